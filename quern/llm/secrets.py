"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are matches of three patterns (assign, access, hex; see BASE). A match's place is found by splitting the text at
the same pattern: the gaps and the matches before it add up to its start.

Linking adds weak candidates, which alone are too common to report: values of a user or key name (`id`), assigned secrets
that assign does not match, being short or a `pwd` (`weak`), and service addresses (`endpoint`). All parts of a document that has weak ones are put in order
of place; a scope is a paragraph (text between blank lines). The interval join holds each weak candidate against the
nearest part of each role before and after it in its scope, by running windows, so no pairs are made: an identifier
(access or id) or a secret (assign, hex or weak) is reported when the other is within SCOPE_GAP code points, an endpoint
when both are.

Cases: null or empty text has no spans and stays as it is. `scan` goes row by row, so null and repeated ids and repeated rows
are kept as they are. `redacted` tells rows by their text alone, so ids do not matter to it, and keeps all columns, whatever
their names. Otherwise other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.shared import table, written

#: Kinds in order, with pattern, group whose length counts, least and largest length, and role.
BASE = {
    "assign": (r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, None, "secret"),
    "access": (r"AKIA[A-Z0-9]+", 0, 18, None, "identifier"),
    "hex": (r"[0-9a-f]{16,}", 0, 16, None, "secret"),
}
#: Weak parts of credentials, reported only where complementary parts are near.
WEAK = {
    "id": (r"""(?i)(access_?key_?id|client_?id|account_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]+)""", 2, 3, None, "identifier"),
    "weak": (r"""(?i)(password|passwd|pwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 4, 11, "secret"),
    "endpoint": (r"(?i)(https?|jdbc:[a-z]+|mongodb|postgres|postgresql|mysql|redis|amqp|s3)://([A-Za-z0-9._~:/?#@!&+=%-]+)", 2, 3, None, "endpoint"),
}
#: Where a scope ends.
_BREAK = {"break": (r"\n[\x20\t\r]*\n", 0, 1, None, "break")}
KINDS = BASE | WEAK | _BREAK
#: Keys whose values may have any length, since no base kind has them.
_ANY_LENGTH = {"weak": "pwd"}
#: Matches whose places are added up together; it keeps the copying of growing lists small.
_TOGETHER = 256
ROLES = ("identifier", "secret", "endpoint")
SCOPE_GAP = 400
#: A cheap test for each kind; texts that fail it have no match.
_HINTS = {"assign": r"(?i)passw|secret|token|api_?key", "access": "AKIA", "hex": r"[0-9a-f]{16}", "id": r"(?i)(?:id|user|name|login)[\"']?\x20*[:=]", "weak": r"(?i)(?:passw(?:or)?d|pwd|secret|token|key)[\"']?\x20*[:=]", "endpoint": "://", "break": r"\n[\x20\t\r]*\n"}
_SPAN = "array<struct<start:int,rank:int,stop:int>>"


def _parts(text: Column, kind: str) -> Column:
    """Of each match of one kind: free of a largest length, its length, its value's and that of the gap before it."""
    pattern, group, *_ = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    key = _ANY_LENGTH.get(kind)
    free = F.transform(whole, lambda x: F.lower(x).startswith(key) if key else F.lit(False))
    parts = F.arrays_zip(free.alias("f"), F.transform(whole, F.length).alias("m"), F.transform(value, F.length).alias("v"), F.transform(F.slice(F.split(text, pattern, -1), 1, F.size(whole)), F.length).alias("g"))
    return F.when(text.rlike(_HINTS[kind]), parts).otherwise(F.array().cast("array<struct<f:boolean,m:int,v:int,g:int>>"))


def _spans(parts: str, kind: str) -> Column:
    """Array of (start, rank, stop) of one kind in code points, in order, from a column of its parts."""
    _, _, least, most, _ = KINDS[kind]
    rank = list(KINDS).index(kind)
    chunk = lambda c: F.slice(F.col(parts), c * _TOGETHER + 1, F.lit(_TOGETHER))
    chunks = F.when(F.size(parts) > 0, F.sequence(F.lit(0), F.expr(f"(size(`{parts}`) - 1) div {_TOGETHER}").cast("int"))).otherwise(F.array().cast("array<int>"))
    sizes = F.transform(chunks, lambda c: F.aggregate(chunk(c), F.lit(0), lambda n, x: n + x["g"] + x["m"]))
    begins = F.aggregate(sizes, F.array(F.lit(0)), lambda at, n: F.array_append(at, F.element_at(at, -1) + n))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["g"]
        one = F.struct(begin.alias("start"), F.lit(rank).alias("rank"), (begin + x["m"]).alias("stop"))
        good = (x["v"] >= least) & (F.lit(True) if most is None else x["f"] | (x["v"] <= most))
        return F.struct((begin + x["m"]).alias("at"), F.when(good, F.array_append(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    placed = F.arrays_zip(chunks.alias("c"), F.slice(begins, F.lit(1), F.size(begins) - 1).alias("at"))
    return F.flatten(F.transform(placed, lambda z: F.aggregate(chunk(z["c"]), F.struct(z["at"].alias("at"), F.array().cast(_SPAN).alias("out")), step)["out"]))


def _found(rows: DataFrame) -> DataFrame:
    """rows(.., text) with the spans in `base`, `weak` and, where there are weak ones, `breaks` in place of the text."""
    kept = [c for c in rows.columns if c != "text"]
    rows = rows.select(*kept, *(_parts(F.col("text"), k).alias(f"parts of {k}") for k in KINDS))
    found = [reduce(F.concat, [_spans(f"parts of {k}", k) for k in kinds]) for kinds in (BASE, WEAK, _BREAK)]
    rows = rows.select(*kept, *(c.alias(n) for c, n in zip(found, ("base", "weak", "breaks"), strict=True)))
    return rows.withColumn("breaks", F.when(F.size("weak") > 0, F.col("breaks")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["rank"] + 1), x["start"].cast("string"), x["stop"].cast("string"))), ",")


def _linked(facts: DataFrame, gap: int) -> DataFrame:
    """(row, linked): the weak spans of each row that have their complementary parts."""
    parts = facts.where("size(weak) > 0").select("row", F.explode(F.concat("base", "weak", "breaks")).alias("x")).select("row", "x.*")
    names = list(KINDS)
    role = F.element_at(F.array(*(F.lit(KINDS[k][4]) for k in names)), F.col("rank") + 1)
    order = Window.partitionBy("row").orderBy("start", "rank")
    parts = parts.withColumn("role", role).withColumn("scope", F.sum((F.col("role") == "break").cast("int")).over(order)).where("role <> 'break'")
    before = Window.partitionBy("row", "scope").orderBy("start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("row", "scope").orderBy(F.desc("start"), F.desc("rank")).rowsBetween(Window.unboundedPreceding, -1)
    for r in ROLES:
        parts = parts.withColumn(f"{r}_before", F.max(F.when(F.col("role") == r, F.col("stop"))).over(before))
    for r in ROLES:
        parts = parts.withColumn(f"{r}_after", F.min(F.when(F.col("role") == r, F.col("start"))).over(after))
    near = {r: F.coalesce(F.col(f"{r}_before") >= F.col("start") - gap, F.lit(False)) | F.coalesce(F.col(f"{r}_after") <= F.col("stop") + gap, F.lit(False)) for r in ROLES}
    met = F.when(F.col("role") == "identifier", near["secret"]).when(F.col("role") == "secret", near["identifier"]).otherwise(near["identifier"] & near["secret"])
    weak = F.col("rank").between(len(BASE), len(BASE) + len(WEAK) - 1)
    return parts.where(weak & met).groupBy("row").agg(F.collect_list(F.struct("start", "rank", "stop")).cast(_SPAN).alias("linked"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", gap: int = SCOPE_GAP) -> DataFrame:
    """Per row: row, doc_id, base and linked (arrays of start, rank in KINDS, stop). `row` numbers the rows of docs."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    facts = written(_found(docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), F.monotonically_increasing_id().alias("row"))), "spans")
    return facts.join(_linked(facts, gap), "row", "left").select("row", "doc_id", "base", F.coalesce("linked", F.array().cast(_SPAN)).alias("linked"))


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of scan()'s rows."""
    of = lambda k: lambda x: x["rank"] == k
    counts = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{n}") for k, n in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "linked")).alias("spans"))


def redacted(docs: DataFrame, text_col: str = "text", gap: int = SCOPE_GAP, mark: str = "[SECRET]") -> DataFrame:
    """docs with every span, base or linked, replaced by the mark. All rows and columns stay."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    key = F.md5(text)  # what is linked in a text depends on the text alone
    found = _found(docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("whole"), key.alias("row"), text.alias("text")))
    linked = written(_linked(found.drop("whole").where("size(weak) > 0").dropDuplicates(["row"]), gap), "linked").withColumnRenamed("row", "of")
    rows = found.join(linked, F.col("row") == F.col("of"), "left")
    rows = rows.select("whole", F.array_sort(F.concat("base", F.coalesce("linked", F.array().cast(_SPAN)))).alias("spans"))
    text = F.col("whole").getField(text_col)

    def step(acc: Column, x: Column) -> Column:
        kept = F.when(x["start"] > acc["at"], F.array_append(acc["out"], F.struct((acc["at"] + 1).alias("a"), (x["start"] - acc["at"]).alias("n")))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), F.when(x["start"] >= acc["at"], F.array_append(kept, F.struct(F.lit(0).alias("a"), F.lit(0).alias("n")))).otherwise(kept).alias("out"))

    pieces = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,n:int>>").alias("out")), step)
    rows = rows.withColumn("pieces", F.when(F.size("spans") > 0, pieces))
    clean = F.concat(F.array_join(F.transform("pieces.out", lambda p: F.when(p["a"] == 0, F.lit(mark)).otherwise(F.substring(text, p["a"], p["n"]))), ""), F.substring(text, F.col("pieces.at") + 1, F.length(text)))
    return rows.select(*(F.when(F.col("pieces").isNull(), text).otherwise(clean).alias(c) if c == text_col else F.col("whole").getField(c).alias(c) for c in docs.columns))


def op10_secret_scan(spark, sf_dir: str) -> DataFrame:
    return digest(scan(table(spark, sf_dir, "documents")))


def _oracle() -> str:
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    scans = []
    for rank, (kind, (pattern, group, least, most, role)) in enumerate(KINDS.items()):
        p = quoted(pattern)
        free = f" OR starts_with(lower(x), '{_ANY_LENGTH[kind]}')" if kind in _ANY_LENGTH else ""
        good = f"v >= {least}" + (f" AND (v <= {most}{free})" if most else "")
        scans.append(
            f"SELECT doc_id, '{kind}' AS kind, {rank} AS rank, '{role}' AS role, start, start + m AS stop FROM (SELECT *, sum(g + m) OVER (PARTITION BY doc_id ORDER BY i) - m AS start FROM (SELECT *, length(x) AS m FROM ("
            f"SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS x, length(unnest(b)) AS v, length(unnest(c[1 : len(a)])) AS g FROM "
            f"(SELECT doc_id, regexp_extract_all(t, {p}, 0) AS a, regexp_extract_all(t, {p}, {group}) AS b, string_split_regex(t, {p}) AS c FROM d)))) WHERE {good}"
        )
    near = lambda r: f"EXISTS (FROM scoped y WHERE y.doc_id = x.doc_id AND y.scope = x.scope AND y.role = '{r}' AND (y.start, y.rank) <> (x.start, x.rank) AND CASE WHEN (y.start, y.rank) < (x.start, x.rank) THEN y.stop >= x.start - {SCOPE_GAP} ELSE y.start <= x.stop + {SCOPE_GAP} END)"
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), found AS MATERIALIZED ("
        + " UNION ALL ".join(scans)
        + "), scoped AS MATERIALIZED (SELECT *, sum(CAST(role = 'break' AS INT)) OVER (PARTITION BY doc_id ORDER BY start, rank) AS scope FROM found), "
        + f"weak AS (SELECT * FROM scoped x WHERE rank BETWEEN {len(BASE)} AND {len(BASE) + len(WEAK) - 1} AND CASE role WHEN 'identifier' THEN {near('secret')} WHEN 'secret' THEN {near('identifier')} ELSE {near('identifier')} AND {near('secret')} END), "
        + f"kept AS (SELECT doc_id, kind, rank, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS s FROM found WHERE rank < {len(BASE)} UNION ALL SELECT doc_id, kind, rank, start, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) FROM weak) "
        + "SELECT d.doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex, "
        + f"sha256(coalesce(string_agg(s, ',' ORDER BY start, rank) FILTER (rank < {len(BASE)}), '')) AS base_sha256, coalesce(string_agg(s, ',' ORDER BY start, rank), '') AS spans FROM d LEFT JOIN kept USING (doc_id) GROUP BY d.doc_id"
    )


ORACLE = _oracle()

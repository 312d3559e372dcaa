"""All registered queries outside the llm subpackage, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import conversations as C
from quern.operators import dedup, diff, etl, evaluate, gates, resolve, stats, validate, views
from quern.plans import query as Q
from quern.schema import ACTION_VERBS, LIFECYCLE_STATES, TRANSITIONS
from quern.sources import readers
from quern.streaming import events as E

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers the decorated function under its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as dataset records: license by statement, score by size, status by label."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    status = F.when(F.col("quality") == 1, "approved").when(F.col("quality") == 0, "rejected").otherwise("pending")
    rows = docs.join(labels, "doc_id", "left")
    return rows.select("doc_id", "lang", "source", "n_chars", X.statement_license(F.col("text")).alias("license"), (1 + F.col("n_chars") % 10).cast("int").alias("quality_score"), status.alias("verification_status"), "toxic")


RECORDS = """WITH r AS (SELECT d.doc_id, d.lang, d.source, d.n_chars,
  CASE WHEN contains(text, 'MIT License') THEN 'MIT' WHEN contains(text, 'Apache License') THEN 'Apache-2.0' WHEN contains(text, 'GNU General Public License') THEN 'GPL-3.0' ELSE 'unknown' END AS license,
  CAST(1 + n_chars % 10 AS INTEGER) AS quality_score, CASE quality WHEN 1 THEN 'approved' WHEN 0 THEN 'rejected' ELSE 'pending' END AS verification_status, toxic
  FROM documents d LEFT JOIN labels l USING (doc_id))
"""
_CLEAN = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(nfc_normalize({0}), ''), '[\x00-\x08\x0B\x0C\x0E-\x1F\x7F]', '', 'g'), '[ \t]+', ' ', 'g'), '\n[ \t\r]+', chr(10), 'g'), '[ \t\r]+\n', chr(10), 'g'), '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g')"""
CLEAN = _CLEAN.replace("nfc_normalize({0})", "{0}")
_EMAIL = X.EMAIL
_FLAGS = "list_filter([{}], lambda f: f IS NOT NULL)".format(", ".join(f"CASE WHEN regexp_matches(t, '{p}') THEN '{n}' END" for n, p in (("email", X.EMAIL), ("api_key", X.API_KEY), ("ssn", X.SSN), ("ipv4", X.IPV4))))


# --- text and cleaning ---------------------------------------------------------------------------------------------


@query(
    f"""WITH c AS (SELECT doc_id, lang, {CLEAN.format("text")} AS t FROM documents), f AS (SELECT *, {_FLAGS} AS flags FROM c),
e AS (SELECT *, CASE WHEN t = '' THEN 'empty_text' WHEN length(t) < 8 THEN 'too_short' WHEN length(t) > 100000 THEN 'too_long' WHEN list_contains(flags, 'api_key') OR list_contains(flags, 'ssn') THEN 'pii_high_severity' END AS early,
  regexp_replace(regexp_replace(regexp_replace(t, '{X.EMAIL}', '[REDACTED_EMAIL]', 'g'), '{X.API_KEY}', '[REDACTED_SECRET]', 'g'), '{X.SSN}', '[REDACTED_SSN]', 'g') AS red FROM f),
k AS (SELECT lang, coalesce(early, CASE WHEN row_number() OVER (PARTITION BY CASE WHEN early IS NULL THEN red ELSE CAST(doc_id AS VARCHAR) END ORDER BY doc_id) > 1 THEN 'duplicate_content' END, 'kept') AS reason FROM e)
SELECT lang, reason, count(*) AS n FROM k GROUP BY 1, 2"""
)
def curation_funnel(spark, sf_dir):
    return etl.funnel(table(spark, sf_dir, "documents"), "lang")


@query(f"SELECT doc_id, sha256({CLEAN.format('text')}) AS clean_sha256, length({CLEAN.format('text')}) AS n FROM documents")
def doc_clean_text(spark, sf_dir):
    c = X.clean_text(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(c, 256).alias("clean_sha256"), F.length(c).cast("long").alias("n"))


@query(f"SELECT doc_id, sha256({_CLEAN.format('text')}) AS clean_sha256 FROM documents")
def doc_clean_text_nfc(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.clean_text(F.col("text"), normalize=True), 256).alias("clean_sha256"))


@query("SELECT p_partkey, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') AS tag FROM part")
def tag_slug(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", X.slug(F.col("p_name")).alias("tag"))


@query(f"SELECT doc_id, array_to_string({_FLAGS}, ',') AS flags FROM (SELECT doc_id, text AS t FROM documents)")
def doc_pii_flags(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.pii_flags(F.col("text")), ",").alias("flags"))


@query(f"SELECT doc_id, sha256(regexp_replace(regexp_replace(regexp_replace(text, '{X.EMAIL}', '[REDACTED_EMAIL]', 'g'), '{X.API_KEY}', '[REDACTED_SECRET]', 'g'), '{X.SSN}', '[REDACTED_SSN]', 'g')) AS s FROM documents")
def doc_pii_redact(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(X.redact(F.col("text")), 256).alias("s"))


@query("SELECT CASE WHEN n_chars < 8 THEN 'too_short' WHEN n_chars > 10000 THEN 'too_long' ELSE 'ok' END AS reason, count(*) AS n FROM documents GROUP BY 1")
def doc_length_reasons(spark, sf_dir):
    r = F.when(F.length("text") < 8, "too_short").when(F.length("text") > 10_000, "too_long").otherwise("ok")
    return table(spark, sf_dir, "documents").groupBy(r.alias("reason")).agg(F.count("*").alias("n"))


@query(RECORDS + "SELECT license, count(*) AS n, license = 'unknown' AS denied, license <> 'unknown' AND license <> 'GPL-3.0' AS attribution FROM r GROUP BY 1")
def license_gate_hist(spark, sf_dir):
    c = F.col("license")
    return records(spark, sf_dir).groupBy("license").agg(F.count("*").alias("n")).select("license", "n", X.license_denied(c).alias("denied"), X.attribution_required(c).alias("attribution"))


@query(RECORDS + "SELECT CASE license WHEN 'unknown' THEN 'DENIED' WHEN 'GPL-3.0' THEN 'review' ELSE 'permissive' END AS class, count(*) AS n FROM r GROUP BY 1")
def license_class(spark, sf_dir):
    return records(spark, sf_dir).groupBy(X.license_class(F.col("license")).alias("class")).agg(F.count("*").alias("n"))


_WORDS = "len(regexp_extract_all(t, '[^ \\t\\r\\n\\f\\x0B]+'))"
_SENTENCES = r"list_filter(string_split(regexp_replace(t, '([.!?])[ \t\r\n\f\x0B]+', '\1' || chr(1), 'g'), chr(1)), lambda s: regexp_matches(s, '[^ \t\r\n\f\x0B]'))"


@query(f"SELECT doc_id, {_WORDS} AS n_words, len({_SENTENCES}) AS n_sentences, len(list_distinct(regexp_extract_all(lower(t), '[a-z0-9]+'))) AS n_tokens FROM (SELECT doc_id, text AS t FROM documents)")
def doc_text_measures(spark, sf_dir):
    t = F.col("text")
    return table(spark, sf_dir, "documents").select("doc_id", X.word_count(t).cast("long").alias("n_words"), F.size(X.sentences(t)).cast("long").alias("n_sentences"), F.size(F.array_distinct(X.tokens(t))).cast("long").alias("n_tokens"))


# --- query language ------------------------------------------------------------------------------------------------


def _records(spark, sf_dir, name, text, tie=None):
    return Q.execute(text, table(spark, sf_dir, name), tie).records


@query("SELECT * FROM customer WHERE lower(c_mktsegment) = 'building'")
def query_filter_eq(spark, sf_dir):
    return _records(spark, sf_dir, "customer", 'c_mktsegment:"building"')


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 200000 AND lower(o_orderstatus) <> 'f'")
def query_filter_cmp(spark, sf_dir):
    return _records(spark, sf_dir, "orders", 'SELECT o_orderkey, o_totalprice WHERE o_totalprice >= 200000 AND o_orderstatus != "F"')


@query("SELECT o_orderkey FROM orders WHERE lower(o_orderpriority) IN ('1-urgent', '2-high')")
def query_in(spark, sf_dir):
    return _records(spark, sf_dir, "orders", 'SELECT o_orderkey WHERE o_orderpriority IN ("1-URGENT", "2-high")')


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey <> 0 AND s_acctbal <> 0")
def query_exists(spark, sf_dir):
    return _records(spark, sf_dir, "supplier", "SELECT s_suppkey WHERE s_nationkey EXISTS AND s_acctbal EXISTS")


@query("SELECT doc_id FROM (SELECT d.doc_id, toxic FROM documents d LEFT JOIN labels USING (doc_id)) WHERE toxic <> 1")
def query_neq_null(spark, sf_dir):
    return Q.execute("SELECT doc_id WHERE toxic != 1", records(spark, sf_dir)).records


@query("SELECT o_orderstatus AS key, count(*) AS n FROM orders WHERE o_totalprice > 100000 GROUP BY 1")
def query_group_count(spark, sf_dir):
    return Q.execute("SELECT o_orderstatus WHERE o_totalprice > 100000 GROUP BY o_orderstatus", table(spark, sf_dir, "orders")).groups


@query("SELECT count(*) AS count_all, sum(l_linenumber) AS sum_l_linenumber, round_even(avg(l_quantity), 2) AS avg_l_quantity, min(l_discount) AS min_l_discount, max(l_tax) AS max_l_tax FROM lineitem WHERE lower(l_returnflag) = 'r'")
def query_scalar_aggs(spark, sf_dir):
    return Q.execute('SELECT COUNT(*), SUM(l_linenumber), AVG(l_quantity), MIN(l_discount), MAX(l_tax) WHERE l_returnflag = "R"', table(spark, sf_dir, "lineitem")).aggregations


@query("SELECT (SELECT count(*) FROM lineitem) AS count_all, 0 AS avg_l_quantity FROM (SELECT 1)")
def query_compat_aggs(spark, sf_dir):
    return Q.execute('SELECT l_orderkey, COUNT(*), AVG(l_quantity) WHERE l_returnflag = "R"', table(spark, sf_dir, "lineitem"), compat=True).aggregations


@query("SELECT * FROM orders WHERE lower(o_orderstatus) = 'o' ORDER BY o_totalprice DESC NULLS LAST, o_orderkey LIMIT 20 OFFSET 10")
def query_order_limit_offset(spark, sf_dir):
    return _records(spark, sf_dir, "orders", 'SELECT * WHERE o_orderstatus = "O" ORDER BY o_totalprice DESC LIMIT 20 OFFSET 10', "o_orderkey")


@query("SELECT p_partkey, p_brand, CAST(NULL AS VARCHAR) AS colour FROM part WHERE p_size <= 5")
def query_projection(spark, sf_dir):
    return _records(spark, sf_dir, "part", "SELECT p_partkey, p_brand, colour WHERE p_size <= 5")


@query("SELECT p_partkey FROM part WHERE p_size >= 40 AND lower(p_brand) IN ('brand#11', 'brand#22') AND p_name <> ''")
def query_tag_style(spark, sf_dir):
    return Q.execute("p_size>=40 p_brand in (Brand#11, Brand#22) p_name", table(spark, sf_dir, "part")).records.select("p_partkey")


# --- deduplication -------------------------------------------------------------------------------------------------

_NORM = r"regexp_replace(lower(text), '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g')"


@query(f"SELECT sha1({_NORM}) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def exact_dup_groups(spark, sf_dir):
    return dedup.exact_groups(table(spark, sf_dir, "documents"), X.strip(F.lower("text")))


@query(f"SELECT min(doc_id) AS doc_id FROM documents GROUP BY {_NORM}")
def first_seen_dedup(spark, sf_dir):
    return dedup.first_seen(table(spark, sf_dir, "documents"), F.sha2(X.strip(F.lower("text")), 256)).select("doc_id")


_NEAR = """WITH RECURSIVE tok AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)),
sh AS (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, w || ' ' || lead(w) OVER p || ' ' || lead(w, 2) OVER p || ' ' || lead(w, 3) OVER p AS x FROM tok WINDOW p AS (PARTITION BY doc_id ORDER BY i)) WHERE x IS NOT NULL
  UNION ALL SELECT doc_id, string_agg(w, ' ' ORDER BY i) FROM tok GROUP BY 1 HAVING count(*) < 4),
rep AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY h) AS rep FROM (SELECT doc_id, count(*) AS n, md5(string_agg(x, ',' ORDER BY x)) AS h FROM sh GROUP BY 1)),
g AS (SELECT doc_id, n, x FROM rep JOIN sh USING (doc_id) WHERE doc_id = rep),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS m FROM g a JOIN g b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
p AS (SELECT a, b, m / (na + nb - m) AS jaccard FROM c WHERE m / (na + nb - m) >= 0.8),
l AS (SELECT a, b FROM p UNION ALL SELECT rep, doc_id FROM rep WHERE rep <> doc_id),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(id, other) AS (SELECT a, b FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.other = e.a),
cl AS (SELECT id, least(id, min(other)) AS cluster FROM reach GROUP BY id)
"""


@query(_NEAR + "SELECT a, b, round_even(jaccard, 3) AS sim FROM p")
def near_dup_pairs(spark, sf_dir):
    return dedup.near_pairs(table(spark, sf_dir, "documents")).select("a", "b", F.bround("jaccard", 3).alias("sim"))


def _clusters(spark, sf_dir):
    return dedup.near_links(table(spark, sf_dir, "documents"))


@query(_NEAR + "SELECT id, cluster FROM cl")
def near_dup_clusters(spark, sf_dir):
    return _clusters(spark, sf_dir)


@query(
    _NEAR
    + """, k AS (SELECT doc_id, coalesce(cluster, doc_id) AS cluster, row_number() OVER (PARTITION BY coalesce(cluster, doc_id) ORDER BY n_chars % 10 DESC, length(text) DESC, doc_id) = 1 AS kept FROM documents LEFT JOIN cl ON doc_id = id)
SELECT doc_id, cluster, kept FROM k"""
)
def dedup_survivors(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return dedup.survivors(docs, _clusters(spark, sf_dir), F.col("n_chars") % 10, F.length("text")).select("doc_id", "cluster", "kept")


# --- conversations -------------------------------------------------------------------------------------------------

_CONV = "WITH m AS (SELECT conv_id, list(role ORDER BY turn) AS roles, list(text ORDER BY turn) AS texts FROM conversations GROUP BY 1)\n"


def _conversations(spark, sf_dir):
    return C.to_messages(table(spark, sf_dir, "conversations"))


@query(_CONV + "SELECT conv_id, len(roles) AS n, sha256(array_to_string(list_transform(range(1, len(roles) + 1), lambda i: roles[i] || ':' || lower(regexp_replace(texts[i], '^[ \\t\\r\\n\\f\\x0B]+|[ \\t\\r\\n\\f\\x0B]+$', '', 'g'))), chr(10))) AS norm FROM m")
def conv_messages(spark, sf_dir):
    return _conversations(spark, sf_dir).select("conv_id", F.size("messages").cast("long").alias("n"), F.sha2(C.norm_text(F.col("messages")), 256).alias("norm"))


@query(
    _CONV
    + """SELECT conv_id, CASE WHEN len(roles) < 2 THEN 'too_short' WHEN len(list_filter(texts, lambda x: regexp_replace(coalesce(x, ''), '[ \\t\\r\\n\\f\\x0B]+', '', 'g') = '')) > 0 THEN 'empty_turn'
WHEN len(list_filter(roles, lambda x: x NOT IN ('system', 'user', 'assistant', 'tool'))) > 0 THEN 'bad_role' WHEN NOT list_contains(roles, 'user') THEN 'no_user' WHEN NOT list_contains(roles, 'assistant') THEN 'no_assistant' END AS problem FROM m"""
)
def conv_validate(spark, sf_dir):
    return _conversations(spark, sf_dir).select("conv_id", C.problem(F.col("messages")).alias("problem"))


@query("SELECT role, count(*) AS n, count(DISTINCT conv_id) AS n_conv, round_even(avg(length(text)), 2) AS mean_chars FROM conversations GROUP BY 1")
def conv_role_stats(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("role").agg(F.count("*").alias("n"), F.count_distinct("conv_id").alias("n_conv"), F.bround(F.avg(F.length("text")), 2).alias("mean_chars"))


def _render_oracle(style: str) -> str:
    t = C.TEMPLATES[style]
    quoted = lambda x: "'" + x.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
    filled = lambda tpl, v: f"{quoted(tpl.split('{}')[0])} || {v} || {quoted(tpl.split('{}')[1])}"
    pick = "first" if style == "gemma" else "last"
    said = f"CASE WHEN i = first_user AND system IS NOT NULL THEN {filled(t['fold'], 'system')} || text ELSE text END" if t["fold"] else "text"
    head = quoted(t["header"]) + (f" || coalesce({filled(t['system'], 'system')}, '')" if t["system"] else "")
    return f"""WITH s AS (SELECT conv_id, nullif({pick}(text ORDER BY turn) FILTER (role = 'system'), '') AS system, min(turn) FILTER (role = 'user') AS first_user FROM conversations GROUP BY 1),
x AS (SELECT c.conv_id, turn, CASE WHEN role = 'user' THEN {filled(t["user"], f"({said})")} ELSE {filled(t["assistant"], "text")} END AS part FROM (SELECT *, turn AS i FROM conversations) c JOIN s USING (conv_id) WHERE role IN ('user', 'assistant')),
y AS (SELECT conv_id, string_agg(part, '' ORDER BY turn) AS body FROM x GROUP BY 1)
SELECT s.conv_id, {head} || coalesce(body, '') AS text FROM s LEFT JOIN y USING (conv_id)"""


def _renders() -> None:
    for style in C.TEMPLATES:

        def run(spark, sf_dir, style=style):
            return _conversations(spark, sf_dir).select("conv_id", C.render_text(F.col("messages"), style).alias("text"))

        run.__name__ = f"render_{style}"
        query(_render_oracle(style))(run)


_renders()


@query(
    _CONV
    + """SELECT conv_id, len(roles) AS n, sha256(array_to_string(list_transform(range(1, len(roles) + 1), lambda i: CASE roles[i] WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE roles[i] END || ':' || texts[i]), chr(10))) AS s FROM m"""
)
def render_sharegpt(spark, sf_dir):
    kind = "conversations array<struct<role:string,content:string>>, id string"
    j = F.from_json(C.sharegpt(F.col("messages"), F.col("conv_id")), kind)
    return _conversations(spark, sf_dir).withColumn("j", j).select("conv_id", F.size("j.conversations").cast("long").alias("n"), F.sha2(F.array_join(F.transform("j.conversations", lambda m: F.concat_ws(":", m["role"], m["content"])), "\n"), 256).alias("s"))


@query(
    """WITH a AS (SELECT conv_id, first(text ORDER BY turn) FILTER (role = 'user') AS u, first(text ORDER BY turn) FILTER (role = 'assistant') AS o, count(*) FILTER (role = 'user') AS nu, count(*) FILTER (role = 'assistant') AS na FROM conversations GROUP BY 1)
SELECT conv_id, CASE WHEN strpos(u, chr(10) || chr(10)) > 0 THEN substr(u, 1, strpos(u, chr(10) || chr(10)) - 1) ELSE u END AS instruction, CASE WHEN strpos(u, chr(10) || chr(10)) > 0 THEN substr(u, strpos(u, chr(10) || chr(10)) + 2) ELSE '' END AS input, o AS output,
CASE WHEN nu > 1 OR na > 1 THEN 'multiturn-collapsed' END AS warn FROM a WHERE nu > 0 AND na > 0"""
)
def render_alpaca(spark, sf_dir):
    return _conversations(spark, sf_dir).select("conv_id", C.alpaca(F.col("messages")).alias("a")).where("a IS NOT NULL").select("conv_id", "a.*")


# --- quality evaluation --------------------------------------------------------------------------------------------


def _conversation_records(spark, sf_dir):
    """Conversations with a category by number, no tags and a subcategory, as records to be scored."""
    rows = _conversations(spark, sf_dir)
    names = F.array(*map(F.lit, evaluate.CATEGORY_KEYWORDS))
    return rows.withColumns({"category": F.element_at(names, (F.col("conv_id") % 9 + 1).cast("int")), "subcategory": F.lit("the_other"), "tags": F.array(F.lit("of"), F.lit("api"))})


def _evaluation_oracle() -> str:
    hits = lambda col: "CASE category " + " ".join(f"WHEN '{k}' THEN " + " + ".join(f"CAST(contains({col}, '{w}') AS INT)" for w in ws) for k, ws in evaluate.CATEGORY_KEYWORDS.items()) + " END"
    names = list(evaluate.CATEGORY_KEYWORDS)
    asks = " OR ".join(f"contains(asked, ' {v} ')" for v in ACTION_VERBS)
    stock = " OR ".join("starts_with(stripped, '" + o.replace("'", "''") + "')" for o in evaluate.BOILERPLATE_OPENERS)
    return rf"""WITH a AS (SELECT conv_id, {names}[conv_id % 9 + 1] AS category, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'assistant'), '') AS t, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (role = 'user'), '') AS u FROM conversations GROUP BY 1),
b AS (SELECT *, {_WORDS} AS n, list_transform({_SENTENCES}, lambda s: len(regexp_extract_all(s, '[^ \t\r\n\f\x0B]+'))) AS parts, len(regexp_extract_all(t, '```')) AS fences, regexp_matches(t, '\b[0-9]+(?:\.[0-9]+)?\b') AS number,
  regexp_matches(t, '(?m)^[ \t]*[-*][ \t]+|^[ \t]*[0-9]+\.[ \t]+') AS listed, lower(t) AS low, lower(t) || ' of api' AS tagged, lower(t) || ' ' || lower(u) || ' of api' AS blob, ' ' || lower(u) || ' ' AS asked, regexp_replace(lower(t), '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g') AS stripped FROM a),
c AS (SELECT *, len(parts) AS ns, list_sum(parts) / len(parts) AS mean, {hits("low")} AS h1, {hits("tagged")} AS h2, {hits("blob")} AS h3, contains(blob, 'the other') AS sub, ({stock}) AS stock, ({asks}) AS asks, listed OR fences > 0 OR n >= 12 AS acts FROM b),
e AS (SELECT *, CAST(CASE WHEN length(t) < 30 THEN 0.45 WHEN regexp_matches(t, 'https?://') THEN 0.82 ELSE round_even(least(0.95, 0.72 + 0.04 * least(h1, 3) + CASE WHEN number THEN 0.06 ELSE 0 END), 3) END AS DOUBLE) AS accuracy,
  CAST(CASE WHEN n = 0 THEN 0.1 ELSE round_even(least(1, least(1, n / 26.0::DOUBLE) + CASE WHEN ns >= 2 THEN 0.06 ELSE 0 END), 3) END AS DOUBLE) AS completeness,
  CAST(CASE WHEN fences % 2 = 1 THEN 0.4 WHEN fences > 0 THEN 0.9 ELSE round_even(least(1, 0.55 + 0.05 * least(h2, 4) + CASE WHEN number THEN 0.1 ELSE 0 END), 3) END AS DOUBLE) AS technical_correctness,
  CAST(CASE WHEN ns = 0 THEN 0.2 ELSE round_even(greatest(0.1, CASE WHEN mean BETWEEN 8 AND 25 THEN 0.92 WHEN mean BETWEEN 4 AND 40 THEN 0.7 ELSE 0.45 END - CASE WHEN len(regexp_extract_all(t, '\b[A-Z]{{4,}}\b')) > 3 THEN 0.15 ELSE 0 END), 3) END AS DOUBLE) AS clarity,
  CAST(round_even(CASE WHEN n < 8 THEN greatest(0.3, CASE WHEN asks AND acts THEN 0.9 WHEN asks OR acts THEN 0.7 ELSE 0.45 END - 0.2) ELSE CASE WHEN asks AND acts THEN 0.9 WHEN asks OR acts THEN 0.7 ELSE 0.45 END END, 3) AS DOUBLE) AS usefulness,
  CAST(CASE WHEN stock THEN 0.4 WHEN length(t) < 25 THEN 0.55 ELSE 0.85 END AS DOUBLE) AS originality,
  CAST(CASE WHEN h3 = 0 AND NOT sub THEN 0.4 WHEN h3 >= 2 OR (h3 >= 1 AND sub) THEN 0.95 ELSE 0.7 END AS DOUBLE) AS relevance FROM c),
q AS (SELECT *, accuracy * 0.2::DOUBLE + completeness * 0.15::DOUBLE + technical_correctness * 0.2::DOUBLE + clarity * 0.15::DOUBLE + usefulness * 0.15::DOUBLE + originality * 0.05::DOUBLE + relevance * 0.1::DOUBLE AS whole,
  round_even(least(1, greatest(0, 0.3::DOUBLE * least(1, n / 24.0::DOUBLE) + 0.25::DOUBLE + 0.2::DOUBLE * relevance + 0.15::DOUBLE * least(1, 0.5::DOUBLE * ns + CASE WHEN listed THEN 0.5 ELSE 0 END) + 0.1::DOUBLE * CASE WHEN number OR fences > 0 THEN 0.6 ELSE 0.3 END)), 3) AS confidence FROM e),
z AS (SELECT *, CAST(greatest(1, least(10, round_even(1 + round_even(whole, 9) * 9, 0))) AS INTEGER) AS quality_score, CAST(greatest(1, least(5, round_even(1 + confidence * 4, 0))) AS INTEGER) AS confidence_level,
  array_to_string(list_filter([CASE WHEN n < 8 THEN 'very_short_answer' END, CASE WHEN relevance < 0.5 THEN 'low_relevance' END, CASE WHEN confidence < 0.5 THEN 'low_confidence' END, CASE WHEN stock THEN 'boilerplate_opener' END, CASE WHEN fences % 2 = 1 THEN 'unclosed_code_fence' END], lambda f: f IS NOT NULL), ',') AS flags FROM q)
"""


_EVAL = _evaluation_oracle()


def _evaluated(spark, sf_dir):
    return evaluate.evaluate(_conversation_records(spark, sf_dir))


@query(_EVAL + "SELECT conv_id, accuracy, completeness, technical_correctness, clarity, usefulness, originality, relevance FROM z")
def eval_dimensions(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("conv_id", "dims.*")


@query(_EVAL + "SELECT conv_id, quality_score, round_even(confidence, 3) AS confidence, confidence_level, flags FROM z")
def eval_scores(spark, sf_dir):
    return _evaluated(spark, sf_dir).select("conv_id", "quality_score", "confidence", "confidence_level", F.array_join("flags", ",").alias("flags"))


@query(_EVAL + "SELECT quality_score, count(*) AS n FROM z GROUP BY 1")
def eval_score_hist(spark, sf_dir):
    return _evaluated(spark, sf_dir).groupBy("quality_score").agg(F.count("*").alias("n"))


@query(_EVAL + "SELECT flag, count(*) AS n FROM (SELECT unnest(string_split(flags, ',')) AS flag FROM z WHERE flags <> '') GROUP BY 1")
def eval_flags(spark, sf_dir):
    return _evaluated(spark, sf_dir).select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@query(
    _EVAL
    + "SELECT area, problem, count(*) AS n FROM (SELECT unnest(list_filter(["
    + ", ".join(f"CASE WHEN {k} < {v} THEN ['{k}', 'low_score'] END" for k, v in evaluate.REVISION_FLOORS.items())
    + "] , lambda p: p IS NOT NULL) || list_transform(list_filter(string_split(flags, ','), lambda f: f <> ''), lambda f: ['flag', f])) AS p FROM z), LATERAL (SELECT p[1] AS area, p[2] AS problem) GROUP BY 1, 2"
)
def revision_counts(spark, sf_dir):
    return evaluate.proposals(_evaluated(spark, sf_dir), "conv_id").groupBy("area", "problem").agg(F.count("*").alias("n"))


# --- calibration and metrics ---------------------------------------------------------------------------------------


def pairs(spark, sf_dir):
    """Automatic scores (by size) and human scores (by label) of the labelled documents."""
    labels = table(spark, sf_dir, "labels")
    human = F.when(F.col("quality") == 1, 6 + F.col("doc_id") % 4).otherwise(3 + F.col("doc_id") % 3)
    auto = 3 + (F.length("text") + F.col("doc_id")) % 6
    return table(spark, sf_dir, "documents").join(labels, "doc_id").select("doc_id", "lang", "source", auto.cast("double").alias("auto"), human.cast("double").alias("human"), "quality", "toxic")


_PAIRS = "WITH p AS (SELECT d.doc_id, lang, source, CAST(3 + (length(text) + d.doc_id) % 6 AS DOUBLE) AS auto, CAST(CASE WHEN quality = 1 THEN 6 + d.doc_id % 4 ELSE 3 + d.doc_id % 3 END AS DOUBLE) AS human, quality, toxic FROM documents d JOIN labels USING (doc_id))\n"
_CM = "count(*) FILTER (auto >= 7 AND human >= 7) AS tp, count(*) FILTER (auto >= 7 AND human < 7) AS fp, count(*) FILTER (auto < 7 AND human >= 7) AS fn, count(*) FILTER (auto < 7 AND human < 7) AS tn"


@query(
    _PAIRS
    + f"""SELECT n, round_even(exact, 3) AS exact, round_even(within1, 3) AS within1, round_even(mae, 3) AS mae, round_even(rmse, 3) AS rmse, round_even(bias, 3) AS bias, round_even(r, 3) AS pearson_r, tp, fp, fn, tn,
round_even(tp / (tp + fp), 3) AS precision, round_even(tp / (tp + fn), 3) AS recall, round_even(2 * tp / (2 * tp + fp + fn), 3) AS f1, round_even((tp + tn) / n, 3) AS accuracy,
CASE WHEN within1 >= 0.8 AND 2 * tp / (2 * tp + fp + fn) >= 0.85 THEN 'READY_FOR_CALIBRATED_AUTO_REVIEW' WHEN within1 >= 0.6 AND 2 * tp / (2 * tp + fp + fn) >= 0.7 THEN 'REQUIRES_HUMAN_REVIEW' ELSE 'NOT_READY' END AS verdict
FROM (SELECT count(*) AS n, avg(CAST(auto = human AS INT)) AS exact, avg(CAST(abs(auto - human) <= 1 AS INT)) AS within1, avg(abs(auto - human)) AS mae, sqrt(avg((auto - human) * (auto - human))) AS rmse, avg(auto - human) AS bias, corr(auto, human) AS r, {_CM} FROM p)"""
)
def calib_global(spark, sf_dir):
    return stats.global_metrics(pairs(spark, sf_dir))


_STRATUM = f"SELECT count(*) AS n, avg(auto) AS am, avg(human) AS hm, avg(auto - human) AS b, avg(abs(auto - human)) AS e, avg(CAST(abs(auto - human) <= 1 AS INT)) AS w, {_CM}, "


@query(
    _PAIRS
    + f""", g AS ({_STRATUM} 'lang' AS scope, lang AS stratum FROM p GROUP BY lang UNION ALL {_STRATUM} 'source', source FROM p GROUP BY source),
f AS (SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, greatest(0, 1 - e / 9) * sqrt(least(n, 10) / 10) AS conf FROM g)
SELECT scope, stratum, n, round_even(am, 2) AS auto_mean, round_even(hm, 2) AS human_mean, round_even(b, 3) AS bias, round_even(e, 3) AS mae, round_even(w, 3) AS within1, round_even(f1, 3) AS f1, round_even(-b, 3) AS correction, round_even(conf, 3) AS confidence,
CASE WHEN conf < 0.5 OR abs(b) >= 1 OR f1 < 0.7 THEN 'MANDATORY_HUMAN_REVIEW' ELSE 'AUTO_ALLOWED' END AS gate,
CASE WHEN conf < 0.5 OR abs(b) >= 1 OR f1 < 0.7 THEN 'MANDATORY_HUMAN_REVIEW' WHEN abs(round_even(b, 3)) >= 1 THEN 'APPLY_ADDITIVE_CORRECTION' ELSE 'MONITOR' END AS action FROM f"""
)
def calib_strata(spark, sf_dir):
    return stats.strata(pairs(spark, sf_dir), ["lang", "source"])


@query(_PAIRS + ", r AS (SELECT rank() OVER (ORDER BY auto) + (count(*) OVER (PARTITION BY auto) - 1) / 2 AS a, rank() OVER (ORDER BY human) + (count(*) OVER (PARTITION BY human) - 1) / 2 AS h FROM p) SELECT round_even(corr(a, h), 3) AS spearman_r FROM r")
def calib_spearman(spark, sf_dir):
    return stats.spearman(pairs(spark, sf_dir))


@query(
    _PAIRS
    + """, d AS (SELECT unnest(['clarity', 'relevance']) AS dimension, unnest([(auto - 1) / 9 * 9 + 1, human / 10 * 9 + 1]) AS a, human AS h FROM p)
SELECT dimension, count(*) AS n, round_even(avg(a), 2) AS auto_mean, round_even(avg(h), 2) AS human_mean, round_even(avg(a - h), 3) AS bias, round_even(avg(abs(a - h)), 3) AS mae, round_even(corr(a, h), 3) AS pearson_r,
CASE WHEN round_even(avg(abs(a - h)), 3) >= 2 AND coalesce(round_even(corr(a, h), 3), 0) < 0.3 THEN 'RETUNE_WEIGHT' ELSE 'MONITOR' END AS action FROM d GROUP BY 1"""
)
def calib_dimensions(spark, sf_dir):
    p = pairs(spark, sf_dir).select(((F.col("auto") - 1) / 9).alias("auto_clarity"), (F.col("human") / 10).alias("auto_relevance"), F.col("human").alias("human_clarity"), F.col("human").alias("human_relevance"))
    return stats.dimension_metrics(p, ["clarity", "relevance"])


@query(
    _PAIRS
    + """, c AS (SELECT count(*) AS t, sum(CAST(quality = 1 - toxic AS INT)) AS same, sum(quality) AS q1, sum(1 - toxic) AS t1 FROM p)
SELECT t AS n, round_even(same / t, 4) AS observed, round_even((q1 * t1 + (t - q1) * (t - t1)) / (t * t), 4) AS expected, round_even((same / t - (q1 * t1 + (t - q1) * (t - t1)) / (t * t)) / (1 - (q1 * t1 + (t - q1) * (t - t1)) / (t * t)), 4) AS kappa FROM c"""
)
def calib_kappa(spark, sf_dir):
    return stats.kappa(pairs(spark, sf_dir).withColumn("clean", 1 - F.col("toxic")), "quality", "clean")


@query(_PAIRS + "SELECT doc_id, auto, human, abs(auto - human) AS distance FROM p ORDER BY distance DESC, doc_id LIMIT 15")
def top_disagreements(spark, sf_dir):
    d = F.abs(F.col("auto") - F.col("human"))
    return pairs(spark, sf_dir).select("doc_id", "auto", "human", d.alias("distance")).orderBy(F.desc("distance"), "doc_id").limit(15)


def _metric_rows(spark, sf_dir):
    c = F.col("source")
    return records(spark, sf_dir).withColumns({"source_id": F.when(c != "src3", c), "source_name": F.when(c != "src4", c), "source_url": F.when(c < "src5", F.concat(F.lit("http://"), c))})


@query(
    RECORDS
    + """, m AS (SELECT *, CASE WHEN source <> 'src3' THEN source END AS source_id, CASE WHEN source <> 'src4' THEN source END AS source_name, CASE WHEN source < 'src5' THEN 'http://' || source END AS source_url FROM r),
x AS (SELECT round_even(avg(quality_score), 2) AS quality_mean_score, round_even(avg(CAST(quality_score >= 7 AS INT)), 4) AS quality_score_agreement, round_even(avg(CAST(source_id IS NOT NULL AS INT)), 4) AS provenance_valid_source_rate,
round_even(avg(CAST(license <> 'unknown' AS INT)), 4) AS provenance_license_pass_rate, round_even(avg(CAST(source_id IS NOT NULL AND source_name IS NOT NULL AND source_url IS NOT NULL AS INT)), 4) AS provenance_accuracy,
round_even(avg(CAST(verification_status <> 'rejected' AND license <> 'unknown' AS INT)), 4) AS content_safety_rate, round_even(avg(CAST(source_id IS NULL OR (source_name IS NULL AND source_url IS NULL) AS INT)), 4) AS hallucination_risk,
round_even(count(*) FILTER (verification_status = 'approved' AND quality_score >= 7) / count(*) FILTER (verification_status = 'approved'), 4) AS approval_prediction_accuracy FROM m)
UNPIVOT x ON COLUMNS(*) INTO NAME metric VALUE value"""
)
def metric_suite(spark, sf_dir):
    return stats.run_metrics(_metric_rows(spark, sf_dir))


@query(RECORDS + "SELECT lang, round_even(avg(quality_score), 2) AS mean_score, count(*) AS n FROM r GROUP BY 1")
def metric_category_avg(spark, sf_dir):
    return records(spark, sf_dir).groupBy("lang").agg(F.bround(F.avg("quality_score"), 2).alias("mean_score"), F.count("*").alias("n"))


@query("SELECT lang, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM documents GROUP BY 1")
def coverage(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


_TARGETS = {"en": 0.5, "fr": 0.2, "de": 0.15, "it": 0.05}


@query(
    """WITH g AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), w(k, target) AS (VALUES ('en', 0.5::DOUBLE), ('fr', 0.2), ('de', 0.15), ('it', 0.05))
SELECT coalesce(lang, k) AS key, coalesce(n, 0) AS n, round_even(coalesce(n, 0) / (SELECT sum(n) FROM g), 4) AS share, target,
CASE WHEN target IS NULL THEN 'UNEXPECTED' WHEN coalesce(n, 0) / (SELECT sum(n) FROM g) < target - 0.05 THEN 'LOW' WHEN coalesce(n, 0) / (SELECT sum(n) FROM g) > target + 0.05 THEN 'HIGH' ELSE 'OK' END AS verdict FROM g FULL JOIN w ON lang = k"""
)
def dataset_statistics(spark, sf_dir):
    return stats.shares_against_targets(table(spark, sf_dir, "documents"), "lang", _TARGETS)


# --- gates and readiness -------------------------------------------------------------------------------------------


def _gates(spark, sf_dir):
    r = records(spark, sf_dir)
    rejected = r.where("toxic = 1").select("source").where("source IN ('src1', 'src2')")
    checks = [gates.quality(), gates.license(), gates.unknown_license(), gates.schema(["lang", "license", "toxic"]), gates.rejected_source()]
    return gates.run([gates.gates(gates.mark_rejected(r, rejected), "doc_id", checks), gates.balance_gate(r, "lang", _TARGETS)])


def _gate_oracle() -> str:
    bad = {"quality": ("quality_score < 7", "fail"), "license": ("license = 'unknown'", "fail"), "unknown_license": ("license = 'unknown'", "warn"), "schema": ("toxic IS NULL", "fail"), "rejected_source": ("source IN (SELECT source FROM r WHERE toxic = 1 AND source IN ('src1', 'src2'))", "fail")}
    one = [
        f"SELECT '{k}' AS gate, CASE WHEN count(*) FILTER ({t}) > 0 THEN '{s}' ELSE 'pass' END AS status, count(*) AS n, count(*) FILTER ({t}) AS n_bad, (SELECT array_to_string(list(i ORDER BY i), ',') FROM (SELECT CAST(doc_id AS VARCHAR) AS i FROM r WHERE {t} ORDER BY i LIMIT 20)) AS first_ids FROM r"
        for k, (t, s) in bad.items()
    ]
    balance = """SELECT 'balance', CASE WHEN count(*) FILTER (off) > 0 THEN 'fail' ELSE 'pass' END, CAST(sum(n) AS BIGINT), count(*) FILTER (off), string_agg(key, ',' ORDER BY key) FILTER (off) FROM (SELECT coalesce(lang, k) AS key, coalesce(n, 0) AS n, target IS NULL OR abs(round_even(coalesce(n, 0) / (SELECT count(*) FROM r), 4) - target) / target > 0.05 AS off
FROM (SELECT lang, count(*) AS n FROM r GROUP BY 1) FULL JOIN (VALUES ('en', 0.5::DOUBLE), ('fr', 0.2), ('de', 0.15), ('it', 0.05)) w(k, target) ON lang = k)"""
    return RECORDS + ", g AS (" + " UNION ALL ".join([*one, balance]) + ")\n"


_GATES = _gate_oracle()


@query(_GATES + "SELECT gate, status, n, n_bad, coalesce(first_ids, '') AS first_ids FROM g")
def release_gates(spark, sf_dir):
    return _gates(spark, sf_dir).withColumn("first_ids", F.array_join("first_ids", ","))


@query(_GATES + "SELECT count(*) AS n_gates, count(*) FILTER (status = 'pass') AS n_passed, CASE max(CASE status WHEN 'fail' THEN 2 WHEN 'warn' THEN 1 ELSE 0 END) WHEN 2 THEN 'BLOCKED' WHEN 1 THEN 'CONDITIONAL' ELSE 'PASS' END AS decision FROM g")
def release_decision(spark, sf_dir):
    return gates.verdict(_gates(spark, sf_dir))


@query(
    RECORDS
    + """, a AS (SELECT count(*) AS n, count(*) FILTER (verification_status = 'approved') AS n_approved, count(*) FILTER (verification_status = 'pending') AS n_open, round_even(avg(quality_score), 2) AS mean_score, round_even(avg(DISTINCT quality_score), 2) AS distinct_mean_score,
count(*) FILTER (license = 'unknown') AS n_denied, 0::BIGINT AS n_incomplete FROM r),
s AS (SELECT *, CASE WHEN n_approved / n < 0.5 THEN 2 WHEN n_approved / n < 0.8 OR n_open > 0 THEN 1 ELSE 0 END AS x, CASE WHEN mean_score < 7 THEN 1 ELSE 0 END AS y, CASE WHEN n_denied > 0 THEN 2 ELSE 0 END AS z FROM a)
SELECT n, n_approved, n_open, mean_score, distinct_mean_score, n_denied, n_incomplete, round_even(n_approved / n, 4) AS approval_rate, ['READY', 'CONDITIONAL', 'BLOCKED'][x + 1] AS review, ['READY', 'CONDITIONAL', 'BLOCKED'][y + 1] AS data_quality,
['READY', 'CONDITIONAL', 'BLOCKED'][z + 1] AS license, ['READY', 'CONDITIONAL', 'BLOCKED'][greatest(x, y, z) + 1] AS verdict FROM s"""
)
def readiness_composite(spark, sf_dir):
    return gates.readiness(records(spark, sf_dir), "doc_id", ["lang", "license"])


@query("SELECT 'verification' AS gate, CASE WHEN count(*) FILTER (o_orderkey % 97 = 0) > 0 THEN 'fail' ELSE 'pass' END AS status, count(*) AS n, count(*) FILTER (o_orderkey % 97 = 0) AS n_bad FROM orders")
def gate_checksum(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    stored = o.select(F.col("o_orderkey").alias("path"), diff.row_digest("o_custkey", "o_orderstatus").alias("digest"))
    changed = o.withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 97 == 0, "?").otherwise(F.col("o_orderstatus")))
    return gates.checksum_gate(stored, changed.select(F.col("o_orderkey").alias("path"), diff.row_digest("o_custkey", "o_orderstatus").alias("digest"))).drop("first_ids")


# --- diffs ---------------------------------------------------------------------------------------------------------


def _versions(spark, sf_dir):
    """Two versions of orders: some rows removed, some added, some changed in status, priority or price."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", (F.col("o_totalprice") / 1000).alias("score"), F.element_at(F.array(F.lit("approved"), F.lit("review"), F.lit("pending")), (F.col("o_orderkey") % 3 + 1).cast("int")).alias("state"))
    k = F.col("o_orderkey")
    new = o.where(k % 11 != 0).withColumns({"o_orderstatus": F.when(k % 7 == 0, "X").otherwise(F.col("o_orderstatus")), "score": F.when(k % 5 == 0, F.col("score") - 2).otherwise(F.col("score")), "state": F.when(k % 13 == 0, "rejected").otherwise(F.col("state"))})
    return o.where(k % 10 != 3), new


_VERSIONS = """WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice / 1000 AS score, ['approved', 'review', 'pending'][o_orderkey % 3 + 1] AS state FROM orders),
old AS (SELECT * FROM o WHERE o_orderkey % 10 <> 3), new AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_orderpriority, CASE WHEN o_orderkey % 5 = 0 THEN score - 2 ELSE score END AS score, CASE WHEN o_orderkey % 13 = 0 THEN 'rejected' ELSE state END AS state FROM o WHERE o_orderkey % 11 <> 0),
c AS (SELECT coalesce(a.o_orderkey, b.o_orderkey) AS k, a.o_orderkey IS NULL AS added, b.o_orderkey IS NULL AS removed, a.o_orderstatus IS DISTINCT FROM b.o_orderstatus AS f1, a.score IS DISTINCT FROM b.score AS f2, a.state IS DISTINCT FROM b.state AS f3, b.score < a.score - 1 AS dropped, a.state AS s0, b.state AS s1 FROM old a FULL JOIN new b USING (o_orderkey)),
e AS (SELECT *, NOT added AND NOT removed AS stays, NOT added AND NOT removed AND (f1 OR f2 OR f3) AS changed FROM c)
"""
_FIELDS = ["o_orderstatus", "o_orderpriority", "score", "state"]


def _compared(spark, sf_dir):
    return diff.compare(*_versions(spark, sf_dir), "o_orderkey", _FIELDS)


@query(_VERSIONS + "SELECT count(*) FILTER (added) AS added, count(*) FILTER (removed) AS removed, count(*) FILTER (changed) AS changed, count(*) FILTER (stays AND NOT changed) AS unchanged FROM e")
def diff_summary(spark, sf_dir):
    return diff.summary(_compared(spark, sf_dir))


@query(_VERSIONS + "SELECT field, count(*) AS n FROM (SELECT unnest(list_filter([CASE WHEN f1 THEN 'o_orderstatus' END, CASE WHEN f2 THEN 'score' END, CASE WHEN f3 THEN 'state' END], lambda f: f IS NOT NULL)) AS field FROM e WHERE changed) GROUP BY 1")
def diff_field_changes(spark, sf_dir):
    return diff.field_changes(_compared(spark, sf_dir))


@query(_VERSIONS + "SELECT coalesce(a.s, b.s) AS key, coalesce(a.n, 0) AS from_n, coalesce(b.n, 0) AS to_n, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM (SELECT o_orderstatus AS s, count(*) AS n FROM old GROUP BY 1) a FULL JOIN (SELECT o_orderstatus AS s, count(*) AS n FROM new GROUP BY 1) b USING (s)")
def diff_group_delta(spark, sf_dir):
    return diff.group_delta(*_versions(spark, sf_dir), "o_orderstatus")


@query(
    _VERSIONS
    + """, x AS (SELECT count(*) FILTER (NOT added) AS from_total, count(*) FILTER (NOT removed) AS to_total, count(*) FILTER (changed) AS changed, count(*) FILTER (stays) AS common, count(*) FILTER (stays AND dropped) AS degraded, count(*) FILTER (stays AND s1 = 'rejected' AND s0 <> 'rejected') AS regressed FROM e)
SELECT *, 0::BIGINT AS categories_removed, 0 AS fields_removed, from_total + to_total - 2 * common AS churn, round_even((common - changed) / greatest(from_total, to_total), 4) AS stability, degraded > 0.1 * common AS degradation_warning, false AS breaking FROM x"""
)
def semantic_diff(spark, sf_dir):
    old, new = _versions(spark, sf_dir)
    return diff.semantic(_compared(spark, sf_dir), old, new, "score", "state", "o_orderpriority")


#: Chains of four releases each: linked in order, then broken in ways that the event's number tells.
_CHAIN = """WITH RECURSIVE e AS (SELECT event_id // 4 AS chain, event_id % 4 AS seq, sha256(CAST(event_id AS VARCHAR) || event_type) AS content FROM events),
c(chain, seq, prev, content, own) AS (SELECT chain, seq, repeat('0', 64), content, sha256(repeat('0', 64) || content) FROM e WHERE seq = 0 UNION ALL SELECT e.chain, e.seq, c.own, e.content, sha256(c.own || e.content) FROM c JOIN e ON e.chain = c.chain AND e.seq = c.seq + 1),
t AS (SELECT chain, seq, CASE WHEN seq = 0 AND chain % 11 = 3 THEN 'x' WHEN seq = 2 AND chain % 13 = 5 THEN repeat('0', 64) ELSE prev END AS prev, content, CASE WHEN seq = 1 AND chain % 7 = 2 THEN 'y' ELSE own END AS own FROM c),
l AS (SELECT *, lag(own) OVER (PARTITION BY chain ORDER BY seq) AS before FROM t),
"""


def _chains(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.expr("event_id div 4").alias("chain"), (F.col("event_id") % 4).alias("seq"), F.sha2(F.concat(F.col("event_id").cast("string"), "event_type"), 256).alias("content_hash"))
    e = diff.linked(e, "chain", "seq")
    at = lambda seq, by, rest: (F.col("seq") == seq) & (F.col("chain") % by == rest)
    return e.withColumns({"prev_hash": F.when(at(0, 11, 3), "x").when(at(2, 13, 5), diff.GENESIS).otherwise(F.col("prev_hash")), "hash": F.when(at(1, 7, 2), "y").otherwise(F.col("hash"))})


@query(_CHAIN + "p AS (SELECT chain, CASE WHEN seq = 0 AND prev <> repeat('0', 64) THEN 'bad_genesis' WHEN seq > 0 AND prev IS DISTINCT FROM before THEN 'broken_link' WHEN own <> sha256(prev || content) THEN 'bad_hash' ELSE 'ok' END AS problem FROM l) SELECT problem, count(*) AS n, count(DISTINCT chain) AS n_chains, min(chain) AS first_chain FROM p GROUP BY 1")
def chain_verify(spark, sf_dir):
    got = diff.verify_chain(_chains(spark, sf_dir), "seq", by="chain")
    return got.groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(F.count("*").alias("n"), F.count_distinct("chain").alias("n_chains"), F.min("chain").alias("first_chain"))


# --- views, splits, decisions, lookup ------------------------------------------------------------------------------


def _view_rows(spark, sf_dir):
    return records(spark, sf_dir).withColumns({"eligible": F.col("doc_id") % 4 != 0, "lineage_complete": F.col("doc_id") % 9 != 0, "verified": F.col("toxic") == 0})


_VIEW = RECORDS + ", v AS (SELECT *, CASE WHEN verification_status = 'rejected' THEN 'rejected' WHEN verification_status <> 'approved' THEN 'pending_review' WHEN license = 'unknown' THEN 'license_denied' WHEN quality_score < 5 THEN 'quality_below' WHEN doc_id % 4 = 0 THEN 'eligibility_missing' WHEN doc_id % 9 = 0 THEN 'lineage_incomplete' ELSE 'eligible' END AS reason FROM r)\n"


@query(_VIEW + "SELECT k.reason, count(v.doc_id) AS n FROM (SELECT unnest(['rejected', 'pending_review', 'license_denied', 'quality_below', 'eligibility_missing', 'lineage_incomplete', 'eligible']) AS reason) k LEFT JOIN v ON v.reason = k.reason GROUP BY 1")
def view_filter_report(spark, sf_dir):
    return views.report(_view_rows(spark, sf_dir), 5)


@query(RECORDS + "SELECT doc_id FROM r WHERE (verification_status = 'approved' OR coalesce(toxic = 0, false)) AND quality_score >= 7")
def production_eligible(spark, sf_dir):
    return _view_rows(spark, sf_dir).where(views.production()).select("doc_id")


@query("SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || CAST(doc_id AS VARCHAR))) <= greatest(1, floor((SELECT count(*) FROM documents) * 0.05)) AS held_out FROM documents")
def holdout_split(spark, sf_dir):
    return views.holdout(table(spark, sf_dir, "documents"), "doc_id", 0.05).select("doc_id", "held_out")


@query("SELECT count(*) AS n, 0::BIGINT AS n_held_out FROM documents")
def holdout_none(spark, sf_dir):
    return views.holdout(table(spark, sf_dir, "documents"), "doc_id", 0.0).agg(F.count("*").alias("n"), F.count_if("held_out").alias("n_held_out"))


@query("SELECT doc_id, source, CASE WHEN row_number() OVER (PARTITION BY source ORDER BY sha256('42:' || CAST(doc_id AS VARCHAR))) <= CASE WHEN count(*) OVER (PARTITION BY source) > 5 THEN greatest(1, round_even(count(*) OVER (PARTITION BY source) * 0.1, 0)) ELSE 1 END THEN 'eval' ELSE 'train' END AS split FROM documents")
def stratified_split(spark, sf_dir):
    return views.stratified(table(spark, sf_dir, "documents"), "doc_id", "source", 0.1).select("doc_id", "source", "split")


@query(RECORDS + ", f AS (SELECT * FROM r WHERE lower(lang) = 'en' AND quality_score >= 4 AND quality_score >= 2), u AS (SELECT min(doc_id) AS doc_id FROM f GROUP BY n_chars) SELECT doc_id, row_number() OVER (ORDER BY sha256('42:' || CAST(doc_id AS VARCHAR))) <= greatest(1, floor((SELECT count(*) FROM u) * 0.1)) AS held_out FROM u")
def recipe_view(spark, sf_dir):
    recipe = views.Recipe(filters=["lang:en", "quality>=4"], unique_by="n_chars", min_score=2, holdout=0.1)
    return views.build(records(spark, sf_dir).withColumn("language", F.col("lang")), recipe, "doc_id").select("doc_id", "held_out")


def _decisions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    names = F.array(*map(F.lit, ("approved", "needs_revision", "rejected", "other")))
    return e.select(F.concat(F.lit("p"), (F.col("user_id") % 20).cast("string"), F.lit("_"), F.col("user_id").cast("string")).alias("record_id"), F.element_at(names, (F.col("event_id") % 4 + 1).cast("int")).alias("decision"), F.col("ts").alias("timestamp"), F.col("event_id").alias("ord"))


_DECISIONS = """WITH d AS (SELECT 'p' || CAST(user_id % 20 AS VARCHAR) || '_' || CAST(user_id AS VARCHAR) AS record_id, ['APPROVE', 'DEFER', 'REJECT', 'PENDING'][event_id % 4 + 1] AS decision, ts AS timestamp, event_id AS ord FROM events),
l AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY timestamp DESC, ord DESC) = 1)
"""


@query(_DECISIONS + "SELECT record_id, decision, timestamp FROM l")
def decisions_latest(spark, sf_dir):
    return resolve.latest_decisions(_decisions(spark, sf_dir)).select("record_id", resolve.decision_name(F.col("decision")).alias("decision"), "timestamp")


@query(
    _DECISIONS
    + """SELECT split_part(record_id, '_', 1) AS packet, count(*) FILTER (decision = 'APPROVE') AS approved_count, count(*) FILTER (decision = 'DEFER') AS deferred_count, count(*) FILTER (decision = 'REJECT') AS rejected_count, count(*) AS reviewed_count, min(timestamp) AS first_timestamp, max(timestamp) AS last_timestamp,
CASE WHEN count(*) FILTER (decision = 'APPROVE') > 0 THEN 'APPROVE' WHEN count(*) FILTER (decision = 'REJECT') > 0 THEN 'REJECT' WHEN count(*) FILTER (decision = 'DEFER') > 0 THEN 'DEFER' ELSE 'PENDING' END AS decision FROM l GROUP BY 1"""
)
def decisions_rollup(spark, sf_dir):
    d = resolve.latest_decisions(_decisions(spark, sf_dir)).withColumns({"decision": resolve.decision_name(F.col("decision")), "packet": F.substring_index("record_id", "_", 1)})
    return resolve.rollup_decisions(d, "packet")


@query(_DECISIONS + "SELECT split_part(record_id, '_', 1) AS packet, decision, count(*) AS n FROM l GROUP BY ROLLUP (1, 2)")
def decision_counts(spark, sf_dir):
    d = resolve.latest_decisions(_decisions(spark, sf_dir)).withColumns({"decision": resolve.decision_name(F.col("decision")), "packet": F.substring_index("record_id", "_", 1)})
    return d.rollup("packet", "decision").agg(F.count("*").alias("n"))


@query("SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'review_cache' WHEN doc_id % 3 = 0 THEN 'curated' ELSE 'archive' END AS tier FROM documents")
def resolve_layers(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "source", F.col("n_chars").alias("ord"))
    return resolve.resolve({"review_cache": d.where("doc_id % 7 = 0"), "curated": d.where("doc_id % 3 = 0"), "archive": d}, "doc_id", "ord").select("doc_id", "tier")


@query(
    """SELECT s_suppkey AS packet_id, CASE WHEN s_suppkey % 5 = 0 THEN 'blocked' WHEN s_suppkey % 3 = 0 THEN 'skipped_decision' WHEN s_nationkey > 20 THEN 'missing_in_registry' WHEN s_nationkey % 2 = 1 THEN 'skipped_status' ELSE 'planned' END AS route FROM supplier"""
)
def acquisition_routing(spark, sf_dir):
    p = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("packet_id"), F.col("s_nationkey").alias("source_id"))
    d = p.where("packet_id % 5 <> 0").select("packet_id", F.when(F.col("packet_id") % 3 == 0, "REJECT").otherwise("APPROVE").alias("decision"))
    r = table(spark, sf_dir, "nation").where("n_nationkey <= 20").select(F.col("n_nationkey").alias("id"), F.when(F.col("n_nationkey") % 2 == 0, "active").otherwise("retired").alias("status"))
    return resolve.route(p, d, r).select("packet_id", "route")


def _lifecycle(spark, sf_dir):
    names = F.array(*map(F.lit, LIFECYCLE_STATES))
    return table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts", "event_id", F.element_at(names, (F.col("event_id") % 8 + 1).cast("int")).alias("state"))


_ALLOWED = "[" + ", ".join(f"'{a}>{b}'" for a, bs in TRANSITIONS.items() for b in bs) + "]"


@query(
    f"""WITH e AS (SELECT event_id, {LIFECYCLE_STATES}[event_id % 8 + 1] AS state, user_id AS id, ts FROM events), p AS (SELECT *, lag(state) OVER (PARTITION BY id ORDER BY ts, event_id) AS previous FROM e)
SELECT coalesce(CASE WHEN previous IS NOT NULL AND NOT list_contains({_ALLOWED}, previous || '>' || state) THEN 'invalid_transition' END, 'ok') AS problem, count(*) AS n FROM p GROUP BY 1"""
)
def lifecycle_validate(spark, sf_dir):
    checked = resolve.check_transitions(_lifecycle(spark, sf_dir), "id", ["ts", "event_id"])
    return checked.groupBy(F.coalesce("problem", F.lit("ok")).alias("problem")).agg(F.count("*").alias("n"))


@query(f"WITH e AS (SELECT {LIFECYCLE_STATES}[event_id % 8 + 1] AS state, user_id AS id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1) SELECT s AS state, count(id) AS n FROM (SELECT unnest({LIFECYCLE_STATES}) AS s) LEFT JOIN e ON s = state GROUP BY 1")
def lifecycle_summary(spark, sf_dir):
    now = _lifecycle(spark, sf_dir).groupBy("id").agg(F.max_by("state", F.struct("ts", "event_id")).alias("state"))
    return resolve.state_summary(now)


_PROV = rf"""WITH d AS (SELECT doc_id, text AS t, {_WORDS} AS n, regexp_replace(text, '^[ \t\r\n\f\x0B]+|[ \t\r\n\f\x0B]+$', '', 'g') AS s, len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '^[ \t\r\f\x0B]*(?:[-*] |[0-9]+\.[ \t])'))) >= 2 AS listed,
len(list_intersect(list_distinct(regexp_extract_all(lower(text), '[a-z0-9_-]+')), {resolve.TECHNICAL})) >= 2 AS tech FROM documents)
SELECT doc_id, CASE WHEN s = '' THEN 'unknown' WHEN n <= 30 THEN 'condensed' WHEN listed THEN 'condensed' WHEN regexp_matches(s, '(?s)^\p{{Lu}}.*[.!?]$') AND tech THEN 'verbatim' ELSE 'rephrased' END AS label,
round_even(CAST(CASE WHEN s = '' THEN 0 WHEN n <= 30 THEN least(0.85, 0.6 + 0.01 * n) WHEN listed THEN 0.7 WHEN regexp_matches(s, '(?s)^\p{{Lu}}.*[.!?]$') AND tech THEN 0.65 ELSE 0.5 END AS DOUBLE), 4) AS confidence FROM d"""


@query(_PROV)
def provenance_classify(spark, sf_dir):
    p = resolve.provenance(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", p["label"].alias("label"), F.bround(p["confidence"], 4).alias("confidence"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey % 4 <> 0")
def incremental_pending(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return resolve.pending(o, o.where("o_orderkey % 4 = 0"), "o_orderkey", "o_orderstatus").select("o_orderkey")


# --- extraction ----------------------------------------------------------------------------------------------------


@query("SELECT count(*) AS n, coalesce(sum(n_chars), 0) AS bytes FROM documents WHERE doc_id IN (SELECT max(doc_id) FROM documents GROUP BY source)")
def cache_stats(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("source").alias("source_ref"), F.col("doc_id").alias("fetched_at"), F.col("n_chars").alias("size_bytes"))
    return readers.cache_stats(readers.cache_index(d))


@query("SELECT conv_id, training_type FROM (SELECT conv_id, unnest(['conversation']) AS training_type, count(*) FILTER (text <> '') AS n FROM conversations GROUP BY 1) WHERE n >= 2 UNION ALL SELECT doc_id + 1000000, 'knowledge' FROM documents")
def transform_fan_out(spark, sf_dir):
    conv = _conversations(spark, sf_dir).select(F.col("conv_id").alias("id"), F.to_json(F.struct("messages")).alias("payload"), F.lit(None).cast("string").alias("license"))
    docs = table(spark, sf_dir, "documents").select((F.col("doc_id") + 1_000_000).alias("id"), F.to_json(F.struct("text")).alias("payload"), F.lit("mit").alias("license"))
    return C.fan_out(etl.normalize(conv.unionByName(docs))).select(F.col("id").alias("conv_id"), "training_type")


# --- extensions ----------------------------------------------------------------------------------------------------


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round_even(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def ext_window_counts(spark, sf_dir):
    return E.tumbling_counts(table(spark, sf_dir, "events")).withColumn("total", F.bround("total", 4))


@query(
    """WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 30 MINUTE AS "end", count(*) AS n FROM s GROUP BY user_id, k"""
)
def ext_sessions(spark, sf_dir):
    return E.sessions(table(spark, sf_dir, "events"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, round_even(sum(l_quantity), 2) AS qty FROM lineitem GROUP BY CUBE (1, 2)")
def ext_cube(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.bround(F.sum("l_quantity"), 2).alias("qty"))


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)")
def ext_anti_join(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")

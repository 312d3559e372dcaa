"""N-gram Jaccard self-join with adaptive multi-match prefixes.

Each text is the set of its distinct word shingles. All sets are put in one global order, shared shingles last. A pair
with |A n B| >= t shares at least l shingles in the prefixes of length |A| - t + l and |B| - t + l, for every l. Each
document picks its own l from the candidates that its prefix would cost, as estimated from the document frequencies of
the shingles in it: where the prefix has frequent shingles, a longer prefix with more required matches is cheaper. A pair
is held to the smaller l of its two documents.

Links are found in rounds, so that large groups of near copies never give all their pairs: first every member of a posting
list is held against one member, another one in each round; then only pairs that these rounds left in different components
are, with the required number of matches. No pair above the threshold between different components is skipped, so the
components are exact. Shingles are 64-bit fingerprints; documents with equal sets are told by a 128-bit one.

Cases: null or empty text, or text of white space only, has an empty set, is linked with nothing and is its own
component. Rows with a null id are returned with a null component. Rows that repeat an id are one node of the graph, with
the links of all their texts; if these differ, rows are joined under numbers of their own and their components united.
Other columns are ignored, whatever their names; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.components import connected
from quern.llm.shared import buffer_of, drop, longs, text_chunks, written
from quern.llm.shingles import shingle_sets

#: Shingles whose frequency is known to every task, the most frequent first; beyond them the order is by fingerprint.
FREQUENT = 1 << 16
#: Rounds in which each posting list's members are held against one of them, before all pairs that are left.
ROUNDS = 2
#: Largest required number of matches.
MOST_MATCHES = 4
#: Bytes of document ids that may be broadcast for fetching the sets of candidates; beyond it they are joined.
BROADCAST_IDS = 8 << 20
#: Bytes of text in which shingles are counted together before the counts are added up.
_WINDOW = 8 << 20


def _describe(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()  # copies within a task do not make a shingle frequent
        size = 0

        def counts() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            often = n >= 2
            values, n = values[often].view(np.int64), n[often]
            none = np.zeros(len(n), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(none, pa.int32()), pa.array(values), pa.array(n), pa.array(none), pa.array(none)], names=["kind", "a", "n", "hi", "lo"])

        for batch in text_chunks(batches):
            data, off = buffer_of(batch.column(1))
            n, hi, lo = [], [], []
            for found in shingle_sets(data, off, words):
                n.append(len(found))
                h = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                hi.append(int.from_bytes(h[:8], "little", signed=True))
                lo.append(int.from_bytes(h[8:], "little", signed=True))
                if h not in seen:
                    seen.add(h)
                    held.append(found)
            size += len(data)
            yield pa.RecordBatch.from_arrays([pa.array([1] * len(n), pa.int32()), batch.column(0), pa.array(n, pa.int64()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], names=["kind", "a", "n", "hi", "lo"])
            if size >= _WINDOW and held:
                yield counts()
                held, size = [], 0
        if held:
            yield counts()

    return run


def _ordered(found: np.ndarray, df: np.ndarray, percent: int, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The prefix of a set in the global order, the least l at which each of its shingles counts, and the l chosen."""
    n = len(found)
    short = n - (percent * n + 99) // 100
    order = np.argsort(df, kind="stable")[: short + most]  # found ascends
    cost = np.cumsum(df[order])
    # Each candidate is met at least l times, so the matches divided by l bound the candidates that must be verified.
    ells = np.arange(1, min(most, n - short) + 1)
    met = cost[short + ells - 1].astype(np.float64)
    chosen = int(ells[np.argmin(met + short + ells + met / ells * (2.0 + n / 64))])
    prefix = order[: short + chosen]
    return prefix, np.maximum(1, np.arange(len(prefix)) - short + 1), chosen


def _postings(words: int, percent: int, frequent, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = frequent.value
        seen: set[bytes] = set()
        for batch in text_chunks(batches):
            data, off = buffer_of(batch.column(1))
            ids, null = longs(batch.column(0))
            out: list[tuple] = []
            for k, found in enumerate(shingle_sets(data, off, words)):
                if null[k] or not len(found):
                    continue
                same = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                if same in seen:  # documents with equal sets are linked through their fingerprint
                    continue
                seen.add(same)
                at = np.minimum(np.searchsorted(known, found), max(0, len(known) - 1))
                df = np.where(known[at] == found, often[at], 0) if len(known) else np.zeros(len(found), np.int64)
                prefix, level, ell = _ordered(found, df, percent, most)
                last = prefix[-1]  # where the prefix ends in the global order, as a row of its own
                tokens = np.append(found[prefix].view(np.int64), (found[last : last + 1] ^ np.uint64(1 << 63)).view(np.int64))
                out.append((tokens, np.full(len(tokens), ids[k]), np.append((np.int64(len(found)) << 8) | (ell << 4) | level, -1 - df[last])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["token", "doc", "meta"])

    return run


def _sets(words: int, wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only = None if wanted is None else wanted.value
        for batch in text_chunks(batches):
            if only is not None:
                ids, null = longs(batch.column(0))
                at = np.minimum(np.searchsorted(only, ids), len(only) - 1)
                batch = batch.filter(pa.array((only[at] == ids) & ~null))
                if not batch.num_rows:
                    continue
            data, off = buffer_of(batch.column(1))
            sets = [s.tobytes() for s in shingle_sets(data, off, words)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.binary())], names=["doc", "found"])

    return run


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                n = len(a) + len(b)
                both = np.sort(np.concatenate((a, b)))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(100 * same >= percent * (n - same))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _links(docs: DataFrame, pairs: DataFrame, words: int, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Those of the pairs (a, b) that reach the threshold, and the tables to drop once they are read."""
    spark = docs.sparkSession
    pairs = written(pairs, "pairs")
    ids = written(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), "ids")
    n = ids.count()
    if not n:
        return pairs, [pairs, ids]
    if n * 8 <= BROADCAST_IDS:
        wanted = spark.sparkContext.broadcast(np.sort(ids.toPandas()["id"].to_numpy(np.int64)))
    else:
        wanted, docs = None, docs.join(ids, docs.id == ids.id, "left_semi")
    sets = docs.dropDuplicates(["id"]) if wanted is None else docs
    sets = written(sets.mapInArrow(_sets(words, wanted), "doc long, found binary").dropDuplicates(["doc"]), "sets")
    right = pairs.join(sets, F.col("b") == F.col("doc")).select("a", "b", F.col("found").alias("y"))
    both = right.join(sets, F.col("a") == F.col("doc")).select("a", "b", F.col("found").alias("x"), "y")
    return both.mapInArrow(_verified(percent), "a long, b long"), [pairs, ids, sets]


def _frequent(counts: DataFrame, most: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `most` of the shingles (a) with the largest sums of n, in ascending order, and their sums.

    A histogram of the sums, by powers of 2^(1/8), gives the sum from which they fit, so no more than these reach the driver.
    """
    sums = written(counts.groupBy("a").agg(F.sum("n").alias("n")), "shingles")
    level = F.floor(F.log2("n") * 8).cast("int")
    room, least = most, 1 << 30
    for at, n in sums.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect():
        if n > room:
            break
        room, least = room - n, at
    top = sums.where(level >= least).toPandas()
    drop(sums)
    known = top["a"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(known)
    return known[order], top["n"].to_numpy(np.int64)[order]


def _needed(percent: int, n: str, ell: str, other_n: str) -> Column:
    """How many shingles a set of n, whose prefix ends first in the global order, must share with another within the prefixes.

    None of its prefix's shingles that is not shared there is in the other set at all, so the whole overlap is at most n
    less those.
    """
    overlap = F.expr(f"({percent} * ({n} + {other_n}) + {99 + percent}) div {100 + percent}")
    return F.greatest(F.lit(1), overlap - F.expr(f"({percent} * {n} + 99) div 100 - {ell}"))


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80, most_matches: int = MOST_MATCHES) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id (the smallest id reachable over links of Jaccard >= percent / 100)."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    described = written(docs.mapInArrow(_describe(words), "kind int, a long, n long, hi long, lo long"), "facts")
    frequent = spark.sparkContext.broadcast(_frequent(described.where("kind = 0"), FREQUENT))

    own = described.where("kind = 1").select(F.col("a").alias("doc_id"), F.col("n").alias("n_shingles"), "hi", "lo")
    filled = own.where("n_shingles > 0 and doc_id is not null")
    sets = filled.groupBy("doc_id").agg(F.min(F.struct("hi", "lo")).alias("x"), F.max(F.struct("hi", "lo")).alias("y"))
    if not sets.where("x <> y").isEmpty():
        return _by_rows(docs, own, words, percent, most_matches)
    first = filled.groupBy("hi", "lo").agg(F.min("doc_id").alias("first"))
    copies = filled.join(first, ["hi", "lo"]).where("doc_id <> first").select(F.col("doc_id").alias("a"), F.col("first").alias("b")).distinct()
    groups = connected(copies)

    postings = docs.mapInArrow(_postings(words, percent, frequent, most_matches), "token long, doc long, meta long")
    by = Window.partitionBy("token")
    listed = postings.withColumn("m", F.count_if(F.col("meta") >= 0).over(by)).where("m > 1 OR meta < 0")
    held = listed = written(listed, "listed")
    # Of each document: how many shingles of its prefix another prefix has too, and where its prefix ends.
    facts = listed.groupBy("doc").agg(F.count_if(F.col("meta") >= 0).alias("met"), F.max(F.when(F.col("meta") < 0, F.struct((-1 - F.col("meta")).alias("df"), F.col("token").alias("at")))).alias("end"))
    left = listed.where("meta >= 0").select("token", "doc", F.shiftright("meta", 8).alias("n"), F.shiftright("meta", 4).bitwiseAND(F.lit(15)).alias("ell"), "m").join(facts, "doc")
    # A document that must share `needed` of its `met` shingles shares one of the met - needed + 1 with the shortest lists.
    left = left.withColumn("rank", F.row_number().over(Window.partitionBy("doc").orderBy("m", "token"))).drop("m")

    for k in range(ROUNDS + 1):
        placed = left.drop("group").join(groups, F.col("doc") == F.col("id"), "left").withColumn("group", F.coalesce("component", "doc")).drop("id", "component")
        mixed = placed.withColumn("least", F.min("group").over(by)).withColumn("largest", F.max("group").over(by)).where("least <> largest").drop("least", "largest")
        if k < ROUNDS:
            # Another member is held against all others in each round; at first the one with the fewest shingles of its own.
            own_shingles = F.expr(f"n - ({percent} * n + 99) div 100 + ell - met")
            order = own_shingles if k == 0 else F.xxhash64("doc", F.lit(k))
            mixed = mixed.withColumn("head", F.min(F.struct(order.cast("long").alias("order"), "doc", "n", "ell", "group", "met", "end")).over(by))
        mixed = written(mixed, "mixed")
        drop(held)
        held = mixed
        if k == ROUNDS:
            break
        near = mixed.where(f"group <> head.group and 100 * least(n, head.n) >= {percent} * greatest(n, head.n)")
        near = near.where(F.when(F.col("end") <= F.col("head.end"), F.col("met") >= _needed(percent, "n", "ell", "head.n")).otherwise(F.col("head.met") >= _needed(percent, "head.n", "head.ell", "n")))
        near = near.groupBy("doc", F.col("head.doc").alias("to")).agg(F.count("*").alias("m"), F.first(F.when(F.col("end") <= F.col("head.end"), _needed(percent, "n", "ell", "head.n")).otherwise(_needed(percent, "head.n", "head.ell", "n"))).alias("needed"))
        near = near.where("m >= needed").select(F.greatest("doc", "to").alias("a"), F.least("doc", "to").alias("b")).distinct()
        links, used = _links(docs, near, words, percent)
        before, left = groups, mixed.drop("head")
        groups = connected(links.unionByName(groups.select(F.col("id").alias("a"), F.col("component").alias("b"))))
        drop(before, *used)
    x, y = mixed.alias("x"), mixed.alias("y")
    sized = (100 * F.col("x.n") >= percent * F.col("y.n")) & (100 * F.col("y.n") >= percent * F.col("x.n"))
    # x is the one whose prefix ends first, so what it must share is known. Both rank their shingles by the length of the
    # lists, so the shared one with the shortest list has a low rank in both; only such shingles probe and are probed.
    needed = _needed(percent, "x.n", "x.ell", "y.n")
    first_end = (F.col("x.end") < F.col("y.end")) | ((F.col("x.end") == F.col("y.end")) & (F.col("x.doc") > F.col("y.doc")))
    far = x.join(y, (F.col("x.token") == F.col("y.token")) & first_end & (F.col("x.group") != F.col("y.group")) & sized & (F.col("x.rank") <= F.col("x.met") - needed + 1) & (F.col("y.rank") <= F.col("y.met") - needed + 1))
    far = far.select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), needed.alias("needed")).distinct()
    prefixes = mixed.groupBy("doc").agg(F.collect_list("token").alias("tokens"))  # at most a prefix for each document
    both = far.join(prefixes.select(F.col("doc").alias("a"), F.col("tokens").alias("ta")), "a").join(prefixes.select(F.col("doc").alias("b"), F.col("tokens").alias("tb")), "b")
    far = both.where(F.size(F.array_intersect("ta", "tb")) >= F.col("needed")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    more, used = _links(docs, far, words, percent)
    reps = groups.withColumnsRenamed({"id": "doc", "component": "to"})
    more = more.join(reps, F.col("a") == F.col("doc"), "left").select(F.coalesce("to", "a").alias("a"), "b")
    more = more.join(reps, F.col("b") == F.col("doc"), "left").select("a", F.coalesce("to", "b").alias("b"))
    joined = connected(more).withColumnsRenamed({"id": "group", "component": "lowest"})
    drop(mixed, *used)
    final = groups.join(joined, F.col("component") == F.col("group"), "full_outer").select(F.coalesce("id", "group").alias("id"), F.coalesce("lowest", "component").alias("component"))
    return own.join(final, F.col("doc_id") == F.col("id"), "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _by_rows(docs: DataFrame, own: DataFrame, words: int, percent: int, most_matches: int) -> DataFrame:
    """The components where an id has different texts: of rows first, which are then united by id."""
    rows = written(docs.where("id is not null").withColumn("node", F.monotonically_increasing_id()), "rows")
    found = ngram_components(rows, "node", "text", words, percent, most_matches)
    placed = written(rows.select("node", "id").join(found, F.col("node") == F.col("doc_id")).select("id", "n_shingles", "component_id"), "nodes")
    least = placed.groupBy(F.col("id").alias("i")).agg(F.min("component_id").alias("m"))
    united = connected(placed.join(least, F.col("id") == F.col("i")).select(F.col("component_id").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
    united = united.withColumnsRenamed({"id": "u", "component": "whole"})
    placed = placed.join(united, F.col("component_id") == F.col("u"), "left").select("id", "n_shingles", F.coalesce("whole", "component_id").alias("part"))
    lowest = placed.groupBy(F.col("part").alias("p")).agg(F.min("id").alias("lowest"))
    named = placed.join(lowest, F.col("part") == F.col("p")).select(F.col("id").alias("doc_id"), "n_shingles", F.col("lowest").alias("component_id"))
    return named.unionByName(own.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component_id")))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component, that of the smallest id, with all columns; rows with a null id all stay.

    Of rows that repeat the smallest id, that with the least digest of the text stays.
    """
    found = ngram_components(docs, id_col, text_col, words, percent).where("doc_id is not null")
    ids = written(found.groupBy("doc_id").agg(F.min("component_id").alias("lowest"), F.count("*").alias("rows")).where("doc_id <> lowest or rows > 1"), "losers")
    whole = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("whole"), F.col(id_col).cast("long").alias("own"))
    rows = whole.join(ids, F.col("own") == F.col("doc_id"), "left").where("lowest is null or doc_id = lowest")
    one = Window.partitionBy("own").orderBy(F.md5(F.coalesce(F.col("whole").getField(text_col).cast("string"), F.lit(""))))
    repeated = rows.where("rows > 1").withColumn("k", F.row_number().over(one)).where("k = 1").select("whole")
    kept = rows.where("rows is null").select("whole").unionByName(repeated)
    return kept.select(*(F.col("whole").getField(c).alias(c) for c in docs.columns))


def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    from quern.llm.shared import table

    return ngram_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS a FROM documents)),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, x || ' ' || lead(x) OVER p || ' ' || lead(x, 2) OVER p || ' ' || lead(x, 3) OVER p || ' ' || lead(x, 4) OVER p AS g FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY i)) WHERE g IS NOT NULL
  UNION ALL SELECT doc_id, string_agg(x, ' ' ORDER BY i) FROM w GROUP BY 1 HAVING count(*) < 5),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT doc_id, n, min(doc_id) OVER (PARTITION BY h) AS rep FROM (SELECT doc_id, count(*) AS n, md5(string_agg(g, ',' ORDER BY g)) AS h FROM s GROUP BY 1)),
r AS (SELECT doc_id, n, g FROM k JOIN s USING (doc_id) WHERE doc_id = rep),
l AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, any_value(x.n) + any_value(y.n) AS t, count(*) AS m FROM r x JOIN r y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY 1, 2) WHERE 100 * m >= 80 * (t - m) UNION ALL SELECT rep, doc_id FROM k WHERE rep <> doc_id),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach(id, other) AS (SELECT a, b FROM e UNION SELECT reach.id, e.b FROM reach JOIN e ON reach.other = e.a),
m AS (SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN m ON id = d.doc_id
"""

"""Exact and near-duplicate removal: digests, MinHash bands with exact verification, clusters, survivors.

Shingle sets, their digests and their band keys come from one pass over the texts in Arrow batches. Sets are written
once and read again only for candidates.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BANDS, ROWS = 32, 4
THRESHOLD = 0.8
#: Bytes of text worked on at once; a longer text is worked on alone.
CHUNK_BYTES = 1 << 20
_TOKEN = np.zeros(256, bool)
_TOKEN[48:58] = _TOKEN[97:123] = True
_STEP = 0x9E3779B97F4A7C15
_ODD = np.random.default_rng(7).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def exact_groups(docs: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """digest, n and the first id of each group of two or more rows."""
    return docs.groupBy(F.sha1(key).alias("digest")).agg(F.count("*").alias("n"), F.min(id_col).alias("first_id")).where("n > 1")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str | None], k: int) -> Iterator[np.ndarray]:
    """Of each text the sorted distinct hashes of its k-grams of tokens (runs of ASCII letters and digits, lower-cased).

    Fewer tokens give one short gram, none give an empty set. Tokens are hashed by differences of a running polynomial,
    so no token is cut out of the text.
    """
    parts = [(t or "").lower().encode() for t in texts]
    data = np.frombuffer(b" ".join([*parts, b""]), np.uint8)
    off = np.cumsum([0, *(len(x) + 1 for x in parts)])
    inside = np.concatenate(([False], _TOKEN[data], [False]))
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    up = np.full(len(data) + 1, _STEP, np.uint64)
    down = np.full(len(data) + 1, pow(_STEP, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    up, down = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(_ODD[data] * up[:-1], dtype=np.uint64)))
    codes = _mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    at = np.searchsorted(starts, off)
    grams = np.zeros(max(0, len(codes) - k + 1), np.uint64)
    for j in range(k):
        grams = grams * np.uint64(_STEP) + codes[j : j + len(grams)]
    grams = _mixed(grams)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(grams[a : b - k + 1])
        elif b > a:
            yield np.frombuffer(hashlib.blake2b(codes[a:b].tobytes(), digest_size=8).digest(), np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def _band_keys(found: np.ndarray, odd: np.ndarray, add: np.ndarray, rows: int) -> np.ndarray:
    """For each band a hash of the least values of `rows` independent hash functions over the set."""
    least = np.full(len(odd), np.iinfo(np.uint64).max)
    for k in range(0, len(found), 4096):  # bounded memory for very long texts
        y = found[k : k + 4096, None] * odd + add
        least = np.minimum(least, (y ^ (y >> np.uint64(31))).min(0))
    h = np.zeros(len(odd) // rows, np.uint64)
    for r in range(rows):
        h = (h ^ least[r::rows]) * np.uint64(_STEP)
    return h


def _described(k: int, bands: int, rows: int):
    rnd = np.random.default_rng(1)
    odd, add = (rnd.integers(0, 2**63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.cumsum([len(t) if t else 0 for t in batch.column(1).to_pylist()])
            cuts = [0, *(np.flatnonzero(np.diff(sizes // CHUNK_BYTES)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts, cuts[1:], strict=False):
                sets = list(shingle_sets(batch.column(1).slice(a, b - a).to_pylist(), k))
                digest = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() for x in sets]
                keys = [_band_keys(x, odd, add, rows).view(np.int64) if len(x) else [] for x in sets]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([len(x) for x in sets], pa.int64()), pa.array(digest), pa.array([x.tobytes() for x in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["id", "n", "digest", "found", "keys"])

    return run


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 4, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, n, digest, found, keys) of every row, as a written table: size, digest and hashes of the shingle set, and band keys."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return _written(docs.mapInArrow(_described(k, bands, rows), f"id {dict(docs.dtypes)['id']}, n long, digest binary, found binary, keys array<long>"), "sets")


def _representatives(sets: DataFrame) -> DataFrame:
    """digest and rep, the smallest id with that set: copies are linked through it and never compared."""
    return sets.where("n > 0").groupBy("digest").agg(F.min("id").alias("rep"))


def _jaccard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            a, b = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            same = len(np.intersect1d(a, b, assume_unique=True))
            out.append(same / (len(a) + len(b) - same))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.float64())], names=["a", "b", "jaccard"])


def _verified(sets: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b, jaccard) of the pairs (a, b), a written table, that reach the threshold; sets are read for their ids alone."""
    right = pairs.join(sets.select(F.col("id").alias("b"), F.col("found").alias("y")), "b")
    both = right.join(sets.select(F.col("id").alias("a"), F.col("found").alias("x")), "a").select("a", "b", "x", "y")
    kind = dict(pairs.dtypes)["a"]
    return both.mapInArrow(_jaccard, f"a {kind}, b {kind}, jaccard double").where(F.col("jaccard") >= threshold)


def _buckets(sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(each set's smallest id with its set; (id, band, h) of these)."""
    reps = sets.join(_representatives(sets).select(F.col("rep").alias("id")), "id", "left_semi").where("n > 0")
    return reps, reps.select("id", F.posexplode("keys").alias("band", "h"))


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(a, b, jaccard) of rows with different shingle sets, a < b, by banding and exact verification; each set's smallest id stands for its copies.

    All pairs of a group of near copies are asked for here; use near_links() where the groups are enough.
    """
    reps, keys = _buckets(described(docs, id_col, text_col, bands=bands, rows=rows))
    x, y = keys.alias("x"), keys.alias("y")
    cand = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h")) & (F.col("x.id") < F.col("y.id"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    return _verified(reps, _written(cand.distinct(), "pairs"), threshold)


def near_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """(id, cluster) of the same groups as those of all near pairs and copies, without all their pairs.

    Every member of a bucket is first held against one of it; then only pairs that are still in different groups are.
    """
    sets = described(docs, id_col, text_col, bands=bands, rows=rows)
    copies = sets.join(_representatives(sets), "digest").where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    reps, keys = _buckets(sets)
    heads = keys.groupBy("band", "h").agg(F.min("id").alias("a"), F.count("*").alias("m")).where("m > 1")
    keys = _written(keys.join(heads.drop("m"), ["band", "h"]), "buckets")  # buckets of one are gone
    first = _written(keys.where("a <> id").select("a", F.col("id").alias("b")).distinct(), "pairs")
    groups = clusters(_verified(reps, first, threshold).select("a", "b"))
    placed = keys.select("id", "band", "h").join(groups.withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left").select("id", "band", "h", F.coalesce("cluster", "id").alias("g"))
    mixed = placed.groupBy("band", "h").agg(F.min("g").alias("g0"), F.max("g").alias("g1")).where("g0 <> g1").select("band", "h")
    rest = _written(placed.join(mixed, ["band", "h"], "left_semi"), "mixed")
    x, y = rest.alias("x"), rest.alias("y")
    far = x.join(y, (F.col("x.band") == F.col("y.band")) & (F.col("x.h") == F.col("y.h")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.g") != F.col("y.g"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
    last = _written(far.distinct(), "pairs")
    more = _verified(reps, last, threshold).select("a", "b")
    found = clusters(groups.select(F.col("cluster").alias("a"), F.col("id").alias("b")).where("a <> b").unionByName(more).unionByName(copies))
    _drop(sets, keys, first, rest, last)  # the groups are a checkpoint and read none of them
    return found


def _shared(spark) -> str:
    """The folder that all executors share; a local session may do without the setting."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quern-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(found)
    return found.rstrip("/")


def _written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: unlike a checkpoint, it is read by column."""
    path = f"{_shared(df.sparkSession)}/quern-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def _drop(*tables: DataFrame) -> None:
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def clusters(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(id, cluster) of the ids in links(a, b): the smallest id reachable, by label spreading with pointer jumping.

    Each round is checkpointed in the shared folder, so a lost executor costs one round at most.
    """
    _shared(links.sparkSession)
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint()
    label = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")).checkpoint()
    for _ in range(most_rounds):
        near = edges.join(label.withColumnsRenamed({"a": "b", "c": "cb"}), "b").groupBy("a").agg(F.min("cb").alias("m"))
        low = label.join(near, "a").select("a", F.least("c", "m").alias("c"))
        jump = low.join(low.select(F.col("a").alias("c"), F.col("c").alias("cc")), "c", "left").select("a", F.least("c", F.coalesce("cc", "c")).alias("n"))
        after = label.join(jump, "a").select("a", "n", (F.col("c") != F.col("n")).alias("moved")).checkpoint()
        label = after.select("a", F.col("n").alias("c"))
        if after.where("moved").isEmpty():
            return label.select(F.col("a").alias("id"), F.col("c").alias("cluster"))
    raise RuntimeError(f"no fixed point after {most_rounds} rounds")


def survivors(docs: DataFrame, groups: DataFrame, score: Column, length: Column, id_col: str = "doc_id") -> DataFrame:
    """docs with cluster and kept: of each cluster the row of the largest (score, length) stays, the first on ties."""
    groups = groups.select(F.col("id").alias("_id"), "cluster")
    joined = docs.join(groups, docs[id_col] == groups["_id"], "left").withColumn("cluster", F.coalesce("cluster", F.col(id_col))).drop("_id")
    ranked = joined.withColumn("_r", F.struct((-score).alias("s"), (-length).alias("l"), F.col(id_col).alias("i")))
    best = ranked.groupBy("cluster").agg(F.min("_r").alias("_best"))
    return ranked.join(best, "cluster").withColumn("kept", F.col(id_col) == F.col("_best.i")).drop("_r", "_best")


def first_seen(docs: DataFrame, key: Column, id_col: str = "doc_id") -> DataFrame:
    """The first row of each key, by id."""
    keyed = docs.withColumn("_k", key)
    first = keyed.groupBy("_k").agg(F.min(id_col).alias("_first"))
    return keyed.join(first.drop("_k"), keyed[id_col] == first["_first"], "left_semi").drop("_k")


def latest_per_key(rows: DataFrame, key: str, *order: str) -> DataFrame:
    """Of each key the row that comes last in `order`."""
    w = Window.partitionBy(key).orderBy(*(F.desc(c) for c in order))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

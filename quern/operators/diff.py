"""Differences between two versions of a keyed table, semantic impact, checksums and hash chains."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.schema import STATUS_RANK

GENESIS = "0" * 64


def compare(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """One row a key: change (added, removed, changed, unchanged), the fields changed, and both versions as structs."""
    a = old.select(F.col(key).alias("_a"), F.struct(*fields).alias("old"))
    b = new.select(F.col(key).alias("_b"), F.struct(*fields).alias("new"))
    both = a.join(b, F.col("_a") == F.col("_b"), "full_outer")
    fields_changed = F.array_compact(F.array(*(F.when(~F.col(f"old.{f}").eqNullSafe(F.col(f"new.{f}")), F.lit(f)) for f in fields)))
    change = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.size(fields_changed) > 0, "changed").otherwise("unchanged")
    return both.select(F.coalesce("_a", "_b").alias(key), change.alias("change"), F.when(change == "changed", fields_changed).alias("fields"), "old", "new")


def summary(compared: DataFrame) -> DataFrame:
    n = lambda k: F.count_if(F.col("change") == k).alias(k)
    return compared.agg(n("added"), n("removed"), n("changed"), n("unchanged"))


def field_changes(compared: DataFrame) -> DataFrame:
    return compared.where("change = 'changed'").select(F.explode("fields").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


def group_delta(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """(key, from_n, to_n, delta) of the counts by key."""
    a = old.groupBy(F.col(key).alias("key")).agg(F.count("*").alias("from_n"))
    b = new.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("to_n"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    return a.join(b, F.col("key").eqNullSafe(F.col("k")), "full_outer").select(F.coalesce("key", "k").alias("key"), zero("from_n").alias("from_n"), zero("to_n").alias("to_n"), (zero("to_n") - zero("from_n")).alias("delta"))


def status_rank(c: Column) -> Column:
    ranks = F.create_map(*(F.lit(x) for kv in STATUS_RANK.items() for x in kv))
    return F.coalesce(F.element_at(ranks, c), F.lit(0))


def semantic(compared: DataFrame, old: DataFrame, new: DataFrame, score: str, status: str, category: str) -> DataFrame:
    """One row: totals, churn, stability, drops of over 1 in score, status regressions, vanished categories and fields, breaking or not.

    `compared` must carry score and status among its fields.
    """
    common = F.col("change").isin("changed", "unchanged")
    drop = common & (F.col(f"new.{score}") < F.col(f"old.{score}") - 1)
    worse = common & (status_rank(F.col(f"new.{status}")) < status_rank(F.col(f"old.{status}")))
    one = compared.agg(
        F.count_if(F.col("change") != "added").alias("from_total"),
        F.count_if(F.col("change") != "removed").alias("to_total"),
        F.count_if(F.col("change") == "changed").alias("changed"),
        F.count_if(common).alias("common"),
        F.count_if(drop).alias("degraded"),
        F.count_if(worse).alias("regressed"),
    )
    gone = group_delta(old, new, category).where("to_n = 0").agg(F.count("*").alias("categories_removed"))
    removed = sorted(set(old.columns) - set(new.columns))
    most = F.greatest("from_total", "to_total")
    out = one.crossJoin(gone)  # two single rows
    return out.select(
        "*",
        F.lit(len(removed)).alias("fields_removed"),
        (F.col("from_total") + F.col("to_total") - 2 * F.col("common")).alias("churn"),
        F.when((F.col("from_total") > 0) & (F.col("to_total") > 0), F.bround((F.col("common") - F.col("changed")) / most, 4)).otherwise(1.0).alias("stability"),
        (F.col("degraded") > 0.1 * F.col("common")).alias("degradation_warning"),
        ((F.col("categories_removed") > 0) | F.lit(bool(removed))).alias("breaking"),
    )


def row_digest(*cols: str) -> Column:
    """SHA-256 of the row as JSON with its keys in order."""
    return F.sha2(F.to_json(F.struct(*sorted(cols))), 256)


def table_digest(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: n and a digest that does not depend on the order of rows.

    Row digests are added up in two limbs, so no task ever holds more than a sum, and repeated rows count.
    """
    h = row_digest(*cols)
    limb = lambda i: F.sum(F.conv(F.substring(h, i, 15), 16, 10).cast("decimal(38,0)"))
    return df.agg(F.count("*").alias("n"), limb(1).alias("x"), limb(17).alias("y")).select("n", F.sha2(F.concat_ws(":", F.col("n").cast("string"), F.col("x").cast("string"), F.col("y").cast("string")), 256).alias("digest"))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def chain_entries(log: DataFrame, seq: str, content: Column) -> DataFrame:
    """Digest of each entry over its own content and sequence number."""
    return log.withColumn("content_hash", F.sha2(F.concat_ws("|", F.col(seq).cast("string"), content), 256))


def verify_chain(chain: DataFrame, seq: str, previous: str = "prev_hash", own: str = "hash", content: str = "content_hash", by: str | None = None) -> DataFrame:
    """chain with `problem`: bad_genesis, broken_link, bad_hash or null. Each chain (`by`) is checked on its own."""
    w = Window.partitionBy(*([by] if by else [])).orderBy(seq)
    before = F.lag(own).over(w)
    expected = F.sha2(F.concat(F.col(previous), F.col(content)), 256)
    problem = (
        F.when(F.row_number().over(w) == 1, F.when(F.col(previous) != GENESIS, "bad_genesis"))
        .when(~F.col(previous).eqNullSafe(before), "broken_link")
    )
    return chain.withColumn("problem", F.coalesce(problem, F.when(~F.col(own).eqNullSafe(expected), "bad_hash")))


def link(contents: list[str]) -> list[tuple[int, str, str, str]]:
    """(seq, prev_hash, content_hash, hash) of a chain, which is sequential by nature and short (one entry a release)."""
    import hashlib

    out, before = [], GENESIS
    for k, c in enumerate(contents):
        now = hashlib.sha256((before + c).encode()).hexdigest()
        out.append((k, before, c, now))
        before = now
    return out


def linked(entries: DataFrame, by: str, seq: str, content: str = "content_hash") -> DataFrame:
    """entries with prev_hash and hash: each chain (`by`, a few entries, one a release) is linked in order of `seq`."""

    def step(acc: Column, x: Column) -> Column:
        own = F.sha2(F.concat(acc["before"], x["c"]), 256)
        return F.struct(own.alias("before"), F.array_append(acc["out"], F.struct(x["s"].alias(seq), x["c"].alias(content), acc["before"].alias("prev_hash"), own.alias("hash"))).alias("out"))

    kind = dict(entries.dtypes)[seq]
    chains = entries.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col(content).alias("c")))).alias("e"))
    start = F.struct(F.lit(GENESIS).alias("before"), F.array().cast(f"array<struct<{seq}:{kind},{content}:string,prev_hash:string,hash:string>>").alias("out"))
    return chains.select(by, F.inline(F.aggregate("e", start, step)["out"]))


def unions(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

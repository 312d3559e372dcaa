"""Versions, packs and collections: frozen statistics, second-level rollups, rollback, registries, consistency, baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import stats, views
from quern.sources import readers

#: How many scores a version manifest shows from either end, and the states of a benchmark that can be run again.
SHOWN_SCORES = 5
REPRODUCIBLE = ("active", "verified")


def facet_counts(rows: DataFrame, facets: dict[str, Column], by: list[str] | None = None) -> DataFrame:
    """(by.., facet, key, n): counts of every value of every facet in one pass; null counts as unknown."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("facet"), F.coalesce(c.cast("string"), F.lit("unknown")).alias("key")) for f, c in facets.items())))
    by = by or []
    return rows.select(*by, each.alias("x")).groupBy(*by, "x.facet", "x.key").agg(F.count("*").alias("n"))


def frozen_statistics(rows: DataFrame, facets: dict[str, Column], score: str = "quality_score") -> DataFrame:
    """(facet, key, value) of a version: counts by facet, total, avg, min and max score, and the scores at either end."""
    counts = facet_counts(rows, facets).select("facet", "key", F.col("n").cast("double").alias("value"))
    s = F.col(score).cast("int")
    one = rows.agg(F.count("*").alias("total"), F.bround(F.avg(s), 2).alias("avg"), F.min(s).alias("min"), F.max(s).alias("max"))
    numbers = one.select(*(F.coalesce(F.col(c), F.lit(0)).cast("double").alias(c) for c in one.columns)).unpivot([], ["total", "avg", "min", "max"], "key", "value").select(F.lit("quality").alias("facet"), "key", "value")

    def end(name: str, order: Column) -> DataFrame:
        top = rows.where(s.isNotNull()).select(s.alias("s")).orderBy(order).limit(SHOWN_SCORES).agg(F.array_sort(F.collect_list("s")).alias("l"))
        return top.select(F.posexplode("l").alias("i", "v")).select(F.lit(name).alias("facet"), F.col("i").cast("string").alias("key"), F.col("v").cast("double").alias("value"))

    return counts.unionByName(numbers).unionByName(end("lowest", F.asc("s"))).unionByName(end("highest", F.desc("s")))


def add_version(index: DataFrame, version: str, frozen_at: str, total_records: int) -> DataFrame:
    """index(ord, version, frozen_at, total_records) with the version at its end, in place of an earlier entry of that name."""
    rest = index.where(F.col("version") != version)
    last = rest.agg((F.coalesce(F.max("ord"), F.lit(-1)) + 1).cast("long").alias("ord"))
    return rest.unionByName(last.select("ord", F.lit(version).alias("version"), F.lit(frozen_at).alias("frozen_at"), F.lit(total_records).cast("long").alias("total_records")))


def rollback(index: DataFrame, version: str) -> DataFrame:
    """The index up to the version; all of it if there is no such version."""
    target = index.agg(F.min(F.when(F.col("version") == version, F.col("ord"))).alias("_to"))
    return index.crossJoin(F.broadcast(target)).where("_to IS NULL OR ord <= _to").drop("_to")  # a single row


def pack_statistics(rows: DataFrame, pack: str, facets: dict[str, Column], score: str = "quality_score") -> DataFrame:
    """(pack, facet, key, n) and, under the facets total and avg_quality, each pack's rows and mean score."""
    counts = facet_counts(rows, facets, [pack]).select(F.col(pack).alias("pack"), "facet", "key", F.col("n").cast("double").alias("n"))
    one = rows.groupBy(F.col(pack).alias("pack")).agg(F.count("*").cast("double").alias("total"), F.bround(F.avg(F.col(score).cast("int")), 2).alias("avg_quality"))
    return counts.unionByName(one.unpivot(["pack"], ["total", "avg_quality"], "facet", "n").select("pack", "facet", F.lit("").alias("key"), "n"))


def collection_rollup(packs: DataFrame) -> DataFrame:
    """(facet, key, value) over pack_statistics(): histograms summed; the mean of the packs' mean scores, each cut to a whole number."""
    summed = packs.where("facet <> 'avg_quality'").groupBy("facet", "key").agg(F.sum("n").alias("value"))
    mean = packs.where("facet = 'avg_quality' AND n <> 0").agg(F.coalesce(F.bround(F.avg(F.floor("n")), 2), F.lit(0)).cast("double").alias("value"))
    return summed.unionByName(mean.select(F.lit("avg_quality").alias("facet"), F.lit("").alias("key"), "value"))


def missing_packs(wanted: DataFrame, packs: DataFrame) -> DataFrame:
    """The packs of a collection that do not exist; it can only be made if there are none."""
    return wanted.select("pack").distinct().join(packs.select("pack").distinct(), "pack", "left_anti")


def registry_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, change) of two (path, sha256) registries: added, removed, changed or unchanged."""
    both = before.select("path", F.col("sha256").alias("x")).join(after.select("path", F.col("sha256").alias("y")), "path", "full_outer")
    return both.select("path", F.when(F.col("x").isNull(), "added").when(F.col("y").isNull(), "removed").when(F.col("x") != F.col("y"), "changed").otherwise("unchanged").alias("change"))


def consistency(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """(check, expected, actual, status) of two (check, value) tables; a check without a value fails."""
    both = expected.select("check", F.col("value").alias("expected")).join(actual.select("check", F.col("value").alias("actual")), "check", "left")
    return both.withColumn("status", F.when(F.col("expected").eqNullSafe(F.col("actual")), "PASS").otherwise("FAIL"))


def freeze_baseline(pairs: DataFrame, strata: list[str], verdict: str) -> DataFrame:
    """(section, key, value) of pairs(auto, human, .., verdict): distributions, rates, and the extremes of bias and confidence."""
    dist = facet_counts(pairs, {"human": F.col("human").cast("int"), "auto": F.col("auto").cast("int"), "verdict": F.lower(verdict)}).select(F.col("facet").alias("section"), "key", F.col("n").cast("double").alias("value"))
    v = F.lower(F.col(verdict))
    rate = lambda test: F.coalesce(F.bround(F.avg(F.coalesce(test, F.lit(False)).cast("int")), 4), F.lit(0.0))
    rates = pairs.agg(F.count("*").cast("double").alias("n"), rate(v == "approve").alias("approval_rate"), rate(v.isin("needs_revision", "reject")).alias("rejection_rate")).unpivot([], ["n", "approval_rate", "rejection_rate"], "key", "value")
    by = stats.strata(pairs, strata).groupBy("scope").agg(F.max(F.abs("bias")).alias("max_abs_bias"), F.min("confidence").alias("min_confidence"), F.count_if(F.col("gate") == "MANDATORY_HUMAN_REVIEW").cast("double").alias("n_mandatory"))
    by = by.unpivot(["scope"], ["max_abs_bias", "min_confidence", "n_mandatory"], "key", "value").withColumnRenamed("scope", "section")
    return dist.unionByName(rates.withColumn("section", F.lit("rates"))).unionByName(by)


def engine_criteria(pairs: DataFrame, frozen_n: int, least_pearson: float = 0.30, least_distinct: int = 3) -> DataFrame:
    """(criterion, passed): the eight conditions that an evaluation engine must meet against a frozen baseline."""
    one = stats.global_metrics(pairs).crossJoin(stats.spearman(pairs)).crossJoin(pairs.agg(F.count_distinct("auto").alias("distinct")))  # single rows
    c = F.col
    tests = {
        "distinct_scores": c("distinct") >= least_distinct,
        "pearson_defined": c("pearson_r").isNotNull(),
        "pearson_least": c("pearson_r") >= least_pearson,
        "spearman_defined": c("spearman_r").isNotNull(),
        "mae": c("mae") < 2.0,
        "rmse": c("rmse") < 2.5,
        "mean_bias": F.abs("bias") <= 1.0,
        "inputs_unchanged": c("n") == frozen_n,
    }
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("criterion"), F.coalesce(t, F.lit(False)).alias("passed")) for k, t in tests.items())))
    return one.select(rows.alias("x")).select("x.*")


def benchmarks(spark, registry: dict[str, dict[str, dict]]) -> DataFrame:
    """(kind, id, status, problem) of a registry {internal, external: {id: {name, status, metrics}}}; problem says what an entry lacks."""
    rows = [(kind, i, b.get("status"), next((f"{k}_missing" for k in ("name", "status", "metrics") if not b.get(k)), None)) for kind, entries in registry.items() for i, b in entries.items()]
    return spark.createDataFrame(rows, "kind string, id string, status string, problem string")


def evaluation_readiness(registered: DataFrame, n_reports: int) -> DataFrame:
    """One row: counts, whether one benchmark can be run again, and READY, CONDITIONAL or BLOCKED (no benchmarks)."""
    one = registered.agg(F.count("*").alias("n_benchmarks"), F.count_if(F.col("kind") == "internal").alias("n_internal"), F.count_if(F.col("kind") == "external").alias("n_external"), (F.count_if(F.col("status").isin(*REPRODUCIBLE)) > 0).alias("reproducible"), (F.count_if(F.col("status") != "placeholder") == 0).alias("all_placeholder"))
    state = F.when(F.col("n_benchmarks") == 0, "BLOCKED").when(F.col("all_placeholder") | ~F.col("reproducible") | (F.lit(n_reports) == 0), "CONDITIONAL").otherwise("READY")
    return one.select("*", F.lit(n_reports).cast("long").alias("n_reports"), state.alias("status"))


def license_readiness(rows: DataFrame, license_: str = "license", attribution: str = "attribution_text") -> DataFrame:
    """One row: denied, unknown and attribution counts, and READY, CONDITIONAL (attribution pending) or BLOCKED."""
    c = F.col(license_)
    needs = X.attribution_required(c)
    one = rows.agg(F.count("*").alias("n"), F.count_if(X.license_denied(c)).alias("n_denied"), F.count_if(F.coalesce(c, F.lit("unknown")) == "unknown").alias("n_unknown"), F.count_if(needs).alias("attribution_required"), F.count_if(needs & (F.coalesce(attribution, F.lit("")) != "")).alias("attribution_complete"))
    state = F.when((F.col("n_denied") > 0) | (F.col("n_unknown") > 0), "BLOCKED").when(F.col("attribution_complete") < F.col("attribution_required"), "CONDITIONAL").otherwise("READY")
    return one.withColumn("status", state)


def plan(datasets: DataFrame, registry: DataFrame, extraction: Column) -> DataFrame:
    """datasets(source_id, license, ..) with license_class, denied, registry_status (candidate by default) and type; nothing is fetched."""
    known = registry.select(F.col("id").alias("_id"), F.coalesce("status", F.lit("candidate")).alias("_status"))
    out = datasets.join(known, F.col("source_id") == F.col("_id"), "left")
    return out.select(*datasets.columns, X.license_class(F.col("license")).alias("license_class"), X.license_denied(F.col("license")).alias("denied"), F.when(F.col("_id").isNull(), "MISSING-IN-REGISTRY").otherwise(F.col("_status")).alias("registry_status"), extraction.alias("type"))


def plan_checks(planned: DataFrame, cap_percent: float, target: str = "target", synthetic: str = "synthetic") -> DataFrame:
    """One row: targets, the synthetic share against its cap, denied licenses and bad registry states."""
    made = F.coalesce(F.sum(F.when(F.col(synthetic), F.col(target))), F.lit(0))
    one = planned.agg(F.count("*").alias("n_sources"), F.sum(target).alias("total_target"), made.alias("n_synthetic"), F.count_if("denied").alias("n_denied"), F.count_if(~F.col("registry_status").isin("accepted", "review")).alias("n_bad_status"), F.count_if(F.col("registry_status") == "MISSING-IN-REGISTRY").alias("n_missing"))
    share = F.bround(stats.ratio(100.0 * F.col("n_synthetic"), F.col("total_target")), 1)
    return one.withColumn("synthetic_pct", share).withColumn("over_cap", F.col("synthetic_pct") > cap_percent)


def bundle(rows: DataFrame, path: str, id_col: str, view: str, holdout: float = 0.05) -> DataFrame:
    """Writes a release: the canonical rows, one folder for each view, and the held-out rows; returns (path, bytes, sha256)."""
    split = views.holdout(rows, id_col, holdout)
    readers.write_jsonl(rows.sortWithinPartitions(id_col), f"{path}/canonical", gzip=True)
    readers.write_jsonl(split.where("NOT held_out").drop("held_out"), f"{path}/views", by=[view])
    readers.write_jsonl(split.where("held_out").drop("held_out"), f"{path}/eval")
    files = rows.sparkSession.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json*").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))


def worksheet(rows: DataFrame, id_col: str, by: str, fraction: float, seed: str = "42") -> DataFrame:
    """Of each value of `by` max(1, round(n * fraction)) rows in the order of a seeded digest, numbered by id within it."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)
    sizes = rows.groupBy(F.col(by).alias("_by")).agg(F.greatest(F.lit(1), F.bround(F.count("*") * fraction).cast("long")).alias("_k"))
    placed = rows.join(F.broadcast(sizes), F.col(by).eqNullSafe(F.col("_by"))).withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(order)))
    return placed.where("_n <= _k").withColumn("review_index", F.row_number().over(Window.partitionBy(by).orderBy(id_col))).drop("_by", "_k", "_n")

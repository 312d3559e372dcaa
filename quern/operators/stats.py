"""Agreement statistics between automatic and human scores, metrics over datasets, and distributions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X

ACCEPT = 7
CAP = 10
CONF_FLOOR, BIAS_FLAG, F1_FLOOR = 0.5, 1.0, 0.7
WITHIN1_TARGET, F1_TARGET = 0.80, 0.85


def pearson(a: str, b: str) -> Column:
    """Null for fewer than 3 pairs or where one side does not vary."""
    spread = F.nullif(F.stddev_pop(a) * F.stddev_pop(b), F.lit(0.0))  # corr() itself divides by it, also where it is 0
    return F.when(F.count("*") >= 3, F.covar_pop(a, b) / spread)


def with_ranks(df: DataFrame, *cols: str, buckets: int = 256) -> DataFrame:
    """Average-tie ranks `rank_<col>` (null for null), from the counts of distinct values.

    Values are dealt into buckets between approximate quantiles: the running sum over all is over the buckets alone, and
    within a bucket over its own values, so no task sorts all values however many there are.
    """
    for c in cols:
        counts = df.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("_v")).agg(F.count("*").alias("_n"))
        cuts = counts.agg(F.percentile_approx("_v", [k / buckets for k in range(1, buckets)], 10 * buckets).alias("_cuts"))
        dealt = counts.crossJoin(F.broadcast(cuts)).withColumn("_b", F.size(F.filter("_cuts", lambda q: q < F.col("_v")))).drop("_cuts")  # a single row
        sums = dealt.groupBy(F.col("_b").alias("_k")).agg(F.sum("_n").alias("_s"))
        before = lambda n, w: F.coalesce(F.sum(n).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        sums = sums.select("_k", before("_s", Window.orderBy("_k")).alias("_before"))
        below = F.col("_before") + before("_n", Window.partitionBy("_b").orderBy("_v"))
        ranks = dealt.join(F.broadcast(sums), F.col("_b") == F.col("_k")).select("_v", (below + (F.col("_n") + 1) / 2).alias(f"rank_{c}"))
        df = df.join(ranks, df[c] == ranks["_v"], "left").drop("_v")
    return df


def spearman(pairs: DataFrame, a: str = "auto", b: str = "human") -> DataFrame:
    return with_ranks(pairs, a, b).agg(F.bround(pearson(f"rank_{a}", f"rank_{b}"), 3).alias("spearman_r"))


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def confusion(auto: str = "auto", human: str = "human", accept: float = ACCEPT) -> dict[str, Column]:
    x, y = F.col(auto) >= accept, F.col(human) >= accept
    return {"tp": F.count_if(x & y), "fp": F.count_if(x & ~y), "fn": F.count_if(~x & y), "tn": F.count_if(~x & ~y)}


def _f1(tp: Column, fp: Column, fn: Column) -> Column:
    return ratio(2.0 * tp, 2.0 * tp + fp + fn)


def global_metrics(pairs: DataFrame) -> DataFrame:
    """One row: n, agreement, errors, Pearson, confusion, precision, recall, F1, accuracy and verdict, of pairs(auto, human)."""
    d = F.col("auto") - F.col("human")
    one = pairs.agg(
        F.count("*").alias("n"),
        F.avg((d == 0).cast("int")).alias("exact"),
        F.avg((F.abs(d) <= 1).cast("int")).alias("within1"),
        F.avg(F.abs(d)).alias("mae"),
        F.sqrt(F.avg(d * d)).alias("rmse"),
        F.avg(d).alias("bias"),
        pearson("auto", "human").alias("pearson_r"),
        *(v.alias(k) for k, v in confusion().items()),
    )
    tp, fp, fn, tn = (F.col(k) for k in ("tp", "fp", "fn", "tn"))
    f1 = _f1(tp, fp, fn)
    verdict = (
        F.when(F.col("n") < 5, "INSUFFICIENT_DATA")
        .when((F.col("within1") >= WITHIN1_TARGET) & (f1 >= F1_TARGET), "READY_FOR_CALIBRATED_AUTO_REVIEW")
        .when((F.col("within1") >= 0.6) & (f1 >= 0.7), "REQUIRES_HUMAN_REVIEW")
        .otherwise("NOT_READY")
    )
    rounded = [F.bround(c, 3).alias(c) for c in ("exact", "within1", "mae", "rmse", "bias", "pearson_r")]
    return one.select("n", *rounded, "tp", "fp", "fn", "tn", F.bround(ratio(tp, tp + fp), 3).alias("precision"), F.bround(ratio(tp, tp + fn), 3).alias("recall"), F.bround(f1, 3).alias("f1"), F.bround(ratio(tp + tn, tp + fp + fn + tn), 3).alias("accuracy"), verdict.alias("verdict"))


def strata(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """The metrics of each value of each key (scope, stratum, ...) in one pass, by grouping sets."""
    d = F.col("auto") - F.col("human")
    grouped = pairs.groupingSets([[F.col(k)] for k in keys], *(F.col(k) for k in keys))
    scope = F.coalesce(*(F.when(F.grouping(k) == 0, F.lit(k)) for k in keys))
    g = grouped.agg(scope.alias("scope"), F.coalesce(*(F.when(F.grouping(k) == 0, F.coalesce(F.col(k).cast("string"), F.lit("unknown"))) for k in keys)).alias("stratum"), F.count("*").alias("n"), F.avg("auto").alias("auto_mean"), F.avg("human").alias("human_mean"), F.avg(d).alias("bias"), F.avg(F.abs(d)).alias("mae"), F.avg((F.abs(d) <= 1).cast("int")).alias("within1"), *(v.alias(k) for k, v in confusion().items()))
    conf = F.greatest(F.lit(0.0), 1 - F.col("mae") / 9.0) * F.sqrt(F.least(F.col("n"), F.lit(CAP)) / CAP)
    f1 = _f1(F.col("tp"), F.col("fp"), F.col("fn"))
    gate = F.when((conf < CONF_FLOOR) | (F.abs("bias") >= BIAS_FLAG) | (f1 < F1_FLOOR), "MANDATORY_HUMAN_REVIEW").otherwise("AUTO_ALLOWED")
    action = F.when(gate == "MANDATORY_HUMAN_REVIEW", gate).when(F.abs(F.bround("bias", 3)) >= BIAS_FLAG, "APPLY_ADDITIVE_CORRECTION").otherwise("MONITOR")
    nz = lambda c: F.bround(c, 3) + 0.0
    return g.select("scope", "stratum", "n", F.bround("auto_mean", 2).alias("auto_mean"), F.bround("human_mean", 2).alias("human_mean"), nz("bias").alias("bias"), F.bround("mae", 3).alias("mae"), F.bround("within1", 3).alias("within1"), F.bround(f1, 3).alias("f1"), nz(-F.col("bias")).alias("correction"), F.bround(conf, 3).alias("confidence"), gate.alias("gate"), action.alias("action"))


def weighted_errors(pairs: DataFrame, weight: str, by: str) -> DataFrame:
    """Per value of `by`: bias and mean absolute error of auto against human, each review weighted by its confidence; null weighs nothing."""
    w, d = F.coalesce(F.col(weight).cast("double"), F.lit(0.0)), F.col("auto") - F.col("human")
    g = pairs.groupBy(F.col(by).alias("stratum")).agg(F.count("*").alias("n"), F.sum(w).alias("weight"), F.sum(w * d).alias("d"), F.sum(w * F.abs(d)).alias("e"))
    mean = lambda c: F.bround(ratio(F.col(c), F.col("weight")), 3) + 0.0
    return g.select("stratum", "n", "weight", mean("d").alias("bias"), mean("e").alias("mae"))


def dimension_metrics(pairs: DataFrame, dims: list[str]) -> DataFrame:
    """Per dimension the error of auto_<dim> (0..1, scaled to 1..10) against human_<dim>."""
    rows = F.explode(F.array(*(F.struct(F.lit(d).alias("dimension"), (F.col(f"auto_{d}") * 9.0 + 1.0).alias("a"), F.col(f"human_{d}").cast("double").alias("h")) for d in dims)))
    long = pairs.select(rows.alias("x")).select("x.*").where("a is not null and h is not null")
    e = F.col("a") - F.col("h")
    out = long.groupBy("dimension").agg(F.count("*").alias("n"), F.bround(F.avg("a"), 2).alias("auto_mean"), F.bround(F.avg("h"), 2).alias("human_mean"), F.bround(F.avg(e), 3).alias("bias"), F.bround(F.avg(F.abs(e)), 3).alias("mae"), F.bround(pearson("a", "h"), 3).alias("pearson_r"))
    return out.withColumn("action", F.when((F.col("mae") >= 2.0) & (F.coalesce("pearson_r", F.lit(0.0)) < 0.3), "RETUNE_WEIGHT").otherwise("MONITOR"))


def kappa(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa of two categorical columns; null where the expected agreement is 1."""
    cells = pairs.groupBy(a, b).agg(F.count("*").alias("n"))
    total = cells.agg(F.sum("n").alias("t"), F.sum(F.when(F.col(a).eqNullSafe(F.col(b)), F.col("n")).otherwise(0)).alias("same"))
    left = cells.groupBy(F.col(a).alias("v")).agg(F.sum("n").alias("x"))
    right = cells.groupBy(F.col(b).alias("w")).agg(F.sum("n").alias("y"))
    chance = left.join(right, F.col("v").eqNullSafe(F.col("w"))).agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0)).alias("c"))
    both = total.crossJoin(chance)  # two single rows
    po, pe = F.col("same") / F.col("t"), F.col("c") / (F.col("t") * F.col("t"))
    return both.select(F.col("t").alias("n"), F.bround(po, 4).alias("observed"), F.bround(pe, 4).alias("expected"), F.when(pe < 1, F.bround((po - pe) / (1 - pe), 4)).alias("kappa"))


def histogram(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("unknown")).alias("key")).agg(F.count("*").alias("n"))


def shares_against_targets(df: DataFrame, key: str, targets: dict[str, float], slack: float = 0.05) -> DataFrame:
    """(key, n, share, target, verdict): OK within `slack` of the target, else LOW or HIGH; UNEXPECTED has no target."""
    spark = df.sparkSession
    want = spark.createDataFrame(list(targets.items()), "k string, target double")
    got = histogram(df, key)
    total = got.agg(F.sum("n").alias("total"))
    both = got.join(F.broadcast(want), F.col("key") == F.col("k"), "full_outer").crossJoin(F.broadcast(total))
    share = F.coalesce(F.col("n"), F.lit(0)) / F.col("total")
    verdict = F.when(F.col("target").isNull(), "UNEXPECTED").when(share < F.col("target") - slack, "LOW").when(share > F.col("target") + slack, "HIGH").otherwise("OK")
    return both.select(F.coalesce("key", "k").alias("key"), F.coalesce("n", F.lit(0)).alias("n"), F.bround(share, 4).alias("share"), "target", verdict.alias("verdict"))


def dataset_numbers(rows: DataFrame, score: str = "quality_score", license_: str = "license", verified: str = "verified") -> DataFrame:
    """One row: rows, min, max and mean score, verified rows and rows of unknown license."""
    return rows.agg(F.count("*").alias("n"), F.min(score).alias("min_score"), F.max(score).alias("max_score"), F.bround(F.avg(score), 2).alias("avg_score"), F.count_if(F.coalesce(verified, F.lit(False))).alias("n_verified"), F.count_if(F.col(license_) == "unknown").alias("n_unknown_license"))


def rate(test: Column) -> Column:
    """Share of rows where the test holds; a null test does not hold."""
    return F.bround(F.avg(F.coalesce(test, F.lit(False)).cast("int")), 4)


def present(*cols: str) -> Column:
    test = F.lit(True)
    for c in cols:
        test = test & F.col(c).isNotNull()
    return test


def schema_pass_rate(required: list[str]) -> Column:
    """Share of rows that have every required field."""
    return rate(present(*required))


#: Metrics by name: an aggregate over rows(quality_score, license, verification_status, source_id, source_name, source_url).
METRICS: dict[str, Column | Callable[[], Column]] = {
    "quality_mean_score": lambda: F.bround(F.avg("quality_score"), 2),
    "quality_score_agreement": lambda: rate(F.col("quality_score") >= ACCEPT),
    "provenance_valid_source_rate": lambda: rate(F.coalesce("source_id", F.lit("")) != ""),
    "provenance_license_pass_rate": lambda: rate(~X.license_denied(F.col("license"))),
    "provenance_accuracy": lambda: rate(present("source_id", "source_name", "source_url", "license")),
    "content_safety_rate": lambda: rate((F.col("verification_status") != "rejected") & ~X.license_denied(F.col("license"))),
    "hallucination_risk": lambda: rate((F.coalesce("source_id", F.lit("")) == "") | ((F.coalesce("source_url", F.lit("")) == "") & (F.coalesce("source_name", F.lit("")) == ""))),
    "approval_prediction_accuracy": lambda: F.bround(ratio(F.count_if((F.col("verification_status") == "approved") & (F.col("quality_score") >= ACCEPT)).cast("double"), F.count_if(F.col("verification_status") == "approved")), 4),
}


def register(name: str, aggregate: Callable[[], Column]) -> None:
    METRICS[name] = aggregate


def run_metrics(rows: DataFrame, names: list[str] | None = None) -> DataFrame:
    """(metric, value): all metrics in one aggregate."""
    names = names or list(METRICS)
    one = rows.agg(*(METRICS[n]().cast("double").alias(n) for n in names))
    return one.unpivot([], names, "metric", "value")

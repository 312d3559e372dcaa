"""Training views: eligibility, reports of first failing reasons, holdouts, splits, manifests, recipes."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.plans import query as Q

REASONS = ["rejected", "pending_review", "license_denied", "quality_below", "eligibility_missing", "lineage_incomplete", "eligible"]


def reason(min_score: float = 7, eligible: str = "eligible", lineage: str = "lineage_complete") -> Column:
    """The first reason why a row is not in a view, or `eligible`."""
    status = F.col("verification_status")
    return (
        F.when(status == "rejected", "rejected")
        .when(~F.coalesce(status == "approved", F.lit(False)), "pending_review")
        .when(X.license_denied(F.col("license")), "license_denied")
        .when(F.coalesce("quality_score", F.lit(0)) < min_score, "quality_below")
        .when(~F.coalesce(F.col(eligible), F.lit(False)), "eligibility_missing")
        .when(~F.coalesce(F.col(lineage), F.lit(False)), "lineage_incomplete")
        .otherwise("eligible")
    )


def report(rows: DataFrame, min_score: float = 7) -> DataFrame:
    """(reason, n) for every reason, also those without rows."""
    known = rows.sparkSession.createDataFrame([(r,) for r in REASONS], "r string")
    got = rows.groupBy(reason(min_score).alias("reason")).agg(F.count("*").alias("n"))
    return known.join(got, F.col("r") == F.col("reason"), "left").select(F.col("r").alias("reason"), F.coalesce("n", F.lit(0)).alias("n"))


def production(min_score: float = 7) -> Column:
    """Approved or verified, and of the least score."""
    return (F.coalesce(F.col("verification_status") == "approved", F.lit(False)) | F.coalesce(F.col("verified"), F.lit(False))) & (F.coalesce("quality_score", F.lit(0)) >= min_score)


def _order(seed: str, id_col: str) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")), 256)


def holdout(rows: DataFrame, id_col: str, fraction: float, seed: str = "42") -> DataFrame:
    """rows with `held_out`: of 10 or more rows the first max(1, int(n * fraction)) in the order of a seeded digest; none if fraction is 0 or less.

    The cut is found by counting in digest prefixes, then among the rows of one prefix only, so no task sorts all rows.
    """
    if fraction <= 0:
        return rows.withColumn("held_out", F.lit(False))
    keyed = rows.withColumn("_d", _order(seed, id_col)).withColumn("_p", F.substring("_d", 1, 4))
    counts = keyed.groupBy("_p").agg(F.count("*").alias("_n"))
    upto = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = F.sum("_n").over(Window.partitionBy())
    cut = upto.withColumn("_k", F.when(total >= 10, F.greatest(F.lit(1), F.floor(total * fraction))).otherwise(0)).drop("_n")
    placed = keyed.join(F.broadcast(cut), "_p")  # at most 65536 prefixes
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_d")) + F.col("_before")
    return placed.withColumn("held_out", rank <= F.col("_k")).drop("_d", "_p", "_before", "_k")


def stratified(rows: DataFrame, id_col: str, by: str, fraction: float, seed: str = "42") -> DataFrame:
    """rows with `split`: of each stratum max(1, round(n * fraction)) go to eval (one of 5 or fewer), by a seeded digest."""
    n = rows.groupBy(F.col(by).alias("_by")).agg(F.count("*").alias("_n"))
    k = F.when(F.col("_n") > 5, F.greatest(F.lit(1), F.bround(F.col("_n") * fraction).cast("long"))).otherwise(1)
    prefixed = rows.withColumn("_d", _order(seed, id_col)).withColumn("_p", F.substring("_d", 1, 3))
    counts = prefixed.groupBy(by, "_p").agg(F.count("*").alias("_c"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_c").over(Window.partitionBy(by).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_c").withColumnsRenamed({by: "_by1", "_p": "_p1"})
    placed = prefixed.join(before, F.col(by).eqNullSafe(F.col("_by1")) & (F.col("_p") == F.col("_p1"))).join(n, F.col(by).eqNullSafe(F.col("_by")))
    rank = F.row_number().over(Window.partitionBy(by, "_p").orderBy("_d")) + F.col("_before")
    return placed.withColumn("split", F.when(rank <= k, "eval").otherwise("train")).select(*rows.columns, "split")


def quotas(counts: dict[str, int], targets: dict[str, float], expansion: int) -> dict[str, int]:
    """How many new rows each key gets, the largest gaps first, so that the whole comes close to its target shares."""
    total = sum(counts.values()) + expansion
    gaps = {k: max(0.0, total * t - counts.get(k, 0)) for k, t in targets.items()}
    whole = sum(gaps.values()) or 1.0
    out = {k: int(expansion * g / whole) for k, g in gaps.items()}
    for k in sorted(gaps, key=lambda k: (-gaps[k], k))[: expansion - sum(out.values())]:
        out[k] += 1
    return out


@dataclass
class Recipe:
    """A view by its parts: filters in the query language, deduplication key, least score, holdout."""

    filters: list[str] = field(default_factory=list)
    unique_by: str | None = None
    min_score: float = 0
    holdout: float = 0.0
    seed: str = "42"


def build(rows: DataFrame, recipe: Recipe, id_col: str) -> DataFrame:
    for f in recipe.filters:
        rows = Q.execute(f, rows).records
    rows = rows.where(F.coalesce("quality_score", F.lit(0)) >= recipe.min_score)
    if recipe.unique_by:
        first = rows.groupBy(recipe.unique_by).agg(F.min(id_col).alias("_first"))
        rows = rows.join(first.select("_first"), F.col(id_col) == F.col("_first"), "left_semi")
    return holdout(rows, id_col, recipe.holdout, recipe.seed)


def project(rows: DataFrame, view: str, model: str, id_col: str = "id") -> DataFrame:
    """The output rows of a training view: view_id, record_id, model, messages, the lineage up to the view, and the model's eligibility."""
    lineage = F.struct(F.col("lineage.source").alias("source"), F.col("lineage.curated_dataset").alias("curated_dataset"), F.lit(view).alias("training_view"))
    return rows.select(F.lit(view).alias("view_id"), F.col(id_col).alias("record_id"), "category", "license", F.lit(model).alias("model"), "messages", lineage.alias("lineage"), F.coalesce(F.col(f"training_view_eligibility.{model}"), F.lit(False)).alias("eligible"))


def lifecycle_valid(rows: DataFrame, states: DataFrame, id_col: str, allowed: tuple[str, ...] = ("approved", "released")) -> DataFrame:
    """The rows whose latest state (id, state, ord) is one of the allowed."""
    now = states.groupBy(F.col("id").alias("_i")).agg(F.max_by("state", "ord").alias("_s")).where(F.col("_s").isin(*allowed))
    return rows.join(now, F.col(id_col) == F.col("_i"), "left_semi")


def manifest(views: DataFrame, by: str, id_col: str, body: str) -> DataFrame:
    """Per view: rows, and a digest over the ids and bodies that does not depend on their order."""
    h = F.sha2(F.concat_ws("\x1f", F.col(id_col).cast("string"), body), 256)
    limb = lambda i: F.sum(F.conv(F.substring(h, i, 15), 16, 10).cast("decimal(38,0)")).cast("string")
    return views.groupBy(by).agg(F.count("*").alias("n"), F.sha2(F.concat_ws(":", limb(1), limb(17)), 256).alias("digest"))

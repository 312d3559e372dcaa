"""Release and readiness gates: one row a gate, with a verdict that is the worst of them."""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators import stats

SHOWN = 20


class Check(NamedTuple):
    """A test that no row may meet; `status` is what the gate says if one does. A null test is not met."""

    name: str
    bad: Column
    status: str = "fail"


def quality(least: int = stats.ACCEPT) -> Check:
    return Check("quality", F.coalesce("quality_score", F.lit(0)) < least)


def license() -> Check:  # noqa: A001
    return Check("license", X.license_denied(F.col("license")))


def unknown_license() -> Check:
    return Check("unknown_license", F.coalesce(F.lower("license"), F.lit("unknown")).isin("unknown", ""), "warn")


def schema(required: list[str]) -> Check:
    return Check("schema", ~stats.present(*required))


def rejected_source() -> Check:
    """For rows that mark_rejected() has marked."""
    return Check("rejected_source", F.col("_rejected"))


def mark_rejected(rows: DataFrame, rejected: DataFrame, source: str = "source") -> DataFrame:
    bad = rejected.select(F.col(source).alias("_s"), F.lit(True).alias("_rejected")).distinct()
    return rows.join(bad, rows[source] == F.col("_s"), "left").drop("_s")


def gates(rows: DataFrame, id_col: str, checks: list[Check]) -> DataFrame:
    """A row for each check: gate, status, n_bad, n and the smallest ids that fail (at most SHOWN, a report).

    Two passes over the rows, however many checks: one counts, one ranks the failing ids of each gate, of which a task
    sends on no more than SHOWN.
    """
    tested = rows.select(F.col(id_col).cast("string").alias("i"), F.array_compact(F.array(*(F.when(c.bad, F.lit(c.name)) for c in checks))).alias("failed"))
    counts = tested.agg(F.count("*").alias("n"), *(F.count_if(F.array_contains("failed", c.name)).alias(f"bad_{k}") for k, c in enumerate(checks)))
    one = F.explode(F.array(*(F.struct(F.lit(c.name).alias("gate"), F.lit(c.status).alias("worst"), F.col(f"bad_{k}").alias("n_bad")) for k, c in enumerate(checks))))
    ranked = tested.select(F.explode("failed").alias("g"), "i").withColumn("k", F.row_number().over(Window.partitionBy("g").orderBy("i"))).where(F.col("k") <= SHOWN)
    ids = ranked.groupBy("g").agg(F.array_sort(F.collect_list("i")).alias("first_ids"))
    all_ = counts.select("n", one.alias("x")).select("n", "x.*").join(ids, F.col("gate") == F.col("g"), "left")
    return all_.select("gate", F.when(F.col("n_bad") > 0, F.col("worst")).otherwise("pass").alias("status"), "n", "n_bad", F.coalesce("first_ids", F.array().cast("array<string>")).alias("first_ids"))


def balance_gate(rows: DataFrame, key: str, targets: dict[str, float], slack: float = 0.05) -> DataFrame:
    """Relative distance of each share from its target over `slack`, or a key without a target, fails."""
    table = stats.shares_against_targets(rows, key, targets)
    off = F.col("target").isNull() | (F.abs(F.col("share") - F.col("target")) / F.col("target") > slack)
    return table.agg(F.lit("balance").alias("gate"), F.when(F.count_if(off) > 0, "fail").otherwise("pass").alias("status"), F.sum("n").alias("n"), F.count_if(off).alias("n_bad"), F.slice(F.array_sort(F.collect_list(F.when(off, F.col("key")))), 1, SHOWN).alias("first_ids"))


def checksum_gate(stored: DataFrame, actual: DataFrame) -> DataFrame:
    """(path, digest) tables: a stored path that is missing or differs fails."""
    both = stored.select("path", F.col("digest").alias("want")).join(actual.select("path", F.col("digest").alias("have")), "path", "left")
    return gates(both, "path", [Check("verification", ~F.col("want").eqNullSafe(F.col("have")))])


def run(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def verdict(found: DataFrame) -> DataFrame:
    """One row: how many gates passed, and PASS, CONDITIONAL (only warnings) or BLOCKED."""
    worst = F.max(F.when(F.col("status") == "fail", 2).when(F.col("status") == "warn", 1).otherwise(0))
    return found.agg(F.count("*").alias("n_gates"), F.count_if(F.col("status") == "pass").alias("n_passed"), F.element_at(F.array(F.lit("PASS"), F.lit("CONDITIONAL"), F.lit("BLOCKED")), worst + 1).alias("decision"))


def readiness(rows: DataFrame, id_col: str, required: list[str], approval_target: float = 0.8) -> DataFrame:
    """One row: counts and rates over all rows, a state for each area, and the worst of them.

    mean_score is over rows; distinct_mean_score over distinct score values, as older reports have it.
    """
    status = F.col("verification_status")
    one = rows.agg(
        F.count("*").alias("n"),
        F.count_if(status == "approved").alias("n_approved"),
        F.count_if(F.coalesce(status, F.lit("pending")).isin("pending", "needs_revision")).alias("n_open"),
        F.bround(F.avg("quality_score"), 2).alias("mean_score"),
        F.bround(F.expr("avg(DISTINCT quality_score)"), 2).alias("distinct_mean_score"),
        F.count_if(X.license_denied(F.col("license"))).alias("n_denied"),
        F.count_if(~stats.present(*required)).alias("n_incomplete"),
    )
    share = stats.ratio(F.col("n_approved").cast("double"), F.col("n"))
    review = F.when(F.col("n") == 0, 2).when(share < 0.5, 2).when((share < approval_target) | (F.col("n_open") > 0), 1).otherwise(0)
    quality = F.when(F.col("n_incomplete") > 0, 2).when(F.col("mean_score") < stats.ACCEPT, 1).otherwise(0)
    lic = F.when(F.col("n_denied") > 0, 2).otherwise(0)
    name = lambda c: F.element_at(F.array(F.lit("READY"), F.lit("CONDITIONAL"), F.lit("BLOCKED")), c + 1)
    return one.select("*", F.bround(share, 4).alias("approval_rate"), name(review).alias("review"), name(quality).alias("data_quality"), name(lic).alias("license"), name(F.greatest(review, quality, lic)).alias("verdict"))

"""Validators: each gives an array of error names, empty where a row is valid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators.conversations import norm_text
from quern.schema import CATEGORIES, KNOWLEDGE_TYPES, ROLES, STATUSES, TYPES

ID = r"^[a-z0-9_-]{3,128}$"
TAG = r"^[a-z0-9][a-z0-9_-]*$"


def errors(rules: dict[str, Column]) -> Column:
    """The names of the rules that are broken, in order; a rule that is null is not broken."""
    return F.array_compact(F.array(*(F.when(broken, F.lit(name)) for name, broken in rules.items())))


def _missing(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit("")) == ""


def message_rules(messages: str = "messages") -> dict[str, Column]:
    m = F.col(messages)
    roles = F.transform(m, lambda x: x["role"])
    size = F.coalesce(F.size(m), F.lit(0))
    return {
        "messages_too_few": size < 2,
        "message_bad_role": F.exists(m, lambda x: ~F.coalesce(x["role"].isin(ROLES), F.lit(False))),
        "message_empty": F.exists(m, lambda x: X.strip(F.coalesce(x["content"], F.lit(""))) == ""),
        "message_too_long": F.exists(m, lambda x: F.length(x["content"]) > 64_000),
        "messages_no_user": ~F.coalesce(F.array_contains(roles, "user"), F.lit(False)),
        "messages_no_assistant": ~F.coalesce(F.array_contains(roles, "assistant"), F.lit(False)),
    }


def base_rules() -> dict[str, Column]:
    """Over the columns of a base record."""
    c = F.col
    return {
        "id_invalid": ~F.coalesce(c("id").rlike(ID), F.lit(False)),
        "category_unknown": ~F.coalesce(c("category").isin(CATEGORIES), F.lit(False)),
        "subcategory_invalid": ~F.coalesce(F.length("subcategory").between(1, 64), F.lit(False)),
        "type_unknown": ~F.coalesce(c("type").isin(TYPES), F.lit(False)),
        "source_name_missing": F.coalesce(c("source.name"), F.lit("")) == "",
        "source_license_missing": F.coalesce(c("source.license"), F.lit("")) == "",
        "source_license_denied": X.license_denied(c("source.license")),
        "source_date_invalid": ~F.coalesce(c("source.date"), F.lit("")).rlike(r"^([0-9]{4}-[0-9]{2}-[0-9]{2})?$"),
        "language_invalid": ~F.coalesce(c("language"), F.lit("en")).rlike("^[a-z]{2}(-[A-Z]{2})?$"),
        "difficulty_range": ~F.coalesce(c("difficulty").between(0, 3), F.lit(False)),
        "quality_score_range": ~F.coalesce(c("quality_score").between(0, 10), F.lit(False)),
        "verified_missing": c("verified").isNull(),
        "notes_missing": c("notes").isNull(),
        "tags_missing": c("tags").isNull(),
        "tags_too_many": F.size("tags") > 20,
        "tags_repeated": F.size("tags") != F.size(F.array_distinct("tags")),
        "tag_invalid": F.exists("tags", lambda t: ~F.coalesce(t.rlike(TAG), F.lit(False))),
        "notes_too_long": F.length("notes") > 2000,
        **message_rules(),
    }


def strict_rules(least: int = 7) -> dict[str, Column]:
    return {
        "strict_license_unknown": F.lower(F.coalesce("source.license", F.lit("unknown"))).isin("unknown", ""),
        "strict_unverified": ~F.coalesce(F.col("verified"), F.lit(False)),
        "strict_low_quality": F.coalesce("quality_score", F.lit(0)) < least,
    }


def knowledge_rules() -> dict[str, Column]:
    """Over the columns of a knowledge object."""
    c = F.col
    sa = X.share_alike(c("source_attribution.license"))
    return {
        **{k: v for k, v in base_rules().items() if k.split("_")[0] in ("id", "category", "subcategory", "difficulty", "quality", "tags", "tag", "messages", "message")},
        "knowledge_type_unknown": ~F.coalesce(c("knowledge_type").isin(KNOWLEDGE_TYPES), F.lit(False)),
        "canonical_answer_missing": _missing("canonical_answer"),
        "license_missing": _missing("license"),
        "license_denied": X.license_denied(c("license")),
        "status_unknown": ~F.coalesce(c("verification_status").isin(STATUSES), F.lit(False)),
        "attribution_incomplete": F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(c(f"source_attribution.{k}"), F.lit("")) == "" for k in ("source_id", "name", "license", "attribution_text")]), F.lit(True)),
        "share_alike_unmarked": F.coalesce(c("source_attribution.share_alike"), F.lit(False)) & ~sa,
        "lineage_missing": c("lineage").isNull(),
        "eligibility_missing": c("training_view_eligibility").isNull(),
        "verified_unapproved": F.coalesce(c("verified"), F.lit(False)) != (F.coalesce(c("verification_status"), F.lit("")) == "approved"),
    }


def knowledge_gate(least: float = 8.5) -> Column:
    return F.coalesce((F.col("verification_status") == "approved") & (F.col("quality_score") >= least), F.lit(False))


def view_rules(view: str) -> dict[str, Column]:
    """Over an output row of a training view."""
    return {"view_id_mismatch": ~F.col("view_id").eqNullSafe(F.lit(view)), **{f"{k}_missing": _missing(k) for k in ("record_id", "category", "license", "model")}, "messages_too_few": F.coalesce(F.size("messages"), F.lit(0)) < 2}


def validate(rows: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return rows.withColumn("errors", errors(rules))


def duplicates(rows: DataFrame, id_col: str = "id", order: str = "ord") -> DataFrame:
    """rows with duplicate_id, and the id of the first row of equal content (null for that row itself)."""
    keyed = rows.withColumn("_h", F.sha1(norm_text(F.col("messages"))))
    ids = keyed.groupBy(F.col(id_col).alias("_id")).agg(F.min(order).alias("_io"))
    content = keyed.groupBy(F.col("_h").alias("_k")).agg(F.min(F.struct(order, id_col)).alias("_first"))
    out = keyed.join(ids, F.col(id_col).eqNullSafe(F.col("_id"))).join(content, F.col("_h") == F.col("_k"))
    return out.withColumns({"duplicate_id": F.col(order) > F.col("_io"), "duplicate_of": F.when(F.col(order) > F.col(f"_first.{order}"), F.col(f"_first.{id_col}"))}).select(*rows.columns, "duplicate_id", "duplicate_of")


def error_counts(validated: DataFrame) -> DataFrame:
    return validated.select(F.explode("errors").alias("error")).groupBy("error").agg(F.count("*").alias("n"))


def unchanged(before: DataFrame, after: DataFrame) -> DataFrame:
    """(path, digest) tables: the paths that were added, removed or changed."""
    both = before.withColumnsRenamed({"digest": "x"}).join(after.withColumnsRenamed({"digest": "y"}), "path", "full_outer")
    return both.where(~F.col("x").eqNullSafe(F.col("y"))).select("path", "x", "y")


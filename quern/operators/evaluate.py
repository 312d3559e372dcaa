"""Explained quality scores of records: seven dimensions, score, confidence, flags and rationale, as plain columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.operators.conversations import role_text
from quern.schema import ACTION_VERBS, BOILERPLATE_OPENERS, CATEGORY_KEYWORDS, QUALITY_WEIGHTS

_NUMBER = r"\b[0-9]+(?:\.[0-9]+)?\b"
_LISTED = r"(?m)^[ \t]*[-*][ \t]+|^[ \t]*[0-9]+\.[ \t]+"


def _hits(blob: Column, category: Column) -> Column:
    """How many of the category's words occur anywhere in the text, also within other words."""
    count = lambda ws: reduce(lambda a, b: a + b, [blob.contains(w).cast("int") for w in ws])
    out = F.lit(0)
    for name, ws in CATEGORY_KEYWORDS.items():
        out = F.when(category == name, count(ws)).otherwise(out)
    return out


def features(rows: DataFrame) -> DataFrame:
    """Adds the shared measures of rows(messages, category, subcategory, tags), each computed once."""
    rows = rows.withColumns({"asst": role_text(F.col("messages"), "assistant"), "usr": role_text(F.col("messages"), "user"), "tagged": F.lower(F.coalesce(F.array_join("tags", " "), F.lit("")))})
    low = F.lower("asst")
    rows = rows.withColumns({"n_words": X.word_count(F.col("asst")), "parts": F.transform(X.sentences(F.col("asst")), X.word_count), "fences": F.regexp_count("asst", F.lit("```")), "number": F.col("asst").rlike(_NUMBER), "listed": F.col("asst").rlike(_LISTED)})
    blob = F.concat_ws(" ", low, F.lower("usr"), "tagged")
    sub = F.replace(F.lower(F.coalesce("subcategory", F.lit(""))), F.lit("_"), F.lit(" "))
    return rows.withColumns(
        {
            "n_sentences": F.size("parts"),
            "mean_words": F.when(F.size("parts") > 0, F.aggregate("parts", F.lit(0), lambda a, x: a + x) / F.size("parts")),
            "answer_hits": _hits(low, F.col("category")),
            "tagged_hits": _hits(F.concat_ws(" ", low, "tagged"), F.col("category")),
            "all_hits": _hits(blob, F.col("category")),
            "sub_hit": (sub != "") & blob.contains(sub),
            "stock": reduce(lambda a, b: a | b, [X.strip(low).startswith(o) for o in BOILERPLATE_OPENERS]),
        }
    )


def dimensions() -> dict[str, Column]:
    """Each dimension as an expression over features()."""
    c, n = F.col, F.col("n_words")
    near = lambda x: F.bround(x, 3)
    clarity = F.when(c("mean_words").between(8, 25), 0.92).when((c("mean_words") >= 4) & (c("mean_words") <= 40), 0.7).otherwise(0.45)
    caps = F.regexp_count("asst", F.lit(r"\b[A-Z]{4,}\b"))
    asked = F.concat(F.lit(" "), F.lower("usr"), F.lit(" "))
    asks = reduce(lambda a, b: a | b, [asked.contains(f" {v} ") for v in ACTION_VERBS])
    acts = c("listed") | (c("fences") > 0) | (n >= 12)
    useful = F.when(asks & acts, 0.9).when(asks | acts, 0.7).otherwise(0.45)
    return {
        "accuracy": F.when(F.length("asst") < 30, 0.45).when(c("asst").rlike("https?://"), 0.82).otherwise(near(F.least(F.lit(0.95), 0.72 + 0.04 * F.least(c("answer_hits"), F.lit(3)) + F.when(c("number"), 0.06).otherwise(0.0)))),
        "completeness": F.when(n == 0, 0.1).otherwise(near(F.least(F.lit(1.0), F.least(F.lit(1.0), n / 26.0) + F.when(c("n_sentences") >= 2, 0.06).otherwise(0.0)))),
        "technical_correctness": F.when(c("fences") % 2 == 1, 0.4).when(c("fences") > 0, 0.9).otherwise(near(F.least(F.lit(1.0), 0.55 + 0.05 * F.least(c("tagged_hits"), F.lit(4)) + F.when(c("number"), 0.1).otherwise(0.0)))),
        "clarity": F.when(c("n_sentences") == 0, 0.2).otherwise(near(F.greatest(F.lit(0.1), clarity - F.when(caps > 3, 0.15).otherwise(0.0)))),
        "usefulness": near(F.when(n < 8, F.greatest(F.lit(0.3), useful - 0.2)).otherwise(useful)),
        "originality": F.when(c("stock"), 0.4).when(F.length("asst") < 25, 0.55).otherwise(0.85),
        "relevance": F.when((c("all_hits") == 0) & ~c("sub_hit"), 0.4).when((c("all_hits") >= 2) | ((c("all_hits") >= 1) & c("sub_hit")), 0.95).otherwise(0.7),
    }


def evaluate(rows: DataFrame, source_confidence: Column | None = None) -> DataFrame:
    """rows with dims (struct), quality_continuous, quality_score 1-10, confidence, confidence_level 1-5, flags, rationale, strongest and weakest."""
    given = F.lower(F.coalesce(source_confidence, F.lit("high"))) if source_confidence is not None else F.lit("high")
    source = F.when(given == "high", 1.0).when(given == "low", 0.4).otherwise(0.7)
    out = features(rows).withColumns(dimensions())
    whole = reduce(lambda a, b: a + b, [F.col(k) * w for k, w in QUALITY_WEIGHTS.items()])
    evidence = (
        0.30 * F.least(F.lit(1.0), F.col("n_words") / 24.0)
        + 0.25 * source
        + 0.20 * F.col("relevance")
        + 0.15 * F.least(F.lit(1.0), 0.5 * F.col("n_sentences") + F.when(F.col("listed"), 0.5).otherwise(0.0))
        + 0.10 * F.when(F.col("number") | (F.col("fences") > 0), 0.6).otherwise(0.3)
    )
    out = out.withColumns({"whole": whole, "confidence": F.bround(F.least(F.lit(1.0), F.greatest(F.lit(0.0), evidence)), 3)})
    names = list(QUALITY_WEIGHTS)
    flags = {"very_short_answer": F.col("n_words") < 8, "low_relevance": F.col("relevance") < 0.5, "low_confidence": F.col("confidence") < 0.5, "boilerplate_opener": F.col("stock"), "unclosed_code_fence": F.col("fences") % 2 == 1}
    rank = F.array(*(F.struct(F.col(k).alias("score"), F.lit(-i).alias("i"), F.lit(k).alias("name")) for i, k in enumerate(names)))
    low = F.array(*(F.struct(F.col(k).alias("score"), F.lit(i).alias("i"), F.lit(k).alias("name")) for i, k in enumerate(names)))
    out = out.withColumns(
        {
            "quality_score": F.greatest(F.lit(1), F.least(F.lit(10), F.bround(1 + F.bround("whole", 9) * 9).cast("int"))),
            "quality_continuous": F.bround("whole", 4),
            "confidence_level": F.greatest(F.lit(1), F.least(F.lit(5), F.bround(1 + F.col("confidence") * 4).cast("int"))),
            "flags": F.array_compact(F.array(*(F.when(test, F.lit(k)) for k, test in flags.items()))),
            "rationale": F.array(*(F.struct(F.lit(k).alias("dimension"), F.col(k).alias("score"), X.band(F.col(k)).alias("band")) for k in names)),
            "strongest": F.array_max(rank)["name"],
            "weakest": F.array_min(low)["name"],
            "dims": F.struct(*names),
        }
    )
    return out.drop("asst", "usr", "tagged", "parts", "whole", "answer_hits", "tagged_hits", "all_hits", "stock", *names)


def report(evaluated: DataFrame, least: float = 0.7) -> DataFrame:
    """(measure, value) over evaluated rows: n, the mean of each dimension, mean confidence, and how many reach `least` as a whole, in one pass."""
    one = evaluated.agg(F.count("*").cast("double").alias("n"), *(F.bround(F.avg(f"dims.{k}"), 3).alias(f"mean_{k}") for k in QUALITY_WEIGHTS), F.bround(F.avg("confidence"), 3).alias("mean_confidence"), F.count_if(F.col("quality_continuous") >= least).cast("double").alias("n_passed"))
    return one.unpivot([], one.columns, "measure", "value")


# Words that speak for a technical text and for a specific one, in the profile for new records.
PROFILE_TERMS = ["therefore", "because", "since", "however", "although", "formula", "equation", "function", "algorithm", "model", "parameter", "gradient", "weight", "matrix", "tensor", "protocol", "architecture", "mechanism", "pipeline", "inference"]
SPECIFIC_TERMS = [":", "such as", "for example", "specifically", "namely", "including"]


def expansion_profile(rows: DataFrame, question: str = "question", answer: str = "answer", license_: str = "license") -> DataFrame:
    """rows with the scores of the second profile: dims, quality_continuous, quality_score, confidence, confidence_level and flags.

    It goes by lengths, terms and variety. Scores have no floor, so that its gate can fail.
    """
    a, q = F.coalesce(F.col(answer), F.lit("")), F.coalesce(F.col(question), F.lit(""))
    out = rows.withColumns({"_low": F.lower(a), "_len": F.length(a), "_words": X.words(F.lower(a)), "_asked": F.array_distinct(X.words(F.lower(q)))})
    n, low = F.col("_len"), F.col("_low")
    held = lambda terms: reduce(lambda x, y: x + y, [low.contains(t).cast("int") for t in terms])
    top = lambda c: F.least(F.lit(1.0), c)
    parts = F.size(F.filter(F.split(a, r"\."), lambda s: X.strip(s) != ""))
    variety = F.size(F.array_distinct("_words")) / F.greatest(F.lit(1), F.size("_words"))
    dims = {
        "accuracy": F.when(n > 0, top(n / 200.0)).otherwise(0.1),
        "completeness": F.when(n > 0, top(n / 500.0)).otherwise(0.1),
        "technical_correctness": top(held(PROFILE_TERMS) / 3.0 + 0.3),
        "clarity": top(1.0 - F.abs(n / F.greatest(F.lit(1), parts) - 20) / 100),
        "usefulness": top(held(SPECIFIC_TERMS) / 3.0 + n / 500.0),
        "originality": top(variety / 0.5),
        "relevance": top(F.size(F.array_intersect("_asked", "_words")) / F.greatest(F.lit(1), F.size("_asked"))),
    }
    out = out.withColumns({"dims": F.struct(*(F.bround(c, 3).alias(k) for k, c in dims.items())), "_conf": top(n / 100.0 * (0.5 + variety * 0.5))})
    whole = reduce(lambda x, y: x + y, [F.col(f"dims.{k}") * w for k, w in QUALITY_WEIGHTS.items()])
    score = F.greatest(F.lit(1), F.least(F.lit(10), F.bround(F.bround(whole, 9) * 9 + 1).cast("int")))
    level = F.when(F.col("_conf") < 0.3, 1).when(F.col("_conf") < 0.5, 2).when(F.col("_conf") < 0.7, 3).when(F.col("_conf") < 0.9, 4).otherwise(5)
    flags = F.array_compact(F.array(F.when(score < 7, F.lit("below_quality_threshold")), F.when(n < 20, F.lit("very_short_answer")), F.when(F.lower(F.coalesce(license_, F.lit(""))).contains("unknown"), F.lit("unknown_license"))))
    return out.withColumns({"quality_continuous": F.bround(whole, 4), "quality_score": score, "confidence": F.bround("_conf", 3), "confidence_level": level, "flags": flags}).drop("_low", "_len", "_words", "_asked", "_conf")


#: Below these a dimension gets a proposal, and what it is about.
REVISION_FLOORS = {"accuracy": 0.7, "completeness": 0.6, "technical_correctness": 0.6, "clarity": 0.7, "usefulness": 0.7, "originality": 0.5, "relevance": 0.6}


def proposals(evaluated: DataFrame, key: str) -> DataFrame:
    """(key, area, problem): one row for each dimension below its floor and each flag, without repeats."""
    weak = F.array(*(F.when(F.col(f"dims.{k}") < v, F.struct(F.lit(k).alias("area"), F.lit("low_score").alias("problem"))) for k, v in REVISION_FLOORS.items()))
    flagged = F.transform("flags", lambda f: F.struct(F.lit("flag").alias("area"), f.alias("problem")))
    return evaluated.select(key, F.explode(F.array_distinct(F.array_compact(F.concat(weak, flagged)))).alias("p")).select(key, "p.*")

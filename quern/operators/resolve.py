"""Layered lookup, review decisions, acquisition routing, lifecycle checks, provenance, incremental state."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.schema import LIFECYCLE_STATES, TRANSITIONS

TIERS = ["review_cache", "review_input", "decision", "curated", "pack", "archive"]
# Terms that mark a technical text.
TECHNICAL = [
    "algorithm", "api", "array", "async", "binary", "buffer", "cache", "callback", "class", "compile", "concurrency", "database", "debug", "deploy",
    "encrypt", "framework", "function", "hash", "http", "https", "index", "inherit", "instance", "interface", "iteration", "json", "library", "loop",
    "method", "middleware", "module", "namespace", "network", "null", "object", "package", "parallel", "polymorphism", "protocol", "queue",
    "recursion", "refactor", "regex", "response", "request", "schema", "serialize", "server", "socket", "stack", "string", "syntax", "tcp",
    "template", "thread", "token", "udp", "url", "variable", "vector", "virtual", "workflow", "xml", "yaml", "bandwidth", "connection-oriented",
    "connectionless", "dns", "firewall", "ip", "latency", "load-balancer", "port", "router", "ssl", "tls", "throughput", "daemon", "filesystem",
    "fifo", "kernel", "lifo", "memory", "mutex", "process", "semaphore",
]


def tiered(tiers: dict[str, DataFrame], key: str) -> DataFrame:
    """All tiers one under the other, with tier and its priority (0 first)."""
    parts = [df.withColumns({"tier": F.lit(name), "priority": F.lit(k)}) for k, (name, df) in enumerate(tiers.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def resolve(tiers: dict[str, DataFrame], key: str, order: str) -> DataFrame:
    """The row of each key in the first tier that has it; within a tier the first in `order`."""
    rows = tiered(tiers, key)
    first = rows.groupBy(F.col(key).alias("_k")).agg(F.min(F.struct("priority", order)).alias("_best"))
    return rows.join(first, F.col(key) == F.col("_k")).where((F.col("priority") == F.col("_best.priority")) & (F.col(order) == F.col("_best").getField(order))).drop("_k", "_best")


def explain(tiers: dict[str, DataFrame], key: str, wanted: Column) -> DataFrame:
    """One row for each tier tried for `wanted`, up to the one that has it."""
    rows = tiered(tiers, key).where(F.col(key) == wanted).groupBy("priority").agg(F.count("*").alias("n"))
    names = rows.sparkSession.createDataFrame(list(enumerate(tiers)), "p int, tier string")
    tried = names.join(rows, F.col("p") == F.col("priority"), "left").withColumn("hit", F.col("priority").isNotNull())
    first = F.min(F.when(F.col("hit"), F.col("p"))).over(Window.partitionBy())
    return tried.withColumn("first", first).where("first IS NULL OR p <= first").select("p", "tier", "hit", F.coalesce("n", F.lit(0)).alias("n"))


def decision_name(c: Column) -> Column:
    low = F.lower(c)
    return F.when(low.isin("approve", "approved"), "APPROVE").when(low.isin("defer", "deferred", "needs_revision", "revise"), "DEFER").when(low.isin("reject", "rejected"), "REJECT").otherwise("PENDING")


def latest_decisions(decisions: DataFrame, key: str = "record_id", at: str = "timestamp", order: str = "ord") -> DataFrame:
    """The last decision of each record; of equal times the later row."""
    last = decisions.groupBy(key).agg(F.max_by(F.struct(*[c for c in decisions.columns if c != key]), F.struct(at, order)).alias("x"))
    return last.select(key, "x.*")


def rollup_decisions(latest: DataFrame, packet: str, decision: str = "decision", at: str = "timestamp") -> DataFrame:
    """Per packet: counts, first and last time, and its verdict. One approval approves; rejection needs that there is none."""
    n = lambda k: F.count_if(F.col(decision) == k)
    verdict = F.when(F.col("approved_count") > 0, "APPROVE").when(F.col("rejected_count") > 0, "REJECT").when(F.col("deferred_count") > 0, "DEFER").otherwise("PENDING")
    out = latest.groupBy(packet).agg(n("APPROVE").alias("approved_count"), n("DEFER").alias("deferred_count"), n("REJECT").alias("rejected_count"), F.count("*").alias("reviewed_count"), F.min(at).alias("first_timestamp"), F.max(at).alias("last_timestamp"))
    return out.withColumn("decision", verdict)


def route(packets: DataFrame, decisions: DataFrame, registry: DataFrame, acceptable: tuple[str, ...] = ("approved", "active")) -> DataFrame:
    """packets(packet_id, source_id) with route: blocked, skipped_decision, missing_in_registry, skipped_status or planned."""
    out = packets.join(decisions.select("packet_id", "decision"), "packet_id", "left").join(registry.select(F.col("id").alias("_id"), "status"), F.col("source_id") == F.col("_id"), "left")
    route_ = (
        F.when(F.col("decision").isNull(), "blocked")
        .when(F.col("decision") != "APPROVE", "skipped_decision")
        .when(F.col("_id").isNull(), "missing_in_registry")
        .when(~F.coalesce(F.col("status").isin(*acceptable), F.lit(False)), "skipped_status")
        .otherwise("planned")
    )
    return out.withColumn("route", route_).drop("_id")


def check_transitions(events: DataFrame, key: str, order: list[str], state: str = "state") -> DataFrame:
    """Each event with the state before it and a problem: unknown_state, invalid_transition or null (also for a first event)."""
    before = F.lag(state).over(Window.partitionBy(key).orderBy(*order))
    allowed = F.create_map(*(x for a, bs in TRANSITIONS.items() for x in (F.lit(a), F.array(*map(F.lit, bs)).cast("array<string>"))))
    known = [*LIFECYCLE_STATES, "needs_revision"]
    out = events.withColumn("previous", before)
    problem = F.when(~F.col(state).isin(known), "unknown_state").when(F.col("previous").isNotNull() & ~F.coalesce(F.array_contains(F.element_at(allowed, F.col("previous")), F.col(state)), F.lit(False)), "invalid_transition")
    return out.withColumn("problem", problem)


def lifecycle_validity(events: DataFrame, key: str, order: list[str], state: str = "state") -> DataFrame:
    """One row: the share of events that are legal moves from the state before, of all and by the share of keys without a bad move."""
    checked = check_transitions(events, key, order, state)
    by = checked.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col("problem").isNotNull()).alias("bad"))
    return by.agg(F.sum("n").alias("n"), F.bround(1 - F.sum("bad") / F.sum("n"), 4).alias("event_validity"), F.bround(F.avg((F.col("bad") == 0).cast("int")), 4).alias("lifecycle_validity"))


def state_summary(current: DataFrame, state: str = "state") -> DataFrame:
    """(state, n) of every state, also those that nothing is in."""
    names = current.sparkSession.createDataFrame([(s,) for s in LIFECYCLE_STATES], "s string")
    got = current.groupBy(state).agg(F.count("*").alias("n"))
    return names.join(got, F.col("s") == F.col(state), "left").select(F.col("s").alias("state"), F.coalesce("n", F.lit(0)).alias("n"))


def pending(items: DataFrame, done: DataFrame, key: str, checksum: str | None = None) -> DataFrame:
    """Items not yet done; with `checksum`, also those whose content has changed since."""
    keys = [key] + ([checksum] if checksum else [])
    return items.join(done.select(*keys).distinct(), keys, "left_anti")


def listed(text: Column) -> Column:
    """Two or more lines that look like items of a list."""
    return F.size(F.filter(F.split(text, "\n"), lambda x: X.strip(x).rlike(r"^(?:[-*] |[0-9]+\.[ \t])"))) >= 2


def technical(text: Column) -> Column:
    words = F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9_-]+"), F.lit(0)))
    return F.size(F.array_intersect(words, F.array(*map(F.lit, TECHNICAL))))


def word_overlap(a: Column, b: Column) -> Column:
    """Jaccard of the sets of lower-cased words; 1 where both are empty."""
    x, y = F.array_distinct(X.words(F.lower(a))), F.array_distinct(X.words(F.lower(b)))

    def overlap(s: Column) -> Column:
        same = F.size(F.array_intersect(s["x"], s["y"]))
        union = F.size(s["x"]) + F.size(s["y"]) - same
        return F.when(union == 0, 1.0).otherwise(same / union)

    return X.once(F.struct(x.alias("x"), y.alias("y")), overlap)


def provenance(answer: Column, source: Column | None = None) -> Column:
    """struct(label, confidence): verbatim, rephrased, condensed or unknown."""
    out = lambda label, conf: F.struct(F.lit(label).alias("label"), (F.lit(conf) if isinstance(conf, float) else conf).alias("confidence"))
    n = X.word_count(answer)
    text = X.strip(answer)
    sentence = text.rlike(r"(?s)^\p{Lu}.*[.!?]$")
    tech = technical(answer) >= 2
    alone = (
        F.when(n <= 30, out("condensed", F.least(F.lit(0.85), 0.6 + 0.01 * n)))
        .when(listed(answer), out("condensed", 0.7))
        .when(sentence & tech, out("verbatim", 0.65))
        .otherwise(out("rephrased", 0.5))
    )
    nothing = out("unknown", 0.0)
    if source is None:
        return F.when(F.coalesce(text, F.lit("")) == "", nothing).otherwise(alone)
    held = X.once(word_overlap(answer, source), lambda j: F.when(j >= 0.95, out("verbatim", j * 0.95)).when(j >= 0.75, out("rephrased", j * 0.8)).when(j > 0.3, out("condensed", j * 0.6)).otherwise(out("unknown", F.greatest(F.lit(0.1), j * 0.3))))
    return F.when(F.coalesce(text, F.lit("")) == "", nothing).when(F.coalesce(X.strip(source), F.lit("")) == "", alone).otherwise(held)


def attribution(name: Column, author: Column, url: Column, license_: Column) -> Column:
    """`name by author, url (license)`, without the parts that are missing."""
    return F.concat(name, F.coalesce(F.concat(F.lit(" by "), author), F.lit("")), F.coalesce(F.concat(F.lit(", "), url), F.lit("")), F.coalesce(F.concat(F.lit(" ("), license_, F.lit(")")), F.lit("")))


# What is said of changes to an answer, by its provenance.
MODIFICATIONS = {
    "verbatim": "Used verbatim from the original Stack Exchange post.",
    "condensed": "Adapted from the original answer — content was condensed for training use.",
    "rephrased": "Adapted from the original answer — content was rephrased for clarity and training use.",
    "unknown": "Content sourced from Stack Exchange data dump pipeline. Specific modifications from the original post, if any, are not recorded.",
}


def modification_text(label: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in MODIFICATIONS.items() for x in kv))
    return F.coalesce(F.element_at(known, label), F.lit(MODIFICATIONS["unknown"]))


def with_resolutions(rows: DataFrame, resolutions: DataFrame, key: str = "record_id") -> DataFrame:
    """rows with label and confidence of their latest resolution (unknown, 0 where there is none) and the text that says so."""
    last = resolutions.groupBy(F.col(key).alias("_r")).agg(F.max_by(F.struct("label", "confidence"), "resolved_at").alias("_x"))
    out = rows.join(last, F.col(key) == F.col("_r"), "left")
    label = F.coalesce(F.col("_x.label"), F.lit("unknown"))
    return out.select(*rows.columns, label.alias("label"), F.coalesce(F.col("_x.confidence"), F.lit(0.0)).alias("confidence"), modification_text(label).alias("modifications"))

"""Typing, cleaning and promotion of source records, and migrations between record versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.schema import CATEGORIES, MESSAGE, ROLES, TYPES

MIN_CHARS, MAX_CHARS = 8, 100_000


def _v(c: Column, name: str) -> Column:
    return F.get_json_object(c, f"$.{name}")


def content_type(payload: Column) -> Column:
    """qa, instruction, conversation or raw, by the keys of a JSON payload; anything that is not an object is raw."""
    has = lambda n: _v(payload, n).isNotNull()
    return (
        F.when(has("question") & has("answer"), "qa")
        .when(has("instruction") & (has("output") | has("response")), "instruction")
        .when(F.substring(_v(payload, "messages"), 1, 1) == "[", "conversation")
        .otherwise("raw")
    )


def role_name(role: Column) -> Column:
    low = F.lower(role)
    return F.when(low.isin("human", "prompt"), "user").when(low.isin("gpt", "bot", "model"), "assistant").otherwise(low)


def messages_of(payload: Column) -> Column:
    """The turns of a JSON payload under either naming of role and content."""
    turns = F.from_json(_v(payload, "messages"), "array<struct<role:string,`from`:string,content:string,value:string>>")
    return F.transform(turns, lambda m: F.struct(role_name(F.coalesce(m["role"], m["from"], F.lit("user"))).alias("role"), X.clean_text(F.coalesce(m["content"], m["value"])).alias("content")))


def normalize(raw: DataFrame, payload: str = "payload") -> DataFrame:
    """raw(id, payload JSON or text, source, license) with record_type and typed, cleaned content."""
    p = F.col(payload)
    clean = lambda n: X.clean_text(_v(p, n))
    kind = content_type(p)
    content = F.struct(
        F.when(kind == "qa", clean("question")).alias("question"),
        F.when(kind == "qa", clean("answer")).alias("answer"),
        F.when(kind == "instruction", clean("instruction")).alias("instruction"),
        F.when(kind == "instruction", clean("input")).alias("input"),
        F.when(kind == "instruction", X.clean_text(F.coalesce(F.nullif(_v(p, "output"), F.lit("")), _v(p, "response")))).alias("output"),
        F.when(kind == "raw", clean("title")).alias("title"),
        F.when(kind == "raw", X.clean_text(F.coalesce(_v(p, "text"), F.when(~F.coalesce(p.startswith("{"), F.lit(False)), p)))).alias("text"),
        F.when(kind == "conversation", messages_of(p)).alias("messages"),
        p.alias("raw"),
    )
    return raw.withColumns({"record_type": kind, "content": content, "license": X.license_name(F.col("license")), "lineage": F.array(F.lit("extract"), F.lit("normalize"))})


def blob(content: Column) -> Column:
    """All strings of a typed content, one after the other."""
    return F.concat_ws("\n", content["question"], content["answer"], content["instruction"], content["input"], content["output"], content["title"], content["text"], F.array_join(F.transform(content["messages"], lambda m: F.concat_ws("\n", m["role"], m["content"])), "\n"))


def malformed(kind: Column, content: Column) -> Column:
    """The reason why a typed record is malformed, or null. An empty turn is named before a bad role."""
    empty = lambda c: F.coalesce(c, F.lit("")) == ""
    turns = content["messages"]
    return F.coalesce(
        F.when((kind == "qa") & (empty(content["question"]) | empty(content["answer"])), "malformed_qa_missing_fields"),
        F.when((kind == "conversation") & (F.coalesce(F.size(turns), F.lit(0)) < 2), "malformed_conversation_too_short"),
        F.when((kind == "conversation") & F.exists(turns, lambda m: X.strip(F.coalesce(m["content"], F.lit(""))) == ""), "malformed_conversation_empty_turn"),
        F.when((kind == "conversation") & F.exists(turns, lambda m: ~F.coalesce(m["role"].isin(ROLES), F.lit(False))), "malformed_conversation_bad_role"),
        F.when((kind == "instruction") & (empty(content["instruction"]) | empty(content["output"])), "malformed_instruction_missing_fields"),
        F.when((kind == "raw") & empty(content["text"]), "empty_text"),
    )


def drop_reason(text: Column, flags: Column, repeat: Column, broken: Column | None = None) -> Column:
    """The first reason for which a record goes, in the order of the cleaners; null if it stays."""
    n = F.length(text)
    return F.coalesce(
        broken if broken is not None else F.lit(None).cast("string"),
        F.when(n < MIN_CHARS, "too_short"),
        F.when(n > MAX_CHARS, "too_long"),
        F.when(F.array_contains(flags, "api_key") | F.array_contains(flags, "ssn"), "pii_high_severity"),
        F.when(repeat, "duplicate_content"),
    )


def first_of_each(df: DataFrame, key: Column, order: str) -> DataFrame:
    """df with `repeat`: whether a row has the key of an earlier one. The key's first is found by a partial aggregate."""
    keyed = df.withColumn("_key", key)
    firsts = keyed.groupBy("_key").agg(F.min(order).alias("_first"))
    return keyed.join(firsts, keyed["_key"].eqNullSafe(firsts["_key"]), "left").select(*df.columns, (F.col(order) > F.col("_first")).alias("repeat"))


def _cleaned(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """docs with clean, flags, early (the first reason to drop but for copies), redacted and key, which copies share."""
    c = docs.withColumn("clean", X.clean_text(F.col(text_col)))
    c = c.withColumn("flags", X.pii_flags(F.col("clean")))
    c = c.withColumn("early", drop_reason(F.col("clean"), F.col("flags"), F.lit(False), F.when(F.col("clean") == "", "empty_text")))
    c = c.withColumn("redacted", F.when(F.col("early").isNull(), X.redact(F.col("clean"))))
    return c.withColumn("key", F.when(F.col("early").isNull(), F.sha2("redacted", 256)))


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cleaned text, PII flags, first reason to drop, and redacted text of what stays.

    As in the chain of cleaners, a text only counts as an earlier copy if it was not dropped before deduplication.
    """
    c = _cleaned(docs, id_col, text_col)
    c = first_of_each(c, F.coalesce("key", F.col(id_col).cast("string")), id_col)
    return c.withColumn("reason", F.coalesce("early", F.when(F.col("repeat"), "duplicate_content"))).drop("early", "key", "repeat")


def funnel(docs: DataFrame, by: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(by, reason, n) of clean_documents(), with `kept`, in one scan: only counts and first ids of each key are exchanged."""
    rows = _cleaned(docs, id_col, text_col).groupBy(F.col(by).alias("_by"), "early", "key").agg(F.count("*").alias("n"), F.min(id_col).alias("first"))
    kept = F.when(F.col("early").isNull(), (F.col("first") == F.min("first").over(Window.partitionBy("early", "key"))).cast("long")).otherwise(0)
    parts = F.array(F.struct(F.coalesce("early", F.lit("duplicate_content")).alias("reason"), (F.col("n") - F.col("kept")).alias("n")), F.struct(F.lit("kept").alias("reason"), F.col("kept").alias("n")))
    long = rows.withColumn("kept", kept).select(F.col("_by").alias(by), F.explode(parts).alias("x")).where("x.n > 0")
    return long.groupBy(by, F.col("x.reason").alias("reason")).agg(F.sum("x.n").alias("n"))


def promote(records: DataFrame) -> DataFrame:
    """Typed records as base records: messages for each record type; a `<<` in an answer makes it reasoning."""
    c, kind = F.col("content"), F.col("record_type")
    turn = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    ask = F.when(c["input"] != "", F.concat(c["instruction"], F.lit("\n\n"), c["input"])).otherwise(c["instruction"])
    titled = F.concat(F.lit("Explain: "), F.when(c["title"] != "", c["title"]).otherwise("this text"))
    messages = (
        F.when(kind == "qa", F.array(turn("user", c["question"]), turn("assistant", c["answer"])))
        .when(kind == "instruction", F.array(turn("user", ask), turn("assistant", c["output"])))
        .when(kind == "conversation", c["messages"])
        .otherwise(F.array(turn("user", titled), turn("assistant", c["text"])))
        .cast(f"array<{MESSAGE.simpleString()}>")
    )
    kinds = F.when((kind == "qa") & c["answer"].contains("<<"), "reasoning").when(kind == "raw", "qa").otherwise(kind)
    return records.withColumns({"messages": messages, "type": kinds})


def coerce_record(rows: DataFrame) -> DataFrame:
    """Base-record defaults and clamps, with drop_reason: missing_category, unknown_category, insufficient_turns or null."""
    category = F.coalesce(*(F.when((F.col("category") == c) | (F.col("category") == c.split("_", 1)[1]), F.lit(c)) for c in CATEGORIES))
    turns = F.filter(F.transform("messages", lambda m: F.struct(role_name(m["role"]).alias("role"), X.clean_text(m["content"]).alias("content"))), lambda m: m["content"] != "")
    out = rows.withColumns({"given": F.col("category"), "messages": turns}).withColumn("category", category)
    roles = F.transform("messages", lambda m: m["role"])
    reason = F.coalesce(
        F.when(F.coalesce("given", F.lit("")) == "", "missing_category"),
        F.when(F.col("category").isNull(), "unknown_category"),
        F.when(~(F.array_contains(roles, "user") & F.array_contains(roles, "assistant")), "insufficient_turns"),
    )
    clamp = lambda c, top: F.greatest(F.lit(0), F.least(F.lit(top), F.coalesce(c, F.lit(0))))
    return out.withColumns(
        {
            "drop_reason": reason,
            "type": F.when(F.col("type").isin(TYPES), F.col("type")).otherwise("qa"),
            "quality_score": clamp(F.col("quality_score"), 10),
            "difficulty": clamp(F.col("difficulty"), 3),
            "tags": F.filter(F.array_distinct(F.transform("tags", X.slug)), lambda t: t != ""),
        }
    ).drop("given")


def coerce_source(source: Column) -> Column:
    """struct(name, url, license, date) of a struct or null: cleaned, name and license `unknown` where there is none."""
    text = lambda k: X.clean_text(source[k])
    known = lambda k: F.coalesce(F.nullif(text(k), F.lit("")), F.lit("unknown"))
    return F.struct(known("name").alias("name"), text("url").alias("url"), known("license").alias("license"), text("date").alias("date"))


def extraction_type(method: Column) -> Column:
    """The record type that an extraction method gives."""
    return F.when(method.isin("issue_to_patch", "conversation_to_turn"), "conversation").otherwise("instruction")


def sequence_ids(rows: DataFrame, prefix: Column, order: str, by: str = "category") -> DataFrame:
    """Ids `prefix_%04d` counted within each group of `by`, so that no task ever sees all rows."""
    n = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return rows.withColumn("id", F.concat(prefix, F.lit("_"), F.lpad(n.cast("string"), 4, "0")))


# Migrations: each is applied where its tag is not yet in the lineage, in order.
def _default_type(row: DataFrame) -> Column:
    code = F.col("category") == "02_software_engineering"
    return F.when(code | F.col("canonical_answer").contains("```"), "code").when(F.col("category").isin("05_hardware_engineering", "06_science_engineering"), "concept").otherwise("procedure")


MIGRATIONS = [
    ("migration:001", lambda df: {"knowledge_type": F.coalesce("knowledge_type", _default_type(df)), "verification_status": F.coalesce("verification_status", F.lit("pending")), "quality_score": F.coalesce("quality_score", F.lit(0))}),
    ("migration:002", lambda df: {"source_name": F.coalesce("source_name", F.lit("unknown"))}),
    ("migration:003", lambda df: {m: F.coalesce(m, F.lit(False)) for m in ("qwen", "llama", "deepseek")}),
]


def migrate(rows: DataFrame) -> DataFrame:
    """Applies MIGRATIONS to rows(category, canonical_answer, knowledge_type, ..., transformations); applying twice changes nothing."""
    for tag, change in MIGRATIONS:
        done = F.array_contains(F.coalesce("transformations", F.array().cast("array<string>")), tag)
        new = {k: F.when(done, F.col(k)).otherwise(v) for k, v in change(rows).items()}
        rows = rows.withColumns(new | {"transformations": F.when(done, F.col("transformations")).otherwise(F.array_append(F.coalesce("transformations", F.array().cast("array<string>")), F.lit(tag)))})
    return rows

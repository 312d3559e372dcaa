"""Conversation tables to records, validation of turns, and rendering to chat formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions import text as X
from quern.schema import ROLES


def to_messages(turns: DataFrame, key: str = "conv_id", order: str = "turn", role: str = "role", content: str = "text") -> DataFrame:
    """One row a conversation: key and messages, in order of turn."""
    packed = F.array_sort(F.collect_list(F.struct(F.col(order).alias("t"), F.col(role).alias("role"), F.col(content).alias("content"))))
    return turns.groupBy(key).agg(F.transform(packed, lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def role_text(messages: Column, role: str) -> Column:
    return F.array_join(F.transform(F.filter(messages, lambda m: m["role"] == role), lambda m: m["content"]), "\n")


def problem(messages: Column) -> Column:
    """too_short, empty_turn, bad_role, no_user, no_assistant, or null."""
    roles = F.transform(messages, lambda m: m["role"])
    return F.coalesce(
        F.when(F.size(messages) < 2, "too_short"),
        F.when(F.exists(messages, lambda m: X.strip(F.coalesce(m["content"], F.lit(""))) == ""), "empty_turn"),
        F.when(F.exists(messages, lambda m: ~F.coalesce(m["role"].isin(ROLES), F.lit(False))), "bad_role"),
        F.when(~F.array_contains(roles, "user"), "no_user"),
        F.when(~F.array_contains(roles, "assistant"), "no_assistant"),
    )


def norm_text(messages: Column) -> Column:
    return F.array_join(F.transform(messages, lambda m: F.concat(m["role"], F.lit(":"), F.lower(X.strip(m["content"])))), "\n")


# The templates of the text formats; {} stands for the content.
TEMPLATES = {
    "chatml": {"header": "", "system": "<|im_start|>system\n{}<|im_end|>\n", "user": "<|im_start|>user\n{}<|im_end|>\n", "assistant": "<|im_start|>assistant\n{}<|im_end|>\n", "fold": None},
    "llama": {"header": "<|begin_of_text|>", "system": "<|start_header_id|>system<|end_header_id|>\n\n{}<|eot_id|>", "user": "<|start_header_id|>user<|end_header_id|>\n\n{}<|eot_id|>", "assistant": "<|start_header_id|>assistant<|end_header_id|>\n\n{}<|eot_id|>", "fold": None},
    "mistral": {"header": "", "system": None, "user": "[INST] {} [/INST]", "assistant": "{}</s>", "fold": "System: {}\n\n"},
    "gemma": {"header": "", "system": None, "user": "<start_of_turn>user\n{}<end_of_turn>\n", "assistant": "<start_of_turn>model\n{}<end_of_turn>\n", "fold": "{}\n\n"},
}
# Which format each family of models reads.
MODEL_FORMATS = {"qwen": "chatml", "llama": "llama", "deepseek": "chatml", "mistral": "mistral", "gemma": "gemma", "openchat": "sharegpt", "alpaca": "alpaca"}


def _filled(template: str, content: Column) -> Column:
    before, after = template.split("{}")
    return F.concat(F.lit(before), content, F.lit(after))


def render_text(messages: Column, style: str) -> Column:
    """A conversation as text. The system message is the last one (gemma: the first one); tool turns are left out."""
    t = TEMPLATES[style]
    systems = F.filter(messages, lambda m: m["role"] == "system")
    system = F.nullif(F.get(systems, F.lit(0) if style == "gemma" else F.size(systems) - 1)["content"], F.lit(""))
    spoken = F.filter(messages, lambda m: m["role"].isin("user", "assistant"))
    first = F.array_position(F.transform(spoken, lambda m: m["role"]), "user") - 1

    def one(m: Column, i: Column) -> Column:
        said = m["content"]
        if t["fold"]:
            said = F.when((i == first) & system.isNotNull(), F.concat(_filled(t["fold"], system), said)).otherwise(said)
        return F.when(m["role"] == "user", _filled(t["user"], said)).otherwise(_filled(t["assistant"], m["content"]))

    head = F.lit(t["header"]) if not t["system"] else F.concat(F.lit(t["header"]), F.coalesce(_filled(t["system"], system), F.lit("")))
    return F.concat(head, F.array_join(F.transform(spoken, one), ""))


def sharegpt(messages: Column, key: Column) -> Column:
    """JSON {"conversations": [{role, content}], "id"}, with user as human and assistant as gpt."""
    name = lambda r: F.when(r == "user", "human").when(r == "assistant", "gpt").otherwise(r)
    return F.to_json(F.struct(F.transform(messages, lambda m: F.struct(name(m["role"]).alias("role"), m["content"].alias("content"))).alias("conversations"), key.cast("string").alias("id")))


def alpaca(messages: Column) -> Column:
    """(instruction, input, output, warn) of the first user and assistant turns; null if one is missing."""
    users, answers = (F.filter(messages, _is(r)) for r in ("user", "assistant"))
    asked = F.get(users, 0)["content"]
    cut = F.locate("\n\n", asked)
    return F.when(
        (F.size(users) > 0) & (F.size(answers) > 0),
        F.struct(
            F.when(cut > 0, F.substring(asked, F.lit(1), cut - 1)).otherwise(asked).alias("instruction"),
            F.when(cut > 0, F.substring(asked, cut + 2, F.length(asked))).otherwise("").alias("input"),
            F.get(answers, 0)["content"].alias("output"),
            F.when((F.size(users) > 1) | (F.size(answers) > 1), "multiturn-collapsed").alias("warn"),
        ),
    )


def _is(role: str):
    return lambda m: m["role"] == role


def fan_out(records: DataFrame) -> DataFrame:
    """Training rows of records(id, record_type, content): 0 to 2 for each, of a training type and its content as JSON."""
    c, kind = F.col("content"), F.col("record_type")
    reasoning = c["answer"].contains("<<") & c["answer"].contains("####")
    own = F.when((kind == "qa") & (c["answer"] != ""), F.struct(F.when(reasoning, "reasoning").otherwise("qa").alias("training_type"), F.to_json(F.struct(c["question"].alias("question"), c["answer"].alias("answer"))).alias("body")))
    own = F.when(kind == "instruction", F.struct(F.lit("instruction").alias("training_type"), F.to_json(F.struct(c["instruction"].alias("instruction"), c["input"].alias("input"), c["output"].alias("output"))).alias("body"))).otherwise(own)
    turns = F.filter(c["messages"], lambda m: m["content"] != "")
    own = F.when((kind == "conversation") & (F.size(turns) >= 2), F.struct(F.lit("conversation").alias("training_type"), F.to_json(F.struct(turns.alias("messages"))).alias("body"))).otherwise(own)
    extra = F.when(kind.isin("qa", "raw"), F.struct(F.lit("knowledge").alias("training_type"), F.to_json(F.struct(F.coalesce(c["question"], c["title"]).alias("topic"), F.coalesce(c["answer"], c["text"]).alias("text"))).alias("body")))
    return records.select("id", F.explode(F.array_compact(F.array(own, extra))).alias("t")).select("id", "t.*")


def transform_counts(normalized: DataFrame) -> DataFrame:
    """(training_type, n) of fan_out(), with `skipped` for the records that give no training row."""
    given = fan_out(normalized).groupBy("id", "training_type").agg(F.count("*").alias("n"))
    per = normalized.groupBy(F.col("id").alias("_i")).agg(F.count("*").alias("_n")).join(given, F.col("_i") == F.col("id"), "left")
    return per.groupBy(F.coalesce("training_type", F.lit("skipped")).alias("training_type")).agg(F.sum(F.coalesce("n", "_n")).alias("n"))

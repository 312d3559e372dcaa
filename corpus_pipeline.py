"""A curation pipeline over documents: quality rules, near duplicates, decontamination, secrets, tokens.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written as Parquet and read again
before the next one. All but the last return the columns of documents. Every stage judges rows, not ids: rows with a null
id, rows that repeat an id and columns of any other name go through each of them; empty tables give empty results.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import bpe, decontam, ngram_join, quality, secrets
from quern.llm.shared import small_batches, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality rules reject go, null and empty texts with them; repeated rows get one verdict."""
    small_batches(spark)
    return quality.accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, that with the smallest id; rows with a null id all stay.

    Rows that repeat an id are one document, of which one row stays. Null and empty texts are no one's duplicates.
    """
    small_batches(spark)
    return ngram_join.representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a window of a benchmark item go; null and empty texts have none."""
    small_batches(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark, by what each row's own text holds; no row goes, and a null text stays null."""
    return secrets.redacted(docs).withColumn("n_chars", F.length("text").cast("long"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts, and digests of ids and of the decoded text; a null text has no tokens."""
    small_batches(spark)
    import public_tokenizers

    return bpe.digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scan),
    ("byte-level BPE", tokens),
]


def _oracle() -> str:
    """The SQL of the five operators, each over what the one before it left."""
    import public_tokenizers

    over = lambda sql, name: "(" + re.sub(r"\bdocuments\b", name, sql) + ")"
    return f"""
WITH RECURSIVE s1 AS MATERIALIZED (SELECT d.* FROM documents d JOIN {over(quality.ORACLE, "documents")} USING (doc_id) WHERE kept),
s2 AS MATERIALIZED (SELECT s1.* FROM s1 JOIN {over(ngram_join.ORACLE, "s1")} USING (doc_id) WHERE component_id = doc_id),
s3 AS MATERIALIZED (SELECT s2.* FROM s2 JOIN {over(decontam.ORACLE, "s2")} USING (doc_id) WHERE NOT contaminated),
spans AS (SELECT doc_id, generate_subscripts(a, 1) AS i, unnest(a) AS x FROM (SELECT doc_id, string_split(spans, ',') AS a FROM {over(secrets.ORACLE, "s3")} WHERE spans <> '')),
placed AS (SELECT doc_id, i, CAST(split_part(x, ':', 2) AS BIGINT) AS a, CAST(split_part(x, ':', 3) AS BIGINT) AS b FROM spans),
after AS (SELECT *, coalesce(max(b) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS z FROM placed),
cut AS (SELECT doc_id, string_agg(CASE WHEN a >= z THEN substr(text, z + 1, a - z) || '[SECRET]' ELSE '' END, '' ORDER BY i) || substr(any_value(text), max(b) + 1) AS text FROM after JOIN s3 USING (doc_id) GROUP BY doc_id),
s4 AS MATERIALIZED (SELECT doc_id, coalesce(cut.text, s3.text) AS text FROM s3 LEFT JOIN cut USING (doc_id))
SELECT * FROM {over(bpe.oracle(public_tokenizers.path("byte_bpe_50k.tiktoken")), "s4")}
"""


ORACLE_SQL = _oracle()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each result but the last is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs

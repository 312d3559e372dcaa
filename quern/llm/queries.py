"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers

from quern.llm import bpe, decontam, langid, license_scan, ngram_join, quality, secrets, suffix_dedup, toxicity, warc

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_benchmark_decontamination": decontam.op3_benchmark_decontamination,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_language_id": langid.op5_language_id,
    "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
    "op7_byte_bpe": bpe.op7_byte_bpe,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_warc": warc.op9_warc,
    "op10_secret_scan": secrets.op10_secret_scan,
}
ORACLES: dict[str, str] = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE,
    "op6_suffix_dedup": suffix_dedup.ORACLE,
    "op3_benchmark_decontamination": decontam.ORACLE,
    "op4_quality_rules": quality.ORACLE,
    "op7_byte_bpe": bpe.oracle(public_tokenizers.path("byte_bpe_50k.tiktoken")),
    "op8_license_scan": license_scan.ORACLE,
    "op9_warc": warc.ORACLE,
    "op10_secret_scan": secrets.ORACLE,
}

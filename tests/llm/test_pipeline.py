"""The pipeline against its stages written out again, and on rows that break ids and names."""

import hashlib
import random
import re

import duckdb
import tiktoken
from test_llm import TABLES, brute_components, prose, prose_in_words_of, quality_rows, same_as_sql  # noqa: F401

import corpus_pipeline
from quern.llm import bpe, decontam, quality, queries, secrets

SF = "/root/testdata/sf0.001"


def by_oracle(name, documents, benchmark=()):
    """The SQL of one operator over documents given as rows."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", documents)
    con.execute("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    if benchmark:
        con.executemany("INSERT INTO benchmark VALUES (?, ?)", benchmark)
    got = con.sql(queries.ORACLES[name])
    return {row[got.columns.index("doc_id")]: dict(zip(got.columns, row, strict=True)) for row in got.fetchall()}


def brute_pipeline(documents, benchmark):
    """(doc_id, n_tokens, sha of ids, sha of text) of what is left; documents are (doc_id, text, lang) with unique ids."""
    import public_tokenizers as P

    verdict = by_oracle("op4_quality_rules", documents)
    left = [x for x in documents if verdict[x[0]]["kept"]]
    component = {i: c for i, _, c in brute_components([x[:2] for x in left])}
    left = [x for x in left if component[x[0]] == x[0]]
    hit = by_oracle("op3_benchmark_decontamination", left, benchmark)
    left = [x for x in left if not hit[x[0]]["contaminated"]]
    spans = by_oracle("op10_secret_scan", left)
    reference = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    out = []
    for i, text, _ in left:
        parts, at = [], 0
        for a, b in sorted((int(x.split(":")[1]), int(x.split(":")[2])) for x in spans[i]["spans"].split(",") if x):
            if a >= at:
                parts += [text[at:a], "[SECRET]"]
            at = max(at, b)
        text = "".join([*parts, text[at:]])
        ids = reference.encode_ordinary(text)
        out.append((i, len(ids), hashlib.sha256(b"".join(x.to_bytes(4, "little") for x in ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out)


def test_run_equals_the_stages_written_out_again(spark):
    read = lambda t, c: duckdb.sql(f"SELECT {c} FROM '{SF}/{t}.parquet'").fetchall()
    want = brute_pipeline(read("documents", "doc_id, text, lang"), read("benchmark", "item_id, text"))
    got = sorted(map(tuple, corpus_pipeline.run(spark, SF).collect()))
    assert got == want and 50 < len(got) < 200
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert sorted(con.sql(corpus_pipeline.ORACLE_SQL).fetchall()) == want


def test_every_stage_on_literal_rows(spark):
    """Null and repeated ids, null and empty texts, ties, repeated rows, clashing names and an empty table."""
    rows, clean = quality_rows()
    r = random.Random(3)
    item = " ".join(duckdb.sql(f"SELECT text FROM '{SF}/benchmark.parquet' WHERE len(text) > 200 LIMIT 1").fetchall()[0][0].split()[:30])
    long = prose_in_words_of(quality.COMMON_WORDS["en"], r, 260)
    own = [prose_in_words_of(quality.COMMON_WORDS["en"], r, 400) for _ in range(2)]
    extra = [(200, long, "en"), (201, long, "en"), (201, long, "en"), (202, long + " more words", "en"), (None, clean[6], "en"), (None, clean[6], "en"), (None, None, None), (203, clean[7] + " " + item, "en"), (204, own[0] + " user = bob pwd = CorrectHorse123", "en"), (204, own[1], "en"), (205, prose(5000, 9) + long, "it")]
    df = spark.createDataFrame([(i, t, g, "s", 1, "x", "y", 5, "z") for i, t, g in rows + extra], "doc_id long, text string, lang string, source string, n_chars long, kept_id string, found_id string, component_id long, whole string").repartition(3)
    now = df
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, df.limit(0), SF).count() == 0
        before, now = now, stage(spark, now, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == df.columns
            now = spark.createDataFrame(now.collect(), df.schema)
            seen[name] = sorted((str(x["doc_id"]) for x in now.collect()))
    first = seen["quality rules"]
    assert first.count("None") == 2 and first.count("201") == 2 and first.count("204") == 2 and "107" not in first and "82" not in first
    second = seen["n-gram Jaccard join"]
    assert second.count("None") == 2 and "200" in second and "201" not in second and "202" not in second and second.count("204") == 1
    assert "203" not in seen["benchmark decontamination"] and set(second) - {"203"} == set(seen["benchmark decontamination"])
    assert now.count() == len(second) - 1
    once = corpus_pipeline.secret_scan(spark, df.where("doc_id = 204"), SF).collect()
    assert sorted(x["text"] for x in once) == sorted([own[0] + " [SECRET] [SECRET]", own[1]]) and all(x["n_chars"] == len(x["text"]) for x in once)


def test_decisions_of_stages_take_effect(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "byte-level BPE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    clean = corpus_pipeline.secret_scan(spark, docs, SF)
    left = {r["doc_id"]: r["spans"] for r in secrets.digest(secrets.scan(clean)).collect()}
    assert clean.count() == docs.count() and not any(re.search("access|hex", s) for s in left.values())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontam.contamination(corpus_pipeline.decontamination(spark, docs, SF), bench).where("contaminated").count() == 0

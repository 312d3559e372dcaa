"""Benchmark decontamination with one Aho-Corasick automaton over normalised benchmark windows.

Texts are normalised to sequences of lower-case words; the automaton reads words of the benchmark as short numbers, and holds
every window of `window` consecutive item words (a shorter item is one window). Each text is scanned once. Hits are word
numbers, and are mapped back to byte offsets of the original text.

The automaton is broadcast as its windows and built once in a Python worker. Windows are read in parts of at most
PATTERN_WORDS words, each of which is one automaton and one scan over the texts, with a table written between two scans,
so that one automaton is alive at a time whatever the size of the benchmark; any usual benchmark is one part.

Cases: null has no words; an item without words has no window; equal items are both reported; items with a null id are
matched but not named; a text without words has no hits. Rows are judged one by one, so null and repeated ids and repeated
rows are kept as they are; other columns are ignored, whatever their names (`clean` returns them); empty tables give empty
results (documents) or no hits (benchmark).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import buffer_of, drop, table, text_chunks, worker_state, written

WINDOW_WORDS = 10
#: Words in the windows of one automaton, at two or three nodes of some 60 bytes each.
PATTERN_WORDS = 1 << 20
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[65:91] = _WORD[97:123] = _WORD[128:] = True
_NORMAL = bytes(c + 32 if 65 <= c < 91 else c if _WORD[c] else 32 for c in range(256))


def normal_words(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


def windows(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The windows of an item."""
    words = normal_words((text or "").encode())
    return {tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set()


def _parts(benchmark: DataFrame, item_col: str, text_col: str, size: int, limit: int) -> Iterator[dict[tuple, list]]:
    """Windows and the items that have them, in parts of about `limit` words; one part and one partition are held at a time."""
    part: dict[tuple, list] = {}
    held = 0
    for item, text in benchmark.select(item_col, text_col).toLocalIterator():
        for w in windows(text, size):
            held += len(w)
            part.setdefault(w, []).append(None if item is None else str(item))
            if held >= limit:
                yield part
                part, held = {}, 0
    if part:
        yield part


class Matcher:
    """The automaton of one part. A word of the benchmark is a number of `digits` characters to it, any other word is blanks.

    Each digit has characters of its own, so a match never starts within a word; there are DIGITS of each, since a node's
    children are searched one by one.
    """

    DIGITS = 64
    alive = 0  # automata in this process

    def __init__(self, part: dict[tuple, list]):
        words = dict.fromkeys(x for w in part for x in w)
        self.digits = next(k for k in range(1, 9) if self.DIGITS**k >= len(words))
        self.spelled = {x: "".join(chr(0x100 + self.DIGITS * j + n // self.DIGITS**j % self.DIGITS) for j in range(self.digits)) for n, x in enumerate(words)}
        self.automaton = ahocorasick.Automaton()
        for w, items in part.items():
            self.automaton.add_word("".join(map(self.spelled.__getitem__, w)), (len(w), items))
        self.automaton.make_automaton()
        Matcher.alive += 1

    def __del__(self):
        Matcher.alive -= 1

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Word spans of windows in a text, and the items that have them."""
        get, other = self.spelled.get, " " * self.digits
        spans, names = [], set()
        for end, (length, items) in self.automaton.iter("".join([get(w, other) for w in words])):
            last = (end + 1) // self.digits
            spans.append((last - length, last))
            names.update(items)
        return spans, names


def _union(spans: list) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def byte_spans(text: bytes, spans: list[list[int]]) -> list[tuple[int, int]]:
    """Word spans as byte offsets of the original UTF-8 text."""
    inside = np.concatenate(([False], _WORD[np.frombuffer(text, np.uint8)], [False]))
    starts, ends = np.flatnonzero(inside[1:] & ~inside[:-1]), np.flatnonzero(inside[:-1] & ~inside[1:])
    return [(int(starts[a]), int(ends[b - 1])) for a, b in spans]


def _scan(shared, first: bool, last: bool):
    """Adds to the hits of each text those of one automaton; the last scan gives the facts."""
    name = f"aho-corasick-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = worker_state(name, lambda: Matcher(shared.value)) if shared is not None else None
        for batch in text_chunks(batches, keep=name):
            data, off = buffer_of(batch.column(1))
            whole = data.tobytes()
            before = [([], [])] * batch.num_rows if first else list(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True))
            n_words, met, found, offsets = [], [], [], []
            for k, (old, named) in enumerate(before):
                text = whole[off[k] : off[k + 1]]
                words = normal_words(text)
                got, names = matcher.find(words) if matcher else ([], set())
                spans = _union([*old, *got]) if got or old else []
                n_words.append(len(words))
                found.append(spans)
                met.append(sorted({*named, *(x for x in names if x is not None)}))
                offsets.append([list(p) for p in byte_spans(text, spans)] if last and spans else [])
            pairs, strings = pa.list_(pa.list_(pa.int64())), pa.list_(pa.string())
            if not last:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pairs), pa.array(met, strings)], names=["id", "text", "spans", "items"])
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array([sum(b - a for a, b in s) for s in found], pa.int64()),
                    pa.array([len(x) for x in met], pa.int64()),
                    pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in met]),
                    pa.array([bool(s) for s in found]),
                    pa.array(offsets, pairs),
                    pa.array(met, strings),
                ],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "byte_spans", "items"],
            )

    return run


def _without(shared, column: int):
    """The rows of whose text no window is a part, with all columns."""
    name = f"aho-corasick-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = worker_state(name, lambda: Matcher(shared.value))
        for batch in text_chunks(batches, column, keep=name):
            data, off = buffer_of(batch.column(column))
            whole = data.tobytes()
            yield batch.filter(pa.array([not matcher.find(normal_words(whole[a:b]))[0] for a, b in zip(off[:-1], off[1:], strict=True)], pa.bool_()))

    return run


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS, pattern_words: int = PATTERN_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, byte_spans (of the original text) and items."""
    sc = docs.sparkSession.sparkContext
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(found.dtypes)["id"]
    facts = f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, byte_spans array<array<long>>, items array<string>"
    parts, first, before = _parts(benchmark, item_col, item_text_col, window, pattern_words), True, None
    part = next(parts, None)
    while (after := next(parts, None)) is not None:
        shared = sc.broadcast(part)
        found = written(found.mapInArrow(_scan(shared, first, False), f"id {kind}, text string, spans array<array<long>>, items array<string>"), "hits")
        shared.unpersist()
        if before is not None:
            drop(before)
        part, first, before = after, False, found
    return found.mapInArrow(_scan(None if part is None else sc.broadcast(part), first, True), facts)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW_WORDS, pattern_words: int = PATTERN_WORDS) -> DataFrame:
    """The rows of docs, with all their columns, that have no window of the benchmark."""
    sc = docs.sparkSession.sparkContext
    before = None
    for k, part in enumerate(_parts(benchmark, item_col, item_text_col, window, pattern_words)):
        if k:
            docs = written(docs, "clean")
            if before is not None:
                drop(before)
            before = docs
        docs = docs.mapInArrow(_without(sc.broadcast(part), docs.columns.index(text_col)), docs.schema)
    return docs


def op3_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("byte_spans", "items")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, i, k, array_to_string(w[i : i + k - 1], ' ') AS win
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
hit AS (SELECT dw.doc_id, dw.i, dw.k, bw.item_id FROM dw JOIN bw USING (k, win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS s FROM hit GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

"""Removal of repeated substrings by a distributed, common-prefix-aware merge sort of suffixes.

A byte goes when a string of `length` bytes around it also starts earlier (smaller id, or same text, earlier start).

Which suffixes: every string of `length` bytes has one anchor, the place of its least hashed GRAM-gram, which depends on
the string alone; equal strings have equal anchors at equal offsets. So only anchors are sorted, about one in 35 places,
and of those only anchors whose gram occurs twice in the corpus. An anchor's key is the suffix from it, up to `length`
bytes, and then what stands before it (read backwards), so equal keys mean equal surroundings for all strings it owns.
That is less than a sort of all suffixes, which would move about a hundred times the input: a count of hashed grams leaves
out the places that cannot repeat, and the sort decides, by bytes, for all that are left.

How they are sorted: tasks sort their anchors into runs, split by a hash of the gram, collapse equal keys, and exchange the
runs front-coded (shared prefix length and the rest of each key). Each receiving task merges its runs with a loser tree
that knows every key's common prefix with the last winner, and so compares only bytes behind it. In the merged order,
equal keys but the earliest are repeats at once; for different keys with the same gram the strings they own are compared,
one offset at a time. Copies never meet in one place: of equal keys a run sends the earliest and settles the others itself,
and of equal grams a task asks about one, so a gram or key counts once a run, however common it is. Of equal texts only the
first is sorted: the others go whole, if they hold a string at all, since the first has all their strings earlier.

Cases: null and empty text has no bytes. Rows with the same id and text are one document and get equal results; rows with
the same id and different texts are ordered by a fingerprint of the text; a null id comes last. A text of 256 MiB or more
raises an error. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.shared import buffer_of, drop, table, text_chunks, written
from quern.llm.shingles import _CODE, _power, mix

LENGTH = 100
GRAM = 32
#: Stands for a null id.
LAST = (1 << 63) - 1
#: Anchors that are sorted into one run.
RUN_ANCHORS = 1 << 17
#: Anchors among which a task asks about each gram once.
GRAM_ANCHORS = 1 << 19
_PLACE = np.uint64((1 << 28) - 1)  # a text, and so a chunk, has fewer bytes than this


def fingerprints(data: np.ndarray, off: np.ndarray) -> list[int]:
    whole = data.tobytes()
    return [int.from_bytes(hashlib.blake2b(whole[a:b], digest_size=8).digest(), "little", signed=True) for a, b in zip(off[:-1], off[1:], strict=True)]


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """For texts side by side: each anchor's place, gram hash, text number, and the first and last string that it owns."""
    none = np.zeros(0, np.int64)
    n = len(data) - gram + 1
    last = len(data) - length
    if last < 0:
        return none, none.astype(np.uint64), none, none, none
    if n > int(_PLACE):
        raise ValueError(f"a text of {len(data)} bytes is too long; places have 28 bits")
    up, down = _power(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_CODE[data] * up[: len(data)], out=sums[1:])
    hashes = mix((sums[gram:] - sums[:n]) * down[:n])
    keys = (hashes & ~_PLACE) | np.arange(n, dtype=np.uint64)
    w = length - gram + 1
    wide = np.full(-(-n // w) * w, np.iinfo(np.uint64).max)
    wide[:n] = keys
    blocks = wide.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    owner = (np.minimum(behind[: last + 1], ahead[w - 1 : w + last]) & _PLACE).astype(np.int64)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))[: last + 1]
    good = np.flatnonzero(np.arange(last + 1) + length <= off[1:][text])
    owner, text = owner[good], text[good]
    first = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (text[1:] != text[:-1])))) if len(good) else none
    stop = np.append(first[1:], len(good)) - 1
    place = owner[first]
    return place, hashes[place], text[first], good[first], good[stop] if len(good) else none


def _repeated_grams(length: int, gram: int):
    """A row for each anchor. Of equal grams in one run one row bears the gram; the others are sure to be wanted and go anywhere."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def flush() -> pa.RecordBatch:
            hashes, doc, fp, place = (np.concatenate(c) for c in zip(*held, strict=True))
            held.clear()
            _, first, which, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
            rest = np.ones(len(hashes), bool)
            rest[first] = False
            key = hashes.copy()
            key[rest] = mix(hashes[rest] ^ place[rest].astype(np.uint64) ^ fp[rest].view(np.uint64))
            return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc), pa.array(fp), pa.array(place), pa.array(n[which] > 1)], names=["gram", "doc", "fp", "place", "sure"])

        for batch in text_chunks(batches):
            data, off = buffer_of(batch.column(1))
            place, hashes, text, _, _ = anchors(data, off, length, gram)
            if not len(place):
                continue
            fp = np.array(fingerprints(data, off), np.int64)
            held.append((hashes, np.asarray(batch.column(0))[text], fp[text], (place - off[text]).astype(np.int32)))
            if sum(len(x[0]) for x in held) >= GRAM_ANCHORS:
                yield flush()
        if held:
            yield flush()

    return run


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        data, off = buffer_of(batch.column(1))
        whole = data.tobytes()
        sha = [hashlib.sha256(whole[a:b]).hexdigest() for a, b in zip(off[:-1], off[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(data, off), pa.int64()), pa.array(np.diff(off)), pa.array(sha)], names=["doc", "fp", "n_bytes", "sha"])


def _key(whole: bytes, begin: int, end: int, at: int, length: int, gram: int) -> bytes:
    """The suffix from `at`, padded, its length, and what stands before it, backwards; all within [begin, end)."""
    right = whole[at : min(end, at + length)]
    left = whole[max(begin, at - (length - gram)) : at]
    return right.ljust(length, b"\0") + bytes((length - len(right),)) + left[::-1]


def pack(rows: list[tuple[bytes, int, int, list]]) -> bytes:
    """A sorted run, front-coded: of each key the length shared with the one before, the rest, the span of strings that it owns, and its members."""
    before, heads, rest, members = b"", bytearray(), [], []
    for key, low, high, who in rows:
        same = common(before, key, 0)
        heads += struct.pack("<BBBBI", same, len(key) - same, low, high, len(who))
        rest.append(key[same:])
        members += who
        before = key
    table_ = np.array(members, np.int64)
    body = b"".join((struct.pack("<II", len(rows), sum(map(len, rest))), bytes(heads), *rest, np.ascontiguousarray(table_.T).tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(body)


def unpack(run: bytes) -> Iterator[tuple[int, bytes, int, int, list]]:
    """(shared with the key before, key, low, high, members) in order."""
    body = zstandard.ZstdDecompressor().decompress(run)
    n, size = struct.unpack_from("<II", body)
    at, text, key, m = 8, 8 + 8 * n, b"", 0
    members = np.frombuffer(body, np.int64, offset=text + size).reshape(3, -1).T.tolist()
    for _ in range(n):
        same, tail, low, high, count = struct.unpack_from("<BBBBI", body, at)
        key = key[:same] + body[text : text + tail]
        yield same, key, low, high, members[m : m + count]
        at, text, m = at + 8, text + tail, m + count


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of a and b, which share `known` bytes already."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


class LoserTree:
    """Merges sorted runs; beside each key stands its common prefix with the last winner, and known prefixes are never compared again."""

    def __init__(self, runs: list[Iterator]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.key: list = [None] * self.size
        self.shared = [0] * self.size
        self.row: list = [None] * self.size
        self.lost = [-1] * self.size
        for r in range(len(runs)):
            self._next(r)
            self.shared[r] = 0
        self.best = self._build(1)

    def _next(self, r: int) -> None:
        row = next(self.runs[r], None)
        self.row[r] = row
        self.shared[r], self.key[r] = row[:2] if row else (0, None)

    def _beats(self, a: int, b: int) -> bool:
        """Whether a comes first; sets the loser's common prefix to that with the winner."""
        ka, kb = self.key[a], self.key[b]
        if ka is None or kb is None:
            return kb is None
        ha, hb = self.shared[a], self.shared[b]
        if ha != hb:
            return ha > hb
        h = common(ka, kb, ha)
        first = h == len(ka) or h < len(kb) and ka[h] < kb[h]
        if h == len(ka) == len(kb):
            first = a < b
        self.shared[b if first else a] = h
        return first

    def _build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        a, b = self._build(2 * node), self._build(2 * node + 1)
        a, b = (a, b) if self._beats(a, b) else (b, a)
        self.lost[node] = b
        return a

    def __iter__(self) -> Iterator[tuple]:
        """(shared with the row before, row) in order."""
        while self.key[self.best] is not None:
            r = self.best
            yield self.shared[r], self.row[r]
            self._next(r)
            node = (r + self.size) // 2
            while node:
                other = self.lost[node]
                if not self._beats(r, other):
                    r, self.lost[node] = other, r
                node //= 2
            self.best = r


_SPANS = np.dtype([("doc", "<i8"), ("fp", "<i8"), ("start", "<i4"), ("stop", "<i4")])


def _runs(parts: int, length: int, gram: int):
    """Front-coded runs by part, and under part -1 the removed spans that are settled within a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            held.sort()
            out: dict[int, list] = {}
            settled = []
            before = (None, None)
            for part, key, low, high, (doc, fp, at) in held:  # of equal keys the earliest comes first
                if (part, key) == before:
                    settled.append((doc, fp, at - high, at - low + length))
                else:
                    out.setdefault(part, []).append((key, low, high, [(doc, fp, at)]))
                    before = (part, key)
            held.clear()
            spans = np.array(settled, _SPANS).tobytes()
            return pa.RecordBatch.from_arrays([pa.array([-1, *out], pa.int32()), pa.array([spans, *(pack(rows) for rows in out.values())], pa.binary())], names=["part", "run"])

        for batch in text_chunks(batches, column=2):
            data, off = buffer_of(batch.column(2))
            whole = data.tobytes()
            place, hashes, text, low, high = anchors(data, off, length, gram)
            ids, fps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            start = batch.column(3).offsets.to_numpy()
            wanted = batch.column(3).values.to_numpy(zero_copy_only=False)[start[0] : start[-1]].astype(np.int64) + np.repeat(off[:-1], np.diff(start))
            keep = np.isin(place, wanted)
            for a, h, t, lo, hi in zip(place[keep].tolist(), (hashes[keep] % np.uint64(parts)).tolist(), text[keep].tolist(), low[keep].tolist(), high[keep].tolist(), strict=True):
                begin = int(off[t])
                held.append((h, _key(whole, begin, int(off[t + 1]), a, length, gram), a - hi, a - lo, (ids[t], fps[t], a - begin)))
            if len(held) >= RUN_ANCHORS:
                yield flush()
        if held:
            yield flush()

    return run


def _settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for run in batch.column(0):
            rows = np.frombuffer(run.as_buffer(), _SPANS)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(rows[c]).astype(np.int64)) for c in _SPANS.names], names=list(_SPANS.names))


def _group(classes: list[tuple], length: int) -> Iterator[tuple[int, int, int, int]]:
    """Removed (doc, fp, start, end) of the anchors of one gram; classes are (key, low, high, members)."""
    firsts = [min(who) for *_, who in classes]
    for (_, low, high, who), first in zip(classes, firsts, strict=True):
        for doc, fp, at in who:
            if [doc, fp, at] != first:
                yield doc, fp, at - high, at - low + length
    if len(classes) < 2:
        return
    lefts = [key[length + 1 :][::-1] for key, *_ in classes]
    until = [-1] * len(classes)  # where each class's last span of offsets ends
    since = [0] * len(classes)
    for o in range(min(c[1] for c in classes), max(c[2] for c in classes) + 1):
        earliest: dict[bytes, list] = {}
        mine = []
        for k, (key, low, high, _) in enumerate(classes):
            if low <= o <= high:
                s = lefts[k][len(lefts[k]) - o :] + key[: length - o]
                mine.append((k, s))
                if s not in earliest or firsts[k] < earliest[s]:
                    earliest[s] = firsts[k]
        for k, s in mine:
            if earliest[s] < firsts[k]:
                if until[k] < o - 1 or until[k] < 0:
                    if until[k] >= 0:
                        yield firsts[k][0], firsts[k][1], firsts[k][2] - until[k], firsts[k][2] - since[k] + length
                    since[k] = o
                until[k] = o
    for (doc, fp, at), a, b in zip(firsts, since, until, strict=True):
        if b >= 0:
            yield doc, fp, at - b, at - a + length


def _merged(length: int, gram: int):
    def rows(runs: list[bytes]) -> Iterator[tuple]:
        classes: list[tuple] = []
        for shared, (_, key, low, high, who) in LoserTree([unpack(r) for r in runs]):
            if classes and shared == len(key) == len(classes[-1][0]):
                classes[-1][3].extend(who)
                continue
            if classes and shared < gram:
                yield from _group(classes, length)
                classes = []
            classes.append((key, low, high, who))
        if classes:
            yield from _group(classes, length)

    def batched(found: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
        held = []
        for x in found:
            held.append(x)
            if len(held) == 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], names=["doc", "fp", "start", "stop"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held, strict=True)], names=["doc", "fp", "start", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, runs = None, []
        for batch in batches:
            for p, r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if p != part and runs:
                    yield from batched(rows(runs))
                    runs = []
                part = p
                runs.append(r)
        if runs:
            yield from batched(rows(runs))

    return run


def _cut(keep_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, column=2):
            rows = []
            for text, spans in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                whole, at, n = text.encode(), 0, 0
                joined: list[list[int]] = []
                for s in sorted((s["start"], s["stop"]) for s in spans):
                    if joined and s[0] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], s[1])
                    else:
                        joined.append(list(s))
                parts = []
                for a, b in joined:
                    parts.append(whole[at:a])
                    at, n = b, n + b - a
                left = b"".join([*parts, whole[at:]])
                rows.append((n, len(joined), hashlib.sha256(left).hexdigest(), left if keep_bytes else None))
            types = [pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=["doc", "fp", "n_removed", "n_spans", "cut_sha", "kept"])

    return run


def _facts_of(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """docs as (doc, text), a null id last, and the written (doc, fp, n_bytes, sha) of every row."""
    docs = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return docs, written(docs.mapInArrow(_facts, "doc long, fp long, n_bytes long, sha string"), "texts")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, keep_bytes: bool = True) -> DataFrame:
    """Per document that loses bytes: doc, fp (fingerprint of the text), n_removed, n_spans, cut_sha and kept (bytes; null without keep_bytes)."""
    return _repeats(*_facts_of(docs, id_col, text_col), length, gram, keep_bytes)


def _repeats(docs: DataFrame, facts: DataFrame, length: int, gram: int, keep_bytes: bool) -> DataFrame:
    spark = docs.sparkSession
    firsts = facts.where(F.col("n_bytes") >= length).groupBy("sha").agg(F.min(F.struct("doc", "fp")).alias("first"))
    rest = facts.select("doc", "fp", "sha", "n_bytes").distinct().join(firsts, "sha").where((F.col("doc") != F.col("first.doc")) | (F.col("fp") != F.col("first.fp")))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    whole = rest.select("doc", "fp", F.col("n_bytes").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"), nothing.alias("cut_sha"), F.lit(b"" if keep_bytes else None).cast("binary").alias("kept"))
    grams = docs.mapInArrow(_repeated_grams(length, gram), "gram long, doc long, fp long, place int, sure boolean")
    often = grams.withColumn("n", F.count("*").over(Window.partitionBy("gram"))).where("n > 1 or sure")
    wanted = often.groupBy("doc", "fp").agg(F.array_sort(F.collect_set("place")).alias("places"))
    wanted = written(wanted.join(firsts.select(F.col("first.doc").alias("doc"), F.col("first.fp").alias("fp")), ["doc", "fp"], "left_semi"), "anchors")
    texts = docs.mapInArrow(_named, "doc long, fp long, text string").dropDuplicates(["doc", "fp"])
    met = written(wanted.withColumnsRenamed({"doc": "d", "fp": "f"}).join(texts, (F.col("d") == F.col("doc")) & (F.col("f") == F.col("fp"))).select("doc", "fp", "text", "places"), "flagged")
    drop(wanted)
    parts = 4 * max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    runs = written(met.mapInArrow(_runs(parts, length, gram), "part int, run binary"), "runs")
    kind = "doc long, fp long, start long, stop long"
    merged = runs.where("part >= 0").repartition("part").sortWithinPartitions("part").mapInArrow(_merged(length, gram), kind)
    spans = written(merged.unionByName(runs.where("part = -1").select("run").mapInArrow(_settled, kind)), "removed")
    drop(runs)
    by_doc = spans.groupBy("doc", "fp").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = by_doc.withColumnsRenamed({"doc": "d", "fp": "f"}).join(met, (F.col("d") == F.col("doc")) & (F.col("f") == F.col("fp"))).select("doc", "fp", "text", "spans")
    cut = written(rows.mapInArrow(_cut(keep_bytes), "doc long, fp long, n_removed long, n_spans long, cut_sha string, kept binary"), "cut")
    drop(met, spans)
    return cut.unionByName(whole)


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        data, off = buffer_of(batch.column(1))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fingerprints(data, off), pa.int64()), batch.column(1)], names=["doc", "fp", "text"])


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that remain)."""
    keyed, facts = _facts_of(docs, id_col, text_col)
    cut = _repeats(keyed, facts, length, gram, False).drop("kept").withColumnsRenamed({"doc": "d", "fp": "f"})
    both = facts.join(cut, (F.col("d") == F.col("doc")) & (F.col("f") == F.col("fp")), "left")
    zero = F.lit(0).cast("long")
    return both.select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_bytes", F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_spans", zero).alias("n_spans"), F.coalesce("cut_sha", "sha").alias("kept_sha256"))


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 200)) AS k FROM (SELECT *, unnest(range(0, len(h) // 2 - 99)) AS p FROM d WHERE len(h) >= 200)),
later AS (SELECT doc_id, p FROM w QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, p) > 1),
marked AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM (SELECT *, CASE WHEN p <= lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 100 THEN 0 ELSE 1 END AS fresh FROM later)),
runs AS (SELECT doc_id, min(p) AS a, max(p) + 100 AS b FROM marked GROUP BY doc_id, run),
gaps AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM runs),
kept AS (SELECT doc_id, sum(b - a) AS n, count(*) AS m, string_agg(substr(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS rest FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(m, 0) AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""

"""Byte-level BPE encoding and decoding with DuckDB queries inside each partition.

Texts are cut into pieces by the tokenizer's pattern, each distinct piece is merged once, in a recursive DuckDB query
over token-position rows: join neighbours with the merge table, contract each word's leftmost pair of minimum rank, go on
until no word has a pair. For long pieces the recursion keeps one row for each position, so a piece may have any length. Where no merge
makes a token of a lower rank than its parts (checked when the vocabulary is read), further occurrences of that pair in
the word come next anyway, from left to right, and one step contracts them all. Decoding joins the ids with the
vocabulary and aggregates the bytes in order of position.

The pattern is fixed, so the cutting is done on arrays of code points with its rules; another pattern is refused. Pieces
are told apart by a 64-bit fingerprint; the bytes of the tokens found are held against the text, and a chunk in which
they differ is encoded again with pieces told apart by their bytes. Merged pieces are kept between texts of a worker, at
most CACHE_PIECES of them.

Cases: null or empty text gives no tokens and decodes to nothing. Special tokens are never produced. Repeated rows are
kept, null ids are returned as they are, other columns are ignored, empty tables give empty results.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator
from itertools import islice, pairwise

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import buffer_of, table, text_chunks, trim, worker_state
from quern.llm.shingles import word_codes

CACHE_PIECES = 1 << 20
#: Bytes of pieces that one recursive query takes, but for a longer piece; it bounds the query's rows.
QUERY_BYTES = 1 << 17
#: Bytes of a piece up to which a query keeps the rows of every step: QUERY_BYTES * SHORT_PIECE / 2 rows at most.
SHORT_PIECE = 64
#: Chunks of text whose new pieces are merged together, since a query reads the merge table in every step.
CHUNKS = 4
#: Bytes of text in a chunk, but for a longer text.
CHUNK_BYTES = 1 << 20
#: Tokens that one decoding query takes.
QUERY_TOKENS = 1 << 17
#: Largest vocabulary file that is broadcast.
VOCABULARY_BYTES = 64 << 20

#: Fixed value: the only pattern whose pieces piece_starts() cuts.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: One row for each byte at first; g is its place in all words, and n the step. k numbers the rows in order. Hits without a
#: gap between them overlap (runs have one `run`), and every other one is contracted, from the left. @HIT: which
#: occurrences a step takes. Steps add rows (SHORT) or, so that words of any length fit, replace the row of a place (LONG),
#: where t is null once a contraction has taken the place.
MERGE = """
WITH RECURSIVE step(g, w, t, n) @KEY AS (
  SELECT g, w, t, 0 FROM start
  @UNION
  (WITH pairs AS (SELECT g, w, t, n, row_number() OVER o AS k, lead(t) OVER o AS t2, lead(w) OVER o AS w2 FROM step @LIVE WINDOW o AS (ORDER BY g)),
        ranked AS (SELECT pairs.g, pairs.w, pairs.t, pairs.n, pairs.k, m.t AS new FROM pairs LEFT JOIN merges m ON m.pair = CASE WHEN w2 = w THEN pairs.t::BIGINT * 1048576 + t2 END),
        least AS (SELECT w, min(new) AS best, @FIRST AS first FROM ranked GROUP BY w HAVING min(new) IS NOT NULL),
        going AS MATERIALIZED (SELECT g, w, t, n, k, new, coalesce(@HIT, false) AS hit FROM ranked JOIN least USING (w)),
        hits AS (SELECT k, k - row_number() OVER (ORDER BY k) AS run FROM going WHERE hit),
        taken AS MATERIALIZED (SELECT k FROM (SELECT k, k - min(k) OVER (PARTITION BY run) AS i FROM hits) WHERE i % 2 = 0)
   @NEXT)
)
@RESULT
"""
EVERY_HIT = {"@FIRST": "0", "@HIT": "new = best"}
FIRST_HIT = {"@FIRST": "arg_min(k, new::BIGINT * 4294967296 + k)", "@HIT": "k = first"}
SHORT = {"@KEY": "", "@UNION": "UNION ALL", "@LIVE": "", "@NEXT": "SELECT g, w, CASE WHEN a.k IS NULL THEN t ELSE new END, n + 1 FROM going LEFT JOIN taken a ON a.k = going.k WHERE going.k - 1 NOT IN (FROM taken)", "@RESULT": "SELECT w, t FROM step JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) USING (w, n) ORDER BY g"}
LONG = {"@KEY": "USING KEY (g)", "@UNION": "UNION", "@LIVE": "WHERE t IS NOT NULL", "@NEXT": "SELECT g, w, CASE WHEN b.k IS NOT NULL THEN NULL WHEN a.k IS NULL THEN t ELSE new END, n + 1 FROM going LEFT JOIN taken a ON a.k = going.k LEFT JOIN taken b ON b.k = going.k - 1", "@RESULT": "SELECT w, t FROM step WHERE t IS NOT NULL ORDER BY g"}
DUCKDB = {"threads": 1, "memory_limit": "256MB", "temp_directory": ""}
DECODE = "SELECT d, string_agg(s, '' ORDER BY p) AS s FROM tokens JOIN vocabulary USING (t) GROUP BY d ORDER BY d"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        data = f.read(VOCABULARY_BYTES + 1)
    if len(data) > VOCABULARY_BYTES:
        raise ValueError(f"{path} has over {VOCABULARY_BYTES} bytes; a vocabulary is broadcast")
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


def vocabulary(path: str) -> dict:
    """What the workers need of a rank file: token bytes, merges, ids of single bytes, and classes of code points."""
    ranks = load_ranks(path)
    merges = [(ranks[k[:i]], ranks[k[i:]], v) for k, v in ranks.items() for i in range(1, len(k)) if k[:i] in ranks and k[i:] in ranks]
    classes = np.full(0x110000, 3, np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for value, pattern in ((0, r"\s"), (1, r"\p{L}"), (2, r"\p{N}")):
        classes[[ord(c) for c in regex.findall(pattern, everything)]] = value
    m = np.array(merges, np.int64)
    return {"ranks": ranks, "rising": rising(ranks, merges), "pair": m[:, 0] << 20 | m[:, 1], "new": m[:, 2].astype(np.int32), "single": np.array([ranks[bytes([b])] for b in range(256)], np.int32), "classes": classes}


def _passes(tokens: list[bytes], ranks: dict[bytes, int]) -> bool:
    """Whether merging the bytes of the tokens, alone, comes by just these tokens."""
    now = [bytes([c]) for c in b"".join(tokens)]
    while len(now) > len(tokens):
        least, k = min(((ranks[x + y], k) for k, (x, y) in enumerate(pairwise(now)) if x + y in ranks), default=(0, -1))
        if k < 0:
            return False
        now[k : k + 2] = [now[k] + now[k + 1]]
    return now == tokens


def rising(ranks: dict[bytes, int], merges: list[tuple[int, int, int]]) -> bool:
    """Whether a contraction of a word's least pair never makes a pair of a lower rank beside it.

    It would have to make a token of which the whole, with a neighbour, has a lower rank; the merges come by such three
    tokens in a text if they do so in their bytes alone, since nothing has crossed their borders.
    """
    token = {v: k for k, v in ranks.items()}
    parts: dict[int, list[tuple[int, int]]] = {}
    for a, b, new in merges:
        parts.setdefault(new, []).append((a, b))
    for a, b, new in merges:
        for x, y in parts.get(b, ()) if new < b else ():
            if ranks.get(token[a] + token[x], b) >= b and _passes([token[a], token[x], token[y]], ranks):
                return False
        for x, y in parts.get(a, ()) if new < a else ():
            if ranks.get(token[y] + token[b], a) >= a and _passes([token[x], token[y], token[b]], ranks):
                return False
    return True


def piece_starts(points: np.ndarray, text_at: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Where the pieces start, in code points; the texts start at text_at[:-1], and pieces tile them."""
    n = len(points)
    kind = classes[points]
    opens = np.zeros(n + 1, bool)
    opens[text_at] = True
    opens = opens[:n]
    run = opens.copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    attached = np.zeros(n, bool)  # a run of letters, numbers or others that takes the space before it along
    attached[1:] = run[1:] & ~opens[1:] & (points[:-1] == 32) & (kind[1:] != 0)
    start &= ~attached
    closes = np.zeros(n, bool)  # the last white space before something else
    closes[:-1] = (kind[:-1] == 0) & (kind[1:] != 0) & ~opens[1:]
    start |= closes
    quote = np.flatnonzero((points == 39) & run & ~attached)
    if len(quote):
        end = text_at[np.searchsorted(text_at, quote, "right")]
        wide = np.concatenate((points, [0, 0, 0]))
        a, b = wide[quote + 1], wide[quote + 2]
        one = (quote + 1 < end) & np.isin(a, [ord(c) for c in "stmd"])
        two = (quote + 2 < end) & (((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l"))))
        start[quote[one | two] + 1] = False
        start[(quote[two] + 2)] = False
        after = np.concatenate((quote[one] + 2, quote[two] + 3))
        start[after[after < n]] = True
    return np.flatnonzero(start)


class Encoder:
    """Encodes chunks of texts; keeps the pieces that it has merged."""

    def __init__(self, v: dict):
        self.v, self.con = v, None
        self.queries = []
        for rows in (SHORT, LONG):
            query = MERGE
            for mark, sql in (rows | (EVERY_HIT if v["rising"] else FIRST_HIT)).items():
                query = query.replace(mark, sql)
            self.queries.append(query)
        tokens = sorted(v["ranks"].items(), key=lambda x: x[1])
        self.token_size, self.token_at = np.zeros(tokens[-1][1] + 1, np.int64), np.zeros(tokens[-1][1] + 1, np.int64)
        ids = [i for _, i in tokens]
        self.token_size[ids] = [len(b) for b, _ in tokens]
        self.token_at[ids] = np.cumsum(self.token_size[ids]) - self.token_size[ids]
        self.token_bytes = np.frombuffer(b"".join(b for b, _ in tokens), np.uint8)
        self.clear()

    def open(self) -> None:
        if self.con is None:
            self.con = duckdb.connect(config=DUCKDB)
            self.con.register("merges_in", pa.table({"pair": self.v["pair"], "t": self.v["new"]}))
            self.con.execute("CREATE TABLE merges AS SELECT * FROM merges_in")

    def close(self) -> None:
        """Gives the database's memory back; merged pieces stay."""
        if self.con is not None:
            self.con.close()
            self.con = None

    def clear(self) -> None:
        self.codes, self.first, self.size, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece."""
        out: list = [None] * len(pieces)
        left = []
        for k, piece in enumerate(pieces):
            if (whole := self.v["ranks"].get(piece)) is not None:
                out[k] = np.array([whole], np.int32)
            else:
                left.append(k)
        left.sort(key=lambda k: len(pieces[k]) > SHORT_PIECE)
        size = np.array([len(pieces[k]) for k in left], np.int64)
        batch = (np.cumsum(size) - size) // QUERY_BYTES * 2 + (size > SHORT_PIECE)
        for which in np.split(np.array(left, np.int64), np.flatnonzero(np.diff(batch)) + 1) if left else ():
            self._query(pieces, which.tolist(), out)
        return out

    def _query(self, pieces: list[bytes], which: list[int], out: list) -> None:
        self.open()
        sizes = np.array([len(pieces[k]) for k in which], np.int64)
        ends = np.cumsum(sizes)
        w = np.repeat(np.arange(len(which), dtype=np.int32), sizes)
        t = self.v["single"][np.frombuffer(b"".join(pieces[k] for k in which), np.uint8)]
        start = pa.table({"g": np.arange(ends[-1], dtype=np.int32), "w": w, "t": t})
        self.con.register("start", start)
        got = self.con.execute(self.queries[int(sizes.max()) > SHORT_PIECE]).fetchnumpy()
        at = np.searchsorted(got["w"], np.arange(len(which) + 1))
        ids = got["t"].astype(np.int32)
        for k, a, b in zip(which, at[:-1], at[1:], strict=True):
            out[k] = ids[a:b]

    def cut(self, data: np.ndarray, off: np.ndarray) -> tuple:
        """The chunk with the places and fingerprints of its pieces."""
        whole = data.tobytes()
        points = np.frombuffer(whole.decode().encode("utf-32-le"), np.uint32)
        leads = np.flatnonzero((data & 0xC0) != 0x80)  # where each code point starts
        byte_at = np.append(leads[piece_starts(points, np.searchsorted(leads, off), self.v["classes"])], len(data)) if len(data) else np.zeros(1, np.int64)
        return data, off, whole, byte_at, word_codes(data, byte_at[:-1], byte_at[1:])

    def learn(self, chunks: list[tuple]) -> None:
        """Merges the pieces that are new."""
        if len(self.codes) > CACHE_PIECES:
            self.clear()
        new, pieces = [np.zeros(0, np.uint64)], []
        for _, _, whole, byte_at, codes in chunks:
            distinct, example = np.unique(codes, return_index=True)
            unknown = ~np.isin(distinct, self.codes, assume_unique=True)
            new.append(distinct[unknown])
            pieces += [whole[byte_at[k] : byte_at[k + 1]] for k in example[unknown].tolist()]
        codes, which = np.unique(np.concatenate(new), return_index=True)
        if not len(codes):
            return
        merged = self.merge([pieces[k] for k in which.tolist()])
        size = np.array([len(x) for x in merged], np.int64)
        first = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, *merged])
        at = np.searchsorted(self.codes, codes)
        self.codes, self.first, self.size = (np.insert(a, at, b) for a, b in ((self.codes, codes), (self.first, first), (self.size, size)))

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        chunk = self.cut(data, off)
        self.learn([chunk])
        return self.encoded(chunk)

    def encoded(self, chunk: tuple) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a chunk whose pieces are learned, and where each text's ids start."""
        data, off, whole, byte_at, codes = chunk
        at = np.searchsorted(self.codes, codes)
        ids, ends = _gathered(self.ids, self.first[at], self.size[at])
        if not np.array_equal(self.spelled(ids), data):  # two pieces with one fingerprint
            known: dict[bytes, int] = {}
            pieces = [whole[a:b] for a, b in zip(byte_at[:-1].tolist(), byte_at[1:].tolist(), strict=True)]
            piece = np.array([known.setdefault(x, len(known)) for x in pieces])
            merged = self.merge(list(known))
            size = np.array([len(x) for x in merged], np.int64)
            ids, ends = _gathered(np.concatenate(merged), (np.cumsum(size) - size)[piece], size[piece])
        return ids.astype("<u4"), np.concatenate(([0], ends))[np.searchsorted(byte_at[:-1], off)]

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the tokens, one after another."""
        return _gathered(self.token_bytes, self.token_at[ids], self.token_size[ids])[0]


def _gathered(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """values[first[i] : first[i] + size[i]] for every i, one after another, and where each ends."""
    ends = np.cumsum(size)
    return values[np.repeat(first - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)], ends


def _encode(shared, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_state(name, lambda: Encoder(shared.value))
        chunks = text_chunks(batches, limit=CHUNK_BYTES, keep=name)
        try:
            while group := list(islice(chunks, CHUNKS)):
                cut = [encoder.cut(*buffer_of(batch.column(1))) for batch in group]
                encoder.learn(cut)
                for batch, chunk in zip(group, cut, strict=True):
                    ids, at = encoder.encoded(chunk)
                    yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary())], names=["id", "ids"])
        finally:
            encoder.close()
            trim()

    return run


def _decode(shared, name: str = ""):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duckdb.connect(config=DUCKDB)
        try:
            ranks = shared.value["ranks"]
            con.register("vocabulary_in", pa.table({"t": pa.array(list(ranks.values()), pa.uint32()), "s": [k.decode("latin-1") for k in ranks]}))
            con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary_in")
            for batch in text_chunks(batches, limit=4 * QUERY_TOKENS, keep=name):
                data, off = buffer_of(batch.column(1))
                ids = np.frombuffer(data.tobytes(), "<u4")
                text = np.repeat(np.arange(len(off) - 1, dtype=np.int32), np.diff(off) // 4)
                out: list[list[bytes]] = [[] for _ in range(len(off) - 1)]
                for a in range(0, len(ids), QUERY_TOKENS):  # parts of a text follow one another
                    part = slice(a, a + QUERY_TOKENS)
                    con.register("tokens", pa.table({"d": text[part], "p": np.arange(len(ids[part]), dtype=np.int32), "t": ids[part]}))
                    for d, s in con.execute(DECODE).fetchall():
                        out[d].append(s.encode("latin-1"))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([b"".join(x) for x in out], pa.binary())], names=["id", "ids", "decoded"])
        finally:
            con.close()

    return run


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): token ids as little-endian unsigned 32-bit integers in one binary value."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return docs.mapInArrow(_encode(docs.sparkSession.sparkContext.broadcast(vocabulary(path)), f"bpe-{uuid.uuid4().hex}"), f"id {dict(docs.dtypes)['id']}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(id, ids, decoded) of (id, ids)."""
    shared = encoded.sparkSession.sparkContext.broadcast({"ranks": load_ranks(path)})
    return encoded.select("id", F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(_decode(shared), f"id {dict(encoded.dtypes)['id']}, ids binary, decoded binary")


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256 and decoded_sha256."""
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(docs.dtypes)["id"]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(path))
    name = f"bpe-{uuid.uuid4().hex}"
    both = docs.mapInArrow(lambda batches: _decode(shared, name)(_encode(shared, name)(batches)), f"id {kind}, ids binary, decoded binary")
    return both.select(F.col("id").alias("doc_id"), F.expr("bigint(octet_length(ids) / 4)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_byte_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    if public_tokenizers.PATTERN != PATTERN:
        raise ValueError("the tokenizer has another pattern than the one implemented")
    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def oracle(path: str) -> str:
    """DuckDB SQL of op7_byte_bpe() over the rank file at `path`, by the definition: one contraction a step, tokens as hexadecimal bytes.

    Its regular expressions cannot look ahead, so a mark is put before the last white space of a run that something follows.
    """
    space = r"\t-\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
    mark = "chr(63743)"
    pattern = rf"''s|''t|''re|''ve|''m|''ll|''d| ?\p{{L}}+| ?\p{{N}}+| ?[^{space}\p{{L}}\p{{N}}\x{{F8FF}}]+|[{space}]+"
    return f"""
WITH RECURSIVE v AS MATERIALIZED (SELECT hex(from_base64(t)) AS h, r FROM read_csv('{path}', delim = ' ', header = false, quote = '', escape = '', columns = {{'t': 'VARCHAR', 'r': 'BIGINT'}})),
d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '([{space}]+)([{space}][^{space}])', '\\1' || {mark} || '\\2', 'g') AS t FROM documents),
piece AS MATERIALIZED (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) AS i FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS a FROM d)),
word AS MATERIALIZED (SELECT x, hex(encode(x)) AS h, row_number() OVER (ORDER BY x) AS w FROM (SELECT DISTINCT x FROM piece)),
step(w, p, h, n) AS (
  SELECT w, p, substr(h, 2 * p + 1, 2), 0 FROM (SELECT w, h, unnest(range(0, len(h) // 2)) AS p FROM word)
  UNION ALL
  (WITH pairs AS (SELECT *, lead(h) OVER (PARTITION BY w ORDER BY p) AS h2 FROM step),
        ranked AS (SELECT pairs.*, v.r FROM pairs LEFT JOIN v ON v.h = pairs.h || pairs.h2),
        best AS (SELECT w, arg_min(p, r * 4294967296 + p) AS p0 FROM ranked WHERE r IS NOT NULL GROUP BY w),
        near AS (SELECT ranked.*, p0, lag(p) OVER (PARTITION BY w ORDER BY p) AS before FROM ranked JOIN best USING (w))
   SELECT w, p, CASE WHEN p = p0 THEN h || h2 ELSE h END, n + 1 FROM near WHERE before IS DISTINCT FROM p0)
),
coded AS (SELECT w, count(*) AS n, string_agg(printf('%02x%02x%02x%02x', r & 255, (r >> 8) & 255, (r >> 16) & 255, (r >> 24) & 255), '' ORDER BY p) AS ids, string_agg(h, '' ORDER BY p) AS h FROM step JOIN (SELECT w, max(n) AS n FROM step GROUP BY w) USING (w, n) JOIN v USING (h) GROUP BY w),
text AS (SELECT doc_id, sum(n) AS n, string_agg(ids, '' ORDER BY i) AS ids, string_agg(coded.h, '' ORDER BY i) AS h FROM piece JOIN word USING (x) JOIN coded USING (w) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_tokens, sha256(unhex(coalesce(ids, ''))) AS ids_sha256, sha256(unhex(coalesce(h, ''))) AS decoded_sha256 FROM documents LEFT JOIN text USING (doc_id)
"""

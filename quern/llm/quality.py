"""Quality rules: base counts and a distribution test against language references.

Three histograms of a document (character classes, SYMBOLS that junk is made of, common words) are held against the
references of its language by Jensen-Shannon distance (square root of the divergence in bits, 0 to 1). The references are
sums over all documents of the language, so they follow the corpus; each document counts with its shares, not its length,
so that a few very long documents do not make the reference. A text with fewer symbols than its language is not rejected
for that.

Minimum lengths: a histogram over k bins of n things lies at a distance of about sqrt(k / (8 ln 2 n)) from its own source.
Classes and symbols (7 and 9 bins) are judged from GUARD_BYTES bytes that are not white space, common words (some 50 bins)
from GUARD_WORDS words, where that comes to 0.25 for a clean text; the base rules still hold for shorter texts.

Cases: null or empty text has no words and fails the base rules. A text whose language is null or not listed is held
against the classes and symbols of every reference and passes if one accepts it; its words are not judged. Rows are judged
one by one, so null and repeated ids are kept as they are and repeated rows count twice in the references; other columns
are ignored, whatever their names (`accepted` returns them); an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import buffer_of, table, text_chunks

MIN_WORDS = 50
GUARD_BYTES = 150
GUARD_WORDS = 150
#: Largest distances at which a document still looks like its language. On sf0.1, documents labelled as good lie at 0.30, 0.10
#: and 0.24 at most (words from 150 words on).
MAX_CLASS_DISTANCE = 0.32
MAX_SYMBOL_DISTANCE = 0.14
MAX_WORD_DISTANCE = 0.32
#: Common function words of each language with a reference.
COMMON_WORDS = {
    "en": "the of and to in a is that for it as was with be by on not he this are or his from at which but have an had they you were their one all we can her has there been if more when will would who so no".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei einer um am sind noch wie einem über einen so zum war haben nur oder aber vor zur bis".split(),
    "fr": "de la le et les des en un du une que est pour qui dans a par plus pas au sur ne se ce il sont avec son aux ou mais comme cette on leur été être nous elle ces sans même fait si tout".split(),
    "es": "de la que el en y a los del se las por un para con no una su al lo como más pero sus le ya o este sí porque esta entre cuando muy sin sobre también me hasta hay donde quien desde todo".split(),
}
#: Classes of bytes: lower case, upper case, digit, white space, sentence punctuation, other ASCII, part of another code point.
_CLASSES = 7
_CLASS = np.full(256, 5, np.uint8)
_CLASS[128:] = 6
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[[ord(c) for c in ".,;:'\"!?()-"]] = 4
#: Symbols that junk is made of, each with a bin of its own; the last bin is every other byte that is not white space.
SYMBOLS = "#*$%&|<>"
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[[ord(c) for c in SYMBOLS]] = np.arange(1, len(SYMBOLS) + 1)
_PLACES = {lang: {w.encode(): k for k, w in enumerate(words)} for lang, words in COMMON_WORDS.items()}


_STRIP = b".,;:!?\"'()"


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int]:
    """n_dup_lines and n_repeat_words."""
    seen: set[bytes] = set()
    dup = 0
    for line in text.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip():
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:], strict=False))
    repeated = until = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        for k, w in enumerate(windows):
            if often[w] > 1:
                repeated += k + 3 - max(until, k)
                until = k + 3
    return dup, repeated


def _between(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))[off])


def _histograms(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Counts of each character class in each text."""
    kinds = _CLASS[data]
    return np.stack([_between(kinds == k, off) for k in range(_CLASSES)], 1)


def _symbols(data: np.ndarray, off: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Counts of each of SYMBOLS in each text, and at the end of all other bytes but white space."""
    at = np.flatnonzero(_SYMBOL[data])
    row = np.searchsorted(off, at, "right") - 1
    n, bins = len(off) - 1, len(SYMBOLS) + 1
    out = np.bincount(row * bins + _SYMBOL[data[at]] - 1, minlength=n * bins).reshape(n, bins)
    out[:, -1] = classes.sum(1) - classes[:, 3] - out.sum(1)
    return out


def _common(words: list[bytes], lang: str) -> np.ndarray:
    """Counts of the language's common words, and at the end of all other words."""
    places = _PLACES[lang]
    out = np.zeros(len(places) + 1, np.int64)
    known = 0
    for w, n in Counter(words).items():
        if len(w) <= 16 and (k := places.get(w.lower().strip(_STRIP))) is not None:
            out[k] += n
            known += n
    out[-1] = len(words) - known
    return out


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two histograms of counts: root of the divergence in bits."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(0.0, d / 2)))


_SHARE = 1_000_000
#: Where the symbols start in a reference, counted from its end.
_MARKS = -len(SYMBOLS) - 1


def _reference_sums(guard_bytes: int, guard_words: int):
    """Per task, language and bin: the sum of the documents' shares, in millionths, so that any order of adding gives the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {lang: np.zeros(_CLASSES + len(words) + 1 + len(SYMBOLS) + 1, np.int64) for lang, words in COMMON_WORDS.items()}
        for batch in text_chunks(batches):
            data, off = buffer_of(batch.column(0))
            whole, classes = data.tobytes(), _histograms(data, off)
            marks = _symbols(data, off, classes)
            for k, lang in enumerate(batch.column(1).to_pylist()):
                if lang not in sums:
                    continue
                if marks[k].sum() >= guard_bytes:
                    sums[lang][:_CLASSES] += classes[k] * _SHARE // classes[k].sum()
                    sums[lang][_MARKS:] += marks[k] * _SHARE // marks[k].sum()
                if len(words := whole[off[k] : off[k + 1]].split()) >= guard_words:
                    sums[lang][_CLASSES:_MARKS] += _common(words, lang) * _SHARE // len(words)
        rows = [(lang, k, int(v)) for lang, values in sums.items() for k, v in enumerate(values) if v]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema=pa.schema([("lang", pa.string()), ("bin", pa.int64()), ("share", pa.int64())]))

    return run


class Rules:
    """References of the listed languages, and the limits."""

    def __init__(self, docs: DataFrame, text_col: str, lang_col: str, guard_bytes: int, guard_words: int, min_words: int, most_class: float, most_symbol: float, most_word: float):
        self.guard_bytes, self.guard_words, self.min_words = guard_bytes, guard_words, min_words
        self.most_class, self.most_symbol, self.most_word = most_class, most_symbol, most_word
        docs = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
        sums = {lang: np.zeros(_CLASSES + len(words) + 1 + len(SYMBOLS) + 1) for lang, words in COMMON_WORDS.items()}
        # At most (languages x bins) rows reach the driver.
        for lang, k, v in docs.mapInArrow(_reference_sums(guard_bytes, guard_words), "lang string, bin long, share long").groupBy("lang", "bin").agg(F.sum("share")).collect():
            sums[lang][k] = v
        self.known = {lang: v for lang, v in sums.items() if v[:_CLASSES].any()}
        self.words = {lang: v[_CLASSES:_MARKS] for lang, v in sums.items() if v[_CLASSES:_MARKS].any()}

    def judge(self, texts: pa.Array, langs: list[str | None]) -> Iterator[tuple]:
        """Of each text: the base counts, base_failed, kept and the three distances (null where not judged)."""
        data, off = buffer_of(texts)
        whole, classes = data.tobytes(), _histograms(data, off)
        marks = _symbols(data, off, classes)
        chars = _between(((data & 0xC0) != 0x80) & (_CLASS[data] != 3), off)
        symbols = _between(_SYMBOL[data] > 0, off)
        for k, lang in enumerate(langs):
            text = whole[off[k] : off[k + 1]]
            words = text.split()
            dup, repeated = base_counts(text, words)
            failed = len(words) < self.min_words or 100 * repeated > 50 * len(words)
            by_class = by_symbol = by_word = None
            good = True
            if marks[k].sum() >= self.guard_bytes and (like := [self.known[lang]] if lang in self.known else [] if lang in COMMON_WORDS else list(self.known.values())):
                found = [(distance(classes[k], r[:_CLASSES]), distance(marks[k], r[_MARKS:]), _fewer(marks[k], r[_MARKS:])) for r in like]
                by_class, by_symbol = min(x[0] for x in found), min(x[1] for x in found)
                good = any(c <= self.most_class and (fewer or m <= self.most_symbol) for c, m, fewer in found)
            if lang in self.words and len(words) >= self.guard_words:
                by_word = distance(_common(words, lang), self.words[lang])
                good = good and by_word <= self.most_word
            yield len(words), int(chars[k]), int(symbols[k]), dup, repeated, failed, good and not failed, by_class, by_symbol, by_word


def _fewer(marks: np.ndarray, reference: np.ndarray) -> bool:
    """Whether a text has no larger share of symbols than its language; a large distance then speaks for it."""
    return marks[-1] * reference.sum() >= reference[-1] * marks.sum()


def _judged(rules: Rules):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches):
            rows = list(rules.judge(batch.column(1), batch.column(2).to_pylist()))
            types = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True))], names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "class_distance", "symbol_distance", "word_distance"])

    return run


def _kept(rules: Rules, text: int, lang: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_chunks(batches, text):
            yield batch.filter(pa.array([x[6] for x in rules.judge(batch.column(text), batch.column(lang).to_pylist())], pa.bool_()))

    return run


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", guard_bytes: int = GUARD_BYTES, guard_words: int = GUARD_WORDS, min_words: int = MIN_WORDS, most_class: float = MAX_CLASS_DISTANCE, most_symbol: float = MAX_SYMBOL_DISTANCE, most_word: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Per document: doc_id, the base counts, base_failed, kept, and class_distance, symbol_distance and word_distance (null where not judged)."""
    rules = Rules(docs, text_col, lang_col, guard_bytes, guard_words, min_words, most_class, most_symbol, most_word)
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    kind = dict(docs.dtypes)["id"]
    return docs.mapInArrow(_judged(rules), f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, class_distance double, symbol_distance double, word_distance double")


def accepted(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs that quality() keeps, with all their columns."""
    rules = Rules(docs, text_col, lang_col, GUARD_BYTES, GUARD_WORDS, MIN_WORDS, MAX_CLASS_DISTANCE, MAX_SYMBOL_DISTANCE, MAX_WORD_DISTANCE)
    return docs.mapInArrow(_kept(rules, docs.columns.index(text_col), docs.columns.index(lang_col)), docs.schema)


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents")).drop("class_distance", "symbol_distance", "word_distance")


_LISTED = ", ".join(f"('{lang}', '{w}')" for lang, words in COMMON_WORDS.items() for w in dict.fromkeys(words))
ORACLE = (
    r"""
WITH common(lang, bin) AS (VALUES @LISTED),
d AS (SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY 1),
word AS (SELECT doc_id, lang, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM d),
tri AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a) AS n FROM (SELECT doc_id, i, [x, lead(x) OVER p, lead(x, 2) OVER p] AS a, lead(x, 2) OVER p AS z FROM word WINDOW p AS (PARTITION BY doc_id ORDER BY i)) WHERE z IS NOT NULL),
rep AS (SELECT doc_id, count(DISTINCT j) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS j FROM tri WHERE n > 1) GROUP BY 1),
base AS (SELECT d.doc_id, d.lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN rep USING (doc_id)),
marks(bin) AS (VALUES ('#'), ('*'), ('$'), ('%'), ('&'), ('|'), ('<'), ('>')),
solid AS (SELECT *, regexp_replace(t, '[^\x00-\x7F]', '', 'g') AS n, length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) AS e FROM d WHERE strlen(t) - length(regexp_replace(t, '[^\x20\x09-\x0D]', '', 'g')) >= @BYTES),
class AS (SELECT doc_id, lang, 'c' AS kind, unnest(['lower', 'upper', 'digit', 'space', 'mark', 'other', 'wide']) AS bin, unnest([a, b, c, e, f, length(n) - a - b - c - e - f, strlen(t) - length(n)]) AS n
          FROM (SELECT *, length(regexp_replace(t, '[^a-z]', '', 'g')) AS a, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS b, length(regexp_replace(t, '[^0-9]', '', 'g')) AS c,
                length(regexp_replace(t, '[^.,;:''"!?()-]', '', 'g')) AS f FROM solid)),
symbol AS (SELECT doc_id, lang, bin, length(t) - length(replace(t, bin, '')) AS n FROM solid, marks),
symbols AS (SELECT doc_id, lang, 's' AS kind, bin, n FROM symbol UNION ALL SELECT doc_id, any_value(solid.lang), 's', '', any_value(strlen(t) - e) - sum(symbol.n) FROM solid JOIN symbol USING (doc_id) GROUP BY 1),
hits AS (SELECT doc_id, word.lang, coalesce(common.bin, '') AS bin, count(*) AS n
         FROM word LEFT JOIN common ON common.lang = word.lang AND strlen(x) <= 16 AND common.bin = trim(translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '.,;:!?"''()')
         WHERE word.lang IN (SELECT lang FROM common) AND doc_id IN (SELECT doc_id FROM d WHERE len(w) >= @GUARD) GROUP BY 1, 2, 3),
counts AS (FROM class WHERE n > 0 UNION ALL FROM symbols WHERE n > 0 UNION ALL SELECT doc_id, lang, 'w', bin, n FROM hits),
shares AS (SELECT *, sum(n) OVER (PARTITION BY doc_id, kind) AS total FROM counts),
sums AS (SELECT lang, kind, bin, CAST(sum(n * 1000000 // total) AS DOUBLE) AS v FROM shares WHERE lang IN (SELECT lang FROM common) GROUP BY 1, 2, 3),
grid AS (SELECT DISTINCT lang, kind, bin FROM (SELECT DISTINCT lang, kind FROM sums) JOIN (SELECT kind, bin, NULL AS own FROM (SELECT DISTINCT kind, bin FROM counts WHERE kind <> 'w') UNION ALL SELECT 'w', bin, lang FROM common UNION ALL SELECT 'w', '', NULL) b USING (kind) WHERE own IS NULL OR own = lang),
ref AS (SELECT lang, kind, bin, coalesce(v, 0) / sum(v) OVER (PARTITION BY lang, kind) AS q FROM grid LEFT JOIN sums USING (lang, kind, bin)),
pairs AS (SELECT x.doc_id, ref.lang, ref.kind, ref.bin, q, coalesce(n / total, 0) AS p FROM (SELECT DISTINCT doc_id, lang, kind FROM shares) x
          JOIN ref ON ref.kind = x.kind AND (ref.lang = x.lang OR coalesce(x.lang NOT IN (SELECT lang FROM common), true)) LEFT JOIN shares s ON s.doc_id = x.doc_id AND s.kind = ref.kind AND s.bin = ref.bin),
js AS (SELECT doc_id, lang, kind, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS far, bool_or(bin = '' AND p >= q) AS fewer FROM pairs GROUP BY 1, 2, 3),
near AS (SELECT doc_id, lang, bool_and(CASE kind WHEN 'c' THEN far <= @CLASS WHEN 's' THEN fewer OR far <= @SYMBOL ELSE far <= @WORD END) AS good FROM js GROUP BY 1, 2),
verdict AS (SELECT doc_id, bool_or(good) AS good FROM near GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(good, true) AS kept
FROM base LEFT JOIN verdict USING (doc_id)
""".replace("@LISTED", _LISTED)
    .replace("@BYTES", str(GUARD_BYTES))
    .replace("@GUARD", str(GUARD_WORDS))
    .replace("@CLASS", str(MAX_CLASS_DISTANCE))
    .replace("@SYMBOL", str(MAX_SYMBOL_DISTANCE))
    .replace("@WORD", str(MAX_WORD_DISTANCE))
)

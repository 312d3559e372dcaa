"""Toxicity by cumulative-link ordinal regression over sparse words.

A document's features are its distinct words and word beginnings of PREFIXES bytes (hashed into BUCKETS);
P(grade > k) = sigmoid(w . x - theta_k), with one weight vector w for all thresholds theta_0 < theta_1 < ..., so a word
moves a document along one scale of severity. Words are evidence for severity or none, w >= 0: a document is not cleared
by harmless words around a toxic one. Weights and thresholds are the maximum of the likelihood (rows of a grade above 0
weigh MISS_COST) less an L1 penalty, found
in numpy by coordinate descent with a working set of the features that break the optimality conditions most, until none
does; every feature takes part. They are fitted to at most SAMPLE_DOCS labelled documents, chosen by a hash of the id, and
applied to all documents. Weights are multiples of 2^-20, so that a score does not depend on the order of adding.

Grades come from the labels: 0 not toxic, 1 toxic, 2 toxic in a document that is labelled as of low quality too (the only
order of harm that two binary labels give; pass `grade` for another). The output is the expected grade.

Cases: null or empty text has no features and gets the grade of the thresholds; with no usable labels every severity is 0.
Labels with a null id or toxic value, and labels without a document, are left out; a null quality counts as not low;
repeated labels count repeatedly. Rows are kept as they are; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import buffer_of, least_rows, table, text_chunks
from quern.llm.shingles import _LOWER, mix, word_bounds, word_codes

BUCKETS = 1 << 20
SAMPLE_DOCS = 6000
PENALTY = 1e-3
#: How much a row of a grade above 0 weighs in the likelihood: a missed document costs that many false alarms.
MISS_COST = 1.5
PREFIXES = (4, 6, 8)
#: Features that join the working set at once; a matter of speed only.
JOINING = 256
_UNIT = 1 << 20
_BREAK = np.ones(256, bool)
_BREAK[48:58] = _BREAK[97:123] = _BREAK[128:] = False


def features(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word buckets of all texts, and where each text's start."""
    data = _LOWER[data]
    starts, ends = word_bounds(data, off, _BREAK)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
    doc = np.searchsorted(off, starts, "right") - 1
    pairs = []
    for size in (None, *PREFIXES):
        long = slice(None) if size is None else np.flatnonzero(ends - starts > size)
        codes = word_codes(data, starts[long], ends[long] if size is None else starts[long] + size)
        codes = mix(codes + np.uint64(size or 0)) >> np.uint64(44)
        pairs.append(np.unique(doc[long] * BUCKETS + codes.astype(np.int64)))
    pairs = np.unique(np.concatenate(pairs))
    return pairs % BUCKETS, np.searchsorted(pairs, np.arange(len(off)) * BUCKETS)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Scale:
    """Weights (by bucket, in units of 2^-20) and ascending thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = np.rint(weights * _UNIT).astype(np.int32), thresholds

    def scores(self, buckets: np.ndarray, at: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(self.weights[buckets], dtype=np.int64)))
        return (sums[at[1:]] - sums[at[:-1]]) / _UNIT

    def above(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for each k, by row."""
        return _sigmoid(score[:, None] - self.thresholds)


class Likelihood:
    """Of grades, given scores and thresholds: probabilities at the edges of each row's grade."""

    def __init__(self, grade: np.ndarray, weight: np.ndarray, theta: np.ndarray):
        self.grade, self.weight = grade, weight
        self.move(theta)

    def move(self, theta: np.ndarray) -> None:
        self.theta = theta
        edges = np.concatenate(([-np.inf], theta, [np.inf]))
        self.low, self.high = edges[self.grade], edges[self.grade + 1]

    def ends(self, score: np.ndarray, rows: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """P(grade >= y) and P(grade > y) of rows with grade y."""
        return _sigmoid(score - self.low[rows]), _sigmoid(score - self.high[rows])

    def slopes(self, score: np.ndarray) -> np.ndarray:
        """Of the negative log likelihood, by each row's score."""
        at_least, more = self.ends(score)
        return self.weight * (at_least + more - 1)

    def threshold_slopes(self, score: np.ndarray) -> np.ndarray:
        """Of the negative log likelihood, by each threshold."""
        at_least, more = self.ends(score)
        mass = np.maximum(at_least - more, 1e-12) / self.weight
        up, down = at_least * (1 - at_least) / mass, more * (1 - more) / mass
        return np.array([up[self.grade == k + 1].sum() - down[self.grade == k].sum() for k in range(len(self.theta))])

    def fit_thresholds(self, score: np.ndarray) -> None:
        """One Newton step on each threshold, kept in order."""
        for k in range(len(self.theta)):
            p = _sigmoid(score - self.theta[k])
            step = self.threshold_slopes(score)[k] / ((self.weight * p * (1 - p)).sum() + 1e-9)
            theta = self.theta.copy()
            theta[k] -= np.clip(step, -1, 1)
            self.move(np.maximum.accumulate(theta + 1e-6 * np.arange(len(theta))))


def fit_scale(at: np.ndarray, buckets: np.ndarray, grade: np.ndarray, grades: int, penalty: float = PENALTY, miss_cost: float = MISS_COST, rounds: int = 400, tolerance: float = 1e-3) -> Scale:
    """Rows have buckets[at[i]:at[i + 1]] and grade[i] in 0..grades-1. Ends when no condition is broken by over tolerance * penalty * rows."""
    n = len(grade)
    used, column = np.unique(buckets, return_inverse=True)
    row = np.repeat(np.arange(n), np.diff(at))
    order = np.argsort(column, kind="stable")
    by_column, start = row[order], np.searchsorted(column[order], np.arange(len(used) + 1))
    weight = np.where(grade > 0, miss_cost, 1.0)
    share = np.array([(weight * (grade > k)).sum() / weight.sum() for k in range(grades - 1)]).clip(1e-3, 1 - 1e-3)
    model = Likelihood(grade, weight, np.maximum.accumulate(np.log((1 - share) / share) + 1e-6 * np.arange(grades - 1)))
    w, score, bound = np.zeros(len(used)), np.zeros(n), penalty * n
    for _ in range(rounds):
        slope = np.bincount(column, model.slopes(score)[row], minlength=len(used))
        broken = np.where(w > 0, np.abs(slope + bound), np.maximum(0, -slope - bound))
        worst = np.argsort(-broken, kind="stable")[:JOINING]
        joining = worst[broken[worst] > tolerance * bound]
        if not len(joining) and np.abs(model.threshold_slopes(score)).max() <= tolerance * bound:
            break
        for j in [*joining.tolist(), *np.flatnonzero(w).tolist()]:
            r = by_column[start[j] : start[j + 1]]
            at_least, more = model.ends(score[r], r)
            curve = (weight[r] * (at_least * (1 - at_least) + more * (1 - more))).sum() + 1e-6
            step = np.clip(-((weight[r] * (at_least + more - 1)).sum() + bound) / curve, -1, 1)
            new = max(0.0, w[j] + step)
            score[r] += new - w[j]
            w[j] = new
        model.fit_thresholds(score)
    weights = np.zeros(BUCKETS)
    weights[used] = w
    return Scale(weights, model.theta)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_chunks(batches):
        buckets, at = features(*buffer_of(batch.column(1)))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([buckets[a:b].astype(np.int32) for a, b in zip(at[:-1], at[1:], strict=True)], pa.list_(pa.int32()))], names=["id", "grade", "buckets"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, grade: F.Column, sample_docs: int) -> Scale | None:
    """Fits the scale to at most sample_docs rows of labels that have a document."""
    key = F.xxhash64(F.col(id_col).cast("string"))
    chosen = labels.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("label_id"), grade.cast("int").alias("grade"), key.alias("key")).where("grade is not null")
    chosen = least_rows(chosen, "key", sample_docs).drop("key")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), F.col("id") == F.col("label_id")).select(F.col("id").cast("string"), "text", "grade")
    got = rows.mapInArrow(_featured, "id string, grade int, buckets array<int>").orderBy("id", "grade").toArrow()
    if not got.num_rows:
        return None
    grades = got.column("grade").to_numpy()
    lists = got.column("buckets").combine_chunks()
    at = lists.offsets.to_numpy().astype(np.int64)
    return fit_scale(at - at[0], lists.flatten().to_numpy().astype(np.int64), grades, max(2, int(grades.max()) + 1))


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scale = shared.value
        for batch in text_chunks(batches):
            n = batch.num_rows
            if scale is None:
                severity, grade = np.zeros(n), np.zeros(n, np.int64)
            else:
                buckets, at = features(*buffer_of(batch.column(1)))
                above = scale.above(scale.scores(buckets, at))
                severity, grade = above.sum(1), (above >= 0.5).sum(1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(severity), pa.array(grade, pa.int64()), pa.array(grade > 0)], names=["doc_id", "severity", "grade", "toxic"])

    return run


def severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", grade: F.Column | None = None, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document: doc_id, severity (expected grade), grade (thresholds passed with probability 1/2) and toxic (grade > 0)."""
    grade = F.when(F.col("toxic") == 1, F.when(F.col("quality") == 0, 2).otherwise(1)).when(F.col("toxic") == 0, 0) if grade is None else grade
    scale = fit(docs, labels, id_col, text_col, grade, sample_docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scored(docs.sparkSession.sparkContext.broadcast(scale)), f"doc_id {dict(rows.dtypes)['id']}, severity double, grade long, toxic boolean")


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    return severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))

"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

A forward and a backward layer read the bytes; at every position both states give a probability for each language, and a
document's probabilities are the mean over its positions. Training is backpropagation through time over windows of a
bounded sample of labelled rows (SAMPLE_DOCS documents, one window each, chosen by a hash of the id). Prediction reads the
whole text, cut into segments of SEGMENT bytes that are worked on side by side. Each layer reads HALO bytes before its
first label (the backward layer HALO bytes behind the last), so that states do not start from zero inside a text; every
byte is labelled in exactly one segment.

Cases: null text, and text without a letter, is `und` with score 0; so is everything when no row is labelled. Rows with a
null id are predicted, not learned from and not held out. Equal texts get equal predictions. Other columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.shared import buffer_of, least_rows, table, text_chunks

SAMPLE_DOCS = 6000
WINDOW = 64
SEGMENT = 512
#: Bytes that warm a state up where a text is cut; as long as a training window.
HALO = 64
HIDDEN = 8
#: Segments that one step of the network takes together.
TOGETHER = 2048
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = True


class Network:
    """Weights, by name; `langs` are the labels in order. Gates: update, reset, candidate."""

    def __init__(self, langs: list[str], hidden: int = HIDDEN, seed: int = 7):
        rnd = np.random.default_rng(seed)
        self.langs, self.h = langs, hidden
        self.p: dict[str, np.ndarray] = {}
        for d in "fb":
            self.p[f"x{d}"] = rnd.normal(0, 0.3, (256, 3 * hidden))
            self.p[f"u{d}"] = rnd.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden))
            self.p[f"v{d}"] = rnd.normal(0, 0.5 / np.sqrt(hidden), (hidden, len(langs)))
        self.p["b"] = np.zeros(len(langs))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def _forward(self, x: np.ndarray, d: str) -> tuple[np.ndarray, list]:
        """States after each of the bytes x (time, batch), and what the way back needs."""
        n, (u, w) = self.h, (self.p[f"u{d}"], self.p[f"x{d}"])
        h = np.zeros((x.shape[1], n), np.float32)
        states, kept = np.empty((*x.shape, n), np.float32), []
        for t, b in enumerate(x):
            a, g = w[b], h @ u
            zr = 0.5 + 0.5 * np.tanh(0.5 * (a[:, : 2 * n] + g[:, : 2 * n]))
            z, r = zr[:, :n], zr[:, n:]
            c = np.tanh(a[:, 2 * n :] + r * g[:, 2 * n :])
            kept.append((h, z, r, c, g[:, 2 * n :]))
            h = h + z * (c - h)
            states[t] = h
        return states, kept

    def _backward(self, x: np.ndarray, d: str, grad: np.ndarray, kept: list, out: dict[str, np.ndarray]) -> None:
        """Adds the gradients of one direction, given those of its states."""
        n, u = self.h, self.p[f"u{d}"]
        dx, du, dh = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(u), np.zeros_like(grad[0])
        for t in range(len(x) - 1, -1, -1):
            h, z, r, c, g = kept[t]
            dh = dh + grad[t]
            dc = dh * z * (1 - c * c)
            da = np.concatenate((dh * (c - h) * z * (1 - z), dc * g * r * (1 - r), dc), 1)
            dg = np.concatenate((da[:, : 2 * n], dc * r), 1)
            du += h.T @ dg
            np.add.at(dx, x[t], da)
            dh = dh * (1 - z) + dg @ u.T
        out[f"x{d}"], out[f"u{d}"] = dx, du

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions of windows x (time, batch) with labels y, and its gradients."""
        back = x[::-1]
        hf, kf = self._forward(x, "f")
        hb, kb = self._forward(back, "b")
        logits = hf @ self.p["vf"] + hb[::-1] @ self.p["vb"] + self.p["b"]
        logits -= logits.max(2, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(2, keepdims=True)
        loss = -float(np.log(prob[:, np.arange(x.shape[1]), y] + 1e-9).mean())
        prob[:, np.arange(x.shape[1]), y] -= 1
        prob /= x.size
        g = {"b": prob.sum((0, 1)), "vf": np.einsum("tbh,tbc->hc", hf, prob), "vb": np.einsum("tbh,tbc->hc", hb[::-1], prob)}
        self._backward(x, "f", prob @ self.p["vf"].T, kf, g)
        self._backward(back, "b", (prob @ self.p["vb"].T)[::-1], kb, g)
        return loss, g

    def train(self, x: np.ndarray, y: np.ndarray, steps: int = 500, batch: int = 128, rate: float = 0.02, seed: int = 11) -> None:
        """Adam over random batches of the windows x (rows, time)."""
        rnd = np.random.default_rng(seed)
        m, s = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        for i in range(1, steps + 1):
            pick = rnd.integers(0, len(x), batch)
            _, g = self.gradients(np.ascontiguousarray(x[pick].T), y[pick])
            size = np.sqrt(sum(float((v * v).sum()) for v in g.values()))
            now = rate * min(1.0, 1.5 * (1 - i / (steps + 1)))
            for k, v in g.items():
                v = v / max(1.0, size)
                m[k] += 0.1 * (v - m[k])
                s[k] += 0.01 * (v * v - s[k])
                self.p[k] -= (now * (m[k] / (1 - 0.9**i)) / (np.sqrt(s[k] / (1 - 0.99**i)) + 1e-8)).astype(np.float32)

    def _run(self, x: np.ndarray, d: str) -> np.ndarray:
        """Logits (time, languages, batch) of one direction; one column for each sequence, gates folded for tanh."""
        n, half = self.h, np.ones(3 * self.h, np.float32)
        half[: 2 * n] = half[2 * n :] = 0.5
        w = self.p[f"x{d}"].T.copy()
        w[: 2 * n] *= 0.5
        u, v = np.ascontiguousarray(self.p[f"u{d}"].T * half[:, None]), np.ascontiguousarray(self.p[f"v{d}"].T)
        size = x.shape[1]
        h, a, g = np.zeros((n, size), np.float32), np.empty((3 * n, size), np.float32), np.empty((3 * n, size), np.float32)
        e = np.empty((n, size), np.float32)
        out = np.empty((len(x), len(self.langs), size), np.float32)
        for t, b in enumerate(x):
            np.take(w, b, axis=1, out=a, mode="clip")
            np.matmul(u, h, out=g)
            a[: 2 * n] += g[: 2 * n]
            np.tanh(a[: 2 * n], out=g[: 2 * n])
            g[: 2 * n] += 1
            g[n : 2 * n] *= g[2 * n :]
            a[2 * n :] += g[n : 2 * n]
            np.tanh(a[2 * n :], out=e)
            e -= h
            e *= g[:n]
            e *= 0.5
            h += e
            np.matmul(v, h, out=out[t])
        return out

    def label(self, data: np.ndarray, off: np.ndarray, segment: int = SEGMENT, halo: int = HALO) -> np.ndarray:
        """Mean probability of each language over the positions of each text; zeros for an empty text."""
        total = np.zeros((len(off) - 1, len(self.langs)))
        length = np.diff(off)
        per = -(-length // segment)
        owner = np.repeat(np.arange(len(length)), per)
        k = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
        first = off[owner] + k * segment
        last = np.minimum(off[owner + 1], first + segment)
        start, stop = np.maximum(off[owner], first - halo), np.minimum(off[owner + 1], last + halo)
        order = np.argsort(start - stop, kind="stable")
        for i in range(0, len(order), TOGETHER):
            pick = order[i : i + TOGETHER]
            s, n = start[pick], (stop - start)[pick]
            t = np.arange(n[0])[:, None]
            labelled = (t >= first[pick] - s) & (t < last[pick] - s)
            ahead = data[np.minimum(s + t, len(data) - 1)].astype(np.intp)
            behind = data[np.maximum(s + n - 1 - t, 0)].astype(np.intp)
            logits = self._run(ahead, "f")
            back = self._run(behind, "b")
            logits += np.take_along_axis(back, np.where(t < n, n - 1 - t, t)[:, None, :], 0)
            logits += self.p["b"][:, None]
            np.exp(np.clip(logits, -30, 30, out=logits), out=logits)
            logits /= logits.sum(1, keepdims=True)
            logits *= labelled[:, None, :]
            np.add.at(total, owner[pick], logits.sum(0, dtype=np.float64).T)
        return total / np.maximum(length, 1)[:, None]


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, learn: F.Column, sample_docs: int = SAMPLE_DOCS) -> Network | None:
    """Trains on one window from each of at most sample_docs rows where `learn` holds; None if there is no such row."""
    key = F.xxhash64(F.col(id_col).cast("string"))
    text = F.col(text_col).cast("string")
    at = F.pmod(F.xxhash64(key), F.greatest(F.lit(1), F.length(text) - WINDOW)).cast("int") + 1
    rows = docs.where(learn & F.col(lang_col).isNotNull() & text.rlike(r"\p{L}")).select(key.alias("key"), F.substring(text, at, F.lit(2 * WINDOW)).alias("t"), F.col(lang_col).cast("string").alias("lang"))
    rows = least_rows(rows, "key", sample_docs).toPandas()
    if not len(rows):
        return None
    langs = sorted(set(rows["lang"]))
    x = np.zeros((len(rows), WINDOW), np.uint8)
    for k, t in enumerate(rows["t"]):
        b = t.encode()
        x[k] = np.frombuffer((b * (1 + WINDOW // len(b)))[:WINDOW], np.uint8)
    net = Network(langs)
    net.train(x, np.array([langs.index(v) for v in rows["lang"]]))
    return net


def _predict(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in text_chunks(batches):
            data, off = buffer_of(batch.column(1))
            sums = np.concatenate(([0], np.cumsum(_ALPHA[data], dtype=np.int64)))[off]
            letters = np.diff(sums) > 0
            for k in np.flatnonzero(~letters & (np.diff(off) > 0)):
                letters[k] = any(c.isalpha() for c in batch.column(1)[int(k)].as_py())
            if net is None:
                best, score, names = np.zeros(len(letters), int), np.zeros(len(letters)), ["und"]
            else:
                prob = net.label(data, off)
                best, score, names = prob.argmax(1), np.clip(prob.max(1), 0, 1), net.langs
            lang = [names[b] if ok else "und" for b, ok in zip(best, letters, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(lang), pa.array(np.where(letters, score, 0.0))], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per document: doc_id, held_out (crc32 of the id as text, mod 4, is 2: not learned from), lang_pred and score."""
    remainder = F.crc32(F.col(id_col).cast("string")) % 4
    held = F.coalesce(remainder == 2, F.lit(False))
    net = fit(docs, id_col, text_col, lang_col, remainder != 2, sample_docs)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    return rows.mapInArrow(_predict(shared), f"doc_id {dict(rows.dtypes)['id']}, held_out boolean, lang_pred string, score double")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))

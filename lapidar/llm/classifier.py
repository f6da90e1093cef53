"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapidar.llm.matrix_sum import matrix_sum
from lapidar.llm.textkernel import PIECE, Texts, mix, texts_of

SLOTS = 1 << 14
"""Words share this many vectors by their hash, so the table has one size for any corpus."""
SIZE = 64
"""Dimensions of a vector."""
MARKS = 4
"""Nonzero entries, +1 or -1, of an index vector."""
REACH = 2
"""Neighbours on each side that make a word's context."""
SAMPLE = 20_000
"""The most labelled rows that the network is fitted on."""
HIDDEN, ROUNDS, RATE, SEED = 32, 300, 3e-3, 7

#: Runs of letters and digits, and runs of any one other sign, are words here.
_KINDS = np.full(256, 2, np.uint8)
_KINDS[[0x20, *range(0x09, 0x0E)]] = 0
_KINDS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def slots(t: Texts) -> np.ndarray:
    return (t.codes >> np.uint64(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """By slot: places and signs of the nonzero entries."""
    h = mix(np.arange(SLOTS * MARKS, dtype=np.uint64) + np.uint64(SEED)).reshape(SLOTS, MARKS)
    return (h % np.uint64(SIZE)).astype(np.int64), np.where(h >> np.uint64(63), 1.0, -1.0)


def contexts(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> None:
    """Add to each word's row the index vectors of its neighbours; the last column counts."""
    places, signs = index_vectors()
    flat = np.zeros(SLOTS * SIZE)
    for b in batches:
        for _, _, t in texts_of(b.column(0), kinds=_KINDS):
            s = slots(t)
            matrix[:, SIZE] += np.bincount(s, minlength=SLOTS)
            for d in range(1, REACH + 1):
                for lo in range(0, len(s) - d, PIECE):
                    hi = min(lo + PIECE, len(s) - d)
                    same = t.doc[lo:hi] == t.doc[lo + d : hi + d]
                    one, two = s[lo:hi][same], s[lo + d : hi + d][same]
                    for a, c in ((one, two), (two, one)):
                        flat += np.bincount((a[:, None] * SIZE + places[c]).ravel(), signs[c].ravel(), minlength=len(flat))
    matrix[:, :SIZE] += flat.reshape(SLOTS, SIZE)


def word_vectors(sums: np.ndarray) -> np.ndarray:
    """By dimension and slot: unit vectors, weighted down for frequent words."""
    count = sums[:, SIZE].astype(float)
    unit = sums[:, :SIZE] / np.maximum(np.linalg.norm(sums[:, :SIZE], axis=1, keepdims=True), 1e-9)
    share = count / max(count.sum(), 1)
    return np.ascontiguousarray((unit * (1e-3 / (1e-3 + share))[:, None] ** 0.5).astype(np.float32).T)


def pooled(t: Texts, vectors: np.ndarray) -> np.ndarray:
    """For each text: mean and spread of its words' vectors, its length, its share of different words.

    A text longer than PIECE words is added up in parts from its first word on, so that
    equal texts get equal numbers wherever they stand.
    """
    out = np.zeros((t.n, 2 * SIZE + 3), np.float32)
    s = slots(t)
    if len(s):
        cut = np.flatnonzero(np.diff(t.doc, prepend=-1))
        doc, n = t.doc[cut], np.diff(np.append(cut, len(s))).astype(np.float32)[:, None]
        part = cut if len(s) <= PIECE else np.concatenate([np.arange(a, z, PIECE) for a, z in zip(cut, [*cut[1:], len(s)])])
        of = np.searchsorted(cut, part, "right") - 1  # the text of each part
        ends = np.append(part[1:], len(s))
        sums, squares = (np.zeros((len(cut), SIZE), np.float32) for _ in range(2))
        at = 0
        while at < len(part):
            to = max(at + 1, int(np.searchsorted(ends, part[at] + PIECE, "right")))
            v = np.take(vectors, s[part[at] : ends[to - 1]], axis=1)  # a dimension lies together: sums along it are fast
            own = part[at:to] - part[at]
            np.add.at(sums, of[at:to], np.add.reduceat(v, own, axis=1).T)
            np.multiply(v, v, out=v)
            np.add.at(squares, of[at:to], np.add.reduceat(v, own, axis=1).T)
            at = to
        mean = sums / n
        spread = np.sqrt(np.maximum(squares / n - mean * mean, 0))
        different = np.bincount(np.unique(t.doc * SLOTS + s) // SLOTS, minlength=t.n)[doc]
        out[doc] = np.hstack([mean, spread, np.log1p(n), (different / n[:, 0])[:, None], np.sqrt(n)])
    return out


@dataclass
class Network:
    """Two layers; probabilities at a calibrated temperature."""

    vectors: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.layers
        return np.maximum((x - self.centre) / self.scale @ a + b, 0) @ c + d

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fit(vectors: np.ndarray, x: np.ndarray, y: np.ndarray) -> Network:
    """Adam on four fifths of the rows; the epoch and the temperature that suit the last fifth best."""
    x, y = x.astype(float), y.astype(float)
    if not len(x):
        return Network(vectors, np.zeros(1), np.ones(1), [np.zeros((2 * SIZE + 3, 1)), np.zeros(1), np.zeros(1), np.float64(0.0)])
    rng = np.random.default_rng(SEED)
    net = Network(vectors, x.mean(0), np.maximum(x.std(0), 1e-6), [])
    width = x.shape[1]
    net.layers = [rng.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.float64(0.0)]
    held = rng.random(len(x)) < 0.2 if len(x) >= 50 else np.zeros(len(x), bool)
    test = held if held.any() else ~held
    xt, yt, rows = x[~held], y[~held], int((~held).sum())
    first, second = [np.zeros_like(p) for p in net.layers], [np.zeros_like(p) for p in net.layers]
    best, kept, step, batch = np.inf, net.layers, 0, 256
    for _ in range(max(10, min(ROUNDS, ROUNDS * 2000 // max(rows, 1)))):
        order = rng.permutation(rows)
        for at in range(0, rows, batch):
            own = order[at : at + batch]
            z = (xt[own] - net.centre) / net.scale
            a, b, c, d = net.layers
            hidden = np.maximum(z @ a + b, 0)
            error = (1 / (1 + np.exp(-np.clip(hidden @ c + d, -30, 30))) - yt[own]) / len(own)
            back = error[:, None] * c * (hidden > 0)
            grads = [z.T @ back + 1e-3 * a, back.sum(0), hidden.T @ error + 1e-3 * c, error.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i], second[i] = 0.9 * first[i] + 0.1 * g, 0.999 * second[i] + 0.001 * g * g
                net.layers[i] = net.layers[i] - RATE * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
        if (loss := _loss(net.logit(x[test]), y[test])) < best:
            best, kept = loss, [p.copy() for p in net.layers]
    net.layers = kept
    logit = net.logit(x[test])
    net.temperature = float(min(np.geomspace(0.25, 8, 61), key=lambda t: _loss(logit / t, y[test])))
    return net


def _loss(logit: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(y > 0, -logit, logit))))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Network:
    """Word vectors from all texts, and a network from at most sample labelled rows (a fixed choice by hash of the id).

    Labels that are null, or of documents that aren't there, are left out; of several
    labels of one id the largest counts, of several texts of one id one. Every fifth row,
    at random, chooses epoch and temperature; with fewer than 50 rows all of them do.
    Passes over the rows fall as rows grow, from ROUNDS at 2,000, to 30 at SAMPLE.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    vectors = word_vectors(matrix_sum(texts, contexts, (SLOTS, SIZE + 1)))
    chosen = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label")).where("doc_id is not null and label is not null")
              .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))
    # at most sample rows of two numbers
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, t in texts_of(b.column(0), kinds=_KINDS):
                rows = [x.tobytes() for x in pooled(t, vectors)]
                yield pa.RecordBatch.from_arrays([b.column(1).slice(lo, hi - lo), pa.array(rows, pa.binary()), b.column(2).slice(lo, hi - lo)], ["doc_id", "x", "label"])

    pooled_rows = found.select("text", "doc_id", "label").mapInArrow(run, "doc_id long, x binary, label int")
    # at most sample rows, however many have one id: of these the least vector counts
    rows = sorted(pooled_rows.groupBy("doc_id").agg(F.min("x").alias("x"), F.first("label").alias("label")).collect(), key=lambda r: r["doc_id"])
    x = np.array([np.frombuffer(r["x"], np.float32) for r in rows]).reshape(len(rows), 2 * SIZE + 3)
    return fit(vectors, x, np.array([r["label"] for r in rows]))


def scored(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, score: how likely label 1 is.

    Null text counts as empty, and empty texts have one score, that of no words at all;
    null ids stay null; equal texts have equal scores; an empty table gives an empty
    one; other columns are ignored. One pass; the network and its vectors have a fixed
    size; a text of n bytes, however long, takes about 17 n.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, t in texts_of(b.column(1), kinds=_KINDS):
                score = net.score(pooled(t, net.vectors).astype(float))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.array(score)], ["doc_id", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double")

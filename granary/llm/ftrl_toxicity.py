"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct buckets of a text's words, word pairs and word pairs around one word. Every
coordinate has its own learning rate, and the L1 term keeps all but a few weights at zero, so the model is
a short sorted list of buckets that travels with the task.
"""

from __future__ import annotations

from typing import Iterator, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm.batches import lists_of, slices
from granary.llm.learning import labelled_features
from granary.llm.shipping import ship
from granary.llm.wordhash import LETTERS, chain, word_hashes

SAMPLE = 8_000
BITS = 30


def buckets(text: str | None) -> np.ndarray:
    """Distinct buckets of single words, neighbours and skip pairs; punctuation only separates words."""
    w = word_hashes(text, LETTERS)
    gap = np.full(max(len(w) - 2, 0), np.uint64(1))
    found = np.concatenate([w, chain(w[:-1], w[1:]), chain(w[:-2], gap, w[2:])]) if len(w) else w
    return np.unique((found >> np.uint64(64 - BITS)).astype(np.uint32))


class Ftrl(NamedTuple):
    """Settings of the learner: alpha and beta of the rates, L1, L2, passes over the sample."""

    alpha: float = 2.0
    beta: float = 1.0
    l1: float = 8.0
    l2: float = 0.0
    passes: int = 8


class Model(NamedTuple):
    """Sorted buckets with their weights, and the bias."""

    bucket: np.ndarray
    weight: np.ndarray
    bias: float

    def score(self, found: np.ndarray) -> float:
        total = self.bias
        if len(self.bucket) and len(found):
            at = np.minimum(np.searchsorted(self.bucket, found), len(self.bucket) - 1)
            total += float(self.weight[at][self.bucket[at] == found].sum())
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(rows: list[np.ndarray], label: np.ndarray, how: Ftrl = Ftrl(), seed: int = 5) -> Model:
    """Online passes in a seeded order. With one class or no rows the bias alone decides (0.5 if none).

    While a weight is zero a row moves its sum by less than one in each pass, so buckets for which passes times
    rows is no more than L1 stay at zero, and are left out first.
    """
    if not len(label):
        return Model(np.empty(0, np.uint32), np.empty(0), 0.0)
    every, counts = np.unique(np.concatenate(rows), return_counts=True)
    known = every[how.passes * counts > how.l1]
    encoded = []
    for row in rows:
        at = np.minimum(np.searchsorted(known, row), max(len(known) - 1, 0))
        encoded.append(at[known[at] == row] if len(known) else at[:0])
    z, n = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    bias = len(known)
    l1 = np.full(len(known) + 1, how.l1)
    l1[bias] = 0.0

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - l1[i], 0)
        return -shrunk / ((how.beta + np.sqrt(n[i])) / how.alpha + how.l2)

    rng = np.random.default_rng(seed)
    for _ in range(how.passes):
        for k in rng.permutation(len(encoded)):
            i = np.append(encoded[k], bias)
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - label[k]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / how.alpha * w
            n[i] += g * g
    w = weights(np.arange(len(known) + 1))
    used = np.flatnonzero(w[:-1])
    return Model(known[used], w[used], float(w[bias]))


def _features(documents: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = lists_of([buckets(t).astype("<i4").tobytes() for t in part.column("text").to_pylist()], pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), rows], ["doc_id", "label", "x"])

    return documents.select("doc_id", "label", "text").mapInArrow(run, "doc_id long, label int, x array<int>")


def learn(documents: DataFrame, labels: DataFrame, label: str = "toxic", bound: int = SAMPLE, how: Ftrl = Ftrl()) -> Model:
    """Fit on at most ``bound`` labelled rows outside the held-out fold; only their buckets come to the driver."""
    ship(documents.sparkSession)
    found = labelled_features(documents, labels, label, _features, bound)
    column = found.column("x").combine_chunks()
    values, ends = column.values.to_numpy().astype(np.uint32), column.offsets.to_numpy()
    return fit([values[a:b] for a, b in zip(ends[:-1], ends[1:])], found.column("label").to_numpy(), how)


def score(documents: DataFrame, model: Model, key: str = "doc_id", text: str = "text", into: str = "score") -> DataFrame:
    """``key`` and ``into`` (0 to 1) for every row, from its whole text, however long; a NULL or empty text has only the bias."""
    ship(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                scores = [model.score(buckets(t)) for t in part.column(text).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(key), pa.array(scores, pa.float64())], [key, into])

    return documents.select(key, text).mapInArrow(run, f"`{key}` {kind}, `{into}` double")

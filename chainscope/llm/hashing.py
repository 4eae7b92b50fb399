"""Hashed bag-of-words features and a bounded-sample linear classifier."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.llm.common import byte_words

DIM = 4096


def features(text: str, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """(slots, values): hashed words of the whole text, square-root counts at
    unit length. An empty text has no slots."""
    slots: dict[int, int] = {}
    for w, n in Counter(byte_words(text)).items():
        h = zlib.crc32(w) % dim
        slots[h] = slots.get(h, 0) + n
    at = np.fromiter(slots.keys(), dtype=np.int64, count=len(slots))
    v = np.sqrt(np.fromiter(slots.values(), dtype=np.float64, count=len(slots)))
    norm = np.sqrt((v * v).sum())
    return at, v / norm if norm else v


def bounded_sample(rows: DataFrame, bound: int) -> DataFrame:
    """At most ``bound`` rows, chosen by a hash of doc_id."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)


def sample_matrix(sample: DataFrame, label: str, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Dense features and labels of a bounded sample (doc_id, text, label);
    the features are made in tasks."""
    def run(batches):
        for b in batches:
            out = [features(t, dim) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "at": [a.tolist() for a, _ in out],
                                "v": [v.tolist() for _, v in out], "y": b[label]})
    got = sample.select("doc_id", "text", label).mapInPandas(
        run, "doc_id long, at array<long>, v array<double>, y double").toPandas().sort_values("doc_id")
    x = np.zeros((len(got), dim))
    for i, (at, v) in enumerate(zip(got["at"], got["v"])):
        x[i, np.asarray(at, dtype=np.int64)] = v
    return x, got["y"].to_numpy(dtype=np.float64)


def fit_softmax(x: np.ndarray, y: np.ndarray, k: int, rounds: int = 150, rate: float = 4.0,
                l2: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights (dim, k) and biases by full-batch gradient ascent; ``y`` is a
    class number per row, or a (rows, k) matrix of soft labels."""
    soft = np.eye(k)[y.astype(int)] if y.ndim == 1 else y
    if not len(x):
        return np.zeros((x.shape[1], k)), np.zeros(k)
    # Rare words weigh more: columns are scaled by their inverse document
    # frequency in the sample, and the scale is folded into the weights.
    scale = 1 + np.log((1 + len(x)) / (1 + (x > 0).sum(axis=0)))
    z = x * scale[:, None].T
    w, b = np.zeros((x.shape[1], k)), np.log((soft.sum(axis=0) + 1) / (len(soft) + k))
    for _ in range(rounds):
        g = soft - posteriors(z @ w + b)
        w += rate * (z.T @ g / len(z) - l2 * w)
        b += 0.1 * rate * g.mean(axis=0)
    return w * scale[:, None], b


def posteriors(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)

"""Weak-label quality classifier.

Overlapping heuristic labellers vote good (1), bad (0) or abstain (-1) on
every document. Votes are aggregated into counts per vote pattern (at most
3**6 = 729 rows whatever the corpus); expectation-maximisation on the
patterns estimates the class share and each labeller's vote probabilities per
class. The posteriors label a bounded sample of documents (``SAMPLE`` rows
by a hash of doc_id, a documented parameter) that trains a hashed linear
scorer, which then scores every whole text and alone gives the verdict.

A null or empty text gets the votes of an empty text (bad on length, else
abstain) and the scorer's bias. Repeated rows score alike; a null doc_id
passes through; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm import hashing
from chainscope.llm.common import id_text, map_keyed
from chainscope.operators.lineage import Scratch

SAMPLE = 4000
ROUNDS = 100
PRIOR_GOOD = 0.75
LABELLERS = ("length", "punctuation", "symbols", "repeats", "variety", "word_size")


def votes(text: str) -> list[int]:
    words = text.split()
    n = len(words)
    if not n:
        return [0, -1, -1, -1, -1, -1]
    chars = sum(map(len, words))
    lines = [ln for ln in text.split("\n") if ln.strip()]
    symbols = sum(text.count(c) for c in "#*$%&|<>{}")
    stops = sum(text.count(c) for c in ".!?")
    dup = 1 - len(set(lines)) / len(lines)
    variety = len(set(words)) / n
    size = chars / n
    return [
        1 if n >= 50 else 0 if n < 20 else -1,
        1 if 0.01 <= stops / n <= 0.3 else 0 if stops / n < 0.002 else -1,
        0 if symbols > 0.05 * chars else 1 if symbols <= 0.005 * chars else -1,
        0 if dup > 0.3 else 1 if dup == 0 and len(lines) > 1 else -1,
        0 if n >= 50 and variety < 0.2 else 1 if n >= 50 and variety > 0.35 else -1,
        0 if size > 15 or size < 2 else 1 if 3 <= size <= 10 else -1,
    ]


def vote_table(docs: DataFrame) -> DataFrame:
    """(doc_id, pattern): one base-3 digit per labeller."""
    def run(batches):
        for b in batches:
            code = [sum((v + 1) * 3 ** i for i, v in enumerate(votes(t))) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "pattern": code})
    return map_keyed(id_text(docs), run, "doc_id long, pattern int")


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """EM: (posterior of good per pattern, P(vote | class) as (labeller,
    class, vote), share of good)."""
    k = len(LABELLERS)
    v = (patterns[:, None] // 3 ** np.arange(k)) % 3  # 0 abstain, 1 bad, 2 good
    good = PRIOR_GOOD
    acc = np.tile(np.array([[0.4, 0.4, 0.2], [0.4, 0.1, 0.5]]), (k, 1, 1))
    post = np.full(len(patterns), good)
    for _ in range(rounds):
        like = np.stack([np.log(acc[np.arange(k), c, v]).sum(axis=1) for c in (0, 1)], axis=1)
        post = hashing.posteriors(like + np.log([1 - good, good]))[:, 1] if len(v) else post
        for c, w in ((0, (1 - post) * counts), (1, post * counts)):
            for lf in range(k):
                acc[lf, c] = np.bincount(v[:, lf], weights=w, minlength=3) + [4, 3 - 2 * c, 1 + 2 * c]
                acc[lf, c] /= acc[lf, c].sum()
        good = ((post * counts).sum() + 3) / (counts.sum() + 4)
    return post, acc, float(good)


def score(spark: SparkSession, docs: DataFrame, sample: int = SAMPLE, keep_at: float = 0.5) -> DataFrame:
    """(doc_id, pattern, weak_label, score, kept) per row."""
    scratch = Scratch(spark, "weak")
    marked = scratch.save(vote_table(docs), "votes")
    counts = marked.groupBy("pattern").count().toPandas().sort_values("pattern")
    post, _, _ = fit(counts["pattern"].to_numpy(dtype=np.int64), counts["count"].to_numpy(dtype=float))
    label = dict(zip(counts["pattern"].astype(int), post.tolist()))

    chosen = hashing.bounded_sample(marked.filter("doc_id IS NOT NULL"), sample).dropDuplicates(["doc_id"])
    chosen = chosen.withColumn("y", F.col("pattern").cast("double")).drop("pattern")
    rows = hashing.bounded_sample(id_text(docs).join(F.broadcast(chosen), "doc_id"), sample)
    x, y = hashing.sample_matrix(rows, "y")
    good = np.array([label[int(p)] for p in y])
    shared = spark.sparkContext.broadcast((hashing.fit_softmax(x, np.stack([1 - good, good], axis=1), 2), label))

    def run(batches):
        (w, bias), known = shared.value
        for b in batches:
            out = []
            for doc_id, t in zip(b["doc_id"], b["text"]):
                at, v = hashing.features(t)
                p = hashing.posteriors(v @ w[at] + bias)[1]
                code = sum((x + 1) * 3 ** i for i, x in enumerate(votes(t)))
                out.append((doc_id, code, known[code], float(p), bool(p >= keep_at)))
            yield pd.DataFrame(out, columns=["doc_id", "pattern", "weak_label", "score", "kept"])
    return map_keyed(
        id_text(docs), run, "doc_id long, pattern int, weak_label double, score double, kept boolean")

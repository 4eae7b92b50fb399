"""Soft-membership mixing of sources to target weights.

1. A softmax classifier over hashed words is fitted on a bounded sample of
   the labelled table (at most ``SAMPLE`` rows, a documented parameter) and
   predicts every document's posterior p_d over the domains ``DOMAINS``.
2. Each document i of n_i tokens gets a rate r_i >= 0. The expected tokens
   of domain d are sum_i n_i p_id r_i; the rates minimise
   sum_d (expected_d / target_d - 1)^2 under r >= 0, starting from one, by
   projected gradient in the token-weighted metric, each step scaled by the
   domains' Gram matrix over the rows whose rate is positive, and halved
   until it lowers that sum, so a domain that the documents barely hold pulls
   the others no further than it gains. A step needs only the domain
   totals (one partial aggregation into one row), and a document's rate is a
   function of its posterior and the steps so far, so the table of documents
   is never rewritten.
3. Rates become copies: the whole part, plus one more when a hash of the
   doc_id falls below the fraction, so the expected copies are the rate.

The target token total is the one at which the ``good`` domain keeps its
expected tokens. Null and empty texts have no tokens: their posterior is the
class prior and their rate follows it. Repeated rows get equal rates; a null
doc_id hashes like any value; without labels or documents every rate is 1.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm import hashing
from chainscope.llm.common import byte_words, id_text, map_keyed
from chainscope.operators.lineage import Scratch

DOMAINS = ("good", "poor", "toxic")
TARGETS = (0.86, 0.10, 0.04)
SAMPLE = 4000
ROUNDS = 60
TOLERANCE = 1e-4
SPAN = 1e-3  # least share of the largest Gram eigenvalue that a step uses


def domain_of(quality, toxic):
    return F.when(toxic == 1, 2).when(quality == 1, 0).otherwise(1).cast("double")


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    marked = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), domain_of(F.col("quality"), F.col("toxic")).alias("y"))
    chosen = hashing.bounded_sample(marked, sample).dropDuplicates(["doc_id"])
    # At most ``sample`` ids: the bound of the broadcast.
    rows = id_text(docs).join(F.broadcast(chosen), "doc_id")
    x, y = hashing.sample_matrix(hashing.bounded_sample(rows, sample), "y")
    return hashing.fit_softmax(x, y, len(DOMAINS))


def predict(docs: DataFrame, model: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """(doc_id, n_tokens, p0, p1, p2) per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"p{d}" for d in range(len(DOMAINS))]

    def run(batches):
        w, b0 = shared.value
        for b in batches:
            scores = np.empty((len(b), len(DOMAINS)))
            for i, t in enumerate(b["text"]):
                at, v = hashing.features(t)
                scores[i] = v @ w[at] + b0
            p = hashing.posteriors(scores) if len(b) else scores
            yield pd.DataFrame({"doc_id": b["doc_id"],
                                "n_tokens": [len(byte_words(t)) for t in b["text"]],
                                **{n: p[:, d] for d, n in enumerate(names)}})
    return map_keyed(id_text(docs), run, "doc_id long, n_tokens long, " + ", ".join(n + " double" for n in names))


def _rates(p: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """Replay the projected steps on rows of posteriors."""
    r = np.ones(len(p))
    for g in steps:
        r = np.maximum(0.0, r - p @ g)
    return r


def fit_rates(predicted: DataFrame, targets=TARGETS, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The projected-gradient steps; each round is one pass of partial sums."""
    k = len(targets)
    names = [f"p{d}" for d in range(k)]

    def totals(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        def run(batches):
            t, m = np.zeros(k), np.zeros((k, k))
            for b in batches:
                p, n = b[names].to_numpy(), b["n_tokens"].to_numpy(dtype=float)
                r = _rates(p, steps)
                t += (n * r) @ p
                m += (p * (n * (r > 0))[:, None]).T @ p
            yield pd.DataFrame([[*t, *m.ravel()]], columns=cols)
        cols = [f"t{i}" for i in range(k + k * k)]
        got = predicted.mapInPandas(run, ", ".join(c + " double" for c in cols)).agg(*[F.sum(c) for c in cols]).first()
        v = np.array([x or 0.0 for x in got])
        return v[:k], v[k:].reshape(k, k)

    t, m = totals([])
    if t[0] <= 0:
        return []
    goal = np.array(targets) * t[0] / targets[0]

    def loss(t: np.ndarray) -> float:
        return float((((t - goal) / goal) ** 2).sum())

    steps: list[np.ndarray] = []
    scale = 1.0
    for _ in range(rounds):
        if np.abs(t / goal - 1).max() < TOLERANCE or scale < 1e-3:
            break
        # The pseudo-inverse leaves out directions that the rows hardly span.
        step = scale * np.linalg.lstsq(m / np.outer(goal, goal), (t - goal) / goal, rcond=SPAN)[0] / goal
        t_new, m_new = totals([*steps, step])
        if loss(t_new) < loss(t) * (1 - 1e-6):
            steps.append(step)
            t, m, scale = t_new, m_new, min(1.0, 2 * scale)
        else:
            scale /= 2
    return steps


def rates(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets=TARGETS,
          rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_tokens, p0, p1, p2, rate) per row of ``docs``."""
    scratch = Scratch(spark, "mixing")
    got = scratch.save(predict(docs, train(docs, labels)), "posteriors")
    steps = fit_rates(got, targets, rounds)
    names = [f"p{d}" for d in range(len(targets))]

    def run(batches):
        for b in batches:
            b["rate"] = _rates(b[names].to_numpy(), steps)
            yield b
    return map_keyed(got, run, got.schema.simpleString()[7:-1].replace(":", " ").replace("bigint", "long") + ", rate double")


def copies(rate, doc_id):
    """Whole number of copies of a rate, by a hash of the id."""
    u = F.pmod(F.xxhash64(doc_id, F.lit("mix")), F.lit(1_000_003)) / F.lit(1_000_003.0)
    return F.floor(rate + u).cast("int")


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame, targets=TARGETS) -> DataFrame:
    """``docs`` with every row repeated by its number of copies."""
    found = rates(spark, docs, labels, targets).select(
        F.col("doc_id").alias("_mix_id"), copies(F.col("rate"), F.col("doc_id")).alias("_mix_n")) \
        .groupBy("_mix_id").agg(F.max("_mix_n").alias("_mix_n"))
    return docs.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("_mix_id"))).filter("_mix_n > 0") \
        .withColumn("_mix_n", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).select(*docs.columns)

"""Quartile bucket digest of whole texts.

Byte triplets of a sliding window of four bytes are hashed into 128 buckets;
each bucket is written as its quartile among the 128 counts (2 bits), after
two hex digits of the length on a logarithmic scale. Two digests are compared
by the sum of quartile differences plus the length difference, bounded by
``FAR``; likeness is 1 at no difference and 0 at ``FAR`` or more, about where
unrelated texts lie.

A text shorter than the window is filled with spaces (its length tells it from
a text ending with them). A null or empty text has the digest of length 0 and empty buckets. Equal
texts have equal digests. Rows are ordered by doc_id, then text; a null
doc_id comes first; repeated rows follow each other; an empty table gives an
empty result; a single row's next document is itself.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm.common import id_text, map_keyed

BUCKETS = 128
FAR = 160
_SHIFTS = ((0, 1, 2), (0, 1, 3), (0, 2, 3))


def bucket_counts(raw: bytes) -> np.ndarray:
    out = np.zeros(BUCKETS, dtype=np.int64)
    if 0 < len(raw) < 4:  # shorter than a window: filled with spaces
        raw = raw.ljust(4)
    data = np.frombuffer(raw, dtype=np.uint8)
    for at in range(0, max(len(data) - 3, 0), 1_000_000):
        part = data[at:at + 1_000_003].astype(np.uint32)
        n = len(part) - 3
        for salt, (i, j, k) in enumerate(_SHIFTS):
            h = (part[i:i + n] * np.uint32(0x9E3779B1) + part[j:j + n] * np.uint32(0x85EBCA6B)
                 + part[k:k + n] * np.uint32(0xC2B2AE35) + np.uint32(salt * 0x27D4EB2F))
            h ^= h >> np.uint32(15)
            h *= np.uint32(0x2C1B3C6D)
            out += np.bincount(h >> np.uint32(25), minlength=BUCKETS)
    return out


def digest(text: str) -> str:
    raw = text.encode("utf-8", "replace")
    counts = bucket_counts(raw)
    cuts = np.sort(counts)[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
    quartile = (counts[:, None] > cuts[None, :]).sum(axis=1).astype(np.uint8).reshape(-1, 4)
    packed = (quartile << np.array([6, 4, 2, 0], dtype=np.uint8)).sum(axis=1).astype(np.uint8)
    length = min(255, round(8 * math.log2(1 + len(raw))))
    return f"{length:02x}{packed.tobytes().hex()}"


def difference(a: str, b: str) -> int:
    """Bounded difference score of two digests, 0 to ``FAR``."""
    x, y = (np.frombuffer(bytes.fromhex(d), dtype=np.uint8) for d in (a, b))
    q = [(v[1:, None] >> np.array([6, 4, 2, 0], dtype=np.uint8)) & 3 for v in (x, y)]
    total = np.abs(q[0].astype(int) - q[1]).sum() + abs(int(x[0]) - int(y[0])) // 4
    return int(min(FAR, total))


def likeness(a: str, b: str) -> float:
    return 1.0 - difference(a, b) / FAR


def _with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Rows sorted within ranges of doc_id. Each range ends with a mark row
    (last = 1): the first document of the following non-empty range, the
    last range's being the first of all."""
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    points = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], 10_000)).first()[0]
    cuts = F.array(*[F.lit(p).cast("long") for p in sorted(set(points or []))]) if points \
        else F.array().cast("array<long>")
    ranged = docs.withColumn("range", F.coalesce(F.size(F.filter(cuts, lambda c: c < F.col("doc_id"))), F.lit(0)))
    # One row per range, so at most ``parts`` rows.
    firsts = ranged.groupBy("range").agg(F.min(F.struct("doc_id", "text")).alias("f"))
    spots = sorted(r[0] for r in firsts.select("range").collect())
    before = {b: a for a, b in zip(spots, spots[1:] + spots[:1])}
    into = before or {0: 0}
    target = F.element_at(F.create_map(*[F.lit(v) for kv in into.items() for v in kv]), F.col("range"))
    marks = firsts.select("f.doc_id", "f.text", target.alias("range"), F.lit(1).alias("last"))
    rows = ranged.withColumn("last", F.lit(0)).unionByName(marks)
    return rows.repartition(parts, "range").sortWithinPartitions("range", "last", "doc_id", "text")


def compare(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Digests of every text and of its edited text, and their likenesses."""
    def one(cur, nxt):
        doc_id, text, fp = cur
        text2, fp2 = nxt[1], nxt[2]
        half = len(text) // 2
        edited = text[:len(text) - half] + text2[:half]
        efp = digest(edited)
        return (doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(), fp, efp,
                likeness(fp, efp), likeness(fp, fp2))

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches):
        prev = None
        for b in batches:
            rows = []
            for doc_id, text, last in zip(b["doc_id"], b["text"], b["last"]):
                cur = (doc_id, text, digest(text))
                if prev is not None:
                    rows.append(one(prev, cur))
                prev = None if last else cur
            yield pd.DataFrame(rows, columns=names)
    return map_keyed(
        _with_next(spark, id_text(docs)), run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
             "near_edited double, near_next double")

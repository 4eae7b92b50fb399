"""SimHash near-duplicates through Golay-code fuzzy hashing.

Fingerprint: 64-bit majority of XXH64 (seed 42) over the word shingles.
Documents are first grouped by equal fingerprint (partial aggregation, so a
group of exact copies of any size becomes one row). A distinct fingerprint is
cut into segments A (23 bits), B (23 bits), C (18 bits, padded with zeros).
The perfect (23,12) Golay code puts every 23-bit word within 3 bits of
exactly one codeword; a word one bit away is within 4 bits of that codeword.
So the *nearest* codeword of x is among the codewords within 4 bits of any y
that differs from x in at most one bit.

Pigeonhole for at most 3 differing bits over three segments: either one
segment agrees exactly and another differs in at most one bit (keys: exact
segment + codeword index of the other, for the six ordered pairs), or every
segment differs in exactly one bit (key: codeword indices of A, B and C).
One side of the join sends its nearest index, the other all indices
within 4 bits, and the bit distance verifies each meeting, so no link is lost
and none is wrong. Components come from alternating large-star/small-star
rounds on the links, each written to the checkpoint folder.

A null or empty text has fingerprint zero and is linked like any other; a
repeated doc_id keeps its rows; a null doc_id takes part in no component
(component_id null); empty tables give empty results. Nothing is capped.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.llm.common import byte_words, id_text, map_keyed
from chainscope.operators.lineage import Scratch

SEED = 42
MAX_BITS = 3
GOLAY_POLY = 0xC75  # generator polynomial of the (23,12) code


def fingerprint_text(text: str, k: int = 3) -> int:
    words = byte_words(text)
    if not words:
        return 0
    if len(words) < k:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(k))))
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 65536):  # bounded memory for very long texts
        bits = np.unpackbits(h[at:at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit integer."""
    def run(batches):
        for b in batches:
            fp = [fingerprint_text(t, k) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"],
                                "fp": np.array(fp, dtype=np.uint64).view(np.int64)})
    return map_keyed(id_text(docs), run, "doc_id long, fp long")


_CODE: dict = {}


def _golay() -> dict:
    """Tables of the code: codewords, syndrome -> index shift, offsets."""
    if _CODE:
        return _CODE

    def remainder(x: np.ndarray) -> np.ndarray:
        x = x.copy()
        for bit in range(22, 10, -1):
            x = np.where((x >> bit) & 1, x ^ (GOLAY_POLY << (bit - 11)), x)
        return x

    words = np.arange(4096, dtype=np.int64) << 11
    codewords = words | remainder(words)
    # Error pattern of each of the 2048 syndromes (weight at most 3).
    pats = [0] + [1 << a for a in range(23)] + [1 << a | 1 << b for a in range(23) for b in range(a)] + \
        [1 << a | 1 << b | 1 << c for a in range(23) for b in range(a) for c in range(b)]
    pats = np.array(pats, dtype=np.int64)
    fix = np.zeros(2048, dtype=np.int64)
    fix[remainder(pats)] = pats
    # x + e, with e its error pattern, is the nearest codeword; the others
    # within 4 bits are the codewords c' with weight(e + c') <= 4, per syndrome.
    near = []
    for s in range(2048):
        other = codewords ^ fix[s]
        near.append(codewords[np.bitwise_count(other) <= 4])
    _CODE.update(remainder=remainder, fix=fix, near=near)
    return _CODE


def nearest_index(seg: np.ndarray) -> np.ndarray:
    g = _golay()
    return (seg ^ g["fix"][g["remainder"](seg)]) >> 11


def near_indices(seg: np.ndarray) -> list[np.ndarray]:
    """Indices of all codewords within 4 bits of each 23-bit word."""
    g = _golay()
    syn = g["remainder"](seg)
    centre = seg ^ g["fix"][syn]
    return [(c ^ g["near"][s]) >> 11 for c, s in zip(centre, syn)]


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [((u >> np.uint64(s)) & np.uint64((1 << w) - 1)).astype(np.int64) for s, w in ((0, 23), (23, 23), (46, 18))]


_PAIRS = [(i, j) for i in range(3) for j in range(3) if i != j]


def _keys(batches, every: bool):
    """Rows (key, fp): every near index when ``every``, else the nearest."""
    for b in batches:
        fp = b["fp"].to_numpy(dtype=np.int64)
        for at in range(0, len(fp), 4096):
            part = fp[at:at + 4096]
            seg = _segments(part)
            idx = [near_indices(s) for s in seg] if every else [[np.array([v]) for v in nearest_index(s)] for s in seg]
            keys, owner = [], []
            for n in range(len(part)):
                mine = [(np.int64(t) << 35) | (seg[i][n] << 12) | idx[j][n] for t, (i, j) in enumerate(_PAIRS)]
                abc = ((idx[0][n][:, None, None] << 12) | idx[1][n][None, :, None]) << 12 | idx[2][n][None, None, :]
                mine.append((np.int64(7) << 36) | abc.ravel())
                k = np.concatenate(mine)
                keys.append(k)
                owner.append(np.full(len(k), part[n]))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "fp": np.concatenate(owner)})


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs (a, b), a < b, of distinct fingerprints at most ``max_bits``
    apart. ``fps`` has one row per distinct ``fp``."""
    if max_bits > MAX_BITS:
        raise ValueError("the three-segment pigeonhole holds up to 3 bits")
    # Keys multiply the rows, so the narrow table is dealt out first.
    fps = fps.select("fp").repartition("fp")
    probe = fps.select("fp").mapInPandas(lambda it: _keys(it, False), "key long, fp long")
    index = fps.select("fp").mapInPandas(lambda it: _keys(it, True), "key long, fp long")
    x, y = probe.withColumnRenamed("fp", "x"), index.withColumnRenamed("fp", "y")
    hit = x.join(y, "key").filter((F.col("x") != F.col("y"))
                                  & (F.bit_count(F.col("x").bitwiseXOR(F.col("y"))) <= max_bits))
    return hit.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def components(spark: SparkSession, edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, component): smallest node reachable over ``edges`` (u, v).

    Alternating large-star and small-star; every neighbourhood is reduced to
    its minimum by a partial aggregation, never collected.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not large:
            both = both.filter("v <= u")
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        j = both.join(low, "u")
        if large:
            out = j.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                low.select("u", F.col("m").alias("v")))
        return out.filter("u != v").distinct()

    def mark(e: DataFrame):
        r = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    cur = scratch.save(edges.select("u", "v").filter("u != v").distinct(), "edges")
    seen = mark(cur)
    while seen[0]:
        cur = scratch.save(star(star(cur, True), False), "star")
        now = mark(cur)
        if now == seen:
            break
        seen = now
    return cur.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))


def near_duplicates(spark: SparkSession, docs: DataFrame, k: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every document."""
    scratch = Scratch(spark, "simhash")
    fp = scratch.save(fingerprints(docs, k), "fingerprints")
    rep = scratch.save(fp.filter("doc_id IS NOT NULL").groupBy("fp").agg(F.min("doc_id").alias("node")), "distinct")
    link = links(rep, max_bits)
    a, b = rep.toDF("a", "u"), rep.toDF("b", "v")
    comp = components(spark, link.join(a, "a").join(b, "b").select("u", "v"), scratch)
    rep = rep.join(comp, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return _attach(fp, rep).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


SALTS = 32


def _attach(fp: DataFrame, rep: DataFrame) -> DataFrame:
    """Join each document to the row of its fingerprint. A fingerprint can
    hold a third of the documents, so both sides carry a salt: documents by
    id, the narrow fingerprint rows once per salt."""
    left = fp.withColumn("_s", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    right = rep.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return left.join(right, ["fp", "_s"], "left")


def dedup(spark: SparkSession, docs: DataFrame, k: int = 3, max_bits: int = MAX_BITS) -> DataFrame:
    """One document of each component (its smallest doc_id), columns of
    ``docs``; rows without an id stay."""
    found = near_duplicates(spark, docs, k, max_bits)
    keep = found.filter("component_id = doc_id").select(F.col("doc_id").alias("_keep")).distinct()
    return docs.filter("doc_id IS NOT NULL").join(keep, F.col("doc_id") == F.col("_keep"), "left_semi") \
        .dropDuplicates(["doc_id"]).unionByName(docs.filter("doc_id IS NULL"))

"""Closed loops of three and four accounts (A->B->C->A, A->B->C->D->A).

Listing is degree ordered: accounts are ranked by (number of distinct
neighbours, address) and every loop is anchored at its highest-ranked
account h. A two-step path is only built through a centre ranked below h,
and a centre has at most sqrt(2m) neighbours ranked above it, so the
intermediate paths number O(m^1.5) in total and a hub (an exchange with a
third of all edges) never pairs all of its in- and out-neighbours.
Each loop is reported once, rotated to start at its smallest address.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chainscope.operators.lineage import Scratch


def _ranks(edges: DataFrame) -> DataFrame:
    ends = edges.select(F.col("src").alias("address"), F.col("dst").alias("other")).unionByName(
        edges.select(F.col("dst").alias("address"), F.col("src").alias("other")))
    return ends.distinct().groupBy("address").agg(F.count(F.lit(1)).alias("deg"))


def _above(deg_a: Column, a: Column, deg_b: Column, b: Column) -> Column:
    """Rank of a is above rank of b."""
    return (deg_a > deg_b) | ((deg_a == deg_b) & (a > b))


def _ranked_edges(edges: DataFrame) -> DataFrame:
    """Edges with both end ranks, written once: every loop plan reads the
    edge list three times, and it is an aggregation over all transfers."""
    edges = edges.select("src", "dst", "weight").persist(StorageLevel.MEMORY_AND_DISK)
    r = _ranks(edges)
    rs = r.select(F.col("address").alias("src"), F.col("deg").alias("ds"))
    rd = r.select(F.col("address").alias("dst"), F.col("deg").alias("dd"))
    out = Scratch(edges.sparkSession, "loops").save(edges.join(rs, "src").join(rd, "dst"), "ranked_edges")
    edges.unpersist()
    return out


def _down_paths(re: DataFrame) -> DataFrame:
    """h -> y -> o with y and o ranked below h: (h, y, o, dh, do, w1, w2)."""
    first = re.filter(_above(F.col("ds"), F.col("src"), F.col("dd"), F.col("dst"))).select(
        F.col("src").alias("h"), F.col("dst").alias("y"), F.col("ds").alias("dh"), F.col("weight").alias("w1"))
    second = re.select(F.col("src").alias("y"), F.col("dst").alias("o"), F.col("dd").alias("do"),
                       F.col("weight").alias("w2"))
    return (first.join(second, "y")
            .filter((F.col("o") != F.col("h")) & _above(F.col("dh"), F.col("h"), F.col("do"), F.col("o"))))


def _up_paths(re: DataFrame) -> DataFrame:
    """o -> x -> h with x and o ranked below h: (o, x, h, dh, do, w3, w4)."""
    last = re.filter(_above(F.col("dd"), F.col("dst"), F.col("ds"), F.col("src"))).select(
        F.col("src").alias("x"), F.col("dst").alias("h"), F.col("dd").alias("dh"), F.col("weight").alias("w4"))
    before = re.select(F.col("src").alias("o"), F.col("dst").alias("x"), F.col("ds").alias("do"),
                       F.col("weight").alias("w3"))
    return (before.join(last, "x")
            .filter((F.col("o") != F.col("h")) & _above(F.col("dh"), F.col("h"), F.col("do"), F.col("o"))))


def _rotate(cols: list[Column]) -> list[Column]:
    """Rotation of a loop that starts at its smallest member."""
    n = len(cols)
    smallest = F.least(*cols)
    out = []
    for i in range(n):
        expr = None
        for start in range(n):
            pick = cols[(start + i) % n]
            expr = F.when(cols[start] == smallest, pick) if expr is None else expr.when(cols[start] == smallest, pick)
        out.append(expr.alias(f"v{i + 1}"))
    return out


def cycles_3(edges: DataFrame) -> DataFrame:
    """Directed 3-loops ``(v1, v2, v3, min_weight)``; ``min_weight`` is the
    number of peeling rounds the loop survives."""
    re = _ranked_edges(edges)
    closing = re.select(F.col("src").alias("o"), F.col("dst").alias("h"), F.col("weight").alias("w3"))
    loops = _down_paths(re).join(closing, ["o", "h"])
    return loops.select(*_rotate([F.col("h"), F.col("y"), F.col("o")]),
                        F.least("w1", "w2", "w3").alias("min_weight"))


def cycles_4(edges: DataFrame) -> DataFrame:
    """Directed 4-loops ``(v1, v2, v3, v4, min_weight)`` of four distinct accounts."""
    re = _ranked_edges(edges)
    down = _down_paths(re).select("h", "y", "o", "w1", "w2")
    up = _up_paths(re).select("h", "o", "x", "w3", "w4")
    loops = down.join(up, ["h", "o"]).filter(F.col("x") != F.col("y"))
    return loops.select(*_rotate([F.col("h"), F.col("y"), F.col("o"), F.col("x")]),
                        F.least("w1", "w2", "w3", "w4").alias("min_weight"))

"""Strongly connected components of the transfer graph.

All work is DataFrame joins and aggregations that Spark partitions by vertex,
whatever the size of the graph; the driver runs the loop and reads counts
observed while a round is written. Many graphs (``lvl``) are solved in the
same rounds.

1. *Shrink.* Vertices joined by edges both ways are one vertex. A vertex
   without an in-edge or without an out-edge lies on no cycle and goes with
   its edges.
2. *Colour.* Every vertex takes the smallest id that reaches it and the
   smallest id it reaches. Both spread along edges from the vertices that
   changed, and jump: what reaches the id that reaches a vertex reaches the
   vertex, so a colour's way grows by jumps, not by single edges, and a ring
   of n vertices takes about log(n) rounds. Where the two ids are equal, the
   vertex is in that id's component; an edge between vertices of different
   pairs lies in none.
3. Repeat on the edges that are left, then put back the vertices made one, the
   last first.

Every table that a later round reads is written under the checkpoint folder,
so plans stay small and a lost executor costs one round.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.operators.lineage import Scratch, large

DEFAULT_MAX_ROUNDS = 100_000
# The graph is shrunk again while that takes more than a tenth of its edges.
SHRINK_SHARE = 10
MEMBERS = "lvl BIGINT, v BIGINT, root BIGINT"


class RoundLimitExceeded(RuntimeError):
    """The fixpoint was not reached within the round budget (no partial result is returned)."""


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


# Ids are mixed (one to one) before they are compared as colours: along a path
# of ascending ids a smallest id would have nothing to jump to.
_MIX = ((13, True), (7, False), (17, True)) * 3


def _shift(c: Column, n: int, left: bool) -> Column:
    return F.shiftleft(c, n) if left else F.shiftrightunsigned(c, n)


def _mix(df: DataFrame, names: list[str], back: bool = False) -> DataFrame:
    """Columns with their ids mixed, or as they were; a step a projection,
    since each step reads its value more than once."""
    for n, left in reversed(_MIX) if back else _MIX:
        def step(c: Column) -> Column:
            out = c.bitwiseXOR(_shift(c, n, left))
            for k in range(2 * n, 64, n) if back else ():
                out = out.bitwiseXOR(_shift(c, k, left))
            return out
        df = df.withColumns({name: step(F.col(name)) for name in names})
    return df


class _Solver:
    def __init__(self, spark: SparkSession, scratch: Scratch, max_rounds: int):
        self.spark, self.scratch, self.limit, self.n = spark, scratch, max_rounds, 0
        self.found: list[DataFrame] = []   # (lvl, v, root)
        self.merged: list[DataFrame] = []  # (lvl, v, u): v was made one with u

    def tick(self) -> None:
        self.n += 1
        if self.n > self.limit:
            raise RoundLimitExceeded(f"SCC did not converge in {self.limit} rounds")

    # --- shrinking ------------------------------------------------------

    def shrink(self, e: DataFrame, n_edges: int) -> tuple[DataFrame, int]:
        pairs_left = True
        while n_edges:
            self.tick()
            if pairs_left:
                back = e.select("lvl", F.col("src").alias("dst"), F.col("dst").alias("src"))
                pairs, n_pairs = self.scratch.save_counted(e.join(large(back), ["lvl", "src", "dst"]), "both_ways")
                pairs_left = n_pairs * SHRINK_SHARE > n_edges
                if pairs_left:
                    e, n_edges = self.merge(e, pairs)
                    continue
            into = e.select("lvl", F.col("dst").alias("src")).distinct()
            out = e.select("lvl", F.col("src").alias("dst")).distinct()
            was = n_edges
            e, n_edges = self.scratch.save_counted(e.join(large(into), ["lvl", "src"], "left_semi").join(
                large(out), ["lvl", "dst"], "left_semi").select("lvl", "src", "dst"), "trimmed")
            if (was - n_edges) * SHRINK_SHARE <= was:
                break
        return e, n_edges

    def merge(self, e: DataFrame, pairs: DataFrame) -> tuple[DataFrame, int]:
        """Vertices that edges both ways join become their smallest."""
        same = self.spread(pairs.select("lvl", F.col("src").alias("at"), F.col("dst").alias("v"), F.lit(True).alias("out")))
        same = same.select("lvl", "v", F.col("f").alias("u"))
        self.merged.append(same)
        ends = [same.select("lvl", F.col("v").alias(end), F.col("u").alias(f"u_{end}")) for end in ("src", "dst")]
        e = e.join(large(ends[0]), ["lvl", "src"], "left").join(large(ends[1]), ["lvl", "dst"], "left").select(
            "lvl", F.coalesce("u_src", "src").alias("src"), F.coalesce("u_dst", "dst").alias("dst"))
        return self.scratch.save_counted(e.filter("src != dst").distinct(), "merged")

    # --- colouring --------------------------------------------------------

    def colour(self, e: DataFrame) -> tuple[DataFrame, int]:
        """Components of one pass, and the edges that may lie in others."""
        arcs = self.scratch.save(e.select("lvl", F.explode(F.array(
            F.struct(F.col("src").alias("at"), F.col("dst").alias("v"), F.lit(True).alias("out")),
            F.struct(F.col("dst").alias("at"), F.col("src").alias("v"), F.lit(False).alias("out")))).alias("x"))
            .select("lvl", "x.*"), "arcs")
        final = self.spread(arcs)
        # A vertex may share its component with vertices shrunk away.
        self.found.append(final.filter("f = b").select("lvl", "v", F.col("f").alias("root")))
        open_ = final.filter("f != b")
        ends = [open_.select("lvl", F.col("v").alias(end), F.struct("f", "b").alias(f"c_{end}")) for end in ("src", "dst")]
        rest = e.join(large(ends[0]), ["lvl", "src"]).join(large(ends[1]), ["lvl", "dst"]).filter("c_src = c_dst")
        return self.scratch.save_counted(rest.select("lvl", "src", "dst"), "left")

    def spread(self, arcs: DataFrame) -> DataFrame:
        """(lvl, v, f, b): the smallest id that reaches a vertex over ``arcs``
        (lvl, at, v, out), and the smallest over those that are not ``out``."""
        heard = [F.min(F.when(F.col("out"), F.col("f"))).alias("mf"), F.min(F.when(~F.col("out"), F.col("b"))).alias("mb")]
        # Round one: every vertex hears of all its neighbours.
        first = arcs.withColumns({"f": F.col("at"), "b": F.col("at")}).groupBy("lvl", "v").agg(*heard)
        state = self.scratch.save(first.select("lvl", "v", F.least("v", "mf").alias("f"), F.least("v", "mb").alias("b"),
                                               F.lit(True).alias("moved")), "colours")
        while True:
            self.tick()
            front = state.filter("moved").select("lvl", F.col("v").alias("at"), "f", "b")
            near = arcs.join(large(front), ["lvl", "at"]).groupBy("lvl", "v").agg(*heard)
            jump_f = state.filter("f < v").select("lvl", F.col("v").alias("f"), F.col("f").alias("jf"))
            jump_b = state.filter("b < v").select("lvl", F.col("v").alias("b"), F.col("b").alias("jb"))
            new = state.drop("moved").join(large(near), ["lvl", "v"], "left").join(
                large(jump_f), ["lvl", "f"], "left").join(large(jump_b), ["lvl", "b"], "left").withColumn("nf", F.least("f", "mf", "jf")).withColumn(
                "nb", F.least("b", "mb", "jb"))
            moved = (F.col("nf") < F.col("f")) | (F.col("nb") < F.col("b"))
            state, n = self.scratch.save_counted(new.select(
                "lvl", "v", F.col("nf").alias("f"), F.col("nb").alias("b"), moved.alias("moved")), "colours", F.col("moved"))
            if not n:
                return state.drop("moved")

    # --- the whole ----------------------------------------------------------

    def unwind(self) -> DataFrame:
        m = _union(self.found) if self.found else self.spark.createDataFrame([], MEMBERS)
        for same in reversed(self.merged):
            roots = m.select("lvl", F.col("v").alias("u"), F.col("root"))
            more = same.join(large(roots), ["lvl", "u"], "left").select("lvl", "v", F.coalesce("root", "u").alias("root"))
            m = self.scratch.save(m.unionByName(more).distinct(), "unwound")
        m = _mix(m, ["v"], back=True)
        sets = m.groupBy("lvl", "root").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
        return m.join(large(sets), ["lvl", "root"]).select("lvl", "v", F.col("low").alias("root"))


def scc_members(spark: SparkSession, edges: DataFrame, scratch: Scratch | None = None,
                max_rounds: int = DEFAULT_MAX_ROUNDS) -> DataFrame:
    """SCC membership of ``edges(lvl, src, dst)`` (BIGINT vertex ids).

    ``(lvl, v, root)`` for every vertex in an SCC of two or more vertices;
    ``root`` is the smallest vertex id of its SCC. Loops and repeated edges
    change nothing; the result is written once.
    """
    s = _Solver(spark, scratch or Scratch(spark, "scc"), max_rounds)
    e = edges.select(F.col("lvl").cast("long").alias("lvl"), "src", "dst").filter("src != dst").distinct()
    e, n_edges = s.scratch.save_counted(_mix(e, ["src", "dst"]), "edges")
    while n_edges:
        e, n_edges = s.shrink(e, n_edges)
        if n_edges:
            e, n_edges = s.colour(e)
    if not (s.found or s.merged):
        return spark.createDataFrame([], MEMBERS)
    return s.scratch.save(s.unwind(), "scc")


def vertex_ids(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(address, vid): BIGINT ids for the addresses of ``edges(src, dst)``.
    They come from ``monotonically_increasing_id`` and are fixed by writing
    the table once; joins then move 8-byte keys instead of addresses."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("address")).distinct()
    return scratch.save(ends.withColumn("vid", F.monotonically_increasing_id()), "ids")


def id_edges(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Replace both addresses of every edge by their ids (AQE splits the
    partition of a hub on the edge side)."""
    cols = [c for c in edges.columns if c not in ("src", "dst")]
    s = ids.select(F.col("address").alias("src"), F.col("vid").alias("s"))
    d = ids.select(F.col("address").alias("dst"), F.col("vid").alias("d"))
    return edges.join(large(s), "src").join(large(d), "dst").select(F.col("s").alias("src"), F.col("d").alias("dst"), *cols)


def scc_components(spark: SparkSession, edges: DataFrame, max_rounds: int = DEFAULT_MAX_ROUNDS) -> DataFrame:
    """SCCs of the whole graph ``edges(src, dst, ...)``.

    ``(address, component, n_members)``: one row per account in an SCC of
    two or more accounts; ``component`` is the smallest address of the SCC.
    """
    scratch = Scratch(spark, "components")
    edges = scratch.save(edges.select("src", "dst"), "edges")
    ids = vertex_ids(edges, scratch)
    m = scc_members(spark, id_edges(edges, ids).withColumn("lvl", F.lit(1)), scratch, max_rounds)
    named = m.join(large(ids.withColumnRenamed("vid", "v")), "v")
    sets = named.groupBy("root").agg(F.min("address").alias("component"), F.count(F.lit(1)).alias("n_members"))
    return named.join(large(sets), "root").select("address", "component", "n_members")

"""The nested sets of iterated SCC peeling, as a merge tree.

Round r of the peel loop (subtract 1 from every weight, drop empty edges,
repeat) sees exactly the edges with ``weight >= r``, so its SCCs contain those
of every later round. The distinct sets form a forest: a set is born at the
last round that has it and ends in its parent, the next larger set.

The forest is built by dividing the range of rounds. At every step each range
is cut into ``PARTS`` and the SCCs of the edges with a weight of at least each
cut are found, those of all ranges and cuts together. An edge goes to the part
above the last cut that still has both its ends in one SCC; there the SCCs of
the next cut are single vertices. After log(largest weight) steps to the base
``PARTS`` each edge has the smallest set that holds both its ends. An edge is
rewritten once per step, and copied once per cut within its weight, so at most
``PARTS`` - 1 times a step, however many rounds it lives through.

What is kept is linear in accounts and edges: one row per account and per edge
with the smallest set that holds it, one row per set with its parent, and the
sets' ancestors 1, 2, 4, ... steps up. Sums over a set's accounts or edges are
rolled up these jumps, and sums along the sets of an account are doubled, so
no account or edge is copied per set that holds it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainscope.operators import scc
from chainscope.operators.lineage import Scratch, large


# Parts a range of rounds is cut into at a step.
PARTS = 16


@dataclass
class MergeTree:
    """``sets`` (node, parent, level, depth, set_key, n_members, occurrences,
    first_round, last_round), ``accounts`` (address, node) and ``edges`` (src,
    dst, weight, value, node) with the smallest set of each, ``jumps[k]``
    (node, up): the set 2^k steps up. ``depth`` counts a set and those that
    hold it."""

    spark: SparkSession
    scratch: Scratch
    accounts: DataFrame
    edges: DataFrame
    sets: DataFrame
    jumps: list[DataFrame] = field(default_factory=list)

    def roll_up(self, values: DataFrame, how: dict[str, Column]) -> DataFrame:
        """(node, ...) of ``values`` combined over each set and all sets inside
        it. ``how`` names, per column, the aggregate that combines it."""
        cur = self.scratch.save(values.groupBy("node").agg(*[c.alias(n) for n, c in how.items()]), "values")
        for jump in self.jumps:
            # After k steps a row covers the sets fewer than 2^k steps below.
            up = cur.join(large(jump), "node").select(F.col("up").alias("node"), *how)
            cur = self.scratch.save(cur.unionByName(up).groupBy("node").agg(*[c.alias(n) for n, c in how.items()]), "rolled")
        return cur

    def along(self, values: DataFrame, name: str, combine) -> DataFrame:
        """(node, name): ``name`` of ``values`` (a row for every set) combined
        over each set and all sets that hold it."""
        cur = values.select("node", name)
        for jump in self.jumps:
            above = jump.join(large(cur.select(F.col("node").alias("up"), F.col(name).alias("_above"))), "up").select(
                "node", "_above")
            cur = self.scratch.save(cur.join(large(above), "node", "left").select(
                "node", F.when(F.col("_above").isNull(), F.col(name)).otherwise(
                    combine(F.col(name), F.col("_above"))).alias(name)), "along")
        return cur

    def holders(self) -> DataFrame:
        """(node, up): each set with itself and every set that holds it."""
        cur = self.sets.select("node", F.col("node").alias("up"))
        for jump in self.jumps:
            cur = self.scratch.save(cur.unionByName(
                cur.join(large(jump.select(F.col("node").alias("up"), F.col("up").alias("_up"))), "up").select(
                    "node", F.col("_up").alias("up"))), "holders")
        return cur

    def path_max(self, spans: DataFrame) -> DataFrame:
        """(node, value): the largest ``value`` of the ``spans`` (node, steps,
        value) over a set; a span covers ``steps`` sets upwards from its node.
        Spans are cut into powers of two, then halved down."""
        at, cut = spans.select("node", "steps", "value"), {}
        for k in range(len(self.jumps), -1, -1):
            long_ = F.col("steps") >= 1 << k
            cut[k] = self.scratch.save(at.filter(long_).groupBy("node").agg(F.max("value").alias("value")), "spans")
            if k < len(self.jumps):
                on = at.filter(long_).join(large(self.jumps[k]), "node", "left").select(
                    F.col("up").alias("node"), (F.col("steps") - (1 << k)).alias("steps"), "value").filter("steps > 0")
                at = self.scratch.save(at.filter(~long_).unionByName(on), "spans_left")
        got = cut[len(self.jumps)]
        for k in range(len(self.jumps) - 1, -1, -1):
            up = got.join(large(self.jumps[k]), "node").select(F.col("up").alias("node"), "value")
            got = self.scratch.save(cut[k].unionByName(got).unionByName(up).groupBy("node").agg(
                F.max("value").alias("value")), "halved")
        return got


def merge_tree(spark: SparkSession, edges: DataFrame, max_rounds: int = scc.DEFAULT_MAX_ROUNDS) -> MergeTree:
    """The sets of every peeling round of ``edges(src, dst, weight, value)``;
    sets have two or more accounts."""
    scratch = Scratch(spark, "peel")
    cols = ["weight", *[c for c in ("value",) if c in edges.columns]]
    edges = scratch.save(edges.select("src", "dst", *cols), "edges")
    ids = scc.vertex_ids(edges, scratch)
    e, n = scratch.save_measured(scc.id_edges(edges, ids).filter("src != dst and weight > 0"), "id_edges",
                                 top=F.max("weight"))
    keep = ["src", "dst", *cols]

    # ``home`` is the SCC of round ``lo`` that holds the edge (none yet for
    # round 0), ``s`` and ``d`` are the SCCs of the round past the range that
    # hold its ends.
    t = e.select(F.lit(0).cast("long").alias("lo"), F.col("src").alias("home"), F.col("src").alias("s"),
                 F.col("dst").alias("d"), *keep)
    width = 1
    while width * PARTS <= int(n["top"] or 0):
        width *= PARTS
    while width and n["top"]:
        t = _divide(spark, scratch, t, keep, width, max_rounds)
        width //= PARTS
    t = t.filter("lo > 0")
    return _assemble(spark, scratch, t, ids, cols)


def _divide(spark: SparkSession, scratch: Scratch, t: DataFrame, keep: list[str], width: int,
            max_rounds: int) -> DataFrame:
    """One step: ranges of ``PARTS * width`` rounds become ranges of ``width``."""
    last_cut = F.least(F.floor((F.col("weight") - F.col("lo")) / width), F.lit(PARTS - 1)).cast("int")
    cuts = F.explode(F.sequence(F.lit(1), last_cut)).alias("cut")
    active = t.filter(F.col("weight") >= F.col("lo") + width).select("lo", "s", "d", cuts).select(
        (F.col("lo") + F.col("cut") * width).alias("lvl"), F.col("s").alias("src"), F.col("d").alias("dst"))
    m = scc.scc_members(spark, active, scratch, max_rounds)
    # The SCCs of a vertex by cut, from the first on: at most PARTS - 1.
    cut = ((F.col("lvl") - 1) % (PARTS * width) + 1) / width
    lo = F.col("lvl") - cut.cast("long") * width
    roots = scratch.save(m.select(lo.alias("lo"), "v", cut.cast("int").alias("cut"), "root").groupBy("lo", "v").agg(
        F.sort_array(F.collect_list(F.struct("cut", "root"))).alias("r")).select("lo", "v", F.col("r.root").alias("r")), "roots")
    none = F.array().cast("array<bigint>")
    both = t.join(large(roots.select("lo", F.col("v").alias("s"), F.col("r").alias("rs"))), ["lo", "s"], "left").join(
        large(roots.select("lo", F.col("v").alias("d"), F.col("r").alias("rd"))), ["lo", "d"], "left").withColumn(
        "rs", F.coalesce("rs", none)).withColumn("rd", F.coalesce("rd", none)).withColumn(
        "same", F.size(F.filter(F.zip_with("rs", "rd", lambda a, b: a == b), lambda x: x)))
    out = both.select(
        (F.col("lo") + F.col("same") * width).alias("lo"),
        F.when(F.col("same") > 0, F.try_element_at("rs", F.col("same"))).otherwise(F.col("home")).alias("home"),
        F.coalesce(F.try_element_at("rs", F.col("same") + 1), F.col("s")).alias("s"),
        F.coalesce(F.try_element_at("rd", F.col("same") + 1), F.col("d")).alias("d"), *keep)
    return scratch.save(out, "divided")


def _assemble(spark: SparkSession, scratch: Scratch, t: DataFrame, ids: DataFrame, cols: list[str]) -> MergeTree:
    """The tree from the final edges: set (home, lo) joins the sets and
    accounts ``s`` and ``d`` that still stood apart one round later. Those are
    named by their smallest account, which is also ``home`` of one of them."""
    joins = scratch.save(t.select("lo", "home", F.explode(F.array("s", "d")).alias("v")).distinct(), "joins")
    nodes = scratch.save(joins.select("home", "lo").distinct().withColumn("node", F.monotonically_increasing_id()), "nodes")
    # Per name from its first round on down (a name takes part once a round):
    # the first row is the account's smallest set; a name that stays home
    # stands for that set in its next row.
    by_name = Window.partitionBy("v").orderBy(F.col("lo").desc())
    rows = scratch.save(joins.withColumn("rank", F.row_number().over(by_name))
                        .withColumn("up_home", F.lead("home").over(by_name))
                        .withColumn("up_lo", F.lead("lo").over(by_name)), "rows")
    accounts = rows.filter("rank = 1").join(large(nodes), ["home", "lo"]).select("v", "node").join(
        large(ids.withColumnRenamed("vid", "v")), "v").select("address", "node")
    up = nodes.select(F.col("home").alias("up_home"), F.col("lo").alias("up_lo"), F.col("node").alias("parent"))
    sets = scratch.save(
        rows.filter("v = home").join(large(nodes), ["home", "lo"]).join(large(up), ["up_home", "up_lo"], "left")
        .select("node", "parent", F.col("lo").alias("level"), F.coalesce("up_lo", F.lit(0)).alias("end")), "sets")

    jumps, jump = [], sets.filter("parent is not null").select("node", F.col("parent").alias("up"))
    while True:
        jump, n = scratch.save_counted(jump, "jumps")
        if not n:
            break
        jumps.append(jump)
        jump = jump.join(large(jump.select(F.col("node").alias("up"), F.col("up").alias("_up"))), "up").select(
            "node", F.col("_up").alias("up"))

    names = [ids.select(F.col("address").alias(f"a_{end}"), F.col("vid").alias(end)) for end in ("src", "dst")]
    edges = t.join(large(nodes), ["home", "lo"]).join(large(names[0]), "src").join(large(names[1]), "dst").select(
        F.col("a_src").alias("src"), F.col("a_dst").alias("dst"), *cols, "node")
    tree = MergeTree(spark, scratch, accounts, edges, sets, jumps)
    size = tree.roll_up(accounts.select("node", F.col("address").alias("set_key"), F.lit(1).alias("n_members")),
                        {"set_key": F.min("set_key"), "n_members": F.sum("n_members")})
    depth = tree.along(sets.withColumn("depth", F.lit(1)), "depth", lambda a, b: a + b)
    tree.sets = scratch.save(sets.join(large(size), "node").join(large(depth), "node").select(
        "node", "parent", "level", "depth", "set_key", "n_members",
        (F.col("level") - F.col("end")).alias("occurrences"), (F.col("end") + 1).alias("first_round"),
        F.col("level").alias("last_round")), "tree")
    return tree

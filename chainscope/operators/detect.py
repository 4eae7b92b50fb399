"""Wash-trading detection on the merge tree of the peeled SCCs.

A *set* is an SCC (two or more accounts) of some peeling round; the
:class:`~chainscope.operators.peeling.MergeTree` holds every distinct set once.
``(set_key = smallest member, n_members)`` names a set in the results: nested
sets of equal smallest member differ in size.

Sums over a set's accounts or edges are taken once per smallest set and rolled
up the tree; nothing is copied per set except where the result lists it.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainscope.functions.columns import WEI
from chainscope.operators.lineage import large
from chainscope.operators.peeling import MergeTree

# Fixed values of the method: a set is a candidate when it survives at
# least 3 peeling rounds, and it is volume-matched when the summed net
# position of its members is within 1 % of their summed absolute positions.
SCC_OCCURRENCE_THRESHOLD = 3
VOLUME_TOLERANCE = 0.01

SET = ["set_key", "n_members"]


def scc_occurrences(tree: MergeTree) -> DataFrame:
    """Distinct sets with the number of peeling rounds they occur in, and
    the first and last such round."""
    return tree.sets.select(*SET, "occurrences", "first_round", "last_round")


def set_members(tree: MergeTree) -> DataFrame:
    """(set_key, n_members, address) for every distinct set: the one result
    that lists an account once per set that holds it."""
    listed = tree.accounts.join(large(tree.holders()), "node").select("address", F.col("up").alias("node"))
    return listed.join(large(tree.sets.select("node", *SET)), "node").select(*SET, "address")


def scc_candidates(occurrences: DataFrame, threshold: int = SCC_OCCURRENCE_THRESHOLD) -> DataFrame:
    return occurrences.filter(F.col("occurrences") >= F.lit(threshold))


def within(part, whole, tolerance: float):
    """``part <= tolerance * whole`` in whole numbers: a wei sum is beyond
    what a double holds exactly."""
    share = Fraction(str(tolerance))
    return part * F.lit(share.denominator) <= whole * F.lit(share.numerator)


def set_balance(tree: MergeTree, net: DataFrame) -> DataFrame:
    """(node, n_positions, net_sum, abs_sum, net_mean): the members' net
    positions over all their transfers. Members without a position count in
    none of them; ``net_mean`` is NULL where no member has one."""
    own = tree.accounts.join(large(net.select("address", "net_value")), "address").select(
        "node", F.lit(1).alias("n_positions"), F.col("net_value").alias("net_sum"), F.abs("net_value").alias("abs_sum"))
    sums = tree.roll_up(own, {"n_positions": F.sum("n_positions"), "net_sum": F.sum("net_sum").cast(WEI),
                              "abs_sum": F.sum("abs_sum").cast(WEI)})
    zero = F.lit(0).cast(WEI)
    return tree.sets.select("node").join(large(sums), "node", "left").select(
        "node", F.coalesce("n_positions", F.lit(0)).alias("n_positions"), F.coalesce("net_sum", zero).alias("net_sum"),
        F.coalesce("abs_sum", zero).alias("abs_sum"),
        F.try_divide(F.col("net_sum").cast("double"), F.col("n_positions").cast("double")).alias("net_mean"))


def volume_match(sets: DataFrame, tree: MergeTree, net: DataFrame, tolerance: float = VOLUME_TOLERANCE) -> DataFrame:
    """Net-position balance of each set.

    ``net_sum`` is the sum of the members' net positions (over all their
    transfers), ``net_mean`` their mean, ``abs_sum`` the sum of their absolute
    net positions; a set is matched when |net_sum| <= tolerance * abs_sum.
    """
    named = set_balance(tree, net).join(large(tree.sets.select("node", *SET)), "node")
    return (sets.join(large(named.select(*SET, "net_sum", "net_mean", "abs_sum")), SET, "left")
            .withColumn("volume_matched", within(F.abs(F.col("net_sum")), F.col("abs_sum"), tolerance)))


def matched_sets(tree: MergeTree, net: DataFrame, threshold: int = SCC_OCCURRENCE_THRESHOLD,
                 tolerance: float = VOLUME_TOLERANCE) -> DataFrame:
    """(node, matched) of every set: candidate and volume-matched."""
    ok = within(F.abs(F.col("net_sum")), F.col("abs_sum"), tolerance)
    return set_balance(tree, net).join(large(tree.sets.select("node", "occurrences")), "node").select(
        "node", (ok & (F.col("occurrences") >= F.lit(threshold))).alias("matched"))


def set_edges(tree: MergeTree) -> DataFrame:
    """(node, n_edges, n_transfers, volume) of the edges with both ends in a
    set, rolled up from the smallest set of each edge."""
    own = tree.edges.select("node", F.lit(1).alias("n_edges"), F.col("weight").alias("n_transfers"),
                            F.col("value").alias("volume"))
    return tree.roll_up(own, {"n_edges": F.sum("n_edges"), "n_transfers": F.sum("n_transfers"),
                              "volume": F.sum("volume").cast(WEI)})


def wash_set_volume(sets: DataFrame, tree: MergeTree) -> DataFrame:
    """Per set: edges inside it, transfers on them and their total value."""
    named = set_edges(tree).join(large(tree.sets.select("node", *SET)), "node")
    return sets.select(*SET).join(large(named), SET).select(*SET, "n_edges", "n_transfers", "volume")


def wash_suspects(tree: MergeTree, matched: DataFrame) -> DataFrame:
    """Accounts in at least one matched set, with the number of such sets:
    the flags of ``matched`` (node, matched) summed along each account's sets."""
    flags = matched.select("node", F.col("matched").cast("bigint").alias("n_sets"))
    counts = tree.along(flags, "n_sets", lambda a, b: a + b).filter("n_sets > 0")
    return tree.accounts.join(large(counts), "node").select("address", "n_sets")


def wash_volume_by_account(tree: MergeTree, matched: DataFrame, edges: DataFrame) -> DataFrame:
    """Per suspect account: value it sent or received on edges inside a
    matched set (each edge once, even when sets nest: it is inside one when
    its smallest set or a set that holds that one is), its total volume over
    all ``edges``, and the share (NULL when the account moved no value)."""
    covered = tree.along(matched.select("node", "matched"), "matched", lambda a, b: a | b).filter("matched").select("node")

    def by_account(e: DataFrame, name: str) -> DataFrame:
        legs = e.select(F.explode(F.array(
            F.struct(F.col("src").alias("address"), F.col("value").alias("v")),
            F.struct(F.col("dst").alias("address"), F.col("value").alias("v")),
        )).alias("l")).select("l.address", "l.v")
        return legs.groupBy("address").agg(F.sum("v").cast(WEI).alias(name))

    wash = by_account(tree.edges.join(large(covered), "node", "left_semi"), "wash_volume")
    total = by_account(edges.select("src", "dst", "value"), "total_volume")
    return (wash.join(large(total), "address", "left")
            .withColumn("wash_share", F.try_divide(F.col("wash_volume").cast("double"),
                                                   F.col("total_volume").cast("double"))))


def top_wash_trader(tree: MergeTree, matched: DataFrame, edges: DataFrame, k: int = 1) -> DataFrame:
    per = wash_volume_by_account(tree, matched, edges)
    return per.orderBy(F.col("wash_volume").desc(), F.col("address").asc()).limit(k)


def vertex_scc_counts(tree: MergeTree) -> DataFrame:
    """Per account: peeling rounds in which it is in a set (up to the last
    round of its smallest set), and the number of distinct sets it is in."""
    return tree.accounts.join(large(tree.sets), "node").select(
        "address", F.col("last_round").alias("n_rounds"), F.col("depth").alias("n_sets"))


def reciprocal_pairs(edges: DataFrame) -> DataFrame:
    """Two-account loops A->B and B->A (each pair once, a < b): an equi-join
    on the edge key, so output is at most one row per edge."""
    ab = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"),
                      F.col("weight").alias("weight_ab"), F.col("value").alias("value_ab"))
    ba = edges.select(F.col("dst").alias("a"), F.col("src").alias("b"),
                      F.col("weight").alias("weight_ba"), F.col("value").alias("value_ba"))
    return ab.filter(F.col("a") < F.col("b")).join(large(ba), ["a", "b"])


def member_volume_match(sets: DataFrame, tree: MergeTree, tolerance: float = VOLUME_TOLERANCE) -> DataFrame:
    """Member test of volume matching: inside the set, every member's net
    (received minus sent on edges with both ends in the set) is within
    ``tolerance`` of the set's internal volume.

    The set-level sum of these nets is always 0, so the test is per member. A
    member's net changes only at the sets that are the smallest of some edge
    of it, and holds from there up to the next: one span per such set.
    """
    legs = tree.edges.select("node", F.explode(F.array(
        F.struct(F.col("src").alias("address"), (-F.col("value")).cast(WEI).alias("amount")),
        F.struct(F.col("dst").alias("address"), F.col("value").cast(WEI).alias("amount")),
    )).alias("l")).groupBy("node", "l.address").agg(F.sum("l.amount").cast(WEI).alias("amount"))
    path = Window.partitionBy("address").orderBy(F.col("depth").desc())
    spans = legs.join(large(tree.sets.select("node", "depth")), "node").select(
        "node", F.abs(F.sum("amount").over(path).cast(WEI)).alias("value"),
        (F.col("depth") - F.coalesce(F.lead("depth").over(path), F.lit(0))).alias("steps"))
    worst = tree.path_max(spans).withColumnRenamed("value", "max_member_net")
    inner = set_edges(tree).select("node", F.col("volume").alias("inner_volume"))
    named = tree.sets.select("node", *SET).join(large(inner), "node").join(large(worst), "node")
    return (sets.join(large(named.select(*SET, "inner_volume", "max_member_net")), SET, "left")
            .withColumn("member_matched", within(F.col("max_member_net"), F.col("inner_volume"), tolerance)))

"""The transfer graph: vertices are accounts, edges the transfers between
two accounts collapsed to (src, dst, weight = number of transfers, value =
total value)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainscope.functions.columns import WEI
from chainscope.operators.lineage import large
from chainscope.operators.transfers import without_self_trades


def graph_vertices(transfers: DataFrame, token_col: str | None = "token_type") -> DataFrame:
    """Distinct accounts with one (the smallest) token type each."""
    token = F.col(token_col) if token_col and token_col in transfers.columns else F.lit("native")
    ends = transfers.select(F.explode(F.array(
        F.struct(F.col("from_address").alias("address"), token.alias("token_type")),
        F.struct(F.col("to_address").alias("address"), token.alias("token_type")),
    )).alias("e")).select("e.address", "e.token_type").filter(F.col("address").isNotNull())
    return ends.groupBy("address").agg(F.min("token_type").alias("token_type"))


def graph_edges(transfers: DataFrame) -> DataFrame:
    """Weighted edges of the non-self transfers with a receiver."""
    t = without_self_trades(transfers).filter(F.col("from_address").isNotNull() & F.col("to_address").isNotNull())
    return (t.groupBy(F.col("from_address").alias("src"), F.col("to_address").alias("dst"))
            .agg(F.count(F.lit(1)).alias("weight"), F.sum("value").cast(WEI).alias("value")))


def edge_peel(edges: DataFrame, step: int = 1) -> DataFrame:
    """One peeling round: every weight minus ``step``; edges reaching 0 go."""
    return (edges.withColumn("weight", F.col("weight") - F.lit(step))
            .filter(F.col("weight") > 0))


def vertices_with_edges(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices that are the end of at least one edge."""
    ends = edges.select(F.explode(F.array("src", "dst")).alias("address")).distinct()
    return vertices.join(large(ends), "address", "left_semi")


def component_edges(components: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges with both ends in one component of (address, component,
    n_members): (component, n_members, src, dst, weight, value)."""
    c = components.select("component", "n_members", F.col("address").alias("src"))
    d = components.select(F.col("component").alias("_other"), F.col("address").alias("dst"))
    return (edges.join(large(c), "src").join(large(d), "dst").filter(F.col("component") == F.col("_other"))
            .select("component", "n_members", "src", "dst", "weight", "value"))

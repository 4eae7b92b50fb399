"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the ledger-shaped views of :mod:`chainscope.sources.bindings`;
every query reads whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.operators import (blocks, cleaning, contracts, cycles, detect, graph, overhead, peeling,
                                  scc, timeseries, transfers)
from chainscope.functions.columns import month_of_label
from chainscope.session import checkpoint_dir
from chainscope.operators import lineage
from chainscope.sources import bindings as b
from chainscope.sources import readers, sinks
from chainscope.streaming import monthly as streaming_monthly

Query = Callable[[SparkSession, str], DataFrame]


def q_clean_transactions(spark, sf_dir):
    raw = b.tx_raw(spark, sf_dir)
    return cleaning.clean_transactions(raw, time_col="block_timestamp", value_col="value",
                                       to_col="to_address")


def q_monthly_tx_count(spark, sf_dir):
    return timeseries.monthly_count(b.tx_orders(spark, sf_dir))


def q_monthly_count_sum(spark, sf_dir):
    return timeseries.monthly_count_sum(b.tx_orders(spark, sf_dir))


def q_monthly_avg_value(spark, sf_dir):
    return timeseries.monthly_average(b.tx_orders(spark, sf_dir))


def q_monthly_raw_count(spark, sf_dir):
    """Count per month needs only a parsable time (a bad value still counts)."""
    raw = cleaning.clean_transactions(b.tx_raw(spark, sf_dir), value_col=None)
    return timeseries.monthly_count(raw)


def q_monthly_raw_count_sum(spark, sf_dir):
    raw = cleaning.clean_transactions(b.tx_raw(spark, sf_dir))
    return timeseries.monthly_count_sum(raw)


def q_value_received(spark, sf_dir):
    return contracts.value_received(b.tx_orders(spark, sf_dir))


def q_contract_value_join(spark, sf_dir):
    totals = contracts.value_received(b.tx_orders(spark, sf_dir))
    return contracts.contract_value_join(totals, b.contracts(spark, sf_dir))


def q_top10_contracts(spark, sf_dir):
    totals = contracts.value_received(b.tx_orders(spark, sf_dir))
    return contracts.top_contracts(totals, b.contracts(spark, sf_dir), k=10)


def q_top10_contract_addresses(spark, sf_dir):
    return q_top10_contracts(spark, sf_dir).select("address")


def q_miner_block_size(spark, sf_dir):
    return blocks.miner_block_size(b.blocks_size(spark, sf_dir))


def q_top10_miners(spark, sf_dir):
    return blocks.top_miners(blocks.miner_block_size(b.blocks_size(spark, sf_dir)), 10)


def q_bottom10_miners(spark, sf_dir):
    return blocks.top_miners(blocks.miner_block_size(b.blocks_size(spark, sf_dir)), 10, ascending=True)


def q_hex_overhead(spark, sf_dir):
    return overhead.hex_overhead(b.blocks_hex(spark, sf_dir))


def q_self_trades(spark, sf_dir):
    return transfers.self_trades(b.transfers_day(spark, sf_dir))


def q_self_trade_summary(spark, sf_dir):
    return transfers.self_trade_summary(b.transfers_day(spark, sf_dir))


def q_without_self_trades(spark, sf_dir):
    return transfers.without_self_trades(b.transfers_day(spark, sf_dir)).select(
        "hash", "from_address", "to_address", "value")


def q_avg_transfer_value(spark, sf_dir):
    return transfers.transfer_stats(transfers.without_self_trades(b.transfers_day(spark, sf_dir)))


def q_net_positions(spark, sf_dir):
    return transfers.net_positions(transfers.without_self_trades(b.transfers_day(spark, sf_dir)))


def _day_net_and_stats(spark, sf_dir):
    kept = transfers.without_self_trades(b.transfers_day(spark, sf_dir))
    return transfers.net_positions(kept), transfers.transfer_stats(kept)


def q_net_neutral_accounts(spark, sf_dir):
    net, stats = _day_net_and_stats(spark, sf_dir)
    return transfers.net_neutral(net, stats)


def q_net_neutral_count(spark, sf_dir):
    net, stats = _day_net_and_stats(spark, sf_dir)
    return transfers.net_neutral_count(net, stats)


# --- transfer graph and SCC peeling ------------------------------------

def _transfers(spark, sf_dir):
    return b.transfers_groups(spark, sf_dir)


def _edges(spark, sf_dir):
    return graph.graph_edges(_transfers(spark, sf_dir))


# The merge tree of a session's input, named by the input's files with their
# sizes and times, so that a rewritten table gets a tree of its own.
_TREES: dict[tuple, peeling.MergeTree] = {}
lineage.on_clear(_TREES.clear)


def _tree(spark, sf_dir):
    key = (spark.sparkContext.applicationId, lineage.snapshot(spark, f"{sf_dir.rstrip('/')}/events.parquet"))
    if key not in _TREES:
        _TREES[key] = peeling.merge_tree(spark, _edges(spark, sf_dir))
    return _TREES[key]


def _net(spark, sf_dir):
    return transfers.net_positions(transfers.without_self_trades(_transfers(spark, sf_dir)))


def _candidates(tree):
    return detect.scc_candidates(detect.scc_occurrences(tree))


def q_graph_vertices(spark, sf_dir):
    return graph.graph_vertices(transfers.without_self_trades(_transfers(spark, sf_dir)))


def q_graph_edges(spark, sf_dir):
    return _edges(spark, sf_dir)


def q_edge_peel(spark, sf_dir):
    return graph.edge_peel(_edges(spark, sf_dir))


def q_vertices_with_edges(spark, sf_dir):
    return graph.vertices_with_edges(q_graph_vertices(spark, sf_dir), graph.edge_peel(_edges(spark, sf_dir)))


def q_scc_components(spark, sf_dir):
    return scc.scc_components(spark, _edges(spark, sf_dir))


def q_scc_edges(spark, sf_dir):
    return graph.component_edges(scc.scc_components(spark, _edges(spark, sf_dir)), _edges(spark, sf_dir))


def q_scc_occurrences(spark, sf_dir):
    return detect.scc_occurrences(_tree(spark, sf_dir))


def q_scc_candidates(spark, sf_dir):
    return _candidates(_tree(spark, sf_dir))


def q_scc_volume_match(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    return detect.volume_match(_candidates(tree), tree, _net(spark, sf_dir))


def q_scc_member_match(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    return detect.member_volume_match(_candidates(tree), tree)


def q_wash_sets(spark, sf_dir):
    """Flagship: every peeled set with its occurrences, volume balance and
    whether it passes the occurrence threshold."""
    tree = _tree(spark, sf_dir)
    out = detect.volume_match(detect.scc_occurrences(tree), tree, _net(spark, sf_dir))
    return out.withColumn("is_candidate", F.col("occurrences") >= F.lit(detect.SCC_OCCURRENCE_THRESHOLD))


def q_scc_set_members(spark, sf_dir):
    return detect.set_members(_tree(spark, sf_dir))


def q_wash_set_volume(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    return detect.wash_set_volume(_candidates(tree), tree)


def q_wash_suspects(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    return detect.wash_suspects(tree, detect.matched_sets(tree, _net(spark, sf_dir)))


def q_top_wash_trader(spark, sf_dir):
    tree = _tree(spark, sf_dir)
    matched = detect.matched_sets(tree, _net(spark, sf_dir))
    return detect.top_wash_trader(tree, matched, _edges(spark, sf_dir))


def q_vertex_scc_counts(spark, sf_dir):
    return detect.vertex_scc_counts(_tree(spark, sf_dir))


def q_reciprocal_pairs(spark, sf_dir):
    return detect.reciprocal_pairs(_edges(spark, sf_dir))


def q_cycles_3(spark, sf_dir):
    return cycles.cycles_3(_edges(spark, sf_dir))


def q_cycles_4(spark, sf_dir):
    return cycles.cycles_4(_edges(spark, sf_dir))


# --- sinks: write a result and read it back ------------------------------

MONTHLY_SCHEMA = "month STRING, month_start DATE, n_transactions BIGINT"


def _result_folder(spark, kind):
    # A fresh folder per call: streaming state must never be shared by two runs.
    return sinks.run_folder(f"{checkpoint_dir(spark).rstrip('/')}/chainscope-results",
                            f"monthly_{kind}") + f"-{uuid.uuid4().hex[:8]}"


def q_result_roundtrip(spark, sf_dir):
    path = sinks.write_json(q_monthly_tx_count(spark, sf_dir), _result_folder(spark, "json"))
    return sinks.read_json_result(spark, path, MONTHLY_SCHEMA)


def q_result_roundtrip_csv(spark, sf_dir):
    path = sinks.write_csv(q_monthly_tx_count(spark, sf_dir), _result_folder(spark, "csv"))
    return sinks.read_csv_result(spark, path, MONTHLY_SCHEMA)


def q_result_roundtrip_text(spark, sf_dir):
    path = sinks.write_text(q_monthly_tx_count(spark, sf_dir), _result_folder(spark, "text"))
    return sinks.read_text_result(spark, path, MONTHLY_SCHEMA)


def q_result_array(spark, sf_dir):
    """The first 100 months with their counts, stored as one JSON array of
    pairs and read back by position."""
    rows = q_monthly_tx_count(spark, sf_dir).orderBy("month_start").select("month", "n_transactions")
    path = sinks.write_json_array(rows, _result_folder(spark, "array"), limit=100)
    return sinks.read_json_array(spark, path, {"month": "string", "n_transactions": "bigint"})


def q_first_months(spark, sf_dir):
    """The first 12 months, stored, read back and ordered by their labels."""
    path = sinks.write_json(q_monthly_tx_count(spark, sf_dir), _result_folder(spark, "first"), limit=12)
    return sinks.read_json_result(spark, path, MONTHLY_SCHEMA).orderBy(month_of_label(F.col("month")))


# --- ledger files -----------------------------------------------------------

def _cleaned(ledger):
    return cleaning.clean_transactions(ledger, to_col="to_address").select(
        "hash", "from_address", "to_address", "value", "block_timestamp")


def _read_csv(spark, sf_dir, header):
    path = sinks.write_csv(b.ledger_rows(spark, sf_dir), _result_folder(spark, "ledger"), header=header)
    return _cleaned(readers.read_ledger_csv(spark, path, "transactions", header=header))


def q_read_ledger_csv(spark, sf_dir):
    return _read_csv(spark, sf_dir, True)


def q_read_ledger_csv_no_header(spark, sf_dir):
    return _read_csv(spark, sf_dir, False)


def q_read_ledger_lines(spark, sf_dir):
    """Comma split of text lines, some of them too short (dropped)."""
    path = _result_folder(spark, "ledger_lines")
    b.ledger_lines(spark, sf_dir).write.mode("overwrite").text(path)
    return _cleaned(readers.read_ledger_text_lines(spark, path, "transactions"))


def q_monthly_stream_count_sum(spark, sf_dir):
    """The monthly count/sum as a streaming job: the ledger view is landed as
    files, streamed to completion (availableNow) and its snapshot read back."""
    base = _result_folder(spark, "stream")
    landing = f"{base}/landing"
    b.tx_orders(spark, sf_dir).write.mode("overwrite").parquet(landing)
    schema = spark.read.parquet(landing).schema
    streaming_monthly.run_monthly_snapshot(spark, landing, schema, f"{base}/snapshot", f"{base}/state",
                                           max_files_per_trigger=4)
    return spark.read.parquet(f"{base}/snapshot")


QUERIES: dict[str, Query] = {
    "clean_transactions": q_clean_transactions,
    "monthly_tx_count": q_monthly_tx_count,
    "monthly_count_sum": q_monthly_count_sum,
    "monthly_avg_value": q_monthly_avg_value,
    "monthly_raw_count": q_monthly_raw_count,
    "monthly_raw_count_sum": q_monthly_raw_count_sum,
    "value_received": q_value_received,
    "contract_value_join": q_contract_value_join,
    "top10_contracts": q_top10_contracts,
    "top10_contract_addresses": q_top10_contract_addresses,
    "miner_block_size": q_miner_block_size,
    "top10_miners": q_top10_miners,
    "bottom10_miners": q_bottom10_miners,
    "hex_overhead": q_hex_overhead,
    "self_trades": q_self_trades,
    "self_trade_summary": q_self_trade_summary,
    "without_self_trades": q_without_self_trades,
    "avg_transfer_value": q_avg_transfer_value,
    "net_positions": q_net_positions,
    "net_neutral_accounts": q_net_neutral_accounts,
    "net_neutral_count": q_net_neutral_count,
    "graph_vertices": q_graph_vertices,
    "graph_edges": q_graph_edges,
    "edge_peel": q_edge_peel,
    "vertices_with_edges": q_vertices_with_edges,
    "scc_components": q_scc_components,
    "scc_edges": q_scc_edges,
    "scc_occurrences": q_scc_occurrences,
    "scc_candidates": q_scc_candidates,
    "scc_set_members": q_scc_set_members,
    "scc_volume_match": q_scc_volume_match,
    "scc_member_match": q_scc_member_match,
    "wash_sets": q_wash_sets,
    "wash_set_volume": q_wash_set_volume,
    "wash_suspects": q_wash_suspects,
    "top_wash_trader": q_top_wash_trader,
    "vertex_scc_counts": q_vertex_scc_counts,
    "reciprocal_pairs": q_reciprocal_pairs,
    "cycles_3": q_cycles_3,
    "cycles_4": q_cycles_4,
    "result_array": q_result_array,
    "first_months": q_first_months,
    "read_ledger_csv": q_read_ledger_csv,
    "read_ledger_csv_no_header": q_read_ledger_csv_no_header,
    "read_ledger_lines": q_read_ledger_lines,
    "result_roundtrip": q_result_roundtrip,
    "result_roundtrip_csv": q_result_roundtrip_csv,
    "result_roundtrip_text": q_result_roundtrip_text,
    "monthly_stream_count_sum": q_monthly_stream_count_sum,
}
FLAGSHIP = "wash_sets"

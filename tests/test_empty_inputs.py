from decimal import Decimal

from chainscope.operators import blocks, contracts, cycles, detect, overhead, peeling, scc, timeseries, transfers
from conftest import typed

EDGE_SCHEMA = "src STRING, dst STRING, weight BIGINT, value DECIMAL(38,0)"


def test_empty_everywhere(spark):
    tx = typed(spark, [])
    assert timeseries.monthly_count(tx).count() == 0
    assert timeseries.monthly_average(tx).count() == 0
    totals = contracts.value_received(tx)
    cons = spark.createDataFrame([], "address STRING, bytecode STRING")
    assert contracts.top_contracts(totals, cons).count() == 0
    stats = transfers.transfer_stats(tx).collect()[0]
    assert stats.n_transfers == 0 and stats.total_value is None
    net = transfers.net_positions(tx)
    assert transfers.net_neutral(net, transfers.transfer_stats(tx)).count() == 0
    per = blocks.miner_block_size(spark.createDataFrame([], "miner STRING, size BIGINT"))
    assert blocks.top_miners(per, 10).count() == 0
    cols = ("sha3_uncles STRING, logs_bloom STRING, transactions_root STRING, state_root STRING, "
            "receipts_root STRING, extra_data STRING")
    assert overhead.hex_overhead(spark.createDataFrame([], cols)).collect()[0].bit_count == 0


def test_empty_graph_paths(spark):
    e = spark.createDataFrame([], EDGE_SCHEMA)
    assert cycles.cycles_3(e).count() == 0
    assert cycles.cycles_4(e).count() == 0
    assert detect.reciprocal_pairs(e).count() == 0
    assert scc.scc_components(spark, e).count() == 0
    assert peeling.merge_tree(spark, e).sets.count() == 0


def test_no_cycles(spark):
    e = spark.createDataFrame([("a", "b", 2, Decimal(1)), ("b", "c", 1, Decimal(1))], EDGE_SCHEMA)
    assert peeling.merge_tree(spark, e).sets.count() == 0


def test_clear_scratch_then_query_again(spark):
    from chainscope.operators.lineage import clear_scratch
    from chainscope.plans.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    first = sorted(tuple(r) for r in QUERIES["scc_occurrences"](spark, sf).collect())
    assert clear_scratch(spark) >= 1
    assert sorted(tuple(r) for r in QUERIES["scc_occurrences"](spark, sf).collect()) == first

from decimal import Decimal

from pyspark.sql import functions as F

from chainscope.operators import blocks, contracts, overhead, timeseries
from conftest import SAMPLE_TX, WASHED_TX, typed


def test_monthly_count_and_sum(spark):
    for rows in (SAMPLE_TX, WASHED_TX):
        out = timeseries.monthly_count_sum(typed(spark, rows)).collect()
        assert [(r.month, r.n_transactions, r.total_value) for r in out] == [
            ("08-2015", 9, Decimal("1053999504406636803795"))]


def test_monthly_average_is_exact_sum_then_division(spark):
    out = timeseries.monthly_average(typed(spark, SAMPLE_TX)).collect()
    assert out[0].avg_value == 1.1711105604518186e+20


def test_monthly_count_is_chronological_not_lexical(spark):
    rows = [("a", "x", "y", "1", str(ts)) for ts in (1451606400, 1420070400, 1448928000, 1420070401)]
    out = timeseries.monthly_count(typed(spark, rows)).collect()
    assert [(r.month, r.n_transactions) for r in out] == [("01-2015", 2), ("12-2015", 1), ("01-2016", 1)]


def test_value_received_and_contract_join(spark):
    tx = typed(spark, SAMPLE_TX + [("t10", "a1e438", None, "5", "1438919800"),
                                   ("t11", "a1e438", "", "7", "1438919801")])
    totals = contracts.value_received(tx)
    assert totals.filter(F.col("address").isNull() | (F.col("address") == "")).count() == 0
    cons = spark.createDataFrame([("4bd5f0", "0x6060"), ("4bd5f0", "0x6060"), ("nobody", "0x00")],
                                 "address STRING, bytecode STRING")
    joined = contracts.contract_value_join(totals, cons).collect()
    assert [(r.address, r.total_value) for r in joined] == [("4bd5f0", Decimal("803989500000000000000"))] * 2
    top = contracts.top_contracts(totals, cons, k=10).collect()
    assert [(r.address, r.total_value) for r in top] == [("4bd5f0", Decimal("803989500000000000000"))]


def test_miners_top_and_bottom(spark):
    rows = [("95581e", 897), ("2a65ac", 2000), ("2a65ac", 570), ("52bc44", 3000), ("52bc44", 712)]
    per = blocks.miner_block_size(spark.createDataFrame(rows, "miner STRING, size BIGINT"))
    top = [(r.miner, r.total_size) for r in blocks.top_miners(per, 10).collect()]
    assert top == [("52bc44", 3712), ("2a65ac", 2570), ("95581e", 897)]
    bottom = [(r.miner, r.total_size) for r in blocks.top_miners(per, 2, ascending=True).collect()]
    assert bottom == [("95581e", 897), ("2a65ac", 2570)]


def test_top_k_ties_break_by_key(spark):
    per = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9)], "miner STRING, total_size BIGINT")
    assert [r.miner for r in blocks.top_miners(per, 2).collect()] == ["c", "a"]


def test_hex_overhead_sample_blocks(spark):
    # Ten blocks shaped like the export: 64 + 512 + 64 + 64 + 64 hex digits
    # plus 48 of extra data = 816 per block.
    row = ("0x" + "1" * 64, "0x" + "0" * 512, "0x" + "a" * 64, "0x" + "b" * 64, "0x" + "c" * 64, "0x" + "d" * 48)
    cols = "sha3_uncles STRING, logs_bloom STRING, transactions_root STRING, state_root STRING, " \
           "receipts_root STRING, extra_data STRING"
    out = overhead.hex_overhead(spark.createDataFrame([row] * 10, cols)).collect()[0]
    assert (out.hex_chars, out.bit_count, out.byte_count) == (8160, 32640, 4080.0)


def test_hex_overhead_null_and_non_hex_count_zero(spark):
    cols = "sha3_uncles STRING, logs_bloom STRING, transactions_root STRING, state_root STRING, " \
           "receipts_root STRING, extra_data STRING"
    rows = [(None, "0x12", "zz", "", "0x", "geth")]
    out = overhead.hex_overhead(spark.createDataFrame(rows, cols)).collect()[0]
    assert out.bit_count == 8


def test_hex_overhead_is_additive_over_splits(spark):
    cols = "sha3_uncles STRING, logs_bloom STRING, transactions_root STRING, state_root STRING, " \
           "receipts_root STRING, extra_data STRING"
    rows = [("0x" + "f" * i, None, None, None, None, "0xab") for i in range(1, 30)]
    df = spark.createDataFrame(rows, cols)
    whole = overhead.hex_overhead(df).collect()[0].bit_count
    a, b = df.randomSplit([0.5, 0.5], seed=7)
    assert whole == overhead.hex_overhead(a).collect()[0].bit_count + overhead.hex_overhead(b).collect()[0].bit_count

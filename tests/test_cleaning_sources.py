from decimal import Decimal

from chainscope.operators.cleaning import clean_transactions
from chainscope.sources import readers, sinks
from chainscope.sources.schemas import TRANSACTION_COLUMNS
from conftest import SAMPLE_TX


def test_integer_rule_rejects_fractions_and_exponents(spark):
    rows = [("a", "x", "y", v, "1438919175") for v in ("12", " 34 ", "+5", "-3", "1.5", "1e3", "n/a", "", None)]
    out = clean_transactions(spark.createDataFrame(rows, "hash STRING, from_address STRING, to_address STRING, "
                                                         "value STRING, block_timestamp STRING"))
    assert sorted(r.value for r in out.collect()) == [Decimal(-3), Decimal(5), Decimal(12), Decimal(34)]


def test_wei_beyond_bigint_is_exact(spark):
    rows = [("a", "x", "y", "123456789012345678901234567", "1")]
    out = clean_transactions(spark.createDataFrame(rows, "hash STRING, from_address STRING, to_address STRING, "
                                                         "value STRING, block_timestamp STRING")).collect()
    assert out[0].value == Decimal("123456789012345678901234567")


def test_receiver_required_when_asked(spark):
    rows = [("a", "x", None, "1", "1"), ("b", "x", "", "1", "1"), ("c", "x", "y", "1", "1")]
    df = spark.createDataFrame(rows, "hash STRING, from_address STRING, to_address STRING, value STRING, "
                                     "block_timestamp STRING")
    assert [r.hash for r in clean_transactions(df, to_col="to_address").collect()] == ["c"]
    assert clean_transactions(df).count() == 3


def _line(r):
    fields = dict(zip(["hash", "from_address", "to_address", "value", "block_timestamp"], r))
    full = {c: "" for c in TRANSACTION_COLUMNS}
    full.update(fields)
    full.update(nonce="0", block_number="46205", transaction_index="0", gas="21000", transaction_type="0")
    return ",".join(full[c] for c in TRANSACTION_COLUMNS)


def test_dirty_csv_export_keeps_exactly_the_valid_rows(spark, tmp_path):
    lines = [",".join(TRANSACTION_COLUMNS)]
    for r in SAMPLE_TX:
        lines += [_line(r), "", ""]
    lines += ["[",
              "Row(hash='0x01f7', nonce='0', block_hash='0x9b43', block_number='46400', transaction_index='0', "
              "from_address='0xf55c', to_address='0x6baf', value='5000000000000000', gas='21000', "
              "gas_price='500000000000', input='0x', block_timestamp='1438920000', max_fee_per_gas=None, "
              "max_priority_fee_per_gas=None, transaction_type='0'),",
              "",
              "Row(hash='0x6c92', nonce='3', block_hash='0x249e', block_number='46402', transaction_index='0', "
              "from_address='0xa1e4', to_address=None, value='0', gas='24000', gas_price='1', input='0x60', "
              "block_timestamp='1438920100', max_fee_per_gas=None, max_priority_fee_per_gas=None, "
              "transaction_type='0')]"]
    path = tmp_path / "transactions.csv"
    path.write_text("\n".join(lines) + "\n")
    raw = readers.read_ledger_csv(spark, str(path), "transactions", header=True, typed=False)
    assert raw.count() == 12  # 9 rows, "[" and two Row(...) lines
    clean = clean_transactions(raw)
    assert clean.count() == 9
    typed = readers.read_ledger_csv(spark, str(path), "transactions", header=True)
    assert typed.filter("value IS NOT NULL AND block_timestamp IS NOT NULL").count() == 9


def test_headerless_contracts_with_quoted_lists(spark, tmp_path):
    text = ('0x4bd5f0,0x6060,"0x1234,0x5678",FALSE,FALSE,1438919175\n\n'
            '0xfd2605,0x6061,"",TRUE,false,46400\n')
    path = tmp_path / "contracts.csv"
    path.write_text(text)
    rows = readers.read_ledger_csv(spark, str(path), "contracts", header=False).orderBy("address").collect()
    assert [(r.address, r.function_sighashes, r.is_erc20, r.is_erc721, r.block_number) for r in rows] == [
        ("0x4bd5f0", "0x1234,0x5678", False, False, 1438919175),
        ("0xfd2605", None, True, False, 46400)]


def test_text_line_scan_splits_on_commas(spark, tmp_path):
    path = tmp_path / "blocks.csv"
    path.write_text("1,0xaa,0xbb,0x01,0x1d,0x00,0xc1,0xcd,0x7c,0x9558,17,17,897,0xd7,5000,0,1438919175,0,\n\n")
    df = readers.read_ledger_text_lines(spark, str(path), "blocks")
    r = df.collect()
    assert len(r) == 1 and r[0].miner == "0x9558" and r[0].size == "897"


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("08-2015", 9)], "month STRING, n BIGINT")
    schema = "month STRING, n BIGINT"
    for write, read in ((sinks.write_json, sinks.read_json_result), (sinks.write_csv, sinks.read_csv_result),
                        (sinks.write_text, sinks.read_text_result)):
        path = write(df, sinks.run_folder(str(tmp_path), write.__name__))
        assert "run=" in path and ":" not in path.rsplit("/", 1)[-1]
        assert [tuple(r) for r in read(spark, path, schema).collect()] == [("08-2015", 9)]


def test_headerless_blocks_feed_miners_and_overhead(spark, tmp_path):
    from chainscope.operators import blocks, overhead
    hexes = ["0x" + "1" * 64, "0x" + "0" * 512, "0x" + "a" * 64, "0x" + "b" * 64, "0x" + "c" * 64]
    lines = []
    for i, (miner, size) in enumerate([("0x9558", 897), ("0x2a65", 2000), ("0x2a65", 570), ("0x52bc", 3712)]):
        fields = [str(46000 + i), "0xh", "0xp", "0x01"] + hexes + [miner, "17", "17", str(size),
                  "0x" + "d" * 48, "5000", "0", "1438919175", "0", ""]
        lines += [",".join(fields), ""]
    path = tmp_path / "blocks.csv"
    path.write_text("\n".join(lines) + "\n")
    df = readers.read_ledger_csv(spark, str(path), "blocks", header=False)
    assert dict(df.dtypes)["size"] == "bigint" and dict(df.dtypes)["difficulty"] == "decimal(38,0)"
    top = [(r.miner, r.total_size) for r in blocks.top_miners(blocks.miner_block_size(df), 10).collect()]
    assert top == [("0x52bc", 3712), ("0x2a65", 2570), ("0x9558", 897)]
    assert overhead.hex_overhead(df).collect()[0].bit_count == 4 * 816 * 4


def test_out_of_range_index_becomes_null(spark):
    from chainscope.sources.schemas import TRANSACTIONS_TEXT, typed_transactions
    row = {c: None for c in TRANSACTIONS_TEXT.fieldNames()}
    row.update(hash="h", transaction_index="99999999999", value="1", block_timestamp="1")
    df = typed_transactions(spark.createDataFrame([row], TRANSACTIONS_TEXT))
    r = df.collect()[0]
    assert r.transaction_index is None and r.value == 1


def test_object_store_conf_has_no_credentials():
    from chainscope.session import object_store_conf
    conf = object_store_conf("store.example:8080")
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "store.example:8080"
    assert conf["spark.hadoop.fs.s3a.path.style.access"] == "true"
    assert conf["spark.hadoop.fs.s3a.connection.ssl.enabled"] == "false"
    assert not any("key" in k for k in conf)

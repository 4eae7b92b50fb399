from chainscope.plans import jobs
from chainscope.sources.schemas import BLOCK_COLUMNS, TRANSACTION_COLUMNS
from conftest import WASHED_TX


def _tx_csv(path, rows):
    lines = [",".join(TRANSACTION_COLUMNS)]
    for h, f, t, v, ts in rows:
        full = dict.fromkeys(TRANSACTION_COLUMNS, "")
        full.update(hash=h, from_address=f, to_address=t, value=v, block_timestamp=ts, nonce="0",
                    block_number="46205", transaction_index="0", gas="21000", transaction_type="0")
        lines.append(",".join(full[c] for c in TRANSACTION_COLUMNS))
    path.write_text("\n".join(lines) + "\n")


def test_jobs_end_to_end(spark, tmp_path):
    tx = tmp_path / "transactions.csv"
    # one extra row whose value does not parse: counted per month, not summed
    _tx_csv(tx, WASHED_TX + [("t10", "aa", "bb", "1.5", "1438919800")])
    cons = tmp_path / "contracts.csv"
    cons.write_text('4bd5f0,0x6060,"0x1,0x2",FALSE,FALSE,1\n\nfd2605,0x6061,"",FALSE,FALSE,2\n')
    blk = tmp_path / "blocks.csv"
    row = ["1", "0xh", "0xp", "0x01", "0x" + "1" * 64, "0x" + "0" * 512, "0x" + "a" * 64, "0x" + "b" * 64,
           "0x" + "c" * 64, "0x9558", "17", "17", "897", "0x" + "d" * 48, "5000", "0", "1438919175", "0", ""]
    blk.write_text(",".join(row) + "\n")
    out = str(tmp_path / "out")

    def read(path):
        return [r.asDict() for r in spark.read.json(path).collect()]

    w = jobs.run(spark, ["monthly-count", "--transactions", str(tx), "--out", out])
    assert [(r["month"], r["n_transactions"]) for r in read(w["monthly_transactions"])] == [("08-2015", 10)]
    w = jobs.run(spark, ["monthly-average", "--transactions", str(tx), "--out", out])
    assert read(w["avg_monthly_transactions"])[0]["avg_value"] == 1.1711105604518186e+20
    w = jobs.run(spark, ["top-contracts", "--transactions", str(tx), "--contracts", str(cons),
                         "--contracts-no-header", "--out", out])
    got = sorted((r["address"], int(r["total_value"])) for r in read(w["top10"]))
    assert got == [("4bd5f0", 803989500000000000000), ("fd2605", 31337)]
    w = jobs.run(spark, ["top-miners", "--blocks", str(blk), "--no-header", "--out", out])
    assert [(r["miner"], r["total_size"]) for r in read(w["top_miners"])] == [("0x9558", 897)]
    w = jobs.run(spark, ["overhead", "--blocks", str(blk), "--no-header", "--out", out, "--sink", "csv"])
    rows = spark.read.option("header", True).csv(w["data_overhead"]).collect()
    assert rows[0]["bit_count"] == str(816 * 4)
    w = jobs.run(spark, ["wash-trading", "--transactions", str(tx), "--out", out])
    sets = read(w["wash_sets"])
    assert [(r["set_key"], r["n_members"], r["occurrences"], r["is_candidate"]) for r in sets] == \
        [("3f2f38", 3, 1, False)]
    assert len(read(w["net_neutral_accounts"])) == 5
    assert [r["address"] for r in read(w["self_trades"])] == ["c8ebcc"]


def test_jobs_read_parquet_exports(spark, tmp_path):
    from conftest import TX_TEXT_SCHEMA
    text = spark.createDataFrame(WASHED_TX, TX_TEXT_SCHEMA)
    text_path = str(tmp_path / "tx_text")
    text.write.parquet(text_path)  # an all-text Parquet export is typed like the CSV
    out = str(tmp_path / "out")
    w = jobs.run(spark, ["monthly-average", "--transactions", text_path, "--format", "parquet", "--out", out])
    assert spark.read.json(w["avg_monthly_transactions"]).collect()[0]["avg_value"] == 1.1711105604518186e+20

import pytest
from pyspark.sql import functions as F

from chainscope.functions.columns import strict_int
from chainscope.operators import blocks
from chainscope.sources import schemas, sinks


def test_strict_int_fails_on_bad_text(spark):
    good = spark.createDataFrame([(" 12 ",), ("+5",), (None,), ("803989500000000000000",)], "s STRING")
    assert [r[0] for r in good.select(strict_int(F.col("s"))).collect()] == [12, 5, None, 803989500000000000000]
    for bad in ("1.5", "1e3", "n/a", ""):
        df = spark.createDataFrame([(bad,)], "s STRING")
        with pytest.raises(Exception, match="not a whole number"):
            df.select(strict_int(F.col("s"))).collect()


def test_bad_block_size_fails_the_job(spark):
    rows = spark.createDataFrame([("m1", "100"), ("m1", "20"), (None, "7"), ("m2", None)], "miner STRING, size STRING")
    got = {r.miner: r.total_size for r in blocks.miner_block_size(rows).collect()}
    assert got == {"m1": 120, None: 7}
    bad = rows.unionByName(spark.createDataFrame([("m3", "12kB")], "miner STRING, size STRING"))
    with pytest.raises(Exception, match="not a whole number"):
        blocks.miner_block_size(bad).collect()
    with pytest.raises(Exception, match="not a whole number"):
        schemas.typed_blocks(bad).collect()


def test_json_array_shape_and_nested_values(spark, tmp_path):
    rows = spark.createDataFrame([(1, "08-2015", 9, None), (2, 'a "b"\\', 10, 2.5), (3, "x", 11, 1.0)],
                                 "o INT, month STRING, n BIGINT, avg DOUBLE").orderBy("o").drop("o")
    path = sinks.write_json_array(rows, str(tmp_path / "array"), limit=2)
    text = "".join(p.read_text() for p in (tmp_path / "array").glob("part-*"))
    assert text.strip() == r'[["08-2015", 9, null], ["a \"b\"\\", 10, 2.5]]'
    got = sinks.read_json_array(spark, path, {"month": "string", "n": "bigint", "avg": "double"}).orderBy("pos").collect()
    assert [tuple(r) for r in got] == [(0, "08-2015", 9, None), (1, 'a "b"\\', 10, 2.5)]
    (tmp_path / "nested.txt").write_text('[["08-2015", [3, 1.5]], ["09-2015", [4, 2.0]]]')
    got = sinks.read_json_array(spark, str(tmp_path / "nested.txt"), {"month": "string", "v": "array<double>"}).collect()
    assert [tuple(r) for r in got] == [(0, "08-2015", [3.0, 1.5]), (1, "09-2015", [4.0, 2.0])]


def test_empty_json_array(spark, tmp_path):
    path = sinks.write_json_array(spark.createDataFrame([], "a STRING"), str(tmp_path / "none"), limit=5)
    assert sinks.read_json_array(spark, path, {"a": "string"}).count() == 0

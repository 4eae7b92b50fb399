import uuid

from chainscope.operators import timeseries
from chainscope.session import checkpoint_dir
from chainscope.streaming.monthly import run_monthly_snapshot
from conftest import SAMPLE_TX, typed


def test_stream_resumes_from_state_and_matches_batch(spark):
    base = f"{checkpoint_dir(spark).rstrip('/')}/test-stream-{uuid.uuid4().hex[:8]}"
    rows = SAMPLE_TX + [(f"n{i}", "aa", "bb", str(10 ** 20 + i), str(1441065600 + 86400 * i)) for i in range(40)]
    df = typed(spark, rows)
    first, second = df.filter("hash < 'n2'"), df.filter("hash >= 'n2'")
    schema = df.schema
    first.write.parquet(f"{base}/landing/part=1")
    run_monthly_snapshot(spark, f"{base}/landing/part=1", schema, f"{base}/out", f"{base}/state")
    partial = {r.month: r.n_transactions for r in spark.read.parquet(f"{base}/out").collect()}
    assert sum(partial.values()) == first.count()
    # new files in the same folder: only they are read, the state carries the rest
    second.write.mode("append").parquet(f"{base}/landing/part=1")
    run_monthly_snapshot(spark, f"{base}/landing/part=1", schema, f"{base}/out", f"{base}/state")
    got = sorted((r.month, r.n_transactions, r.total_value) for r in spark.read.parquet(f"{base}/out").collect())
    want = sorted((r.month, r.n_transactions, r.total_value) for r in timeseries.monthly_count_sum(df).collect())
    assert got == want

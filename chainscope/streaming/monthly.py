"""Monthly transaction statistics over a growing folder of ledger files.

The same aggregation as :func:`chainscope.operators.timeseries.monthly_count_sum`,
run by Structured Streaming: new files are picked up incrementally and the
state holds one row per month (a few hundred rows for the whole chain), so
complete output mode stays cheap. Each micro-batch replaces a Parquet
snapshot of the table through ``foreachBatch``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from chainscope.functions.columns import WEI, month_label, month_start


def monthly_totals(stream: DataFrame, time_col: str = "block_timestamp", value_col: str = "value") -> DataFrame:
    """Streaming aggregate (month, month_start, n_transactions, total_value)."""
    dtype = stream.schema[time_col].dataType
    m = stream.withColumn("month_start", month_start(F.col(time_col), dtype))
    agg = (m.filter(F.col("month_start").isNotNull() & F.col(value_col).isNotNull())
           .groupBy("month_start")
           .agg(F.count(F.lit(1)).alias("n_transactions"),
                F.sum(F.col(value_col).cast(WEI)).cast(WEI).alias("total_value")))
    return agg.select(month_label(F.col("month_start")).alias("month"), "month_start",
                      "n_transactions", "total_value")


def run_monthly_snapshot(spark: SparkSession, source_dir: str, schema: StructType | str, output_dir: str,
                         checkpoint_location: str, time_col: str = "block_timestamp",
                         value_col: str = "value", available_now: bool = True,
                         max_files_per_trigger: int | None = None, state_partitions: int = 4):
    """Start (and with ``available_now`` finish) the streaming job.

    ``checkpoint_location`` keeps offsets and state; it must be on shared
    storage so the job resumes after a driver or executor loss. The state is
    one row per month whatever the input size (rows are combined per task
    before the shuffle), so it lives in ``state_partitions`` partitions; the
    number is fixed when the query first starts and kept by its checkpoint.
    """
    # A child session (same SparkContext, own SQL settings) fixes the state
    # partitioning for this query without touching the caller's settings.
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    reader = session.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    totals = monthly_totals(reader.parquet(source_dir), time_col, value_col)

    def publish(batch: DataFrame, batch_id: int) -> None:
        batch.coalesce(1).write.mode("overwrite").parquet(output_dir)

    writer = (totals.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query

"""Result sinks. Files are written by the executors, never through the driver.

A run folder is ``<base>/<name>/run=<yyyyMMdd_HHmmss>``: sortable, and free
of the ':' that Hadoop paths reject.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def run_folder(base: str, name: str, when: datetime | None = None) -> str:
    stamp = (when or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M%S")
    return f"{base.rstrip('/')}/{name}/run={stamp}"


def _bounded(df: DataFrame, limit: int | None, single_file: bool | None) -> DataFrame:
    if limit is not None:
        df = df.limit(limit)
    # One output file only when asked for or when a limit bounds the result;
    # otherwise every partition writes its own file in parallel.
    if single_file is None:
        single_file = limit is not None
    return df.coalesce(1) if single_file else df


def write_json(df: DataFrame, path: str, limit: int | None = None, single_file: bool | None = None) -> str:
    _bounded(df, limit, single_file).write.mode("overwrite").json(path)
    return path


def write_csv(df: DataFrame, path: str, limit: int | None = None, single_file: bool | None = None,
              header: bool = True) -> str:
    _bounded(df, limit, single_file).write.mode("overwrite").option("header", header).csv(path)
    return path


def write_text(df: DataFrame, path: str, limit: int | None = None, single_file: bool | None = None) -> str:
    """One JSON object per line in a text file (the text-directory sink)."""
    lines = df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("value"))
    _bounded(lines, limit, single_file).write.mode("overwrite").text(path)
    return path


def write_json_array(df: DataFrame, path: str, limit: int) -> str:
    """The first ``limit`` rows as one JSON array of value lists, such as
    ``[["08-2015", 85609], ["09-2015", 173805]]``, on a single line; ``limit``
    bounds what the one writing task holds. The rows keep the order of ``df``."""
    values = [F.regexp_replace(F.to_json(F.array(F.col(c)), {"ignoreNullFields": "false"}), r"^\[|\]$", "") for c in df.columns]
    row = F.concat(F.lit("["), F.concat_ws(", ", *values), F.lit("]"))
    first = df.limit(limit).coalesce(1).select(F.monotonically_increasing_id().alias("pos"), row.alias("row"))
    lines = first.agg(F.sort_array(F.collect_list(F.struct("pos", "row"))).alias("rows")).select(
        F.concat(F.lit("["), F.concat_ws(", ", F.col("rows.row")), F.lit("]")).alias("value"))
    lines.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_json_array(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """(pos, ...) of a stored array of value lists, by position; a nested list
    is read as the type its column is given. One row holds a whole stored
    array, which its writer bounds."""
    rows = spark.read.option("wholetext", True).text(path).select(
        F.posexplode(F.from_json("value", "array<string>")).alias("pos", "row"))
    parts = rows.select("pos", F.from_json("row", "array<string>").alias("v"))

    def value(i: int, kind: str):
        c = F.try_element_at("v", F.lit(i + 1))
        return F.from_json(c, kind) if kind.startswith(("array", "struct", "map")) else c.cast(kind)
    return parts.select("pos", *[value(i, kind).alias(name) for i, (name, kind) in enumerate(columns.items())])


def read_json_result(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_csv_result(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_text_result(spark: SparkSession, path: str, schema) -> DataFrame:
    parsed = spark.read.text(path).select(F.from_json("value", schema).alias("r"))
    return parsed.select("r.*")

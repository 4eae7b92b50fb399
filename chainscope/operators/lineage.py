"""Lineage cuts for iterative operators.

Each intermediate result of a loop is written as Parquet under the
session's reliable checkpoint folder and read back. This cuts the lineage
(the plan no longer grows with the number of rounds), survives the loss of
executors, and gives AQE exact sizes for its join choices.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chainscope.session import checkpoint_dir


def large(df: DataFrame) -> DataFrame:
    """One side of a join of tables that both grow with the input. Spark
    judges a table by its files or by what shuffles have written, and sends
    one below the broadcast threshold through the driver, where it takes more
    room than in Parquet, several times a round. A merge join sends nothing
    there, and AQE still splits its hot keys."""
    return df.hint("merge")


class Scratch:
    """A folder of intermediate tables under the checkpoint directory."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/chainscope-{tag}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        self._n += 1
        path = f"{self.base}/{self._n:05d}-{name}"
        df.write.mode("overwrite").parquet(path)
        return self._read(df, path)

    def _read(self, df: DataFrame, path: str) -> DataFrame:
        # The schema is known: no job to look it up in the files.
        return self.spark.read.schema(df.schema).parquet(path)

    def save_counted(self, df: DataFrame, name: str, flag: Column | None = None) -> tuple[DataFrame, int]:
        """Write like :meth:`save` and return the number of rows written
        (or of rows where ``flag`` holds), observed during the write itself
        instead of by a second job. A stage re-run after an executor loss can
        only over-count, which costs a loop one extra round, never a wrong
        result."""
        self._n += 1
        obs = Observation(f"{name}-{self._n}")
        metric = F.count(F.lit(1)) if flag is None else F.count(F.when(flag, F.lit(1)))
        path = f"{self.base}/{self._n:05d}-{name}"
        df.observe(obs, metric.alias("n")).write.mode("overwrite").parquet(path)
        out = self._read(df, path)
        got = observed(obs)
        if got is None:  # nothing was processed, so no metrics: count the (small) table
            got = {"n": out.count() if flag is None else out.filter(flag).count()}
        return out, int(got["n"] or 0)

    def save_measured(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """Write like :meth:`save` and return aggregates over the rows written.
        A re-run stage can make counts too large and leaves maxima as they
        are, so callers use them only to choose a path."""
        self._n += 1
        obs = Observation(f"{name}-{self._n}")
        named = [c.alias(n) for n, c in metrics.items()]
        path = f"{self.base}/{self._n:05d}-{name}"
        df.observe(obs, *named).write.mode("overwrite").parquet(path)
        out = self._read(df, path)
        got = observed(obs)
        if got is None:  # nothing was processed, so no metrics: ask the (small) table
            got = out.agg(*named).collect()[0].asDict()
        return out, got

    @staticmethod
    def _place(path: str) -> str:
        # "file:/x" and "file:///x" are the same folder.
        return "/" + path.split(":", 1)[-1].strip("/")

    def drop(self, df: DataFrame) -> None:
        """Delete the files behind a saved table that is no longer read."""
        for path in df.inputFiles()[:1]:
            folder = path.rsplit("/", 1)[0]
            if self._place(self.base) in self._place(folder):
                jvm = self.spark.sparkContext._jvm
                hpath = jvm.org.apache.hadoop.fs.Path(folder)
                hpath.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)


# Called before the scratch tables go, to drop what still refers to them.
_ON_CLEAR: list = []


def on_clear(callback) -> None:
    _ON_CLEAR.append(callback)


def snapshot(spark: SparkSession, path: str) -> tuple:
    """The files of a table with their lengths and modification times."""
    sc = spark.sparkContext
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    found = hpath.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(hpath)
    return (path, *sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))


def clear_scratch(spark: SparkSession) -> int:
    """Delete every intermediate table this package wrote under the
    checkpoint folder (call once the results that read them are written).
    Returns the number of folders removed."""
    for callback in _ON_CLEAR:
        callback()
    sc = spark.sparkContext
    jvm = sc._jvm
    base = jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = base.getFileSystem(sc._jsc.hadoopConfiguration())
    removed = 0
    for status in fs.listStatus(base):
        if status.getPath().getName().startswith("chainscope-"):
            fs.delete(status.getPath(), True)
            removed += 1
    return removed


def observed(obs: Observation) -> dict | None:
    """Metrics of an observation, or None when the observed plan processed
    no partition (an empty input produces no metrics row)."""
    try:
        return obs.get
    except Exception:  # noqa: BLE001 - Spark raises a JVM assertion error here
        return None

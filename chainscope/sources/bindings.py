"""Ledger-shaped views over the driver's test tables.

The test data holds no ledger export, so each operator input is derived
from a driver table by Spark (its size grows with the table). Every view has
a Spark definition and the equivalent DuckDB SQL (used by the oracle); the
two must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainscope.functions.columns import WEI
from chainscope.sources.schemas import TRANSACTION_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _cents(c):
    return F.round(c * 100).cast(WEI)


def _k(props_col="props"):
    return F.regexp_extract(F.col(props_col), r"([0-9]+)", 1)


def tx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transfers to the customer: value in cents, time = order date."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("hash"),
                    F.col("o_custkey").cast("string").alias("to_address"),
                    _cents(F.col("o_totalprice")).alias("value"),
                    F.col("o_orderdate").alias("block_timestamp"))


TX_ORDERS_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS hash, CAST(o_custkey AS VARCHAR) AS to_address,
  CAST(round(o_totalprice * 100) AS DECIMAL(38,0)) AS value, o_orderdate AS block_timestamp FROM orders"""


def contracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as contracts (address, bytecode)."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("address"), F.col("c_name").alias("bytecode"))


CONTRACTS_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS address, c_name AS bytecode FROM customer"""


def blocks_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as blocks: miner = supplier (some without one), size = quantity."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.when(F.col("l_orderkey") % 29 != 0, F.col("l_suppkey").cast("string")).alias("miner"),
                     F.col("l_quantity").cast("bigint").alias("size"))


BLOCKS_SIZE_SQL = """SELECT CASE WHEN l_orderkey % 29 <> 0 THEN CAST(l_suppkey AS VARCHAR) END AS miner, CAST(l_quantity AS BIGINT) AS size FROM lineitem"""


def blocks_hex(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as blocks with hex columns (some NULL, one never hex)."""
    d = table(spark, sf_dir, "documents")
    return d.select(
        F.concat(F.lit("0x"), F.md5(F.col("text"))).alias("sha3_uncles"),
        F.concat(F.lit("0x"), F.lower(F.hex(F.col("text")))).alias("logs_bloom"),
        F.when(F.col("lang") == "en", F.concat(F.lit("0x"), F.md5(F.col("source")))).alias("transactions_root"),
        F.lit(None).cast("string").alias("state_root"),
        F.lit(None).cast("string").alias("receipts_root"),
        F.col("source").alias("extra_data"),
    )


BLOCKS_HEX_SQL = """SELECT '0x' || md5(text) AS sha3_uncles, '0x' || lower(hex(text)) AS logs_bloom,
  CASE WHEN lang = 'en' THEN '0x' || md5(source) END AS transactions_root,
  CAST(NULL AS VARCHAR) AS state_root, CAST(NULL AS VARCHAR) AS receipts_root, source AS extra_data
  FROM documents"""


def tx_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an all-text transaction export with malformed fields:
    non-numeric and fractional values, missing/empty receivers, unparsable
    times."""
    e = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = _k()
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)").cast("string")
    return e.select(
        eid.cast("string").alias("hash"),
        F.concat(F.lit("a"), F.col("user_id").cast("string")).alias("from_address"),
        F.when(eid % 13 == 0, F.lit(None).cast("string")).when(eid % 17 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("a"), k)).alias("to_address"),
        F.when(eid % 7 == 0, F.lit("n/a")).when(eid % 11 == 0, F.lit("1.5")).otherwise(k).alias("value"),
        F.when(eid % 19 == 0, F.lit("pending")).otherwise(epoch).alias("block_timestamp"),
    )


TX_RAW_SQL = r"""SELECT CAST(event_id AS VARCHAR) AS hash, 'a' || CAST(user_id AS VARCHAR) AS from_address,
  CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 17 = 0 THEN ''
       ELSE 'a' || regexp_extract(props, '([0-9]+)', 1) END AS to_address,
  CASE WHEN event_id % 7 = 0 THEN 'n/a' WHEN event_id % 11 = 0 THEN '1.5'
       ELSE regexp_extract(props, '([0-9]+)', 1) END AS value,
  CASE WHEN event_id % 19 = 0 THEN 'pending' ELSE CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) END
       AS block_timestamp
  FROM events"""


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`tx_raw` in the column order of the export; the fields it lacks
    are empty."""
    raw = tx_raw(spark, sf_dir)
    return raw.select(*[F.col(n) if n in raw.columns else F.lit("").alias(n) for n in TRANSACTION_COLUMNS])


def ledger_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`ledger_rows` as comma-separated text; the lines of hashes
    divisible by 23 break off after three fields."""
    rows = ledger_rows(spark, sf_dir)
    fields = [F.coalesce(F.col(n), F.lit("")) for n in rows.columns]
    return rows.select(F.when(F.col("hash").cast("bigint") % 23 == 0, F.concat_ws(",", *fields[:3]))
                       .otherwise(F.concat_ws(",", *fields)).alias("value"))


def transfers_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as transfers between per-day accounts of users of the same
    hundred (accounts grow with the table, some self-trades)."""
    e = table(spark, sf_dir, "events")
    day = F.dayofmonth("ts").cast("string")
    return e.select(
        F.col("event_id").cast("string").alias("hash"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("d"), day).alias("from_address"),
        F.concat(F.lit("u"), (F.floor(F.col("user_id") / 100) * 100 + _k().cast("bigint")).cast("string"),
                 F.lit("d"), day).alias("to_address"),
        _cents(F.col("value")).alias("value"),
        F.col("ts").alias("block_timestamp"),
        F.col("event_type").alias("token_type"),
    )


TRANSFERS_DAY_SQL = r"""SELECT CAST(event_id AS VARCHAR) AS hash,
  'u' || CAST(user_id AS VARCHAR) || 'd' || CAST(day(ts) AS VARCHAR) AS from_address,
  'u' || CAST(user_id // 100 * 100 + CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS VARCHAR)
    || 'd' || CAST(day(ts) AS VARCHAR) AS to_address,
  CAST(round(value * 100) AS DECIMAL(38,0)) AS value, ts AS block_timestamp, event_type AS token_type
  FROM events"""


# Shape of the trading groups below: users side by side share a group, and
# days a period.
GROUP_USERS, PERIOD_DAYS, PERIODS = 5, 5, 6


def transfers_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a transfer among accounts of one user and period, so
    accounts, edges and components grow with the table.

    Users trade within small groups, low numbers more, so edges repeat and
    sets nest over many peeling rounds. One event in 34 goes to the next
    group, in the first period also one to the group before: there components
    run through many groups, elsewhere such edges close no loop. A third of
    the groups moves a fixed amount, so balanced sets occur."""
    e = table(spark, sf_dir, "events")
    period = F.floor(F.dayofmonth("ts") / PERIOD_DAYS) % PERIODS
    group = F.floor(F.col("user_id") / GROUP_USERS)
    shift = F.when(F.col("event_id") % 34 == 0, 1).when((F.col("event_id") % 34 == 17) & (period == 0), -1).otherwise(0)
    k = _k().cast("bigint")
    other = F.greatest(group + shift, F.lit(0)) * GROUP_USERS + F.floor(k * k * GROUP_USERS / 10000)

    def account(user):
        return F.concat(F.lit("u"), user.cast("bigint").cast("string"), F.lit("p"), period.cast("string"))

    return e.select(
        F.col("event_id").cast("string").alias("hash"),
        account(F.col("user_id")).alias("from_address"),
        account(other).alias("to_address"),
        F.when(group % 3 == 1, F.lit(500).cast(WEI)).otherwise(_cents(F.col("value"))).alias("value"),
        F.col("ts").alias("block_timestamp"),
        F.col("event_type").alias("token_type"),
    )


TRANSFERS_GROUPS_SQL = rf"""SELECT CAST(event_id AS VARCHAR) AS hash,
  'u' || user_id || 'p' || period AS from_address, 'u' || (greatest(user_id // {GROUP_USERS}
    + CASE WHEN event_id % 34 = 0 THEN 1 WHEN event_id % 34 = 17 AND period = 0 THEN -1 ELSE 0 END, 0) * {GROUP_USERS}
    + k * k * {GROUP_USERS} // 10000) || 'p' || period AS to_address,
  CAST(CASE WHEN user_id // {GROUP_USERS} % 3 = 1 THEN 500 ELSE round(value * 100) END AS DECIMAL(38,0)) AS value,
  ts AS block_timestamp, event_type AS token_type
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
        day(ts) // {PERIOD_DAYS} % {PERIODS} AS period FROM events)"""

"""Batch jobs over a ledger export, for ``spark-submit``.

    spark-submit chainscope/plans/jobs.py monthly-count   --transactions PATH --out BASE
    spark-submit chainscope/plans/jobs.py monthly-average --transactions PATH --out BASE
    spark-submit chainscope/plans/jobs.py top-contracts   --transactions PATH --contracts PATH --out BASE
    spark-submit chainscope/plans/jobs.py top-miners      --blocks PATH --out BASE [--ascending]
    spark-submit chainscope/plans/jobs.py overhead        --blocks PATH --out BASE
    spark-submit chainscope/plans/jobs.py wash-trading    --transactions PATH --out BASE

Inputs are the CSV export (``--format csv``, header on by default,
``--no-header`` for header-less files) or Parquet with the same column
names. Each result is written by the executors under
``BASE/<result>/run=<yyyyMMdd_HHmmss>`` as JSON (``--sink csv|text`` for the
other formats). The session is the one ``spark-submit`` configures.
"""

from __future__ import annotations

import argparse
import os
import sys
from datetime import datetime, timezone

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from chainscope.operators import (blocks, cleaning, contracts, detect, graph, overhead, peeling,  # noqa: E402
                                  timeseries, transfers)
from chainscope.operators.lineage import Scratch  # noqa: E402
from chainscope.sources import readers, schemas, sinks  # noqa: E402

WRITERS = {"json": sinks.write_json, "csv": sinks.write_csv, "text": sinks.write_text}
TYPERS = {"transactions": schemas.typed_transactions, "contracts": schemas.typed_contracts,
          "blocks": schemas.typed_blocks}


def read_input(spark: SparkSession, path: str, kind: str, fmt: str, header: bool) -> DataFrame:
    if fmt == "parquet":
        df = spark.read.parquet(path)
        text_cols = [c for c, t in df.dtypes if t == "string"]
        # Parquet exports may hold numbers as text; type them like the CSV.
        return TYPERS[kind](df) if len(text_cols) == len(df.columns) else df
    return readers.read_ledger_csv(spark, path, kind, header=header)


def _transactions(spark, args, require_value: bool = True) -> DataFrame:
    """Transactions whose time (and, unless counting only, value) parse."""
    raw = read_input(spark, args.transactions, "transactions", args.format, args.header)
    return cleaning.clean_transactions(raw, value_col="value" if require_value else None)


def job_results(spark: SparkSession, args) -> dict[str, DataFrame]:
    """The result tables of one job, by name."""
    if args.job == "monthly-count":
        return {"monthly_transactions": timeseries.monthly_count(_transactions(spark, args, require_value=False))}
    if args.job == "monthly-average":
        return {"avg_monthly_transactions": timeseries.monthly_average(_transactions(spark, args))}
    if args.job == "top-contracts":
        tx = read_input(spark, args.transactions, "transactions", args.format, args.header)
        cons = read_input(spark, args.contracts, "contracts", args.format, args.contracts_header)
        totals = contracts.value_received(tx)
        return {"top10": contracts.top_contracts(totals, cons, k=args.k)}
    if args.job == "top-miners":
        blk = read_input(spark, args.blocks, "blocks", args.format, args.header)
        return {"top_miners": blocks.top_miners(blocks.miner_block_size(blk), args.k, ascending=args.ascending)}
    if args.job == "overhead":
        blk = read_input(spark, args.blocks, "blocks", args.format, args.header)
        return {"data_overhead": overhead.hex_overhead(blk)}
    if args.job == "wash-trading":
        # Six results are written as six actions: the cleaned transfers (only
        # the columns used) and the edge list are landed once as Parquet, so
        # the raw export is read and parsed a single time.
        scratch = Scratch(spark, "wash-job")
        tx = scratch.save(_transactions(spark, args).select(
            "hash", "from_address", "to_address", "value", "block_timestamp"), "transactions")
        kept = transfers.without_self_trades(tx)
        net, stats = transfers.net_positions(kept), transfers.transfer_stats(kept)
        edges = scratch.save(graph.graph_edges(kept), "edges")
        tree = peeling.merge_tree(spark, edges)
        sets = scratch.save(detect.volume_match(detect.scc_occurrences(tree), tree, net).withColumn(
            "is_candidate", F.col("occurrences") >= F.lit(args.threshold)), "sets")
        matched = scratch.save(detect.matched_sets(tree, net, args.threshold), "matched")
        return {
            "self_trades": transfers.self_trade_summary(tx),
            "net_neutral_accounts": transfers.net_neutral(net, stats),
            "wash_sets": sets,
            "wash_set_members": detect.set_members(tree).join(
                sets.filter("is_candidate").select(*detect.SET), detect.SET, "left_semi"),
            "wash_suspects": detect.wash_suspects(tree, matched),
            "top_wash_traders": detect.top_wash_trader(tree, matched, edges, k=args.k),
        }
    raise ValueError(f"unknown job {args.job}")


def parse_args(argv: list[str] | None = None):
    p = argparse.ArgumentParser(prog="chainscope-jobs")
    p.add_argument("job", choices=["monthly-count", "monthly-average", "top-contracts", "top-miners",
                                   "overhead", "wash-trading"])
    p.add_argument("--transactions")
    p.add_argument("--contracts")
    p.add_argument("--blocks")
    p.add_argument("--out", required=True, help="base folder of the results (shared storage)")
    p.add_argument("--format", choices=["csv", "parquet"], default="csv")
    p.add_argument("--no-header", dest="header", action="store_false")
    p.add_argument("--contracts-no-header", dest="contracts_header", action="store_false")
    p.add_argument("--sink", choices=sorted(WRITERS), default="json")
    p.add_argument("--k", type=int, default=10)
    p.add_argument("--ascending", action="store_true")
    p.add_argument("--threshold", type=int, default=detect.SCC_OCCURRENCE_THRESHOLD)
    return p.parse_args(argv)


def run(spark: SparkSession, argv: list[str] | None = None) -> dict[str, str]:
    """Run one job and return the folders written, by result name."""
    args = parse_args(argv)
    when = datetime.now(timezone.utc)
    written = {}
    for name, df in job_results(spark, args).items():
        written[name] = WRITERS[args.sink](df, sinks.run_folder(args.out, name, when))
    return written


def main() -> None:
    parse_args(sys.argv[1:])  # usage errors and --help before any session starts
    spark = SparkSession.builder.appName("chainscope-jobs").getOrCreate()
    for name, path in run(spark, sys.argv[1:]).items():
        print(f"{name}\t{path}")
    spark.stop()


if __name__ == "__main__":
    main()

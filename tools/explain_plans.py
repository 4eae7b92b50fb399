"""Write PLANS.md: the executed (AQE-final) physical plans of representative
queries, trimmed to operators, pushed filters, read schemas and join types.

    python tools/explain_plans.py [sf_dir]
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from chainscope.plans.queries import QUERIES  # noqa: E402
from chainscope.session import local_session  # noqa: E402

SHOWN = ["top10_contracts", "monthly_count_sum", "net_neutral_accounts", "hex_overhead",
         "self_trade_summary", "reciprocal_pairs", "cycles_3", "wash_sets"]
KEEP = re.compile(r"^(\(\d+\) .*|PushedFilters.*|ReadSchema.*|Join type.*|Join condition.*|"
                  r"Functions.*|Keys.*|Arguments.*|.*Subquery.*|.*ReusedExchange.*|[ +:*-].*)$")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 16)
    out = ["# Physical plans", "",
           f"Executed plans at `{os.path.basename(sf_dir)}` (`local[8]`, AQE on), produced by "
           "`python tools/explain_plans.py`. Trimmed to operators, pushed filters, read schemas, "
           "join types and aggregate functions. Iterative operators (SCC peeling, ranked edges) "
           "read their materialised tables, so their plans start at those Parquet scans.", ""]
    for name in SHOWN:
        df = QUERIES[name](spark, sf_dir)
        df.collect()  # run this DataFrame so explain shows AQE's final plan (results here are small)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        lines = [ln.rstrip() for ln in buf.getvalue().splitlines() if ln.strip() and KEEP.match(ln.strip())]
        out += [f"## {name}", "", "```", *lines, "```", ""]
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()

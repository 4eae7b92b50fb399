import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from chainscope.session import local_session  # noqa: E402

# Sample transfers (addresses shortened to 6 hex characters), file order.
SAMPLE_TX = [
    ("t1", "3f2f38", "4bd5f0", "803989500000000000000", "1438919175"),
    ("t2", "a1e438", "c9d403", "31337", "1438919394"),
    ("t3", "c8ebcc", "c8ebcc", "0", "1438919451"),
    ("t4", "a1e438", "5df9b8", "31337", "1438919461"),
    ("t5", "f0cf0a", "b60877", "100000000000000000000", "1438919491"),
    ("t6", "1c68a6", "c8ebcc", "50000000000000000000", "1438919571"),
    ("t7", "fd2605", "073f70", "10000000000000000", "1438919655"),
    ("t8", "bbed46", "bf8d8b", "4406636741121", "1438919696"),
    ("t9", "8ce494", "15e34a", "100000000000000000000", "1438919756"),
]
# The edited copy closes the loop 3f2f38 -> 4bd5f0 -> fd2605 -> 3f2f38.
WASHED_TX = [r for r in SAMPLE_TX]
WASHED_TX[3] = ("t4", "4bd5f0", "fd2605", "31337", "1438919461")
WASHED_TX[6] = ("t7", "fd2605", "3f2f38", "10000000000000000", "1438919655")

TX_TEXT_SCHEMA = "hash STRING, from_address STRING, to_address STRING, value STRING, block_timestamp STRING"


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, shuffle_partitions=4, app_name="chainscope-tests")
    yield s
    s.stop()


def typed(spark, rows):
    from chainscope.operators.cleaning import clean_transactions
    return clean_transactions(spark.createDataFrame(rows, TX_TEXT_SCHEMA))

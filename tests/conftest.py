import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tradelens.schema import TRADE_SCHEMA  # noqa: E402
from tradelens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="tradelens-test-ckpt-")
    s = build_session("local[4]", shuffle_partitions=4, extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def make_trade(spark, rows):
    """rows: (FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH, VALUE, QTY1)."""
    return spark.createDataFrame(rows, TRADE_SCHEMA)


def monthly_rows(flow, reporter, partner, year_months_qty, commodity="3102"):
    return [(flow, reporter, partner, commodity, y, m, 1.0, q) for (y, m, q) in year_months_qty]

"""One ingest run: landed extract files -> enriched rows -> keep-last upsert.

The reference's run picks full or incremental mode, reads the extract,
derives the dimension columns, merges with the stored rows keeping the last
version of every key, writes the table and logs row counts. Here each step
is a Spark job over the landed files and the stored table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..dims import Dims
from ..operators._util import small_table
from ..operators.enrich import enrich_trade
from ..operators.load import since
from ..schema import EXTRACT_COLUMNS
from . import commits, files
from .extract import read_extracts
from .table import recorded_audit, upsert_table


def stored_begin(spark: SparkSession, table_path: str, flow: str) -> str | None:
    """January of the flow's latest stored year as 'YYYY01', by the write record
    (no scan); None when nothing is stored."""
    stored = map(files.partition_values, commits.last(spark, table_path)["partitions"])
    years = [int(year) for f, year in stored if f == flow and year is not None]
    return f"{max(years)}01" if years else None


def ingest(spark: SparkSession, landing: str, table_path: str, flow: str, dims: Dims,
           full: bool = False, columns=EXTRACT_COLUMNS, low_water: bool = True) -> DataFrame:
    """Load every extract file under ``landing`` for ``flow`` into the table.

    Full mode replaces all rows of ``flow``, other flows stay. Incremental
    mode takes the landed rows from the low-water mark on (January of the
    flow's latest stored year; ``low_water=False`` takes them all) and
    replaces only the (FLOW, YEAR) partitions they touch with stored + new
    rows, newest version kept. ``columns`` are the extract's required columns
    (``COTTON_COLUMNS`` for extracts without a value). Returns the audit per
    flow from the commit's record: no stored row is counted.
    """
    commits.settle(spark, table_path)
    landed = read_extracts(spark, landing, flow, columns=columns, arrival=True)
    begin = stored_begin(spark, table_path, flow) if low_water and not full else None
    if begin:
        landed = since(landed, begin)
    new = small_table(enrich_trade(landed, dims), "landed")       # the extract is parsed once
    fetched = {flow: new.count()}                                 # from the written files' footers
    upsert_table(new, table_path, full=full, fetched=fetched)
    files.delete(spark, new.inputFiles()[0].rsplit("/", 1)[0])
    return recorded_audit(spark, table_path)

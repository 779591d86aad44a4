"""Cubes that follow the stored trade table.

A cube holds sums of the quantity per calendar month and some dimensions. It
is a table of its own, partitioned as the trade table by (FLOW, YEAR), and its
notes say from which version of every partition it was made. After a load only
the partitions whose version moved on are read and summed again. Sums of one
calendar year never mix with another's, so the merged cube equals a fresh one.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import FLOW, MONTH, PARTNER, QTY1, REGION, REPORTER, YEAR
from . import commits, files
from .table import _of_partitions, _ordered_schema, _partitions, _row_counts, read_table

#: Dimensions of the cubes: period cutoffs and monthly series, drilldown, mirror.
REPORTER_CUBE, DRILL_CUBE, MIRROR_CUBE = [REPORTER], [REGION, PARTNER], [REPORTER, PARTNER]


def stale_partitions(table: dict, cube: dict) -> tuple[list[str], list[str]]:
    """(partitions to sum again, partitions that are gone), by the last notes."""
    made = cube.get("audit", {}).get("source", {})
    versions = {p: e["version"] for p, e in table["partitions"].items()}
    return [p for p, v in versions.items() if made.get(p) != v], [p for p in made if p not in versions]


def cube_rows(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Sum of QTY1 per flow, dimension values, year and month; rows without one of
    the dimensions stay out, as the standard selection leaves them out."""
    for c in dims:
        rows = rows.where(F.col(c).isNotNull())
    return rows.groupBy(FLOW, *dims, YEAR, MONTH).agg(F.coalesce(F.sum(QTY1), F.lit(0.0)).alias(QTY1))


def refresh_cube(spark: SparkSession, table_path: str, cube_path: str, dims: list[str], where=None) -> list[str]:
    """Bring the cube at ``cube_path`` up to the table; returns the partitions that
    were summed again. ``where`` filters the rows first (always the same one)."""
    while True:
        table, cube, run, started = commits.settle(spark, table_path), commits.settle(spark, cube_path), uuid.uuid4().hex, time.time()
        stale, gone = stale_partitions(table, cube)
        if not stale and not gone:
            return []
        home, staged = f"{cube_path}/{commits.RUNS}/{run}", {p: ([], 0) for p in gone}
        rows = cube_rows(stale_rows(spark, table_path, stale, where), dims)
        schema = _ordered_schema(rows.schema)
        if stale:
            rows.hint("rebalance", FLOW, YEAR).write.partitionBy(FLOW, YEAR).parquet(f"{home}/sums")
            counts, found = _row_counts(spark, f"{home}/sums", schema), set(_partitions(spark, f"{home}/sums"))
            staged |= {p: ([f"sums/{p}/{n}" for n in commits.data_files(spark, f"{home}/sums/{p}")], counts[p]) if p in found else ([], 0) for p in stale}
        source = {p: e["version"] for p, e in table["partitions"].items()}
        # a load that commits meanwhile has moved files away: the cube then stands for the version it read
        if commits.last(spark, table_path)["version"] == table["version"] and commits.commit(
                spark, cube_path, cube, run, staged, schema.json(), started, audit={"source": source}) is not None:
            return sorted(stale)
        files.delete(spark, home)


def stale_rows(spark: SparkSession, table_path: str, stale: list[str], where=None) -> DataFrame:
    """Stored rows of the partitions to sum again (the scan is pruned to them)."""
    rows = read_table(spark, table_path)
    rows = rows if where is None else rows.where(where)
    return _of_partitions(rows, stale)


def read_cube(spark: SparkSession, cube_path: str) -> DataFrame:
    """The cube's rows: FLOW, YEAR, MONTH, its dimensions and QTY1."""
    note = commits.last(spark, cube_path)
    return spark.read.schema(T.StructType.fromJson(json.loads(note["schema"]))).parquet(cube_path)

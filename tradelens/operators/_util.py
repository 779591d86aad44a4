"""Small helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..session import scratch_path


def win(keys: list[str]) -> WindowSpec:
    """Window over one series. Operators only use it on rows already reduced
    to one per (series, period), so a partition holds at most one series'
    periods, never raw rows."""
    return Window.partitionBy(*keys)


def join_on_keys(df: DataFrame, stats: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Attach per-series statistics (one row per key) to ``df``.

    With keys, pass statistics read from a written or cached frame
    (``small_table``): their size is known when the join is planned, so the
    rows of ``df`` are shuffled only when the statistics are too large to
    broadcast. Without keys they are a single-row global aggregate, so the
    broadcast is bounded by construction.
    """
    if keys:
        return df.join(stats, keys, how)
    return df.crossJoin(F.broadcast(stats))


def small_table(df: DataFrame, label: str = "stats") -> DataFrame:
    """Write a reduced frame to the shared checkpoint folder and read it back.

    The planner then knows its true size: below the broadcast threshold a
    join with it never shuffles the other side, above it the join stays a
    shuffle join. Lineage ends at the written files.
    """
    path = scratch_path(df.sparkSession, label)
    df.hint("rebalance").write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def in_or_present(col: str, values) -> Column:
    """IN-list filter where an empty list means every non-null value."""
    values = list(values or [])
    return F.col(col).isin(values) if values else F.col(col).isNotNull()


def month_columns() -> list[str]:
    return [f"M{i:02d}" for i in range(1, 13)]


def top_n(totals: DataFrame, keys: list[str], member: str, n: int, value: str = "TOTAL") -> DataFrame:
    """Keep the N members with the largest ``value`` per series, ties by name.

    ``row_number`` with a rank filter plans as a WindowGroupLimit, so each
    task keeps at most N rows per series before the final window.
    """
    w = win(keys).orderBy(F.col(value).desc(), F.col(member).asc())
    return totals.withColumn("RANK", F.row_number().over(w)).where(F.col("RANK") <= n)

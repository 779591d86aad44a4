"""Keep-last upsert of new extract rows into the stored table, load audit and
the incremental low-water mark."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DEDUP_KEYS, FLOW, HISTORY_START, MONTH, YEAR

ARRIVAL = "_ARRIVAL"


def landed_at() -> Column:
    """File part of the arrival order; valid only directly on a file scan."""
    return F.struct(F.col("_metadata.file_modification_time").alias("TIME"),
                    F.col("_metadata.file_path").alias("FILE"),
                    F.col("_metadata.file_block_start").alias("BLOCK"))


def stamp(df: DataFrame) -> DataFrame:
    """Stamp rows with their arrival order: landing time and place of the file
    where the reader recorded them, then the row's position in its partition.
    Call it on the scan, before any shuffle."""
    parts = [F.monotonically_increasing_id().alias("ROW")]
    if ARRIVAL in df.columns:
        parts = [F.col(f"{ARRIVAL}.{c}").alias(c) for c in ("TIME", "FILE", "BLOCK")] + parts
    return df.withColumn(ARRIVAL, F.struct(*parts))


def keep_last(df: DataFrame, keys=DEDUP_KEYS) -> DataFrame:
    """One row per key: the one that arrived last (null keys form one group).

    ``row_number`` with a rank filter plans as a WindowGroupLimit on both
    sides of the shuffle: each task passes on at most one row of a key, so a
    key with very many versions never meets whole in one task.
    """
    if ARRIVAL not in df.columns:
        df = stamp(df)
    w = Window.partitionBy(*keys).orderBy(F.col(ARRIVAL).desc())
    return df.withColumn("_RN", F.row_number().over(w)).where(F.col("_RN") == 1).drop("_RN", ARRIVAL)


def without_keys(old: DataFrame, fresh: DataFrame, keys=DEDUP_KEYS) -> DataFrame:
    """Rows of ``old`` whose key (null-safe) does not occur in ``fresh``."""
    marks = fresh.select(*[F.col(k).alias(f"_N_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_N_{k}")) for k in keys])
    return old.join(marks, same, "left_anti")


def upsert_keep_last(old: DataFrame, new: DataFrame, keys=DEDUP_KEYS, old_unique: bool = False) -> DataFrame:
    """Stored and new rows, newest version of every key kept.

    Only the new batch is deduplicated; its keys then leave the stored rows
    through an anti join (a broadcast one while the batch is small). Pass
    ``old_unique`` when the stored rows hold one row per key, as every table
    written by this library does. A column only one side has is null on the
    other.
    """
    fresh = keep_last(new, keys)
    if not old_unique:
        old = keep_last(old, keys)
    return without_keys(old, fresh, keys).unionByName(fresh, allowMissingColumns=True)


def load_audit(old: DataFrame, new: DataFrame, after: DataFrame) -> DataFrame:
    """Per flow: rows before, fetched, merged, after, new and removed by dedup."""
    def counts(df, name):
        return df.groupBy(FLOW).agg(F.count(F.lit(1)).alias(name))

    out = (counts(old, "ROWS_BEFORE").join(counts(new, "ROWS_FETCHED"), FLOW, "full")
           .join(counts(after, "ROWS_AFTER"), FLOW, "full").na.fill(0))
    return out.withColumns({
        "ROWS_MERGED": F.col("ROWS_BEFORE") + F.col("ROWS_FETCHED"),
        "ROWS_NEW": F.col("ROWS_AFTER") - F.col("ROWS_BEFORE"),
        "ROWS_REMOVED_BY_DEDUP": F.col("ROWS_BEFORE") + F.col("ROWS_FETCHED") - F.col("ROWS_AFTER"),
    })


def incremental_begin(df: DataFrame, product: str = "fertilizer") -> DataFrame:
    """Per flow: January of the latest stored year as 'YYYY01'."""
    return (df.groupBy(FLOW).agg(F.max(YEAR).alias("_Y"))
            .select(FLOW, F.coalesce(F.concat(F.col("_Y").cast("string"), F.lit("01")),
                                     F.lit(HISTORY_START[product])).alias("PERIOD_BEGIN")))


def since(df: DataFrame, begin: str) -> DataFrame:
    """Rows from the period ``begin`` ('YYYYMM') on; a row without a year stays."""
    ym = F.col(YEAR) * 100 + F.coalesce(F.col(MONTH), F.lit(12))
    return df.where(ym.isNull() | (ym >= int(begin)))

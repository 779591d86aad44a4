"""Results in period order at any size: ordered files instead of one sorted task."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_in_order(df: DataFrame, path: str, order: list[str], n_files: int | None = None) -> None:
    """Write ``df`` so that its files, read in name order, hold the rows in ``order``
    (series columns, then the period): one range of it per file, sorted inside.
    Without ``n_files`` their number follows the size of the result."""
    df.repartitionByRange(*([n_files] if n_files else []), *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def read_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Rows with POSITION, counted from 1 over the files in name order.

    One row per file is ranked; a row's place inside its file comes from the
    file's own metadata, so nothing is sorted again.
    """
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_name").alias("_FILE"), F.col("_metadata.row_index").alias("_AT"))
    before = Window.orderBy("_FILE").rowsBetween(Window.unboundedPreceding, -1)
    files = rows.groupBy("_FILE").agg(F.count(F.lit(1)).alias("_N")).select("_FILE", F.coalesce(F.sum("_N").over(before), F.lit(0)).alias("_BEFORE"))
    return rows.join(F.broadcast(files), "_FILE").withColumn("POSITION", F.col("_BEFORE") + F.col("_AT") + 1).drop("_FILE", "_AT", "_BEFORE")

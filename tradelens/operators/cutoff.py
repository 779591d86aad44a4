"""Latest period, common cutoff month and the comparable-period trim."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import crop_month_num, year_month_key
from ..schema import CM, CY, CY_LABEL, MONTH, REPORTER, YEAR, check_start_month
from ._util import join_on_keys, small_table, win

STAT_COLUMNS = ["LATEST_CY_START", "LATEST_CROP_YEAR", "COMMON_MONTH", "OLDEST_CY_START", "N_CY",
                "PREV_CY_START", "PREV_CROP_YEAR"]


def _reporter_cols(keys: list[str]) -> list[str]:
    return list(keys) + ([REPORTER] if REPORTER not in keys else [])


def period_stats(df: DataFrame, keys: list[str], drop_oldest: bool = True) -> DataFrame:
    """One row per series: latest crop year, latest common month and more.

    COMMON_MONTH: in the latest crop year, the last crop month of each
    reporter present in that year, then the minimum over those reporters.
    PREV_CY_START: second-latest crop year still shown after the oldest year
    is dropped. The work is two partial aggregates; the window runs on one
    row per (series, crop year).
    """
    per_rep = (df.groupBy(*_reporter_cols(keys), CY, CY_LABEL)
               .agg(F.max(CM).alias("_MAXCM")))
    per_year = (per_rep.groupBy(*keys, CY, CY_LABEL).agg(F.min("_MAXCM").alias("_COMMON"))
                .withColumn("_RK", F.row_number().over(win(keys).orderBy(F.col(CY).desc()))))
    first = F.col("_RK") == 1
    second = F.col("_RK") == 2
    stats = per_year.groupBy(*keys).agg(
        F.max(F.when(first, F.col(CY))).alias("LATEST_CY_START"),
        F.max(F.when(first, F.col(CY_LABEL))).alias("LATEST_CROP_YEAR"),
        F.max(F.when(first, F.col("_COMMON"))).alias("COMMON_MONTH"),
        F.min(CY).alias("OLDEST_CY_START"),
        F.count(F.lit(1)).alias("N_CY"),
        F.max(F.when(second, F.col(CY))).alias("_SECOND"),
        F.max(F.when(second, F.col(CY_LABEL))).alias("_SECOND_LABEL"))
    shown = F.col("N_CY") >= (3 if drop_oldest else 2)
    return (stats.withColumn("PREV_CY_START", F.when(shown, F.col("_SECOND")))
            .withColumn("PREV_CROP_YEAR", F.when(shown, F.col("_SECOND_LABEL")))
            .withColumn("COMMON_MONTH", F.coalesce(F.col("COMMON_MONTH"), F.lit(12)))
            .drop("_SECOND", "_SECOND_LABEL"))


def display_trim(df: DataFrame, keys: list[str], drop_oldest: bool = True,
                 stats: DataFrame | None = None, keep: list[str] | tuple = ()) -> DataFrame:
    """Comparable-period trim, then drop the oldest crop year.

    Keeps every earlier crop year whole and the latest one only up to the
    common month; then removes the oldest crop year when more than one
    remains (the latest year always survives the trim, so counts and the
    oldest year are those of the untrimmed rows). ``keep`` names stats
    columns to carry on the rows (saves a second join downstream).
    """
    if stats is None:
        stats = small_table(period_stats(df, keys, drop_oldest))
    s = stats.select(*keys, F.col("LATEST_CY_START").alias("_L"), F.col("COMMON_MONTH").alias("_C"),
                     F.col("OLDEST_CY_START").alias("_O"), F.col("N_CY").alias("_N"), *keep)
    cond = (F.col(CY) < F.col("_L")) | ((F.col(CY) == F.col("_L")) & (F.col(CM) <= F.col("_C")))
    if drop_oldest:
        cond = cond & ((F.col("_N") <= 1) | (F.col(CY) > F.col("_O")))
    return join_on_keys(df, s, keys).where(cond).select(*df.columns, *keep)


def common_cutoff_ym(df: DataFrame, keys: list[str], start_month: int) -> DataFrame:
    """Drilldown cutoff: per reporter the last YEAR*100+MONTH over all years,
    minimum over reporters; its calendar month and crop month."""
    per_rep = (df.groupBy(*_reporter_cols(keys))
               .agg(F.max(year_month_key(F.col(YEAR), F.col(MONTH))).alias("_YM")))
    st = per_rep.groupBy(*keys).agg(F.min("_YM").alias("COMMON_YM"))
    cal = F.pmod(F.col("COMMON_YM"), F.lit(100)).cast("int")
    crop = crop_month_num(cal, check_start_month(start_month))
    return st.withColumns({"COMMON_CAL_MONTH": cal, "COMMON_CROP_MONTH": crop})

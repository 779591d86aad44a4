"""Scenario projection of the remaining months of the latest crop year.

All series (``keys``) are projected in one job from the trimmed monthly
cube. Inputs per series: the cube (one row per crop year and month), the
period stats (latest crop year, common month, previous crop year) and the
last <= 5 complete years. The remaining months are a per-series
``sequence(common + 1, 12)``, so no spine is joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import CM, CY, PROJECTION_YEARS, QTY
from ._util import join_on_keys, win
from .series import last_complete_years


def _j(a: DataFrame, b: DataFrame, cols: list[str], how: str = "inner") -> DataFrame:
    """Join on ``cols``; with no columns ``b`` is a one-row global aggregate."""
    return a.join(b, cols, how) if cols else a.crossJoin(F.broadcast(b))


def _stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    return stats.select(*keys, "LATEST_CY_START", "COMMON_MONTH", "PREV_CY_START")


def remaining_months(stats: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, LATEST_CY_START, COMMON_MONTH, CM) for every month after the common month."""
    s = _stats(stats, keys).where(F.col("COMMON_MONTH") < 12)
    return s.select(*keys, "LATEST_CY_START", "COMMON_MONTH", "PREV_CY_START",
                    F.explode(F.sequence(F.col("COMMON_MONTH") + 1, F.lit(12))).alias(CM))


def ytd_sums(cube: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Per series: YTD of the latest and previous crop year up to the common month,
    and the sum of the latest year's positive months (cumulative start)."""
    j = join_on_keys(cube, _stats(stats, keys), keys)
    elapsed = F.col(CM) <= F.col("COMMON_MONTH")
    latest = (F.col(CY) == F.col("LATEST_CY_START")) & elapsed
    prev = (F.col(CY) == F.col("PREV_CY_START")) & elapsed
    return j.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(latest, F.col(QTY))), F.lit(0.0)).alias("CY_YTD"),
        F.coalesce(F.sum(F.when(prev, F.col(QTY))), F.lit(0.0)).alias("PREV_YTD"),
        F.coalesce(F.sum(F.when(latest & (F.col(QTY) > 0), F.col(QTY))), F.lit(0.0)).alias("CUM_START"),
        F.max(F.when((F.col(CY) == F.col("LATEST_CY_START")) & (F.col(CM) == F.col("COMMON_MONTH"))
                     & (F.col(QTY) > 0), F.col(QTY))).alias("ANCHOR_QTY"))


def avg_proportions(cube: DataFrame, keys: list[str], n: int = PROJECTION_YEARS) -> DataFrame:
    """Per crop month: mean over the last <= n complete years of month / year total."""
    ref = last_complete_years(cube, keys, n)
    j = cube.join(ref, [*keys, CY])
    return (j.groupBy(*keys, CM)
            .agg(F.avg(F.col(QTY) / F.col("ANNUAL_QTY")).alias("AVG_SHARE"),
                 F.count(F.lit(1)).alias("N_YEARS"),
                 F.avg(QTY).alias("AVG_QTY")))


def _prop_totals(cube: DataFrame, stats: DataFrame, keys: list[str], n: int) -> DataFrame:
    """Per series: elapsed and remaining share sums and the mean annual total."""
    props = avg_proportions(cube, keys, n)
    s = _stats(stats, keys)
    elapsed = F.col(CM) <= F.col("COMMON_MONTH")
    ann = last_complete_years(cube, keys, n).groupBy(*keys).agg(F.avg("ANNUAL_QTY").alias("MEAN_ANNUAL"))
    tot = (join_on_keys(props, s, keys).groupBy(*keys)
           .agg(F.sum(F.when(elapsed, F.col("AVG_SHARE"))).alias("ACT_SHARE"),
                F.sum(F.when(~elapsed, F.col("AVG_SHARE"))).alias("REM_SHARE")))
    return _j(tot, ann, keys, "left")


def projection_base(cube: DataFrame, stats: DataFrame, keys: list[str], n: int = PROJECTION_YEARS) -> DataFrame:
    """One row per (series, remaining month) with every input of the methods.

    PREV_QTY (previous crop year's month), AVG_QTY / AVG_SHARE (mean value
    and mean share of the month over the last <= n complete years), and per
    series CY_YTD, PREV_YTD, CUM_START, ANCHOR_QTY, ACT_SHARE, REM_SHARE,
    MEAN_ANNUAL. Built from small per-series frames with key joins only.
    """
    rem = remaining_months(stats, keys)
    prev_m = (join_on_keys(cube, _stats(stats, keys).select(*keys, "PREV_CY_START"), keys)
              .where(F.col(CY) == F.col("PREV_CY_START")).select(*keys, CM, F.col(QTY).alias("PREV_QTY")))
    props = avg_proportions(cube, keys, n).select(*keys, CM, "AVG_QTY", "AVG_SHARE")
    tot = _prop_totals(cube, stats, keys, n)
    sums = ytd_sums(cube, stats, keys)
    out = rem.join(prev_m, [*keys, CM], "left").join(props, [*keys, CM], "left")
    return _j(_j(out, sums, keys), tot, keys, "left")


def _base(cube, stats, keys, n, base):
    return base if base is not None else projection_base(cube, stats, keys, n)


def projection_ytd(cube: DataFrame, stats: DataFrame, keys: list[str], yoy: float | None = None,
                   n: int = PROJECTION_YEARS, base: DataFrame | None = None) -> DataFrame:
    """YTD method: previous year's month x (1 + YoY); a month without a
    positive previous value uses the mean of the last <= n complete years."""
    b = _base(cube, stats, keys, n, base)
    default = F.when(F.col("PREV_CY_START").isNotNull() & (F.col("PREV_YTD") > 0),
                     F.bround((F.col("CY_YTD") / F.col("PREV_YTD") - 1) * 100, 1)).otherwise(F.lit(0.0))
    yoy_col = default if yoy is None else F.lit(float(yoy))
    prev = F.coalesce(F.col("PREV_QTY"), F.lit(0.0))
    base_qty = F.when((prev <= 0) & F.col("AVG_QTY").isNotNull(), F.col("AVG_QTY")).otherwise(prev)
    out = b.withColumns({"YOY_PCT": yoy_col, "BASE_QTY": base_qty})
    return (out.where(F.col("BASE_QTY") > 0)
            .select(*keys, F.col("LATEST_CY_START").alias(CY), CM, "YOY_PCT", "BASE_QTY",
                    (F.col("BASE_QTY") * (1 + F.col("YOY_PCT") / 100)).alias("PROJ_QTY")))


def projection_proportions(cube: DataFrame, stats: DataFrame, keys: list[str],
                           n: int = PROJECTION_YEARS, base: DataFrame | None = None) -> DataFrame:
    """Proportions: implied full year = YTD / elapsed average share (or the
    mean annual total when that share is 0); month = implied x share."""
    b = _base(cube, stats, keys, n, base).where(F.col("AVG_SHARE").isNotNull())
    implied = F.when(F.coalesce(F.col("ACT_SHARE"), F.lit(0.0)) > 0, F.col("CY_YTD") / F.col("ACT_SHARE")) \
        .otherwise(F.col("MEAN_ANNUAL"))
    out = b.withColumn("IMPLIED_TOTAL", implied)
    return out.select(*keys, F.col("LATEST_CY_START").alias(CY), CM, "IMPLIED_TOTAL",
                      (F.col("IMPLIED_TOTAL") * F.col("AVG_SHARE")).alias("PROJ_QTY"))


def projection_manual_month(stats: DataFrame, keys: list[str], value: float) -> DataFrame:
    """The same given value in every remaining month."""
    rem = remaining_months(stats, keys)
    return rem.select(*keys, F.col("LATEST_CY_START").alias(CY), CM,
                      F.lit(float(value)).alias("PROJ_QTY"))


def projection_manual_year(cube: DataFrame, stats: DataFrame, keys: list[str], target: float | None = None,
                           n: int = PROJECTION_YEARS, base: DataFrame | None = None) -> DataFrame:
    """Yearly target: the budget left after YTD is split over the remaining
    months by their average shares (renormalised). Default target =
    round(YTD / elapsed share); no rows when nothing is left."""
    b = _base(cube, stats, keys, n, base).where(F.col("AVG_SHARE").isNotNull())
    default = F.when(F.col("ACT_SHARE") > 0, F.bround(F.col("CY_YTD") / F.col("ACT_SHARE"), 0)) \
        .otherwise(F.lit(0.0))
    tgt = default if target is None else F.lit(float(target))
    out = b.withColumn("TARGET", tgt)
    out = out.withColumn("REMAINING_BUDGET", F.greatest(F.lit(0.0), F.col("TARGET") - F.col("CY_YTD")))
    out = out.where((F.col("REMAINING_BUDGET") > 0) & (F.col("REM_SHARE") > 0))
    return out.select(*keys, F.col("LATEST_CY_START").alias(CY), CM, "TARGET", "REMAINING_BUDGET",
                      (F.col("REMAINING_BUDGET") * F.col("AVG_SHARE") / F.col("REM_SHARE")).alias("PROJ_QTY"))


def projection_totals(cube: DataFrame, stats: DataFrame, keys: list[str], target: float | None = None,
                      n: int = PROJECTION_YEARS) -> DataFrame:
    """One row per series with the totals the methods report, also when no month
    remains or nothing is left of the target.

    IMPLIED_TOTAL (proportions): YTD / elapsed average share, or the mean
    annual total where that share is 0; null without a complete year. TARGET
    and REMAINING_BUDGET (yearly target): the given target, or YTD / elapsed
    share rounded (0 without one), and what is left of it after YTD, at least 0.
    """
    s = _stats(stats, keys)
    out = _j(_j(s, ytd_sums(cube, stats, keys).select(*keys, "CY_YTD"), keys, "left"), _prop_totals(cube, stats, keys, n), keys, "left")
    share = F.coalesce(F.col("ACT_SHARE"), F.lit(0.0))
    default = F.when(share > 0, F.bround(F.col("CY_YTD") / share, 0)).otherwise(F.lit(0.0))
    out = out.withColumns({
        "IMPLIED_TOTAL": F.when(share > 0, F.col("CY_YTD") / share).otherwise(F.col("MEAN_ANNUAL")),
        "TARGET": default if target is None else F.lit(float(target)),
        "N_REMAINING": (12 - F.col("COMMON_MONTH")).cast("int")})
    return out.select(*keys, F.col("LATEST_CY_START").alias(CY), "COMMON_MONTH", "N_REMAINING", "CY_YTD", "IMPLIED_TOTAL", "TARGET",
                      F.greatest(F.lit(0.0), F.col("TARGET") - F.col("CY_YTD")).alias("REMAINING_BUDGET"))


def _anchors(cube, stats, keys, base):
    b = _base(cube, stats, keys, PROJECTION_YEARS, base)
    return b.select(*keys, "LATEST_CY_START", "COMMON_MONTH", "ANCHOR_QTY", "CUM_START").distinct()


def _with_projection(frame: DataFrame, proj: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of series that have at least one projected month."""
    if keys:
        return frame.join(proj.select(*keys).distinct(), keys, "left_semi")
    return _j(frame, proj.select(F.count(F.lit(1)).alias("_N")), []).where("_N > 0").drop("_N")


def projection_series(cube: DataFrame, stats: DataFrame, proj: DataFrame, keys: list[str],
                      base: DataFrame | None = None) -> DataFrame:
    """Projected months preceded by the last actual point (when positive).

    Series without any projected month get no rows."""
    anchor = _with_projection(_anchors(cube, stats, keys, base).where(F.col("ANCHOR_QTY").isNotNull()), proj, keys)
    anchor = anchor.select(*keys, F.col("LATEST_CY_START").alias(CY), F.col("COMMON_MONTH").alias(CM),
                           F.col("ANCHOR_QTY").alias(QTY), F.lit(False).alias("IS_PROJECTED"))
    return anchor.unionByName(proj.select(*keys, CY, CM, F.col("PROJ_QTY").alias(QTY),
                                          F.lit(True).alias("IS_PROJECTED")))


def projection_cumulative(cube: DataFrame, stats: DataFrame, proj: DataFrame, keys: list[str],
                          base: DataFrame | None = None) -> DataFrame:
    """Cumulative line: the sum of the positive actual months up to the common
    month, then each projected month added in order."""
    start = _with_projection(_anchors(cube, stats, keys, base), proj, keys)
    start_rows = start.select(*keys, F.col("LATEST_CY_START").alias(CY), F.col("COMMON_MONTH").alias(CM),
                              F.col("CUM_START").alias("STEP"), F.lit(False).alias("IS_PROJECTED"))
    steps = proj.select(*keys, CY, CM, F.col("PROJ_QTY").alias("STEP"), F.lit(True).alias("IS_PROJECTED"))
    w = win(keys).orderBy(CM).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (start_rows.unionByName(steps).withColumn("CUM_QTY", F.sum("STEP").over(w)).drop("STEP"))

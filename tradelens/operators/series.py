"""Seasonal series, matrices, complete years, bands, YTD/YoY, cumulative, rolling.

Every function takes ``keys`` (series columns): all series run in one job.
Inputs are reduced to one row per (series, period) by a distributed
aggregate first; windows then see at most one series' periods.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import growth_vs, pct_change
from ..schema import CM, CY, CY_LABEL, DATE, QTY, REFERENCE_YEARS, REGION
from ._util import join_on_keys, month_columns, win
from .filters import seasonal_range, seasonal_range_of


def _sum_qty() -> F.Column:
    return F.coalesce(F.sum(QTY), F.lit(0.0)).alias(QTY)


def monthly_cube(df: DataFrame, keys: list[str], extra: list[str] | tuple = ()) -> DataFrame:
    """Seasonal monthly sum per (series, crop year, crop month)."""
    return df.groupBy(*keys, *extra, CY, CY_LABEL, CM).agg(_sum_qty())


def monthly_matrix(cube: DataFrame, keys: list[str]) -> DataFrame:
    """Crop year x 12 crop-month columns (M01..M12), absent month = 0."""
    cols = [F.expr(f"coalesce(sum(CASE WHEN {CM} = {i} THEN {QTY} END), 0D) AS {c}")
            for i, c in enumerate(month_columns(), start=1)]
    return cube.groupBy(*keys, CY, CY_LABEL).agg(*cols)


def complete_years(cube: DataFrame, keys: list[str]) -> DataFrame:
    """Per crop year: months with value > 0, annual total, complete flag (12 of 12)."""
    return (cube.groupBy(*keys, CY, CY_LABEL)
            .agg(F.count(F.when(F.col(QTY) > 0, 1)).cast("int").alias("N_POSITIVE_MONTHS"),
                 F.sum(QTY).alias("ANNUAL_QTY"))
            .withColumn("IS_COMPLETE", F.col("N_POSITIVE_MONTHS") == 12))


def last_complete_years(cube: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The last ``n`` complete crop years of each series, ranked from the newest."""
    comp = complete_years(cube, keys).where("IS_COMPLETE")
    return (comp.withColumn("YEAR_RANK", F.row_number().over(win(keys).orderBy(F.col(CY).desc())))
            .where(F.col("YEAR_RANK") <= n).select(*keys, CY, "YEAR_RANK", "ANNUAL_QTY"))


def reference_band(cube: DataFrame, keys: list[str], n: int = REFERENCE_YEARS) -> DataFrame:
    """Per crop month max, min, mean over the last <= n complete years."""
    ref = last_complete_years(cube, keys, n).select(*keys, CY)
    return (cube.join(ref, [*keys, CY], "left_semi")
            .groupBy(*keys, CM)
            .agg(F.max(QTY).alias("BAND_MAX"), F.min(QTY).alias("BAND_MIN"),
                 F.avg(QTY).alias("BAND_AVG"), F.count(F.lit(1)).alias("BAND_N")))


def _latest_values(cube: DataFrame, stats: DataFrame, keys: list[str]) -> DataFrame:
    """Latest-year month values up to the common month, 0 or less -> null."""
    s = stats.select(*keys, "LATEST_CY_START", "COMMON_MONTH")
    latest = join_on_keys(cube, s, keys).where(
        (F.col(CY) == F.col("LATEST_CY_START")) & (F.col(CM) <= F.col("COMMON_MONTH")))
    return latest.select(*keys, CM, F.when(F.col(QTY) > 0, F.col(QTY)).alias("LATEST_QTY"))


def latest_vs_band(cube: DataFrame, stats: DataFrame, keys: list[str], n: int = REFERENCE_YEARS) -> DataFrame:
    """Reference band with the latest year's months 1..common month."""
    return reference_band(cube, keys, n).join(_latest_values(cube, stats, keys), [*keys, CM], "left")


def latest_vs_avg(cube: DataFrame, stats: DataFrame, keys: list[str], n: int = REFERENCE_YEARS) -> DataFrame:
    """Latest year vs the band average, in %, per crop month."""
    band = reference_band(cube, keys, n).select(*keys, CM, "BAND_AVG", "BAND_N")
    out = band.join(_latest_values(cube, stats, keys), [*keys, CM], "left")
    return out.withColumn("VS_AVG_PCT", growth_vs(F.col("LATEST_QTY"), F.col("BAND_AVG")))


def ytd_yoy(disp: DataFrame, stats: DataFrame, keys: list[str],
            cy_from: int | None = None, cy_to: int | None = None) -> DataFrame:
    """YTD sum per crop year up to the common month, and YoY % against the
    previous shown crop year (gaps not filled; zero base -> null)."""
    if "COMMON_MONTH" not in disp.columns:
        disp = join_on_keys(disp, stats.select(*keys, "COMMON_MONTH"), keys)
    ytd = (disp.where(F.col(CM) <= F.col("COMMON_MONTH"))
           .groupBy(*keys, CY, CY_LABEL).agg(F.coalesce(F.sum(QTY), F.lit(0.0)).alias("YTD_QTY")))
    ytd = seasonal_range(ytd, cy_from, cy_to)
    prev = F.lag("YTD_QTY").over(win(keys).orderBy(CY))
    return ytd.withColumn("YOY_PCT", pct_change(F.col("YTD_QTY"), prev))


def cumulative(cube: DataFrame, keys: list[str]) -> DataFrame:
    """Running sum within each crop year in crop-month order (absent months skipped)."""
    w = win([*keys, CY]).orderBy(CM).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return cube.withColumn("CUM_QTY", F.sum(QTY).over(w))


def monthly_total(disp: DataFrame, keys: list[str], extra: list[str] | tuple = ()) -> DataFrame:
    """Total per (series, DATE)."""
    return disp.groupBy(*keys, *extra, DATE).agg(_sum_qty())


def rolling(monthly: DataFrame, keys: list[str], window: int) -> DataFrame:
    """Sum over the last ``window`` rows in DATE order; null until full."""
    if window < 1:
        raise ValueError("window must be >= 1")
    w = win(keys).orderBy(DATE).rowsBetween(-(window - 1), 0)
    return monthly.withColumn("ROLLING", F.when(F.count(QTY).over(w) == window, F.sum(QTY).over(w)))


def rolling_by_region(drill_base: DataFrame, keys: list[str], window: int) -> DataFrame:
    """Rolling sum per partner region (input without the YTD filter)."""
    return rolling(monthly_total(drill_base, keys, [REGION]), [*keys, REGION], window)


def heatmap(cube: DataFrame, stats: DataFrame, keys: list[str], cy_from: int | None = None,
            cy_to: int | None = None, n: int = REFERENCE_YEARS) -> DataFrame:
    """Crop year x month table: zero -> null, Total only for complete years,
    Min/Max/Avg rows over the last <= n complete years (annual totals in
    TOTAL), and a vs-average % row after the latest year when it is shown.

    One matrix aggregate, one window (complete years ranked newest first) and
    one aggregate over two grouping sets: a crop year gives its own row, a
    series its Min, Max, Avg and vs-average rows.
    """
    months = month_columns()
    k = [f"`{c}`" for c in keys]
    total = " + ".join(months)
    complete = " AND ".join(f"{m} > 0" for m in months)
    part = f"PARTITION BY {', '.join(k)} " if keys else ""
    s = seasonal_range(stats.select(*keys, F.col("LATEST_CY_START").alias("_L")).withColumn(CY, F.col("_L")), cy_from, cy_to).drop(CY)
    mat = monthly_matrix(cube, keys).selectExpr(
        "*", f"({complete}) AS _COMPLETE", f"{total} AS _TOT",
        f"({complete}) AND row_number() OVER ({part}ORDER BY ({complete}) DESC, {CY} DESC) <= {n} AS _REF")
    mat = mat.join(s, keys, "left") if keys else mat.join(F.broadcast(s), F.lit(True), "left")
    values = [*months, "_TOT"]
    aggs = [F.expr(f"max({c}) AS own_{c}") for c in values]                               # a year has one matrix row
    aggs += [F.expr(f"{fn}({c}) FILTER (WHERE _REF) AS {fn}_{c}") for fn in ("min", "max", "avg") for c in values]
    aggs += [F.expr(f"max({m}) FILTER (WHERE {CY} = _L) AS now_{m}") for m in months]
    aggs += [F.expr("count_if(_REF) AS _N"), F.expr("bool_or(_COMPLETE) AS _DONE"), F.expr("max(_L) AS _LATEST"), F.grouping(CY).alias("_G")]
    sets = [[*keys, CY, CY_LABEL], [*keys]]
    rows = mat.groupingSets([[F.col(c) for c in g] for g in sets], *[F.col(c) for c in sets[0]]).agg(*aggs)
    rows = rows.where((F.col("_G") == 1) | seasonal_range_of(cy_from, cy_to))

    def row(kind: str, label: str, year: str, cells: list[str], tot: str, order: str) -> str:
        fields = [f"'{kind}' AS ROW_TYPE", f"{label} AS ROW_LABEL", f"CAST({year} AS INT) AS {CY}",
                  *[f"CAST({e} AS DOUBLE) AS {m}" for e, m in zip(cells, months)], f"CAST({tot} AS DOUBLE) AS TOTAL", f"CAST({order} AS BIGINT) AS ROW_ORDER"]
        return f"struct({', '.join(fields)})"

    year_row = row("year", CY_LABEL, CY, [f"nullif(own_{m}, 0D)" for m in months], "CASE WHEN _DONE THEN own__TOT END", f"{CY} * 10")
    ref_rows = [row(name, f"format_string('{name.title()} (L%dY)', _N)", "NULL", [f"{name}_{m}" for m in months], f"{name}__TOT", str(10 ** 9 + i))
                for i, name in enumerate(["min", "max", "avg"], start=1)]
    vs_row = row("vs_avg", "format_string('vs Avg (L%dY)%%', _N)", "NULL",
                 [f"CASE WHEN avg_{m} > 0 AND now_{m} > 0 THEN (now_{m} / avg_{m} - 1) * 100 END" for m in months], "NULL", "_LATEST * 10 + 5")
    lines = (f"CASE WHEN _G = 0 THEN array({year_row}) WHEN _N = 0 THEN array() "
             f"WHEN _LATEST IS NULL THEN array({', '.join(ref_rows)}) ELSE array({', '.join([*ref_rows, vs_row])}) END")
    return rows.selectExpr(*k, f"inline({lines})")

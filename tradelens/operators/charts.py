"""Chart tables: actual, reference-band and projected months of every series in
one long table, marked by SERIES and IS_PROJECTED."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CM, CY, CY_LABEL, QTY, REFERENCE_YEARS
from ._util import join_on_keys
from .filters import seasonal_range
from .projection import projection_series
from .series import reference_band

BAND = ["BAND_MAX", "BAND_MIN", "BAND_AVG"]


def _band_rows(band: DataFrame, keys: list[str]) -> DataFrame:
    """Three rows per band month, SERIES = band_max / band_min / band_avg."""
    lines = F.array(*[F.struct(F.lit(c.lower()).alias("SERIES"), F.col(c).alias(QTY)) for c in BAND])
    return band.select(*keys, CM, F.inline(lines)).select(
        *keys, "SERIES", F.lit(None).cast("int").alias(CY), CM, QTY, F.lit(False).alias("IS_PROJECTED"))


def _projected_rows(cube, stats, proj, keys, base) -> DataFrame:
    """The projected line: last actual point, then the projected months."""
    line = projection_series(cube, stats, proj, keys, base=base)
    return line.select(*keys, F.lit("projection").alias("SERIES"), CY, CM, QTY, "IS_PROJECTED")


def seasonal_chart(cube: DataFrame, stats: DataFrame, proj: DataFrame, keys: list[str], cy_from: int | None = None,
                   cy_to: int | None = None, n: int = REFERENCE_YEARS, base: DataFrame | None = None) -> DataFrame:
    """Monthly lines of the shown crop years (SERIES = year; absent months stay
    absent), the reference band, and the projection of the latest crop year
    when that year is shown. The band does not follow the shown range."""
    years = seasonal_range(cube, cy_from, cy_to).select(
        *keys, F.lit("year").alias("SERIES"), CY, CM, QTY, F.lit(False).alias("IS_PROJECTED"))
    ahead = seasonal_range(_projected_rows(cube, stats, proj, keys, base), cy_from, cy_to)
    return years.unionByName(_band_rows(reference_band(cube, keys, n), keys)).unionByName(ahead)


def latest_chart(cube: DataFrame, stats: DataFrame, proj: DataFrame, keys: list[str], n: int = REFERENCE_YEARS,
                 base: DataFrame | None = None) -> DataFrame:
    """Reference band, the latest crop year's months up to the common month
    (0, less or absent: null) and its projection. Series without a complete
    year have no band and no rows."""
    band = reference_band(cube, keys, n)
    s = stats.select(*keys, F.col("LATEST_CY_START").alias(CY), "COMMON_MONTH")
    months = s.withColumn(CM, F.explode(F.sequence(F.lit(1), "COMMON_MONTH"))).drop("COMMON_MONTH")
    latest = months.join(cube.select(*keys, CY, CM, QTY), [*keys, CY, CM], "left").select(
        *keys, F.lit("latest").alias("SERIES"), CY, CM, F.when(F.col(QTY) > 0, F.col(QTY)).alias(QTY), F.lit(False).alias("IS_PROJECTED"))
    lines = latest.unionByName(_projected_rows(cube, stats, proj, keys, base))
    with_band = band.groupBy(*keys).agg(F.count(F.lit(1)).alias("_N")).where("_N > 0")
    return join_on_keys(lines, with_band, keys).drop("_N").unionByName(_band_rows(band, keys))

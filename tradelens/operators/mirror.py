"""Mirror comparison: an exporter's report against the importer's report of
the same flow, the mirror shifted back by a lag.

Pairs are keys, so every (exporter, destination, importer, origin) pair is
compared in one job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import Dims
from ..functions.calendar import shift_months, with_calendar
from ..schema import CM, COMMODITY_TAG, CY, CY_LABEL, DATE, FLOW, MIRROR_LAG_RANGE, PARTNER, QTY, REPORTER
from ._util import in_or_present, win

PAIR = ["EXPORTER", "DESTINATION", "IMPORTER", "ORIGIN"]
UNMATCHED = "Other"


def _canonical(df: DataFrame, col: str, out: str, dims: Dims) -> DataFrame:
    alias = dims.alias.select(F.col("NAME").alias("_AK"), F.col("STD_NAME").alias("_AV"))
    return (df.join(F.broadcast(alias), F.trim(F.col(col)) == F.col("_AK"), "left")
            .withColumn(out, F.coalesce(F.col("_AV"), F.trim(F.col(col)))).drop("_AK", "_AV"))


def mirror_cube(df: DataFrame, tags=()) -> DataFrame:
    """Monthly quantity per (flow, reporter, partner, year, month).

    Every mirror result is derived from this aggregate: shifting months
    commutes with the sum, so the lag is applied to the reduced rows.
    """
    return (df.where(in_or_present(COMMODITY_TAG, tags))
            .groupBy(FLOW, REPORTER, PARTNER, "YEAR", "MONTH")
            .agg(F.coalesce(F.sum(QTY), F.lit(0.0)).alias(QTY)))


def mirror_pairs(df: DataFrame, dims: Dims) -> DataFrame:
    """Exporter -> destination pairs whose destination reports imports from the
    exporter, matched on canonical (alias-resolved) names on both sides.

    "Other" collects unrelated areas, so it never matches."""
    exp = df.where(F.col(FLOW) == "E").select(F.col(REPORTER).alias("EXPORTER"),
                                              F.col(PARTNER).alias("DESTINATION")).distinct()
    imp = df.where(F.col(FLOW) == "I").select(F.col(REPORTER).alias("IMPORTER"),
                                              F.col(PARTNER).alias("ORIGIN")).distinct()
    exp = _canonical(_canonical(exp, "EXPORTER", "_E", dims), "DESTINATION", "_D", dims)
    imp = _canonical(_canonical(imp, "IMPORTER", "_I", dims), "ORIGIN", "_O", dims)
    exp = exp.where((F.col("_E") != UNMATCHED) & (F.col("_D") != UNMATCHED))
    return (exp.join(imp, (F.col("_D") == F.col("_I")) & (F.col("_E") == F.col("_O")))
            .select(*PAIR))


def _series(df: DataFrame, pairs: DataFrame, flow: str, rep: str, par: str, start_month: int,
            lag: int, tags) -> DataFrame:
    rows = df.where(F.col(FLOW) == flow)
    if COMMODITY_TAG in df.columns:
        rows = rows.where(in_or_present(COMMODITY_TAG, tags))
    rows = shift_months(rows, lag, start_month) if lag else with_calendar(rows, start_month)
    agg = (rows.groupBy(F.col(REPORTER).alias(rep), F.col(PARTNER).alias(par), CY, CY_LABEL, CM)
           .agg(F.coalesce(F.sum(QTY), F.lit(0.0)).alias(QTY)))
    return agg.join(pairs, [rep, par])


def mirror_years(df: DataFrame, pairs: DataFrame, start_month: int, tags=()) -> DataFrame:
    """Union of the crop years of the direct and the unshifted mirror series."""
    d = _series(df, pairs, "E", "EXPORTER", "DESTINATION", start_month, 0, tags)
    m = _series(df, pairs, "I", "IMPORTER", "ORIGIN", start_month, 0, tags)
    return d.select(*PAIR, CY, CY_LABEL).union(m.select(*PAIR, CY, CY_LABEL)).distinct()


def mirror_overlay(df: DataFrame, pairs: DataFrame, start_month: int, lag: int = 1, tags=(),
                   years_back: int | None = None) -> DataFrame:
    """Direct and lag-shifted mirror monthly series on one crop-year axis.

    Years shown: the union of the unshifted series' years, all or the last
    ``years_back`` of them; shifted rows falling in other years are dropped.
    Every row carries both its own and its shifted crop year, so series and
    years come from one aggregate.
    """
    lo, hi = MIRROR_LAG_RANGE
    if not isinstance(lag, int) or isinstance(lag, bool) or not lo <= lag <= hi:
        raise ValueError(f"lag must be a whole number of months from {lo} to {hi}, got {lag!r}")
    if years_back is not None and years_back < 1:
        raise ValueError("years_back must be >= 1 or None")
    rows = df.where(in_or_present(COMMODITY_TAG, tags)) if COMMODITY_TAG in df.columns else df
    # both reports of a pair by (flow, reporter, partner): one join, one pass over the rows
    sides = pairs.select(*PAIR, F.inline(F.array(
        F.struct(F.lit("E").alias("_FLOW"), F.col("EXPORTER").alias("_REP"), F.col("DESTINATION").alias("_PAR")),
        F.struct(F.lit("I").alias("_FLOW"), F.col("IMPORTER").alias("_REP"), F.col("ORIGIN").alias("_PAR")))))
    rows = rows.join(sides, (F.col(FLOW) == F.col("_FLOW")) & (F.col(REPORTER) == F.col("_REP")) & (F.col(PARTNER) == F.col("_PAR")))
    plain = with_calendar(rows.select(*PAIR, FLOW, "YEAR", "MONTH", QTY), start_month).withColumn("_OWN", F.col(CY))
    moved = F.add_months(DATE, F.when(F.col(FLOW) == "I", -lag).otherwise(0))
    shifted = with_calendar(plain.withColumns({"YEAR": F.year(moved), "MONTH": F.month(moved)}), start_month)
    series = F.when(F.col(FLOW) == "E", "direct").otherwise("mirror").alias("SERIES")
    # dealt by pair once: the aggregate and the window over a pair's months need no other shuffle
    cells = shifted.select(*PAIR, series, CY, CY_LABEL, CM, "_OWN", QTY).repartition(*PAIR).groupBy(
        *PAIR, "SERIES", CY, CY_LABEL, CM, "_OWN").agg(F.coalesce(F.sum(QTY), F.lit(0.0)).alias(QTY))
    years = F.sort_array(F.collect_set("_OWN").over(win(PAIR)), False)
    if years_back is not None:
        years = F.slice(years, 1, years_back)
    return cells.withColumn("_YEARS", years).where(F.array_contains("_YEARS", F.col(CY))).select(*PAIR, "SERIES", CY, CY_LABEL, CM, QTY)

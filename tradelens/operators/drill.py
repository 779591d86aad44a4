"""Drilldown: region / partner volumes, shares, top-N with remainder.

Input is the untrimmed, reporter-filtered rows. ``drill_rows`` applies the
drilldown mask; the views below aggregate first (partial + final hash
aggregate), so every window sees one row per (series, member, period).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import share_pct
from ..schema import CM, CY, CY_LABEL, PARTNER, QTY, REGION, REPORTER
from ._util import in_or_present, join_on_keys, small_table, top_n, win
from .cutoff import common_cutoff_ym

REST = "Rest of World"
TOTAL = "Total"


def _sum_qty() -> F.Column:
    return F.coalesce(F.sum(QTY), F.lit(0.0)).alias(QTY)


def drill_stats(rep: DataFrame, keys: list[str], start_month: int, years_back: int | None = None) -> DataFrame:
    """Per series: common cutoff (E3) and the first crop year of the active range
    (all crop years, or the last ``years_back`` present)."""
    if years_back is not None and years_back < 1:
        raise ValueError("years_back must be >= 1 or None")
    cut = common_cutoff_ym(rep, keys, start_month)
    years = rep.select(*keys, CY).distinct()
    if years_back is None:
        first = years.groupBy(*keys).agg(F.min(CY).alias("FIRST_ACTIVE_CY"))
    else:
        ranked = years.withColumn("_YR", F.row_number().over(win(keys).orderBy(F.col(CY).desc())))
        first = ranked.where(F.col("_YR") <= years_back).groupBy(*keys).agg(F.min(CY).alias("FIRST_ACTIVE_CY"))
    return cut.join(first, keys) if keys else cut.crossJoin(first)


def drill_rows(df: DataFrame, keys: list[str], start_month: int, reporters=(), partners=(), crop_years=(),
               crop_months=(), tags=(), years_back: int | None = None, ytd: bool = False,
               stats_source: DataFrame | None = None):
    """(rows on the chosen basis, full-year rows, per-series drill stats).

    Every crop year and month is kept unless ``years_back`` or ``ytd`` (only
    months up to the common crop month) asks for less.

    ``stats_source``: any reduction of ``df`` that keeps the keys, REPORTER,
    CROP_YEAR_START, YEAR and MONTH (e.g. the written reporter cube); the
    cutoff and active years are then computed from it instead of another
    scan of the rows.
    """
    from .filters import drill_filter

    rep = df.where(in_or_present(REPORTER, reporters))
    src = rep if stats_source is None else stats_source.where(in_or_present(REPORTER, reporters))
    stats = drill_stats(src, keys, start_month, years_back)
    if keys:
        stats = small_table(stats)
    s = stats.select(*keys, F.col("COMMON_CROP_MONTH").alias("_CCM"), F.col("FIRST_ACTIVE_CY").alias("_FA"))
    base = drill_filter(join_on_keys(rep, s, keys), partners, crop_years, crop_months, tags)
    base = base.where(F.col(CY) >= F.col("_FA"))
    masked = base.where(F.col(CM) <= F.col("_CCM")) if ytd else base
    return masked.select(*df.columns), base.select(*df.columns), stats


def drill_cube(dff: DataFrame, keys: list[str]) -> DataFrame:
    """Drill rows reduced to (series, region, partner, crop year, crop month).

    Every view below only needs these columns, so they can run on this
    small aggregate instead of the rows (same results: the views sum QTY).
    """
    return dff.groupBy(*keys, REGION, PARTNER, CY, CY_LABEL, CM).agg(_sum_qty())


def on_basis(cube: DataFrame, stats: DataFrame, keys: list[str], ytd: bool = False) -> DataFrame:
    """Cube rows of the active range of ``stats``, with ``ytd`` only up to the
    common crop month (a filter on the written cube, not on the rows)."""
    s = stats.select(*keys, F.col("COMMON_CROP_MONTH").alias("_CCM"), F.col("FIRST_ACTIVE_CY").alias("_FA"))
    out = join_on_keys(cube, s, keys).where(F.col(CY) >= F.col("_FA"))
    if ytd:
        out = out.where(F.col(CM) <= F.col("_CCM"))
    return out.select(*cube.columns)


def _filled(agg: DataFrame, members: DataFrame, k: list[str], member: str, cells: DataFrame,
            period: list[str]) -> DataFrame:
    """Every cell of the (member x period) matrix, an absent one as 0.

    ``cells`` holds the wanted (series, member, period) rows; both sides are
    reduced rows, bounded by members x periods.
    """
    on = [*k, member, *period]
    out = cells.join(agg.select(*on, QTY), on, "left").withColumn(QTY, F.coalesce(QTY, F.lit(0.0)))
    return out.join(members, [*k, member])


def _cells(members: DataFrame, k: list[str], periods: DataFrame, on: list[str], member: str = PARTNER) -> DataFrame:
    """Members x periods, paired within the series columns ``on``."""
    m = members.select(*k, member)
    return m.join(periods, on) if on else m.crossJoin(F.broadcast(periods))


def year_region(dff: DataFrame, keys: list[str]) -> DataFrame:
    """Crop year x region volume (absent cells 0), share of the year (%), region
    total and rank."""
    agg = dff.groupBy(*keys, CY, CY_LABEL, REGION).agg(_sum_qty())
    regions = agg.select(*keys, REGION).distinct()
    cells = _cells(regions, keys, agg.select(*keys, CY, CY_LABEL).distinct(), keys, REGION)
    agg = _filled(agg, regions, keys, REGION, cells, [CY, CY_LABEL])
    out = agg.withColumns({"SHARE_PCT": share_pct(F.col(QTY), F.sum(QTY).over(win([*keys, CY]))),
                           "REGION_TOTAL": F.sum(QTY).over(win([*keys, REGION]))})
    order = win(keys).orderBy(F.col("REGION_TOTAL").desc(), F.col(REGION).asc())
    return out.withColumn("REGION_RANK", F.dense_rank().over(order))


def selected_year(dff: DataFrame, keys: list[str], cy_start: int | None = None) -> DataFrame:
    """Per series the crop year a one-year view shows: the given one, else the latest."""
    latest = dff.groupBy(*keys).agg(F.max(CY).alias("SEL_CY"))
    return latest if cy_start is None else latest.withColumn("SEL_CY", F.lit(cy_start))


def in_selected_year(dff: DataFrame, keys: list[str], cy_start: int | None = None) -> DataFrame:
    sel = selected_year(dff, keys, cy_start)
    return join_on_keys(dff, sel, keys).where(F.col(CY) == F.col("SEL_CY")).drop("SEL_CY")


def month_region(dff: DataFrame, keys: list[str], cy_start: int | None = None) -> DataFrame:
    """Crop month x region in one crop year, with share of the month total (%)."""
    agg = in_selected_year(dff, keys, cy_start).groupBy(*keys, CY, CY_LABEL, CM, REGION).agg(_sum_qty())
    return agg.withColumn("SHARE_PCT", share_pct(F.col(QTY), F.sum(QTY).over(win([*keys, CM]))))


def month_partner(dff: DataFrame, keys: list[str], by_region: bool = False, n: int = 12,
                  cy_start: int | None = None) -> DataFrame:
    """Top-n partners by month in one crop year (all partners or per region).

    Every partner has all twelve crop months, absent ones 0. Share is within
    the top n of each month; a zero month total gives 0.
    """
    k = [*keys, REGION] if by_region else list(keys)
    agg = in_selected_year(dff, keys, cy_start).groupBy(*k, CY, CY_LABEL, CM, PARTNER).agg(_sum_qty())
    tops = top_n(agg.groupBy(*k, PARTNER, CY, CY_LABEL).agg(F.sum(QTY).alias("TOTAL")), k, PARTNER, n)
    members = tops.select(*k, PARTNER, F.col("RANK").alias("PARTNER_RANK"))
    cells = (tops.select(*k, PARTNER, CY, CY_LABEL)
             .withColumn(CM, F.explode(F.sequence(F.lit(1), F.lit(12)))))
    out = _filled(agg, members, k, PARTNER, cells, [CY, CY_LABEL, CM])
    month_tot = F.sum(QTY).over(win([*k, CM]))
    return out.withColumn("SHARE_PCT", F.col(QTY) / F.when(month_tot == 0, 1.0).otherwise(month_tot) * 100)


def _partner_year(dff: DataFrame, k: list[str]) -> DataFrame:
    return dff.groupBy(*k, PARTNER, CY, CY_LABEL).agg(_sum_qty())


def year_partner(dff: DataFrame, keys: list[str], n: int = 12, by_region: bool = False) -> DataFrame:
    """Top-n partners (total over the shown years) by crop year, share within the top n.

    Every partner has every shown crop year, absent ones 0: all years of the
    series, or with ``by_region`` those in which a top partner of the region
    trades. A year without volume has a null share.
    """
    k = [*keys, REGION] if by_region else list(keys)
    agg = _partner_year(dff, k)
    tops = top_n(agg.groupBy(*k, PARTNER).agg(F.sum(QTY).alias("TOTAL")), k, PARTNER, n)
    members = tops.select(*k, PARTNER, F.col("RANK").alias("PARTNER_RANK"))
    shown = agg.join(members, [*k, PARTNER], "left_semi") if by_region else agg
    periods = shown.select(*k, CY, CY_LABEL).distinct()
    out = _filled(agg, members, k, PARTNER, _cells(members, k, periods, k), [CY, CY_LABEL])
    return out.withColumn("SHARE_PCT", share_pct(F.col(QTY), F.sum(QTY).over(win([*k, CY]))))


def top_in_year(dff: DataFrame, keys: list[str], cy_start: int, n: int = 12) -> DataFrame:
    """Per region: top-n partners ranked in one crop year, shown for every year.

    A region without rows in that year is ranked in its own latest year.
    Every partner has every crop year of the series, absent ones 0;
    ``TOTAL_RANK`` orders the partners by their total over these years.
    """
    k = [*keys, REGION]
    agg = _partner_year(dff, k)
    chosen = (agg.groupBy(*k).agg(F.max(CY).alias("_LATEST"),
                                  F.max(F.when(F.col(CY) == cy_start, 1)).alias("_HAS"))
              .select(*k, F.when(F.col("_HAS") == 1, F.lit(cy_start)).otherwise(F.col("_LATEST"))
                      .alias("RANK_CY")))
    in_rank_year = agg.join(chosen, k).where(F.col(CY) == F.col("RANK_CY"))
    tops = top_n(in_rank_year.select(*k, PARTNER, "RANK_CY", F.col(QTY).alias("TOTAL")), k, PARTNER, n)
    totals = (agg.join(tops.select(*k, PARTNER), [*k, PARTNER], "left_semi")
              .groupBy(*k, PARTNER).agg(F.sum(QTY).alias("TOTAL")))
    order = win(k).orderBy(F.col("TOTAL").desc(), F.col(PARTNER).asc())
    ranked = totals.withColumn("TOTAL_RANK", F.row_number().over(order)).drop("TOTAL")
    members = (tops.select(*k, PARTNER, "RANK_CY", F.col("RANK").alias("PARTNER_RANK"))
               .join(ranked, [*k, PARTNER]))
    periods = dff.select(*keys, CY, CY_LABEL).distinct()
    out = _filled(agg, members, k, PARTNER, _cells(members, k, periods, keys), [CY, CY_LABEL])
    return out.withColumn("SHARE_PCT", share_pct(F.col(QTY), F.sum(QTY).over(win([*k, CY]))))


def top_partners(dff: DataFrame, keys: list[str], n: int = 12) -> DataFrame:
    """Rows of the top-n partners by crop year, with their rank by total."""
    tops = top_n(dff.groupBy(*keys, PARTNER).agg(F.sum(QTY).alias("TOTAL")), keys, PARTNER, n)
    kept = dff.join(tops.select(*keys, PARTNER, "RANK"), [*keys, PARTNER])
    return kept.groupBy(*keys, PARTNER, "RANK", CY, CY_LABEL).agg(_sum_qty())


def partner_share_in_region(dff: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    """Per region: top-n partners by crop year and their % of the top-n column total."""
    return year_partner(dff, keys, n, by_region=True)


def with_rest(agg: DataFrame, keys: list[str], period: list[str], n: int) -> DataFrame:
    """Top-n member rows, a Rest-of-World row and a Total row per period.

    Absent cells are 0, Rest of World included when nobody is left over. Every
    period is kept, also one traded only by non-top members, so Total always
    equals the sum of all members. Members, rest and total come from one
    aggregate over two grouping sets; empty cells enter it as rows of 0.
    """
    tops = top_n(agg.groupBy(*keys, PARTNER).agg(F.sum(QTY).alias("TOTAL")), keys, PARTNER, n)
    tops = tops.select(*keys, PARTNER, "RANK")
    ranked = agg.join(tops, [*keys, PARTNER], "left").select(
        *keys, *period, F.when(F.col("RANK").isNotNull(), F.col(PARTNER)).alias(PARTNER), F.coalesce("RANK", F.lit(n + 1)).alias("RANK"), QTY)
    # the periods of the series, each with its empty cells: every top member and the rest
    members = tops.groupBy(*keys).agg(F.collect_list(F.struct(PARTNER, "RANK")).alias("_M"))      # n at most
    periods = agg.select(*keys, *period).distinct()
    cells = periods.join(members, keys) if keys else periods.crossJoin(F.broadcast(members))
    rest = F.array(F.struct(F.lit(None).cast("string").alias(PARTNER), F.lit(n + 1).alias("RANK")))
    cells = cells.select(*keys, *period, F.inline(F.concat("_M", rest)), F.lit(0.0).alias(QTY))
    both = ranked.unionByName(cells)
    sets = [[*keys, *period, PARTNER, "RANK"], [*keys, *period]]
    out = both.groupingSets([[F.col(c) for c in g] for g in sets], *[F.col(c) for c in sets[0]]).agg(_sum_qty(), F.grouping("RANK").alias("_G"))
    kind = F.when(F.col("_G") == 1, "total").when(F.col("RANK") > n, "rest").otherwise("partner")
    label = F.when(F.col("_G") == 1, TOTAL).when(F.col("RANK") > n, REST).otherwise(F.col(PARTNER))
    return out.select(*keys, kind.alias("ROW_TYPE"), label.alias("ROW_LABEL"), F.coalesce("RANK", F.lit(n + 2)).alias("RANK"), *period, QTY)


def top15_with_rest(dff: DataFrame, keys: list[str], n: int = 15) -> DataFrame:
    return with_rest(_partner_year(dff, keys), keys, [CY, CY_LABEL], n)


def monthly_breakdown(dff: DataFrame, keys: list[str], n: int = 15, cy_start: int | None = None) -> DataFrame:
    one = in_selected_year(dff, keys, cy_start)
    agg = one.groupBy(*keys, PARTNER, CY, CY_LABEL, CM).agg(_sum_qty())
    return with_rest(agg, keys, [CY, CY_LABEL, CM], n)

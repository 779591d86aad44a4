"""Selection filters (F1-F6) and filter domains (F2/E19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CM, COMMODITY_TAG, CY, PARTNER, REGION, REPORTER, REPORTER_REGION
from ._util import in_or_present, join_on_keys, win


def filter_trade(df: DataFrame, reporters=(), regions=(), partners=(), tags=()) -> DataFrame:
    """Conjunctive IN-lists over REPORTER, REGION, PARTNER, COMMODITY_TAG.

    An empty list means "everything in scope"; rows with a null in any of
    these columns never pass.
    """
    cond = (in_or_present(REPORTER, reporters) & in_or_present(REGION, regions)
            & in_or_present(PARTNER, partners) & in_or_present(COMMODITY_TAG, tags))
    return df.where(cond)


def drill_filter(df: DataFrame, partners=(), crop_years=(), crop_months=(), tags=()) -> DataFrame:
    """Drilldown mask: partner, crop-year start, crop month and tag lists."""
    cond = (in_or_present(PARTNER, partners) & in_or_present(CY, crop_years)
            & in_or_present(CM, crop_months) & in_or_present(COMMODITY_TAG, tags))
    return df.where(cond)


def drill_months(df: DataFrame, crop_months=()) -> DataFrame:
    """Month subset in crop-month numbers; empty = all 12."""
    return df.where(in_or_present(CM, crop_months))


def seasonal_range(df: DataFrame, cy_from: int | None = None, cy_to: int | None = None) -> DataFrame:
    """Inclusive crop-year range on CROP_YEAR_START (open where None)."""
    return df.where(seasonal_range_of(cy_from, cy_to))


def seasonal_range_of(cy_from: int | None = None, cy_to: int | None = None) -> F.Column:
    """The condition of ``seasonal_range``."""
    cond = F.lit(True)
    if cy_from is not None:
        cond = cond & (F.col(CY) >= cy_from)
    if cy_to is not None:
        cond = cond & (F.col(CY) <= cy_to)
    return cond


def filter_domains(df: DataFrame, keys: list[str], reporter_region: str | None = None,
                   partner_region: str | None = None, overview: bool = False, reporters=()) -> DataFrame:
    """Cascading choice lists as (DOMAIN, VALUE, POSITION) rows per series key,
    POSITION counting the sorted values of a list from 1.

    reporter_region -> reporters of that region -> (those of ``reporters`` in
    scope; all of them when none is) -> their partner regions, the partners of
    the chosen partner region, and their tags. One scan: rows are reduced to
    their distinct dimension values, each of which emits its candidate
    (domain, value) pairs, then one distinct. With ``overview`` regions,
    partners and tags are those of all rows and only the reporter list follows
    the reporter region.
    """
    in_rep = F.lit(True) if reporter_region is None else (F.col(REPORTER_REGION) == reporter_region)
    dims = [*keys, *[c for c in (REPORTER_REGION, REPORTER, REGION, PARTNER, COMMODITY_TAG) if c not in keys]]
    rows, scope = df.select(*dims).distinct(), F.lit(True) if overview else in_rep
    if reporters and not overview:
        chosen = in_rep & F.col(REPORTER).isin(list(reporters))
        any_chosen = rows.groupBy(*keys).agg(F.coalesce(F.bool_or(chosen), F.lit(False)).alias("_ANY"))
        rows = join_on_keys(rows, any_chosen, keys)
        scope = in_rep & (~F.col("_ANY") | chosen)
    in_part = scope if partner_region is None else (scope & (F.col(REGION) == partner_region))

    def item(name: str, col: str, chosen) -> F.Column:
        return F.when(chosen & F.col(col).isNotNull(),
                      F.struct(F.lit(name).alias("DOMAIN"), F.col(col).cast("string").alias("VALUE")))

    items = F.array(item("reporter_region", REPORTER_REGION, F.lit(True)), item("reporter", REPORTER, in_rep),
                    item("region", REGION, scope), item("partner", PARTNER, in_part),
                    item("tag", COMMODITY_TAG, scope))
    values = (rows.select(*keys, F.explode(items).alias("_D")).where(F.col("_D").isNotNull())
              .select(*keys, "_D.DOMAIN", "_D.VALUE").distinct())
    # a list is one choice box: distinct names, never rows
    return values.withColumn("POSITION", F.row_number().over(win([*keys, "DOMAIN"]).orderBy("VALUE")))

"""Crop-year calendar, period keys and lag shift (column expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CM, CY, CY_LABEL, DATE, MONTH, QTY, QTY1, UNIT_DIVISORS, YEAR, check_start_month


def crop_year_start(year: Column, month: Column, start_month: int) -> Column:
    """First calendar year of the crop year holding (year, month)."""
    return (year - F.when(month < F.lit(start_month), 1).otherwise(0)).cast("int")


def crop_year_label(cy_start: Column, start_month: int) -> Column:
    """"YYYY" for a Jan start, else "yy/yy" (display only; order on the int)."""
    if start_month == 1:
        return cy_start.cast("string")

    def two(c: Column) -> Column:
        return F.lpad(F.pmod(c, F.lit(100)).cast("string"), 2, "0")

    return F.concat(two(cy_start), F.lit("/"), two(cy_start + 1))


def crop_month_num(month: Column, start_month: int) -> Column:
    """1-based month inside the crop year (pmod, never negative)."""
    return (F.pmod(month - F.lit(start_month), F.lit(12)) + 1).cast("int")


def crop_month_label(cm: Column, start_month: int | str) -> Column:
    """Month name of a crop month number ("Jul" for month 1 of a July year)."""
    from ..schema import month_order
    return F.element_at(F.array(*[F.lit(m) for m in month_order(start_month)]), cm)


def year_month_key(year: Column, month: Column) -> Column:
    return (year * 100 + month).cast("int")


def with_crop_date(df: DataFrame, start_month: int = 1) -> DataFrame:
    """DATE (first of the calendar month) back from CROP_YEAR_START and CROP_MONTH_NUM."""
    s = check_start_month(start_month)
    k = F.col(CM) + (s - 2)                  # months since January of the start year
    return df.withColumn(DATE, F.make_date((F.col(CY) + F.floor(k / 12)).cast("int"),
                                           (F.pmod(k, F.lit(12)) + 1).cast("int"), F.lit(1)))


def with_calendar(df: DataFrame, start_month: int = 1) -> DataFrame:
    """Add DATE, CROP_YEAR_START, CROP_YEAR and CROP_MONTH_NUM."""
    s = check_start_month(start_month)
    y, m = F.col(YEAR), F.col(MONTH)
    cy = crop_year_start(y, m, s)
    return df.withColumns({
        DATE: F.make_date(y, m, F.lit(1)),
        CY: cy,
        CY_LABEL: crop_year_label(cy, s),
        CM: crop_month_num(m, s),
    })


def with_unit(df: DataFrame, unit: str = "MT") -> DataFrame:
    """QTY = QTY1 in the chosen unit."""
    if unit not in UNIT_DIVISORS:
        raise ValueError(f"unit must be one of {sorted(UNIT_DIVISORS)}")
    div = UNIT_DIVISORS[unit]
    q = F.col(QTY1) if div == 1.0 else F.col(QTY1) / F.lit(div)
    return df.withColumn(QTY, q.cast("double"))


def shift_months(df: DataFrame, lag: int, start_month: int | str = 1) -> DataFrame:
    """Move every row ``lag`` months back and rebuild the calendar columns."""
    if lag == 0:
        return with_calendar(df, start_month)
    shifted = F.add_months(F.make_date(F.col(YEAR), F.col(MONTH), F.lit(1)), -lag)
    return with_calendar(
        df.withColumns({YEAR: F.year(shifted).cast("int"), MONTH: F.month(shifted).cast("int")}),
        start_month)

"""Scalar helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import NULL_WORDS


def hs4(commodity: Column) -> Column:
    """First run of digits, left-padded to 4 and cut to 4; null without digits."""
    digits = F.regexp_extract(commodity.cast("string"), r"([0-9]+)", 1)
    return F.lpad(F.nullif(digits, F.lit("")), 4, "0")


def pct_change(cur: Column, prev: Column) -> Column:
    """(cur / prev - 1) * 100; null for a zero or missing base (no inf)."""
    return (F.try_divide(cur, F.nullif(prev, F.lit(0.0))) - 1) * 100


def share_pct(part: Column, total: Column) -> Column:
    """part / total * 100; null for a zero total."""
    return F.try_divide(part, F.nullif(total, F.lit(0.0))) * 100


def growth_vs(value: Column, base: Column) -> Column:
    """(value / base - 1) * 100 only where base > 0 and value is present."""
    return F.when((base > 0) & value.isNotNull(), (value / base - 1) * 100)


def zero_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(0.0))


def null_words_to_null(c: Column) -> Column:
    """Strings that a pandas reader takes as missing become null."""
    return F.when(F.trim(c).isin(NULL_WORDS) | c.isNull(), F.lit(None).cast("string")).otherwise(c)

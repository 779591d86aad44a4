"""Properties of the calendar and the YTD series."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradelens.functions.calendar import with_calendar, with_crop_date
from tradelens.operators import series
from tradelens.operators.cutoff import period_stats
from tradelens.schema import CY, DATE, MONTH, YEAR

from conftest import make_trade, monthly_rows
from test_cutoff_series import prep


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1990, 2030), st.integers(1, 12)), min_size=1, max_size=40),
       st.integers(1, 12))
def test_crop_calendar_round_trip(spark, ym, start):
    df = make_trade(spark, [("E", "A", "B", "3101", y, m, 1.0, 1.0) for y, m in ym])
    cal = with_calendar(df, start)
    back = with_crop_date(cal.drop(DATE), start)
    bad = back.where((F.year(DATE) != F.col(YEAR)) | (F.month(DATE) != F.col(MONTH))).count()
    assert bad == 0
    # crop year start is never after the calendar year and at most one year before
    assert cal.where((F.col(CY) > F.col(YEAR)) | (F.col(CY) < F.col(YEAR) - 1)).count() == 0


def test_ytd_at_month_12_is_annual_total(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(y, m, float(y % 7 + m)) for y in (2018, 2019, 2020)
                                                      for m in range(1, 13)])
    df = prep(spark, rows)
    stats = period_stats(df, [])
    assert stats.first().COMMON_MONTH == 12
    ytd = {r[CY]: r.YTD_QTY for r in series.ytd_yoy(df, stats, []).collect()}
    annual = {r[CY]: r.ANNUAL_QTY for r in series.complete_years(series.monthly_cube(df, []), []).collect()}
    assert ytd == annual

from tradelens.functions.calendar import with_calendar, with_unit
from tradelens.operators import series
from tradelens.operators.cutoff import common_cutoff_ym, display_trim, period_stats
from tradelens.operators.filters import filter_trade
from tradelens.dims import fixture_dims
from tradelens.operators.enrich import enrich_trade
from tradelens.schema import CM, CY, DATE, QTY

from conftest import SF_SMALL, make_trade, monthly_rows


def prep(spark, rows, start=1):
    df = enrich_trade(make_trade(spark, rows), fixture_dims(spark, SF_SMALL))
    return filter_trade(with_unit(with_calendar(df, start)))


def test_lagging_reporter_cutoffs(spark):
    rows = (monthly_rows("E", "NATION_0", "NATION_3", [(2020, m, 1.0) for m in range(1, 9)])
            + monthly_rows("E", "NATION_1", "NATION_3", [(2020, m, 1.0) for m in range(1, 6)])
            + monthly_rows("E", "NATION_2", "NATION_3", [(2019, 11, 1.0)]))
    df = prep(spark, rows)
    st = period_stats(df, []).first()
    assert st.LATEST_CY_START == 2020 and st.COMMON_MONTH == 5   # the 2019-only reporter is ignored
    ym = common_cutoff_ym(df, [], 1).first()
    assert ym.COMMON_YM == 201911 and ym.COMMON_CAL_MONTH == 11 and ym.COMMON_CROP_MONTH == 11


def test_trim_and_drop_oldest(spark):
    rows = (monthly_rows("E", "NATION_0", "NATION_3", [(y, m, 1.0) for y in (2018, 2019) for m in range(1, 13)])
            + monthly_rows("E", "NATION_0", "NATION_3", [(2020, m, 1.0) for m in range(1, 9)])
            + monthly_rows("E", "NATION_1", "NATION_3", [(2020, m, 1.0) for m in range(1, 4)]))
    df = prep(spark, rows)
    disp = display_trim(df, [])
    years = sorted({(r[CY], r[CM]) for r in disp.select(CY, CM).collect()})
    assert min(y for y, _ in years) == 2019                      # oldest year dropped
    assert max(m for y, m in years if y == 2020) == 3            # latest year cut at the common month
    st = period_stats(df, []).first()
    assert st.PREV_CY_START == 2019 and st.N_CY == 3


def test_ytd_yoy_over_gap_and_zero_base(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(2015, 1, 10.0), (2017, 1, 15.0)])
    df = prep(spark, rows)
    out = series.ytd_yoy(df, period_stats(df, []), []).orderBy(CY).collect()
    assert [r.YOY_PCT for r in out] == [None, 50.0]
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(2015, 1, 0.0), (2016, 1, 5.0), (2017, 1, 0.0),
                                                      (2018, 1, 0.0)])
    df = prep(spark, rows)
    out = series.ytd_yoy(df, period_stats(df, []), []).orderBy(CY).collect()
    assert [r.YOY_PCT for r in out] == [None, None, -100.0, None]


def test_rolling_by_rows(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(2020, 1, 1.0), (2020, 2, 2.0), (2020, 4, 4.0),
                                                      (2020, 5, 5.0)])
    df = prep(spark, rows)
    out = series.rolling(series.monthly_total(df, []), [], 3).orderBy(DATE).collect()
    assert [r.ROLLING for r in out] == [None, None, 7.0, 11.0]


def test_all_null_sum_is_zero(spark):
    rows = [("E", "NATION_0", "NATION_3", "3101", 2020, 1, 1.0, None)]
    df = prep(spark, rows)
    assert series.monthly_cube(df, []).first()[QTY] == 0.0


def test_one_complete_year_band(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(2019, m, float(m)) for m in range(1, 13)]
                        + [(2020, m, 1.0) for m in range(1, 4)])
    cube = series.monthly_cube(prep(spark, rows), [])
    band = series.reference_band(cube, []).collect()
    assert len(band) == 12 and all(r.BAND_N == 1 for r in band)
    assert all(r.BAND_MIN <= r.BAND_AVG <= r.BAND_MAX for r in band)


def test_zero_month_is_not_complete(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(2019, m, 0.0 if m == 6 else 1.0) for m in range(1, 13)])
    comp = series.complete_years(series.monthly_cube(prep(spark, rows), []), []).first()
    assert comp.N_POSITIVE_MONTHS == 11 and comp.IS_COMPLETE is False


def test_cumulative_ends_at_annual_total(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(2019, m, float(m)) for m in (1, 2, 5, 9)])
    cum = series.cumulative(series.monthly_cube(prep(spark, rows), []), []).orderBy(CM).collect()
    assert [r.CUM_QTY for r in cum] == [1.0, 3.0, 8.0, 17.0]


def test_heatmap_rows(spark):
    rows = monthly_rows("E", "NATION_0", "NATION_3", [(y, m, float(y - 2000)) for y in (2017, 2018, 2019)
                                                      for m in range(1, 13)] + [(2020, 1, 40.0), (2020, 2, 0.0)])
    df = prep(spark, rows)
    stats = period_stats(df, [])
    cube = series.monthly_cube(display_trim(df, [], stats=stats), [])
    hm = {r.ROW_TYPE + ":" + r.ROW_LABEL: r for r in series.heatmap(cube, stats, []).collect()}
    assert hm["min:Min (L2Y)"].M01 == 18.0 and hm["max:Max (L2Y)"].TOTAL == 19.0 * 12
    assert hm["year:2020"].TOTAL is None and hm["year:2018"].TOTAL == 18.0 * 12
    vs = hm["vs_avg:vs Avg (L2Y)%"]
    assert abs(vs.M01 - (40.0 / 18.5 - 1) * 100) < 1e-9 and vs.M02 is None

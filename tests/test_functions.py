from pyspark.sql import functions as F

from tradelens.functions.calendar import shift_months, with_calendar, with_unit
from tradelens.functions.scalars import hs4, null_words_to_null, pct_change
from tradelens.schema import CM, CY, CY_LABEL, MONTH, YEAR, month_order

from conftest import make_trade


def test_hs4_cases(spark):
    rows = [("52.01",), ("520100",), ("7",), ("abc",), (None,), ("31x05",)]
    df = spark.createDataFrame(rows, "c string").select(hs4(F.col("c")).alias("h"))
    assert [r.h for r in df.collect()] == ["0052", "5201", "0007", None, None, "0031"]


def test_crop_calendar_july_crosses_century(spark):
    df = make_trade(spark, [("E", "A", "B", "3101", 2000, 6, 1.0, 1.0), ("E", "A", "B", "3101", 2000, 7, 1.0, 1.0)])
    out = with_calendar(df, 7).orderBy(MONTH).select(CY, CY_LABEL, CM).collect()
    assert [tuple(r) for r in out] == [(1999, "99/00", 12), (2000, "00/01", 1)]
    # ordering uses the int start year, so 99/00 comes before 00/01
    assert out[0][CY] < out[1][CY]


def test_crop_calendar_january(spark):
    df = make_trade(spark, [("E", "A", "B", "3101", 2020, 5, 1.0, 1.0)])
    r = with_calendar(df, 1).select(CY, CY_LABEL, CM).first()
    assert tuple(r) == (2020, "2020", 5)


def test_month_order():
    assert month_order(7)[:2] == ["Jul", "Aug"] and month_order(7)[-1] == "Jun"


def test_lag_shift_and_inverse(spark):
    df = make_trade(spark, [("I", "A", "B", "3101", 2020, 1, 1.0, 1.0)])
    r = shift_months(df, 2, 1).select(YEAR, MONTH).first()
    assert tuple(r) == (2019, 11)
    back = shift_months(shift_months(df, 3, 1), -3, 1).select(YEAR, MONTH).first()
    assert tuple(back) == (2020, 1)


def test_unit_scaling(spark):
    df = make_trade(spark, [("E", "A", "B", "3101", 2020, 1, 1.0, 2500.0)])
    assert with_unit(df, "k MT").first().QTY == 2.5
    assert with_unit(df, "MMT").first().QTY == 0.0025


def test_pct_change_zero_base(spark):
    df = spark.createDataFrame([(0.0, None), (5.0, 0.0), (0.0, 5.0), (0.0, 0.0)], "cur double, prev double")
    out = [r.p for r in df.select(pct_change(F.col("cur"), F.col("prev")).alias("p")).collect()]
    assert out == [None, None, -100.0, None]


def test_null_words(spark):
    df = spark.createDataFrame([("NA",), ("None",), ("null",), ("N/A",), ("",), ("x",)], "c string")
    out = [r.c for r in df.select(null_words_to_null(F.col("c")).alias("c")).collect()]
    assert out == [None, None, None, None, None, "x"]


def test_crop_month_label(spark):
    from tradelens.functions.calendar import crop_month_label
    df = spark.createDataFrame([(1,), (6,), (7,), (12,)], "cm int")
    assert [r.l for r in df.select(crop_month_label(F.col("cm"), 7).alias("l")).collect()] == ["Jul", "Dec", "Jan", "Jun"]
    assert [r.l for r in df.select(crop_month_label(F.col("cm"), 1).alias("l")).collect()] == ["Jan", "Jun", "Jul", "Dec"]


def test_year_basis_presets(spark):
    import pytest
    from tradelens.schema import check_start_month
    assert [check_start_month(p) for p in ("Jan-Dec", "Jul-Jun", "Oct-Sep", 4)] == [1, 7, 10, 4]
    for bad in (0, 13, "Apr-Mar", 7.0, True):
        with pytest.raises(ValueError):
            check_start_month(bad)
    df = make_trade(spark, [("E", "A", "B", "3101", 2000, 9, 1.0, 1.0)])
    r = with_calendar(df, "Oct-Sep").select(CY, CY_LABEL, CM).first()
    assert tuple(r) == (1999, "99/00", 12)
    assert month_order("Oct-Sep")[0] == "Oct"

from tradelens.operators import drill, projection
from tradelens.operators._util import top_n
from tradelens.schema import CM, CY, CY_LABEL, PARTNER, QTY, REGION


def cube_of(spark, cells):
    rows = [(cy, str(cy), cm, float(q)) for (cy, cm, q) in cells]
    return spark.createDataFrame(rows, f"{CY} int, {CY_LABEL} string, {CM} int, {QTY} double")


def stats_of(spark, latest, common, prev):
    return spark.createDataFrame([(latest, common, prev)],
                                 "LATEST_CY_START int, COMMON_MONTH int, PREV_CY_START int")


def test_ytd_projection_falls_back_to_complete_mean(spark):
    cells = ([(2016, m, 10) for m in range(1, 13)] + [(2017, m, 20) for m in range(1, 13)]
             + [(2018, m, 30) for m in range(1, 13) if m != 5] + [(2019, m, 30) for m in range(1, 5)])
    out = {r[CM]: r for r in projection.projection_ytd(cube_of(spark, cells), stats_of(spark, 2019, 4, 2018), [],
                                                       yoy=10.0).collect()}
    assert sorted(out) == list(range(5, 13))
    assert abs(out[5].PROJ_QTY - 15 * 1.1) < 1e-9          # no previous value: mean of complete years
    assert abs(out[6].PROJ_QTY - 30 * 1.1) < 1e-9


def test_ytd_projection_default_yoy(spark):
    cells = ([(2017, m, 20) for m in range(1, 13)] + [(2018, m, 10) for m in range(1, 13)]
             + [(2019, m, 11) for m in range(1, 4)])
    out = projection.projection_ytd(cube_of(spark, cells), stats_of(spark, 2019, 3, 2018), []).collect()
    assert all(abs(r.YOY_PCT - 10.0) < 1e-9 for r in out) and len(out) == 9


def test_yearly_target_below_ytd_gives_no_rows(spark):
    cells = [(2016, m, 10) for m in range(1, 13)] + [(2017, m, 10) for m in range(1, 13)] + [(2019, 1, 4), (2019, 2, 4)]
    out = projection.projection_manual_year(cube_of(spark, cells), stats_of(spark, 2019, 2, 2017), [], target=5.0)
    assert out.count() == 0
    out = projection.projection_manual_year(cube_of(spark, cells), stats_of(spark, 2019, 2, 2017), [], target=128.0)
    rows = out.collect()
    assert len(rows) == 10 and abs(sum(r.PROJ_QTY for r in rows) - 120.0) < 1e-9


def test_proportions_projection(spark):
    cells = [(2017, m, m) for m in range(1, 13)] + [(2019, m, 2 * m) for m in range(1, 4)]
    rows = projection.projection_proportions(cube_of(spark, cells), stats_of(spark, 2019, 3, None), []).collect()
    assert abs(rows[0].IMPLIED_TOTAL - 156.0) < 1e-9       # YTD 12 / elapsed share 6/78
    assert abs(sum(r.PROJ_QTY for r in rows) - 144.0) < 1e-9


def test_top_n_ties_by_name(spark):
    df = spark.createDataFrame([("c", 5.0), ("a", 5.0), ("b", 5.0), ("d", 9.0)], f"{PARTNER} string, TOTAL double")
    assert [r[PARTNER] for r in top_n(df, [], PARTNER, 3).orderBy("RANK").collect()] == ["d", "a", "b"]


def test_remainder_keeps_periods_without_top_members(spark):
    agg = spark.createDataFrame([("A", 2019, 100.0), ("B", 2019, 1.0), ("B", 2020, 2.0)],
                                f"{PARTNER} string, {CY} int, {QTY} double")
    out = {(r.ROW_TYPE, r[CY]): r[QTY] for r in drill.with_rest(agg, [], [CY], 1).collect()}
    assert out == {("partner", 2019): 100.0, ("partner", 2020): 0.0, ("rest", 2019): 1.0, ("rest", 2020): 2.0,
                   ("total", 2019): 101.0, ("total", 2020): 2.0}


def test_top_in_year_falls_back_to_latest_year(spark):
    rows = [("X", "p1", 2017, 5.0), ("X", "p2", 2018, 7.0), ("Y", "q1", 2019, 3.0)]
    dff = spark.createDataFrame([(r, p, cy, str(cy), q) for r, p, cy, q in rows],
                                f"{REGION} string, {PARTNER} string, {CY} int, {CY_LABEL} string, {QTY} double")
    out = {(r[REGION], r[PARTNER]): r.RANK_CY for r in drill.top_in_year(dff, [], 2019, 12).collect()}
    assert out == {("X", "p2"): 2018, ("Y", "q1"): 2019}


def test_absent_cells_are_zero(spark):
    cells = [("X", "p1", 2019, 2, 5.0), ("X", "p2", 2019, 3, 15.0), ("X", "p2", 2019, 2, 5.0), ("Y", "q", 2018, 1, 1.0)]
    dff = spark.createDataFrame([(r, p, cy, str(cy), cm, q) for r, p, cy, cm, q in cells],
                                f"{REGION} string, {PARTNER} string, {CY} int, {CY_LABEL} string, {CM} int, {QTY} double")
    mp = drill.month_partner(dff, []).collect()
    assert len(mp) == 24 and sum(r[QTY] for r in mp) == 25.0
    assert {(r[PARTNER], r.SHARE_PCT) for r in mp if r[CM] == 2} == {("p1", 50.0), ("p2", 50.0)}
    assert all(r.SHARE_PCT == 0.0 for r in mp if r[CM] not in (2, 3))
    yp = {(r[PARTNER], r[CY]): r[QTY] for r in drill.year_partner(dff, []).collect()}
    assert yp == {("p1", 2018): 0.0, ("p2", 2018): 0.0, ("q", 2018): 1.0,
                  ("p1", 2019): 5.0, ("p2", 2019): 20.0, ("q", 2019): 0.0}
    by = {(r[REGION], r[PARTNER], r[CY]) for r in drill.year_partner(dff, [], by_region=True).collect()}
    assert by == {("X", "p1", 2019), ("X", "p2", 2019), ("Y", "q", 2018)}
    yr = {(r[REGION], r[CY]): r[QTY] for r in drill.year_region(dff, []).collect()}
    assert yr == {("X", 2018): 0.0, ("X", 2019): 25.0, ("Y", 2018): 1.0, ("Y", 2019): 0.0}
    top = {(r[PARTNER], r[CY]): (r[QTY], r.TOTAL_RANK) for r in drill.top_in_year(dff, [], 2019).collect()}
    assert top[("p1", 2018)] == (0.0, 2) and top[("p2", 2019)] == (20.0, 1) and top[("q", 2019)] == (0.0, 1)


def test_parameter_checks(spark):
    import pytest
    from tradelens.operators import mirror
    df = spark.createDataFrame([], "FLOW string, REPORTER string, PARTNER string, YEAR int, MONTH int, QTY double")
    with pytest.raises(ValueError):
        mirror.mirror_overlay(df, df, 7, lag=-1)
    with pytest.raises(ValueError):
        drill.drill_stats(df, [], 7, years_back=0)

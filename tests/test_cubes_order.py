"""Cubes that follow the stored table, results in period order, chart tables,
totals without remaining months, choice lists of chosen reporters."""

import pytest
from pyspark.sql import functions as F

from tradelens.functions.calendar import with_calendar, with_unit
from tradelens.operators import charts, drill, filters, mirror, projection, series
from tradelens.operators.cutoff import display_trim, period_stats
from tradelens.schema import CM, COMMODITY_TAG, CY, FLOW, PARTNER, QTY, QTY1, REGION, REPORTER, REPORTER_REGION, YEAR
from tradelens.session import scratch_path
from tradelens.sources import commits
from tradelens.sources.cubes import DRILL_CUBE, MIRROR_CUBE, REPORTER_CUBE, cube_rows, read_cube, refresh_cube, stale_partitions, stale_rows
from tradelens.sources.ordered import read_in_order, write_in_order
from tradelens.sources.table import read_table, upsert_table

from conftest import make_trade


def dated(spark, rows, start=1):
    """Rows with calendar, unit and fixed regions."""
    df = make_trade(spark, rows).withColumns({REGION: F.lit("Asia"), REPORTER_REGION: F.lit("Asia"), COMMODITY_TAG: F.lit("t")})
    return with_unit(with_calendar(df, start), "MT")


def years(flow, reporter, partner, spec, qty=1.0):
    """spec: {year: last month}."""
    return [(flow, reporter, partner, "3102", y, m, 1.0, qty * m) for y, last in spec.items() for m in range(1, last + 1)]


@pytest.mark.parametrize("dims", [REPORTER_CUBE, DRILL_CUBE, MIRROR_CUBE])
def test_cube_follows_an_upsert(spark, dims):
    path, cube = scratch_path(spark, "t"), scratch_path(spark, "cube")
    extra = {REGION: F.when(F.col(PARTNER) == "B", "Asia").when(F.col(PARTNER) == "C", "Europe")}
    rows = [("EI"[i % 2], "A", p, "3101", y, m, 1.0, float(i + y)) for i, p in enumerate("BCD") for y in (2018, 2019, 2020) for m in (1, 7)]
    upsert_table(make_trade(spark, rows).withColumns(extra), path)
    assert len(refresh_cube(spark, path, cube, dims)) == 6
    assert refresh_cube(spark, path, cube, dims) == []
    upsert_table(make_trade(spark, [("E", "A", "B", "3101", 2020, 7, 1.0, 5.0), ("E", "Z", "B", "3101", 2021, 1, 1.0, 6.0)]).withColumns(extra), path)
    stale, gone = stale_partitions(commits.last(spark, path), commits.last(spark, cube))
    assert sorted(stale) == ["FLOW=E/YEAR=2020", "FLOW=E/YEAR=2021"] and not gone
    plan = cube_rows(stale_rows(spark, path, stale), dims)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2021" in plan.split("PartitionFilters")[1].split("\n")[0] and "2019" not in plan
    assert refresh_cube(spark, path, cube, dims) == sorted(stale)
    upsert_table(make_trade(spark, [("I", "A", "C", "3101", 2019, 1, 1.0, 5.0)]).withColumns(extra), path, full=True)     # other import years go
    refresh_cube(spark, path, cube, dims)
    cols = [FLOW, *dims, YEAR, "MONTH", QTY1]
    fresh = cube_rows(read_table(spark, path), dims).select(cols)
    assert sorted(map(tuple, read_cube(spark, cube).select(cols).collect())) == sorted(map(tuple, fresh.collect()))


def test_ordered_files(spark):
    path = scratch_path(spark, "ordered")
    df = spark.range(0, 5000, 1, 7).select(F.pmod(F.xxhash64("id"), F.lit(3)).alias("k"), F.pmod(F.hash("id"), F.lit(997)).alias("p"), "id")
    write_in_order(df, path, ["k", "p"], 6)
    got = read_in_order(spark, path).orderBy("POSITION").collect()
    assert [r.POSITION for r in got] == list(range(1, 5001))
    assert [(r.k, r.p) for r in got] == sorted((r.k, r.p) for r in got)
    assert len(spark.read.parquet(path).inputFiles()) > 1


def inputs(spark, rows, keys=()):
    df = dated(spark, rows)
    stats = period_stats(df, list(keys))
    return series.monthly_cube(display_trim(df, list(keys), stats=stats), list(keys)), stats


def test_totals_when_no_month_remains(spark):
    cube, stats = inputs(spark, years("E", "A", "B", {2017: 12, 2018: 12, 2019: 12}))
    r = projection.projection_totals(cube, stats, []).first()
    assert (r.N_REMAINING, r.CY_YTD, round(r.IMPLIED_TOTAL, 6), r.TARGET, r.REMAINING_BUDGET) == (0, 78.0, 78.0, 78.0, 0.0)
    assert projection.projection_totals(cube, stats, [], target=100).first().REMAINING_BUDGET == 22.0
    assert projection.projection_proportions(cube, stats, []).count() == 0


def test_totals_when_the_budget_is_spent(spark):
    cube, stats = inputs(spark, years("E", "A", "B", {2017: 12, 2018: 12, 2019: 6}))
    r = projection.projection_totals(cube, stats, [], target=10).first()
    assert (r.N_REMAINING, r.CY_YTD, round(r.IMPLIED_TOTAL, 6), r.TARGET, r.REMAINING_BUDGET) == (6, 21.0, 78.0, 10.0, 0.0)
    assert projection.projection_manual_year(cube, stats, [], target=10).count() == 0


def test_totals_without_a_complete_year(spark):
    cube, stats = inputs(spark, years("E", "A", "B", {2018: 3, 2019: 2}))
    r = projection.projection_totals(cube, stats, []).first()
    assert (r.CY_YTD, r.IMPLIED_TOTAL, r.TARGET, r.REMAINING_BUDGET) == (3.0, None, 0.0, 0.0)


def test_chart_tables(spark):
    rows = [r for r in years("E", "A", "B", {2016: 12, 2017: 12, 2018: 12, 2019: 4}) if r[4:6] != (2019, 2)]
    cube, stats = inputs(spark, rows)
    proj = projection.projection_ytd(cube, stats, [])
    chart = charts.seasonal_chart(cube, stats, proj, [], 2018, 2019).collect()
    assert {(r.SERIES, r[CY]) for r in chart} == {("year", 2018), ("year", 2019), ("projection", 2019), ("band_max", None), ("band_min", None), ("band_avg", None)}
    assert [r[CM] for r in sorted((r for r in chart if r.SERIES == "year" and r[CY] == 2019), key=lambda r: r[CM])] == [1, 3, 4]
    assert sorted((r[CM], r.IS_PROJECTED) for r in chart if r.SERIES == "projection") == [(4, False)] + [(m, True) for m in range(5, 13)]
    assert not [r for r in charts.seasonal_chart(cube, stats, proj, [], 2017, 2018).collect() if r.SERIES == "projection"]
    latest = charts.latest_chart(cube, stats, proj, []).collect()
    assert sorted((r[CM], r[QTY]) for r in latest if r.SERIES == "latest" and r[CM] != 2) == [(1, 1.0), (3, 3.0), (4, 4.0)]
    assert [r[QTY] for r in latest if r.SERIES == "latest" and r[CM] == 2] == [None]
    short, short_stats = inputs(spark, years("E", "A", "B", {2018: 3, 2019: 2}))
    none = projection.projection_manual_month(short_stats, [], 1.0)
    assert charts.latest_chart(short, short_stats, none, []).count() == 0


def test_lists_of_chosen_reporters(spark):
    rows = [("E", "R1", "P1"), ("E", "R1", "P2"), ("E", "R2", "P3"), ("E", "R3", "P4"), ("I", "R4", "P5"), ("I", "R4", None)]
    df = spark.createDataFrame(rows, f"{FLOW} string, {REPORTER} string, {PARTNER} string").withColumns(
        {REPORTER_REGION: F.when(F.col(REPORTER) == "R3", "Europe").otherwise("Asia"), REGION: F.lit("NAM"), COMMODITY_TAG: F.lit("t")})

    def lists(domain, **kw):
        got = filters.filter_domains(df, [FLOW], **kw).where(F.col("DOMAIN") == domain).collect()
        return {f: [r.VALUE for r in sorted((r for r in got if r[FLOW] == f), key=lambda r: r.POSITION)] for f in "EI"}

    assert lists("partner", reporters=["R2", "R1"]) == {"E": ["P1", "P2", "P3"], "I": ["P5"]}        # none chosen in I: all
    assert lists("partner", reporters=["R2"]) == {"E": ["P3"], "I": ["P5"]}
    assert lists("partner", reporter_region="Asia", reporters=["R3"]) == {"E": ["P1", "P2", "P3"], "I": ["P5"]}
    assert lists("reporter", reporter_region="Asia", reporters=["R2"]) == {"E": ["R1", "R2"], "I": ["R4"]}
    assert lists("partner", reporters=["R2"], overview=True) == {"E": ["P1", "P2", "P3", "P4"], "I": ["P5"]}


def operators_of(df, name):
    """How often an operator stands in the plan that was run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0].count(name)


def test_totals_come_from_one_aggregate(spark):
    rows = [("E", "A", p, "3102", y, 1, 1.0, q) for p, q in zip("BCDE", (4.0, 3.0, 2.0, 1.0)) for y in (2018, 2019)]
    agg = dated(spark, rows).groupBy(FLOW, PARTNER, CY).agg(F.sum(QTY).alias(QTY))
    out = drill.with_rest(agg, [FLOW], [CY], 2)
    got = sorted((r[CY], r.RANK, r.ROW_TYPE, r.ROW_LABEL, r[QTY]) for r in out.collect())
    assert got == [(y, *r) for y in (2018, 2019) for r in ((1, "partner", "B", 4.0), (2, "partner", "C", 3.0), (3, "rest", drill.REST, 3.0), (4, "total", drill.TOTAL, 10.0))]
    assert operators_of(out, "Expand [") == 1


def test_heatmap_rows_come_from_one_aggregate(spark):
    cube, stats = inputs(spark, years("E", "A", "B", {2016: 12, 2017: 12, 2018: 12, 2019: 4}))
    out = series.heatmap(cube, stats, [])
    assert sorted(r.ROW_TYPE for r in out.collect()) == ["avg", "max", "min", "vs_avg", "year", "year", "year"]
    assert operators_of(out, "Expand [") == 1 and "Union" not in out._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.ROW_TYPE for r in series.heatmap(cube, stats, [], 2017, 2018).collect()) == ["avg", "max", "min", "year", "year"]


def test_overlay_reads_the_rows_once(spark):
    rows = [(f, "AB"[f == "I"], "BA"[f == "I"], "3102", y, m, 1.0, 1.0) for f in "EI" for y in (2018, 2019) for m in (1, 6, 12)]
    path = scratch_path(spark, "rows")
    dated(spark, rows).write.parquet(path)
    pairs = spark.createDataFrame([("A", "B", "B", "A")], mirror.PAIR)
    out = mirror.mirror_overlay(spark.read.parquet(path), pairs, 1, 1)
    got = sorted((r.SERIES, r[CY], r[CM]) for r in out.collect())
    assert got == sorted([("direct", y, m) for y in (2018, 2019) for m in (1, 6, 12)] + [("mirror", y, m) for y in (2018, 2019) for m in (5, 11)] + [("mirror", 2018, 12)])
    assert operators_of(out, "FileScan") == 1 and operators_of(out, "Exchange hash") <= 2

"""The query catalog: one callable (spark, sf_dir) -> DataFrame per operator.

Every query reads the test tables through the stored trade table and runs
over all of it: both flows, every reporter, partner, tag and month.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..dims import reference_dims
from ..functions.calendar import crop_month_label, shift_months, with_calendar, with_crop_date, with_unit
from ..operators import charts, drill, enrich, filters, load, mirror, projection, series
from ..session import scratch_path
from ..sources import commits, extract, files
from ..sources.cubes import REPORTER_CUBE, read_cube, refresh_cube
from ..sources.ordered import read_in_order, write_in_order
from ..sources.table import read_table, recorded_audit, table_freshness, trade_path, upsert_table
from ..streaming.upsert_stream import stream_upsert
from ..operators.cutoff import common_cutoff_ym, display_trim, period_stats
from ..operators.filters import filter_trade
from ..schema import (CM, COMMODITY_TAG, COTTON_COLUMNS, CY, CY_LABEL, DATE, FLOW, HS4, MONTH, PARTNER, PARTNER_STD,
                      QTY, QTY1, REGION, REPORTER, REPORTER_REGION, VALUE, YEAR)
from ..sources.table import test_dims
from .common import (KEYS, RAW_COLUMNS, START, UNIT, finish, materialize, pin, prepared, raw_trade,
                     reporter_cube, reuse, series_inputs, trade)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- enrich ---
@query("derive_hs4")
def q_derive_hs4(spark, sf_dir):
    return finish(enrich.derive_hs4(raw_trade(spark, sf_dir)))


@query("clean_partner")
def q_clean_partner(spark, sf_dir):
    return finish(enrich.clean_partner(raw_trade(spark, sf_dir), test_dims(spark, sf_dir)))


@query("partner_region")
def q_partner_region(spark, sf_dir):
    return finish(enrich.partner_region(raw_trade(spark, sf_dir), test_dims(spark, sf_dir)))


@query("reporter_region")
def q_reporter_region(spark, sf_dir):
    return finish(enrich.reporter_region(raw_trade(spark, sf_dir), test_dims(spark, sf_dir)))


@query("commodity_tag")
def q_commodity_tag(spark, sf_dir):
    return finish(enrich.commodity_tag(raw_trade(spark, sf_dir), test_dims(spark, sf_dir)))


@query("enrich_trade")
def q_enrich_trade(spark, sf_dir):
    return finish(enrich.enrich_trade(raw_trade(spark, sf_dir), test_dims(spark, sf_dir)))


REAL_NAMES = {f"NATION_{i}": name for i, name in enumerate(
    ["Brazil", "India", "Vietnam", "Russia", "Kenya", "Peru", "Norway", "Australia", "South Korea", "Mexico", "Ghana", "Spain"])}


@query("unmatched_partners")
def q_unmatched_partners(spark, sf_dir):
    """Partners the built-in country table does not know: half of the fixture
    nations trade under a country's name (some by an alias), the others do not."""
    names = F.create_map(*[F.lit(x) for pair in REAL_NAMES.items() for x in pair])
    rows = raw_trade(spark, sf_dir).withColumn(PARTNER, F.coalesce(names[F.col(PARTNER)], F.col(PARTNER)))
    return finish(enrich.unmatched_partners(rows, reference_dims(spark)))


# -------------------------------------------------------------- calendar ---
def _calendar(spark, sf_dir, start):
    cols = [*RAW_COLUMNS, DATE, CY, CY_LABEL, CM]
    return finish(with_calendar(raw_trade(spark, sf_dir), start).select(*cols))


@query("crop_calendar")
def q_crop_calendar(spark, sf_dir):
    return _calendar(spark, sf_dir, 1)


@query("crop_calendar_jul")
def q_crop_calendar_jul(spark, sf_dir):
    return _calendar(spark, sf_dir, 7)


@query("crop_calendar_oct")
def q_crop_calendar_oct(spark, sf_dir):
    return _calendar(spark, sf_dir, 10)


@query("mirror_shift")
def q_mirror_shift(spark, sf_dir):
    """Import rows moved one month back, calendar rebuilt."""
    imp = raw_trade(spark, sf_dir).where(F.col(FLOW) == "I")
    return finish(shift_months(imp, 1, START).select(*RAW_COLUMNS, DATE, CY, CY_LABEL, CM))


def _dated_cube(spark, sf_dir):
    return with_crop_date(series_inputs(spark, sf_dir)[2], START)


@query("monthly_total")
def q_monthly_total(spark, sf_dir):
    return finish(series.monthly_total(_dated_cube(spark, sf_dir), KEYS))


@query("monthly_total_in_order")
def q_monthly_total_in_order(spark, sf_dir):
    """Monthly totals by partner region written in period order; POSITION counts
    the rows over the files as they lie."""
    path = scratch_path(spark, "ordered")
    cube = with_crop_date(_drill_cube(spark, sf_dir), START)
    write_in_order(series.monthly_total(cube, KEYS, [REGION]), path, [*KEYS, REGION, DATE])
    return finish(read_in_order(spark, path))


# ---------------------------------------------------------------- cutoff ---
@query("latest_period")
def q_latest_period(spark, sf_dir):
    return finish(series_inputs(spark, sf_dir)[0])


def _dated_reporter_cube(spark, sf_dir):
    """The reporter cube with calendar YEAR and MONTH recovered from the crop calendar."""
    src = with_crop_date(reporter_cube(spark, sf_dir), START)
    return src.withColumns({YEAR: F.year(DATE), MONTH: F.month(DATE)})


@query("common_cutoff_ym")
def q_common_cutoff_ym(spark, sf_dir):
    return finish(common_cutoff_ym(_dated_reporter_cube(spark, sf_dir), KEYS, START))


@query("display_trim")
def q_display_trim(spark, sf_dir):
    """Trimmed rows; the period stats come from the reporter cube (one row scan)."""
    stats = series_inputs(spark, sf_dir)[0]
    disp = display_trim(prepared(spark, sf_dir), KEYS, stats=stats)
    return finish(disp.select(*RAW_COLUMNS, CY, CM))


# ---------------------------------------------------------------- series ---
def _cube(spark, sf_dir):
    return series_inputs(spark, sf_dir)


@query("seasonal")
def q_seasonal(spark, sf_dir):
    cube = _cube(spark, sf_dir)[2]
    return finish(cube.withColumn("CROP_MONTH", crop_month_label(F.col(CM), START)))


@query("monthly_matrix")
def q_monthly_matrix(spark, sf_dir):
    return finish(series.monthly_matrix(_cube(spark, sf_dir)[2], KEYS))


@query("complete_years")
def q_complete_years(spark, sf_dir):
    return finish(series.complete_years(_cube(spark, sf_dir)[2], KEYS))


@query("reference_band")
def q_reference_band(spark, sf_dir):
    return finish(series.reference_band(_cube(spark, sf_dir)[2], KEYS))


@query("latest_vs_band")
def q_latest_vs_band(spark, sf_dir):
    stats, _, cube = _cube(spark, sf_dir)
    return finish(series.latest_vs_band(cube, stats, KEYS))


@query("latest_vs_avg")
def q_latest_vs_avg(spark, sf_dir):
    stats, _, cube = _cube(spark, sf_dir)
    return finish(series.latest_vs_avg(cube, stats, KEYS))


@query("heatmap")
def q_heatmap(spark, sf_dir):
    stats, _, cube = _cube(spark, sf_dir)
    return finish(series.heatmap(cube, stats, KEYS))


@query("ytd_yoy")
def q_ytd_yoy(spark, sf_dir):
    stats, _, cube = series_inputs(spark, sf_dir)
    return finish(series.ytd_yoy(cube, stats, KEYS))


@query("cumulative")
def q_cumulative(spark, sf_dir):
    return finish(series.cumulative(_cube(spark, sf_dir)[2], KEYS))


@query("rolling_3m")
def q_rolling_3m(spark, sf_dir):
    return finish(series.rolling(series.monthly_total(_dated_cube(spark, sf_dir), KEYS), KEYS, 3))


@query("rolling_12m")
def q_rolling_12m(spark, sf_dir):
    return finish(series.rolling(series.monthly_total(_dated_cube(spark, sf_dir), KEYS), KEYS, 12))


# ----------------------------------------------------------------- drill ---
DRILL_PARTNERS = ["NATION_1", "NATION_2", "NATION_3", "NATION_5", "NATION_8", "NATION_13", "NATION_21"]
DRILL_YEARS = [1997, 1998, 1999]
CHOSEN_REPORTERS = ["NATION_12", "NATION_17", "NATION_0"]
DRILL_MONTHS = [1, 2, 3, 4, 5, 6]
DRILL_TAGS = ["Nitrogenous (N)", "Phosphatic (P)", "Other Fertilizer"]
RANK_YEAR = 1999


def _drill(spark, sf_dir, **kw):
    """(rows on the chosen basis, full-year rows, stats), by default all years and months.

    Cutoff and active years come from the written reporter cube (calendar
    year and month recovered from the crop calendar), so the rows are
    scanned once."""
    return drill.drill_rows(prepared(spark, sf_dir), KEYS, START, stats_source=_dated_reporter_cube(spark, sf_dir),
                            **kw)


def _drill_cube(spark, sf_dir):
    """All selected rows reduced to the drill cube and written once; ranges and
    bases are filters on this cube."""
    return reuse(("drill", trade_path(spark, sf_dir), tuple(KEYS), START),
                 lambda: materialize(drill.drill_cube(prepared(spark, sf_dir), KEYS), "drill"))


def _drill_stats(spark, sf_dir, years_back=None):
    return drill.drill_stats(_dated_reporter_cube(spark, sf_dir), KEYS, START, years_back)


@query("filter_trade")
def q_filter_trade(spark, sf_dir):
    df = filter_trade(trade(spark, sf_dir), regions=["Asia", "Europe", "NAM", "LATAM"],
                      tags=["Nitrogenous (N)", "Potassic (K)", "Mixed / NPK"])
    return finish(df.select(*RAW_COLUMNS, REGION, COMMODITY_TAG))


@query("drill_filter")
def q_drill_filter(spark, sf_dir):
    dff, _, _ = _drill(spark, sf_dir, partners=DRILL_PARTNERS, crop_years=DRILL_YEARS,
                       crop_months=DRILL_MONTHS, tags=DRILL_TAGS)
    return finish(dff.select(*RAW_COLUMNS, CY, CM, COMMODITY_TAG))


@query("drill_months")
def q_drill_months(spark, sf_dir):
    dff, _, _ = _drill(spark, sf_dir, crop_months=[1, 2, 3])
    return finish(dff.select(*RAW_COLUMNS, CY, CM))


@query("filter_domains")
def q_filter_domains(spark, sf_dir):
    return finish(filters.filter_domains(trade(spark, sf_dir), KEYS, reporter_region="Asia",
                                         partner_region="Europe"))


@query("filter_domains_overview")
def q_filter_domains_overview(spark, sf_dir):
    return finish(filters.filter_domains(trade(spark, sf_dir), KEYS, reporter_region="Asia", overview=True))


@query("filter_domains_reporters")
def q_filter_domains_reporters(spark, sf_dir):
    """Lists that follow two chosen reporters (one more lies outside the region)."""
    return finish(filters.filter_domains(trade(spark, sf_dir), KEYS, reporter_region="Asia", partner_region="Europe",
                                         reporters=CHOSEN_REPORTERS))


@query("seasonal_range")
def q_seasonal_range(spark, sf_dir):
    return finish(filters.seasonal_range(_cube(spark, sf_dir)[2], 1997, 1999))


@query("drill_year_region")
def q_drill_year_region(spark, sf_dir):
    return finish(drill.year_region(_drill_cube(spark, sf_dir), KEYS))


@query("drill_year_range")
def q_drill_year_range(spark, sf_dir):
    """The range as the feature: region volumes of the last six crop years."""
    cube = drill.on_basis(_drill_cube(spark, sf_dir), _drill_stats(spark, sf_dir, 6), KEYS)
    return finish(drill.year_region(cube, KEYS))


@query("drill_ytd_basis")
def q_drill_ytd_basis(spark, sf_dir):
    """The basis as the feature: region volumes up to the common crop month."""
    cube = drill.on_basis(_drill_cube(spark, sf_dir), _drill_stats(spark, sf_dir), KEYS, ytd=True)
    return finish(drill.year_region(cube, KEYS))


@query("share_by_year")
def q_share_by_year(spark, sf_dir):
    yr = drill.year_region(_drill_cube(spark, sf_dir), KEYS)
    return finish(yr.select(*KEYS, REGION, "REGION_RANK", CY, CY_LABEL, "SHARE_PCT"))


@query("drill_month_region")
def q_drill_month_region(spark, sf_dir):
    return finish(drill.month_region(_drill_cube(spark, sf_dir), KEYS).drop("SHARE_PCT"))


@query("share_by_month")
def q_share_by_month(spark, sf_dir):
    return finish(drill.month_region(_drill_cube(spark, sf_dir), KEYS))


@query("drill_month_partner")
def q_drill_month_partner(spark, sf_dir):
    return finish(drill.month_partner(_drill_cube(spark, sf_dir), KEYS, by_region=True))


@query("drill_month_partner_all")
def q_drill_month_partner_all(spark, sf_dir):
    """The same over all regions."""
    return finish(drill.month_partner(_drill_cube(spark, sf_dir), KEYS))


@query("drill_year_partner")
def q_drill_year_partner(spark, sf_dir):
    return finish(drill.year_partner(_drill_cube(spark, sf_dir), KEYS))


@query("drill_top_in_year")
def q_drill_top_in_year(spark, sf_dir):
    return finish(drill.top_in_year(_drill_cube(spark, sf_dir), KEYS, RANK_YEAR))


@query("top_partners")
def q_top_partners(spark, sf_dir):
    return finish(drill.top_partners(_drill_cube(spark, sf_dir), KEYS, 12))


@query("partner_share_in_region")
def q_partner_share_in_region(spark, sf_dir):
    return finish(drill.partner_share_in_region(_drill_cube(spark, sf_dir), KEYS, 10))


@query("top15_with_rest")
def q_top15_with_rest(spark, sf_dir):
    return finish(drill.top15_with_rest(_drill_cube(spark, sf_dir), KEYS, 15))


@query("monthly_breakdown")
def q_monthly_breakdown(spark, sf_dir):
    return finish(drill.monthly_breakdown(_drill_cube(spark, sf_dir), KEYS, 15))


@query("rolling_by_region")
def q_rolling_by_region(spark, sf_dir):
    return finish(series.rolling_by_region(with_crop_date(_drill_cube(spark, sf_dir), START), KEYS, 12))


# ------------------------------------------------------------ projection ---
MANUAL_MONTH_VALUE = 1000.0


def _proj_inputs(spark, sf_dir):
    stats, _, cube = _cube(spark, sf_dir)
    return cube, stats


def _proj_base(spark, sf_dir):
    cube, stats = _proj_inputs(spark, sf_dir)
    return reuse(("projbase", trade_path(spark, sf_dir)), lambda: pin(projection.projection_base(cube, stats, KEYS)))


@query("avg_proportions")
def q_avg_proportions(spark, sf_dir):
    cube, _ = _proj_inputs(spark, sf_dir)
    return finish(projection.avg_proportions(cube, KEYS))


@query("projection_ytd")
def q_projection_ytd(spark, sf_dir):
    cube, stats = _proj_inputs(spark, sf_dir)
    return finish(projection.projection_ytd(cube, stats, KEYS, base=_proj_base(spark, sf_dir)))


@query("projection_proportions")
def q_projection_proportions(spark, sf_dir):
    cube, stats = _proj_inputs(spark, sf_dir)
    return finish(projection.projection_proportions(cube, stats, KEYS, base=_proj_base(spark, sf_dir)))


@query("projection_manual_month")
def q_projection_manual_month(spark, sf_dir):
    _, stats = _proj_inputs(spark, sf_dir)
    return finish(projection.projection_manual_month(stats, KEYS, MANUAL_MONTH_VALUE))


@query("projection_manual_year")
def q_projection_manual_year(spark, sf_dir):
    cube, stats = _proj_inputs(spark, sf_dir)
    return finish(projection.projection_manual_year(cube, stats, KEYS, base=_proj_base(spark, sf_dir)))


@query("projection_series")
def q_projection_series(spark, sf_dir):
    cube, stats = _proj_inputs(spark, sf_dir)
    base = _proj_base(spark, sf_dir)
    proj = projection.projection_ytd(cube, stats, KEYS, base=base)
    return finish(projection.projection_series(cube, stats, proj, KEYS, base=base))


@query("projection_cumulative")
def q_projection_cumulative(spark, sf_dir):
    cube, stats = _proj_inputs(spark, sf_dir)
    base = _proj_base(spark, sf_dir)
    proj = projection.projection_ytd(cube, stats, KEYS, base=base)
    return finish(projection.projection_cumulative(cube, stats, proj, KEYS, base=base))


@query("projection_totals")
def q_projection_totals(spark, sf_dir):
    """Totals of the methods per flow and reporter, remaining months or not."""
    cube, stats, keys = _by_reporter(spark, sf_dir)
    return finish(projection.projection_totals(cube, stats, keys))


def _by_reporter(spark, sf_dir):
    """(trimmed cube, stats, keys) with every reporter as a series of its own."""
    keys = [FLOW, REPORTER]
    rep = reporter_cube(spark, sf_dir)
    stats = reuse(("repstats", trade_path(spark, sf_dir)), lambda: materialize(period_stats(rep, keys), "repstats"))
    return display_trim(rep, keys, stats=stats), stats, keys


@query("seasonal_chart")
def q_seasonal_chart(spark, sf_dir):
    """Actual, band and projected months of all shown crop years."""
    cube, stats = _proj_inputs(spark, sf_dir)
    base = _proj_base(spark, sf_dir)
    proj = projection.projection_ytd(cube, stats, KEYS, base=base)
    return finish(charts.seasonal_chart(cube, stats, proj, KEYS, base=base))


@query("latest_chart")
def q_latest_chart(spark, sf_dir):
    """Band, latest crop year and its projection."""
    cube, stats = _proj_inputs(spark, sf_dir)
    base = _proj_base(spark, sf_dir)
    proj = projection.projection_ytd(cube, stats, KEYS, base=base)
    return finish(charts.latest_chart(cube, stats, proj, KEYS, base=base))


# ---------------------------------------------------------------- mirror ---
MIRROR_LAG = 1


def _mirror_input(spark, sf_dir):
    """The selected rows reduced to the pair-month mirror cube, written once."""
    cube = reuse(("mirror", trade_path(spark, sf_dir)),
                 lambda: materialize(mirror.mirror_cube(with_unit(filter_trade(trade(spark, sf_dir)), "MT")),
                                     "mirror"))
    return cube, test_dims(spark, sf_dir)


@query("mirror_pairs")
def q_mirror_pairs(spark, sf_dir):
    df, dims = _mirror_input(spark, sf_dir)
    return finish(mirror.mirror_pairs(df, dims))


@query("mirror_years")
def q_mirror_years(spark, sf_dir):
    df, _ = _mirror_input(spark, sf_dir)
    return finish(mirror.mirror_years(df, _mirror_pairs(spark, sf_dir), START))


def _mirror_pairs(spark, sf_dir):
    """The matched pairs, written once (years and overlay both need them)."""
    df, dims = _mirror_input(spark, sf_dir)
    return reuse(("pairs", trade_path(spark, sf_dir)), lambda: materialize(mirror.mirror_pairs(df, dims), "pairs"))


@query("mirror_overlay")
def q_mirror_overlay(spark, sf_dir):
    """All crop years of every pair."""
    df, _ = _mirror_input(spark, sf_dir)
    return finish(mirror.mirror_overlay(df, _mirror_pairs(spark, sf_dir), START, MIRROR_LAG))


@query("mirror_overlay_range")
def q_mirror_overlay_range(spark, sf_dir):
    """The range as the feature: the last two crop years of every pair."""
    df, _ = _mirror_input(spark, sf_dir)
    return finish(mirror.mirror_overlay(df, _mirror_pairs(spark, sf_dir), START, MIRROR_LAG, years_back=2))


# ------------------------------------------------------------------ load ---
SLICE_REPORTERS = ["NATION_0", "NATION_3", "NATION_7", "NATION_12", "NATION_18", "NATION_24"]
SLICE_FROM, SLICE_TO = 199701, 200012
UPSERT_YEAR = 2000
OLD_FILE_TIME = 1_000_000_000_000        # 2001, in milliseconds


def _stored_and_new(spark, sf_dir):
    """Stored rows (YEAR <= 2000) and a new batch (YEAR >= 2000, 2000 revised x2)."""
    raw = raw_trade(spark, sf_dir)
    stored = raw.where(F.col(YEAR) <= UPSERT_YEAR)
    new = raw.where(F.col(YEAR) >= UPSERT_YEAR).withColumn(
        QTY1, F.when(F.col(YEAR) == UPSERT_YEAR, F.col(QTY1) * 2).otherwise(F.col(QTY1)))
    return stored, new


@query("read_extract")
def q_read_extract(spark, sf_dir):
    raw = raw_trade(spark, sf_dir)
    root = scratch_path(spark, "landing")
    parts = []
    for flow in ("E", "I"):
        extract.write_extract(raw.where(F.col(FLOW) == flow), f"{root}/{flow}")
        parts.append(extract.read_extract(spark, f"{root}/{flow}", flow))
    return finish(parts[0].unionByName(parts[1]))


@query("read_extract_encodings")
def q_read_extract_encodings(spark, sf_dir):
    raw = raw_trade(spark, sf_dir)
    root = scratch_path(spark, "landing")
    extract.write_extract(raw.where(F.col(FLOW) == "E"), f"{root}/E/utf16", encoding="UTF-16")
    imp = raw.where(F.col(FLOW) == "I")
    extract.write_extract(imp.where(F.col(YEAR) <= 1998), f"{root}/I/latin1", encoding="ISO-8859-1")
    extract.write_extract(imp.where(F.col(YEAR) > 1998), f"{root}/I/utf8bom", encoding="UTF-8", bom=True)
    e = extract.read_extracts(spark, f"{root}/E/*", "E")
    i = extract.read_extracts(spark, f"{root}/I/*", "I")
    return finish(e.unionByName(i))


@query("read_extract_cotton")
def q_read_extract_cotton(spark, sf_dir):
    """Extracts without a value column, two column orders in one folder."""
    raw = raw_trade(spark, sf_dir)
    root = scratch_path(spark, "landing")
    for flow in ("E", "I"):
        rows = raw.where(F.col(FLOW) == flow)
        extract.write_extract(rows.where(F.col(YEAR) <= 1998), f"{root}/{flow}/a", columns=COTTON_COLUMNS)
        extract.write_extract(rows.where(F.col(YEAR) > 1998), f"{root}/{flow}/b", columns=COTTON_COLUMNS[::-1])
    parts = [extract.read_extracts(spark, f"{root}/{flow}/*", flow, columns=COTTON_COLUMNS) for flow in ("E", "I")]
    return finish(parts[0].unionByName(parts[1]))


@query("extract_slice")
def q_extract_slice(spark, sf_dir):
    ym = F.col(YEAR) * 100 + F.col(MONTH)
    df = trade(spark, sf_dir).where((F.col(FLOW) == "E") & F.col(REPORTER).isin(SLICE_REPORTERS)
                                    & ym.between(SLICE_FROM, SLICE_TO) & F.col(HS4).startswith("31"))
    return finish(df.select(*RAW_COLUMNS, HS4))


@query("load_trade")
def q_load_trade(spark, sf_dir):
    return finish(trade(spark, sf_dir).select(*RAW_COLUMNS, HS4, PARTNER_STD, REGION, REPORTER_REGION,
                                              COMMODITY_TAG))


@query("incremental_begin")
def q_incremental_begin(spark, sf_dir):
    stored, _ = _stored_and_new(spark, sf_dir)
    return finish(load.incremental_begin(stored))


@query("table_freshness")
def q_table_freshness(spark, sf_dir):
    """File times against the write record; files of one import year are set
    back, as when an old file is put back, so the imports are not as written."""
    path = scratch_path(spark, "table")
    upsert_table(raw_trade(spark, sf_dir), path, full=True)
    for name in commits.data_files(spark, f"{path}/{FLOW}=I/{YEAR}={UPSERT_YEAR}"):
        files.set_time(spark, f"{path}/{FLOW}=I/{YEAR}={UPSERT_YEAR}/{name}", OLD_FILE_TIME)
    return finish(table_freshness(spark, path).drop("LAST_MODIFIED"))


@query("upsert_keep_last")
def q_upsert_keep_last(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    return finish(load.upsert_keep_last(stored, new, old_unique=True))


@query("load_audit")
def q_load_audit(spark, sf_dir):
    """The audit of an incremental load, from the record of its commit."""
    stored, new = _stored_and_new(spark, sf_dir)
    path = scratch_path(spark, "table")
    upsert_table(stored, path, full=True)
    upsert_table(new, path)
    return finish(recorded_audit(spark, path))


@query("upsert_roundtrip")
def q_upsert_roundtrip(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    path = scratch_path(spark, "table")
    upsert_table(stored, path, full=True)
    upsert_table(new, path)
    return finish(read_table(spark, path).select(*RAW_COLUMNS))


@query("upsert_new_column")
def q_upsert_new_column(spark, sf_dir):
    """Stored rows without VALUE, new rows with it: nothing stored is lost."""
    stored, new = _stored_and_new(spark, sf_dir)
    path = scratch_path(spark, "table")
    upsert_table(stored.drop(VALUE), path)
    upsert_table(new, path)
    return finish(read_table(spark, path).select(*RAW_COLUMNS))


@query("full_reload_one_flow")
def q_full_reload_one_flow(spark, sf_dir):
    """A full load of the exports up to 1998 removes their later years only."""
    raw = raw_trade(spark, sf_dir)
    path = scratch_path(spark, "table")
    upsert_table(raw, path, full=True)
    upsert_table(raw.where((F.col(FLOW) == "E") & (F.col(YEAR) <= 1998)), path, full=True)
    return finish(read_table(spark, path).select(*RAW_COLUMNS))


@query("cube_after_upsert")
def q_cube_after_upsert(spark, sf_dir):
    """The reporter cube after an incremental load: only the years that the load
    touched are summed again."""
    stored, new = _stored_and_new(spark, sf_dir)
    path, cube = scratch_path(spark, "table"), scratch_path(spark, "cube")
    upsert_table(stored, path, full=True)
    refresh_cube(spark, path, cube, REPORTER_CUBE)
    upsert_table(new, path)
    refresh_cube(spark, path, cube, REPORTER_CUBE)
    rows = with_unit(with_calendar(read_cube(spark, cube), START), UNIT)
    return finish(rows.select(FLOW, REPORTER, CY, CY_LABEL, CM, QTY))


@query("stream_upsert")
def q_stream_upsert(spark, sf_dir):
    stored, new = _stored_and_new(spark, sf_dir)
    path, landing = scratch_path(spark, "table"), scratch_path(spark, "landing")
    upsert_table(stored, path, full=True)
    # A first version of every new row, then the revision in files landed later.
    new.withColumn(QTY1, F.lit(-1.0)).write.mode("append").parquet(landing)
    for lo, hi in ((1, 4), (5, 8), (9, 12)):
        new.where(F.col(MONTH).between(lo, hi)).write.mode("append").parquet(landing)
    stream_upsert(spark, landing, path, scratch_path(spark, "stream-ckpt"), new.schema,
                  max_files_per_trigger=8)
    return finish(read_table(spark, path).select(*RAW_COLUMNS))

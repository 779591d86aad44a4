"""Series keys: every key's result equals the single selection of that key."""

from pyspark.sql import functions as F

from tradelens.operators import projection, series
from tradelens.operators.cutoff import display_trim, period_stats
from tradelens.plans.common import prepared
from tradelens.schema import CM, CY, FLOW, REPORTER

from conftest import SF_SMALL

KEYS = [FLOW, REPORTER]


def _inputs(df, keys):
    stats = period_stats(df, keys)
    cube = series.monthly_cube(display_trim(df, keys, stats=stats), keys)
    return stats, cube


def _rows(df, cols):
    return sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


def test_keyed_equals_single_selection(spark):
    df = prepared(spark, SF_SMALL)
    stats_k, cube_k = _inputs(df, KEYS)
    reporters = [r[0] for r in df.where(F.col(FLOW) == "E").select(REPORTER).distinct().limit(3).collect()]
    assert reporters
    for rep in reporters:
        one = df.where((F.col(FLOW) == "E") & (F.col(REPORTER) == rep))
        stats_1, cube_1 = _inputs(one, [FLOW])
        pick = (F.col(FLOW) == "E") & (F.col(REPORTER) == rep)
        cols = [CY, "YTD_QTY", "YOY_PCT"]
        assert (_rows(series.ytd_yoy(cube_k, stats_k, KEYS).where(pick), cols)
                == _rows(series.ytd_yoy(cube_1, stats_1, [FLOW]), cols))
        cols = [CM, "BAND_MAX", "BAND_MIN", "BAND_AVG", "BAND_N"]
        assert (_rows(series.reference_band(cube_k, KEYS).where(pick), cols)
                == _rows(series.reference_band(cube_1, [FLOW]), cols))
        cols = [CY, CM, "PROJ_QTY"]
        assert (_rows(projection.projection_ytd(cube_k, stats_k, KEYS).where(pick), cols)
                == _rows(projection.projection_ytd(cube_1, stats_1, [FLOW]), cols))

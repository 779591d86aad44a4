"""Column names, the fact-table schema and the constants that define semantics."""

from __future__ import annotations

from pyspark.sql import types as T

# Fact-table columns (one row per FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH).
FLOW = "FLOW"
REPORTER = "REPORTER"
PARTNER = "PARTNER"
COMMODITY = "COMMODITY"
YEAR = "YEAR"
MONTH = "MONTH"
VALUE = "VALUE"
QTY1 = "QTY1"

# Derived at ingest.
HS4 = "HS4"
PARTNER_STD = "PARTNER_STD"
REGION = "REGION"
REPORTER_REGION = "REPORTER_REGION"
COMMODITY_TAG = "COMMODITY_TAG"

# Derived at read.
DATE = "DATE"
CY = "CROP_YEAR_START"       # int, used for every order and comparison
CY_LABEL = "CROP_YEAR"       # "YYYY" or "yy/yy", display only
CM = "CROP_MONTH_NUM"
QTY = "QTY"                  # QTY1 in the chosen unit

# Columns the extract must carry; a missing one fails the read.
EXTRACT_COLUMNS = [REPORTER, PARTNER, COMMODITY, YEAR, MONTH, VALUE, QTY1]

# Cotton extracts carry no value.
COTTON_COLUMNS = [c for c in EXTRACT_COLUMNS if c != VALUE]

# Upsert (keep-last) key of the stored table.
DEDUP_KEYS = [FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH]

EXTRACT_SCHEMA = T.StructType([
    T.StructField(REPORTER, T.StringType()),
    T.StructField(PARTNER, T.StringType()),
    T.StructField(COMMODITY, T.StringType()),
    T.StructField(YEAR, T.IntegerType()),
    T.StructField(MONTH, T.IntegerType()),
    T.StructField(VALUE, T.DoubleType()),
    T.StructField(QTY1, T.DoubleType()),
])

TRADE_SCHEMA = T.StructType([T.StructField(FLOW, T.StringType())] + list(EXTRACT_SCHEMA.fields))

# ---- fixed values (must equal the reference for equal results) -----------
# Unit divisors of QTY1 (metric tonnes).
UNIT_DIVISORS = {"MT": 1.0, "k MT": 1_000.0, "MMT": 1_000_000.0}
# Flow codes: exports, imports.
FLOWS = ["E", "I"]
# Year-basis presets: crop-year start month.
YEAR_BASIS = {"Jan-Dec": 1, "Jul-Jun": 7, "Oct-Sep": 10}
# History start (YYYYMM) per product.
HISTORY_START = {"fertilizer": "201401", "cotton": "201701"}
# Default reference windows.
REFERENCE_YEARS = 10      # band / heatmap reference: last complete years
PROJECTION_YEARS = 5      # projection reference: last complete years
MIRROR_LAG_RANGE = (0, 4)
# Words the extract reader turns into null.
NULL_WORDS = ["", "NA", "N/A", "NaN", "nan", "None", "null", "NULL", "<NA>", "#N/A", "n/a", "-NaN", "-nan"]
# ---------------------------------------------------------------------------

MONTH_ABBR = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def month_order(start_month: int | str) -> list[str]:
    """Month labels in crop order for a crop year starting at ``start_month``."""
    s = check_start_month(start_month)
    return [MONTH_ABBR[(s - 1 + i) % 12] for i in range(12)]


def check_start_month(start_month: int | str) -> int:
    """Crop-year start month: an int 1..12 or a preset name of ``YEAR_BASIS``."""
    if isinstance(start_month, str) and start_month in YEAR_BASIS:
        return YEAR_BASIS[start_month]
    if isinstance(start_month, bool) or not isinstance(start_month, int) or not 1 <= start_month <= 12:
        raise ValueError(f"start_month must be 1..12 or one of {sorted(YEAR_BASIS)}, got {start_month!r}")
    return start_month

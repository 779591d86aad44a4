"""Independent DuckDB SQL for every catalog query (the correctness oracle).

Each string runs on the pre-registered test views (lineitem, orders, ...).
Column names and rounding match ``common.finish``: lower case, doubles
rounded to 6 places (VALUE to 2).
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

RAW = "FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH, QTY1, VALUE"


def _label(s: int) -> str:
    if s == 1:
        return "CAST(CROP_YEAR_START AS VARCHAR)"
    return ("lpad(CAST(CROP_YEAR_START % 100 AS VARCHAR), 2, '0') || '/' || "
            "lpad(CAST((CROP_YEAR_START + 1) % 100 AS VARCHAR), 2, '0')")


def base(start: int = 7) -> str:
    """CTEs: trade (raw rows), enriched, c (calendar + QTY)."""
    return f"""
WITH li AS (
  SELECT sn.n_name AS supp_nation, cn.n_name AS cust_nation,
         '31' || lpad(CAST(l.l_partkey % 6 + 1 AS VARCHAR), 2, '0') AS commodity,
         CAST(year(l.l_shipdate) AS INTEGER) AS y, CAST(month(l.l_shipdate) AS INTEGER) AS m,
         l.l_quantity, l.l_extendedprice, l.l_returnflag
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer cu ON o.o_custkey = cu.c_custkey
  JOIN nation cn ON cu.c_nationkey = cn.n_nationkey
  JOIN supplier su ON l.l_suppkey = su.s_suppkey
  JOIN nation sn ON su.s_nationkey = sn.n_nationkey
),
trade AS (
  SELECT 'E' AS FLOW, supp_nation AS REPORTER, cust_nation AS PARTNER, commodity AS COMMODITY,
         y AS YEAR, m AS MONTH, CAST(sum(l_quantity) AS DOUBLE) AS QTY1,
         CAST(sum(l_extendedprice) AS DOUBLE) AS VALUE
  FROM li GROUP BY supp_nation, cust_nation, commodity, y, m
  UNION ALL
  SELECT 'I', cust_nation, supp_nation, commodity,
         CAST(CASE WHEN m = 12 THEN y + 1 ELSE y END AS INTEGER), CAST(m % 12 + 1 AS INTEGER),
         CAST(sum(l_quantity) AS DOUBLE), CAST(sum(l_extendedprice) AS DOUBLE)
  FROM li WHERE l_returnflag <> 'R' GROUP BY cust_nation, supp_nation, commodity, y, m
),
cont AS (
  SELECT n_name AS NAME,
         CASE WHEN n_name = 'NATION_22' THEN 'Oceania' WHEN r_name = 'AFRICA' THEN 'Africa'
              WHEN r_name = 'ASIA' THEN 'Asia' WHEN r_name = 'EUROPE' THEN 'Europe'
              WHEN r_name = 'AMERICA' THEN 'America' END AS CONTINENT
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
rreg AS (
  SELECT n_name AS NAME,
         CASE WHEN n_name = 'NATION_1' THEN 'NAM' WHEN n_name IN ('NATION_6', 'NATION_11') THEN 'LATAM'
              WHEN n_name = 'NATION_22' THEN 'Oceania' WHEN r_name = 'AFRICA' THEN 'Africa'
              WHEN r_name = 'ASIA' THEN 'Asia' WHEN r_name = 'EUROPE' THEN 'Europe'
              WHEN r_name = 'MIDDLE EAST' THEN 'Middle East' ELSE 'Other' END AS RR
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
t1 AS (
  SELECT trade.*,
         lpad(nullif(regexp_extract(COMMODITY, '([0-9]+)', 1), ''), 4, '0') AS HS4,
         CASE trim(PARTNER) WHEN 'NATION_23' THEN 'Nation Twenty-Three' WHEN 'NATION_24' THEN 'Other'
              ELSE trim(PARTNER) END AS PARTNER_STD
  FROM trade
),
enriched AS (
  SELECT t1.*,
         CASE WHEN PARTNER_STD = 'Other' THEN 'Other' WHEN PARTNER_STD IN ('NATION_1') THEN 'NAM'
              WHEN PARTNER_STD IN ('NATION_6', 'NATION_11') THEN 'LATAM'
              WHEN cont.CONTINENT IN ('Europe', 'Asia', 'Africa', 'Oceania') THEN cont.CONTINENT
              ELSE 'Other' END AS REGION,
         coalesce(rreg.RR, 'Other') AS REPORTER_REGION,
         CASE HS4 WHEN '3101' THEN 'Organic Fertilizers' WHEN '3102' THEN 'Nitrogenous (N)'
                  WHEN '3103' THEN 'Phosphatic (P)' WHEN '3104' THEN 'Potassic (K)'
                  WHEN '3105' THEN 'Mixed / NPK' ELSE 'Other Fertilizer' END AS COMMODITY_TAG
  FROM t1 LEFT JOIN cont ON t1.PARTNER_STD = cont.NAME LEFT JOIN rreg ON t1.REPORTER = rreg.NAME
),
cal AS (
  SELECT *, make_date(YEAR, MONTH, 1) AS DATE,
         CAST(YEAR - CASE WHEN MONTH < {start} THEN 1 ELSE 0 END AS INTEGER) AS CROP_YEAR_START,
         CAST(((MONTH - {start} + 12) % 12) + 1 AS INTEGER) AS CROP_MONTH_NUM,
         QTY1 AS QTY
  FROM enriched
),
c AS (
  SELECT *, {_label(start)} AS CROP_YEAR FROM cal
  WHERE REPORTER IS NOT NULL AND PARTNER IS NOT NULL AND REGION IS NOT NULL AND COMMODITY_TAG IS NOT NULL
)"""


# Overview chain on c, one series per FLOW: stats and trimmed rows (disp).
OVERVIEW = """,
per_rep AS (
  SELECT FLOW, REPORTER, CROP_YEAR_START, max(CROP_MONTH_NUM) AS mx FROM c GROUP BY ALL
),
per_year AS (
  SELECT FLOW, CROP_YEAR_START, min(mx) AS cm_common FROM per_rep GROUP BY ALL
),
yrs AS (
  SELECT *, row_number() OVER (PARTITION BY FLOW ORDER BY CROP_YEAR_START DESC) AS rk FROM per_year
),
stats AS (
  SELECT FLOW, max(CROP_YEAR_START) AS latest_cy_start,
         arg_max(cm_common, CROP_YEAR_START) AS common_month,
         min(CROP_YEAR_START) AS oldest_cy_start, count(*) AS n_cy,
         max(CASE WHEN rk = 2 THEN CROP_YEAR_START END) AS second_cy
  FROM yrs GROUP BY FLOW
),
disp AS (
  SELECT c.* FROM c JOIN stats USING (FLOW)
  WHERE (c.CROP_YEAR_START < stats.latest_cy_start
         OR (c.CROP_YEAR_START = stats.latest_cy_start AND c.CROP_MONTH_NUM <= stats.common_month))
    AND (stats.n_cy <= 1 OR c.CROP_YEAR_START > stats.oldest_cy_start)
),
cube AS (
  SELECT FLOW, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM, sum(QTY) AS QTY FROM disp GROUP BY ALL
),
mat AS (
  SELECT FLOW, CROP_YEAR_START, CROP_YEAR,
         {months}
  FROM cube GROUP BY ALL
),
comp AS (
  SELECT FLOW, CROP_YEAR_START, count(CASE WHEN QTY > 0 THEN 1 END) = 12 AS is_complete,
         sum(QTY) AS annual
  FROM cube GROUP BY ALL
),
ref10 AS (
  SELECT FLOW, CROP_YEAR_START FROM (
    SELECT *, row_number() OVER (PARTITION BY FLOW ORDER BY CROP_YEAR_START DESC) AS yr_rank
    FROM comp WHERE is_complete) WHERE yr_rank <= 10
),
band AS (
  SELECT cube.FLOW, CROP_MONTH_NUM, max(QTY) AS band_max, min(QTY) AS band_min, avg(QTY) AS band_avg,
         count(*) AS band_n
  FROM cube JOIN ref10 USING (FLOW, CROP_YEAR_START) GROUP BY ALL
),
latest AS (
  SELECT cube.FLOW, CROP_MONTH_NUM, CASE WHEN QTY > 0 THEN QTY END AS latest_qty
  FROM cube JOIN stats USING (FLOW)
  WHERE cube.CROP_YEAR_START = stats.latest_cy_start AND cube.CROP_MONTH_NUM <= stats.common_month
)""".replace("{months}", ",\n         ".join(
    f"coalesce(sum(CASE WHEN CROP_MONTH_NUM = {i} THEN QTY END), 0) AS M{i:02d}" for i in range(1, 13)))


def r6(expr: str, alias: str) -> str:
    return f"round({expr}, 6) AS {alias}"


def q(name: str, sql: str) -> None:
    ORACLE[name] = sql.strip() + "\n"


RAW_OUT = ("FLOW AS flow, REPORTER AS reporter, PARTNER AS partner, COMMODITY AS commodity, "
           "YEAR AS year, MONTH AS month, round(QTY1, 6) AS qty1, round(VALUE, 2) AS value")

# ---------------------------------------------------------------- enrich ---
q("derive_hs4", base() + f"\nSELECT {RAW_OUT}, HS4 AS hs4 FROM enriched")
q("clean_partner", base() + f"\nSELECT {RAW_OUT}, PARTNER_STD AS partner_std FROM enriched")
q("partner_region", base() + f"\nSELECT {RAW_OUT}, PARTNER_STD AS partner_std, REGION AS region FROM enriched")
q("reporter_region", base() + f"\nSELECT {RAW_OUT}, REPORTER_REGION AS reporter_region FROM enriched")
q("commodity_tag", base() + f"\nSELECT {RAW_OUT}, HS4 AS hs4, COMMODITY_TAG AS commodity_tag FROM enriched")
q("enrich_trade", base() + f"""
SELECT {RAW_OUT}, HS4 AS hs4, PARTNER_STD AS partner_std, REGION AS region,
       REPORTER_REGION AS reporter_region, COMMODITY_TAG AS commodity_tag FROM enriched""")

# -------------------------------------------------------------- calendar ---
CAL_OUT = (f"{RAW_OUT}, DATE AS date, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year, "
           "CROP_MONTH_NUM AS crop_month_num")
q("crop_calendar", base(1) + f"\nSELECT {CAL_OUT} FROM (SELECT *, {_label(1)} AS CROP_YEAR FROM cal)")
q("crop_calendar_jul", base(7) + f"\nSELECT {CAL_OUT} FROM (SELECT *, {_label(7)} AS CROP_YEAR FROM cal)")
q("crop_calendar_oct", base(10) + f"\nSELECT {CAL_OUT} FROM (SELECT *, {_label(10)} AS CROP_YEAR FROM cal)")
q("mirror_shift", base() + f""",
shifted AS (
  SELECT FLOW, REPORTER, PARTNER, COMMODITY,
         CAST((YEAR * 12 + MONTH - 1 - 1) // 12 AS INTEGER) AS YEAR,
         CAST((YEAR * 12 + MONTH - 1 - 1) % 12 + 1 AS INTEGER) AS MONTH, QTY1, VALUE
  FROM trade WHERE FLOW = 'I'
),
sc AS (
  SELECT *, make_date(YEAR, MONTH, 1) AS DATE,
         CAST(YEAR - CASE WHEN MONTH < 7 THEN 1 ELSE 0 END AS INTEGER) AS CROP_YEAR_START,
         CAST(((MONTH - 7 + 12) % 12) + 1 AS INTEGER) AS CROP_MONTH_NUM
  FROM shifted
)
SELECT {CAL_OUT} FROM (SELECT *, {_label(7)} AS CROP_YEAR FROM sc)""")
q("monthly_total", base() + OVERVIEW + """
SELECT FLOW AS flow, DATE AS date, round(sum(QTY), 6) AS qty FROM disp GROUP BY ALL""")

q("monthly_total_in_order", base() + """
SELECT flow, region, date, qty, row_number() OVER (ORDER BY flow, region, date) AS position
FROM (SELECT FLOW AS flow, REGION AS region, DATE AS date, round(sum(QTY), 6) AS qty FROM c GROUP BY ALL)""")

# ---------------------------------------------------------------- cutoff ---
q("latest_period", base() + OVERVIEW + f"""
SELECT FLOW AS flow, latest_cy_start,
       {_label(7).replace('CROP_YEAR_START', 'latest_cy_start')} AS latest_crop_year,
       common_month, oldest_cy_start, n_cy,
       CASE WHEN n_cy >= 3 THEN second_cy END AS prev_cy_start,
       CASE WHEN n_cy >= 3 THEN {_label(7).replace('CROP_YEAR_START', 'second_cy')} END AS prev_crop_year
FROM stats""")
q("common_cutoff_ym", base() + """,
rep_ym AS (SELECT FLOW, REPORTER, max(YEAR * 100 + MONTH) AS ym FROM c GROUP BY ALL),
cut AS (SELECT FLOW, CAST(min(ym) AS INTEGER) AS common_ym FROM rep_ym GROUP BY FLOW)
SELECT FLOW AS flow, common_ym, CAST(common_ym % 100 AS INTEGER) AS common_cal_month,
       CAST(((common_ym % 100 - 7 + 12) % 12) + 1 AS INTEGER) AS common_crop_month
FROM cut""")
q("display_trim", base() + OVERVIEW + f"""
SELECT {RAW_OUT}, CROP_YEAR_START AS crop_year_start, CROP_MONTH_NUM AS crop_month_num FROM disp""")

# ---------------------------------------------------------------- series ---
MONTHS_OUT = ", ".join(f"round(M{i:02d}, 6) AS m{i:02d}" for i in range(1, 13))
q("seasonal", base() + OVERVIEW + """
SELECT FLOW AS flow, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year,
       CROP_MONTH_NUM AS crop_month_num, round(QTY, 6) AS qty,
       ['Jul', 'Aug', 'Sep', 'Oct', 'Nov', 'Dec', 'Jan', 'Feb', 'Mar', 'Apr', 'May', 'Jun'][CROP_MONTH_NUM]
         AS crop_month
FROM cube""")
q("monthly_matrix", base() + OVERVIEW + f"""
SELECT FLOW AS flow, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year, {MONTHS_OUT} FROM mat""")
q("complete_years", base() + OVERVIEW + """
SELECT cube.FLOW AS flow, cube.CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year,
       CAST(count(CASE WHEN QTY > 0 THEN 1 END) AS INTEGER) AS n_positive_months,
       round(sum(QTY), 6) AS annual_qty, count(CASE WHEN QTY > 0 THEN 1 END) = 12 AS is_complete
FROM cube GROUP BY ALL""")
q("reference_band", base() + OVERVIEW + """
SELECT FLOW AS flow, CROP_MONTH_NUM AS crop_month_num, round(band_max, 6) AS band_max,
       round(band_min, 6) AS band_min, round(band_avg, 6) AS band_avg, band_n FROM band""")
q("latest_vs_band", base() + OVERVIEW + """
SELECT band.FLOW AS flow, band.CROP_MONTH_NUM AS crop_month_num, round(band_max, 6) AS band_max,
       round(band_min, 6) AS band_min, round(band_avg, 6) AS band_avg, band_n,
       round(latest_qty, 6) AS latest_qty
FROM band LEFT JOIN latest USING (FLOW, CROP_MONTH_NUM)""")
VS_AVG = "CASE WHEN band_avg > 0 AND latest_qty IS NOT NULL THEN (latest_qty / band_avg - 1) * 100 END"
q("latest_vs_avg", base() + OVERVIEW + f"""
SELECT band.FLOW AS flow, band.CROP_MONTH_NUM AS crop_month_num, round(band_avg, 6) AS band_avg, band_n,
       round(latest_qty, 6) AS latest_qty, round({VS_AVG}, 6) AS vs_avg_pct
FROM band LEFT JOIN latest USING (FLOW, CROP_MONTH_NUM)""")

_M_NULL = ", ".join(f"round(nullif(M{i:02d}, 0), 6) AS m{i:02d}" for i in range(1, 13))
_M_SUM = " + ".join(f"M{i:02d}" for i in range(1, 13))
_REF_AGG = lambda fn, label, order: f"""
SELECT mat.FLOW AS flow, '{label.lower()}' AS row_type, '{label} (L' || count(*) || 'Y)' AS row_label,
       CAST(NULL AS INTEGER) AS crop_year_start,
       {", ".join(f"round({fn}(M{i:02d}), 6) AS m{i:02d}" for i in range(1, 13))},
       round({fn}({_M_SUM}), 6) AS total, CAST({10 ** 9 + order} AS BIGINT) AS row_order
FROM mat JOIN ref10 USING (FLOW, CROP_YEAR_START) GROUP BY mat.FLOW"""
q("heatmap", base() + OVERVIEW + f""",
vs AS (
  SELECT band.FLOW, band.CROP_MONTH_NUM, band_n, {VS_AVG} AS vs_avg_pct
  FROM band LEFT JOIN latest USING (FLOW, CROP_MONTH_NUM)
)
SELECT mat.FLOW AS flow, 'year' AS row_type, CROP_YEAR AS row_label, mat.CROP_YEAR_START AS crop_year_start,
       {_M_NULL},
       round(CASE WHEN comp.is_complete THEN {_M_SUM} END, 6) AS total,
       CAST(mat.CROP_YEAR_START * 10 AS BIGINT) AS row_order
FROM mat JOIN comp USING (FLOW, CROP_YEAR_START)
UNION ALL {_REF_AGG('min', 'Min', 1)}
UNION ALL {_REF_AGG('max', 'Max', 2)}
UNION ALL {_REF_AGG('avg', 'Avg', 3)}
UNION ALL
SELECT vs.FLOW, 'vs_avg', 'vs Avg (L' || max(band_n) || 'Y)%', CAST(NULL AS INTEGER),
       {", ".join(f"round(max(CASE WHEN vs.CROP_MONTH_NUM = {i} THEN vs_avg_pct END), 6)" for i in range(1, 13))},
       CAST(NULL AS DOUBLE), CAST(stats.latest_cy_start * 10 + 5 AS BIGINT)
FROM vs JOIN stats USING (FLOW) GROUP BY vs.FLOW, stats.latest_cy_start""")
q("ytd_yoy", base() + OVERVIEW + """,
ytd AS (
  SELECT disp.FLOW, CROP_YEAR_START, CROP_YEAR, sum(QTY) AS ytd_qty
  FROM disp JOIN stats USING (FLOW) WHERE CROP_MONTH_NUM <= stats.common_month GROUP BY ALL
)
SELECT FLOW AS flow, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year,
       round(ytd_qty, 6) AS ytd_qty,
       round((ytd_qty / nullif(lag(ytd_qty) OVER (PARTITION BY FLOW ORDER BY CROP_YEAR_START), 0) - 1) * 100, 6)
         AS yoy_pct
FROM ytd""")
q("cumulative", base() + OVERVIEW + """
SELECT FLOW AS flow, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year,
       CROP_MONTH_NUM AS crop_month_num, round(QTY, 6) AS qty,
       round(sum(QTY) OVER (PARTITION BY FLOW, CROP_YEAR_START ORDER BY CROP_MONTH_NUM
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS cum_qty
FROM cube""")
for _w in (3, 12):
    q(f"rolling_{_w}m", base() + OVERVIEW + f""",
mt AS (SELECT FLOW, DATE, sum(QTY) AS QTY FROM disp GROUP BY ALL)
SELECT FLOW AS flow, DATE AS date, round(QTY, 6) AS qty,
       round(CASE WHEN count(QTY) OVER w = {_w} THEN sum(QTY) OVER w END, 6) AS rolling
FROM mt
WINDOW w AS (PARTITION BY FLOW ORDER BY DATE ROWS BETWEEN {_w - 1} PRECEDING AND CURRENT ROW)""")

# ----------------------------------------------------------------- drill ---
DRILL_STATS = """,
rep_ym AS (SELECT FLOW, REPORTER, max(YEAR * 100 + MONTH) AS ym FROM c GROUP BY ALL),
dcut AS (
  SELECT FLOW, min(ym) AS common_ym, ((min(ym) % 100 - 7 + 12) % 12) + 1 AS ccm FROM rep_ym GROUP BY FLOW
),
dyrs AS (
  SELECT FLOW, CROP_YEAR_START,
         row_number() OVER (PARTITION BY FLOW ORDER BY CROP_YEAR_START DESC) AS yr
  FROM (SELECT DISTINCT FLOW, CROP_YEAR_START FROM c)
)"""
DRILL = """,
droll AS (SELECT * FROM c),
dff AS (SELECT * FROM c),
dsel AS (SELECT FLOW, max(CROP_YEAR_START) AS sel_cy FROM dff GROUP BY FLOW),
dfy AS (SELECT dff.* FROM dff JOIN dsel USING (FLOW) WHERE dff.CROP_YEAR_START = dsel.sel_cy)"""
DRILL_RANGE = DRILL_STATS + """,
dff AS (SELECT c.* FROM c JOIN dyrs USING (FLOW, CROP_YEAR_START) WHERE yr <= 6)"""
DRILL_YTD = DRILL_STATS + """,
dff AS (SELECT c.* FROM c JOIN dcut USING (FLOW) WHERE CROP_MONTH_NUM <= ccm)"""

CYO = "CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year"


def _in(col: str, values) -> str:
    return f"{col} IN (" + ", ".join(repr(v) if isinstance(v, str) else str(v) for v in values) + ")"


q("filter_trade", base() + f"""
SELECT {RAW_OUT}, REGION AS region, COMMODITY_TAG AS commodity_tag FROM enriched
WHERE REPORTER IS NOT NULL AND PARTNER IS NOT NULL
  AND {_in('REGION', ['Asia', 'Europe', 'NAM', 'LATAM'])}
  AND {_in('COMMODITY_TAG', ['Nitrogenous (N)', 'Potassic (K)', 'Mixed / NPK'])}""")
q("drill_filter", base() + f"""
SELECT {RAW_OUT}, CROP_YEAR_START AS crop_year_start, CROP_MONTH_NUM AS crop_month_num,
       COMMODITY_TAG AS commodity_tag
FROM c
WHERE {_in('PARTNER', ['NATION_1', 'NATION_2', 'NATION_3', 'NATION_5', 'NATION_8', 'NATION_13', 'NATION_21'])}
  AND {_in('CROP_YEAR_START', [1997, 1998, 1999])} AND {_in('CROP_MONTH_NUM', [1, 2, 3, 4, 5, 6])}
  AND {_in('COMMODITY_TAG', ['Nitrogenous (N)', 'Phosphatic (P)', 'Other Fertilizer'])}""")
q("drill_months", base() + DRILL + f"""
SELECT {RAW_OUT}, CROP_YEAR_START AS crop_year_start, CROP_MONTH_NUM AS crop_month_num
FROM droll WHERE CROP_MONTH_NUM IN (1, 2, 3)""")
def _domains(reporters: str, partners: str, rows: str = "enriched") -> str:
    """Choice lists with the place of each value in sorted order."""
    return f"""
SELECT flow, domain, value, CAST(row_number() OVER (PARTITION BY flow, domain ORDER BY value) AS INTEGER) AS position FROM (
SELECT DISTINCT FLOW AS flow, 'reporter_region' AS domain, REPORTER_REGION AS value
FROM enriched WHERE REPORTER_REGION IS NOT NULL
UNION SELECT FLOW, 'reporter', REPORTER FROM enriched WHERE REPORTER_REGION = 'Asia' AND REPORTER IS NOT NULL
UNION SELECT FLOW, 'region', REGION FROM enriched WHERE {reporters} AND REGION IS NOT NULL
UNION SELECT FLOW, 'partner', PARTNER FROM enriched WHERE {reporters} AND {partners} AND PARTNER IS NOT NULL
UNION SELECT FLOW, 'tag', COMMODITY_TAG FROM enriched WHERE {reporters} AND COMMODITY_TAG IS NOT NULL)"""


q("filter_domains", base() + _domains("REPORTER_REGION = 'Asia'", "REGION = 'Europe'"))
q("filter_domains_overview", base() + _domains("true", "true"))
q("filter_domains_reporters", base() + _domains(
    "REPORTER_REGION = 'Asia' AND REPORTER IN ('NATION_12', 'NATION_17')", "REGION = 'Europe'"))
q("seasonal_range", base() + OVERVIEW + f"""
SELECT FLOW AS flow, {CYO}, CROP_MONTH_NUM AS crop_month_num, round(QTY, 6) AS qty
FROM cube WHERE CROP_YEAR_START BETWEEN 1997 AND 1999""")

_YR_BODY = """,
yr0 AS (SELECT FLOW, CROP_YEAR_START, CROP_YEAR, REGION, sum(QTY) AS QTY FROM dff GROUP BY ALL),
yr AS (
  SELECT FLOW, CROP_YEAR_START, CROP_YEAR, REGION, coalesce(yr0.QTY, 0) AS QTY
  FROM (SELECT DISTINCT FLOW, CROP_YEAR_START, CROP_YEAR FROM yr0) a
  JOIN (SELECT DISTINCT FLOW, REGION FROM yr0) b USING (FLOW)
  LEFT JOIN yr0 USING (FLOW, CROP_YEAR_START, CROP_YEAR, REGION)
),
yr2 AS (
  SELECT *, QTY / nullif(sum(QTY) OVER (PARTITION BY FLOW, CROP_YEAR_START), 0) * 100 AS share_pct,
         sum(QTY) OVER (PARTITION BY FLOW, REGION) AS region_total
  FROM yr
),
yr3 AS (
  SELECT *, CAST(dense_rank() OVER (PARTITION BY FLOW ORDER BY region_total DESC, REGION) AS INTEGER)
              AS region_rank
  FROM yr2
)"""
_YR = DRILL + _YR_BODY
for _name, _rows in (("drill_year_region", DRILL), ("drill_year_range", DRILL_RANGE), ("drill_ytd_basis", DRILL_YTD)):
    q(_name, base() + _rows + _YR_BODY + f"""
SELECT FLOW AS flow, {CYO}, REGION AS region, round(QTY, 6) AS qty, round(share_pct, 6) AS share_pct,
       round(region_total, 6) AS region_total, region_rank FROM yr3""")
q("share_by_year", base() + _YR + f"""
SELECT FLOW AS flow, REGION AS region, region_rank, {CYO}, round(share_pct, 6) AS share_pct FROM yr3""")

_MR = DRILL + """,
mr AS (SELECT FLOW, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM, REGION, sum(QTY) AS QTY FROM dfy GROUP BY ALL)"""
q("drill_month_region", base() + _MR + f"""
SELECT FLOW AS flow, {CYO}, CROP_MONTH_NUM AS crop_month_num, REGION AS region, round(QTY, 6) AS qty FROM mr""")
q("share_by_month", base() + _MR + f"""
SELECT FLOW AS flow, {CYO}, CROP_MONTH_NUM AS crop_month_num, REGION AS region, round(QTY, 6) AS qty,
       round(QTY / nullif(sum(QTY) OVER (PARTITION BY FLOW, CROP_MONTH_NUM), 0) * 100, 6) AS share_pct
FROM mr""")
for _name, _k in (("drill_month_partner", "FLOW, REGION"), ("drill_month_partner_all", "FLOW")):
    _r = "REGION AS region, " if "REGION" in _k else ""
    q(_name, base() + DRILL + f""",
mp0 AS (SELECT {_k}, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM, PARTNER, sum(QTY) AS QTY FROM dfy GROUP BY ALL),
mpt AS (
  SELECT {_k}, PARTNER, CROP_YEAR_START, CROP_YEAR,
         CAST(row_number() OVER (PARTITION BY {_k} ORDER BY sum(QTY) DESC, PARTNER) AS INTEGER) AS partner_rank
  FROM mp0 GROUP BY {_k}, PARTNER, CROP_YEAR_START, CROP_YEAR
),
mp2 AS (
  SELECT {_k}, PARTNER, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM, partner_rank, coalesce(QTY, 0) AS QTY
  FROM (SELECT mpt.*, CAST(m AS INTEGER) AS CROP_MONTH_NUM FROM mpt, range(1, 13) t(m) WHERE partner_rank <= 12)
  LEFT JOIN mp0 USING ({_k}, PARTNER, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM)
),
mp3 AS (SELECT *, sum(QTY) OVER (PARTITION BY {_k}, CROP_MONTH_NUM) AS mt FROM mp2)
SELECT FLOW AS flow, {_r}{CYO}, CROP_MONTH_NUM AS crop_month_num, PARTNER AS partner,
       round(QTY, 6) AS qty, partner_rank,
       round(QTY / CASE WHEN mt = 0 THEN 1 ELSE mt END * 100, 6) AS share_pct
FROM mp3""")
q("drill_year_partner", base() + DRILL + f""",
py AS (SELECT FLOW, PARTNER, CROP_YEAR_START, CROP_YEAR, sum(QTY) AS QTY FROM dff GROUP BY ALL),
pr AS (
  SELECT FLOW, PARTNER,
         CAST(row_number() OVER (PARTITION BY FLOW ORDER BY sum(QTY) DESC, PARTNER) AS INTEGER) AS partner_rank
  FROM py GROUP BY FLOW, PARTNER
),
p2 AS (
  SELECT FLOW, PARTNER, partner_rank, CROP_YEAR_START, CROP_YEAR, coalesce(py.QTY, 0) AS QTY
  FROM pr JOIN (SELECT DISTINCT FLOW, CROP_YEAR_START, CROP_YEAR FROM py) y USING (FLOW)
  LEFT JOIN py USING (FLOW, PARTNER, CROP_YEAR_START, CROP_YEAR) WHERE partner_rank <= 12
)
SELECT FLOW AS flow, PARTNER AS partner, {CYO}, round(QTY, 6) AS qty, partner_rank,
       round(QTY / nullif(sum(QTY) OVER (PARTITION BY FLOW, CROP_YEAR_START), 0) * 100, 6) AS share_pct
FROM p2""")
q("drill_top_in_year", base() + DRILL + f""",
py AS (SELECT FLOW, REGION, PARTNER, CROP_YEAR_START, CROP_YEAR, sum(QTY) AS QTY FROM dff GROUP BY ALL),
ry AS (
  SELECT FLOW, REGION,
         CASE WHEN max(CASE WHEN CROP_YEAR_START = 1999 THEN 1 END) = 1 THEN 1999
              ELSE max(CROP_YEAR_START) END AS rank_cy
  FROM py GROUP BY FLOW, REGION
),
rk AS (
  SELECT py.FLOW, py.REGION, py.PARTNER, ry.rank_cy,
         CAST(row_number() OVER (PARTITION BY py.FLOW, py.REGION ORDER BY py.QTY DESC, py.PARTNER) AS INTEGER)
           AS partner_rank
  FROM py JOIN ry ON py.FLOW = ry.FLOW AND py.REGION = ry.REGION AND py.CROP_YEAR_START = ry.rank_cy
),
tops AS (
  SELECT FLOW, REGION, PARTNER, rank_cy, partner_rank,
         CAST(row_number() OVER (PARTITION BY FLOW, REGION ORDER BY sum(py.QTY) DESC, PARTNER) AS INTEGER)
           AS total_rank
  FROM rk JOIN py USING (FLOW, REGION, PARTNER) WHERE partner_rank <= 12
  GROUP BY FLOW, REGION, PARTNER, rank_cy, partner_rank
),
sel AS (
  SELECT FLOW, REGION, PARTNER, rank_cy, partner_rank, total_rank, CROP_YEAR_START, CROP_YEAR,
         coalesce(py.QTY, 0) AS QTY
  FROM tops JOIN (SELECT DISTINCT FLOW, CROP_YEAR_START, CROP_YEAR FROM dff) y USING (FLOW)
  LEFT JOIN py USING (FLOW, REGION, PARTNER, CROP_YEAR_START, CROP_YEAR)
)
SELECT FLOW AS flow, REGION AS region, PARTNER AS partner, {CYO}, round(QTY, 6) AS qty,
       CAST(rank_cy AS INTEGER) AS rank_cy, partner_rank, total_rank,
       round(QTY / nullif(sum(QTY) OVER (PARTITION BY FLOW, REGION, CROP_YEAR_START), 0) * 100, 6) AS share_pct
FROM sel""")
q("top_partners", base() + DRILL + f""",
pt AS (
  SELECT FLOW, PARTNER, CAST(row_number() OVER (PARTITION BY FLOW ORDER BY sum(QTY) DESC, PARTNER) AS INTEGER) AS rank
  FROM dff GROUP BY FLOW, PARTNER
)
SELECT FLOW AS flow, PARTNER AS partner, rank, {CYO}, round(sum(QTY), 6) AS qty
FROM dff JOIN pt USING (FLOW, PARTNER) WHERE rank <= 12 GROUP BY ALL""")
q("partner_share_in_region", base() + DRILL + f""",
py AS (SELECT FLOW, REGION, PARTNER, CROP_YEAR_START, CROP_YEAR, sum(QTY) AS QTY FROM dff GROUP BY ALL),
pr AS (
  SELECT FLOW, REGION, PARTNER,
         CAST(row_number() OVER (PARTITION BY FLOW, REGION ORDER BY sum(QTY) DESC, PARTNER) AS INTEGER)
           AS partner_rank
  FROM py GROUP BY FLOW, REGION, PARTNER
),
top AS (SELECT * FROM pr WHERE partner_rank <= 10),
years AS (
  SELECT DISTINCT FLOW, REGION, CROP_YEAR_START, CROP_YEAR FROM py JOIN top USING (FLOW, REGION, PARTNER)
),
p2 AS (
  SELECT FLOW, REGION, PARTNER, partner_rank, CROP_YEAR_START, CROP_YEAR, coalesce(py.QTY, 0) AS QTY
  FROM top JOIN years USING (FLOW, REGION)
  LEFT JOIN py USING (FLOW, REGION, PARTNER, CROP_YEAR_START, CROP_YEAR)
)
SELECT FLOW AS flow, REGION AS region, PARTNER AS partner, {CYO}, round(QTY, 6) AS qty, partner_rank,
       round(QTY / nullif(sum(QTY) OVER (PARTITION BY FLOW, REGION, CROP_YEAR_START), 0) * 100, 6) AS share_pct
FROM p2""")


def _with_rest(src: str, period: str, period_out: str, n: int) -> str:
    return f""",
py AS (SELECT FLOW, PARTNER, {period}, sum(QTY) AS QTY FROM {src} GROUP BY ALL),
pr AS (
  SELECT FLOW, PARTNER,
         CAST(row_number() OVER (PARTITION BY FLOW ORDER BY sum(QTY) DESC, PARTNER) AS INTEGER) AS rnk
  FROM py GROUP BY FLOW, PARTNER
),
pj AS (SELECT py.*, rnk FROM py JOIN pr USING (FLOW, PARTNER)),
per AS (SELECT DISTINCT FLOW, {period} FROM py),
cell AS (
  SELECT FLOW, PARTNER, rnk, {period}, coalesce(py.QTY, 0) AS QTY
  FROM pr JOIN per USING (FLOW) LEFT JOIN py USING (FLOW, PARTNER, {period}) WHERE rnk <= {n}
)
SELECT FLOW AS flow, 'partner' AS row_type, PARTNER AS row_label, rnk AS rank, {period_out},
       round(QTY, 6) AS qty
FROM cell
UNION ALL
SELECT FLOW, 'rest', 'Rest of World', {n + 1}, {period},
       round(coalesce(sum(CASE WHEN rnk > {n} THEN QTY END), 0), 6) FROM pj
GROUP BY FLOW, {period}
UNION ALL
SELECT FLOW, 'total', 'Total', {n + 2}, {period}, round(sum(QTY), 6) FROM py GROUP BY FLOW, {period}"""


q("top15_with_rest", base() + DRILL + _with_rest(
    "dff", "CROP_YEAR_START, CROP_YEAR", CYO, 15))
q("monthly_breakdown", base() + DRILL + _with_rest(
    "dfy", "CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM", CYO + ", CROP_MONTH_NUM AS crop_month_num", 15))
q("rolling_by_region", base() + DRILL + """,
rm AS (SELECT FLOW, REGION, DATE, sum(QTY) AS QTY FROM droll GROUP BY ALL)
SELECT FLOW AS flow, REGION AS region, DATE AS date, round(QTY, 6) AS qty,
       round(CASE WHEN count(QTY) OVER w = 12 THEN sum(QTY) OVER w END, 6) AS rolling
FROM rm
WINDOW w AS (PARTITION BY FLOW, REGION ORDER BY DATE ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)""")

# ------------------------------------------------------------ projection ---
PROJ = """,
st AS (
  SELECT FLOW, latest_cy_start, common_month, CASE WHEN n_cy >= 3 THEN second_cy END AS prev_cy FROM stats
),
rem AS (
  SELECT FLOW, latest_cy_start, common_month, prev_cy, CAST(unnest(range(common_month + 1, 13)) AS INTEGER) AS cm
  FROM st WHERE common_month < 12
),
sums AS (
  SELECT cube.FLOW,
    coalesce(sum(CASE WHEN CROP_YEAR_START = latest_cy_start AND CROP_MONTH_NUM <= common_month
                      THEN QTY END), 0) AS cy_ytd,
    coalesce(sum(CASE WHEN CROP_YEAR_START = prev_cy AND CROP_MONTH_NUM <= common_month THEN QTY END), 0)
      AS prev_ytd,
    coalesce(sum(CASE WHEN CROP_YEAR_START = latest_cy_start AND CROP_MONTH_NUM <= common_month AND QTY > 0
                      THEN QTY END), 0) AS cum_start,
    max(CASE WHEN CROP_YEAR_START = latest_cy_start AND CROP_MONTH_NUM = common_month AND QTY > 0
             THEN QTY END) AS anchor_qty
  FROM cube JOIN st USING (FLOW) GROUP BY cube.FLOW
),
ref5 AS (
  SELECT FLOW, CROP_YEAR_START, annual FROM (
    SELECT *, row_number() OVER (PARTITION BY FLOW ORDER BY CROP_YEAR_START DESC) AS r
    FROM comp WHERE is_complete) WHERE r <= 5
),
props AS (
  SELECT cube.FLOW, CROP_MONTH_NUM AS cm, avg(QTY / annual) AS avg_share, count(*) AS n_years,
         avg(QTY) AS avg_qty
  FROM cube JOIN ref5 USING (FLOW, CROP_YEAR_START) GROUP BY ALL
),
ptot AS (
  SELECT props.FLOW, sum(CASE WHEN cm <= common_month THEN avg_share END) AS act_share,
         sum(CASE WHEN cm > common_month THEN avg_share END) AS rem_share
  FROM props JOIN st USING (FLOW) GROUP BY props.FLOW
),
mann AS (SELECT FLOW, avg(annual) AS mean_annual FROM ref5 GROUP BY FLOW),
pytd AS (
  SELECT rem.FLOW, rem.latest_cy_start, rem.cm,
         CASE WHEN rem.prev_cy IS NOT NULL AND sums.prev_ytd > 0
              THEN round_even((sums.cy_ytd / sums.prev_ytd - 1) * 100, 1) ELSE 0 END AS yoy,
         coalesce(pv.QTY, 0) AS b0, props.avg_qty
  FROM rem JOIN sums USING (FLOW)
  LEFT JOIN cube pv ON pv.FLOW = rem.FLOW AND pv.CROP_YEAR_START = rem.prev_cy AND pv.CROP_MONTH_NUM = rem.cm
  LEFT JOIN props ON props.FLOW = rem.FLOW AND props.cm = rem.cm
),
pb AS (
  SELECT *, CASE WHEN b0 <= 0 AND avg_qty IS NOT NULL THEN avg_qty ELSE b0 END AS base FROM pytd
),
proj AS (
  SELECT FLOW, latest_cy_start, cm, yoy, base, base * (1 + yoy / 100) AS proj_qty FROM pb WHERE base > 0
)"""

q("avg_proportions", base() + OVERVIEW + PROJ + """
SELECT FLOW AS flow, cm AS crop_month_num, round(avg_share, 6) AS avg_share, n_years,
       round(avg_qty, 6) AS avg_qty FROM props""")
q("projection_ytd", base() + OVERVIEW + PROJ + """
SELECT FLOW AS flow, latest_cy_start AS crop_year_start, cm AS crop_month_num, round(yoy, 6) AS yoy_pct,
       round(base, 6) AS base_qty, round(proj_qty, 6) AS proj_qty FROM proj""")
q("projection_proportions", base() + OVERVIEW + PROJ + """,
pp AS (
  SELECT rem.FLOW, rem.latest_cy_start, rem.cm, props.avg_share,
         CASE WHEN coalesce(ptot.act_share, 0) > 0 THEN sums.cy_ytd / ptot.act_share
              ELSE mann.mean_annual END AS imp
  FROM rem JOIN props ON props.FLOW = rem.FLOW AND props.cm = rem.cm
  JOIN ptot ON ptot.FLOW = rem.FLOW LEFT JOIN mann ON mann.FLOW = rem.FLOW JOIN sums ON sums.FLOW = rem.FLOW
)
SELECT FLOW AS flow, latest_cy_start AS crop_year_start, cm AS crop_month_num,
       round(imp, 6) AS implied_total, round(imp * avg_share, 6) AS proj_qty FROM pp""")
q("projection_manual_month", base() + OVERVIEW + PROJ + """
SELECT FLOW AS flow, latest_cy_start AS crop_year_start, cm AS crop_month_num,
       CAST(1000.0 AS DOUBLE) AS proj_qty FROM rem""")
q("projection_manual_year", base() + OVERVIEW + PROJ + """,
py AS (
  SELECT rem.FLOW, rem.latest_cy_start, rem.cm, props.avg_share, ptot.rem_share, sums.cy_ytd,
         CASE WHEN ptot.act_share > 0 THEN round_even(sums.cy_ytd / ptot.act_share, 0) ELSE 0 END AS target
  FROM rem JOIN props ON props.FLOW = rem.FLOW AND props.cm = rem.cm
  JOIN ptot ON ptot.FLOW = rem.FLOW JOIN sums ON sums.FLOW = rem.FLOW
),
py2 AS (SELECT *, greatest(0, target - cy_ytd) AS rb FROM py)
SELECT FLOW AS flow, latest_cy_start AS crop_year_start, cm AS crop_month_num, round(target, 6) AS target,
       round(rb, 6) AS remaining_budget, round(rb * avg_share / rem_share, 6) AS proj_qty
FROM py2 WHERE rb > 0 AND rem_share > 0""")
q("projection_series", base() + OVERVIEW + PROJ + """
SELECT st.FLOW AS flow, st.latest_cy_start AS crop_year_start, st.common_month AS crop_month_num,
       round(sums.anchor_qty, 6) AS qty, false AS is_projected
FROM st JOIN sums USING (FLOW)
WHERE sums.anchor_qty IS NOT NULL AND st.FLOW IN (SELECT FLOW FROM proj)
UNION ALL
SELECT FLOW, latest_cy_start, cm, round(proj_qty, 6), true FROM proj""")
q("projection_cumulative", base() + OVERVIEW + PROJ + """,
steps AS (
  SELECT st.FLOW, st.latest_cy_start AS cy, st.common_month AS cm, sums.cum_start AS step, false AS is_projected
  FROM st JOIN sums USING (FLOW) WHERE st.FLOW IN (SELECT FLOW FROM proj)
  UNION ALL
  SELECT FLOW, latest_cy_start, cm, proj_qty, true FROM proj
)
SELECT FLOW AS flow, cy AS crop_year_start, cm AS crop_month_num, is_projected,
       round(sum(step) OVER (PARTITION BY FLOW ORDER BY cm ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6)
         AS cum_qty
FROM steps""")

_BAND_ROWS = " UNION ALL ".join(
    f"SELECT FLOW, '{c}', CAST(NULL AS INTEGER), CROP_MONTH_NUM, round({c}, 6), false FROM band" for c in ("band_max", "band_min", "band_avg"))
_AHEAD_ROWS = """
SELECT st.FLOW, 'projection', st.latest_cy_start, st.common_month, round(sums.anchor_qty, 6), false
FROM st JOIN sums USING (FLOW) WHERE sums.anchor_qty IS NOT NULL AND st.FLOW IN (SELECT FLOW FROM proj)
UNION ALL SELECT FLOW, 'projection', latest_cy_start, cm, round(proj_qty, 6), true FROM proj"""
q("seasonal_chart", base() + OVERVIEW + PROJ + f"""
SELECT FLOW AS flow, 'year' AS series, CROP_YEAR_START AS crop_year_start, CROP_MONTH_NUM AS crop_month_num,
       round(QTY, 6) AS qty, false AS is_projected FROM cube
UNION ALL {_BAND_ROWS} UNION ALL {_AHEAD_ROWS}""")
q("latest_chart", base() + OVERVIEW + PROJ + f""",
months AS (SELECT FLOW, latest_cy_start, CAST(unnest(range(1, common_month + 1)) AS INTEGER) AS cm FROM st)
SELECT months.FLOW AS flow, 'latest' AS series, latest_cy_start AS crop_year_start, cm AS crop_month_num,
       round(latest_qty, 6) AS qty, false AS is_projected
FROM months LEFT JOIN latest ON latest.FLOW = months.FLOW AND latest.CROP_MONTH_NUM = cm
WHERE months.FLOW IN (SELECT FLOW FROM band)
UNION ALL {_BAND_ROWS}
UNION ALL SELECT * FROM ({_AHEAD_ROWS}) WHERE FLOW IN (SELECT FLOW FROM band)""")
q("projection_totals", base() + """,
ry AS (SELECT FLOW, REPORTER, CROP_YEAR_START AS cy, max(CROP_MONTH_NUM) AS mx FROM c GROUP BY ALL),
rs AS (
  SELECT FLOW, REPORTER, max(cy) AS lcy, arg_max(mx, cy) AS m, min(cy) AS ocy, count(*) AS n FROM ry GROUP BY ALL
),
rc AS (
  SELECT c.FLOW, c.REPORTER, CROP_YEAR_START AS cy, CROP_MONTH_NUM AS cm, lcy, m, sum(QTY) AS qty
  FROM c JOIN rs USING (FLOW, REPORTER)
  WHERE (CROP_YEAR_START < lcy OR CROP_MONTH_NUM <= m) AND (n <= 1 OR CROP_YEAR_START > ocy) GROUP BY ALL
),
rann AS (SELECT FLOW, REPORTER, cy, sum(qty) AS annual FROM rc GROUP BY ALL HAVING count(CASE WHEN qty > 0 THEN 1 END) = 12),
rref AS (
  SELECT * FROM rann QUALIFY row_number() OVER (PARTITION BY FLOW, REPORTER ORDER BY cy DESC) <= 5
),
rshare AS (
  SELECT FLOW, REPORTER, m, cm, avg(qty / annual) AS share FROM rc JOIN rref USING (FLOW, REPORTER, cy) GROUP BY ALL
),
ract AS (SELECT FLOW, REPORTER, sum(CASE WHEN cm <= m THEN share END) AS act FROM rshare GROUP BY ALL),
rmean AS (SELECT FLOW, REPORTER, avg(annual) AS mean_annual FROM rref GROUP BY ALL),
rytd AS (SELECT FLOW, REPORTER, coalesce(sum(qty) FILTER (WHERE cy = lcy AND cm <= m), 0) AS ytd FROM rc GROUP BY ALL),
rt AS (
  SELECT FLOW, REPORTER, lcy, m, ytd, CASE WHEN coalesce(act, 0) > 0 THEN ytd / act ELSE mean_annual END AS implied,
         CASE WHEN coalesce(act, 0) > 0 THEN round_even(ytd / act, 0) ELSE 0 END AS target
  FROM rs JOIN rytd USING (FLOW, REPORTER) LEFT JOIN ract USING (FLOW, REPORTER) LEFT JOIN rmean USING (FLOW, REPORTER)
)
SELECT FLOW AS flow, REPORTER AS reporter, lcy AS crop_year_start, m AS common_month, CAST(12 - m AS INTEGER) AS n_remaining,
       round(ytd, 6) AS cy_ytd, round(implied, 6) AS implied_total, round(target, 6) AS target,
       round(greatest(0, target - ytd), 6) AS remaining_budget FROM rt""")

# ---------------------------------------------------------------- mirror ---
MIRROR = """,
canon AS (SELECT * FROM (VALUES ('NATION_23', 'Nation Twenty-Three'), ('NATION_24', 'Other')) v(NAME, STD)),
ep AS (SELECT DISTINCT REPORTER AS exporter, PARTNER AS destination FROM c WHERE FLOW = 'E'),
ip AS (SELECT DISTINCT REPORTER AS importer, PARTNER AS origin FROM c WHERE FLOW = 'I'),
pairs AS (
  SELECT exporter, destination, importer, origin
  FROM ep JOIN ip
    ON coalesce((SELECT STD FROM canon WHERE NAME = trim(destination)), trim(destination))
       = coalesce((SELECT STD FROM canon WHERE NAME = trim(importer)), trim(importer))
   AND coalesce((SELECT STD FROM canon WHERE NAME = trim(destination)), '') <> 'Other'
   AND coalesce((SELECT STD FROM canon WHERE NAME = trim(exporter)), '') <> 'Other'
   AND coalesce((SELECT STD FROM canon WHERE NAME = trim(exporter)), trim(exporter))
       = coalesce((SELECT STD FROM canon WHERE NAME = trim(origin)), trim(origin))
),
direct AS (
  SELECT REPORTER AS exporter, PARTNER AS destination, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM,
         sum(QTY) AS QTY
  FROM c WHERE FLOW = 'E' GROUP BY ALL
),
mir AS (
  SELECT REPORTER AS importer, PARTNER AS origin, CROP_YEAR_START, CROP_YEAR, CROP_MONTH_NUM, sum(QTY) AS QTY
  FROM c WHERE FLOW = 'I' GROUP BY ALL
),
shifted AS (
  SELECT REPORTER, PARTNER, QTY, CAST((YEAR * 12 + MONTH - 1 - 1) // 12 AS INTEGER) AS Y,
         CAST((YEAR * 12 + MONTH - 1 - 1) % 12 + 1 AS INTEGER) AS M
  FROM c WHERE FLOW = 'I'
),
mir_s AS (
  SELECT REPORTER AS importer, PARTNER AS origin,
         CAST(Y - CASE WHEN M < 7 THEN 1 ELSE 0 END AS INTEGER) AS CROP_YEAR_START,
         CAST(((M - 7 + 12) % 12) + 1 AS INTEGER) AS CROP_MONTH_NUM, sum(QTY) AS QTY
  FROM shifted GROUP BY ALL
),
myears AS (
  SELECT DISTINCT p.*, d.CROP_YEAR_START, d.CROP_YEAR FROM pairs p JOIN direct d USING (exporter, destination)
  UNION
  SELECT DISTINCT p.*, m.CROP_YEAR_START, m.CROP_YEAR FROM pairs p JOIN mir m USING (importer, origin)
)"""
_PAIR_OUT = "exporter, destination, importer, origin"
q("mirror_pairs", base() + MIRROR + f"\nSELECT {_PAIR_OUT} FROM pairs")
q("mirror_years", base() + MIRROR + f"""
SELECT {_PAIR_OUT}, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year FROM myears""")
for _name, _last in (("mirror_overlay", "true"), ("mirror_overlay_range", "r <= 2")):
    q(_name, base() + MIRROR + f""",
sel AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY exporter, destination, importer, origin
                                 ORDER BY CROP_YEAR_START DESC) AS r
    FROM myears) WHERE {_last}
)
SELECT sel.exporter, sel.destination, sel.importer, sel.origin, 'direct' AS series,
       sel.CROP_YEAR_START AS crop_year_start, sel.CROP_YEAR AS crop_year, d.CROP_MONTH_NUM AS crop_month_num,
       round(d.QTY, 6) AS qty
FROM sel JOIN direct d ON d.exporter = sel.exporter AND d.destination = sel.destination
                      AND d.CROP_YEAR_START = sel.CROP_YEAR_START
UNION ALL
SELECT sel.exporter, sel.destination, sel.importer, sel.origin, 'mirror',
       sel.CROP_YEAR_START, sel.CROP_YEAR, m.CROP_MONTH_NUM, round(m.QTY, 6)
FROM sel JOIN mir_s m ON m.importer = sel.importer AND m.origin = sel.origin
                     AND m.CROP_YEAR_START = sel.CROP_YEAR_START""")

# ------------------------------------------------------------------ load ---
q("read_extract", base() + f"\nSELECT {RAW_OUT} FROM trade")
q("read_extract_encodings", base() + f"\nSELECT {RAW_OUT} FROM trade")
q("read_extract_cotton", base() + f"\nSELECT {RAW_OUT.replace(', round(VALUE, 2) AS value', '')} FROM trade")
q("table_freshness", base() + """
SELECT FLOW AS flow, count(DISTINCT YEAR) AS n_partitions, count(*) AS rows,
       CAST(FLOW = 'I' AS BIGINT) AS n_strange, FLOW <> 'I' AS is_dated FROM trade GROUP BY FLOW""")
q("unmatched_partners", base() + """
SELECT PARTNER AS partner_std, count(*) AS n_rows FROM trade
WHERE CAST(replace(PARTNER, 'NATION_', '') AS INTEGER) >= 12 GROUP BY PARTNER""")
q("full_reload_one_flow", base() + f"\nSELECT {RAW_OUT} FROM trade WHERE FLOW = 'I' OR YEAR <= 1998")
q("extract_slice", base() + f"""
SELECT {RAW_OUT}, HS4 AS hs4 FROM enriched
WHERE FLOW = 'E' AND {_in('REPORTER', ['NATION_0', 'NATION_3', 'NATION_7', 'NATION_12', 'NATION_18', 'NATION_24'])}
  AND YEAR * 100 + MONTH BETWEEN 199701 AND 200012 AND HS4 LIKE '31%'""")
q("load_trade", base() + f"""
SELECT {RAW_OUT}, HS4 AS hs4, PARTNER_STD AS partner_std, REGION AS region,
       REPORTER_REGION AS reporter_region, COMMODITY_TAG AS commodity_tag FROM enriched""")
q("incremental_begin", base() + """
SELECT FLOW AS flow, CAST(max(YEAR) AS VARCHAR) || '01' AS period_begin FROM trade WHERE YEAR <= 2000 GROUP BY FLOW""")
_UPSERTED = ("FLOW AS flow, REPORTER AS reporter, PARTNER AS partner, COMMODITY AS commodity, YEAR AS year, "
             "MONTH AS month, round(CASE WHEN YEAR = 2000 THEN QTY1 * 2 ELSE QTY1 END, 6) AS qty1, "
             "round(VALUE, 2) AS value")
for _k in ("upsert_keep_last", "upsert_roundtrip", "stream_upsert"):
    q(_k, base() + f"\nSELECT {_UPSERTED} FROM trade")
q("load_audit", base() + """,
stored AS (SELECT * FROM trade WHERE YEAR <= 2000),
fresh AS (SELECT * FROM trade WHERE YEAR >= 2000),
merged AS (
  SELECT DISTINCT FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH FROM stored
  UNION SELECT DISTINCT FLOW, REPORTER, PARTNER, COMMODITY, YEAR, MONTH FROM fresh
),
b AS (SELECT FLOW, count(*) AS n FROM stored GROUP BY FLOW),
f AS (SELECT FLOW, count(*) AS n FROM fresh GROUP BY FLOW),
a AS (SELECT FLOW, count(*) AS n FROM merged GROUP BY FLOW)
SELECT a.FLOW AS flow, coalesce(b.n, 0) AS rows_before, coalesce(f.n, 0) AS rows_fetched,
       a.n AS rows_after, coalesce(b.n, 0) + coalesce(f.n, 0) AS rows_merged,
       a.n - coalesce(b.n, 0) AS rows_new, coalesce(b.n, 0) + coalesce(f.n, 0) - a.n AS rows_removed_by_dedup
FROM a LEFT JOIN b USING (FLOW) LEFT JOIN f USING (FLOW)""")
q("upsert_new_column", base() + f"""
SELECT {_UPSERTED.replace("round(VALUE, 2)", "CASE WHEN YEAR >= 2000 THEN round(VALUE, 2) END")} FROM trade""")
q("cube_after_upsert", base() + """
SELECT FLOW AS flow, REPORTER AS reporter, CROP_YEAR_START AS crop_year_start, CROP_YEAR AS crop_year,
       CROP_MONTH_NUM AS crop_month_num, round(sum(CASE WHEN YEAR = 2000 THEN 2 * QTY ELSE QTY END), 6) AS qty
FROM c GROUP BY ALL""")

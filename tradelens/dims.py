"""Dimension seeds as small DataFrames.

The enrichment operators broadcast these only through ``Dims.hint``: every
seed has a size fixed in source (tens of rows); a dimension derived from data
(country -> continent) has its row count checked when the ``Dims`` is built,
and without that bound the planner chooses the join by size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators._util import small_table

# =========================== fixed values ==================================
# These must equal the reference's lookup tables for equal results.

# HS4 heading -> tag, and the default tag, per product.
HS4_TAGS = {
    "fertilizer": {
        "3101": "Organic Fertilizers",
        "3102": "Nitrogenous (N)",
        "3103": "Phosphatic (P)",
        "3104": "Potassic (K)",
        "3105": "Mixed / NPK",
    },
    "cotton": {
        "5201": "Raw Cotton",
        "5202": "Cotton Waste",
        "5203": "Cotton, Carded/Combed",
        "5204": "Cotton Sewing Thread",
        "5205": "Cotton Yarn >=85%",
        "5206": "Cotton Yarn <85%",
        "5207": "Cotton Yarn Retail",
        "5208": "Woven Fabric >=85% <=200g",
        "5209": "Woven Fabric >=85% >200g",
        "5210": "Woven Fabric <85% <=200g",
        "5211": "Woven Fabric <85% >200g",
        "5212": "Other Woven Cotton",
    },
}
DEFAULT_TAG = {"fertilizer": "Other Fertilizer", "cotton": "Other Cotton"}

# Partner-name aliases shared by both products.
PARTNER_ALIASES_COMMON = {
    "United States": "United States of America",
    "Russia": "Russian Federation",
    "South Korea": "Korea, Republic of",
    "Iran": "Iran, Islamic Republic of",
    "Vietnam": "Viet Nam",
    "Venezuela": "Venezuela, Bolivarian Republic of",
    "Bolivia": "Bolivia, Plurinational State of",
    "Tanzania": "Tanzania, United Republic of",
    "Taiwan": "Taiwan, Province of China",
    "Congo (ROC)": "Congo",
    "Congo (DROC)": "Democratic Republic of the Congo",
    "Netherlands Antilles": "Other",
    "Duty Free Shops": "Other",
    "Stores and Provisions": "Other",
    "Other Asia, nes": "Other",
    "Free Zones": "Other",
    "High Seas": "Other",
    "Unidentified": "Other",
}
# Extra aliases of the fertilizer extracts; cotton maps Cote d'Ivoire to itself.
PARTNER_ALIASES_FERTILIZER = {
    "North Korea": "Korea, Democratic People's Republic of",
    "Syria": "Syrian Arab Republic",
    "Laos": "Lao People's Democratic Republic",
    "Moldova": "Moldova, Republic of",
    "Gaza Strip and West Bank": "State of Palestine",
    "Cote d'Ivoire": "Côte d'Ivoire",
}
PARTNER_ALIASES_COTTON = {"Cote d'Ivoire": "Cote d'Ivoire"}

# Partner region sets (cleaned names).
NAM = ["Canada", "United States of America", "Bermuda", "Greenland"]
LATAM = [
    "Argentina", "Belize", "Bolivia, Plurinational State of", "Brazil", "Chile",
    "Colombia", "Costa Rica", "Cuba", "Dominican Republic", "Ecuador", "El Salvador",
    "French Guiana", "Guatemala", "Guyana", "Haiti", "Honduras", "Jamaica", "Mexico",
    "Nicaragua", "Panama", "Paraguay", "Peru", "Suriname", "Trinidad and Tobago",
    "Uruguay", "Venezuela, Bolivarian Republic of",
]
# Continents that give a partner region of their own; anything else is "Other".
REGION_CONTINENTS = ["Europe", "Asia", "Africa", "Oceania"]

# Reporter name -> reporter region, per extract (default "Other").
REPORTER_REGIONS = {
    ("fertilizer", "I"): {
        "Brazil": "LATAM", "India": "Asia", "United States": "NAM",
        "United States of America": "NAM", "China": "Asia",
        "China, People's Republic of": "Asia", "Australia": "Oceania", "Thailand": "Asia",
        "Canada": "NAM", "Indonesia": "Asia", "Mexico": "LATAM", "Colombia": "LATAM",
        "Ecuador": "LATAM", "Cote d'Ivoire": "Africa", "Côte d'Ivoire": "Africa",
        "Honduras": "LATAM", "Ghana": "Africa", "Uganda": "Africa",
    },
    ("fertilizer", "E"): {
        "China": "Asia", "China, People's Republic of": "Asia", "Morocco": "Africa",
        "Canada": "NAM", "Saudi Arabia": "Middle East", "United States": "NAM",
        "United States of America": "NAM", "Netherlands": "Europe", "Belgium": "Europe",
        "Qatar": "Middle East", "Egypt": "Africa", "Spain": "Europe", "Iran": "Middle East",
        "Iran, Islamic Republic of": "Middle East", "Israel": "Middle East",
        "Jordan": "Middle East", "Germany": "Europe", "Poland": "Europe",
        "Russia": "Europe", "Russian Federation": "Europe",
    },
    ("cotton", "I"): {
        "Korea, Republic of": "Asia", "Ukraine": "Europe", "Peru": "LATAM", "Taiwan": "Asia",
        "Taiwan, Province of China": "Asia", "Singapore": "Asia", "China": "Asia",
        "China, People's Republic of": "Asia", "New Zealand": "Oceania",
        "United States": "NAM", "United States of America": "NAM", "Turkey": "Europe",
        "Türkiye": "Europe", "India": "Asia",
    },
    ("cotton", "E"): {
        "Brazil": "LATAM", "United States": "NAM", "United States of America": "NAM",
        "Cote d'Ivoire": "Africa", "Ivory Coast": "Africa", "Argentina": "LATAM",
        "China": "Asia", "China, People's Republic of": "Asia", "Taiwan": "Asia",
        "Taiwan, Province of China": "Asia", "Pakistan": "Asia", "Singapore": "Asia",
        "Korea, Republic of": "Asia", "New Zealand": "Oceania", "Ukraine": "Europe",
        "Turkey": "Europe", "Türkiye": "Europe", "Australia": "Oceania",
        "Australia (AUC)": "Oceania", "India": "Asia",
    },
}

# Fixture seeds for the trade view built over the TPC-H-style test tables.
FIXTURE_ALIASES = {"NATION_23": "Nation Twenty-Three", "NATION_24": "Other"}
FIXTURE_NAM = ["NATION_1"]
FIXTURE_LATAM = ["NATION_6", "NATION_11"]
FIXTURE_CONTINENT_OF_REGION = {
    "AFRICA": "Africa", "ASIA": "Asia", "EUROPE": "Europe", "AMERICA": "America",
}
FIXTURE_CONTINENT_OVERRIDE = {"NATION_22": "Oceania"}
FIXTURE_REPORTER_REGION_OF_REGION = {
    "AFRICA": "Africa", "ASIA": "Asia", "EUROPE": "Europe", "MIDDLE EAST": "Middle East",
}
# ===========================================================================

# Built-in country -> continent seed (public geography), keyed by cleaned
# partner names; used when the caller passes no fuller country list.
COUNTRY_CONTINENT = {
    "Europe": [
        "Albania", "Austria", "Belarus", "Belgium", "Bulgaria", "Croatia", "Czechia", "Denmark", "Estonia",
        "Finland", "France", "Germany", "Greece", "Hungary", "Ireland", "Italy", "Latvia", "Lithuania",
        "Netherlands", "Norway", "Poland", "Portugal", "Romania", "Russian Federation", "Serbia", "Slovakia",
        "Slovenia", "Spain", "Sweden", "Switzerland", "Ukraine", "United Kingdom",
        "Moldova, Republic of",
        "Andorra", "Bosnia and Herzegovina", "Iceland", "Liechtenstein", "Luxembourg", "Malta", "Monaco",
        "Montenegro", "North Macedonia", "San Marino",
    ],
    "Asia": [
        "Bangladesh", "China", "India", "Indonesia", "Iran, Islamic Republic of", "Iraq", "Israel", "Japan",
        "Jordan", "Kazakhstan", "Korea, Republic of", "Korea, Democratic People's Republic of", "Kuwait",
        "Lao People's Democratic Republic", "Malaysia", "Myanmar", "Oman", "Pakistan", "Philippines", "Qatar",
        "Saudi Arabia", "Singapore", "Sri Lanka", "State of Palestine", "Syrian Arab Republic",
        "Taiwan, Province of China", "Thailand", "Turkey", "Türkiye", "United Arab Emirates", "Uzbekistan",
        "Viet Nam",
        "Afghanistan", "Armenia", "Azerbaijan", "Bahrain", "Bhutan", "Brunei Darussalam", "Cambodia", "Cyprus",
        "Georgia", "Hong Kong", "Kyrgyzstan", "Lebanon", "Macao", "Maldives", "Mongolia", "Nepal", "Tajikistan",
        "Turkmenistan", "Yemen",
    ],
    "Africa": [
        "Algeria", "Benin", "Burkina Faso", "Cameroon", "Congo", "Côte d'Ivoire", "Cote d'Ivoire",
        "Democratic Republic of the Congo", "Egypt", "Ethiopia", "Ghana", "Kenya", "Mali", "Morocco",
        "Mozambique", "Nigeria", "Senegal", "South Africa", "Sudan", "Tanzania, United Republic of", "Togo",
        "Tunisia", "Uganda", "Zambia", "Zimbabwe",
        "Angola", "Botswana", "Burundi", "Cabo Verde", "Central African Republic", "Chad", "Comoros", "Djibouti",
        "Equatorial Guinea", "Eritrea", "Eswatini", "Gabon", "Gambia", "Guinea", "Guinea-Bissau", "Lesotho",
        "Liberia", "Libya", "Madagascar", "Malawi", "Mauritania", "Mauritius", "Namibia", "Niger", "Rwanda",
        "Sao Tome and Principe", "Seychelles", "Sierra Leone", "Somalia", "South Sudan",
    ],
    "Oceania": [
        "Australia", "Fiji", "New Zealand", "Papua New Guinea", "French Polynesia", "Kiribati", "Marshall Islands",
        "Micronesia, Federated States of", "Nauru", "New Caledonia", "Palau", "Samoa", "Solomon Islands", "Tonga",
        "Tuvalu", "Vanuatu",
    ],
    "America": [
        "Argentina", "Belize", "Bermuda", "Bolivia, Plurinational State of", "Brazil", "Canada", "Chile",
        "Colombia", "Costa Rica", "Cuba", "Dominican Republic", "Ecuador", "El Salvador", "Greenland",
        "Guatemala", "Guyana", "Haiti", "Honduras", "Jamaica", "Mexico", "Nicaragua", "Panama", "Paraguay",
        "Peru", "Suriname", "Trinidad and Tobago", "United States of America", "Uruguay",
        "Venezuela, Bolivarian Republic of",
        "Antigua and Barbuda", "Aruba", "Bahamas", "Barbados", "Cayman Islands", "Curaçao", "Dominica", "Grenada",
        "Puerto Rico", "Saint Kitts and Nevis", "Saint Lucia", "Saint Vincent and the Grenadines",
    ],
}

@dataclass
class Dims:
    """Lookups used by enrichment, keyed by name or HS4 group.

    ``alias`` and ``tags`` are fixed seeds (tens of rows) and are broadcast.
    The region dimensions may come from data of any size: they are written
    once, so the planner knows their size and picks the join.
    """

    alias: DataFrame            # NAME, STD_NAME
    partner_region: DataFrame   # NAME (cleaned), REGION
    reporter_region: DataFrame  # NAME (raw), REPORTER_REGION
    tags: DataFrame             # HS4, TAG
    default_tag: str


def _pairs(spark: SparkSession, mapping: dict, k: str, v: str) -> DataFrame:
    return spark.createDataFrame(list(mapping.items()), f"{k} string, {v} string")


def _partner_region(spark: SparkSession, continent: DataFrame, nam: list, latam: list) -> DataFrame:
    """Region of every known cleaned name, in the ingest's precedence order."""
    sets = spark.createDataFrame(
        [(n, "NAM") for n in nam] + [(n, "LATAM") for n in latam], "NAME string, SET_REGION string")
    names = (continent.select("NAME").union(sets.select("NAME")).distinct()
             .join(sets, "NAME", "left")
             .join(continent, "NAME", "left"))
    region = (F.when(F.col("NAME") == "Other", "Other")
              .when(F.col("SET_REGION") == "NAM", "NAM")
              .when(F.col("SET_REGION") == "LATAM", "LATAM")
              .when(F.col("CONTINENT").isin(REGION_CONTINENTS), F.col("CONTINENT"))
              .otherwise("Other"))
    return names.select("NAME", region.alias("REGION"))


def reference_dims(spark: SparkSession, product: str = "fertilizer", flow: str = "I",
                   continent: DataFrame | None = None) -> Dims:
    """Seeds of the reference extracts.

    ``continent`` (NAME, CONTINENT) is the country -> continent dimension; the
    reference takes it from a third-party converter. Without one, the
    built-in ``COUNTRY_CONTINENT`` seed is used; unknown names fall to "Other".
    """
    aliases = dict(PARTNER_ALIASES_COMMON)
    aliases.update(PARTNER_ALIASES_FERTILIZER if product == "fertilizer" else PARTNER_ALIASES_COTTON)
    if continent is None:
        continent = spark.createDataFrame(
            [(name, cont) for cont, names in COUNTRY_CONTINENT.items() for name in names],
            "NAME string, CONTINENT string")
    return Dims(
        alias=_pairs(spark, aliases, "NAME", "STD_NAME"),
        partner_region=small_table(_partner_region(spark, continent, NAM, LATAM), "dims"),
        reporter_region=small_table(
            _pairs(spark, REPORTER_REGIONS[(product, flow)], "NAME", "REPORTER_REGION"), "dims"),
        tags=_pairs(spark, HS4_TAGS[product], "HS4", "TAG"),
        default_tag=DEFAULT_TAG[product],
    )


def fixture_dims(spark: SparkSession, sf_dir: str) -> Dims:
    """Seeds for the trade view over the test tables (nation and region)."""
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name", "n_regionkey")
    region = spark.read.parquet(f"{sf_dir}/region.parquet").select("r_regionkey", "r_name")
    nr = nation.join(region, nation.n_regionkey == region.r_regionkey)

    def mapped(mapping: dict, col: str) -> F.Column:
        expr = F.lit(None).cast("string")
        for k, v in mapping.items():
            expr = F.when(F.col(col) == k, v).otherwise(expr)
        return expr

    cont = F.coalesce(mapped(FIXTURE_CONTINENT_OVERRIDE, "n_name"),
                      mapped(FIXTURE_CONTINENT_OF_REGION, "r_name"))
    continent = nr.select(F.col("n_name").alias("NAME"), cont.alias("CONTINENT"))
    rep_region = (F.when(F.col("n_name").isin(FIXTURE_NAM), "NAM")
                  .when(F.col("n_name").isin(FIXTURE_LATAM), "LATAM")
                  .otherwise(F.coalesce(mapped(FIXTURE_CONTINENT_OVERRIDE, "n_name"),
                                        mapped(FIXTURE_REPORTER_REGION_OF_REGION, "r_name"),
                                        F.lit("Other"))))
    reporter_region = nr.select(F.col("n_name").alias("NAME"), rep_region.alias("REPORTER_REGION"))
    return Dims(
        alias=_pairs(spark, FIXTURE_ALIASES, "NAME", "STD_NAME"),
        partner_region=small_table(_partner_region(spark, continent, FIXTURE_NAM, FIXTURE_LATAM), "dims"),
        reporter_region=small_table(reporter_region, "dims"),
        tags=_pairs(spark, HS4_TAGS["fertilizer"], "HS4", "TAG"),
        default_tag=DEFAULT_TAG["fertilizer"],
    )

from tradelens.dims import fixture_dims, reference_dims
from tradelens.operators.enrich import enrich_trade
from tradelens.schema import COMMODITY_TAG, HS4, PARTNER_STD, REGION, REPORTER_REGION

from conftest import SF_SMALL, make_trade


def test_fixture_regions(spark):
    dims = fixture_dims(spark, SF_SMALL)
    rows = [("E", "NATION_0", p, "3106", 2000, 1, 1.0, 1.0)
            for p in ["NATION_1", "NATION_6", "NATION_22", "NATION_23", "NATION_24", "NATION_16", "NATION_4",
                      " NATION_3 ", None]]
    out = {r.PARTNER: (r[PARTNER_STD], r[REGION]) for r in enrich_trade(make_trade(spark, rows), dims).collect()}
    assert out["NATION_1"][1] == "NAM"
    assert out["NATION_6"][1] == "LATAM"
    assert out["NATION_22"][1] == "Oceania"
    assert out["NATION_23"] == ("Nation Twenty-Three", "Other")
    assert out["NATION_24"] == ("Other", "Other")
    assert out["NATION_16"][1] == "Other"      # America outside the two sets
    assert out["NATION_4"][1] == "Other"       # Middle East has no partner region
    assert out[" NATION_3 "] == ("NATION_3", "Europe")   # trimmed before lookup
    assert out[None][1] == "Other"


def test_reference_seeds(spark):
    cont = spark.createDataFrame([("Germany", "Europe"), ("India", "Asia"), ("Brazil", "America")],
                                 "NAME string, CONTINENT string")
    dims = reference_dims(spark, "fertilizer", "E", cont)
    rows = [("E", "Morocco", p, c, 2020, 1, 1.0, 1.0)
            for p, c in [("United States", "3102"), ("Germany", "310520"), ("Brazil", "3109"),
                         ("Free Zones", "31"), ("Atlantis", "abc")]]
    out = {r.PARTNER: r for r in enrich_trade(make_trade(spark, rows), dims).collect()}
    assert out["United States"][REGION] == "NAM"
    assert out["United States"][COMMODITY_TAG] == "Nitrogenous (N)"
    assert out["Germany"][REGION] == "Europe" and out["Germany"][HS4] == "3105"
    assert out["Brazil"][REGION] == "LATAM"
    assert out["Free Zones"][REGION] == "Other" and out["Free Zones"][HS4] == "0031"
    assert out["Atlantis"][REGION] == "Other" and out["Atlantis"][COMMODITY_TAG] == "Other Fertilizer"
    assert out["Atlantis"][REPORTER_REGION] == "Africa"


def test_builtin_continent_seed(spark):
    dims = reference_dims(spark, "fertilizer", "I")
    rows = [("I", "Brazil", p, "3104", 2020, 1, 1.0, 1.0)
            for p in ["Russia", "Morocco", "Canada", "Chile", "Viet Nam", "Australia", "High Seas", "Atlantis"]]
    out = {r.PARTNER: r[REGION] for r in enrich_trade(make_trade(spark, rows), dims).collect()}
    assert out == {"Russia": "Europe", "Morocco": "Africa", "Canada": "NAM", "Chile": "LATAM",
                   "Viet Nam": "Asia", "Australia": "Oceania", "High Seas": "Other", "Atlantis": "Other"}

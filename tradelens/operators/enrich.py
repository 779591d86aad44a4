"""Ingest-time derived columns (HS4, cleaned partner, regions, tag)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dims import Dims
from ..functions.scalars import hs4
from ..schema import COMMODITY, COMMODITY_TAG, HS4, PARTNER, PARTNER_STD, REGION, REPORTER, REPORTER_REGION


def derive_hs4(df: DataFrame) -> DataFrame:
    return df.withColumn(HS4, hs4(F.col(COMMODITY)))


def clean_partner(df: DataFrame, dims: Dims) -> DataFrame:
    """PARTNER_STD = trimmed partner name with the alias table applied."""
    alias = dims.alias.select(F.col("NAME").alias("_PT"), F.col("STD_NAME").alias("_STD"))
    return (df.withColumn("_PT", F.trim(F.col(PARTNER).cast("string")))
            .join(F.broadcast(alias), "_PT", "left")
            .withColumn(PARTNER_STD, F.coalesce(F.col("_STD"), F.col("_PT")))
            .drop("_PT", "_STD"))


def partner_region(df: DataFrame, dims: Dims) -> DataFrame:
    """REGION of the cleaned partner name; unknown names are "Other"."""
    if PARTNER_STD not in df.columns:
        df = clean_partner(df, dims)
    reg = dims.partner_region.select(F.col("NAME").alias("_STDK"), F.col("REGION").alias("_REG"))
    return (df.join(reg, F.col(PARTNER_STD) == F.col("_STDK"), "left")
            .withColumn(REGION, F.when(F.col(PARTNER_STD) == "Other", "Other")
                        .otherwise(F.coalesce(F.col("_REG"), F.lit("Other"))))
            .drop("_STDK", "_REG"))


def reporter_region(df: DataFrame, dims: Dims) -> DataFrame:
    rr = dims.reporter_region.select(F.col("NAME").alias("_RK"), F.col("REPORTER_REGION").alias("_RR"))
    return (df.join(rr, F.col(REPORTER) == F.col("_RK"), "left")
            .withColumn(REPORTER_REGION, F.coalesce(F.col("_RR"), F.lit("Other")))
            .drop("_RK", "_RR"))


def commodity_tag(df: DataFrame, dims: Dims) -> DataFrame:
    if HS4 not in df.columns:
        df = derive_hs4(df)
    tags = dims.tags.select(F.col("HS4").alias("_HK"), F.col("TAG").alias("_TAG"))
    return (df.join(F.broadcast(tags), F.col(HS4) == F.col("_HK"), "left")
            .withColumn(COMMODITY_TAG, F.coalesce(F.col("_TAG"), F.lit(dims.default_tag)))
            .drop("_HK", "_TAG"))


def enrich_trade(df: DataFrame, dims: Dims) -> DataFrame:
    """All ingest-time columns: HS4, PARTNER_STD, REGION, REPORTER_REGION, COMMODITY_TAG."""
    return commodity_tag(reporter_region(partner_region(clean_partner(derive_hs4(df), dims), dims), dims), dims)


def unmatched_partners(df: DataFrame, dims: Dims) -> DataFrame:
    """Cleaned partner names the region dimension does not know, with their rows."""
    known = dims.partner_region.select(F.col("NAME").alias(PARTNER_STD))
    names = df if PARTNER_STD in df.columns else clean_partner(df, dims)
    return (names.where(F.col(PARTNER_STD).isNotNull() & (F.col(PARTNER_STD) != "Other"))
            .groupBy(PARTNER_STD).agg(F.count(F.lit(1)).alias("N_ROWS"))
            .join(known, PARTNER_STD, "left_anti"))

"""Commune geography from landed payloads, with fallback centres."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V
from ..functions.casts import strip
from .dimensions import first_wins, split_cities

GEO_COLUMNS = ("code_insee", "nom", "latitude", "longitude", "geometry_json", "source")


def flatten_payload(payloads: DataFrame, with_contour: bool = True) -> DataFrame:
    """Payload rows as centre point and contour text; the source lists longitude first."""
    contour: Column = F.col("contour") if with_contour else F.lit(None).cast("string")
    return payloads.select(
        strip(F.col("code")).alias("code_insee"),
        "nom",
        F.get("centre.coordinates", F.lit(1)).alias("latitude"),
        F.get("centre.coordinates", F.lit(0)).alias("longitude"),
        contour.alias("geometry_json"),
        F.lit(V.GEO_SOURCE).alias("source"),
    )


def fallback_centres(spark: SparkSession) -> DataFrame:
    rows = spark.createDataFrame(
        list(V.FALLBACK_CENTRES), "code_insee string, nom string, latitude double, longitude double"
    )
    return rows.select(
        "*", F.lit(None).cast("string").alias("geometry_json"), F.lit(V.GEO_FALLBACK).alias("source")
    )


def arrondissement_codes(spark: SparkSession) -> DataFrame:
    return split_cities(spark).select("code_insee")


def located(df: DataFrame) -> DataFrame:
    return df.dropna(subset=["code_insee", "latitude", "longitude"])


def _rows_of(codes: DataFrame, geo: DataFrame) -> DataFrame:
    return geo.join(codes.select("code_insee"), "code_insee", "left_semi").select(*GEO_COLUMNS)


def geo_by_codes(codes: DataFrame, payloads: DataFrame, centres: DataFrame) -> DataFrame:
    """Geography of the listed codes: landed payload, else fallback centre, else left out.

    A payload decides for its code even when it has no usable centre; such a code is left out.
    """
    wanted = [_rows_of(codes, flatten_payload(payloads)), _rows_of(codes, centres)]
    return located(first_wins(wanted, ["code_insee"]))


def geo_by_departements(
    payloads: DataFrame,
    departements,
    arrondissements: DataFrame,
    centres: DataFrame,
    with_contour: bool = True,
) -> DataFrame:
    """Geography of whole départements plus arrondissements they do not list.

    Priority: payloads listed by département, payloads of single arrondissements, fallback centres
    of arrondissements.
    """
    of_departement = F.col("departement").isin(*departements)
    listed = payloads.where(of_departement & (F.coalesce(strip(F.col("code")), F.lit("")) != ""))
    single = payloads.where(~F.coalesce(of_departement, F.lit(False)))
    sources = [
        flatten_payload(listed, with_contour).select(*GEO_COLUMNS),
        _rows_of(arrondissements, flatten_payload(single, with_contour)),
        _rows_of(arrondissements, centres),
    ]
    return located(first_wins(sources, ["code_insee"]))

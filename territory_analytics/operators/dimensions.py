"""Reference dimensions and priority unions."""

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import fixed_values as V, schemas
from ..functions.casts import strip, whole_number
from .joins import fresh
from .latest import keep_first


def first_wins(sources, keys, ties=()) -> DataFrame:
    """Union of tables where an earlier table wins over a later one, one row per key.

    Within one table ``ties`` decides, then all other columns, so the outcome does not depend on
    row order.
    """

    def united(tables):
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)

    priority = fresh(united(sources), "priority")
    union = united([df.withColumn(priority, F.lit(i)) for i, df in enumerate(sources)])
    rest = [c for c in union.columns if c not in (*keys, priority, *ties)]
    order = [F.col(c).asc_nulls_last() for c in (priority, *ties, *rest)]
    return keep_first(union, keys, order).drop(priority)


def build_dim_commune(communes: DataFrame, arrondissements: DataFrame, ties=()) -> DataFrame:
    """Commune list plus arrondissements under the names of the data model."""

    def renamed(df):
        return df.select(
            strip(F.col("code").cast("string")).alias("code_insee"),
            F.col("nom").cast("string").alias("nom"),
            strip(F.col("codeDepartement").cast("string")).alias("departement"),
            strip(F.col("codeRegion").cast("string")).alias("region"),
            whole_number(F.col("population").cast("string")).cast("bigint").alias("population"),
            *ties,
        )

    both = first_wins([renamed(communes), renamed(arrondissements)], ["code_insee"], ties)
    return both.drop(*ties)


def label_scale(spark: SparkSession) -> DataFrame:
    """The seven labels; fixed rows, so always fit to broadcast."""
    return F.broadcast(spark.createDataFrame(list(V.LABEL_SCALE), schemas.DIM_LABEL))


def property_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(t,) for t in V.PROPERTY_TYPES], schemas.DIM_TYPE)


def build_dimensions(spark: SparkSession, communes: DataFrame, arrondissements: DataFrame) -> dict:
    return {
        "dim_commune": build_dim_commune(communes, arrondissements),
        "dim_dpe": label_scale(spark),
        "dim_type_bien": property_types(spark),
    }


def split_cities(spark: SparkSession) -> DataFrame:
    """One row per arrondissement of a split city: city, member name, member code."""
    cities = spark.createDataFrame(list(V.SPLIT_CITIES), "city string, first_code int, size int")
    numbered = cities.withColumn("number", F.explode(F.sequence(F.lit(1), F.col("size"))))
    ordinal = F.when(F.col("number") == 1, "1er").otherwise(F.concat(F.col("number").cast("string"), F.lit("e")))
    return numbered.select(
        "city",
        F.concat_ws(" ", "city", ordinal, F.lit("Arrondissement")).alias("member"),
        F.format_string("%05d", F.col("first_code") + F.col("number") - 1).alias("code_insee"),
    )


def chosen_with_members(chosen: DataFrame, members: DataFrame) -> DataFrame:
    """Chosen names plus every member of a chosen city; ``members`` has city and member."""
    extra = members.join(chosen, members["city"] == chosen["commune"], "left_semi")
    return chosen.select("commune").unionByName(extra.select(F.col("member").alias("commune"))).distinct()

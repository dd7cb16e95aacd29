"""Headline figures and top lists over the dashboard datasets."""

from pyspark.sql import DataFrame, functions as F

from ..functions.labels import badges, label_position
from .quantiles import grouped_quantiles
from .serving import double_signal

TOP_ROWS = 20


def _summary(rows: DataFrame, medians: dict[str, str], others, **limits) -> DataFrame:
    """One row of figures; medians over any number of rows stay exact and distributed."""
    return grouped_quantiles(
        rows, [], {name: (column, 0.5) for name, column in medians.items()}, others=others, **limits
    )


def headline_kpis(market_rows: DataFrame, least: int, **limits) -> DataFrame:
    return _summary(
        market_rows,
        {"prix_m2_median": "prix_m2"},
        [
            F.count_distinct("commune").alias("communes"),
            F.avg("pct_passoires").alias("pct_passoires_moyen"),
            F.sum("nb_dpe").alias("nb_dpe"),
            F.avg("indice_sous_cotation").alias("sous_cotation_moyenne"),
            F.count_if(F.col("nb_dpe") >= least).alias("communes_fiables"),
            F.max("pct_passoires").alias("pct_passoires_max"),
        ],
        **limits,
    )


def energy_kpis(market_rows: DataFrame, **limits) -> DataFrame:
    return _summary(
        market_rows,
        {"conso_mediane": "conso_energie_med", "cout_median": "cout_energie_annuel_median"},
        [
            F.avg("pct_passoires").alias("pct_passoires_moyen"),
            F.avg("pct_ges_passoires").alias("pct_ges_moyen"),
            F.count_distinct("commune").alias("communes"),
            F.sum("nb_dpe").alias("nb_dpe"),
        ],
        **limits,
    )


def map_kpis(rows: DataFrame, **limits) -> DataFrame:
    """Rows, median price, mean share and volume: map, comparison and decision board figures."""
    return _summary(
        rows,
        {"prix_m2_median": "prix_m2"},
        [
            F.count("*").alias("lignes"),
            F.avg("pct_passoires").alias("pct_passoires_moyen"),
            F.sum("nb_dpe").alias("nb_dpe"),
        ],
        **limits,
    )


def opportunity_kpis(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count("*").alias("opportunites"),
        F.max("score_opportunite").alias("meilleur_score"),
        F.min("indice_sous_cotation").alias("ecart_min"),
        F.avg("pct_passoires").alias("pct_passoires_moyen"),
        F.count_if(F.col("etiquette_opportunite").contains("passoires")).alias("double_signal"),
    )


def featured(rows: DataFrame) -> DataFrame:
    return double_signal(rows)


def by_value(rows: DataFrame, column: str) -> DataFrame:
    """Greatest first, NULL last."""
    return rows.orderBy(F.desc_nulls_last(column))


def top_rows(rows: DataFrame, column: str, n: int = TOP_ROWS) -> DataFrame:
    """The ``n`` greatest known values; rows without a value never rank, ties go by commune."""
    known = rows.where(F.col(column).isNotNull())
    return known.orderBy(F.desc(column), F.asc_nulls_last("commune")).limit(n)


def dearest(market_rows: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return top_rows(market_rows, "prix_m2", n)


def costliest(market_rows: DataFrame, n: int = TOP_ROWS) -> DataFrame:
    return top_rows(market_rows, "cout_energie_annuel_median", n)


def leaders(opportunity_rows: DataFrame, n: int) -> DataFrame:
    """First rows of the opportunity order with their badges."""
    order = (
        F.desc_nulls_last("score_opportunite"),
        F.asc_nulls_last("indice_sous_cotation"),
        F.asc_nulls_last("commune"),
        F.asc_nulls_last("type_bien"),
    )
    first = opportunity_rows.orderBy(*order).limit(n)
    return first.withColumn("badges", badges(F.col("indice_sous_cotation"), F.col("pct_passoires")))


def signals(market_rows: DataFrame) -> DataFrame:
    """One row: the dearest commune and the one with the greatest share of sieves."""

    def best(column):
        # As in ``top_rows``: the greatest value, ties go to the first name.
        known = F.when(F.col(column).isNotNull(), F.struct(-F.col(column), F.col("commune").isNull(), F.col("commune")))
        first = F.min(F.struct(known.isNull().alias("none"), known.alias("known"), F.struct(column, "commune").alias("row")))
        return F.when(~first["none"], first["row"])

    return market_rows.agg(best("prix_m2").alias("_price"), best("pct_passoires").alias("_share")).select(
        F.col("_price.commune").alias("commune_plus_chere"),
        F.col("_price.prix_m2").alias("prix_m2_max"),
        F.col("_share.commune").alias("commune_renovation"),
        F.col("_share.pct_passoires").alias("pct_passoires_max"),
    )


def in_label_order(counts: DataFrame) -> DataFrame:
    return counts.orderBy("commune", label_position(F.col("etiquette")))

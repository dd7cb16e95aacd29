"""Area indicators, profiles against the parent area and the under-pricing detector."""

from pyspark.sql import DataFrame, Window as W, functions as F

from .. import fixed_values as V
from ..functions.labels import is_sieve, mart_wording, opportunity_score, underpriced
from ..functions.numbers import half_away, percent_gap, percent_true, ratio
from ..layout import ByArea
from ..storage import durable
from .joins import fresh, join_groups
from .quantiles import VALUE_LIMIT, grouped_quantiles, largest_group
from .ranking import rank_in_group

FLAG = "_sieve"


def flag_sieves(fact: DataFrame, scale: DataFrame) -> DataFrame:
    """Mark dwellings whose label counts as an energy sieve; unknown labels do not."""
    flags = scale.select("etiquette", F.coalesce("label_passoire", F.lit(False)).alias(FLAG))
    return fact.join(flags, "etiquette", "left").withColumn(FLAG, F.coalesce(FLAG, F.lit(False)))


def area_kpi(fact: DataFrame | ByArea, scale: DataFrame, ds: str, **limits) -> DataFrame:
    """Per area: median price, share of sieves, price discount of sieves, number of dwellings."""
    if isinstance(fact, ByArea):
        return fact.each(lambda part, **grouping: area_kpi(part, scale, ds, **{**limits, **grouping}))
    price = F.col("prix_m2")
    discount = percent_gap(F.avg(F.when(F.col(FLAG), price)), F.avg(F.when(~F.col(FLAG), price)))
    kpi = grouped_quantiles(
        flag_sieves(fact, scale).select("code_insee", "prix_m2", FLAG),
        ["code_insee"],
        {"prix_m2_median": ("prix_m2", 0.5)},
        others=[
            percent_true(F.col(FLAG)).alias("pct_passoires"),
            half_away(discount, 2).alias("decote_passoire_pct"),
            F.count("*").alias("nb_transactions"),
        ],
        # An area has at most six distinct prices per type.
        **{"gather": False, **limits},
    )
    return kpi.select(
        F.lit(ds).cast("date").alias("dt"),
        "code_insee",
        "prix_m2_median",
        "pct_passoires",
        "decote_passoire_pct",
        "nb_transactions",
    )


def parent_position(
    df: DataFrame,
    parent,
    value: str,
    gap: str,
    z: str,
    median: str | None = None,
    largest: int | None = None,
    limit: int = VALUE_LIMIT,
) -> DataFrame:
    """Add the percent gap to the parent median and the z-score among the rows of one parent.

    One plan at every size: mean, deviation and median of each parent are aggregated and joined back,
    so no task gathers a whole parent.  ``largest`` bounds the rows per parent where the caller knows it.
    """
    centre = median or fresh(df, "_median")
    mean, spread = fresh(df, "_mean"), fresh(df, "_spread")
    stats = grouped_quantiles(
        df.select(*parent, value),
        parent,
        {centre: (value, 0.5)},
        others=[F.avg(value).alias(mean), F.stddev_pop(value).alias(spread)],
        largest=largest,
        limit=limit,
    )
    with_stats = join_groups(df, stats, parent)
    x = F.col(value)
    placed = with_stats.withColumns(
        {
            z: half_away(ratio(x - F.col(mean), F.col(spread)), 3),
            gap: half_away(percent_gap(x, F.col(centre)), 1),
        }
    )
    return placed.drop(mean, spread, *([] if median else [centre]))


def area_summary(fact: DataFrame | ByArea, scale: DataFrame, **limits) -> DataFrame:
    """Per area: price, energy, cost and age indicators."""
    if isinstance(fact, ByArea):
        return fact.each(lambda part, **grouping: area_summary(part, scale, **{**limits, **grouping}))
    columns = ["prix_m2", "conso_energie", "emission_ges", "cout_energie_annuel",
               "annee_construction", "etiquette_ges"]
    return grouped_quantiles(
        flag_sieves(fact, scale).select("code_insee", FLAG, *columns),
        ["code_insee"],
        {
            "prix_m2_median": ("prix_m2", 0.5),
            "cout_energie_annuel_median": ("cout_energie_annuel", 0.5),
            "annee_construction_mediane": ("annee_construction", 0.5),
        },
        others=[
            F.count("*").alias("nb_dpe"),
            percent_true(F.col(FLAG)).alias("pct_passoires"),
            half_away(F.avg("conso_energie"), 1).alias("conso_energie_moy"),
            half_away(F.avg("emission_ges"), 1).alias("emission_ges_moy"),
            percent_true(is_sieve(F.col("etiquette_ges"))).alias("pct_ges_passoires"),
        ],
        **limits,
    )


def area_profile(
    fact: DataFrame | ByArea, scale: DataFrame, communes: DataFrame, parent_size: int | None = None, **limits
) -> DataFrame:
    """Named areas with their summary, gap, z-score and price rank inside the parent area.

    ``parent_size`` bounds the areas per parent; the dimension gives it without running the summary.
    """
    return profile_of_areas(area_summary(fact, scale, **limits), communes, parent_size)


def profile_of_areas(
    summary: DataFrame, communes: DataFrame, parent_size: int | None = None
) -> DataFrame:
    # Read several times from here on: by the statistics, the rows they join and the ranks.
    named = durable(summary.join(communes, "code_insee"))
    parent = ["departement"]
    if parent_size is None:
        parent_size = largest_group(named, parent)
    placed = parent_position(
        named, parent, "prix_m2_median", "indice_sous_cotation", "z_prix_dpt", largest=parent_size
    )
    ranked = rank_in_group(placed, parent, "prix_m2_median", "rang_prix_dpt", largest=parent_size)
    return ranked.select(
        "code_insee", "nom", "departement", "region", "population",
        "prix_m2_median", "nb_dpe", "pct_passoires", "conso_energie_moy", "emission_ges_moy",
        "cout_energie_annuel_median", "annee_construction_mediane", "pct_ges_passoires",
        (F.col("nb_dpe") >= V.MIN_CERTIFICATES).alias("fiable"),
        "indice_sous_cotation", "z_prix_dpt", "rang_prix_dpt",
    )


def area_type_summary(fact: DataFrame | ByArea, scale: DataFrame, **limits) -> DataFrame:
    """Per area and property type: price, sieves, cost and age."""
    if isinstance(fact, ByArea):
        return fact.each(lambda part, **grouping: area_type_summary(part, scale, **{**limits, **grouping}))
    keys = ["code_insee", "type_bien"]
    return grouped_quantiles(
        flag_sieves(fact, scale).select(
            *keys, FLAG, "prix_m2", "cout_energie_annuel", "annee_construction"
        ),
        keys,
        {
            "prix_m2_median": ("prix_m2", 0.5),
            "cout_energie_annuel_median": ("cout_energie_annuel", 0.5),
            "annee_construction_mediane": ("annee_construction", 0.5),
        },
        others=[
            F.count("*").alias("nb_dpe"),
            percent_true(F.col(FLAG)).alias("pct_passoires"),
        ],
        **limits,
    )


def area_type_profile(
    fact: DataFrame | ByArea, scale: DataFrame, communes: DataFrame, **limits
) -> DataFrame:
    """The summary per area and property type, with the area's names."""
    return profile_of_types(area_type_summary(fact, scale, **limits), communes)


def profile_of_types(summary: DataFrame, communes: DataFrame) -> DataFrame:
    names = communes.select("code_insee", "nom", "departement", "region")
    return summary.join(names, "code_insee").select(
        "code_insee", "type_bien", "prix_m2_median", "nb_dpe", "pct_passoires", "cout_energie_annuel_median",
        "annee_construction_mediane", "nom", "departement", "region",
    )


def opportunities(
    profile: DataFrame,
    k: float = V.MART_K,
    least: int = V.MIN_CERTIFICATES,
    parent_size: int | None = None,
) -> DataFrame:
    """Score every backed (area, type) against its parent area; flag those ``k`` deviations below.

    The z-score uses the mean, the percent gap the median of the parent.
    """
    backed = durable(profile.where(F.col("nb_dpe") >= least))
    placed = parent_position(
        backed,
        ["departement", "type_bien"],
        "prix_m2_median",
        "ecart_pct",
        "z",
        median="prix_m2_median_dpt",
        largest=parent_size,
    )
    flag = underpriced(F.col("z"), k)
    return placed.select(
        *profile.columns,
        "prix_m2_median_dpt",
        "z",
        "ecart_pct",
        flag.alias("est_opportunite"),
        opportunity_score(F.col("z"), F.col("pct_passoires")).alias("score_opportunite"),
        mart_wording(flag, F.col("pct_passoires")).alias("etiquette_opportunite"),
    )


def opportunity_count(mart: DataFrame) -> DataFrame:
    return mart.where("est_opportunite").agg(F.count("*").alias("nb_opportunites"))

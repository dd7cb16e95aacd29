"""Reference prices from sales, and dwellings priced by them."""

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.labels import band, property_type
from ..functions.numbers import half_away
from .quantiles import grouped_quantiles, largest_group

WHOLE_AREA = "*"
SHARES = {"prix_m2_p10": 0.10, "prix_m2_p25": 0.25, "prix_m2_median": 0.50, "prix_m2_p75": 0.75,
          "prix_m2_p90": 0.90}


def reference_prices(sales: DataFrame, largest: int | None = None, **limits) -> DataFrame:
    """Median unit price by (area, type, floor-area band), with band ``*`` for the whole area.

    Each sale is counted in its band and in ``*``, so one scan and one shuffle give both levels; counts
    of equal prices combine before it.
    """
    keys = ["code_insee", "type_bien"]
    usable = sales.where((F.col("prix_m2") > 0) & (F.col("surface") > 0))
    if largest is None:
        largest = largest_group(usable, keys)
    usable = usable.select(*keys, "surface", "prix_m2")
    levels = F.explode(F.array(band(F.col("surface")), F.lit(WHOLE_AREA))).alias("tranche_surface")
    return grouped_quantiles(
        usable.select(*keys, levels, "prix_m2"),
        [*keys, "tranche_surface"],
        {"prix_m2": ("prix_m2", 0.5)},
        largest=largest,
        gather=False,
        **limits,
    )


def band_prices(prices: DataFrame) -> DataFrame:
    return prices.where(F.col("tranche_surface") != WHOLE_AREA)


def area_prices(prices: DataFrame) -> DataFrame:
    return prices.where(F.col("tranche_surface") == WHOLE_AREA).drop("tranche_surface")


def price_card(prices: DataFrame) -> DataFrame:
    """One row per area holding its prices by type and band (at most six per type) as a map."""
    entry = F.struct(F.struct("type_bien", "tranche_surface"), "prix_m2")
    return prices.groupBy("code_insee").agg(F.map_from_entries(F.collect_list(entry)).alias("_prices"))


def dwellings(certificates: DataFrame) -> DataFrame:
    """Certificates of known positive area as typed, banded dwellings."""
    known = certificates.where(F.col("code_insee").isNotNull() & (F.col("surface_habitable") > 0))
    return known.select(
        "code_insee",
        F.col("etiquette_dpe").alias("etiquette"),
        property_type(F.col("type_batiment")).alias("type_bien"),
        band(F.col("surface_habitable")).alias("tranche_surface"),
        F.col("surface_habitable").alias("surface"),
        "etiquette_ges",
        "annee_construction",
        "conso_energie",
        "emission_ges",
        "cout_energie_annuel",
        "energie_chauffage",
        "date_etablissement",
    )


def known_only(df: DataFrame, communes: DataFrame, scale: DataFrame) -> DataFrame:
    """Rows whose area and label exist in the dimensions; the dimensions add no column."""
    return df.join(communes.select("code_insee"), "code_insee", "left_semi").join(
        scale.select("etiquette"), "etiquette", "left_semi"
    )


def price_dwellings(
    certificates: DataFrame, card: DataFrame, communes: DataFrame, scale: DataFrame, ds: str
) -> DataFrame:
    """The fact table: every known dwelling with the price of its band, else of its area.

    One join with the price card, by area alone, serves all types and both levels, and keeps a layout by
    area.  Pass a stored card: its size decides whether it is broadcast, and beyond that a hot area is
    split by adaptive execution.
    Dwellings of areas without sales keep a NULL price.
    """
    homes = known_only(dwellings(certificates), communes, scale)
    priced = homes.join(card, "code_insee", "left")
    of_band = F.try_element_at("_prices", F.struct("type_bien", "tranche_surface"))
    of_area = F.try_element_at("_prices", F.struct("type_bien", F.lit(WHOLE_AREA).alias("tranche_surface")))
    unit = F.coalesce(of_band, of_area)
    return priced.select(
        F.lit(ds).cast("date").alias("dt"),
        "code_insee",
        "etiquette",
        "type_bien",
        "tranche_surface",
        "surface",
        unit.alias("prix_m2"),
        (F.col("surface") * unit).alias("prix"),
        "etiquette_ges",
        "annee_construction",
        "conso_energie",
        "emission_ges",
        "cout_energie_annuel",
        "energie_chauffage",
        "date_etablissement",
    )


def price_distribution(
    sales: DataFrame, communes: DataFrame, largest: int | None = None, **limits
) -> DataFrame:
    """Unit price quantiles by (area, type) in whole units, where enough sales back them."""
    keys = ["code_insee", "type_bien"]
    usable = sales.where((F.col("prix_m2") > 0) & F.col("type_bien").isin(*V.PRICED_TYPES))
    spread = grouped_quantiles(
        usable.select(*keys, "prix_m2"),
        keys,
        {name: ("prix_m2", p) for name, p in SHARES.items()},
        others=[F.count("*").alias("nb_transactions")],
        largest=largest,
        **limits,
    ).where(F.col("nb_transactions") >= V.MIN_SALES)
    named = spread.join(communes, "code_insee")
    return named.select(
        *keys,
        "nom",
        "departement",
        "region",
        "nb_transactions",
        *[half_away(F.col(name)).alias(name) for name in SHARES],
    )

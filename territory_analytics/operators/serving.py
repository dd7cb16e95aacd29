"""Dashboard datasets: market, map, filter options, label distribution, opportunities, comparison."""

from pyspark.sql import DataFrame, functions as F

from .. import fixed_values as V
from ..functions.colours import feature_json, fill_colour, geometry, palette_of
from ..functions.labels import opportunity_score, raw_score, serving_wording
from ..functions.numbers import down_to_step, half_even
from ..clustering import Clustered
from ..storage import durable
from .filters import COMMUNES, DWELLINGS, TYPED, Filters, Grain, for_table, intervals, predicate
from .joins import fresh
from ..sources.tables import PartitionedTable
from .latest import latest_partition

COMPARED = ("prix_m2", "pct_passoires", "conso_energie_med", "indice_sous_cotation")
NORMALISED = ("prix_m2", "pct_passoires", "conso_energie_med")

_PLACE = ("latitude", "longitude", "geometry_json")


def _missing(kind: str, name: str):
    return F.lit(None).cast(kind).alias(name)


def with_place(mart: DataFrame, geo: DataFrame) -> DataFrame:
    return mart.join(geo.select("code_insee", *_PLACE), "code_insee", "left")


def market_view(mart_commune: DataFrame, geo: DataFrame) -> DataFrame:
    """Commune rows in the common dashboard shape; type is the all-types marker."""
    return with_place(mart_commune, geo).select(
        F.coalesce("nom", "code_insee").alias("commune"),
        "code_insee",
        "departement",
        "region",
        F.lit(V.ALL_TYPES).alias("type_bien"),
        _missing("string", "etiquette"),
        F.col("prix_m2_median").alias("prix_m2"),
        _missing("double", "surface"),
        "nb_dpe",
        "pct_passoires",
        F.col("conso_energie_moy").alias("conso_energie_med"),
        "emission_ges_moy",
        "cout_energie_annuel_median",
        "annee_construction_mediane",
        "pct_ges_passoires",
        "indice_sous_cotation",
        F.col("z_prix_dpt").alias("z"),
        _missing("double", "score_opportunite"),
        *_PLACE,
    )


def opportunity_view(mart_opportunites: DataFrame, geo: DataFrame) -> DataFrame:
    """(Commune, type) rows in the dashboard shape with their score and flag."""
    return with_place(mart_opportunites, geo).select(
        F.coalesce("nom", "code_insee").alias("commune"),
        "code_insee",
        "departement",
        "region",
        "type_bien",
        _missing("string", "etiquette"),
        F.col("prix_m2_median").alias("prix_m2"),
        _missing("double", "surface"),
        "nb_dpe",
        "pct_passoires",
        _missing("double", "conso_energie_med"),
        "cout_energie_annuel_median",
        "annee_construction_mediane",
        F.col("ecart_pct").alias("indice_sous_cotation"),
        "z",
        opportunity_score(F.col("z"), F.col("pct_passoires")).alias("score_opportunite"),
        *_PLACE,
        "est_opportunite",
    )


def market_rows(mart_commune: DataFrame, geo: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """Filtered communes in no order, which is what figures over them need."""
    return market_view(mart_commune, geo).where(predicate(for_table(filters, COMMUNES)))


def clustered_rows(table: Clustered, filters: Filters, grain: Grain) -> DataFrame:
    """Filtered rows of a clustered table, read from the files that can hold any."""
    own = for_table(filters, grain)
    return table.pick(intervals(own)).where(predicate(own))


def market(mart_commune: DataFrame, geo: DataFrame, filters: Filters = Filters()) -> DataFrame:
    """Filtered communes, dearest first."""
    return market_rows(mart_commune, geo, filters).orderBy(F.desc_nulls_last("prix_m2"))


def add_missing(df: DataFrame, name: str, kind: str) -> DataFrame:
    return df if name in df.columns else df.withColumn(name, F.lit(None).cast(kind))


def map_points(rows: DataFrame) -> DataFrame:
    """Rows that can be placed on the map."""
    return add_missing(rows, "geometry_json", "string").dropna(
        subset=["latitude", "longitude"]
    )


def metric_range(rows: DataFrame, metric: str) -> DataFrame:
    """One row (low, high): 0 to 1 without values, one unit wide for a constant."""
    value = F.col(metric).try_cast("double")
    ends = rows.where(value.isNotNull() & ~F.isnan(value)).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi")
    )
    low = F.coalesce("lo", F.lit(0.0))
    high = F.when(F.col("hi") > F.col("lo"), F.col("hi")).otherwise(low + 1.0)
    return ends.select(low.alias("low"), high.alias("high"))


def coloured(rows: DataFrame, metric: str) -> DataFrame:
    """Add the fill colour of every row; the range is a one-row scalar subquery."""
    ends = metric_range(rows, metric).select(F.struct("low", "high")).scalar()
    value = F.col(metric).try_cast("double")
    return rows.withColumn(
        "fill_color", fill_colour(value, ends["low"], ends["high"], palette_of(metric))
    )


def map_features(rows: DataFrame, metric: str) -> DataFrame:
    """One GeoJSON feature per row with a readable geometry; every column becomes a property."""
    shape = fresh(rows, "_geometry")
    shaped = coloured(rows, metric).withColumn(shape, geometry(F.col("geometry_json")))
    properties = F.struct(*rows.columns, "fill_color")
    return shaped.where(F.col(shape).isNotNull()).select(
        *rows.columns,
        "fill_color",
        feature_json(F.col(shape), properties).alias("feature"),
    )


def map_point_features(rows: DataFrame, metric: str) -> DataFrame:
    """Coloured points, the map's form when no row carries a geometry."""
    point = F.struct(
        F.lit("Point").alias("type"), F.array("longitude", "latitude").alias("coordinates")
    )
    properties = F.struct(*rows.columns, "fill_color")
    return coloured(rows, metric).select(
        *rows.columns, "fill_color", feature_json(point, properties).alias("feature")
    )


def map_layer(rows: DataFrame, metric: str) -> DataFrame:
    """Areas where at least one row has a geometry, points otherwise."""
    areas = map_features(rows, metric)
    return map_point_features(rows, metric) if areas.isEmpty() else areas


def map_centre(rows: DataFrame) -> DataFrame:
    latitude, longitude = V.DEFAULT_CENTRE
    return rows.agg(
        F.coalesce(F.avg("latitude"), F.lit(latitude)).alias("latitude"),
        F.coalesce(F.avg("longitude"), F.lit(longitude)).alias("longitude"),
    )


def _types(mart_commune_type: DataFrame) -> DataFrame:
    """Distinct known types; the default ones where the mart has none."""
    found = mart_commune_type.select("type_bien").where(F.col("type_bien").isNotNull()).distinct()
    default = found.sparkSession.createDataFrame([(t,) for t in V.DEFAULT_TYPES], "type_bien string")
    nothing = found.agg((F.count("*") == 0).alias("none")).scalar()
    return found.unionByName(default.where(nothing))


def present_types(mart_commune_type: DataFrame) -> DataFrame:
    return _types(mart_commune_type).orderBy("type_bien")


def slider_bounds(rows: DataFrame) -> DataFrame:
    """One row of slider ends: prices to the hundred, areas to the ten."""
    ends = rows.agg(
        F.min("prix_m2").alias("low"), F.max("prix_m2").alias("high"), F.max("surface").alias("area")
    )
    largest = (down_to_step(F.col("area"), V.AREA_STEP) + V.AREA_HEADROOM).cast("bigint")
    least = F.lit(V.AREA_SLIDER_LEAST).cast("bigint")
    return ends.select(
        F.greatest(F.lit(0).cast("bigint"), down_to_step(F.col("low"), V.PRICE_STEP).cast("bigint"))
        .alias("prix_m2_min"),
        (down_to_step(F.col("high"), V.PRICE_STEP) + V.PRICE_HEADROOM).cast("bigint")
        .alias("prix_m2_max"),
        F.lit(0).cast("bigint").alias("surface_min"),
        F.coalesce(F.greatest(least, largest), least).alias("surface_max"),
    )


def filter_choices(rows: DataFrame, mart_commune_type: DataFrame) -> DataFrame:
    """Every selectable value as a row (filter, value), sorted inside each filter."""
    places = rows.unpivot([], ["region", "departement", "commune"], "filtre", "valeur")
    types = _types(mart_commune_type).select(
        F.lit("type_bien").alias("filtre"), F.col("type_bien").alias("valeur")
    )
    scale = places.sparkSession.createDataFrame(
        [("etiquette", name) for name in V.LABELS], "filtre string, valeur string"
    )
    union = places.unionByName(types).unionByName(scale)
    return union.where(F.col("valeur").isNotNull()).distinct().orderBy("filtre", "valeur")


def filter_options(mart_commune: DataFrame, mart_commune_type: DataFrame, geo: DataFrame):
    """Choices and slider bounds over the whole market with any evidence."""
    rows = market_rows(mart_commune, geo, Filters(nb_dpe_min=1))
    return filter_choices(rows, mart_commune_type), slider_bounds(rows)


def label_counts(
    fact: DataFrame | PartitionedTable, communes: DataFrame, filters: Filters = Filters()
) -> DataFrame:
    """Dwellings by (commune, label) in the newest partition, which a partitioned table knows unread."""
    newest = fact.newest() if isinstance(fact, PartitionedTable) else latest_partition(fact)
    current = newest.select("code_insee", "type_bien", "etiquette")
    names = communes.select("code_insee", F.col("nom").alias("commune"), "departement", "region")
    named = current.join(names, "code_insee")
    return (
        named.where(predicate(for_table(filters, DWELLINGS)))
        .groupBy("commune", "etiquette")
        .agg(F.count("*").alias("nb"))
    )


def label_distribution(
    fact: DataFrame | PartitionedTable,
    communes: DataFrame,
    filters: Filters = Filters(),
    top_n: int = V.DISTRIBUTION_TOP_N,
) -> DataFrame:
    """Label counts of the ``top_n`` communes with most dwellings; ties go to the first name."""
    # Stored: the totals and the result both read the counts, which are as many as communes and labels.
    counts = durable(label_counts(fact, communes, filters))
    totals = counts.where(F.col("commune").isNotNull()).groupBy("commune").agg(F.sum("nb").alias("total"))
    top = totals.orderBy(F.desc("total"), "commune").limit(top_n).select("commune")
    return counts.join(top, "commune", "left_semi").orderBy("commune", "etiquette")


def pick_opportunities(rows: DataFrame, k: float, ordered: bool = True) -> DataFrame:
    """Rows ``k`` deviations below the parent or under its median, best score first if ``ordered``."""
    z = F.coalesce("z", F.lit(0.0))
    gap = F.coalesce("indice_sous_cotation", F.lit(0.0))
    score = F.col("score_opportunite").try_cast("double")
    filled = half_even(F.coalesce(score, raw_score(F.col("z"), F.col("pct_passoires"))), 1)
    kept = rows.where((z <= -k) | (gap < 0)).withColumns(
        {
            "score_opportunite": filled,
            "etiquette_opportunite": serving_wording(F.col("pct_passoires")),
        }
    )
    if not ordered:
        return kept
    return kept.orderBy(
        F.desc_nulls_last("score_opportunite"), F.asc_nulls_last("indice_sous_cotation")
    )


def serve_opportunities(
    mart_opportunites: DataFrame,
    mart_commune: DataFrame,
    geo: DataFrame,
    filters: Filters = Filters(),
    ordered: bool = True,
) -> DataFrame:
    """Filtered opportunities; the market stands in where the filters leave no scored row.

    Figures and top lists need no order of their own, so they ask for rows that are not ``ordered``.
    """
    rows = opportunity_view(mart_opportunites, geo).where(predicate(for_table(filters, TYPED)))
    if rows.isEmpty():
        rows = market_rows(mart_commune, geo, filters)
    return pick_opportunities(rows, filters.opportunite_k, ordered)


def double_signal(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("etiquette_opportunite").contains("passoires"))


def chosen_communes(rows: DataFrame, communes: tuple[str, ...]) -> DataFrame:
    """Rows of the chosen communes, all rows without a choice, by name."""
    kept = rows.where(F.col("commune").isin(*communes)) if communes else rows
    return kept.orderBy(F.asc_nulls_last("commune"))


def compare(
    mart_commune: DataFrame, geo: DataFrame, communes: tuple[str, ...] = (),
    filters: Filters = Filters(nb_dpe_min=1),
) -> DataFrame:
    return chosen_communes(market_rows(mart_commune, geo, filters), communes)


def compare_long(rows: DataFrame, metrics=COMPARED) -> DataFrame:
    """One row per (commune, indicator)."""
    typed = rows.select("commune", *[F.col(m).cast("double").alias(m) for m in metrics])
    return typed.unpivot("commune", list(metrics), "indicateur", "valeur")


def compare_normalised(rows: DataFrame, metrics=NORMALISED) -> DataFrame:
    """Indicators as shares of their greatest value (0 where that is 0), in long form.

    The greatest values are a scalar subquery, so no window over the whole table is needed.
    """
    greatest = rows.select(F.struct(*[F.max(m).cast("double").alias(m) for m in metrics])).scalar()

    def share(m):
        return F.when(greatest[m] == 0, 0.0).otherwise(F.col(m) / F.nullif(greatest[m], F.lit(0.0)))

    scaled = rows.select("commune", *[share(m).alias(m) for m in metrics])
    return scaled.unpivot("commune", list(metrics), "indicateur", "score_normalise")

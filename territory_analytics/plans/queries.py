"""Registered queries: every operator over the whole given tables."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import fixed_values as V, schemas
from ..clustering import write_clustered
from ..functions import casts, colours, labels, numbers
from ..operators import (
    cleaning, dimensions, geography, latest, pricing, profiles, quality, ranking, reports, sampling,
    serving,
)
from ..operators.filters import COMMUNES, TYPED, Filters, Grain, for_table, predicate
from ..operators.quantiles import grouped_quantiles, largest_group
from ..sinks import tables as sinks
from ..sinks.swap import Swap
from ..sources import drifting_parquet, pages, parts, tables as sources, text_files
from ..storage import discard, durable, remove, scratch_path
from ..streaming.refresh import refresh_silver
from . import incremental, standin as S
from .daily import Lake, run_day

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def registered(query):
    QUERIES[query.__name__] = lambda spark, sf: query(S.Tables(spark, sf))
    return query


def text_dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- Cleaning ----------------------------------------------------------------------------------


@registered
def keep_latest(t):
    events = t.given("events").select("event_id", "ts", "user_id", "event_type", "value")
    newest = latest.keep_latest(events, ["user_id", "event_type"], "ts", ["event_id"])
    return newest.select("user_id", "event_type", "event_id", "value")


@registered
def safe_casts(t):
    raw = t.raw_certificates
    return raw.groupBy(
        casts.number(F.col("surface_habitable_logement")).alias("surface"),
        casts.whole_number(F.col("annee_construction")).alias("annee"),
        casts.number(F.col("emission_ges_5_usages_par_m2")).alias("emission"),
        casts.calendar_date(F.col("date_etablissement_dpe")).isNull().alias("sans_date"),
    ).agg(F.count("*").alias("n"))


@registered
def clean_certificates(t):
    cleaned = cleaning.clean_certificates(t.raw_certificates, S.DS)
    return text_dates(cleaned, "dt", "date_etablissement")


@registered
def clean_sales(t):
    return text_dates(cleaning.clean_sales(t.raw_sales), "date_mutation")


@registered
def type_case(t):
    kind = labels.property_type(F.lower("type_local"))
    return t.raw_sales.groupBy(kind.alias("type_bien")).agg(F.count("*").alias("n"))


@registered
def area_band(t):
    area = t.certificates.groupBy(labels.band(F.col("surface_habitable")).alias("tranche"))
    return area.agg(
        F.count("*").alias("n"),
        F.min("surface_habitable").alias("surface_min"),
        F.max("surface_habitable").alias("surface_max"),
    )


@registered
def known_area_semi(t):
    scale = dimensions.label_scale(t.spark).where(~F.col("etiquette").isin("A"))
    homes = pricing.dwellings(t.certificates)
    known = pricing.known_only(homes, t.communes, scale)
    return known.groupBy("code_insee", "etiquette").agg(F.count("*").alias("n"))


# --- Prices ------------------------------------------------------------------------------------


@registered
def ref_price_band(t):
    return pricing.band_prices(t.prices)


@registered
def ref_price_fallback(t):
    return pricing.area_prices(t.prices)


@registered
def enriched_fact(t):
    return text_dates(t.fact, "dt", "date_etablissement")


@registered
def price_quantiles(t):
    return pricing.price_distribution(
        t.sales, t.communes, largest=t.area_bound
    )


@registered
def quantiles_by_counting(t):
    """The same quantiles forced through the counting plan that serves oversized groups."""
    return pricing.price_distribution(t.sales, t.communes, limit=200)


@registered
def exact_median_whole_table(t):
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    rows = t.given("lineitem").select(unit.alias("prix_m2"), "l_quantity")
    return grouped_quantiles(
        rows,
        [],
        {"prix_m2_median": ("prix_m2", 0.5), "surface_mediane": ("l_quantity", 0.5)},
        others=[F.count("*").alias("n")],
    )


# --- Indicators and marts ----------------------------------------------------------------------


@registered
def area_kpi(t):
    scale = dimensions.label_scale(t.spark)
    kpi = profiles.area_kpi(t.fact_by_area, scale, S.DS)
    return text_dates(kpi, "dt")


@registered
def discount_filtered_avg(t):
    flagged = profiles.flag_sieves(t.fact, dimensions.label_scale(t.spark))
    flag, price = F.col(profiles.FLAG), F.col("prix_m2")
    gap = numbers.percent_gap(F.avg(F.when(flag, price)), F.avg(F.when(~flag, price)))
    return flagged.groupBy("type_bien").agg(
        numbers.half_away(gap, 2).alias("decote_pct"),
        F.count_if(flag).alias("nb_passoires"),
        F.count("*").alias("nb"),
    )


@registered
def area_profile(t):
    return t.mart_commune


@registered
def area_type_profile(t):
    return t.mart_commune_type


def _area_prices(t):
    named = pricing.area_prices(t.prices).join(t.communes, "code_insee")
    return named.select("code_insee", "type_bien", "departement", "prix_m2")


@registered
def rank_in_parent(t):
    return ranking.rank_in_group(
        _area_prices(t), ["departement", "type_bien"], "prix_m2", "rang",
        largest=t.parent_bound,
    )


@registered
def rank_by_counting(t):
    """Line items ranked by price inside their shipping flag: three groups hold the whole table."""
    items = t.given("lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice"
    )
    return ranking.rank_in_group(items, ["l_returnflag"], "l_extendedprice", "rang", limit=1000)


def _placed(t):
    return profiles.parent_position(
        _area_prices(t), ["departement", "type_bien"], "prix_m2", "ecart_pct", "z",
        median="mediane_parent", largest=t.parent_bound,
    )


@registered
def zscore_in_parent(t):
    return _placed(t).select("code_insee", "type_bien", "z")


@registered
def gap_to_median(t):
    return _placed(t).select("code_insee", "type_bien", "mediane_parent", "ecart_pct")


@registered
def flagship_opportunities(t):
    return t.mart_opportunites


@registered
def opportunity_count(t):
    return profiles.opportunity_count(t.mart_opportunites)


# --- Quality -----------------------------------------------------------------------------------


@registered
def quality_counts(t):
    return quality.quality_gate(t.fact, quality.fact_rules())


@registered
def quality_counts_dirty(t):
    """The gate on unfiltered raw certificates, where every rule has something to count."""
    raw = t.raw_certificates.select(
        F.trim("code_insee_ban").alias("code_insee"),
        F.trim("etiquette_dpe").alias("etiquette"),
        F.lit("2999-01-01").cast("date").alias("dt"),
    )
    return quality.quality_gate(raw, quality.fact_rules(labels=("a", "b", "c", "d", "e", "f")))


# --- Serving -----------------------------------------------------------------------------------


def _dated(t):
    """Certificate-like rows in yearly partitions, from order dates."""
    year = F.date_trunc("year", "o_orderdate").cast("date")
    return t.given("orders").withColumn("dt", year)


def _homes(t):
    """Located dwellings in the dashboard's column names."""
    homes = pricing.dwellings(t.certificates)
    names = t.communes.select("code_insee", F.col("nom").alias("commune"), "departement", "region")
    return homes.join(names, "code_insee")


@registered
def filter_compile(t):
    chosen = Filters(
        regions=("NORD",),
        types_bien=("appartement", "maison"),
        etiquettes=("A", "F", "G"),
        passoires_only=True,
        surface_min=40,
        surface_max=120,
        nb_dpe_min=0,
    )
    kept = _homes(t).where(predicate(chosen))
    return kept.groupBy("commune", "type_bien", "etiquette").agg(F.count("*").alias("n"))


@registered
def market_view(t):
    return serving.market_view(t.mart_commune, t.geo)


def _market(t, filters=Filters()):
    return serving.market_rows(t.mart_commune, t.geo, filters)


@registered
def commune_grain(t):
    """Type, label and area filters are lifted for communes; the rest of the filter acts."""
    chosen = Filters(
        regions=("NORD",), types_bien=("maison",), etiquettes=("G",), surface_min=500,
        prix_m2_min=1000, prix_m2_max=4000,
    )
    return _market(t, chosen).select("commune", "departement", "region", "prix_m2", "nb_dpe")


@registered
def clustered_market(t):
    """The market clustered over region, area and price; the filters open only the cells they touch."""
    market = durable(serving.market_view(t.mart_commune, t.geo))
    cuts = {"region": 2, "code_insee": 4, "prix_m2": 4}
    table = write_clustered(market, scratch_path(t.spark, "market"), cuts, ["nb_dpe"], ["commune"])
    chosen = Filters(regions=("NORD",), prix_m2_min=1000, prix_m2_max=4000)
    kept = serving.clustered_rows(table, chosen, COMMUNES)
    return kept.select("commune", "departement", "region", "prix_m2", "nb_dpe")


@registered
def clustered_dwellings(t):
    """Dwellings clustered over region, area and living space, counted under the filters of all columns."""
    homes = durable(_homes(t))
    cuts = {"region": 2, "code_insee": 8, "surface": 8}
    table = write_clustered(homes, scratch_path(t.spark, "homes"), cuts, ["commune"], ["commune", "etiquette"])
    chosen = Filters(
        regions=("NORD",), types_bien=("appartement", "maison"), passoires_only=True,
        surface_min=40, surface_max=120, nb_dpe_min=0,
    )
    kept = serving.clustered_rows(table, chosen, Grain(frozenset(homes.columns), has_evidence=False))
    return kept.groupBy("commune", "type_bien", "etiquette").agg(F.count("*").alias("n"))


@registered
def opportunity_view(t):
    return serving.opportunity_view(t.mart_opportunites, t.geo)


@registered
def typed_grain(t):
    chosen = Filters(types_bien=("tous", "maison"), etiquettes=("G",), passoires_only=True)
    rows = serving.opportunity_view(t.mart_opportunites, t.geo)
    kept = rows.where(predicate(for_table(chosen, TYPED)))
    return kept.select("commune", "type_bien", "prix_m2", "nb_dpe")


@registered
def city_alias(t):
    """Choosing a region name also chooses its nations; customers of the chosen places."""
    region, nation = t.given("region"), t.given("nation")
    members = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("r_name").alias("city"), F.col("n_name").alias("member")
    )
    chosen = t.spark.createDataFrame([("ASIA",), ("EUROPE",), ("NATION_1",)], "commune string")
    names = dimensions.chosen_with_members(chosen, members)
    customer = t.given("customer")
    placed = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    kept = placed.join(names, placed["n_name"] == names["commune"], "left_semi")
    return kept.groupBy("n_name").agg(F.count("*").alias("n"))


def _opportunities(t, ordered=False):
    t.store("mart_opportunites")
    return serving.serve_opportunities(
        t.mart_opportunites, t.mart_commune, t.geo, S.DEALS, ordered
    )


@registered
def serve_opportunities(t):
    return _opportunities(t, ordered=True)


@registered
def serve_opportunities_fallback(t):
    """No scored row matches the type filter, so the market stands in."""
    t.store("mart_opportunites")
    chosen = Filters(types_bien=("chateau",), opportunite_k=0.5)
    return serving.serve_opportunities(
        t.mart_opportunites, t.mart_commune, t.geo, chosen
    )


@registered
def label_distribution_topn(t):
    return serving.label_distribution(t.dated_fact, t.communes, S.ENERGY)


@registered
def label_order(t):
    counts = serving.label_counts(t.fact, t.communes)
    place = labels.label_position(F.col("etiquette")).cast("bigint")
    return reports.in_label_order(counts).withColumn("place", place)


@registered
def filter_choices(t):
    rows = _market(t, Filters(nb_dpe_min=1))
    return serving.filter_choices(rows, t.mart_commune_type)


@registered
def filter_options(t):
    return serving.slider_bounds(_market(t, Filters(nb_dpe_min=1)))


@registered
def slider_bounds_areas(t):
    homes = _homes(t).withColumn("prix_m2", F.col("cout_energie_annuel"))
    return serving.slider_bounds(homes)


@registered
def present_types(t):
    return serving.present_types(t.mart_commune_type)


def _compared(t):
    rows = serving.market_view(t.mart_commune, t.geo)
    names = tuple(f"Supplier#{n:09d}" for n in (3, 4, 5, 7))
    return serving.chosen_communes(rows, names)


@registered
def default_types(t):
    """A typed mart without rows offers the default types."""
    return serving.present_types(t.mart_commune_type.where("type_bien = 'chateau'"))


@registered
def compare(t):
    return _compared(t).select(
        "commune", "prix_m2", "pct_passoires", "conso_energie_med", "indice_sous_cotation", "nb_dpe"
    )


@registered
def compare_long(t):
    return serving.compare_long(serving.market_view(t.mart_commune, t.geo))


@registered
def compare_normalised(t):
    t.store("mart_commune")
    rows = serving.market_view(t.mart_commune, t.geo)
    shares = serving.compare_normalised(rows)
    return shares.withColumn("score_normalise", numbers.half_away(F.col("score_normalise"), 6))


@registered
def headline_kpis(t):
    bound = t.communes.count()
    kpi = reports.headline_kpis(_market(t), V.MIN_CERTIFICATES, largest=bound)
    return _rounded(kpi, "pct_passoires_moyen", "sous_cotation_moyenne")


@registered
def energy_kpis(t):
    kpi = reports.energy_kpis(_market(t), largest=t.communes.count())
    return _rounded(kpi, "pct_passoires_moyen", "pct_ges_moyen")


@registered
def map_kpis(t):
    rows = serving.map_points(_market(t))
    return _rounded(reports.map_kpis(rows, largest=t.communes.count()), "pct_passoires_moyen")


@registered
def opportunity_kpis(t):
    return _rounded(reports.opportunity_kpis(_opportunities(t)), "pct_passoires_moyen")


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: numbers.half_away(F.col(n), 8) for n in names})


@registered
def signals(t):
    return reports.signals(_market(t))


@registered
def top_price(t):
    return reports.dearest(_market(t)).select("commune", "prix_m2", "departement")


@registered
def top_cost(t):
    return reports.costliest(_market(t)).select(
        "commune", "cout_energie_annuel_median", "pct_ges_passoires"
    )


@registered
def by_sieve_share(t):
    return reports.by_value(_market(t), "pct_passoires").select("commune", "pct_passoires")


@registered
def badges(t):
    rows = _opportunities(t)
    wording = labels.badges(F.col("indice_sous_cotation"), F.col("pct_passoires"))
    return rows.select("commune", "type_bien", wording.alias("badges"))


@registered
def leaderboard(t):
    return reports.leaders(_opportunities(t), 5).select(
        "commune", "departement", "type_bien", "prix_m2", "score_opportunite", "badges"
    )


@registered
def double_signal(t):
    return reports.featured(_opportunities(t)).select("commune", "type_bien", "score_opportunite")


@registered
def latest_partition(t):
    newest = latest.latest_partition(_dated(t))
    return text_dates(newest.select("o_orderkey", "o_orderpriority", "dt"), "dt")


# --- Map ---------------------------------------------------------------------------------------


@registered
def map_points(t):
    return serving.map_points(_market(t)).select("commune", "latitude", "longitude")


@registered
def metric_range(t):
    return serving.metric_range(_market(t), "prix_m2")


@registered
def map_centre(t):
    return _rounded(serving.map_centre(serving.map_points(_market(t))), "latitude", "longitude")


def _channels(colour: Column) -> list[Column]:
    return [colour[i].alias(name) for i, name in enumerate(("rouge", "vert", "bleu", "opacite"))]


@registered
def map_features(t):
    t.store("mart_commune")
    rows = serving.map_points(_market(t))
    features = serving.map_features(rows, "prix_m2")
    return features.select(
        "commune",
        *_channels(F.col("fill_color")),
        F.get_json_object("feature", "$.type").alias("genre"),
        F.get_json_object("feature", "$.geometry.type").alias("forme"),
        F.get_json_object("feature", "$.properties.commune").alias("nom_affiche"),
        F.get_json_object("feature", "$.properties.nb_dpe").cast("bigint").alias("nb_affiche"),
    )


@registered
def map_point_features(t):
    t.store("mart_commune")
    rows = serving.map_points(_market(t))
    features = serving.map_point_features(rows, "pct_passoires")
    coordinate = "$.geometry.coordinates[{}]"
    return features.select(
        "commune",
        *_channels(F.col("fill_color")),
        F.get_json_object("feature", coordinate.format(0)).cast("double").alias("lon"),
        F.get_json_object("feature", coordinate.format(1)).cast("double").alias("lat"),
    )


@registered
def map_opportunities(t):
    """Scored (commune, type) rows on the map, coloured by their score."""
    rows = serving.map_points(serving.opportunity_view(t.mart_opportunites, t.geo))
    layer = serving.map_layer(rows, "score_opportunite")
    return layer.select("commune", "type_bien", *_channels(F.col("fill_color")))


@registered
def map_layer_points(t):
    """Rows without a geometry column become points."""
    t.store("mart_commune")
    layer = serving.map_layer(serving.map_points(_market(t).drop("geometry_json")), "pct_passoires")
    coordinate = "$.geometry.coordinates[{}]"
    return layer.select(
        "commune",
        *_channels(F.col("fill_color")),
        F.get_json_object("feature", coordinate.format(0)).cast("double").alias("lon"),
        F.get_json_object("feature", coordinate.format(1)).cast("double").alias("lat"),
    )


@registered
def colour_of_every_sale(t):
    sold = t.sales.select("code_insee", "prix_m2")
    ends = V.UNIT_PRICE_RANGE
    colour = colours.fill_colour(
        F.col("prix_m2"), F.lit(float(ends[0])), F.lit(float(ends[1])), V.PALETTE_PRICE
    )
    red, green, blue, alpha = _channels(colour)
    return sold.groupBy(red, green, blue, alpha).agg(F.count("*").alias("n"))


# --- Dimensions and geography ------------------------------------------------------------------


def _commune_list(t, table, prefix, key, name, place):
    return t.given(table).selectExpr(
        f"concat(' ', {key}, '\t') AS code",
        f"{name} AS nom",
        f"CAST({place} AS STRING) AS codeDepartement",
        f"'{prefix}' AS codeRegion",
        f"CASE WHEN {place} = 7 THEN 'inconnue' ELSE CAST({key} * 10 AS STRING) END AS population",
    )


@registered
def dimension_tables(t):
    """Keys of all three dimensions built from two overlapping commune lists."""
    first = _commune_list(t, "supplier", "S", "s_suppkey", "s_name", "s_nationkey")
    second = _commune_list(t, "customer", "C", "c_custkey", "c_name", "c_nationkey")
    tables = dimensions.build_dimensions(t.spark, first, second)
    keys = [df.select(F.lit(name).alias("dimension"), F.col(df.columns[0]).alias("cle")) for name, df in tables.items()]
    return keys[0].unionByName(keys[1]).unionByName(keys[2])


@registered
def arrondissement_names(t):
    """Customers placed in the arrondissements; Lyon chosen as a whole, Paris by one of its parts."""
    placed = t.given("customer").selectExpr(
        "CAST(CASE c_nationkey % 3 WHEN 0 THEN 75101 + c_custkey % 20 WHEN 1 THEN 69381 + c_custkey % 9 "
        "ELSE 13201 + c_custkey % 16 END AS STRING) AS code_insee"
    )
    chosen = t.spark.createDataFrame([("Lyon",), ("Paris 2e Arrondissement",)], "commune string")
    members = dimensions.split_cities(t.spark)
    names = dimensions.chosen_with_members(chosen, members.select("city", "member"))
    named = placed.join(members, "code_insee").join(names, F.col("member") == F.col("commune"), "left_semi")
    return named.groupBy("member").agg(F.count("*").alias("n"))


@registered
def dim_union_first_wins(t):
    """Suppliers and customers share keys; the supplier list comes first and wins."""
    first = _commune_list(t, "supplier", "S", "s_suppkey", "s_name", "s_nationkey")
    second = _commune_list(t, "customer", "C", "c_custkey", "c_name", "c_nationkey")
    return dimensions.build_dim_commune(first, second)


def _payloads(t):
    """Suppliers as landed payloads: longitude first, a list without its second number, no centre."""
    text = (
        "CASE WHEN s_nationkey = 3 THEN '{\"centre\":null}' "
        "WHEN s_nationkey = 4 THEN '{\"centre\":{\"type\":\"Point\",\"coordinates\":[1.5]}}' "
        "ELSE concat('{\"centre\":{\"type\":\"Point\",\"coordinates\":[', s_suppkey % 14 - 5, '.5,', "
        "41 + s_suppkey % 10, '.25]},\"contour\":{\"type\":\"Polygon\"}}') END"
    )
    schema = "centre struct<type: string, coordinates: array<double>>, contour string"
    supplier = t.given("supplier").withColumn("payload", F.from_json(F.expr(text), schema))
    return supplier.select(
        F.col("s_suppkey").cast("string").alias("code"),
        F.col("s_name").alias("nom"),
        F.when(F.col("s_nationkey") < 20, F.col("s_nationkey").cast("string")).alias("departement"),
        "payload.centre",
        "payload.contour",
    )


@registered
def geo_payload(t):
    return geography.flatten_payload(_payloads(t))


def _centres(t):
    """Customers as fallback centres; their keys overlap the suppliers'."""
    return t.given("customer").selectExpr(
        "CAST(c_custkey AS STRING) AS code_insee",
        "c_name AS nom",
        "CAST(c_nationkey AS DOUBLE) AS latitude",
        "CAST(c_custkey % 180 AS DOUBLE) AS longitude",
        "CAST(NULL AS STRING) AS geometry_json",
        f"'{V.GEO_FALLBACK}' AS source",
    )


@registered
def geo_by_codes(t):
    codes = t.given("customer").select(F.col("c_custkey").cast("string").alias("code_insee"))
    return geography.geo_by_codes(codes, _payloads(t), _centres(t))


@registered
def geo_priority_union(t):
    nations = [str(n) for n in range(0, 10)]
    codes = t.given("customer").select(F.col("c_custkey").cast("string").alias("code_insee"))
    return geography.geo_by_departements(
        _payloads(t), nations, codes, _centres(t), with_contour=False
    )


# --- Sources and sinks -------------------------------------------------------------------------


@registered
def page_flatten(t):
    """Conversations landed as pages of at most four turns, then flattened again."""
    turns = t.given("conversations")
    page = F.floor(F.col("turn") / 4).cast("bigint")
    landed = turns.groupBy("conv_id", page.alias("page")).agg(
        F.collect_list(F.struct("turn", "role", "text")).alias("results")
    )
    path = scratch_path(t.spark, "pages")
    landed.write.json(path)
    schema = "page bigint, conv_id bigint, results array<struct<turn: bigint, role: string, text: string>>"
    stored = t.spark.read.schema(schema).json(path)
    rows = pages.page_rows(stored, ["turn", "role", "text"], partitions=("conv_id", "page"))
    return rows


@registered
def first_pages(t):
    turns = t.given("conversations").select(
        F.floor(F.col("turn") / 4).cast("bigint").alias("page"),
        F.col("conv_id"),
        F.array(F.struct("turn", "role")).alias("results"),
    )
    return pages.page_rows(turns, ["turn", "role"], max_pages=1, partitions=("conv_id",))


@registered
def cursor_parse(t):
    parsed = t.given("pages").select(
        "page_id", pages.cursor(F.col("url"), "page").alias("curseur")
    )
    return parsed


@registered
def page_set_status(t):
    """Line items of an order as its pages: gaps in the numbering make a set incomplete."""
    landed = t.given("lineitem").select(
        F.col("l_orderkey").alias("dep"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("page"),
        F.when(F.col("l_returnflag") != "R", F.lit("http://x.org/lines?after=c")).alias("next"),
        F.array(F.col("l_partkey")).alias("results"),
    )
    return pages.page_set_status(landed)


@registered
def page_chains(t):
    """Completeness of page sets from cursors alone, without page numbers.

    The lines of an order are its pages, each pointing to the next line number unless it was returned, so
    there are gaps and early ends; the customers are one long set.
    """
    line = t.given("lineitem").select(
        F.concat(F.lit("o"), F.col("l_orderkey")).alias("dep"),
        F.when(F.col("l_linenumber") > 1, F.col("l_linenumber").cast("string")).alias("own"),
        F.when(F.col("l_returnflag") != "R", (F.col("l_linenumber") + 1).cast("string")).alias("after"),
    )
    customer = t.given("customer")
    last = customer.agg(F.max("c_custkey")).first()[0]
    one = customer.select(
        F.lit("customers").alias("dep"),
        F.when(F.col("c_custkey") > 0, (F.col("c_custkey") + 1).cast("string")).alias("own"),
        F.when(F.col("c_custkey") < last, (F.col("c_custkey") + 2).cast("string")).alias("after"),
    )
    chains = pages.page_chains(line.unionByName(one), F.col("own"), F.col("after"))
    return pages.chain_status(chains)


@registered
def source_filter(t):
    raw = t.raw_certificates.select(
        F.trim("type_energie_principale_chauffage").alias("dep"),
        F.trim("code_postal_ban").alias("code_postal_ban"),
        F.trim("code_insee_ban").alias("code_insee_ban"),
    )
    kept = raw.where(text_files.source_filter(departement="F", code_insee="00007"))
    return kept.groupBy("dep", "code_insee_ban").agg(F.count("*").alias("n"))


@registered
def scope_errors(t):
    """Rows per scope of order statuses: a missing one is tolerated, a scope without any is an error."""
    path = scratch_path(t.spark, "scope")
    orders = t.given("orders").select("o_orderkey", F.col("o_orderstatus").alias("dep"))
    orders.write.partitionBy("dep").parquet(path)
    stored = sources.read_table(t.spark, path)
    rows = []
    for text in ("F, Z", "Z", "", "O,P"):
        try:
            found = text_files.in_scope(stored, text_files.scope_list(text)).count()
        except FileNotFoundError:
            found = None
        rows.append((text, found))
    return t.spark.createDataFrame(rows, "perimetre string, lignes bigint")


@registered
def business_dates(t):
    """The given date wins over upstream's, here that of the newest event; upstream's over today."""
    upstream = t.given("events").agg(F.max(F.to_date("ts")).cast("string")).first()[0]
    rows = [("donnee", sinks.business_date(S.DS, upstream)), ("amont", sinks.business_date(None, upstream))]
    return t.spark.createDataFrame(rows, "source string, jour string")


@registered
def written_codecs(t):
    """Compression of every column of every written file, from the footers."""
    path = scratch_path(t.spark, "codec")
    orders = t.given("orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("dep"))
    sinks.add_raw_parts(orders, f"{path}/raw", S.DS, ["F", "O", "P"])
    sinks.replace_partition(orders, f"{path}/table", S.DS)
    files = parts.list_files(t.spark, [path], "*.parquet")
    zone = F.regexp_extract("path", "/(raw|table)/", 1)
    return drifting_parquet.codecs(files).select(zone.alias("zone"), "codec").distinct()


@registered
def scoped_partitions(t):
    path = scratch_path(t.spark, "scope")
    orders = t.given("orders").select("o_orderkey", F.col("o_orderstatus").alias("dep"))
    orders.write.partitionBy("dep").parquet(path)
    scope = text_files.scope_list("", fallback=" F, O ,, Z")
    kept = text_files.in_scope(sources.read_table(t.spark, path), scope)
    return kept.select("o_orderkey", "dep")


@registered
def union_by_name_scan(t):
    """Events written as parts whose types and columns drift, read back as one text table."""
    path = scratch_path(t.spark, "parts")
    events = t.given("events")
    kinds = {
        "01": events.where("event_type IN ('click', 'view')").select("event_id", "user_id", "value"),
        "2A": events.where("event_type IN ('error')").select(
            F.col("event_id").cast("int"), F.col("user_id").cast("string")
        ),
        "33": events.where("coalesce(event_type NOT IN ('click', 'view', 'error'), true)").select(
            F.col("event_id").cast("string"), F.col("value").cast("string"), "user_id"
        ),
    }
    for dep, part in kinds.items():
        part.write.parquet(f"{path}/dt={S.DS}/dep={dep}")
    return drifting_parquet.read_text_parts(
        t.spark, path, ["event_id", "user_id", "value"], scope={"dt": [S.DS]}
    )


@registered
def tolerant_csv_scan(t):
    """Customers as gzip CSV with quoted commas, doubled quotes and broken lines."""
    path = scratch_path(t.spark, "csv")
    line = (
        "concat_ws(',', CAST(c_custkey AS STRING), concat('\"', c_name, ', \"\"', c_mktsegment, '\"\"\"'), "
        "CASE WHEN c_nationkey = 3 THEN 'one,field,too,many' WHEN c_nationkey = 5 THEN NULL "
        "ELSE lpad(c_nationkey, 5, '0') END)"
    )
    swapped = (
        "concat_ws(',', CASE WHEN c_nationkey = 3 THEN 'one,field,too,many' WHEN c_nationkey = 5 THEN NULL "
        "ELSE lpad(c_nationkey, 5, '0') END, concat('\"', c_name, ', \"\"', c_mktsegment, '\"\"\"'), "
        "CAST(c_custkey AS STRING))"
    )
    # Every file of the source opens with its header line; half of the files have another order.
    for header, text, rest in (
        ("code_commune,adresse,code", line, 0), ("code,adresse,code_commune", swapped, 1)
    ):
        body = t.given("customer").where(F.col("c_custkey") % 2 == rest).selectExpr(f"{text} AS value")
        with_header = body.select(F.concat(F.lit(f"{header}\n"), F.col("value")).alias("value"))
        writer = with_header.write.mode("append").option("compression", "gzip")
        writer.option("lineSep", "\n").text(path)
    rows = text_files.read_csv_text(t.spark, path)
    return rows.where("code_commune <> 'code_commune'").select("code_commune", "adresse", "code")


@registered
def json_array_scan(t):
    """Nations landed as one JSON array per region file."""
    path = scratch_path(t.spark, "json")
    nation = t.given("nation")
    body = nation.groupBy("n_regionkey").agg(
        F.to_json(F.collect_list(F.struct(
            F.col("n_nationkey").cast("string").alias("code"),
            F.col("n_name").alias("nom"),
            F.col("n_regionkey").cast("string").alias("codeRegion"),
        ))).alias("value")
    )
    body.write.partitionBy("n_regionkey").text(path)
    schema = "code string, nom string, codeRegion string"
    return text_files.read_json_array(t.spark, path, t.spark.createDataFrame([], schema).schema).select(
        "code", "nom", "codeRegion"
    )


@registered
def partition_scan(t):
    path = scratch_path(t.spark, "dated")
    _dated(t).select("o_orderkey", "o_totalprice", "dt").write.partitionBy("dt").parquet(path)
    day = sources.read_partition(t.spark, path, "1997-01-01")
    return day.select("o_orderkey", "o_totalprice")


@registered
def partition_replace(t):
    """Daily partitions; one day replaced by other rows, one by nothing, one by the same rows."""
    path = scratch_path(t.spark, "replace")
    events = t.given("events").withColumn("dt", F.to_date("ts"))
    rows = events.select("event_id", "event_type", "dt")
    rows.write.partitionBy("dt").parquet(path)

    def day(value):
        return rows.where(F.col("dt") == F.lit(value).cast("date"))

    errors = day("2024-01-03").where("event_type = 'error'")
    sinks.replace_partition(errors, path, "2024-01-03")
    sinks.replace_partition(day("2024-01-04").where("event_id < 0"), path, "2024-01-04")
    for _ in range(2):
        sinks.replace_partition(day("2024-01-05"), path, "2024-01-05")
    schema = t.spark.createDataFrame([], "event_id bigint, event_type string, dt date").schema
    return text_dates(sources.read_table(t.spark, path, schema), "dt")


@registered
def interrupted_replace(t):
    """Replacements that fail or stop half-way: a failing write keeps all old rows, a stored journal is settled.

    Of three partitions of orders one is replaced by a write that raises; the other two by a run that is
    lost after its journal, which the next replacement of a fourth partition carries out.
    """
    path = scratch_path(t.spark, "swap")
    orders = t.given("orders").select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias("dt"))
    for status in ("F", "O", "P"):
        sinks.replace_partition(orders.where(F.col("dt") == status), path, status)
    broken = F.when(F.col("o_orderkey") % 2 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("o_totalprice"))
    try:
        sinks.replace_partition(orders.withColumn("o_totalprice", broken), path, "P")
    except Exception as error:  # whatever a failing task surfaces as
        if "lost" not in str(error):
            raise
    lost = Swap(t.spark, path)
    for status in ("F", "O"):
        half = orders.where((F.col("dt") == status) & (F.col("o_orderkey") % 2 == 1)).drop("dt")
        lost.write(half, f"{path}/dt={status}")
    lost.commit()
    sinks.replace_partition(orders.where("o_orderkey <= 10"), path, "X")
    schema = t.spark.createDataFrame([], "o_orderkey bigint, o_totalprice double, dt string").schema
    stored = sources.read_table(t.spark, path, schema)
    return stored.groupBy("dt").agg(F.count("*").alias("n"), F.sum(F.col("o_orderkey")).alias("cles"))


@registered
def additive_parts(t):
    """Raw parts by order status: one status landed again in halves, the others untouched."""
    path = scratch_path(t.spark, "additive")
    orders = t.given("orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("dep")
    )
    sinks.add_raw_parts(orders, path, S.DS, ["F", "O", "P"], rows_per_part=1000)
    urgent = orders.where("o_orderpriority = '1-URGENT'")
    sinks.add_raw_parts(urgent.where("dep = 'F'"), path, S.DS, ["F", "X"], rows_per_part=1000)
    landed = t.spark.read.schema("o_orderkey bigint, o_orderpriority string, dep string").parquet(f"{path}/dt={S.DS}")
    per_file = landed.groupBy("dep", F.input_file_name().alias("file")).agg(F.count("*").alias("n"))
    return per_file.groupBy("dep").agg(
        F.sum("n").alias("lignes"), (F.max("n") <= 1000).alias("parts_bornees")
    )


@registered
def run_metrics(t):
    """Rows counted by the write itself, per status and in all."""
    path = scratch_path(t.spark, "metrics")
    orders = t.given("orders").select("o_orderkey", F.col("o_orderstatus").alias("dep"))
    written = sinks.add_raw_parts(orders, path, S.DS, ["F", "O", "P"])
    rows = [*written.items(), ("total", sum(written.values()))]
    return t.spark.createDataFrame(rows, "dep string, lignes bigint")


@registered
def exact_sample(t):
    orders = t.given("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return sampling.exact_sample(orders, 500, ["o_orderkey"], seed=7)


@registered
def snapshot_export(t):
    """Marts and a sample of the newest of two fact partitions; rows per exported table."""
    t.store("fact", "mart_commune_type")
    gold, out = scratch_path(t.spark, "gold"), scratch_path(t.spark, "snapshot")
    for day in ("2026-01-01", S.DS):
        sinks.replace_partition(t.fact, f"{gold}/fact_biens", day)
    marts = {
        "mart_commune": t.mart_commune,
        "mart_commune_type": t.mart_commune_type,
        "mart_opportunites": t.mart_opportunites,
        "dvf_stats_commune_type": pricing.price_distribution(t.sales, t.communes, largest=t.area_bound),
    }
    for name, mart in marts.items():
        sinks.replace_table(mart, f"{gold}/{name}")
    rows = sinks.export_snapshot(t.spark, gold, out, n=2000)
    return t.spark.createDataFrame(list(rows.items()), "nom string, lignes bigint")


# --- Whole runs --------------------------------------------------------------------------------


@registered
def daily_run(t):
    """Raw files to marts through the written tables; the opportunity mart comes back.

    Département 99 is in scope without data.
    """
    lake = Lake(scratch_path(t.spark, "lake"))
    certificates = t.raw_certificates.withColumn("dep", F.lit("01"))
    sinks.add_raw_parts(certificates, lake.at("raw", "dpe"), S.DS, ["01"])
    t.raw_sales.write.option("header", "true").option("compression", "gzip").csv(
        f"{lake.at('raw', 'dvf')}/dt={S.DS}/dep=01"
    )
    code = F.format_string("%05d", F.col("code_insee").cast("bigint"))
    known = t.communes.withColumn("code_insee", code)
    sinks.replace_table(known, lake.at("ref", "dim_commune"))
    sinks.replace_table(dimensions.label_scale(t.spark), lake.at("ref", "dim_dpe"))
    run_day(t.spark, lake, S.DS, departements=["01", "99"])
    return sources.read_table(
        t.spark, lake.at("gold", "mart_opportunites"), schemas.MART_OPPORTUNITES
    )


@registered
def incremental_marts(t):
    """The rows of the daily run in three waves; the opportunity mart comes back.

    Issues of one number arrive in different waves, so later waves replace what earlier ones added.
    """
    lake = Lake(scratch_path(t.spark, "lake"))
    packed = {"header": "true", "compression": "gzip", "maxRecordsPerFile": 500_000}
    t.raw_sales.write.options(**packed).csv(f"{lake.at('raw', 'dvf')}/dt={S.DS}/dep=01")
    code = F.format_string("%05d", F.col("code_insee").cast("bigint"))
    sinks.replace_table(t.communes.withColumn("code_insee", code), lake.at("ref", "dim_commune"))
    sinks.replace_table(dimensions.label_scale(t.spark), lake.at("ref", "dim_dpe"))
    incremental.open_day(t.spark, lake, S.DS)
    remove(t.spark, lake.at("raw", "dvf"))  # the day reads what it made of them
    certificates = t.raw_certificates
    wave = F.pmod(F.xxhash64(*certificates.columns), F.lit(3))
    for number in (0, 1, 2):
        # A wave lands when it comes, and goes when it is taken in.
        raw = durable(certificates.where(wave == number), compression="zstd")
        incremental.add_wave(t.spark, lake, S.DS, raw, most_waves=2)
        discard(raw)
    return sources.read_table(
        t.spark, lake.at("gold", "mart_opportunites"), schemas.MART_OPPORTUNITES
    )


@registered
def failed_gate(t):
    """A run dated in the future fails the gate; the indicators and marts of the day before stay."""
    lake = Lake(scratch_path(t.spark, "lake"))
    late = "2999-01-01"
    certificates = t.raw_certificates.withColumn("dep", F.lit("01"))
    sinks.add_raw_parts(certificates, lake.at("raw", "dpe"), late, ["01"])
    t.raw_sales.write.option("header", "true").csv(f"{lake.at('raw', 'dvf')}/dt={late}/dep=01")
    code = F.format_string("%05d", F.col("code_insee").cast("bigint"))
    sinks.replace_table(t.communes.withColumn("code_insee", code), lake.at("ref", "dim_commune"))
    sinks.replace_table(dimensions.label_scale(t.spark), lake.at("ref", "dim_dpe"))
    before = t.communes.select("code_insee", "population")
    sinks.replace_partition(before, lake.at("gold", "kpi_commune"), S.DS)
    sinks.replace_table(before, lake.at("gold", "mart_commune"))
    run_day(t.spark, lake, late, departements=["01"])
    kpi = sources.read_table(t.spark, lake.at("gold", "kpi_commune"))
    mart = sources.read_table(t.spark, lake.at("gold", "mart_commune"))
    return text_dates(kpi, "dt").join(mart.withColumnRenamed("population", "dans_mart"), "code_insee")


@registered
def stream_refresh(t):
    """Raw certificates arrive in two waves whose types and columns differ; each refreshes its dates.

    The last call finds nothing new and changes nothing.
    """
    root = scratch_path(t.spark, "stream")
    raw, silver, progress = f"{root}/raw", f"{root}/silver", f"{root}/progress"
    certificates = t.raw_certificates
    dated = certificates.withColumn(
        "dt", F.when(F.col("etiquette_ges").startswith("f"), "2026-06-17").otherwise(S.DS)
    ).withColumn("dep", F.lit("01"))
    flats = F.col("type_batiment").contains("Appartement")
    year = casts.whole_number(F.col("annee_construction"))
    drifted = dated.where(~flats).withColumn("annee_construction", year).drop("cout_total_5_usages")
    for wave in (dated.where(flats), drifted):
        wave.write.mode("append").partitionBy("dt", "dep").parquet(raw)
        refresh_silver(t.spark, raw, silver, progress)
    refresh_silver(t.spark, raw, silver, progress)
    rows = sources.read_table(t.spark, silver)
    return rows.groupBy(F.col("dt").cast("string").alias("dt"), "etiquette_dpe").agg(
        F.count("*").alias("n"), F.count("surface_habitable").alias("n_surface")
    )

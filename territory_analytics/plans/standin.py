"""The engine's tables played by a generic star schema (orders, parts, suppliers, events).

Line items are sales and dwellings, suppliers are communes, regions are the parent areas.  Prices and
areas are scaled by four, which leaves unit prices unchanged and fills every floor-area band.
"""

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from .. import schemas
from ..layout import ByArea, lay_out, read_by_area, replace_by_area
from ..operators import pricing, profiles
from ..operators.cleaning import plausible
from ..operators.dimensions import label_scale
from ..operators.filters import Filters
from ..operators.quantiles import largest_group
from ..sinks.tables import replace_partition
from ..sources.tables import PartitionedTable
from ..storage import durable, scratch_path

DS = "2026-06-18"
KIND = (
    "CASE WHEN p_type IN ('ECONOMY', 'STANDARD', 'SMALL') THEN 'Appartement' "
    "WHEN p_type IN ('MEDIUM', 'LARGE') THEN 'Maison' ELSE 'Immeuble' END"
)
LETTER = "substring('ABCDEFG', l_linenumber, 1)"
GES_LETTER = "CASE l_returnflag WHEN 'R' THEN 'F' WHEN 'A' THEN 'C' ELSE 'E' END"


TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string",
    "pages": "page_id bigint, url string, html string",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """The stand-in tables over one directory, each built once per query."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def store(self, *names: str) -> None:
        """Write the named tables and go on from the written ones, as the daily run does."""
        for name in names:
            setattr(self, name, durable(getattr(self, name)))

    def given(self, name: str) -> DataFrame:
        """A given table under its declared schema, so no footer is read to plan a query."""
        return self.spark.read.schema(TABLES[name]).parquet(f"{self.sf}/{name}.parquet")

    @cached_property
    def lines(self) -> DataFrame:
        """Line items with their part."""
        part, items = self.given("part"), self.given("lineitem")
        return items.join(part, items["l_partkey"] == part["p_partkey"])

    @cached_property
    def raw_sales(self) -> DataFrame:
        """Sales as text, with unsold areas, zero prices and unreadable numbers among them."""
        return self.lines.selectExpr(
            "CAST(l_suppkey AS STRING) AS code_commune",
            f"{KIND} AS type_local",
            "CASE WHEN l_tax = 0.08 THEN '95d' ELSE CAST(l_quantity * 4 AS STRING) END AS surface_reelle_bati",
            "CASE WHEN l_discount = 0.1 THEN '0' ELSE CAST(l_extendedprice * 4 AS STRING) END AS valeur_fonciere",
            "CASE WHEN l_linenumber = 7 THEN '2026' ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS date_mutation",
            "CAST(l_suppkey % 14 - 5 AS STRING) AS longitude",
            "CAST(41 + l_suppkey % 10 AS STRING) AS latitude",
        )

    @cached_property
    def sales(self) -> DataFrame:
        sold = self.lines.where("p_type <> 'PROMO'")
        return plausible(
            sold.selectExpr(
                "CAST(l_suppkey AS STRING) AS code_insee",
                f"lower({KIND}) AS type_bien",
                "l_quantity * 4 AS surface",
                "l_extendedprice * 4 AS prix",
                "(l_extendedprice * 4) / (l_quantity * 4) AS prix_m2",
                "CAST(l_shipdate AS DATE) AS date_mutation",
            )
        )

    @cached_property
    def raw_certificates(self) -> DataFrame:
        """Certificates as text: re-issued numbers, padded labels, missing and broken values."""
        return self.lines.selectExpr(
            "concat('D', l_orderkey, '-', l_linenumber) AS numero_dpe",
            "CASE WHEN l_discount = 0.09 THEN '2026-01' "
            "ELSE date_format(l_shipdate, 'yyyy-MM-dd') END AS date_etablissement_dpe",
            "CASE WHEN l_quantity = 13 THEN NULL ELSE format_string(' %05d', l_suppkey) END AS code_insee_ban",
            "concat(l_suppkey, '0 ') AS code_postal_ban",
            "concat(' Commune ', l_suppkey) AS nom_commune_ban",
            f"concat(' ', {KIND}) AS type_batiment",
            "CASE WHEN l_tax = 0.0 THEN NULL WHEN l_tax = 0.01 THEN '0' WHEN l_tax = 0.02 THEN 'abc' "
            "ELSE CAST(l_quantity * 4 AS STRING) END AS surface_habitable_logement",
            "CASE WHEN p_size = 50 THEN '' ELSE concat(1900 + p_size, '.6') END AS annee_construction",
            f"concat(' ', lower({LETTER}), ' ') AS etiquette_dpe",
            f"concat(lower({GES_LETTER}), ' ') AS etiquette_ges",
            "CAST(p_retailprice AS STRING) AS conso_5_usages_par_m2_ep",
            "CASE WHEN l_discount = 0.05 THEN '95f' ELSE CAST(l_quantity AS STRING) END AS emission_ges_5_usages_par_m2",
            "CAST(l_extendedprice AS STRING) AS cout_total_5_usages",
            "concat(' ', l_linestatus) AS type_energie_principale_chauffage",
        )

    @cached_property
    def certificates(self) -> DataFrame:
        return self.lines.selectExpr(
            "CAST(l_suppkey AS STRING) AS code_insee",
            f"{LETTER} AS etiquette_dpe",
            f"{GES_LETTER} AS etiquette_ges",
            f"lower({KIND}) AS type_batiment",
            "l_quantity * 4 AS surface_habitable",
            "CAST(1900 + p_size AS INT) AS annee_construction",
            "p_retailprice AS conso_energie",
            "l_quantity AS emission_ges",
            "l_extendedprice AS cout_energie_annuel",
            "lower(l_linestatus) AS energie_chauffage",
            "CAST(l_shipdate AS DATE) AS date_etablissement",
        )

    @cached_property
    def communes(self) -> DataFrame:
        """Suppliers in credit are the known communes, so some sales and dwellings fall outside."""
        supplier, nation = self.given("supplier"), self.given("nation")
        region = self.given("region")
        placed = supplier.join(nation, supplier["s_nationkey"] == nation["n_nationkey"]).join(
            region, nation["n_regionkey"] == region["r_regionkey"]
        )
        named = placed.where("s_acctbal > 0").selectExpr(
            "CAST(s_suppkey AS STRING) AS code_insee",
            "s_name AS nom",
            "r_name AS departement",
            "CASE WHEN r_regionkey < 3 THEN 'NORD' ELSE 'SUD' END AS region",
            "CAST(floor(s_acctbal) AS BIGINT) AS population",
        )
        # Stored, so that Spark knows its size and broadcasts it where it is small.
        return durable(named)

    @cached_property
    def geo(self) -> DataFrame:
        """Centres on a grid, some missing; geometries missing, empty, broken or whole."""
        return self.given("supplier").selectExpr(
            "CAST(s_suppkey AS STRING) AS code_insee",
            "s_name AS nom",
            "CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE CAST(41 + s_suppkey % 10 AS DOUBLE) END AS latitude",
            "CASE WHEN s_suppkey % 17 = 0 THEN NULL ELSE CAST(s_suppkey % 14 - 5 AS DOUBLE) END AS longitude",
            "CASE WHEN s_acctbal < 1000 THEN '{bad' WHEN s_acctbal < 2000 THEN '' "
            "WHEN s_acctbal < 3000 THEN NULL "
            "ELSE concat('{\"type\":\"Point\",\"coordinates\":[', s_suppkey % 14 - 5, ',', 41 + s_suppkey % 10, ']}') "
            "END AS geometry_json",
        )

    @cached_property
    def area_bound(self) -> int:
        """Most line items of one supplier: bounds every group of sales or dwellings by commune."""
        return largest_group(self.given("lineitem"), ["l_suppkey"])

    @cached_property
    def parent_bound(self) -> int:
        """Most communes of one region: bounds every group of areas by parent."""
        return largest_group(self.communes, ["departement"])

    @cached_property
    def prices(self) -> DataFrame:
        return pricing.reference_prices(self.sales, largest=self.area_bound)

    def priced(self, certificates: DataFrame) -> DataFrame:
        return pricing.price_dwellings(certificates, self.card, self.communes, label_scale(self.spark), DS)

    @cached_property
    def card(self) -> DataFrame:
        return durable(pricing.price_card(self.prices))

    @cached_property
    def fact(self) -> DataFrame:
        """For queries that read the fact once; marts read ``fact_by_area``."""
        return self.priced(self.certificates)

    @cached_property
    def dated_fact(self) -> PartitionedTable:
        """Stored by date, with an older partition of other rows beside the newest."""
        table = PartitionedTable(self.spark, scratch_path(self.spark, "fact"), schemas.FACT)
        replace_partition(self.fact, table.root, DS)
        replace_partition(table.at(DS).where("type_bien = 'maison'"), table.root, "2026-01-01")
        return table

    @cached_property
    def fact_by_area(self) -> ByArea:
        """Stored by area, as in the daily run."""
        root = scratch_path(self.spark, "fact")
        replace_by_area(lay_out(self.certificates).map(self.priced), root, DS)
        return read_by_area(self.spark, root, DS, schemas.FACT)

    @cached_property
    def mart_commune(self) -> DataFrame:
        return profiles.area_profile(
            self.fact_by_area,
            label_scale(self.spark),
            self.communes,
            parent_size=self.parent_bound,
        )

    @cached_property
    def mart_commune_type(self) -> DataFrame:
        return profiles.area_type_profile(self.fact_by_area, label_scale(self.spark), self.communes)

    @cached_property
    def mart_opportunites(self) -> DataFrame:
        return profiles.opportunities(self.mart_commune_type, parent_size=self.parent_bound)


# Filter sets the dashboard queries run with.
ENERGY = Filters(passoires_only=True)
DEALS = Filters(types_bien=("tous", "appartement", "maison"), opportunite_k=1.0)

"""Raw text tables to typed, filtered and deduplicated tables."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V
from ..functions.casts import calendar_date, number, whole_number
from ..functions.labels import property_type
from ..functions.numbers import ratio
from .latest import keep_latest


def text(name: str) -> Column:
    return F.trim(F.col(name).cast("string"))


def clean_certificates(raw: DataFrame, ds: str | None, ties=None) -> DataFrame:
    """Typed certificates of business date ``ds``, the newest issue of each number only.

    Without ``ds`` every row has the date of its partition ``dt``, and the newest issue of each date
    counts.  Rows without number, area code or label go, as do areas that are present but not a positive
    number; a missing area stays.
    """
    area = F.col("surface_habitable_logement").cast("string")
    usable = raw.dropna(subset=["numero_dpe", "code_insee_ban", "etiquette_dpe"]).where(
        area.isNull() | (number(area) > 0)
    )
    typed = usable.select(
        F.col("numero_dpe").cast("string").alias("numero_dpe"),
        (F.col("dt") if ds is None else F.lit(ds)).cast("date").alias("dt"),
        text("code_insee_ban").alias("code_insee"),
        text("code_postal_ban").alias("code_postal"),
        text("nom_commune_ban").alias("nom_commune"),
        F.lower(text("type_batiment")).alias("type_batiment"),
        number(area).alias("surface_habitable"),
        whole_number(text("annee_construction")).alias("annee_construction"),
        F.upper(text("etiquette_dpe")).alias("etiquette_dpe"),
        F.upper(text("etiquette_ges")).alias("etiquette_ges"),
        number(text("conso_5_usages_par_m2_ep")).alias("conso_energie"),
        number(text("emission_ges_5_usages_par_m2")).alias("emission_ges"),
        number(text("cout_total_5_usages")).alias("cout_energie_annuel"),
        F.lower(text("type_energie_principale_chauffage")).alias("energie_chauffage"),
        calendar_date(text("date_etablissement_dpe")).alias("date_etablissement"),
    )
    keys = ["numero_dpe"] if ds is not None else ["numero_dpe", "dt"]
    return keep_latest(typed, keys, "date_etablissement", ties)


def plausible(sales: DataFrame) -> DataFrame:
    """Positive price, an area worth a dwelling and a unit price inside the realistic range."""
    low, high = V.UNIT_PRICE_RANGE
    return sales.where(
        (F.col("prix") > 0)
        & (F.col("surface") >= V.SMALLEST_SOLD_AREA)
        & F.col("prix_m2").between(low, high)
    )


def clean_sales(raw: DataFrame, types=V.SALE_TYPES) -> DataFrame:
    """Typed plausible sales with their unit price; ``types`` is matched case-sensitively.

    The casts run behind a one-element ``inline``: guards pushed below a plain projection would
    parse price and area again for every comparison.
    """
    row = F.struct(
        F.lpad(text("code_commune"), V.CODE_WIDTH, "0").alias("code_insee"),
        property_type(F.lower("type_local")).alias("type_bien"),
        number(F.col("surface_reelle_bati")).alias("surface"),
        number(F.col("valeur_fonciere")).alias("prix"),
        calendar_date(F.col("date_mutation")).alias("date_mutation"),
        number(F.col("longitude")).alias("longitude"),
        number(F.col("latitude")).alias("latitude"),
    )
    typed = raw.where(F.col("type_local").isin(*types)).select(F.inline(F.array(row)))
    typed = typed.withColumn("prix_m2", ratio(F.col("prix"), F.col("surface")))
    return plausible(typed).select(
        "code_insee", "type_bien", "surface", "prix", "prix_m2", "date_mutation", "longitude", "latitude"
    )

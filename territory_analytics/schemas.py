"""Table schemas, one StructType per table."""

from pyspark.sql import types as T

from . import fixed_values as V


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "date": T.DateType(),
    "boolean": T.BooleanType(),
}


def _struct(spec: str) -> T.StructType:
    """Flat schema from "name type, name type", without needing a session."""
    pairs = [field.split() for field in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


def text_columns(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def with_columns(schema: T.StructType, spec: str) -> T.StructType:
    return T.StructType(schema.fields + _struct(spec).fields)


RAW_CERTIFICATE = text_columns(V.RAW_CERTIFICATE_COLUMNS)
RAW_SALE = text_columns(V.RAW_SALE_COLUMNS)

CERTIFICATE = _struct(
    "numero_dpe string, dt date, code_insee string, code_postal string, nom_commune string, "
    "type_batiment string, surface_habitable double, annee_construction int, etiquette_dpe string, "
    "etiquette_ges string, conso_energie double, emission_ges double, cout_energie_annuel double, "
    "energie_chauffage string, date_etablissement date"
)
SALE = _struct(
    "code_insee string, type_bien string, surface double, prix double, prix_m2 double, "
    "date_mutation date, longitude double, latitude double"
)
DIM_COMMUNE = _struct(
    "code_insee string, nom string, departement string, region string, population bigint"
)
DIM_LABEL = _struct("etiquette string, conso_min int, conso_max int, label_passoire boolean")
DIM_TYPE = _struct("type_bien string")
GEO_COMMUNE = _struct(
    "code_insee string, nom string, latitude double, longitude double, geometry_json string, "
    "source string"
)
FACT = _struct(
    "dt date, code_insee string, etiquette string, type_bien string, tranche_surface string, "
    "surface double, prix_m2 double, prix double, etiquette_ges string, annee_construction int, "
    "conso_energie double, emission_ges double, cout_energie_annuel double, "
    "energie_chauffage string, date_etablissement date"
)
KPI_COMMUNE = _struct(
    "dt date, code_insee string, prix_m2_median double, pct_passoires double, "
    "decote_passoire_pct double, nb_transactions bigint"
)
MART_COMMUNE = _struct(
    "code_insee string, nom string, departement string, region string, population bigint, "
    "prix_m2_median double, nb_dpe bigint, pct_passoires double, conso_energie_moy double, "
    "emission_ges_moy double, cout_energie_annuel_median double, "
    "annee_construction_mediane double, pct_ges_passoires double, fiable boolean, "
    "indice_sous_cotation double, z_prix_dpt double, rang_prix_dpt bigint"
)
MART_COMMUNE_TYPE = _struct(
    "code_insee string, type_bien string, prix_m2_median double, nb_dpe bigint, "
    "pct_passoires double, cout_energie_annuel_median double, annee_construction_mediane double, "
    "nom string, departement string, region string"
)
MART_OPPORTUNITES = with_columns(
    MART_COMMUNE_TYPE,
    "prix_m2_median_dpt double, z double, ecart_pct double, est_opportunite boolean, "
    "score_opportunite double, etiquette_opportunite string",
)
SALE_STATS = _struct(
    "code_insee string, type_bien string, nom string, departement string, region string, "
    "nb_transactions bigint, prix_m2_p10 double, prix_m2_p25 double, prix_m2_median double, "
    "prix_m2_p75 double, prix_m2_p90 double"
)

# One landed source page per JSON line; rows stay text because the source drifts in type.
CERTIFICATE_PAGE = T.StructType(
    [
        T.StructField("page", T.LongType()),
        T.StructField("results", T.ArrayType(RAW_CERTIFICATE)),
        T.StructField("next", T.StringType()),
    ]
)
COMMUNE_LIST = _struct(
    "code string, nom string, codeDepartement string, codeRegion string, population string"
)
CENTRE = T.StructType(
    [
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.ArrayType(T.DoubleType())),
    ]
)
# The contour stays JSON text.
GEO_PAYLOAD = T.StructType(
    _struct("code string, nom string, departement string").fields
    + [T.StructField("centre", CENTRE), T.StructField("contour", T.StringType())]
)

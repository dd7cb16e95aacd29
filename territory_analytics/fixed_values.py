"""Values the results depend on.

Everything here is a fixed value of the data model: column names, labels, thresholds, code ranges
and colours.  Operators take them as defaults, so another data set can pass its own.
"""

# --- Fixed values: raw certificate columns kept out of the wide source ------------------------
RAW_CERTIFICATE_COLUMNS = (
    "numero_dpe",
    "date_etablissement_dpe",
    "code_insee_ban",
    "code_postal_ban",
    "nom_commune_ban",
    "type_batiment",
    "surface_habitable_logement",
    "annee_construction",
    "etiquette_dpe",
    "etiquette_ges",
    "conso_5_usages_par_m2_ep",
    "emission_ges_5_usages_par_m2",
    "cout_total_5_usages",
    "type_energie_principale_chauffage",
)

# --- Fixed values: raw sale columns read by the cleaning job ----------------------------------
RAW_SALE_COLUMNS = (
    "code_commune",
    "type_local",
    "surface_reelle_bati",
    "valeur_fonciere",
    "date_mutation",
    "longitude",
    "latitude",
)

# --- Fixed values: label scale (label, lowest and highest consumption, energy sieve) -----------
LABEL_SCALE = (
    ("A", 0, 70, False),
    ("B", 71, 110, False),
    ("C", 111, 180, False),
    ("D", 181, 250, False),
    ("E", 251, 330, False),
    ("F", 331, 420, True),
    ("G", 421, 9999, True),
)
LABELS = ("A", "B", "C", "D", "E", "F", "G")
SIEVE_LABELS = ("F", "G")

# --- Fixed values: property types --------------------------------------------------------------
SALE_TYPES = ("Appartement", "Maison")
PROPERTY_TYPES = ("appartement", "maison", "autre")
PRICED_TYPES = ("appartement", "maison")
ALL_TYPES = "tous"

# --- Fixed values: floor-area bands ------------------------------------------------------------
AREA_EDGES = (40, 70, 100, 150)
AREA_BANDS = ("<40", "40-70", "70-100", "100-150", "150+")

# --- Fixed values: plausibility limits of a sale -----------------------------------------------
SMALLEST_SOLD_AREA = 9
UNIT_PRICE_RANGE = (200, 40000)
CODE_WIDTH = 5

# --- Fixed values: evidence and opportunity thresholds -----------------------------------------
MIN_CERTIFICATES = 30
MIN_SALES = 5
MART_K = 1.0
SERVING_K = 1.2
SIEVE_SHARE = 20
PRICE_WEIGHT = 0.6
SIEVE_WEIGHT = 0.4
Z_SCALE = 50
DISTRIBUTION_TOP_N = 25

# --- Fixed values: opportunity wording ---------------------------------------------------------
LABEL_RENOVATION = "sous-cotee + parc passoires (potentiel renovation)"
LABEL_UNDERPRICED = "sous-cotee"
LABEL_OVERPRICED = "survalorisee"
LABEL_DOUBLE_SIGNAL = "sous-cotee + parc passoires"
BADGE_SIEVES = "parc passoires"
BADGE_SEPARATOR = " · "

# --- Fixed values: cities split in arrondissements (city, first code, how many) ----------------
SPLIT_CITIES = (
    ("Paris", 75101, 20),
    ("Lyon", 69381, 9),
    ("Marseille", 13201, 16),
)

# --- Fixed values: centre points used when no payload was landed -------------------------------
FALLBACK_CENTRES = (
    ("33063", "Bordeaux", 44.8378, -0.5792),
    ("44109", "Nantes", 47.2184, -1.5536),
    ("35238", "Rennes", 48.1173, -1.6778),
    ("34172", "Montpellier", 43.6108, 3.8767),
    ("31555", "Toulouse", 43.6045, 1.4442),
    ("69123", "Lyon", 45.7578, 4.8320),
    ("13055", "Marseille", 43.2965, 5.3698),
    ("75101", "Paris 1er Arrondissement", 48.8626, 2.3363),
    ("75102", "Paris 2e Arrondissement", 48.8686, 2.3418),
)
GEO_SOURCE = "geo.api.gouv.fr"
GEO_FALLBACK = "fallback"

# --- Fixed values: map colours and default view ------------------------------------------------
PALETTE_PRICE = ((69, 117, 180), (244, 109, 67))
PALETTE_SIEVES = ((43, 131, 186), (215, 48, 39))
FILL_ALPHA = 185
NO_VALUE_COLOUR = (160, 166, 176, 150)
DEFAULT_CENTRE = (46.8, 2.4)

# --- Fixed values: slider bounds and output sizes ----------------------------------------------
PRICE_STEP = 100
PRICE_HEADROOM = 500
AREA_STEP = 10
AREA_HEADROOM = 20
AREA_SLIDER_LEAST = 150
ROWS_PER_PART = 50000
SNAPSHOT_ROWS = 500000

# --- Fixed values: time zone of the business date, property types where a mart has none ----------
BUSINESS_ZONE = "Europe/Paris"
DEFAULT_TYPES = ("appartement", "maison")

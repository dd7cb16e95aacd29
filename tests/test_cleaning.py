import csv
import datetime as dt

from conftest import rows
from territory_analytics import fixed_values as V, schemas
from territory_analytics.operators.cleaning import clean_certificates, clean_sales
from territory_analytics.sources.text_files import read_csv_text

DS = "2026-06-18"


def certificate(**given):
    blank = dict.fromkeys(V.RAW_CERTIFICATE_COLUMNS)
    return tuple({**blank, **given}[c] for c in V.RAW_CERTIFICATE_COLUMNS)


def certificates(spark, *given):
    return spark.createDataFrame([certificate(**g) for g in given], schemas.RAW_CERTIFICATE)


# Two issues of one certificate, and what the cleaned row must hold of the newer one.
NEWER = dict(numero_dpe="Z-77/b", code_insee_ban=" 2A004 ", code_postal_ban="20090", nom_commune_ban=" Ajaccio",
             type_batiment=" MAISON ", surface_habitable_logement="131.75", annee_construction="1999.6",
             etiquette_dpe="f ", etiquette_ges="g", conso_5_usages_par_m2_ep="377.5",
             emission_ges_5_usages_par_m2="9.25e1", cout_total_5_usages="-", date_etablissement_dpe="2023-11-30T10:00",
             type_energie_principale_chauffage="Fioul DOMESTIQUE")
EARLIER = {**NEWER, "surface_habitable_logement": "12", "etiquette_dpe": "A", "cout_total_5_usages": "8",
           "date_etablissement_dpe": "2023-9-30"}


def test_newest_issue_is_kept_and_typed(spark):
    out = clean_certificates(certificates(spark, NEWER, EARLIER), DS)
    assert out.columns == schemas.CERTIFICATE.names
    assert [f.dataType for f in out.schema] == [f.dataType for f in schemas.CERTIFICATE]
    (row,) = out.collect()
    assert row.asDict() == dict(
        numero_dpe="Z-77/b", dt=dt.date(2026, 6, 18), code_insee="2A004", code_postal="20090",
        nom_commune="Ajaccio", type_batiment="maison", surface_habitable=131.75, annee_construction=2000,
        etiquette_dpe="F", etiquette_ges="G", conso_energie=377.5, emission_ges=92.5,
        cout_energie_annuel=None, energie_chauffage="fioul domestique", date_etablissement=dt.date(2023, 11, 30),
    )


def test_areas(spark):
    base = {k: v for k, v in NEWER.items() if k != "surface_habitable_logement"}
    cases = [("none", None), ("nought", "0.0"), ("below", "-0.5"), ("words", "9 m2"), ("small", ".25"), ("power", "1e2")]
    raw = certificates(
        spark, *[{**base, "numero_dpe": n, "surface_habitable_logement": a} for n, a in cases]
    )
    kept = {r["numero_dpe"]: r["surface_habitable"] for r in clean_certificates(raw, DS).collect()}
    assert kept == {"none": None, "small": 0.25, "power": 100.0}


def test_required_columns(spark):
    raw = certificates(
        spark, NEWER, {**NEWER, "numero_dpe": None}, {**NEWER, "numero_dpe": "x", "etiquette_dpe": None}
    )
    assert rows(clean_certificates(raw, DS), "numero_dpe") == [("Z-77/b",)]


def test_missing_date_loses_and_ties_are_stable(spark):
    undated = {**NEWER, "date_etablissement_dpe": "soon", "cout_total_5_usages": "70000"}
    twin = {**NEWER, "cout_total_5_usages": "412.5"}
    forward = clean_certificates(certificates(spark, undated, NEWER, twin), DS)
    backward = clean_certificates(certificates(spark, twin, NEWER, undated), DS)
    assert rows(forward) == rows(backward)
    assert rows(forward, "cout_energie_annuel") == [(412.5,)]


def test_one_number_with_a_third_of_all_rows(spark):
    many = [{**NEWER, "numero_dpe": "hot", "cout_total_5_usages": str(i)} for i in range(300)]
    rest = [{**NEWER, "numero_dpe": f"n{i}"} for i in range(600)]
    out = clean_certificates(certificates(spark, *many, *rest), DS)
    assert out.count() == 601
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2, "one row per key must be kept before the shuffle"


def test_empty_input(spark):
    out = clean_certificates(certificates(spark), DS)
    assert out.columns == schemas.CERTIFICATE.names and out.count() == 0


# The guards' edges: unit price 200 to 40 000, at least nine square metres, listed types only.
SALES = [
    # code, type, area, price, date, longitude, latitude, address -> kept unit price
    ("2B033", "Maison", "9", "1800", "2019-12-31", "9.45", "42.7", 'quai "Sud"', 200.0),
    ("2B033", "Maison", "9", "1799.99", "2019-12-31", "9.45", "42.7", "x", None),
    ("971", "Appartement", "20.5", "820000", "2020-02-29", "", "16.2", "a, b, c", 40000.0),
    ("971", "Appartement", "20.5", "820000.5", "2020-02-29", "", "16.2", "x", None),
    ("97105", "Appartement", "8.9", "9000", "2020-01-01", "1", "1", "x", None),
    ("97105", "Local", "90", "90000", "2020-01-01", "1", "1", "x", None),
    ("97105", "MAISON", "90", "90000", "2020-01-01", "1", "1", "x", None),
    ("7", "Maison", "64", "96000", "2021-13-01", "east", "-5", "", 1500.0),
    ("7", "Maison", "", "96000", "2021-01-01", "1", "1", "x", None),
    ("7", "Maison", "64", "free", "2021-01-01", "1", "1", "x", None),
]
HEADER = ("code_commune", "type_local", "surface_reelle_bati", "valeur_fonciere", "date_mutation",
          "longitude", "latitude", "adresse")


def test_sales_guards(spark, tmp_path):
    order = [3, 7, 0, 5, 1, 6, 2, 4]
    for name, columns in (("a.csv", range(8)), ("b.csv", order)):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f)
            out.writerow([HEADER[k] for k in columns])
            out.writerows([[sale[k] for k in columns] for sale in SALES])
    cleaned = clean_sales(read_csv_text(spark, str(tmp_path)))
    assert cleaned.columns == schemas.SALE.names
    assert [f.dataType for f in cleaned.schema] == [f.dataType for f in schemas.SALE]
    kept = [(s[0].zfill(5), s[1].lower(), s[-1]) for s in SALES if s[-1]]
    assert rows(cleaned, "code_insee", "type_bien", "prix_m2") == sorted(kept * 2)
    far = cleaned.where("code_insee = '00007'").first()
    assert far["date_mutation"] is None and far["longitude"] is None and far["latitude"] == -5.0
    assert {r["date_mutation"] for r in cleaned.where("code_insee = '00971'").collect()} == {dt.date(2020, 2, 29)}


def test_range_ends_and_case(spark):
    def sale(kind, area, price):
        return ("44109", kind, area, price, "2022-07-14", "0", "0")

    raw = spark.createDataFrame(
        [sale("Maison", "10", "2000"), sale("Maison", "10", "400000"), sale("Maison", "10", "1999"),
         sale("Maison", "10", "400001"), sale("maison", "10", "3000"), sale("Maison", "9", "9000"),
         sale("Maison", "8.99", "9000"), sale("Maison", "0", "9000"), sale("Maison", None, "9000"),
         sale(None, "10", "3000")],
        schemas.RAW_SALE,
    )
    assert rows(clean_sales(raw), "surface", "prix") == [(10.0, 2000.0), (10.0, 400000.0), (9.0, 9000.0)]

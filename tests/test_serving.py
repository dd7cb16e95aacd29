import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from territory_analytics import fixed_values as V, schemas
from territory_analytics.operators import reports, serving
from territory_analytics.operators.filters import (
    COMMUNES, DWELLINGS, TYPED, Filters, for_table, predicate,
)

VIEW = ("commune string, code_insee string, departement string, region string, type_bien string, "
        "etiquette string, prix_m2 double, surface double, nb_dpe bigint, pct_passoires double, "
        "conso_energie_med double, indice_sous_cotation double, z double, score_opportunite double, "
        "latitude double, longitude double, geometry_json string")
POLYGON = '{"type":"Polygon","coordinates":[[[0,0],[1,0],[1,1],[0,0]]]}'


def place(name, price=3000.0, share=10.0, gap=0.0, z=0.0, n=50, lat=44.0, lon=0.5, geometry=None,
          label=None, kind="tous", surface=None, region="75", dep="33", energy=200.0):
    return (name, f"c{name}", dep, region, kind, label, price, surface, n, share, energy, gap, z, None, lat, lon,
            geometry)


def view(spark, *places):
    return spark.createDataFrame(list(places), VIEW)


def names(df):
    return [r["commune"] for r in df.collect()]


def test_predicate_filters(spark):
    df = view(
        spark, place("A", label="F", surface=50.0), place("B", label="C", surface=50.0),
        place("C", label="G", surface=500.0), place("D", label="G", surface=50.0, price=9000.0),
        place("E", label="G", surface=50.0, n=10), place("F", label="G", surface=50.0, region="11"),
    )
    chosen = Filters(regions=("75",), passoires_only=True, prix_m2_min=1000, prix_m2_max=5000, surface_min=20,
                     surface_max=120)
    assert names(df.where(predicate(chosen))) == ["A"]
    assert names(df.where(predicate(Filters(nb_dpe_min=0)))) == list("ABCDEF")
    assert names(df.where(predicate(Filters()))) == list("ABCDF")
    assert names(df.where(predicate(Filters(departements=("44",))))) == []
    assert names(df.where(predicate(Filters(communes=("A", "B"), etiquettes=("C",))))) == ["B"]


def test_hostile_text_is_a_value(spark):
    df = view(spark, place("Sète"))
    hostile = Filters(communes=('Sète") OR (true) /*', "Sète'); --"))
    assert names(df.where(predicate(hostile))) == []


def test_grains():
    full = Filters(communes=("Lyon",), types_bien=("tous", "maison"), etiquettes=("A",), passoires_only=True,
                   prix_m2_min=1, prix_m2_max=2, surface_min=3, surface_max=4, nb_dpe_min=7)
    commune, typed, dwelling = (for_table(full, grain) for grain in (COMMUNES, TYPED, DWELLINGS))
    assert commune.types_bien == () and typed.types_bien == dwelling.types_bien == ("maison",)
    for grain in (commune, typed):
        assert grain.etiquettes == () and not grain.passoires_only
        assert grain.surface_min is grain.surface_max is None
        assert (grain.prix_m2_min, grain.prix_m2_max, grain.nb_dpe_min) == (1, 2, 7)
    assert dwelling.etiquettes == ("A",) and dwelling.passoires_only
    assert dwelling.prix_m2_min is dwelling.prix_m2_max is dwelling.surface_max is None
    assert dwelling.nb_dpe_min == 0
    assert all(g.communes == ("Lyon",) for g in (commune, typed, dwelling))
    assert for_table(Filters(types_bien=("tous",)), TYPED).types_bien == ()


def test_city_members(spark):
    named = ["Nice", "Paris", "Paris 1er Arrondissement", "Paris 20e Arrondissement", "Marseille 2e Arrondissement", None]
    table = spark.createDataFrame([(n,) for n in named], "commune string")
    kept = lambda *names: {r[0] for r in table.where(predicate(Filters(communes=names, nb_dpe_min=0))).collect()}
    assert kept("Nice") == {"Nice"} and kept("Paris") == set(named[1:4])
    assert kept("Nice", "Marseille") == {"Nice", "Marseille 2e Arrondissement"}
    assert kept("Paris 20e Arrondissement") == {"Paris 20e Arrondissement"}


MART = [("1", "Un", "33", "75", 10, 3000.0, 40, 10.0, 200.0, 20.0, 1000.0, 1980.0, 5.0, True, -5.0, -1.0, 2),
        ("2", None, "33", "75", 10, 4000.0, 50, 30.0, 210.0, 20.0, None, 1980.0, 5.0, True, 5.0, 1.0, 1),
        ("3", "Trois", "33", "75", 10, None, 60, 30.0, 0.0, 20.0, 900.0, 1980.0, 5.0, True, None, None, 3),
        ("4", "Peu", "33", "75", 10, 9000.0, 4, 30.0, 0.0, 20.0, 900.0, 1980.0, 5.0, False, 9.0, None, 3)]
GEO = [("1", "Un", 44.0, 0.5, POLYGON, "x"), ("2", "Deux", None, None, None, "x"), ("3", "Trois", 46.0, 1.5, "{bad", "x")]


@pytest.fixture
def mart(spark):
    return spark.createDataFrame(MART, schemas.MART_COMMUNE)


@pytest.fixture
def geo(spark):
    return spark.createDataFrame(GEO, schemas.GEO_COMMUNE)


def test_market(mart, geo):
    rows_ = serving.market(mart, geo)
    assert names(rows_) == ["2", "Un", "Trois"]
    assert len(rows_.columns) == 21
    first = rows_.first()
    assert first["type_bien"] == "tous" and first["etiquette"] is None and first["latitude"] is None


def test_map(mart, geo):
    points = serving.map_points(serving.market(mart, geo))
    assert names(points) == ["Un", "Trois"]
    assert rows(serving.metric_range(points, "prix_m2")) == [(3000.0, 3001.0)]
    assert rows(serving.metric_range(points.limit(0), "prix_m2")) == [(0.0, 1.0)]
    features = serving.map_features(points, "prix_m2").collect()
    assert [f["commune"] for f in features] == ["Un"]
    feature = json.loads(features[0]["feature"])
    assert feature["type"] == "Feature" and feature["geometry"] == json.loads(POLYGON)
    assert feature["properties"]["commune"] == "Un" and feature["properties"]["etiquette"] is None
    assert feature["properties"]["fill_color"] == [69, 117, 180, 185]
    assert rows(serving.map_centre(points)) == [(45.0, 1.0)]
    assert rows(serving.map_centre(points.limit(0))) == [V.DEFAULT_CENTRE]
    assert serving.map_layer(points, "prix_m2").count() == 1
    bare = points.withColumn("geometry_json", F.lit(None).cast("string"))
    layer = serving.map_layer(bare, "pct_passoires").collect()
    assert json.loads(layer[0]["feature"])["geometry"] == {"type": "Point", "coordinates": [0.5, 44.0]}
    assert serving.map_points(points.drop("geometry_json")).columns[-1] == "geometry_json"


def test_bad_geometries_are_skipped(spark):
    texts = [None, "", "{bad", '{"type":"MultiPolygon","coordinates":[]}']
    df = view(spark, *[place(str(i), geometry=g) for i, g in enumerate(texts)])
    assert names(serving.map_features(df, "prix_m2")) == ["3"]


def test_filter_options(spark, mart, geo):
    types = spark.createDataFrame([("maison",), (None,), ("appartement",), ("maison",)], "type_bien string")
    choices, bounds = serving.filter_options(mart, types, geo)
    got = choices.collect()
    assert [r["valeur"] for r in got if r["filtre"] == "commune"] == ["2", "Peu", "Trois", "Un"]
    assert [r["valeur"] for r in got if r["filtre"] == "type_bien"] == ["appartement", "maison"]
    assert [r["valeur"] for r in got if r["filtre"] == "etiquette"] == list("ABCDEFG")
    assert rows(bounds) == [(3000, 9500, 0, 150)]
    assert [r[0] for r in serving.present_types(types).collect()] == ["appartement", "maison"]


def test_bounds_step(spark):
    df = view(spark, place("A", price=250.0, surface=151.0), place("B", price=3456.0))
    assert rows(serving.slider_bounds(df)) == [(200, 3900, 0, 170)]
    assert rows(serving.slider_bounds(df.limit(0))) == [(0, None, 0, 150)]


def deals(spark):
    return view(
        spark, place("A", share=25.0, gap=-12.0, z=-1.4), place("B", share=5.0, gap=4.0, z=0.2),
        place("C", share=None, gap=None, z=-1.0), place("D", share=20.0, gap=-1.0, z=None),
        place("E", share=None, gap=None, z=None),
    )


def test_opportunities_are_filtered_scored_and_ordered(spark):
    out = serving.pick_opportunities(deals(spark), 1.0).collect()
    assert [(r["commune"], r["score_opportunite"], r["etiquette_opportunite"]) for r in out] == [
        ("A", 52.0, V.LABEL_DOUBLE_SIGNAL), ("C", 30.0, V.LABEL_UNDERPRICED), ("D", 8.0, V.LABEL_DOUBLE_SIGNAL)]


def test_serving_falls_back_to_the_market(spark, mart, geo):
    empty = spark.createDataFrame([], schemas.MART_OPPORTUNITES)
    out = serving.serve_opportunities(empty, mart, geo, Filters(opportunite_k=1.0))
    assert names(out) == ["Un"]


def test_comparison(spark):
    df = view(spark, place("B", price=2000.0), place("A", price=1000.0, share=0.0), place(None))
    assert names(serving.chosen_communes(df, ("B",))) == ["B"]
    assert names(serving.chosen_communes(df, ())) == ["A", "B", None]
    long = serving.compare_long(df.where("commune = 'A'"))
    assert rows(long) == sorted([("A", "prix_m2", 1000.0), ("A", "pct_passoires", 0.0),
                                 ("A", "conso_energie_med", 200.0), ("A", "indice_sous_cotation", 0.0)], key=repr)
    flat = df.where("commune IN ('A', 'B')").withColumn("conso_energie_med", F.lit(0.0))
    shares = {(r[0], r[1]): r[2] for r in serving.compare_normalised(flat).collect()}
    assert shares[("A", "prix_m2")] == 0.5 and shares[("B", "prix_m2")] == 1.0
    assert shares[("A", "conso_energie_med")] == 0.0


def test_label_distribution(spark):
    fact = spark.createDataFrame(
        [("2026-01-01", "1", "maison", "G")] * 9 + [("2026-02-01", "1", "maison", "G")] * 2
        + [("2026-02-01", "1", "appartement", "A")] + [("2026-02-01", "2", "maison", "F")] * 2
        + [("2026-02-01", "3", "maison", "A")],
        "dt string, code_insee string, type_bien string, etiquette string").withColumn("dt", F.col("dt").cast("date"))
    dims = spark.createDataFrame([(c, f"N{c}", "33", "75", 1) for c in "123"], schemas.DIM_COMMUNE)
    out = serving.label_distribution(fact, dims, Filters(), top_n=2).collect()
    assert [tuple(r) for r in out] == [("N1", "A", 1), ("N1", "G", 2), ("N2", "F", 2)]
    sieves = serving.label_counts(fact, dims, Filters(passoires_only=True, types_bien=("tous", "maison")))
    assert rows(sieves) == [("N1", "G", 2), ("N2", "F", 2)]
    assert [r["etiquette"] for r in reports.in_label_order(serving.label_counts(fact, dims)).collect()] == list("AGFA")


def test_reports(spark):
    df = view(spark, place("A", price=1000.0, share=30.0), place("B", price=None, share=10.0, n=10),
              place("C", price=3000.0, share=None), place("D", price=3000.0, share=20.0))
    # Column order: named figures, medians last.
    kpi = reports.headline_kpis(df, 30).first()
    assert (kpi["communes"], kpi["prix_m2_median"], kpi["pct_passoires_moyen"], kpi["nb_dpe"],
            kpi["communes_fiables"]) == (4, 3000.0, 20.0, 160, 3)
    assert names(reports.dearest(df, 2)) == ["C", "D"]
    assert names(reports.by_value(df, "pct_passoires")) == ["A", "D", "B", "C"]
    best = reports.signals(df).first()
    assert (best["commune_plus_chere"], best["commune_renovation"]) == ("C", "A")
    picked = serving.pick_opportunities(deals(spark), 1.0)
    figures = reports.opportunity_kpis(picked).first()
    assert (figures["opportunites"], figures["meilleur_score"], figures["ecart_min"], figures["double_signal"]) == (
        3, 52.0, -12.0, 2)
    assert [(r["commune"], r["badges"]) for r in reports.leaders(picked, 2).collect()] == [
        ("A", "sous-cotee · parc passoires"), ("C", "")]
    assert names(reports.featured(picked)) == ["A", "D"]
    assert reports.map_kpis(df).first()["lignes"] == 4
    assert reports.map_kpis(df, limit=1).first()["prix_m2_median"] == 3000.0

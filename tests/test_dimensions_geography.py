from conftest import rows
from territory_analytics import fixed_values as V, schemas
from territory_analytics.operators import dimensions, geography


def commune_list(spark, *given):
    return spark.createDataFrame(list(given), schemas.COMMUNE_LIST)


def test_first_list_wins(spark):
    first = commune_list(spark, (" 33063\t", "Bordeaux", "33 ", " 75", "260000"), ("01004", "Amberieu", "01", "84", "x"))
    second = commune_list(spark, ("33063", "Autre", "99", "99", "1"), ("75101", "Paris 1er", "75", "11", None))
    dims = dimensions.build_dim_commune(first, second)
    assert dims.columns == schemas.DIM_COMMUNE.names
    assert rows(dims) == [("01004", "Amberieu", "01", "84", None), ("33063", "Bordeaux", "33", "75", 260000),
                          ("75101", "Paris 1er", "75", "11", None)]
    built = dimensions.build_dimensions(spark, first, second)
    assert {k: v.count() for k, v in built.items()} == {"dim_commune": 3, "dim_dpe": 7, "dim_type_bien": 3}


def test_a_column_named_like_the_order_of_tables_stays(spark):
    first, later = (spark.createDataFrame([("1", p)], "code string, Priority int") for p in (9, 3))
    assert rows(dimensions.first_wins([first, later], ["code"])) == [("1", 9)]


def test_order_column_decides_inside_one_list(spark):
    df = spark.createDataFrame([("k", "z", 1), ("k", "a", 2)], "key string, v string, place int")
    assert rows(dimensions.first_wins([df], ["key"], ["place"]), "v") == [("z",)]


def test_chosen_city_brings_its_members(spark):
    chosen = spark.createDataFrame([("Lyon",), ("Nice",), ("Lyon 2e Arrondissement",)], "commune string")
    names = [r[0] for r in rows(dimensions.chosen_with_members(chosen, dimensions.split_cities(spark)))]
    assert len(names) == 11 and "Lyon 9e Arrondissement" in names and "Nice" in names


def payloads(spark, *given):
    return spark.createDataFrame(
        [(c, n, d, None if xy is None else ("Point", xy), g) for c, n, d, xy, g in given], schemas.GEO_PAYLOAD)


def test_payload_lists_longitude_first(spark):
    out = geography.flatten_payload(payloads(
        spark, (" 1 ", "Un", "33", [0.5, 44.0], '{"type":"Polygon"}'), ("2", "Deux", "33", [0.5], None),
        ("3", "Trois", "33", None, None)))
    assert rows(out, "code_insee", "latitude", "longitude", "geometry_json") == [
        ("1", 44.0, 0.5, '{"type":"Polygon"}'), ("2", None, 0.5, None), ("3", None, None, None)]
    assert rows(geography.flatten_payload(payloads(spark, ("1", "Un", "33", [0.5, 44.0], "{}")), False),
                "geometry_json") == [(None,)]


def test_codes_take_payload_then_fallback(spark):
    codes = spark.createDataFrame([("33063",), ("1",), ("404",), ("1",), ("2",)], "code_insee string")
    landed = payloads(spark, ("1", "Un", None, [0.5, 44.0], None), ("2", "Deux", None, None, None),
                      ("9", "Neuf", None, [1.0, 45.0], None))
    out = geography.geo_by_codes(codes, landed, geography.fallback_centres(spark))
    assert out.columns == list(geography.GEO_COLUMNS)
    assert rows(out, "code_insee", "nom", "source") == [
        ("1", "Un", V.GEO_SOURCE), ("33063", "Bordeaux", V.GEO_FALLBACK)]


def test_departement_payloads_come_first(spark):
    landed = payloads(
        spark, ("33063", "Bordeaux", "33", [-0.5, 44.8], None), ("", "Sans code", "33", [0.0, 1.0], None),
        ("75101", "Paris 1", "75", [2.3, 48.8], None), ("75101", "Seul", None, [9.9, 9.9], None),
        ("75103", "Paris 3", None, [2.4, 48.9], None), ("69999", "Hors liste", None, [4.0, 45.0], None),
        ("44109", "Nantes", "44", [-1.5, 47.2], None))
    out = geography.geo_by_departements(
        landed, ["33", "75"], geography.arrondissement_codes(spark), geography.fallback_centres(spark))
    assert rows(out, "code_insee", "nom", "source") == [
        ("33063", "Bordeaux", V.GEO_SOURCE), ("75101", "Paris 1", V.GEO_SOURCE),
        ("75102", "Paris 2e Arrondissement", V.GEO_FALLBACK), ("75103", "Paris 3", V.GEO_SOURCE)]
    assert geography.arrondissement_codes(spark).count() == 45

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import rows
from territory_analytics import fixed_values as V, schemas
from territory_analytics.operators import pricing, profiles, quality
from territory_analytics.operators.dimensions import label_scale

DS = "2026-06-18"
CERT = ("code_insee string, etiquette_dpe string, etiquette_ges string, type_batiment string, "
        "surface_habitable double, annee_construction int, conso_energie double, emission_ges double, "
        "cout_energie_annuel double, energie_chauffage string, date_etablissement date")
SALE = "code_insee string, type_bien string, prix_m2 double, surface double"


def cert(area, label="C", size=50.0, kind="appartement", ges="D"):
    return (area, label, ges, kind, size, 1980, 150.0, 25.0, 1300.0, "gaz naturel", dt.date(2026, 1, 1))


def commune_dim(spark, *codes, parent="33"):
    return spark.createDataFrame(
        [(c, f"Commune {c}", parent, "75", 10) for c in codes], schemas.DIM_COMMUNE
    )


@pytest.fixture
def sold(spark):
    """Flats of one area in two bands: 1500, 2500 and 1750 below 40 m2, 6000 above 150 m2, two unusable."""
    sales = [(1500.0, 20.0), (2500.0, 39.9), (1750.0, 31.0), (6000.0, 150.0), (0.0, 30.0), (800.0, -4.0)]
    return spark.createDataFrame([("2A004", "appartement", p, s) for p, s in sales], SALE)


def priced(spark, sold, *certs, codes=("2A004", "1")):
    card = pricing.price_card(pricing.reference_prices(sold))
    return pricing.price_dwellings(
        spark.createDataFrame(list(certs), CERT), card, commune_dim(spark, *codes), label_scale(spark), DS
    )


def test_reference_prices(spark, sold):
    for limits in ({}, {"limit": 2}):
        prices = pricing.reference_prices(sold, **limits)
        assert rows(pricing.band_prices(prices), "tranche_surface", "prix_m2") == [
            ("150+", 6000.0), ("<40", 1750.0)]
        # The whole area: the mean of the two middle ones of four.
        assert rows(pricing.area_prices(prices), "code_insee", "type_bien", "prix_m2") == [
            ("2A004", "appartement", 2125.0)]


def test_fact_prices_by_band_then_area(spark, sold):
    known = [cert("2A004", size=10.0), cert("2A004", size=69.5), cert("2A004", kind="maison", size=200.0), cert("1")]
    unknown = [cert("2A005"), cert("2A004", label="H"), cert(None), cert("2A004", size=None), cert("2A004", size=-1.0)]
    fact = priced(spark, sold, *known, *unknown)
    assert fact.columns == schemas.FACT.names
    assert [f.dataType for f in fact.schema] == [f.dataType for f in schemas.FACT]
    got = rows(fact, "code_insee", "type_bien", "tranche_surface", "prix_m2", "prix")
    assert got == sorted([
        ("2A004", "appartement", "<40", 1750.0, 17500.0),
        ("2A004", "appartement", "40-70", 2125.0, 147687.5),
        ("2A004", "maison", "150+", None, None),
        ("1", "appartement", "40-70", None, None),
    ], key=repr)


def test_area_without_sales_flows_through(spark, sold):
    fact = priced(spark, sold, *[cert("1", label="F") for _ in range(30)])
    by_type = profiles.area_type_profile(fact, label_scale(spark), commune_dim(spark, "1"))
    (row,) = profiles.opportunities(by_type).collect()
    assert row["z"] is None and row["ecart_pct"] is None and row["est_opportunite"] is None
    assert row["score_opportunite"] == 40.0
    assert row["etiquette_opportunite"] == V.LABEL_OVERPRICED


def fact_of(spark, *homes):
    """(area, label, price, ges, cost) dwellings."""
    return spark.createDataFrame(
        [(dt.date(2026, 6, 18), a, label, "maison", "40-70", 50.0, price, None, ges, 1990, 100.0, 10.0, cost,
          "gaz", None) for a, label, price, ges, cost in homes],
        schemas.FACT,
    )


def test_kpi(spark):
    homes = [("a", "F", 800.0, "F", 1.0), ("a", "C", 1000.0, "C", 2.0), ("a", "Z", 1000.0, None, None),
             ("b", "G", 500.0, "A", 1.0), ("c", "A", None, "A", 1.0)]
    kpi = profiles.area_kpi(fact_of(spark, *homes), label_scale(spark), DS)
    assert kpi.columns == schemas.KPI_COMMUNE.names
    assert rows(kpi.drop("dt")) == [("a", 1000.0, 33.33, -20.0, 3), ("b", 500.0, 100.0, None, 1),
                                    ("c", None, 0.0, None, 1)]


@pytest.mark.parametrize("parent_size", [None, 10, 10**7])
def test_area_profile_positions(spark, parent_size):
    prices = {"a": 1000.0, "b": 2000.0, "c": 3000.0, "d": None}
    homes = [(a, "C", p, "F", 5.0) for a, p in prices.items() for _ in range(30)]
    dims = commune_dim(spark, "a", "b", "c", "d")
    mart = profiles.area_profile(fact_of(spark, *homes), label_scale(spark), dims, parent_size)
    assert mart.columns == schemas.MART_COMMUNE.names
    assert [f.dataType for f in mart.schema] == [f.dataType for f in schemas.MART_COMMUNE]
    got = {r["code_insee"]: r for r in mart.collect()}
    assert [got[a]["rang_prix_dpt"] for a in "cbad"] == [1, 2, 3, 4]
    assert [got[a]["indice_sous_cotation"] for a in "abcd"] == [-50.0, 0.0, 50.0, None]
    assert [got[a]["z_prix_dpt"] for a in "abcd"] == [-1.225, 0.0, 1.225, None]
    assert all(r["fiable"] for r in got.values()) and got["a"]["pct_ges_passoires"] == 100.0


def test_one_area_in_its_parent_has_no_z(spark):
    homes = [("a", "F", 1000.0, "F", 5.0)] * 30 + [("b", "F", 1000.0, "F", 5.0)] * 29
    by_type = profiles.area_type_profile(fact_of(spark, *homes), label_scale(spark), commune_dim(spark, "a", "b"))
    (row,) = profiles.opportunities(by_type).collect()
    assert row["code_insee"] == "a" and row["z"] is None and row["ecart_pct"] == 0.0
    assert [c for c in schemas.MART_OPPORTUNITES.names] == profiles.opportunities(by_type).columns


def test_opportunity_flags(spark):
    homes = [(a, "G" if a == "a" else "C", p, "F", 5.0)
             for a, p in {"a": 1000.0, "b": 3000.0, "c": 3100.0, "d": 3200.0}.items() for _ in range(30)]
    dims = commune_dim(spark, *"abcd")
    by_type = profiles.area_type_profile(fact_of(spark, *homes), label_scale(spark), dims)
    found = profiles.opportunities(by_type, k=1.0)
    flagged = {r["code_insee"]: r for r in found.collect()}
    assert [flagged[a]["est_opportunite"] for a in "abcd"] == [True, False, False, False]
    assert flagged["a"]["etiquette_opportunite"] == V.LABEL_RENOVATION
    assert profiles.opportunity_count(found).first()[0] == 1


def test_distribution(spark):
    sales = spark.createDataFrame(
        [("a", "maison", float(p), 50.0) for p in range(1000, 2100, 100)]
        + [("b", "maison", 1000.0, 50.0)] * 4 + [("a", "autre", 1000.0, 50.0)] * 9, SALE)
    for limits in ({}, {"limit": 2}):
        (row,) = pricing.price_distribution(sales, commune_dim(spark, "a", "b"), **limits).collect()
        assert row["nb_transactions"] == 11
        spread = [row[c] for c in pricing.SHARES]
        assert spread == [1100.0, 1250.0, 1500.0, 1750.0, 1900.0] and spread == sorted(spread)


@pytest.mark.parametrize("broken, homes", [
    ("code_insee_null", [(None, "A", 1.0, "A", 1.0)]),
    ("bad_dpe", [("a", "Z", 1.0, "A", 1.0)]),
    ("not_empty", []),
])
def test_gate_rules_fail_alone(spark, broken, homes):
    gate = quality.quality_gate(fact_of(spark, *homes), quality.fact_rules())
    assert [r["rule"] for r in gate.where(~F.col("passed")).collect()] == [broken]
    assert not quality.gate_passes(gate)


def test_gate_future_date_and_clean(spark):
    fact = fact_of(spark, ("a", "A", 1.0, "A", 1.0)).withColumn("dt", F.current_date())
    assert quality.gate_passes(quality.quality_gate(fact, quality.fact_rules()))
    late = fact.withColumn("dt", F.date_add(F.current_date(), 2))
    gate = quality.quality_gate(late, quality.fact_rules())
    assert [r["rule"] for r in gate.where(~F.col("passed")).collect()] == ["future_date"]
    # A missing label is not a wrong label.
    unlabelled = fact.withColumn("etiquette", F.lit(None).cast("string"))
    assert quality.gate_passes(quality.quality_gate(unlabelled, quality.fact_rules()))

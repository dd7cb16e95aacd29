import gzip
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import rows
from territory_analytics import fixed_values as V, schemas
from territory_analytics.operators.dimensions import label_scale, property_types
from territory_analytics.plans.daily import Lake, run_day
from territory_analytics.sinks.tables import add_raw_parts, export_snapshot, replace_table
from territory_analytics.sources.tables import read_table
from territory_analytics.streaming.refresh import refresh_silver

DS = "2026-06-18"


def raw(spark, n, prefix="D"):
    """``n`` certificates over three communes, one of them unknown, every fifth one re-issued."""
    base = spark.range(n).selectExpr(
        f"concat('{prefix}', id) AS numero_dpe", "'2026-01-08' AS date_etablissement_dpe",
        "element_at(array('33281', '33001', '33999'), CAST(id % 3 AS INT) + 1) AS code_insee_ban",
        "'33000' AS code_postal_ban", "'X' AS nom_commune_ban", "'Appartement' AS type_batiment",
        "CAST(20 + id % 150 AS STRING) AS surface_habitable_logement", "'1975' AS annee_construction",
        "substring('ABCDEFG', CAST(id % 7 AS INT) + 1, 1) AS etiquette_dpe", "'F' AS etiquette_ges",
        "'200' AS conso_5_usages_par_m2_ep", "'20' AS emission_ges_5_usages_par_m2", "'1500' AS cout_total_5_usages",
        "'Gaz' AS type_energie_principale_chauffage", "'33' AS dep")
    again = base.where("CAST(substring(numero_dpe, 2) AS INT) % 5 = 0").withColumn(
        "date_etablissement_dpe", F.lit("2025-01-01"))
    return base.unionByName(again)


def sales_csv(lake, ds=DS):
    lines = ["code_commune,type_local,surface_reelle_bati,valeur_fonciere,date_mutation,longitude,latitude"]
    lines += [f"33281,Appartement,{20 + i},{(20 + i) * (3000 + i)},2024-01-01,0,0" for i in range(120)]
    place = Path(lake.root, "raw", "dvf", f"dt={ds}", "dep=33")
    place.mkdir(parents=True)
    with gzip.open(place / "data.csv.gz", "wt") as out:
        out.write("\n".join(lines) + "\nbroken,line\n")


@pytest.fixture
def lake(spark, folder):
    lake = Lake(folder)
    add_raw_parts(raw(spark, 600), lake.at("raw", "dpe"), DS, ["33"])
    sales_csv(lake)
    dims = [("33281", "Merignac", "33", "75", 1), ("33001", "Abzac", "33", "75", 1)]
    replace_table(spark.createDataFrame(dims, schemas.DIM_COMMUNE), lake.at("ref", "dim_commune"))
    replace_table(label_scale(spark), lake.at("ref", "dim_dpe"))
    replace_table(property_types(spark), lake.at("ref", "dim_type_bien"))
    return lake


def test_whole_day_twice(spark, lake):
    first = run_day(spark, lake, DS, ["33", "57"])
    assert first["silver_dpe"] == 600 and first["silver_dvf"] == 120
    assert first["fact_biens"] == 400, "dwellings of unknown communes drop"
    assert first["gate_passed"] and first["kpi_commune"] == first["mart_commune"] == 2
    mart = read_table(spark, lake.at("gold", "mart_commune"), schemas.MART_COMMUNE)
    before = rows(mart)
    shares = [r["pct_passoires"] for r in mart.collect()]
    assert all(0 <= s <= 100 for s in shares)
    unsold = mart.where("code_insee = '33001'").first()
    assert unsold["prix_m2_median"] is None and unsold["z_prix_dpt"] is None
    assert run_day(spark, lake, DS, ["33", "57"]) == first
    assert rows(read_table(spark, lake.at("gold", "mart_commune"), schemas.MART_COMMUNE)) == before
    fact = read_table(spark, lake.at("gold", "fact_biens"), schemas.FACT)
    assert fact.count() == 400 and fact.columns == schemas.FACT.names

    out = f"{lake.root}/snapshot"
    exported = export_snapshot(spark, f"{lake.root}/gold", out, n=150)
    assert exported["fact_biens"] == 150 and exported["mart_commune"] == 2
    assert read_table(spark, f"{out}/fact_biens").count() == 150


def test_failed_gate_stops_the_run(spark, lake):
    later = "2999-01-01"
    add_raw_parts(raw(spark, 30), lake.at("raw", "dpe"), later, ["33"])
    sales_csv(lake, later)
    done = run_day(spark, lake, later)
    assert not done["gate_passed"] and "kpi_commune" not in done and "mart_commune" not in done
    assert not Path(lake.at("gold", "mart_commune")).exists()


def test_stream_refresh_recomputes_touched_dates(spark, folder):
    root, silver, progress = f"{folder}/raw", f"{folder}/silver", f"{folder}/progress"

    def arrive(df, ds):
        df.withColumn("dt", F.lit(ds)).write.mode("append").partitionBy("dt", "dep").parquet(root)
        refresh_silver(spark, root, silver, progress)

    def counts():
        return {str(k): n for k, n in rows(read_table(spark, silver).groupBy("dt").count())}

    arrive(raw(spark, 20), "2026-06-17")
    assert counts() == {"2026-06-17": 20}
    arrive(raw(spark, 10, "E"), "2026-06-18")
    assert counts() == {"2026-06-17": 20, "2026-06-18": 10}
    # A late part repeats ten known numbers and brings five new ones.
    arrive(raw(spark, 25), "2026-06-17")
    assert counts() == {"2026-06-17": 25, "2026-06-18": 10}
    refresh_silver(spark, root, silver, progress)
    assert counts() == {"2026-06-17": 25, "2026-06-18": 10}
    # A part whose area is a number and that lacks a column.
    area = F.col("surface_habitable_logement").cast("double")
    drifted = raw(spark, 28).withColumn("surface_habitable_logement", area).drop("cout_total_5_usages")
    arrive(drifted, "2026-06-17")
    assert counts() == {"2026-06-17": 28, "2026-06-18": 10}


def test_a_backfill_of_many_dates_is_one_write(spark, folder, monkeypatch):
    from territory_analytics.sinks import swap

    root, silver, progress = f"{folder}/raw", f"{folder}/silver", f"{folder}/progress"
    dates = [f"2026-05-{day:02d}" for day in range(1, 31)]
    rows_in = raw(spark, 60).withColumn("dt", F.concat(F.lit("2026-05-"), F.lpad((F.substring("numero_dpe", 2, 9).cast("int") % 30 + 1).cast("string"), 2, "0")))
    # One date has nothing usable; one number occurs on two dates.
    unusable = rows_in.withColumn("etiquette_dpe", F.when(F.col("dt") != "2026-05-07", F.col("etiquette_dpe")))
    twice = unusable.where("numero_dpe = 'D0'").withColumn("dt", F.lit("2026-05-30"))
    unusable.unionByName(twice).write.partitionBy("dt", "dep").parquet(root)
    writes, plain = [], swap.write_counted
    monkeypatch.setattr(swap, "write_counted", lambda df, path, **named: writes.append(path) or plain(df, path, **named))
    refresh_silver(spark, root, silver, progress)
    assert len(writes) == 2, "all dates in one, and the one that is empty"
    counts = {str(k): n for k, n in rows(read_table(spark, silver, schemas.CERTIFICATE).groupBy("dt").count())}
    assert counts == {d: 3 if d == "2026-05-30" else 2 for d in dates if d != "2026-05-07"}
    assert Path(silver, "dt=2026-05-07").exists()
    assert [p.name for p in Path(silver).iterdir() if p.name.startswith(".new")] == []

"""Tables by area: the layout on disk, plans without a shuffle by area, hot areas, equal rows."""

from pathlib import Path

from conftest import rows
from pyspark.sql import functions as F

from territory_analytics import schemas
from territory_analytics.layout import ByArea, lay_out, read_by_area, replace_by_area
from territory_analytics.operators import profiles
from territory_analytics.operators.dimensions import label_scale

DS = "2026-06-18"


def fact(spark, n=4_000):
    """Dwellings of 41 areas and one without a code; the first area holds a third of all rows."""
    area = F.when(F.col("id") % 3 == 0, "00001").when(F.col("id") % 101 == 1, None).otherwise(
        F.format_string("%05d", F.col("id") % 41 + 2)
    )
    values = {
        "dt": F.lit(DS).cast("date"),
        "code_insee": area,
        "etiquette": F.substring(F.lit("ABCDEFG"), (F.col("id") % 7 + 1).cast("int"), F.lit(1)),
        "type_bien": F.when(F.col("id") % 2 == 0, "maison").otherwise("appartement"),
        "prix_m2": F.when(F.col("id") % 13 > 0, (F.col("id") * 7919 % 997).cast("double")),
        "annee_construction": (1900 + F.col("id") % 120).cast("int"),
        "conso_energie": (F.col("id") % 400).cast("double"),
        "cout_energie_annuel": (F.col("id") * 31 % 2_003).cast("double"),
        "etiquette_ges": F.lit("F"),
    }
    types = {f.name: f.dataType for f in schemas.FACT}
    columns = [values.get(c, F.lit(None)).cast(types[c]).alias(c) for c in schemas.FACT.names]
    return spark.range(n).select(*columns)


def stored(spark, folder, limit):
    replace_by_area(lay_out(fact(spark), limit=limit), folder, DS)
    return read_by_area(spark, folder, DS, schemas.FACT, limit=limit)


def shuffles(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]


def test_rows_come_back_from_either_reader(spark, folder):
    table = stored(spark, folder, 500)
    assert isinstance(table, ByArea) and table.hot is not None
    assert rows(table.rows()) == rows(fact(spark))
    assert {r[0] for r in table.hot.select("code_insee").distinct().collect()} == {"00001"}
    plain = spark.read.schema(schemas.FACT).parquet(folder).select(*schemas.FACT.names)
    assert rows(plain) == rows(fact(spark))
    parts = {p.name for p in Path(folder, f"dt={DS}").iterdir() if p.is_dir()}
    assert parts == {f"part=even-{table.buckets}", "part=hot"}


def test_every_area_lies_in_one_bucket(spark, folder):
    table = stored(spark, folder, 10**6)
    assert table.hot is None
    filed = table.even.withColumn("file", F.input_file_name())
    per_area = filed.groupBy("code_insee").agg(F.countDistinct("file").alias("files"))
    assert per_area.agg(F.max("files")).first()[0] == 1


def test_indicators_need_no_shuffle_by_area(spark, folder):
    table, scale = stored(spark, folder, 10**6), label_scale(spark)
    kpi = profiles.area_kpi(table, scale, DS)
    assert shuffles(kpi) == []
    assert shuffles(profiles.area_summary(table, scale)) == []
    assert shuffles(profiles.area_type_summary(table, scale)) == []
    assert shuffles(profiles.area_kpi(fact(spark), scale, DS)) != []


def test_layout_is_written_by_one_shuffle_and_kept_by_joins(spark, folder):
    table = stored(spark, folder, 10**6)
    card = table.even.groupBy("code_insee").agg(F.count("*").alias("n"))
    joined = table.map(lambda part: part.join(card.hint("merge"), "code_insee", "left"))
    assert shuffles(joined.even) == []
    again = joined.even.repartition(table.buckets, "code_insee")
    assert shuffles(again) == []


def test_marts_agree_with_and_without_layout(spark, folder):
    plain, scale = fact(spark), label_scale(spark)
    for limit in (10**6, 500, 20):
        table = stored(spark, f"{folder}/{limit}", limit)
        assert rows(profiles.area_kpi(table, scale, DS)) == rows(profiles.area_kpi(plain, scale, DS))
        assert rows(profiles.area_summary(table, scale)) == rows(profiles.area_summary(plain, scale))
        assert rows(profiles.area_type_summary(table, scale)) == rows(profiles.area_type_summary(plain, scale))


def test_empty_and_replaced_partitions(spark, folder):
    replace_by_area(lay_out(fact(spark), limit=500), folder, DS)
    replace_by_area(lay_out(fact(spark, 50), limit=500), folder, DS)
    assert read_by_area(spark, folder, DS, schemas.FACT).rows().count() == 50
    replace_by_area(lay_out(fact(spark, 0)), folder, DS)
    table = read_by_area(spark, folder, DS, schemas.FACT)
    assert table.rows().count() == 0
    assert profiles.area_kpi(table, label_scale(spark), DS).count() == 0

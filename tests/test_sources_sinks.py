import gzip
import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from conftest import rows
from territory_analytics import fixed_values as V, schemas
from territory_analytics.operators.latest import keep_first, latest_partition
from territory_analytics.operators.sampling import exact_sample
from territory_analytics.sinks import tables as sinks
from territory_analytics.sources import pages
from territory_analytics.sources.drifting_parquet import read_text_parts
from territory_analytics.sources.tables import newest_partition, read_partition, read_table
from territory_analytics.sources.text_files import (
    in_scope, read_csv_text, read_json_array, scope_list, source_filter,
)
from territory_analytics.storage import CHECKPOINT_SETTING, durable, scratch_path, shared_folder


def test_drifting_parts_unite_as_text(spark, folder):
    def part(values, spec, place):
        spark.createDataFrame(values, spec).write.parquet(f"{folder}/{place}")

    part([(1, 2.5)], "a bigint, b double", "dt=2026-06-18/dep=33")
    part([(1.5,)], "a double", "dt=2026-06-18/dep=2A")
    part([("7.5", "x")], "b string, a string", "dt=2026-06-18/dep=01")
    part([("old", "old")], "b string, a string", "dt=2026-06-17/dep=01")
    out = read_text_parts(spark, folder, ["a", "b", "c"], scope={"dt": ["2026-06-18"]})
    assert dict(out.dtypes) == dict.fromkeys(["a", "b", "c", "dt", "dep"], "string")
    assert rows(out, "a", "b", "c", "dep") == sorted(
        [("1", "2.5", None, "33"), ("1.5", None, None, "2A"), ("x", "7.5", None, "01")], key=repr)
    assert read_text_parts(spark, folder, ["a"], scope={"dep": ["01", "99"]}).count() == 2
    with pytest.raises(FileNotFoundError):
        read_text_parts(spark, folder, ["a"], scope={"dep": ["99"]})


LINES = [("7500", 'rue "du" Puits', "1"), ("2B3", "quai, côté mer", "22"), ("98", None, "333")]
BAD = ["5,6", "5,6,7,8", "only"]


def quoted(value):
    return "" if value is None else '"' + value.replace('"', '""') + '"'


def test_csv_is_read_by_the_header_of_each_file(spark, folder):
    names = ("code", "adresse", "prix")
    for dep, order in (("01", (0, 1, 2)), ("33", (2, 0, 1))):
        (d := __import__("pathlib").Path(folder, f"dep={dep}")).mkdir()
        body = [",".join(names[k] for k in order)]
        body += [",".join(quoted(line[k]) for k in order) for line in LINES] + BAD
        with gzip.open(d / "data.csv.gz", "wt", encoding="utf-8") as out:
            out.write("\n".join(body) + "\n")
    table = read_csv_text(spark, folder, partitions=("dep",))
    assert set(table.columns) == {*names, "dep"}
    for dep in ("01", "33"):
        assert rows(table.where(f"dep = '{dep}'"), *names) == sorted(LINES, key=repr)
    assert rows(table, "prix") == sorted([(line[2],) for line in LINES] * 2)
    assert in_scope(table, ["33", "57"]).count() == 3
    with pytest.raises(FileNotFoundError):
        in_scope(table, ["57", "67"])


def test_one_folder_may_hold_parts_of_several_schemas(spark, folder):
    place = f"{folder}/dt=2026-06-18/dep=33"
    spark.createDataFrame([(1, 2.5)], "a bigint, b double").coalesce(1).write.parquet(place)
    spark.createDataFrame([("x",)], "a string").coalesce(1).write.mode("append").parquet(place)
    out = read_text_parts(spark, folder, ["a", "b"], scope={"dt": ["2026-06-18", "2026-06-19"]})
    assert rows(out, "a", "b") == sorted([("1", "2.5"), ("x", None)], key=repr)


def test_newest_partition_is_read_from_the_listing(spark, folder):
    for day, n in (("2026-06-09", 3), ("2026-06-10", 2), ("2026-06-11", 0)):
        sinks.replace_partition(spark.range(n), folder, day)
    assert newest_partition(spark, folder) == "2026-06-10"


def test_listed_files_are_not_opened_to_plan(spark, folder, monkeypatch):
    from territory_analytics.sources import drifting_parquet, manifest, text_files

    def closed(path):
        raise AssertionError(f"{path} was opened")

    a = spark.createDataFrame([(1, 2.5, "33"), (2, None, "2A")], "a bigint, b double, dep string")
    b = spark.createDataFrame([("x", "44")], "a string, dep string")
    sinks.add_raw_parts(a, folder, "2026-06-18", ["33", "2A"])
    sinks.add_raw_parts(b, folder, "2026-06-18", ["44"])
    listed = manifest.entries(spark, folder)
    assert rows(listed.groupBy("signature").agg(F.sum("rows"))) == [("a:int64;b:double", 2), ("a:string", 1)]
    want = sorted([("1", "2.5", "33"), ("2", None, "2A"), ("x", None, "44")], key=repr)
    monkeypatch.setattr(drifting_parquet, "schema_of", closed)
    scope = {"dt": ["2026-06-18"]}
    assert rows(read_text_parts(spark, folder, ["a", "b"], scope=scope), "a", "b", "dep") == want
    monkeypatch.undo()
    # A file that somebody else landed is opened; a rewritten one no longer matches its entry.
    spark.createDataFrame([(7,)], "a int").write.parquet(f"{folder}/dt=2026-06-18/dep=57")
    sinks.add_raw_parts(b.withColumn("a", F.lit("y")), folder, "2026-06-18", ["44"])
    got = rows(read_text_parts(spark, folder, ["a", "b"], scope=scope), "a", "b", "dep")
    assert got == sorted([want[0], want[1], ("7", None, "57"), ("y", None, "44")], key=repr)

    csv = f"{folder}/csv"
    for name, text in (("1.csv", "u,v\n1,2\n"), ("2.csv", "v,u\n4,3\n")):
        (p := __import__("pathlib").Path(csv, name)).parent.mkdir(exist_ok=True)
        p.write_text(text)
    assert text_files.index_headers(spark, csv) == 2 and text_files.index_headers(spark, csv) == 0
    monkeypatch.setattr(text_files, "first_line", closed)
    assert rows(text_files.read_csv_text(spark, csv), "u", "v") == [("1", "2"), ("3", "4")]


def test_a_partitioned_table_reads_its_newest_partition_only(spark, folder):
    from territory_analytics.operators import serving
    from territory_analytics.sources.tables import PartitionedTable

    fact = spark.createDataFrame([("33281", "maison", "A"), ("33281", "maison", "F")], "code_insee string, type_bien string, etiquette string")
    whole = fact.select(*[(F.col(c) if c in fact.columns else F.lit(None).cast(f.dataType)).alias(c) for c, f in zip(schemas.FACT.names, schemas.FACT)])
    for day, n in (("2026-06-09", 2), ("2026-06-10", 1), ("2026-06-11", 0)):
        sinks.replace_partition(whole.limit(n), folder, day)
    table = PartitionedTable(spark, folder, schemas.FACT)
    communes = spark.createDataFrame([("33281", "Merignac", "33", "75", 1)], schemas.DIM_COMMUNE)
    counts = serving.label_counts(table, communes)
    assert [f for f in counts.inputFiles() if "/dt=" in f and "dt=2026-06-10" not in f] == []
    assert sum(r["nb"] for r in counts.collect()) == 1
    assert table.rows().count() == 3 and table.at("2026-06-09").first()["dt"] == date(2026, 6, 9)
    assert PartitionedTable(spark, f"{folder}/dt=2026-06-09", schemas.FACT).newest().count() == 0


def test_figures_ask_for_rows_without_order(spark):
    from territory_analytics.operators import serving

    columns = "z double, indice_sous_cotation double, score_opportunite double, pct_passoires double"
    rows_in = spark.createDataFrame([(-2.0, -5.0, None, 30.0)], columns)
    plain = serving.pick_opportunities(rows_in, 1.0, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort" not in plain
    assert "Sort" in serving.pick_opportunities(rows_in, 1.0)._jdf.queryExecution().optimizedPlan().toString()


def test_business_date(monkeypatch):
    assert sinks.business_date("2026-01-02", "2025-01-01") == "2026-01-02"
    assert sinks.business_date(None, "2025-01-01") == "2025-01-01"

    class Late(datetime):
        @classmethod
        def now(cls, tz=None):
            return datetime(2026, 6, 18, 23, 30, tzinfo=timezone.utc).astimezone(tz)

    monkeypatch.setattr(sinks, "datetime", Late)
    assert sinks.business_date() == "2026-06-19"


def test_stray_departements_are_an_error(spark, folder):
    strays = spark.createDataFrame([(1, "33"), (2, None)], "id long, dep string")
    sinks.add_raw_parts(strays.where("id = 1"), folder, "2026-06-18", ["33"])
    with pytest.raises(Exception, match="outside the listed"):
        sinks.add_raw_parts(strays, folder, "2026-06-18", ["33"])
    landed = spark.read.schema("id bigint, dep string").parquet(f"{folder}/dt=2026-06-18")
    assert rows(landed) == [(1, "33")]


def test_scratch_is_empty_after_a_run(spark, folder, monkeypatch):
    from territory_analytics import storage

    monkeypatch.setattr(storage, "shared_folder", lambda _: folder)
    monkeypatch.setattr(storage, "_stored", {})
    first, second = durable(spark.range(5)), durable(spark.range(3))
    storage.discard(first)
    assert len(list(__import__("pathlib").Path(folder).iterdir())) == 1 and second.count() == 3
    storage.clear_scratch(spark)
    assert not list(__import__("pathlib").Path(folder).iterdir())


def test_scope_list():
    assert scope_list(" 33, 2A ,,01") == ["33", "2A", "01"]
    assert scope_list("", "75,69") == ["75", "69"]
    assert scope_list(None) == [] and scope_list(" , ", " ") == []


def test_source_filter(spark):
    df = spark.createDataFrame(
        [("33", "33000", "33281"), ("33", "33100", "33281"), ("44", "44000", "44109")],
        "dep string, code_postal_ban string, code_insee_ban string")
    assert df.where(source_filter()).count() == 3
    assert df.where(source_filter("33")).count() == 2
    assert df.where(source_filter("33", "33100")).count() == 1
    assert df.where(source_filter(code_insee="44109", departement="33")).count() == 0


def test_json_array_file(spark, folder):
    with open(f"{folder}/communes.json", "w") as out:
        json.dump([{"code": "01004", "nom": "A", "codeDepartement": "01", "codeRegion": "84", "population": 7},
                   {"code": "2A004", "nom": "B", "codeDepartement": "2A", "codeRegion": "94"}], out, indent=1)
    got = read_json_array(spark, f"{folder}/communes.json", schemas.COMMUNE_LIST)
    assert rows(got, "code", "population") == [("01004", "7"), ("2A004", None)]


def landed_pages(folder):
    link = "https://x.org/lines?size=2&after={}"
    landed = {"33": [([{"numero_dpe": "A", "extra": 1}], link.format("c2")), ([{"numero_dpe": "B"}], link.format("c3")),
                     ([{"numero_dpe": "C", "etiquette_dpe": "D"}], None)],
              "2A": [([{"numero_dpe": "D"}], link.format("c2"))]}
    for dep, listed in landed.items():
        (d := __import__("pathlib").Path(folder, f"dep={dep}")).mkdir()
        lines = [json.dumps({"page": i, "results": r, "next": n}) for i, (r, n) in enumerate(listed)]
        (d / "pages.json").write_text("\n".join(lines))


def test_pages(spark, folder):
    landed_pages(folder)
    stored = pages.read_pages(spark, folder)
    found = pages.page_rows(stored, ["numero_dpe", "etiquette_dpe"])
    assert rows(found) == sorted([("A", None, "33"), ("B", None, "33"), ("C", "D", "33"), ("D", None, "2A")], key=repr)
    assert pages.page_rows(stored).columns == [*V.RAW_CERTIFICATE_COLUMNS, "dep"]
    assert pages.page_rows(stored, ["numero_dpe"], max_pages=2).count() == 3
    cursors = stored.where("dep = '33'").select(pages.cursor(F.col("next")))
    assert sorted(r[0] or "" for r in cursors.collect()) == ["", "c2", "c3"]
    assert rows(pages.page_set_status(stored)) == [("2A", 1, False), ("33", 3, True)]


def test_page_chains(spark):
    links = {
        "whole": [(None, "b"), ("b", "c"), ("c", None)],
        "gap": [(None, "b"), ("c", "d"), ("d", None)],
        "cycle": [(None, "b"), ("b", "c"), ("c", "b")],
        "branch": [(None, "b"), (None, "c"), ("b", None), ("c", None)],
        "twice": [(None, "b"), ("b", None), ("b", None)],
        "headless": [("b", "c"), ("c", None)],
        "stray": [(None, None), ("x", None)],
        "long": [(str(k) if k else None, str(k + 1) if k < 999 else None) for k in range(1_000)],
    }
    landed = spark.createDataFrame([(d, *link) for d, links_ in links.items() for link in links_], "dep string, own string, after string")
    chains = pages.page_chains(landed.repartition(5), F.col("own"), F.col("after"))
    got = {r["dep"]: (r["pages"], r["reached"], r["missing"], r["complete"]) for r in pages.chain_status(chains).collect()}
    assert got == {
        "whole": (3, 3, None, True), "gap": (3, 1, "b", False), "cycle": (3, 0, None, False),
        "branch": (3, 2, None, False), "twice": (2, 2, None, True), "headless": (2, 0, None, False),
        "stray": (2, 1, None, False), "long": (1_000, 1_000, None, True),
    }
    steps = {r["cursor"]: r["steps"] for r in chains.where("dep = 'whole'").collect()}
    assert steps == {"": 2, "b": 1, "c": 0}
    assert pages.chain_status(pages.page_chains(landed.limit(0), F.col("own"), F.col("after"))).count() == 0


def test_partition_replace_is_repeatable(spark, folder):
    def day(n):
        return spark.range(n).select("id", F.lit("x").cast("date").alias("dt") if n < 0 else F.lit("2026-06-18").alias("dt"))

    root = f"{folder}/t"
    assert [sinks.replace_partition(day(5), root, d) for d in ("2026-06-17", "2026-06-18")] == [5, 5]
    assert sinks.replace_partition(day(3), root, "2026-06-18") == 3
    assert sinks.replace_partition(day(3), root, "2026-06-18") == 3
    schema = spark.createDataFrame([], "id bigint, dt date").schema
    assert read_table(spark, root, schema).count() == 8
    assert sinks.replace_partition(day(0), root, "2026-06-18") == 0
    assert rows(read_table(spark, root, schema).groupBy("dt").count()) == [(date(2026, 6, 17), 5)]
    one = read_partition(spark, root, "2026-06-17")
    assert one.count() == 5
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert latest_partition(read_table(spark, root)).count() == 5


def test_raw_parts_are_additive_and_bounded(spark, folder):
    rows_in = spark.range(250).select(
        "id", F.when(F.col("id") < 200, "33").otherwise("2A").alias("dep"))
    assert sinks.add_raw_parts(rows_in, folder, "2026-06-18", ["33", "2A"], 60) == {"33": 200, "2A": 50}
    again = sinks.add_raw_parts(rows_in.where("id < 10"), folder, "2026-06-18", ["33", "01"], 60)
    assert again == {"33": 10, "01": 0}
    landed = spark.read.schema("id bigint, dep string").parquet(f"{folder}/dt=2026-06-18")
    assert rows(landed.groupBy("dep").count()) == [("2A", 50), ("33", 10)]
    assert sinks.add_raw_parts(rows_in.limit(0), folder, "2026-06-18", ["33"], 60) == {"33": 0}
    landed = spark.read.schema("id bigint, dep string").parquet(f"{folder}/dt=2026-06-18")
    assert rows(landed.groupBy("dep").count()) == [("2A", 50)]
    sinks.add_raw_parts(rows_in, folder, "2026-06-18", ["33", "2A"], 60, mixed=True)
    per_file = spark.read.parquet(f"{folder}/dt=2026-06-18").groupBy(F.input_file_name()).count()
    assert per_file.agg(F.max("count")).first()[0] <= 60


def test_exact_sample(spark):
    df = spark.range(5000).withColumn("v", F.col("id") % 3)
    for n in (0, 1, 777, 5000, 9000):
        sample = exact_sample(df, n, ["id"], seed=1)
        assert sample.count() == min(n, 5000)
        assert sample.select("id").distinct().count() == min(n, 5000)
        assert sample.columns == ["id", "v"]
    first, again, other = (
        {r["id"] for r in exact_sample(d, 500, ["id"], seed=s).collect()}
        for d, s in ((df, 1), (df.repartition(7), 1), (df, 2)))
    assert first == again != other
    assert 2000 < sum(first) / len(first) < 3000


def test_durable_tables_live_in_the_shared_folder(spark):
    folder = spark.conf.get(CHECKPOINT_SETTING)
    assert shared_folder(spark) == folder
    assert scratch_path(spark, "a").startswith(folder + "/a-") and scratch_path(spark, "a") != scratch_path(spark, "a")
    kept = durable(spark.range(10))
    assert kept.count() == 10 and kept.inputFiles()[0].startswith(f"file:{folder}") or folder in kept.inputFiles()[0]


def test_keep_first_by_priority(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4)], "k string, n int")
    assert rows(keep_first(df, ["k"], [F.col("n").asc_nulls_last()])) == sorted([("a", 1), (None, 4)], key=repr)

"""Replacement that survives failures: old rows until all new ones are there, journals carried out."""

from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from territory_analytics import schemas
from territory_analytics.plans import daily
from territory_analytics.sinks import swap, tables as sinks
from territory_analytics.sinks.swap import Swap, settle
from territory_analytics.sources.tables import read_table


def broken(spark, n=10):
    fails = F.when(F.col("id") == n - 1, F.raise_error(F.lit("lost"))).otherwise(F.col("id"))
    return spark.range(n).select(fails.cast("bigint").alias("id"))


def hidden(folder):
    return [p.name for p in Path(folder).rglob(".*") if not p.name.endswith(".crc")]


def test_failing_write_keeps_the_old_rows(spark, folder):
    root = f"{folder}/t"
    sinks.replace_partition(spark.range(10), root, "2026-06-18")
    sinks.replace_table(spark.range(4), f"{folder}/m")
    for act in (lambda: sinks.replace_partition(broken(spark), root, "2026-06-18"), lambda: sinks.replace_table(broken(spark), f"{folder}/m")):
        with pytest.raises(Exception, match="lost"):
            act()
    assert read_table(spark, root).count() == 10 and read_table(spark, f"{folder}/m").count() == 4
    assert hidden(folder) == []


def test_a_table_may_be_replaced_from_itself(spark, folder):
    root = f"{folder}/t"
    sinks.replace_table(spark.range(10), root)
    assert sinks.replace_table(read_table(spark, root).where("id < 3"), root) == 3
    assert rows(read_table(spark, root)) == [(0,), (1,), (2,)]


def test_places_are_replaced_together_or_not_at_all(spark, folder):
    for name in "ab":
        sinks.replace_table(spark.range(5), f"{folder}/{name}")
    with pytest.raises(Exception, match="lost"):
        with Swap(spark, folder) as both:
            assert both.write(spark.range(2), f"{folder}/a") == 2
            assert spark.read.parquet(both.at(f"{folder}/a")).count() == 2
            assert both.at(f"{folder}/b") == f"{folder}/b"
            both.write(broken(spark), f"{folder}/b")
    assert [read_table(spark, f"{folder}/{n}").count() for n in "ab"] == [5, 5]
    assert hidden(folder) == []


@pytest.mark.parametrize("done", range(6))
def test_a_lost_driver_is_made_up_for(spark, folder, monkeypatch, done):
    """The run stops after any number of renames; the next replacement finishes it."""
    for name in "ab":
        sinks.replace_table(spark.range(5), f"{folder}/{name}")
    plain, calls = swap._rename, iter(range(100))

    def rename(*names):
        if next(calls) >= done:
            raise KeyboardInterrupt
        plain(*names)

    lost = Swap(spark, folder)
    for name in "ab":
        lost.write(spark.range(2), f"{folder}/{name}")
    monkeypatch.setattr(swap, "_rename", rename)
    if done < 5:  # the journal's own rename and two per place
        with pytest.raises(KeyboardInterrupt):
            lost.publish()
    else:
        lost.publish()
    monkeypatch.setattr(swap, "_rename", plain)
    sinks.replace_table(spark.range(1), f"{folder}/c")
    want = 5 if done == 0 else 2  # without a journal nothing has happened
    assert [read_table(spark, f"{folder}/{n}").count() for n in "ab"] == [want, want]
    assert not [n for n in hidden(folder) if n.startswith((swap.OLD, swap.JOURNAL)) and not n.endswith(".tmp")]
    assert settle(spark, folder) == []


def test_unfinished_rows_are_not_read(spark, folder):
    sinks.replace_partition(spark.range(3), folder, "1")
    aside = Swap(spark, folder)
    aside.write(spark.range(9), f"{folder}/dt=1")
    aside.write(spark.range(9), f"{folder}/dt=2")
    assert rows(read_table(spark, folder).groupBy("dt").count()) == [(1, 3)]
    aside.abandon()
    assert hidden(folder) == []


def test_codec_of_every_written_file(spark, folder):
    """K2: zstandard, told from the footers."""
    import pyarrow.parquet as pq

    sinks.replace_partition(spark.range(5), f"{folder}/t", "1")
    sinks.add_raw_parts(spark.range(5).withColumn("dep", F.lit("33")), f"{folder}/raw", "2026-06-18", ["33"])
    files = [*Path(folder).rglob("*.parquet")]
    assert len(files) >= 2
    for file in files:
        group = pq.ParquetFile(file).metadata.row_group(0)
        assert {group.column(k).compression for k in range(group.num_columns)} == {"ZSTD"}


def test_marts_stay_together_when_one_fails(spark, folder, monkeypatch):
    lake = daily.Lake(folder)
    for name in sinks.MARTS:
        sinks.replace_table(spark.range(3), lake.at("gold", name))
    fact = spark.createDataFrame([], schemas.FACT)
    sinks.replace_partition(fact, lake.at("gold", "fact_biens"), "2026-06-18")
    sinks.replace_table(spark.createDataFrame([], schemas.DIM_COMMUNE), lake.at("ref", "dim_commune"))
    sinks.replace_table(spark.createDataFrame([], schemas.DIM_LABEL), lake.at("ref", "dim_dpe"))
    monkeypatch.setattr(daily.profiles, "opportunities", lambda *_: broken(spark))
    with pytest.raises(Exception, match="lost"):
        daily.build_marts(spark, lake, "2026-06-18")
    assert [read_table(spark, lake.at("gold", name)).count() for name in sinks.MARTS] == [3] * 4

"""Clustered tables: equal rows, few files, hot values, NULLs, empty tables, safe replacement."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from territory_analytics.clustering import Clustered, read_clustered, write_clustered
from territory_analytics.operators.filters import Filters, Grain, intervals, predicate
from territory_analytics.operators.serving import clustered_rows

PARTS = {"region": 2, "code_insee": 4, "prix_m2": 4}
GRAIN = Grain(frozenset({"region", "departement", "commune", "prix_m2"}))


def communes(spark, n=6_000):
    """Areas of two regions; one area has a third of all rows, some have no name, some no or no real price."""
    area = F.when(F.col("id") % 3 == 0, "33063").otherwise(F.format_string("%05d", F.col("id") * 7 % 900 + 1000))
    price = F.when(F.col("id") % 19 == 0, None).when(F.col("id") % 23 == 0, float("nan"))
    return spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "NORD").otherwise("SUD").alias("region"),
        area.alias("code_insee"),
        F.when(F.col("id") % 29 == 0, None).when(F.col("id") % 31 == 0, "Paris 1er Arrondissement")
        .when(F.col("id") % 37 == 0, "Paris").otherwise(F.concat(F.lit("C"), area)).alias("commune"),
        price.otherwise((F.col("id") * 7919 % 5_003).cast("double")).alias("prix_m2"),
        (F.col("id") % 90).alias("nb_dpe"),
        F.col("id").alias("cell"),  # a name the layout would like for itself
    )


def texts(df):
    """Rows to compare, where NaN equals itself."""
    return rows(df.withColumn("prix_m2", F.col("prix_m2").cast("string")))


CHOICES = [
    Filters(),
    Filters(regions=("NORD",), prix_m2_min=1_000, prix_m2_max=1_400),
    Filters(prix_m2_max=300, nb_dpe_min=0),
    Filters(prix_m2_min=4_900),
    Filters(communes=("Paris",), nb_dpe_min=0),
    Filters(communes=("C33063", "C01007"), regions=("SUD",)),
    Filters(regions=("EST",)),
    Filters(etiquettes=("G",), departements=("33",)),
]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    df = communes(spark)
    return write_clustered(df, str(tmp_path_factory.mktemp("clustered")), PARTS, ["commune", "nb_dpe"], ["cell"])


@pytest.mark.parametrize("chosen", CHOICES[:-1])
def test_picked_rows_are_the_filtered_ones(spark, table, chosen):
    assert texts(clustered_rows(table, chosen, GRAIN)) == texts(communes(spark).where(predicate(chosen)))


def test_groups_over_columns_without_bounds_rule_out_no_cell(table):
    assert table.cells(intervals(CHOICES[-1])) == table.cells(intervals(Filters()))


def scanned(df):
    """(files, rows) that the scans of ``df`` read, by Spark's own metrics."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    metrics = [leaves.apply(k).metrics() for k in range(leaves.size())]
    return tuple(sum(m.apply(name).value() for m in metrics) for name in ("numFiles", "numOutputRows"))


def test_a_filtered_query_reads_a_fraction_of_the_files(table):
    files, n = scanned(table.rows())
    some, fewer = scanned(clustered_rows(table, CHOICES[1], GRAIN))
    assert files >= 24 and some <= files / 3 and fewer <= n / 3
    assert table.cells(intervals(Filters(regions=("EST",)))) == []


def test_cells_are_of_like_size_beside_the_hot_area(spark, table):
    sizes = sorted(r["n_rows"] for r in table.bounds.collect())
    assert sum(sizes) == 6_000 and sizes[-1] <= 6 * sizes[len(sizes) // 2]


def test_looked_up_columns_have_bloom_filters(spark, table):
    hadoop = spark._jvm.org.apache.parquet.hadoop
    path = spark._jvm.org.apache.hadoop.fs.Path(table.stored.inputFiles()[0])
    file = hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration())
    reader = hadoop.ParquetFileReader.open(file)
    columns = reader.getFooter().getBlocks().get(0).getColumns()
    reader.close()
    found = {columns.get(k).getPath().toDotString(): columns.get(k).getBloomFilterOffset() for k in range(columns.size())}
    assert found["cell"] > 0 > found["prix_m2"]


def test_empty_tables_and_their_replacement(spark, folder):
    nothing = communes(spark, 0)
    empty = write_clustered(nothing, folder, PARTS)
    assert isinstance(empty, Clustered) and rows(empty.rows()) == []
    assert rows(clustered_rows(empty, CHOICES[1], GRAIN)) == []
    write_clustered(communes(spark, 500), folder, PARTS)
    again = read_clustered(spark, folder, nothing.schema)
    assert texts(again.rows()) == texts(communes(spark, 500))


def test_a_failing_write_leaves_the_old_table(spark, folder):
    write_clustered(communes(spark, 300), folder, PARTS)
    broken = communes(spark, 400).withColumn("nb_dpe", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        write_clustered(broken, folder, PARTS)
    again = read_clustered(spark, folder, communes(spark, 0).schema)
    assert texts(again.rows()) == texts(communes(spark, 300))


def test_the_number_of_cells_is_bounded(spark, folder):
    with pytest.raises(ValueError):
        write_clustered(communes(spark, 10), folder, {"region": 100, "prix_m2": 100})

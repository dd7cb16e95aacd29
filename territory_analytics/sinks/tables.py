"""Writers whose rerun leaves the same table, whose failure leaves the old one, and the counts they report."""

from datetime import datetime
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .. import fixed_values as V
from ..operators.sampling import exact_sample
from ..sources import manifest
from ..sources.drifting_parquet import signature_of
from ..sources.tables import newest_partition, read_table
from .swap import Swap

MARTS = ("mart_commune", "mart_commune_type", "mart_opportunites", "dvf_stats_commune_type")
FILE_PATH, ROW_INDEX = "_file", "_row"


def business_date(explicit: str | None = None, upstream: str | None = None) -> str:
    """Explicit date, else the date carried by the upstream run, else today where the data is from."""
    return explicit or upstream or datetime.now(ZoneInfo(V.BUSINESS_ZONE)).date().isoformat()


def replace_partition(df: DataFrame, root: str, value: str, column: str = "dt", **options) -> int:
    """Replace one partition directory, also by nothing; other partitions stay.

    The old rows stay until the new ones are written, see ``swap``; ``df`` may even read them.  The exact
    folder is replaced: dynamic overwrite would keep the old rows when the new result is empty.
    """
    with Swap(df.sparkSession, root) as swap:
        return swap.write(df.drop(column), f"{root}/{column}={value}", **options)


def replace_table(df: DataFrame, root: str, **options) -> int:
    """Replace a whole table, under the same promise."""
    above = root.rstrip("/").rsplit("/", 1)[0]
    with Swap(df.sparkSession, above) as swap:
        return swap.write(df, root, **options)


def add_raw_parts(
    df: DataFrame,
    root: str,
    ds: str,
    departements,
    rows_per_part: int = V.ROWS_PER_PART,
    mixed: bool = True,
) -> dict[str, int]:
    """Replace the listed départements of one date, leave all others; rows per département back.

    Rows are first rebalanced by département, which splits a dominant one over several tasks, so a
    département has few files.  Where tasks hold one département each (``mixed`` off) they write
    straight to it.  A file is closed after ``rows_per_part`` rows.  Listed départements without rows
    end up empty; rows of any other département are an error, and nothing is replaced then.  The files are
    recorded in the table's manifest, so readers need not open them to plan.
    """
    spark, day = df.sparkSession, f"{root}/dt={ds}"
    listed = F.coalesce(F.col("dep").isin(*departements), F.lit(False))
    stray = F.concat(F.lit("rows outside the listed départements, such as "), F.coalesce("dep", F.lit("NULL")))
    # Checked by the counting of the write itself, whose files count only once all tasks have ended.
    checked = F.max(F.when(~listed, F.raise_error(stray).cast("string")))
    rows = df.drop("dt")
    seen = Observation()
    counts = [F.count_if(F.col("dep") == dep).alias(dep) for dep in departements]
    counted = rows.observe(seen, *counts, checked.alias("checked"))
    (
        (counted.hint("rebalance", "dep") if mixed else counted)
        .write.mode("overwrite")
        .options(
            compression="zstd", maxRecordsPerFile=rows_per_part, partitionOverwriteMode="dynamic"
        )
        .partitionBy("dep")
        .parquet(day)
    )
    written = {dep: seen.get[dep] for dep in departements}
    for dep in (d for d, n in written.items() if n == 0):
        nothing = spark.createDataFrame([], rows.drop("dep").schema)
        nothing.write.mode("overwrite").parquet(f"{day}/dep={dep}")
    signature = signature_of(to_arrow_schema(rows.drop("dep").schema))
    manifest.record(spark, root, [f"{day}/dep={dep}" for dep in departements], signature)
    return written


def row_identity(spark: SparkSession, root: str) -> DataFrame:
    """A Parquet table with the file and position of each row, which tell any two rows apart."""
    rows = read_table(spark, root)
    return rows.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.row_index").alias(ROW_INDEX),
    )


def export_snapshot(
    spark: SparkSession, gold: str, out: str, n: int = V.SNAPSHOT_ROWS, seed: int = 0
) -> dict[str, int]:
    """Marts whole, and an exact-size sample of the newest fact partition; rows per table."""
    written = {
        name: replace_table(read_table(spark, f"{gold}/{name}"), f"{out}/{name}") for name in MARTS
    }
    fact = f"{gold}/fact_biens"
    newest = row_identity(spark, fact).where(F.col("dt") == newest_partition(spark, fact))
    sample = exact_sample(newest, n, [FILE_PATH, ROW_INDEX], seed).drop(FILE_PATH, ROW_INDEX)
    written["fact_biens"] = replace_table(sample, f"{out}/fact_biens")
    return written

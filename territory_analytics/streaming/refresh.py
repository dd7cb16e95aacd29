"""Refresh silver certificates for the dates that received new raw files."""

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..operators.cleaning import clean_certificates
from ..sinks.swap import Swap
from ..sources.drifting_parquet import read_text_parts

FILE = "path string, modificationTime timestamp, length bigint, content binary"


def touched_dates(spark: SparkSession, raw_root: str) -> DataFrame:
    """Stream of the partition dates of files not seen before; the files themselves are not read."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(raw_root)
    )
    return files.select(F.regexp_extract("path", "/dt=([^/]+)/", 1).alias("dt"))


def refresh_silver(
    spark: SparkSession,
    raw_root: str,
    silver_root: str,
    progress: str,
    schema: T.StructType = schemas.RAW_CERTIFICATE,
    ties=None,
) -> None:
    """Process everything that arrived since the last call, then stop.

    The dates with new files are recomputed together, in one plan over all of their raw files, whose types
    and columns may drift, and become visible together.  So late parts, repeated batches and restarts from
    ``progress`` give the same silver partitions, and a backfill of many dates is one job.
    """

    def recompute(batch: DataFrame, _batch_id: int) -> None:
        # Dates, not rows, come back: one per touched day.
        dates = sorted(row["dt"] for row in batch.distinct().collect())
        if not dates:
            return
        session = batch.sparkSession
        raw = read_text_parts(session, raw_root, schema.names, scope={"dt": dates})
        cleaned = clean_certificates(raw, None, ties).hint("rebalance", "dt")
        with Swap(session, silver_root) as swap:
            swap.write_partitions(cleaned, silver_root, "dt", dates)

    query = (
        touched_dates(spark, raw_root)
        .writeStream.foreachBatch(recompute)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

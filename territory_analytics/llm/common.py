"""Helpers that several operators of this subpackage share."""

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Rows a task hands to Python at a time; with texts of some kilobytes this stays near a few MB.
ROWS_PER_BATCH = 1_000
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds: batches of at most ``ROWS_PER_BATCH`` rows."""
    if int(spark.conf.get(BATCH_SETTING)) > ROWS_PER_BATCH:
        spark.conf.set(BATCH_SETTING, str(ROWS_PER_BATCH))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2``, ... that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    names = [name, *(f"{name}_{k}" for k in range(1, len(taken) + 2))]
    return next(n for n in names if n.lower() not in taken)


def id_remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def text_bytes(texts: pa.Array) -> Iterable[bytes]:
    """The texts of an Arrow column in UTF-8; NULL counts as empty."""
    for value in texts.cast(pa.binary()):
        yield value.as_py() or b""

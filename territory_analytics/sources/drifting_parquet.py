"""Parquet parts whose column types drift from file to file, read as one all-text table."""

from functools import reduce

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .manifest import known_signatures
from .parts import by_signature, list_files, open_part, scoped_folders


def signature_of(fields: pa.Schema) -> str:
    return ";".join(f"{f.name}:{f.type}" for f in fields)


def schema_of(path: str) -> str:
    with open_part(path) as handle:
        return signature_of(pq.read_schema(handle))


def codecs(files: DataFrame) -> DataFrame:
    """``path`` and ``codec`` of every column chunk of listed Parquet files; only footers are read."""

    def read(batches):
        for batch in batches:
            found = []
            for path in batch["path"]:
                with open_part(path) as handle:
                    footer = pq.read_metadata(handle)
                groups = [footer.row_group(g) for g in range(footer.num_row_groups)]
                kinds = {group.column(c).compression for group in groups for c in range(group.num_columns)}
                found += [(path, kind) for kind in sorted(kinds)]
            yield pd.DataFrame(found, columns=["path", "codec"])

    return files.select("path").mapInPandas(read, "path string, codec string")


def read_text_parts(
    spark: SparkSession, root: str, columns, partitions=("dt", "dep"), scope: dict | None = None
) -> DataFrame:
    """All parts below ``root`` united by column name, every column as text.

    One scan per distinct file schema, so pruning and push-down still reach Parquet.  Columns a part
    lacks are NULL.  Partition values keep their exact text ("01", "2A").  ``scope`` maps partition
    columns to the values wanted; of the first one, folders of other values are not even listed.  Files
    that the table's manifest lists are not opened to plan.
    """
    scope, first = scope or {}, partitions[0] if partitions else None
    folders = scoped_folders(spark, root, first, scope[first]) if first in scope else [root]
    groups = {}
    if folders:
        files = list_files(spark, folders, "*.parquet")
        for name, values in scope.items():
            files = files.where(F.regexp_extract("path", f"/{name}=([^/]+)/", 1).isin(*values))
        groups = by_signature(known_signatures(spark, root, files), schema_of)
    if not groups:
        raise FileNotFoundError(f"no part below {root} for {scope or 'any partition'}")
    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [_read_group(spark, root, groups[kind], columns, partitions) for kind in sorted(groups)],
    ).select(*columns, *partitions)


def _read_group(spark, root, paths, columns, partitions) -> DataFrame:
    own = spark.read.parquet(paths[0]).schema
    fields = [f for f in own.fields if f.name in columns and f.name not in partitions]
    schema = T.StructType(fields + [T.StructField(p, T.StringType()) for p in partitions])
    group = spark.read.schema(schema).option("basePath", root).parquet(*paths)
    present = {f.name for f in fields}
    missing = [F.lit(None).cast("string").alias(c) for c in columns if c not in present]
    return group.select(
        *[F.col(c).cast("string").alias(c) for c in columns if c in present], *missing, *partitions
    )

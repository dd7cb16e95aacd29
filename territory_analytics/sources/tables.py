"""Typed tables: whole, one business date, or the newest one."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .parts import partition_values


def read_table(spark: SparkSession, root: str, schema: T.StructType | None = None) -> DataFrame:
    """Every partition below ``root``; a given schema fixes types and column order."""
    if schema is None:
        return spark.read.parquet(root)
    return spark.read.schema(schema).parquet(root).select(*schema.names)


def read_partition(
    spark: SparkSession, root: str, ds: str, schema: T.StructType | None = None, column: str = "dt"
) -> DataFrame:
    """One business date; the scan lists and reads that directory only."""
    return read_table(spark, root, schema).where(F.col(column) == F.lit(ds).cast("date"))


def newest_partition(spark: SparkSession, root: str, column: str = "dt") -> str | None:
    """Greatest partition value that has rows, from the listing of folders; no other file is opened."""
    for value in reversed(partition_values(spark, root, column)):
        if not spark.read.parquet(f"{root}/{column}={value}").isEmpty():
            return value
    return None


@dataclass(frozen=True)
class PartitionedTable:
    """A table with the place of its partitions, so that one is chosen before anything is planned."""

    spark: SparkSession
    root: str
    schema: T.StructType
    column: str = "dt"

    def rows(self) -> DataFrame:
        return read_table(self.spark, self.root, self.schema)

    def at(self, value: str) -> DataFrame:
        """One partition; no other folder is listed."""
        own = T.StructType([field for field in self.schema if field.name != self.column])
        rows = self.spark.read.schema(own).parquet(f"{self.root}/{self.column}={value}")
        kind = self.schema[self.column].dataType
        return rows.select(*[F.lit(value).cast(kind).alias(c) if c == self.column else c for c in self.schema.names])

    def newest(self) -> DataFrame:
        """The newest partition that has rows; without any, an empty table."""
        value = newest_partition(self.spark, self.root, self.column)
        return self.spark.createDataFrame([], self.schema) if value is None else self.at(value)

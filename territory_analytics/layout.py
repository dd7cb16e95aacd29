"""Tables laid out by area: rows of one area lie in one bucket, so what groups or joins by area needs no shuffle.

A partition of such a table has two parts.  ``part=even-N`` holds the areas of moderate size in N buckets
by the hash of the area; ``part=hot`` the rows of oversized areas, spread over plain files, because a
bucket is read by one task and an area that holds a third of all rows must not be.  Both together are an
ordinary partitioned Parquet table for readers that do not care.
"""

import hashlib
import math
import re
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from .operators.joins import join_groups
from .operators.quantiles import VALUE_LIMIT
from .sinks.swap import Swap
from .storage import durable, file_system

#: Rows that a bucket holds on average at most, besides at least one bucket per shuffle partition.
ROWS_PER_BUCKET = 2_000_000
_EVEN = re.compile(r"part=even-(\d+)$")


@dataclass(frozen=True)
class ByArea:
    """Rows laid out by ``column`` in ``buckets``; no area of ``even`` has more than ``largest`` rows."""

    even: DataFrame
    hot: DataFrame | None
    column: str
    buckets: int
    largest: int

    def rows(self) -> DataFrame:
        return self.even if self.hot is None else self.even.unionByName(self.hot)

    def each(self, build: Callable[..., DataFrame]) -> DataFrame:
        """``build`` on either part, told how to group it; results of different areas are simply united.

        The even part is grouped where it lies; the hot part by counting, see ``grouped_quantiles``.
        """
        parts = [build(self.even, largest=self.largest, limit=self.largest, gather=False)]
        if self.hot is not None:
            parts.append(build(self.hot, limit=self.largest, gather=False))
        return reduce(DataFrame.unionByName, parts)

    def map(self, change: Callable[[DataFrame], DataFrame]) -> "ByArea":
        """Both parts changed row by row; the area column must stay, and no area may gain rows."""
        return replace(self, even=change(self.even), hot=None if self.hot is None else change(self.hot))


def lay_out(df: DataFrame, column: str = "code_insee", limit: int = VALUE_LIMIT) -> ByArea:
    """Split a stored table into even and hot areas; the even ones are shuffled by area, once.

    Areas of more than ``limit`` rows are hot.  They are counted on the area column alone.
    """
    sizes = durable(df.groupBy(column).count().withColumn("hot", F.col("count") > limit))
    rows, oversized = sizes.agg(F.sum("count"), F.max("hot")).first()
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = max(least, math.ceil((rows or 0) / ROWS_PER_BUCKET))
    even, hot = df, None
    if oversized:
        named = sizes.where("hot").select(column)
        even, hot = (join_groups(df, named, [column], how) for how in ("left_anti", "left_semi"))
    return ByArea(even.repartition(buckets, column), hot, column, buckets, limit)


def write_by_area(swap: Swap, table: ByArea, place: str) -> int:
    """Write the future rows of ``place`` in their layout, without another shuffle; rows written."""
    even = table.even.drop("dt").repartition(table.buckets, table.column)
    written = swap.write(even, place, f"part=even-{table.buckets}", buckets=(table.buckets, table.column))
    if table.hot is not None:
        written += swap.write(table.hot.drop("dt"), place, "part=hot")
    return written


def replace_by_area(table: ByArea, root: str, value: str) -> int:
    """Replace the partition ``dt=value``; the old rows stay until the new ones are written."""
    with Swap(table.even.sparkSession, root) as swap:
        return write_by_area(swap, table, f"{root}/dt={value}")


def read_by_area(
    spark: SparkSession, root: str, value: str, schema: T.StructType, column: str = "code_insee", limit: int = VALUE_LIMIT
) -> ByArea:
    """The partition ``dt=value`` of a table written by area, under its declared ``schema``.

    One that was stored without a layout is laid out when it is read.
    """
    place = f"{root}/dt={value}"
    system, path = file_system(spark, place)
    names = [entry.getPath().getName() for entry in system.listStatus(path(place))]
    own = T.StructType([field for field in schema if field.name != "dt"])
    dated = [F.lit(value).cast("date").alias(c) if c == "dt" else F.col(c) for c in schema.names]
    found = next((match for match in map(_EVEN.match, names) if match), None)
    if found is None:
        return lay_out(spark.read.schema(own).parquet(place).select(*dated), column, limit)
    even = bucketed_table(spark, f"{place}/{found.group()}", own, column, int(found.group(1))).select(*dated)
    hot = None
    if "part=hot" in names:
        hot = spark.read.schema(own).parquet(f"{place}/part=hot").select(*dated)
    return ByArea(even, hot, column, int(found.group(1)), limit)


def bucketed_table(spark: SparkSession, place: str, schema: T.StructType, column: str, buckets: int) -> DataFrame:
    """Bucketed files under their table definition, which only the catalog can carry.

    The table is external: dropping it leaves the files alone.  Its name is that of its place.
    """
    name = f"by_area_{hashlib.md5(place.encode()).hexdigest()}"
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({fields}) USING parquet "
        f"CLUSTERED BY (`{column}`) SORTED BY (`{column}`) INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)

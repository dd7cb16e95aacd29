"""Serving tables clustered over several columns, so that a filtered query opens few of their files.

Rows are cut into cells of about equal size: at approximate quantiles of the first column, every part of that
at quantiles of the second column within it, and so on.  A cell is a folder, and a small table beside the
rows holds least and greatest values per cell.  A query first asks that table which cells its filters can
touch; Spark then lists and opens only those folders.  Inside a folder rows are sorted by the same columns, so
footer statistics rule out more; columns that are looked up by value have Bloom filters where a file has no
dictionary of them.
"""

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .operators.joins import fresh
from .sinks.swap import Swap
from .storage import durable

#: Cells of a table at most.  Their cuts are broadcast and the wanted ones come to the driver, so this bounds both.
MOST_CELLS = 4_096
#: Leading bytes of a text that decide where it is cut.
PREFIX_BYTES = 6
ACCURACY = 1_000

#: (column, lowest, highest): the rows whose value lies between both; None is no bound.
Interval = tuple[str, object, object]


def _number(df: DataFrame, column: str) -> Column:
    """A number in the order of the column; texts are ordered by their first bytes."""
    if not isinstance(df.schema[column].dataType, T.StringType):
        return F.col(column).cast("double")
    digits = F.rpad(F.hex(F.substring(F.col(column).cast("binary"), 1, PREFIX_BYTES)), 2 * PREFIX_BYTES, "0")
    return F.conv(digits, 16, 10).cast("double")


def _placed(df: DataFrame, parts: dict[str, int], cell: str) -> DataFrame:
    """``df`` with the number of each row's cell; a NULL lies with the least values."""
    cuts = fresh(df, "cuts")
    placed = df.withColumn(cell, F.lit(0))
    for column, count in parts.items():
        number = _number(df, column)
        shares = [k / count for k in range(1, count)]
        found = F.percentile_approx(number, shares, ACCURACY).alias(cuts)
        # At most MOST_CELLS rows of few numbers each.
        known = F.broadcast(durable(placed.groupBy(cell).agg(found)))
        below = F.size(F.filter(F.coalesce(cuts, F.array().cast("array<double>")), lambda cut: cut < number))
        placed = placed.join(known, cell).withColumn(cell, F.col(cell) * count + below).drop(cuts)
    return placed.select(*df.columns, cell)


@dataclass(frozen=True)
class Clustered:
    """A clustered table: ``stored`` rows with their ``cell``, and ``bounds`` of every cell by column."""

    stored: DataFrame
    bounds: DataFrame
    cell: str

    def rows(self) -> DataFrame:
        return self.stored.drop(self.cell)

    def cells(self, wanted: Sequence[Sequence[Interval]]) -> list[int]:
        """Cells that may hold rows inside one interval of every group; groups over other columns rule out none."""
        known = set(self.bounds.columns)
        groups = [group for group in wanted if all(f"least_{column}" in known for column, *_ in group)]
        tests = [reduce(Column.__or__, [_touches(*interval) for interval in group]) for group in groups]
        touched = self.bounds.where(reduce(Column.__and__, tests, F.lit(True)))
        return sorted(row[0] for row in touched.select(self.cell).collect())

    def pick(self, wanted: Sequence[Sequence[Interval]]) -> DataFrame:
        """Rows of those cells: all that can satisfy ``wanted``, and others.  The filter itself is still to come."""
        cells = self.cells(wanted)
        return self.stored.where(F.col(self.cell).isin(cells) if cells else F.lit(False)).drop(self.cell)


def _touches(column: str, lowest, highest) -> Column:
    """Whether a cell's values reach into the interval; a cell that has only NULL does not."""
    test = F.col(f"least_{column}").isNotNull()
    if lowest is not None:
        test &= F.col(f"greatest_{column}") >= F.lit(lowest)
    if highest is not None:
        test &= F.col(f"least_{column}") <= F.lit(highest)
    return test


def write_clustered(
    df: DataFrame, root: str, parts: dict[str, int], bounded: Sequence[str] = (), looked_up: Sequence[str] = ()
) -> Clustered:
    """Replace the table below ``root``; the old one stays until the new one is written.

    ``parts`` says into how many parts each column cuts, the first one first; bounds are kept of these columns
    and of ``bounded``, Bloom filters of ``looked_up``.  ``df`` is read once per column and once more, so it
    should be stored.  A cell that is larger than others, as one of a frequent value is, has more files, not a
    larger task.
    """
    if math.prod(parts.values()) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells")
    spark, cell = df.sparkSession, fresh(df, "cell")
    placed = _placed(df, parts, cell)
    blooms = {f"parquet.bloom.filter.enabled#{column}": "true" for column in looked_up}
    with Swap(spark, root) as swap:
        gathered = placed.hint("rebalance", cell).sortWithinPartitions(cell, *parts)
        swap.write(gathered, f"{root}/rows", partition=cell, **blooms)
        written = spark.read.schema(placed.schema).parquet(swap.at(f"{root}/rows"))
        ends = [
            end(column).alias(f"{name}_{column}")
            for column in dict.fromkeys([*parts, *bounded])
            for name, end in (("least", F.min), ("greatest", F.max))
        ]
        swap.write(written.groupBy(cell).agg(F.count("*").alias("n_rows"), *ends), f"{root}/cells")
    return read_clustered(spark, root, df.schema)


def read_clustered(spark: SparkSession, root: str, schema: T.StructType) -> Clustered:
    """A table that ``write_clustered`` stored, whose rows have the declared ``schema``."""
    bounds = spark.read.parquet(f"{root}/cells")
    cell = bounds.columns[0]
    stored = spark.read.schema(T.StructType([*schema, T.StructField(cell, T.IntegerType())]))
    return Clustered(stored.parquet(f"{root}/rows"), bounds, cell)

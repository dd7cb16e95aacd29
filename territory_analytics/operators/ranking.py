"""Rank of a row inside its parent group."""

from pyspark.sql import DataFrame, Window as W, functions as F

from ..storage import durable
from .joins import fresh, join_groups
from .quantiles import GROUP_LIMIT, largest_group


# Distinct values that one task sorts again.
VALUES_PER_FILE = 1_000_000


def rank_in_group(
    df: DataFrame,
    keys,
    value: str,
    name: str,
    largest: int | None = None,
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Add ``name``: 1 for the greatest ``value`` of the group, equal values share a rank.

    Moderate groups are ranked by one window.  Groups larger than ``limit`` are split off, and their
    distinct values are counted and ranked instead, see ``_value_ranks``; both give the same ranks.
    """
    keys = list(keys)
    if largest is None:
        largest = largest_group(df, keys, limit)
    if largest <= limit:
        return _window_ranks(df, keys, value, name)
    # At most rows / limit keys.
    size = fresh(df, "size")
    oversized = durable(df.groupBy(*keys).agg(F.count("*").alias(size)).where(F.col(size) > limit).select(*keys))
    moderate = join_groups(df, oversized, keys, "left_anti")
    hot = join_groups(df, oversized, keys, "left_semi")
    ranks = durable(_value_ranks(hot, keys, value, name))
    counted = join_groups(hot, ranks, [*keys, value], "inner")
    return _window_ranks(moderate, keys, value, name).unionByName(counted)


def _window_ranks(df, keys, value, name) -> DataFrame:
    order = F.col(value).desc_nulls_last()
    return df.withColumn(name, F.rank().over(W.partitionBy(*keys).orderBy(order)).cast("bigint"))


def _value_ranks(df, keys, value, name) -> DataFrame:
    """Rank of every distinct value of a group, without one task holding the group.

    The counted values are range-sorted and stored, which cuts any group into files of even size.  A
    value's rank is one more than the rows in the files above its own and above it in its own.
    """
    falling = F.col(value).desc_nulls_last()
    n, file, file_n, top, above = (fresh(df, x) for x in ("n", "file", "file_n", "top", "above"))
    counted = df.groupBy(*keys, value).agg(F.count("*").alias(n))
    stored = durable(counted.orderBy(*keys, falling), maxRecordsPerFile=VALUES_PER_FILE)
    stored = stored.withColumn(file, stored.metadataColumn("_metadata")["file_path"])

    files = stored.groupBy(*keys, file).agg(F.sum(n).alias(file_n), F.max(value).alias(top))
    before = W.unboundedPreceding, -1
    files_above = W.partitionBy(*keys).orderBy(F.col(top).desc_nulls_last()).rowsBetween(*before)
    values_above = W.partitionBy(*keys, file).orderBy(falling).rowsBetween(*before)
    starts = files.select(
        *keys, file, F.coalesce(F.sum(file_n).over(files_above), F.lit(0)).alias(above)
    )
    within = F.coalesce(F.sum(n).over(values_above), F.lit(0))
    return join_groups(stored, starts, [*keys, file], "inner").select(
        *keys, value, (F.lit(1) + F.col(above) + within).cast("bigint").alias(name)
    )

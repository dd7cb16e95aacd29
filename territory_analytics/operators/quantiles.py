"""Exact continuous quantiles per group, safe for groups of any size.

The built-in ``percentile`` is exact but holds every distinct value of a group in one task.  That is
the cheapest plan for moderate groups, which a combinable count tells apart.  In an oversized group two
scans find the quantile.  The first builds a mergeable quantile sketch, whose values just below and just
above a wanted rank bracket it; the second counts the rows below each bracket and the values inside it,
some thousandth of the group, which are then placed exactly.  Brackets follow ranks, so no distribution
needs a third scan; should a sketch err beyond its bound, the counts show it and only that bracket is
widened and counted again.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import durable
from .joins import join_groups

# Rows of a group one task may sort or buffer in a window, which spills.
GROUP_LIMIT = 1_000_000
# Rows of a group whose values may sit in the percentile buffer.  An aggregating task holds up to 128
# such buffers of some 100 bytes a value on its heap, so this stays near one gigabyte.
VALUE_LIMIT = 100_000
# The sketch errs by one in so many rows of a group; a bracket reaches that many times as far.
ACCURACY, REACH = 10_000, 4
WIDER = 16

_METRIC, _VALUE, _ALL = "_metric", "_value", "_all"


def largest_group(df: DataFrame, keys, limit: int = GROUP_LIMIT) -> int:
    """Rows of the biggest group.

    One job: counts combine before the shuffle and one number comes back.  ``limit`` is what the caller
    compares it with.
    """
    if not keys:
        return df.count()
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def grouped_quantiles(
    df: DataFrame,
    keys,
    wanted: dict[str, tuple[str, float]],
    others: tuple[Column, ...] | list[Column] = (),
    largest: int | None = None,
    limit: int = VALUE_LIMIT,
    gather: bool = True,
) -> DataFrame:
    """``keys``, the ``others`` aggregates, then one column per wanted ``name: (column, p)``.

    ``largest`` is an upper bound of the rows (or distinct values) per group when the caller knows
    one; otherwise it is counted.  NULL values are ignored; a group without values gets NULL.
    ``gather`` shuffles plain rows by key before grouping, the cheaper way when values hardly repeat;
    without it value counts combine before the shuffle, which pays when they do.
    """
    keys = list(keys)
    if largest is None:
        largest = largest_group(df, keys, limit)
    if largest <= limit:
        return _one_pass(df, keys, wanted, others, gather)
    if not keys:
        return _by_counting(df, keys, wanted, others, limit)

    # At most rows / limit keys, so the table that splits the rows stays small.
    oversized = durable(df.groupBy(*keys).count().where(F.col("count") > limit).select(*keys))
    moderate = join_groups(df, oversized, keys, "left_anti")
    hot = join_groups(df, oversized, keys, "left_semi")
    return _one_pass(moderate, keys, wanted, others, gather).unionByName(
        _by_counting(hot, keys, wanted, others, limit)
    )


def _one_pass(df, keys, wanted, others, gather) -> DataFrame:
    asked = _shares_by_column(wanted)
    if gather and keys:
        df = df.repartition(*keys)
    buffers = [
        F.percentile(_one_zero(column), F.array(*[F.lit(p) for p in shares])).alias(f"_q_{column}")
        for column, shares in asked.items()
    ]
    grouped = df.groupBy(*keys).agg(*others, *buffers)
    kept = [c for c in grouped.columns if not c.startswith("_q_")]
    return grouped.select(
        *kept,
        *[
            F.col(f"_q_{column}")[asked[column].index(p)].alias(name)
            for name, (column, p) in wanted.items()
        ],
    )


def _one_zero(column: str) -> Column:
    """The column as a double with a single zero, as grouping has it."""
    return F.col(column).cast("double") + F.lit(0.0)


def _shares_by_column(wanted) -> dict[str, list[float]]:
    asked: dict[str, list[float]] = {}
    for column, p in wanted.values():
        shares = asked.setdefault(column, [])
        if p not in shares:
            shares.append(p)
    return asked


def _place(p: float) -> Column:
    return F.lit(p) * (F.col("_total") - 1)


def _by_counting(df, keys, wanted, others, limit) -> DataFrame:
    whole_table = not keys
    if whole_table:
        df, keys = df.withColumn(_ALL, F.lit(0)), [_ALL]
    asked = _shares_by_column(wanted)
    rows = df.select(
        *keys,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias(_METRIC), _one_zero(c).alias(_VALUE))
                    for c in asked
                ]
            )
        ),
    ).where(F.col(_VALUE).isNotNull())

    # At least two ranks of a group of more than ``limit`` rows.
    reach = max(REACH / ACCURACY, 2 / max(1, limit))
    brackets = durable(_brackets(rows, keys, asked, reach))
    placed = durable(_placed_in(rows, keys, brackets))
    while reach < 1:
        missed = durable(_missed(brackets, placed, keys))
        if missed.isEmpty():
            break
        reach *= WIDER
        path = [*keys, _METRIC, "_share"]
        kept = join_groups(brackets, missed, path, "left_anti")
        wider = join_groups(_brackets(rows, keys, asked, reach), missed, path, "left_semi")
        brackets = durable(kept.unionByName(wider))
        placed = durable(_placed_in(rows, keys, brackets))
    found = _at_wanted_ranks(placed, keys, wanted)
    base = df.groupBy(*keys).agg(F.count("*").alias("_rows"), *others).drop("_rows")
    result = join_groups(base, found, keys)
    return result.drop(_ALL) if whole_table else result


def _brackets(rows, keys, asked, reach: float) -> DataFrame:
    """First scan: per group, column and wanted share the values that enclose its rank; NULL where open."""
    shares = sorted({p for ps in asked.values() for p in ps})
    cuts = sorted({c for p in shares for c in (p - reach, p + reach) if 0 < c < 1})
    sketch = F.percentile_approx(_VALUE, [*cuts, 0.5], ACCURACY)
    sketched = rows.groupBy(*keys, _METRIC).agg(F.count("*").alias("_total"), sketch.alias("_cuts"))

    def cut(share: float):
        return F.col("_cuts")[cuts.index(share)] if share in cuts else F.lit(None).cast("double")

    # One entry per share that the column is asked for.
    entries = [
        F.struct(F.lit(column).alias("_asked"), F.lit(p).alias("_share"), cut(p - reach).alias("_low"), cut(p + reach).alias("_high"))
        for column, ps in asked.items()
        for p in ps
    ]
    each = sketched.select(*keys, _METRIC, "_total", F.inline(F.array(*entries)))
    return each.where(F.col("_asked") == F.col(_METRIC)).drop("_asked")


def _placed_in(rows, keys, brackets) -> DataFrame:
    """Second scan: values inside the brackets with the number of rows before them; counts combine early."""
    path = [*keys, _METRIC, "_share"]
    met = join_groups(rows, brackets, [*keys, _METRIC], "inner")
    inside = met.where(F.col("_high").isNull() | (F.col(_VALUE) <= F.col("_high")))
    # Rows below a bracket are only counted.
    below = F.col("_low").isNotNull() & (F.col(_VALUE) < F.col("_low"))
    counted = inside.groupBy(*path, "_total", F.when(~below, F.col(_VALUE)).alias(_VALUE)).agg(F.count("*").alias("_copies"))
    # A row below sorts first, as NULL does.
    earlier = W.partitionBy(*path).orderBy(F.col(_VALUE).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    return counted.withColumn("_from", F.coalesce(F.sum("_copies").over(earlier), F.lit(0))).where(F.col(_VALUE).isNotNull())


def _missed(brackets, placed, keys) -> DataFrame:
    """Brackets that do not hold both neighbours of their rank."""
    path = [*keys, _METRIC, "_share"]
    place = F.col("_share") * (F.col("_total") - 1)
    covers = [
        F.count_if((rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_copies")))
        for rank in (F.floor(place), F.ceil(place))
    ]
    held = placed.groupBy(*path).agg(F.least(*covers).alias("_held")).where("_held > 0").drop("_held")
    return join_groups(brackets.select(*path), held, path, "left_anti")


def quantiles_of_counts(counts: DataFrame, keys, metric: str, value: str, n: str, wanted) -> DataFrame:
    """Exact quantiles of values that are stored with how often they occur: ``keys``, one column per wanted.

    ``metric`` names the column a value belongs to.  A group's distinct values are sorted in one task,
    which spills; its rows are never expanded.
    """
    keys = list(keys)
    renamed = counts.select(*keys, F.col(metric).alias(_METRIC), F.col(value).alias(_VALUE), F.col(n).alias("_copies"))
    # One shuffle serves the sums and the window: stored values hardly repeat.
    dealt = renamed.repartition(*keys, _METRIC)
    summed = dealt.groupBy(*keys, _METRIC, _VALUE).agg(F.sum("_copies").alias("_copies")).where("_copies > 0")
    group = W.partitionBy(*keys, _METRIC)
    earlier = group.orderBy(_VALUE).rowsBetween(W.unboundedPreceding, -1)
    placed = summed.withColumns(
        {"_from": F.coalesce(F.sum("_copies").over(earlier), F.lit(0)), "_total": F.sum("_copies").over(group)}
    )
    return _at_wanted_ranks(placed, keys, wanted)


def _at_wanted_ranks(values, keys, wanted) -> DataFrame:
    """Values at the wanted ranks, interpolated between the two neighbours."""

    def at(column, rank):
        covered = (rank >= F.col("_from")) & (rank < F.col("_from") + F.col("_copies"))
        return F.max(F.when((F.col(_METRIC) == column) & covered, F.col(_VALUE)))

    picks = []
    for name, (column, p) in wanted.items():
        place = _place(p)
        picks += [
            at(column, F.floor(place)).alias(f"_lower_{name}"),
            at(column, F.ceil(place)).alias(f"_upper_{name}"),
            F.max(F.when(F.col(_METRIC) == column, place)).alias(f"_place_{name}"),
        ]
    picked = values.groupBy(*keys).agg(*picks)

    def between(name):
        place = F.col(f"_place_{name}")
        lower, upper = F.col(f"_lower_{name}"), F.col(f"_upper_{name}")
        mixed = (F.ceil(place) - place) * lower + (place - F.floor(place)) * upper
        return F.when(lower == upper, lower).otherwise(mixed).alias(name)

    return picked.select(*keys, *[between(name) for name in wanted])

"""Joins on equal keys where two NULL keys match, as they do in a grouping."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it, in any case."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def join_groups(left: DataFrame, groups: DataFrame, keys, how: str = "left") -> DataFrame:
    """Join rows with a table of one row per key: its columns are attached, or it selects rows."""
    renamed = groups.select(
        *[F.col(k).alias(f"_group_{k}") for k in keys],
        *[F.col(c) for c in groups.columns if c not in keys],
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_group_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[c for c in renamed.columns if c.startswith("_group_")])

"""Quality gate: named rules counted in one pass."""

from pyspark.sql import Column, DataFrame, functions as F

from .. import fixed_values as V


def fact_rules(labels=V.LABELS) -> dict[str, Column]:
    """Rule name to the condition that marks a bad row."""
    return {
        "code_insee_null": F.col("code_insee").isNull(),
        "bad_dpe": ~F.col("etiquette").isin(*labels),
        "future_date": F.col("dt") > F.current_date(),
    }


def quality_gate(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """One row per rule: how many rows break it and whether it passes.

    ``not_empty`` always comes first; its ``n`` is the number of rows.
    """
    counted = df.agg(
        F.count("*").alias("not_empty"),
        *[F.count_if(bad).alias(name) for name, bad in rules.items()],
    )
    long = counted.unpivot([], ["not_empty", *rules], "rule", "n")
    passed = F.when(F.col("rule") == "not_empty", F.col("n") > 0).otherwise(F.col("n") == 0)
    return long.withColumn("passed", passed)


def gate_passes(gate: DataFrame) -> bool:
    return gate.where(~F.col("passed")).isEmpty()

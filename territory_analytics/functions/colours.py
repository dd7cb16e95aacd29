"""Map colours and GeoJSON features."""

from pyspark.sql import Column, functions as F

from .. import fixed_values as V


def palette_of(metric: str):
    return V.PALETTE_SIEVES if metric == "pct_passoires" else V.PALETTE_PRICE


def fill_colour(value: Column, low: Column, high: Column, palette) -> Column:
    """RGBA between the two palette ends; grey where there is no value."""
    start, end = palette
    share = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (value - low) / (high - low)))
    mixed = [F.rint(F.lit(a) + F.lit(b - a) * share).cast("int") for a, b in zip(start, end)]
    grey = F.array(*[F.lit(c) for c in V.NO_VALUE_COLOUR])
    known = value.isNotNull() & ~F.isnan(value)
    return F.when(known, F.array(*mixed, F.lit(V.FILL_ALPHA))).otherwise(grey)


def geometry(text: Column) -> Column:
    """Parsed geometry; NULL for missing, empty or broken JSON."""
    return F.try_parse_json(F.nullif(text, F.lit("")))


def feature_json(geometry_value: Column, properties: Column) -> Column:
    feature = F.struct(
        F.lit("Feature").alias("type"),
        geometry_value.alias("geometry"),
        properties.alias("properties"),
    )
    return F.to_json(feature, {"ignoreNullFields": "false"})

"""Categories, scores and wording derived from a row."""

from functools import reduce

from pyspark.sql import Column, functions as F

from .. import fixed_values as V
from .numbers import half_away


def property_type(text: Column) -> Column:
    """Normalised property type by the words the text contains."""
    flat, house, other = V.PROPERTY_TYPES
    return F.when(text.contains("appart"), flat).when(text.contains("maison"), house).otherwise(other)


def band(value: Column, edges=V.AREA_EDGES, names=V.AREA_BANDS) -> Column:
    """Name of the first band whose upper edge lies above the value; the last one is open."""
    steps = zip(edges[1:], names[1:])
    first = F.when(value < edges[0], names[0])
    return reduce(lambda rule, s: rule.when(value < s[0], s[1]), steps, first).otherwise(names[-1])


def is_sieve(label: Column) -> Column:
    return label.isin(*V.SIEVE_LABELS)


def raw_score(z: Column, sieve_share: Column) -> Column:
    """60 % under-pricing against the parent area, 40 % share of energy sieves."""
    under = F.greatest(-F.coalesce(z, F.lit(0.0)), F.lit(0.0))
    share = F.coalesce(sieve_share, F.lit(0.0))
    return F.lit(V.PRICE_WEIGHT) * under * V.Z_SCALE + F.lit(V.SIEVE_WEIGHT) * share


def opportunity_score(z: Column, sieve_share: Column) -> Column:
    return half_away(raw_score(z, sieve_share), 1)


def underpriced(z: Column, k: float) -> Column:
    """NULL where there is no z-score."""
    return z < -k


def mart_wording(flag: Column, sieve_share: Column) -> Column:
    """Everything that is not flagged, fairly priced or unscored rows included, reads over-priced."""
    return (
        F.when(flag & (sieve_share >= V.SIEVE_SHARE), V.LABEL_RENOVATION)
        .when(flag, V.LABEL_UNDERPRICED)
        .otherwise(V.LABEL_OVERPRICED)
    )


def serving_wording(sieve_share: Column) -> Column:
    return F.when(sieve_share >= V.SIEVE_SHARE, V.LABEL_DOUBLE_SIGNAL).otherwise(V.LABEL_UNDERPRICED)


def badges(gap: Column, sieve_share: Column) -> Column:
    return F.concat_ws(
        V.BADGE_SEPARATOR,
        F.when(gap < 0, V.LABEL_UNDERPRICED),
        F.when(sieve_share >= V.SIEVE_SHARE, V.BADGE_SIEVES),
    )


def label_position(label: Column) -> Column:
    """Place of a label on the A to G scale, for ordering categories."""
    return F.array_position(F.array(*[F.lit(name) for name in V.LABELS]), label)

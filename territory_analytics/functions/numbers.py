"""Rounding, guarded division and order-preserving slots."""

from pyspark.sql import Column, functions as F

SLOTS_PER_UNIT = 64
# Slots of the infinities, and of NaN, which sorts above everything.
LAST_SLOT = 2**62
NAN_SLOT = 2**63 - 1


def half_away(value: Column, digits: int = 0) -> Column:
    """Round halves away from zero on the scaled double.

    ``F.round(1.005, 2)`` works on the decimal text of the number and gives 1.01; the wanted results
    scale first and give 1.0.  The sign survives, so a small negative gap reads -0.0.
    """
    scale = F.lit(float(10**digits))
    scaled = value * scale if digits else value
    rounded = F.signum(scaled) * F.round(F.abs(scaled), 0)
    return rounded / scale if digits else rounded


def half_even(value: Column, digits: int = 0) -> Column:
    scale = F.lit(float(10**digits))
    return F.rint(value * scale) / scale


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; NULL where the divisor is zero."""
    return part / F.nullif(whole, F.lit(0))


def percent_gap(value: Column, base: Column) -> Column:
    return ratio(F.lit(100.0) * (value - base), base)


def percent_true(flag: Column) -> Column:
    """Share of rows where ``flag`` holds, as an aggregate in percent; NULL counts as no."""
    return half_away(F.lit(100.0) * F.avg(F.when(flag, 1).otherwise(0)), 2)


def down_to_step(value: Column, step: int) -> Column:
    return F.floor(value / step) * step


def ordered_slot(value: Column, per_unit: int = SLOTS_PER_UNIT) -> Column:
    """Slot number that never decreases as ``value`` grows.

    A logarithmic grid: about 1.5 % wide slots, at most some 90 000 over the whole double range.
    It depends on the value alone, so a retried task puts a row in the same slot.
    """
    infinite = F.lit(float("inf"))
    slot = F.floor(F.signum(value) * F.log1p(F.abs(value)) * per_unit)
    return (
        F.when(F.isnan(value), F.lit(NAN_SLOT))
        .when(value == infinite, F.lit(LAST_SLOT))
        .when(value == -infinite, F.lit(-LAST_SLOT))
        .otherwise(slot.cast("bigint"))
    )


def even_slot(value: Column, low: Column, high: Column, width: int) -> Column:
    """Slot number of ``value`` on an even grid of ``width`` slots between two bounds."""
    place = F.floor(ratio(value - low, high - low) * width).cast("bigint")
    return F.when(high > low, F.least(F.lit(width - 1).cast("bigint"), place)).otherwise(
        F.lit(0).cast("bigint")
    )

"""Exact-size random sample."""

from pyspark.sql import DataFrame, Window as W, functions as F

from .joins import fresh

DRAW = "_draw"
SLOT_DIGITS = 4
# Rows of the last slot that one task may order.
LAST_ROWS = 10_000


def exact_sample(df: DataFrame, n: int, identity, seed: int = 0) -> DataFrame:
    """Exactly ``n`` rows (all if there are fewer), the same rows on every run.

    ``identity`` names columns that together tell rows apart.  Each row draws a number from them and
    the seed.  Draws are counted in 65 536 even slots, slots below the cut are taken whole, and the cut
    slot is cut finer in the same way until few rows are left to order.  A plain
    ``orderBy(rand()).limit(n)`` would pass ``n`` rows of every partition through one task.
    """
    draw = fresh(df, DRAW)
    drawn = df.withColumn(
        draw, F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in identity]))
    )
    prefix, wanted = "", n
    while True:
        digits = len(prefix) + SLOT_DIGITS
        inside = drawn.where(F.col(draw).startswith(prefix)) if prefix else drawn
        counts = inside.groupBy(F.substring(draw, 1, digits).alias("slot")).agg(F.count("*").alias("rows"))
        # At most 65 536 rows.
        running = W.orderBy("slot").rowsBetween(W.unboundedPreceding, W.currentRow)
        cuts = counts.withColumn("reached", F.sum("rows").over(running)).where(F.col("reached") >= wanted)
        cut = cuts.orderBy("slot").first()
        if cut is None:
            return df
        prefix, wanted = cut["slot"], cut["rows"] - cut["reached"] + wanted
        if cut["rows"] <= LAST_ROWS or digits >= 32:
            break
    below = drawn.where(F.substring(draw, 1, len(prefix)) < prefix)
    at_cut = drawn.where(F.col(draw).startswith(prefix))
    return below.unionByName(at_cut.orderBy(draw).limit(wanted)).drop(draw)

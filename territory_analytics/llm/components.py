"""Connected components of a link table, by alternating large and small stars.

Each round lets every node point its larger neighbours (large star), then its smaller neighbours and
itself (small star), to the smallest node it knows, until nothing changes; the number of rounds grows
with the logarithm of the graph.  Minima combine before the shuffle, so a node with very many links is
no burden, and every round is stored in the shared folder: a lost executor costs a task.
"""

from pyspark.sql import DataFrame, functions as F

from ..storage import discard, durable


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root``: the smallest node reachable, for every node of ``links`` (``a``, ``b``).

    Self links and NULL ends are ignored, repeated links count once; an empty table gives no rows.
    """
    stars = durable(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(stars)
    while state[0]:
        nxt = durable(_small_star(_large_star(stars)))
        discard(stars)
        stars, before, state = nxt, state, _state(nxt)
        if state == before:
            break
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _state(stars: DataFrame) -> tuple:
    mixed = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(stars.agg(F.count("*"), F.sum(mixed)).first())


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(stars: DataFrame) -> DataFrame:
    # Here every row has u > v already.
    low = stars.groupBy("u").agg(F.min("v").alias("m"))
    moved = stars.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()

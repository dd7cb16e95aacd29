"""Landed pages of a paged source: one JSON object (page, results, next) per line."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .. import schemas
from ..storage import discard, durable


def read_pages(
    spark: SparkSession, root: str, schema: T.StructType = schemas.CERTIFICATE_PAGE, partitions=("dep",)
) -> DataFrame:
    own = ", ".join(f"{p} string" for p in partitions)
    return spark.read.schema(schemas.with_columns(schema, own)).json(root)


def page_rows(
    pages: DataFrame, columns=None, max_pages: int | None = None, partitions=("dep",)
) -> DataFrame:
    """Result rows of the first ``max_pages`` pages (numbered from 0), ``columns`` only."""
    wanted = pages if max_pages is None else pages.where(F.col("page") < max_pages)
    rows = wanted.select(F.inline("results"), *partitions)
    return rows.select(*columns, *partitions) if columns else rows


def cursor(url: Column, name: str = "after") -> Column:
    """Cursor carried by the link to the next page; NULL on the last page."""
    return F.try_parse_url(url, F.lit("QUERY"), F.lit(name))


def page_set_status(pages: DataFrame, partitions=("dep",)) -> DataFrame:
    """Per source area: pages landed, and whether they run without a gap to a last page.

    A page ends the set when it has no cursor or no rows.
    """
    last = cursor(F.col("next")).isNull() | (F.coalesce(F.size("results"), F.lit(0)) == 0)
    counted = pages.groupBy(*partitions).agg(
        F.count("*").alias("pages"),
        F.max("page").alias("_last_page"),
        F.min(F.when(last, F.col("page"))).alias("_end"),
    )
    whole = (F.col("_end") == F.col("_last_page")) & (F.col("pages") == F.col("_last_page") + 1)
    return counted.select(*partitions, "pages", F.coalesce(whole, F.lit(False)).alias("complete"))


def page_chains(pages: DataFrame, own: Column, after: Column, partitions=("dep",)) -> DataFrame:
    """Every page with how far it is from the end of its chain: ``cursor``, ``after``, ``steps``, ``end``.

    Pages are found by the cursor that fetched them (``own``; NULL for the first one) and point to the next
    one by theirs (``after``; NULL on the last).  List ranking by pointer doubling: in every round a page
    jumps as far as the page it points to, so a chain of n pages takes log n rounds, each a join of the
    pages with themselves.  ``end`` is the first cursor ahead that no page was landed for (NULL: the chain
    ends well).  Pages that lead into a cycle have NULL ``steps``.  Pages landed twice count once; of several
    next cursors of one page the least is followed, and ``branches`` counts them.
    """
    keys = [*partitions, "cursor"]
    landed = pages.select(*partitions, F.coalesce(own, F.lit("")).alias("cursor"), after.alias("after"))
    nodes = durable(
        landed.groupBy(*keys).agg(F.min("after").alias("after"), F.count_distinct(F.coalesce("after", F.lit(""))).alias("branches"))
    )
    target = nodes.select(*partitions, F.col("cursor").alias("jump"), F.lit(True).alias("found"))
    state = durable(
        nodes.withColumn("jump", F.col("after")).join(target, [*partitions, "jump"], "left").select(
            *keys, "after", "branches",
            F.when(F.col("found"), F.col("jump")).alias("jump"),
            F.when(F.col("found").isNull(), F.col("after")).alias("end"),
            F.when(F.col("found"), 1).otherwise(0).cast("bigint").alias("steps"),
        )
    )
    longest = nodes.groupBy(*partitions).count().agg(F.max("count")).first()[0] or 0
    for _ in range(longest.bit_length()):
        if state.where("jump IS NOT NULL").isEmpty():
            break
        ahead = state.select(
            *partitions, F.col("cursor").alias("jump"), F.col("jump").alias("next_jump"),
            F.col("end").alias("next_end"), F.col("steps").alias("next_steps"),
        )
        further = state.join(ahead, [*partitions, "jump"], "left").select(
            *keys, "after", "branches",
            F.col("next_jump").alias("jump"),
            F.coalesce("end", "next_end").alias("end"),
            (F.col("steps") + F.coalesce("next_steps", F.lit(0))).alias("steps"),
        )
        following = durable(further)
        discard(state)
        state = following
    # What still jumps after as many doublings as the longest chain could need goes round in a cycle.
    steps = F.when(F.col("jump").isNull(), F.col("steps"))
    return state.select(*keys, "after", "branches", "end", steps.alias("steps"))


def chain_status(chains: DataFrame, partitions=("dep",)) -> DataFrame:
    """Per source area: pages landed, pages reached from the first one, and whether these are all of them.

    A set is complete if its first page was landed, no page branches and the chain from the first page
    comes to a last page after all others.
    """
    first = F.col("cursor") == ""
    reached = F.max(F.when(first, F.col("steps") + 1))
    counted = chains.groupBy(*partitions).agg(
        F.count("*").alias("pages"),
        F.coalesce(reached, F.lit(0)).alias("reached"),
        F.max(F.when(first, F.col("end"))).alias("missing"),
        F.sum(F.when(F.col("branches") > 1, 1).otherwise(0)).alias("branched"),
    )
    whole = (F.col("reached") == F.col("pages")) & F.col("missing").isNull() & (F.col("branched") == 0)
    return counted.select(*partitions, "pages", "reached", "missing", whole.alias("complete"))

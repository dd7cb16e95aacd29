"""Mixing sources to target weights by weighted fair queueing.

Every document gets a virtual finish time: the words of its source up to and with it, in a shuffled
order, divided by the target of its source; a source whose target exceeds it goes round again, up to
three times.  Sorted by finish time over all sources, documents are served until the budget of all
targets is used up, so at any point each source has its share.

No source is ever ordered in one task: running sums are taken inside slots of the shuffled order, whose
totals are summed up first, and the place where the budget ends is found by counting in ever narrower
slots of time.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import discard, durable
from .common import fresh, table

#: Weights of the sources in the order of their names, repeating.
WEIGHTS = (5, 2, 1)
MOST_ROUNDS = 3
SEED = "mix-1"
#: Leading hexadecimal digits of the shuffle key that number a slot; one more for 16 times the rows.
SLOT_DIGITS = 3
#: Even parts of a stretch of time in which served words are summed.
TIME_SLOTS = 4096
#: Services that one task may sort to find the last one within the budget.
LAST_ROWS = 50_000


def size_of(text: Column) -> Column:
    """Number of words: what stands between blanks and the characters 9 to 13; NULL has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, most_rounds: int = MOST_ROUNDS) -> DataFrame:
    """``source``, ``source_size``, ``target`` from one row (``source``, ``source_size``) per source.

    The total of all sizes is shared by weight; a target stops at ``most_rounds`` times its source, and
    the excess is shared among the rest by weight until none is above.  Sources by code point, NULL
    last.  In the order of size per weight those that stop come first; the first that does not stop
    sets the level for all after it.
    """
    names = W.orderBy(F.col("source").asc_nulls_last())
    place = ((F.row_number().over(names) - 1) % len(weights) + 1).cast("int")
    weighted = sources.select(
        "source",
        "source_size",
        (F.col("source_size") * most_rounds).alias("cap"),
        F.element_at(F.array(*map(F.lit, weights)), place).alias("weight"),
    )
    order = W.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    filling = weighted.select(
        "*",
        F.row_number().over(order).alias("rank"),
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))).alias("rest"),
        (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))).alias("rest_weight"),
    ).withColumn("stops", F.col("cap") * F.col("rest_weight") < F.col("rest") * F.col("weight"))
    level = F.min(F.when(~F.col("stops"), F.struct("rank", "rest", "rest_weight"))).over(whole)
    fair = level["rest"] / level["rest_weight"] * F.col("weight")
    stops = F.col("rank") < level["rank"]
    return filling.select(
        "source", "source_size", F.when(stops, F.col("cap").cast("double")).otherwise(fair).alias("target")
    )


@dataclass(frozen=True)
class Names:
    """Columns that the queue adds, under names that the documents do not have."""

    key: str
    size: str
    group: str
    slot: str
    source_size: str
    target: str
    total: str

    @classmethod
    def free(cls, documents: DataFrame) -> "Names":
        return cls(*(fresh(documents, f"mix_{n}") for n in cls.__dataclass_fields__))


def _keyed(documents: DataFrame, n: Names, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """With shuffle key, size, group of the source (never NULL) and slot of the key."""
    content = F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary"))
    named = F.concat_ws(":", F.lit(SEED), F.coalesce(F.col(id_col).cast("string"), F.lit("")), content)
    return (
        documents.withColumn(n.key, F.md5(named.cast("binary")))
        .withColumn(n.size, size_of(F.col(text_col)))
        .withColumn(n.group, F.coalesce(F.concat(F.lit("="), F.col(source_col)), F.lit("")))
        .withColumn(n.slot, F.substring(n.key, 1, SLOT_DIGITS))
    )


def _slots(keyed: DataFrame, n: Names, source_col: str, weights, most_rounds) -> DataFrame:
    """Per group and slot: words of the source in earlier slots, size and target of the source."""
    sums = durable(
        keyed.groupBy(n.group, n.slot).agg(
            F.min(source_col).alias("source"), F.sum(n.size).alias("words")
        )
    )
    sources = sums.groupBy(n.group, "source").agg(F.sum("words").alias("source_size"))
    named = targets(sources.drop(n.group), weights, most_rounds).select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias(n.group),
        F.col("source_size").alias(n.source_size),
        F.col("target").alias(n.target),
    )
    earlier = W.partitionBy(n.group).orderBy(n.slot).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select(
        n.group, n.slot, F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("start")
    )
    return durable(starts.join(named, n.group))


def _queued(keyed: DataFrame, slots: DataFrame, n: Names) -> DataFrame:
    """With the words of the source up to and with each row (``n.total``)."""
    inside = W.partitionBy(n.group, n.slot).orderBy(n.key).rowsBetween(W.unboundedPreceding, 0)
    joined = keyed.join(slots, [n.group, n.slot])
    return joined.withColumn(n.total, F.col("start") + F.sum(n.size).over(inside)).drop("start")


def _finish(n: Names, turn: Column) -> Column:
    """Virtual time at which a row's service ends in a round; 0 in a source without words."""
    return F.when(
        F.col(n.target) > 0, (turn * F.col(n.source_size) + F.col(n.total)) / F.col(n.target)
    ).otherwise(0.0)


def _last_service(queue: DataFrame, n: Names, most_rounds: int) -> tuple[float, str, int] | None:
    """(finish, key, turn) of the first service beyond the budget; None if all are within."""
    turns = F.explode(F.sequence(F.lit(0), F.lit(most_rounds - 1))).alias("turn")
    services = queue.where(F.col(n.size) > 0).select("*", turns)
    services = services.select(
        _finish(n, F.col("turn")).alias("finish"),
        F.col(n.key).alias("key"),
        "turn",
        F.col(n.size).alias("size"),
    )
    budget = queue.agg(F.sum(n.size)).first()[0] or 0
    low, high = services.agg(F.min("finish"), F.max("finish")).first()
    served = 0
    while low is not None:
        part = services.where(F.col("finish").between(low, high))
        place = F.floor((F.col("finish") - low) / max(high - low, 5e-324) * TIME_SLOTS)
        sums = part.groupBy(place.alias("slot")).agg(
            F.count("*").alias("rows"), F.sum("size").alias("size"),
            F.min("finish").alias("low"), F.max("finish").alias("high"),
        )
        # At most TIME_SLOTS + 1 rows.
        upto = W.orderBy("slot").rowsBetween(W.unboundedPreceding, 0)
        over = sums.withColumn("served", F.sum("size").over(upto) + served)
        crossing = over.where(F.col("served") > budget).orderBy("slot").first()
        if crossing is None:
            return None
        served = crossing["served"] - crossing["size"]
        narrowed = (crossing["low"], crossing["high"])
        stuck = narrowed == (low, high)
        low, high = narrowed
        if crossing["rows"] <= LAST_ROWS or low == high or stuck:
            break
    else:
        return None
    ordered = W.orderBy("finish", "key", "turn").rowsBetween(W.unboundedPreceding, 0)
    part = services.where(F.col("finish").between(low, high))
    beyond = part.withColumn("served", F.sum("size").over(ordered) + served).where(F.col("served") > budget)
    first = beyond.orderBy("finish", "key", "turn").first()
    return first["finish"], first["key"], first["turn"]


def _copies(n: Names, last: tuple[float, str, int] | None, most_rounds: int) -> Column:
    """How many services of a row are within the budget."""

    def within(turn: int) -> Column:
        if last is None:
            return F.lit(1)
        here = F.struct(_finish(n, F.lit(turn)).alias("f"), F.col(n.key).alias("k"), F.lit(turn).alias("t"))
        limit = F.struct(F.lit(last[0]).alias("f"), F.lit(last[1]).alias("k"), F.lit(last[2]).alias("t"))
        return (here < limit).cast("int")

    return sum((within(turn) for turn in range(1, most_rounds)), within(0))


def mix(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """The mixed documents: each row as often as it is served, all columns as they are.

    The order of service depends on ids and texts alone, so reruns agree; rows that agree in both are
    served one after the other.  NULL texts have size zero; a row without words costs nothing and is
    there once if its time comes.  NULL sources are one source, the last.
    """
    n = Names.free(documents)
    keyed = _keyed(documents, n, id_col, text_col, source_col)
    slots = _slots(keyed, n, source_col, weights, most_rounds)
    narrow = keyed.select(n.group, n.slot, n.key, n.size)
    queue = durable(_queued(narrow, slots, n).drop(n.group, n.slot))
    last = _last_service(queue, n, most_rounds)
    discard(queue)
    copies = F.least(_copies(n, last, most_rounds), F.when(F.col(n.size) == 0, 1).otherwise(most_rounds))
    served = _queued(keyed, slots, n).select(
        *documents.columns, F.explode(F.array_repeat(F.lit(0), copies)).alias(n.slot)
    )
    return served.drop(n.slot)


def mix_report(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    most_rounds: int = MOST_ROUNDS,
) -> DataFrame:
    """One row per document: id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    n = Names.free(documents)
    keyed = _keyed(documents.select(id_col, text_col, source_col), n, id_col, text_col, source_col)
    keyed = durable(keyed.drop(text_col))
    slots = _slots(keyed, n, source_col, weights, most_rounds)
    queue = durable(_queued(keyed, slots, n).drop(n.group, n.slot))
    last = _last_service(queue, n, most_rounds)
    return queue.select(
        id_col,
        F.col(n.size).alias("size"),
        F.col(n.source_size).alias("source_size"),
        F.col(n.target).alias("target"),
        (F.col(n.size) * _copies(n, last, most_rounds)).alias("taken"),
    )


def mixing(spark, sf_dir) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, md5(concat_ws(':', 'mix-1', coalesce(CAST(doc_id AS VARCHAR), ''), md5(coalesce(text, '')))) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, CAST(sum(size) AS BIGINT) * 3 AS cap FROM sized GROUP BY source),
weighted AS (
  SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight FROM sources),
ranked AS (
  SELECT *, row_number() OVER o AS rank,
         CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest,
         CAST(sum(weight) OVER () - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS rest_weight
  FROM weighted WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)),
level AS (SELECT * FROM ranked WHERE cap * rest_weight >= rest * weight ORDER BY rank LIMIT 1),
aims AS (
  SELECT r.source, r.source_size,
         CASE WHEN r.rank < l.rank THEN CAST(r.cap AS DOUBLE)
              ELSE CAST(l.rest AS DOUBLE) / CAST(l.rest_weight AS DOUBLE) * r.weight END AS target
  FROM ranked r, level l),
queue AS (
  SELECT s.*, a.source_size, a.target,
         CAST(sum(size) OVER (PARTITION BY s.source ORDER BY key ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
  FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source),
services AS (
  SELECT q.*, turn, CASE WHEN target > 0 THEN CAST(turn * source_size + total AS DOUBLE) / target ELSE 0 END AS finish
  FROM queue q, (SELECT unnest([0, 1, 2]) AS turn)),
served AS (
  SELECT *, sum(size) OVER (ORDER BY finish, key, turn ROWS UNBOUNDED PRECEDING) AS upto FROM services)
SELECT doc_id, size, source_size, target,
       CAST(sum(CASE WHEN upto <= (SELECT sum(size) FROM sized) THEN size ELSE 0 END) AS BIGINT) AS taken
FROM served GROUP BY doc_id, key, source, size, source_size, target, total
"""

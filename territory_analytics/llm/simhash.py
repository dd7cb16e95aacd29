"""SimHash near-duplicates by a segment-popcount embedding and a grid range-join.

A 64-bit fingerprint is embedded as the bit counts of its sixteen 4-bit segments.  The Manhattan
distance of two embeddings never exceeds the Hamming distance of the fingerprints, so fingerprints that
differ in few bits lie close on the integer grid of the embeddings.  For a distance of two both sides
meet half way: every fingerprint goes to its own grid cell and to those one step away (33 cells), and
two embeddings at a distance of at most two always share a cell.  Pairs of a cell are then verified on
the fingerprints themselves.  Only distinct fingerprints take part, so copies cost nothing here.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from ..storage import durable
from .common import fresh, small_batches, table, text_bytes
from .components import components

SEED = 42
SHINGLE_WORDS = 3
MAX_DISTANCE = 2
#: Shingles whose bits are unpacked at a time.
BLOCK = 1 << 16


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of every ``width`` words joined by spaces; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = [0, *ends[: len(words) - width].tolist()]
    digest = xxhash.xxh64_intdigest
    stops = (ends[width - 1 :] - 1).tolist()
    return np.fromiter(
        (digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(stops)
    )


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if it is set in over half of the hashes; signed, as Spark's long."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), BLOCK):
        block = np.ascontiguousarray(hashes[k : k + BLOCK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint_of(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """Fingerprint of a text as a long; NULL counts as empty, a text without words has zero."""

    @arrow_udf(T.LongType())
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array([fingerprint(shingle_hashes(t, width)) for t in text_bytes(texts)], pa.int64())

    return of(text)


def hex_of(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def _nibble_counts(half: Column) -> Column:
    """Bit counts of the eight 4-bit segments of a 32-bit number, each in its own segment."""
    fives, threes = F.lit(0x55555555), F.lit(0x33333333)
    pairs = half.bitwiseAND(fives) + F.shiftrightunsigned(half, 1).bitwiseAND(fives)
    return pairs.bitwiseAND(threes) + F.shiftrightunsigned(pairs, 2).bitwiseAND(threes)


def embedding(fingerprint: Column) -> Column:
    """The sixteen segment counts, each plus one, packed into the sixteen segments of a long."""
    low = _nibble_counts(fingerprint.bitwiseAND(F.lit(0xFFFFFFFF)))
    high = _nibble_counts(F.shiftrightunsigned(fingerprint, 32))
    return F.shiftleft(high, 32).bitwiseOR(low) + F.lit(0x1111111111111111)


def close_pairs(fingerprints: DataFrame, column: str = "fp", max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``a`` < ``b``: all pairs of different fingerprints that differ in at most ``max_distance`` bits.

    Takes distances up to two, which is what one step from either side covers.  NULL is ignored.
    """
    if not 0 <= max_distance <= 2:
        raise ValueError("the grid reaches fingerprints that differ in at most two bits")
    steps = F.array(F.lit(0), *[F.lit(sign << (4 * k)) for k in range(16) for sign in (1, -1)])
    points = fingerprints.select(F.col(column).alias("fp")).where("fp IS NOT NULL").distinct()
    spread = points.select("fp", F.explode(steps).alias("step"))
    cells = spread.select("fp", (embedding(F.col("fp")) + F.col("step")).alias("cell"))
    left = cells.select("cell", F.col("fp").alias("a"))
    right = cells.select("cell", F.col("fp").alias("b"))
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    near = (F.col("a") < F.col("b")) & (differing <= max_distance)
    # Spark sizes the 33 cells of a fingerprint like one row, and would broadcast them.
    return left.hint("merge").join(right, "cell").where(near).select("a", "b").distinct()


def near_classes(rows: DataFrame, id_col: str = "doc_id", max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``fp``, ``component_id`` for the fingerprints of stored ``rows`` (``id_col``, ``fp``)."""
    return _least_of_components(rows, F.min(id_col).alias("component_id"), max_distance)


def _least_of_components(rows: DataFrame, least: Column, max_distance: int) -> DataFrame:
    """``fp`` and the ``least`` aggregate of its component, for the fingerprints of stored ``rows``."""
    name = rows.select(least).columns[0]
    points = durable(rows.groupBy("fp").agg(least))
    roots = components(close_pairs(points, "fp", max_distance))
    placed = points.join(roots, points["fp"] == roots["node"], "left").select(
        "fp", name, F.coalesce("root", "fp").alias("root")
    )
    best = placed.groupBy("root").agg(F.min(name).alias(name))
    return placed.drop(name).join(best, "root").select("fp", name)


def near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per document: ``id_col``, fingerprint (hex), component_id.

    component_id is the smallest id reachable over links of at most ``max_distance`` bits; rows with a
    NULL id take part, and only a component without any id has NULL.  Texts without words have
    fingerprint zero and link like any other.  Repeated rows stay repeated.
    """
    small_batches(documents.sparkSession)
    printed = durable(
        documents.select(F.col(id_col), fingerprint_of(F.col(text_col), width).alias("fp"))
    )
    classes = durable(near_classes(printed, id_col, max_distance))
    return printed.join(classes, "fp").select(
        F.col(id_col), hex_of(F.col("fp")).alias("fingerprint"), "component_id"
    )


# --- One document of each group ------------------------------------------------------------------


def keep_one_per_group(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = SHINGLE_WORDS,
    max_distance: int = MAX_DISTANCE,
) -> DataFrame:
    """The documents without near copies, all columns as they are; the smallest id of a group stays.

    Groups are the components of ``near_duplicates``: fingerprints linked at ``max_distance`` bits.  Texts
    without words are copies of each other.  NULL counts as empty; a NULL id sorts last, and among equal
    ids the smallest hash of the text decides; of rows that agree in id and text one stays.
    """
    small_batches(documents.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    row = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.xxhash64(text).alias("text_hash"))
    printed = durable(documents.select(row.alias("row"), fingerprint_of(F.col(text_col), width).alias("fp")))
    best = _least_of_components(printed, F.min("row").alias("best"), max_distance)
    stay = durable(best.select("best.id", "best.text_hash").distinct())
    key_id, key_hash, mark = fresh(documents, "kept_id"), fresh(documents, "kept_hash"), fresh(documents, "kept_mark")
    stay = stay.select(F.col("id").alias(key_id), F.col("text_hash").alias(key_hash))
    hashed = documents.withColumn(mark, F.xxhash64(text))
    same = F.col(id_col).eqNullSafe(F.col(key_id)) & (F.col(mark) == F.col(key_hash))
    kept = hashed.join(stay, same, "left_semi")
    # Rows that agree in id and text are told apart by nothing; one of them stays.
    repeated = durable(printed.groupBy("row").count().where("count > 1").select("row.id", "row.text_hash"))
    if repeated.isEmpty():
        return kept.drop(mark)
    twice = repeated.select(F.col("id").alias(key_id), F.col("text_hash").alias(key_hash))
    once = kept.join(twice, same, "left_anti")
    again = kept.join(twice, same, "left_semi").dropDuplicates([id_col, mark])
    return once.unionByName(again).drop(mark)


def simhash_near_dedup(spark, sf_dir) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

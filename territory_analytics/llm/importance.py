"""Importance resampling towards a target distribution of hashed n-grams.

Features of a text are its runs of one to ``MOST_WORDS`` words, each named by the CRC-32 of its bytes
modulo a number of buckets.  A bucket's gain is the logarithm of how much likelier the target makes it
than the corpus; a document weighs the sum of the gains of its features, and Gumbel noise from its id
turns the weights into a sample without replacement: the highest scores are drawn.

Checksums come from a position table.  A CRC is affine in its bytes, so that of a span is the XOR of what
each byte contributes at its distance from the end of the span, and of a constant for the length.  All
features that end with one word share these distances: the contributions of their bytes are looked up once
and XORed with ``bitwise_xor.reduceat`` over the parts of the span.  Spans longer than the table are folded
block by block: the register after a block, moved over the next one, is again four table entries.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..storage import durable
from .common import fresh, small_batches, table, text_bytes

BUCKETS = 10_000
MOST_WORDS = 3
SEED = 42
LEAST_WORDS = 20
SHARE_PERCENT = 5

#: Distances the table covers, and table entries that are looked up at a time.
REACH = 64
LOOKED_UP = 2_000_000
_ONES = np.uint32(0xFFFFFFFF)

#: Separators and capitals: every byte that is no ASCII letter, digit or part of a longer character is a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


# --- Checksums ---------------------------------------------------------------------------------------


def position_table(reach: int = REACH) -> np.ndarray:
    """[distance from the end of a span, byte]: what the byte contributes to the span's CRC-32."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = np.where(step & 1, (step >> 1) ^ np.uint32(0xEDB88320), step >> 1)
    rows = [step]
    for _ in range(reach - 1):
        rows.append((rows[-1] >> 8) ^ step[rows[-1] & 255])
    return np.stack(rows)


TABLE = position_table()
_FLAT = TABLE.reshape(-1)


def _moved(register: np.ndarray, by: int) -> np.ndarray:
    """The register after ``by`` (4 to REACH) more bytes that are zero."""
    parts = [TABLE[by - 1 - k][(register >> (8 * k)) & 255] for k in range(4)]
    return parts[0] ^ parts[1] ^ parts[2] ^ parts[3]


def _length_constants(reach: int) -> np.ndarray:
    """[length]: the register after that many zero bytes, from all ones."""
    out = np.empty(reach + 1, np.uint32)
    out[0] = register = _ONES
    for n in range(1, reach + 1):
        register = (register >> np.uint32(8)) ^ TABLE[0][register & 255]
        out[n] = register
    return out


CONSTANTS = _length_constants(REACH)


def _contributions(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Table entries of all bytes of the spans, one span after another, and where each span begins."""
    sizes = stops - starts
    ends = np.cumsum(sizes)
    offsets = ends - sizes
    index = np.arange(ends[-1] if len(ends) else 0)
    # Entry = distance from the span's end * 256 + byte.
    distance = np.repeat(ends, sizes) - 1 - index
    return _FLAT[(distance << 8) | text[index + np.repeat(starts - offsets, sizes)]], offsets


def span_checksums(text: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """CRC-32 of spans (start, stop) of any length of an array of bytes, folded block by block."""
    sizes = stops - starts
    out = np.zeros(len(sizes), np.uint32)
    filled = np.flatnonzero(sizes)
    # The first block has what is left of the length, so that all others are whole.
    at = starts[filled] + (sizes[filled] - 1) % REACH + 1
    entries, offsets = _contributions(text, starts[filled], at)
    if len(filled):
        out[filled] = np.bitwise_xor.reduceat(entries, offsets) ^ CONSTANTS[at - starts[filled]]
    while True:
        more = at < stops[filled]
        filled, at = filled[more], at[more]
        if not len(filled):
            return np.where(sizes > 0, out ^ _ONES, 0)
        entries, offsets = _contributions(text, at, at + REACH)
        out[filled] = _moved(out[filled], REACH) ^ np.bitwise_xor.reduceat(entries, offsets)
        at = at + REACH


def ending_features(text: np.ndarray, starts: np.ndarray, stops: np.ndarray, rank: np.ndarray, first: int, last: int) -> list:
    """Features that end with the words ``first`` to ``last``: for 1, 2, ... words (which words, checksums).

    ``rank`` is the number of a word in its document; words are one space apart.
    """
    word = np.arange(first, last)
    back = np.minimum(rank[first:last], MOST_WORDS - 1)
    begins = starts[word - back]
    short = stops[first:last] - begins <= REACH
    out = []
    near, near_back, near_begins = word[short], back[short], begins[short]
    if len(near):
        entries, offsets = _contributions(text, near_begins, stops[near])
        # A span is cut where its words begin; its last part is the word itself.
        parts = near_back + 1
        at = np.cumsum(parts) - parts
        step = np.arange(parts.sum()) - np.repeat(at, parts)
        cut = np.repeat(offsets - near_begins, parts) + starts[np.repeat(near - near_back, parts) + step]
        values = np.bitwise_xor.reduceat(entries, cut)
        total = np.zeros(len(near), np.uint32)
        for n in range(MOST_WORDS):
            has = near_back >= n
            total[has] ^= values[(at + near_back)[has] - n]
            sizes = stops[near[has]] - starts[near[has] - n]
            out.append((near[has], total[has] ^ CONSTANTS[sizes] ^ _ONES))
    far, far_back = word[~short], back[~short]
    for n in range(MOST_WORDS if len(far) else 0):
        ends = far[far_back >= n]
        out.append((ends, span_checksums(text, starts[ends - n], stops[ends])))
    return out


def bucketed(texts: Iterator[bytes], buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(document, bucket) of the features of a batch of texts, in parts of bounded size; the order is free."""
    clean = [b" ".join(text.translate(_FOLD).split()) for text in texts]
    counts = np.array([text.count(b" ") + 1 if text else 0 for text in clean], np.int64)
    text = np.frombuffer(b" ".join(t for t in clean if t) + b" ", np.uint8)
    stops = np.flatnonzero(text == 32) if counts.any() else np.zeros(0, np.int64)
    starts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else stops
    document = np.repeat(np.arange(len(counts)), counts)
    rank = np.arange(len(stops)) - np.repeat(np.cumsum(counts) - counts, counts)
    # As many words at a time as have about LOOKED_UP bytes to look up.
    weight = np.cumsum(stops - starts[np.maximum(0, np.arange(len(stops)) - np.minimum(rank, MOST_WORDS - 1))]) if len(stops) else stops
    first = 0
    while first < len(stops):
        before = weight[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(weight, before + LOOKED_UP, "right")))
        for ends, checksums in ending_features(text, starts, stops, rank, first, last):
            yield document[ends], checksums % np.uint32(buckets)
        first = last


def word_count(texts: Iterator[bytes]) -> np.ndarray:
    return np.array([len(text.translate(_FOLD).split()) for text in texts], np.int64)


# --- On tables -----------------------------------------------------------------------------------------


def bucket_counts(documents: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """``bucket``, ``n``: features of all texts, counted in the tasks before the only, tiny shuffle."""
    small_batches(documents.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, found in bucketed(text_bytes(batch.column(0)), buckets):
                total += np.bincount(found, minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(filled.astype(np.int32)), pa.array(total[filled])], ["bucket", "n"]
        )

    parts = documents.select(text_col).mapInArrow(counted, "bucket int, n bigint")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(documents: DataFrame, target: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket in thousandths, an array of the fixed length ``buckets``.

    Counts are those of all texts, smoothed by one per bucket.  Only one number per bucket and table
    comes to the driver.
    """

    def counts(df: DataFrame) -> np.ndarray:
        rows = bucket_counts(df, text_col, buckets).toPandas()
        out = np.zeros(buckets)
        out[rows["bucket"].to_numpy(np.int64)] = rows["n"].to_numpy(np.float64)
        return out

    source, wanted = counts(documents), counts(target)
    ratio = ((wanted + 1) * (source.sum() + buckets)) / ((source + 1) * (wanted.sum() + buckets))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def with_weights(
    documents: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``documents``: its id, ``n_words``, ``n_features`` and ``weight``."""
    small_batches(documents.sparkSession)
    buckets = len(gain)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            features, weight = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for document, found in bucketed(text_bytes(batch.column(1)), buckets):
                features += np.bincount(document, minlength=n)
                # Sums of whole numbers far below 2**53 are exact.
                weight += np.bincount(document, gain[found], minlength=n).astype(np.int64)
            words = word_count(text_bytes(batch.column(1)))
            columns = [batch.column(0), *map(pa.array, (words, features, weight))]
            yield pa.RecordBatch.from_arrays(columns, [id_col, "n_words", "n_features", "weight"])

    id_type = documents.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_words bigint, n_features bigint, weight bigint"
    return documents.select(id_col, text_col).mapInArrow(weighed, schema)


def noise(row_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths from the hash of an id; a NULL id counts as an empty name."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


def ranked(scored: DataFrame, eligible: Column, id_col: str, most: int) -> DataFrame:
    """Add ``rank``: 1, 2, ... for the ``most`` eligible rows with the highest ``score``, NULL for others.

    Ties go to the smaller id, NULL ids last.  Rows are range-partitioned in this order and stored with
    their part; a rank is the rows of the parts before plus the place in the part, so no task sees more
    than one part.
    """
    part, fits = fresh(scored, "part"), fresh(scored, "fits")
    order = [F.col(fits).desc(), F.col("score").desc(), F.col(id_col).asc_nulls_last()]
    rows = scored.withColumn(fits, F.coalesce(eligible, F.lit(False)))
    stored = durable(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id())
    )
    sizes = stored.groupBy(part).agg(F.count("*").alias("n"))
    # One row per part.
    before = F.sum("n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1))
    offsets = sizes.select(part, F.coalesce(before, F.lit(0)).alias("before"))
    place = F.row_number().over(W.partitionBy(part).orderBy(*order))
    placed = stored.withColumn("place", place).join(offsets, part)
    rank = F.col("before") + F.col("place")
    return placed.withColumn("rank", F.when(F.col(fits) & (rank <= most), rank)).drop("before", "place", part, fits)


def resample(
    documents: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    share_percent: int = SHARE_PERCENT,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row per row of ``documents``: id, n_words, n_features, weight, score and the rank it is drawn at.

    Of the documents of at least ``least_words`` words, ``share_percent`` of a hundred (rounded down) with
    the highest scores are drawn; others have a NULL rank.  A NULL or empty text has no features and the
    weight zero; a text of any length counts whole.  Ties go to the smaller id, repeated rows are drawn one
    by one, NULL ids come last among equals; an empty table gives no rows, an empty target equal counts of
    zero; other columns are ignored.
    """
    gain = gains(documents, target, text_col, buckets)
    weighed = with_weights(documents, gain, id_col, text_col)
    scored = durable(weighed.withColumn("score", F.col("weight") + noise(F.col(id_col), seed)))
    eligible = F.col("n_words") >= least_words
    most = scored.where(eligible).count() * share_percent // 100
    return ranked(scored, eligible, id_col, most)


def importance_resampling(spark, sf_dir) -> DataFrame:
    """Documents drawn towards the distribution of the benchmark's texts."""
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


# The checksum of a feature, byte by byte, with the usual table of 256 entries, built here by its rule.
ORACLE = r"""
WITH steps AS (
  SELECT list(t ORDER BY b) AS t FROM (
    SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
        CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t
    FROM (SELECT unnest(range(256))::BIGINT AS b))
), texts AS (
  SELECT true AS source, row_number() OVER () AS r, doc_id, text FROM documents
  UNION ALL SELECT false, row_number() OVER (), NULL, text FROM benchmark
), worded AS (
  SELECT source, r, doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM texts
), features AS (
  SELECT source, r, unnest(list_concat(words,
      list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]),
      list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]))) AS f
  FROM worded
), named AS (
  SELECT f, xor(list_reduce(
      list_concat([4294967295], list_transform(range(0, octet_length(encode(f))), lambda i:
        16 * (instr('0123456789ABCDEF', substr(h, 2 * i + 1, 1)) - 1) + instr('0123456789ABCDEF', substr(h, 2 * i + 2, 1)) - 1)),
      lambda c, b: xor(c >> 8, t[1 + (xor(c, b) & 255)])), 4294967295) % 10000 AS bucket
  FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)), steps
), found AS (SELECT source, r, bucket FROM features JOIN named USING (f)
), counts AS (
  SELECT bucket, count(*) FILTER (source) AS s, count(*) FILTER (NOT source) AS t FROM found GROUP BY bucket
), totals AS (SELECT coalesce(sum(s), 0)::DOUBLE AS s_all, coalesce(sum(t), 0)::DOUBLE AS t_all FROM counts
), gained AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (s_all + 10000)) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
  FROM counts, totals
), weighed AS (
  SELECT r, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM found JOIN gained USING (bucket) WHERE source GROUP BY r
), scored AS (
  SELECT doc_id, len(words) >= 20 AS fits, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM (SELECT *, list_reduce(list_concat([0], list_transform(range(1, 9), lambda i:
          instr('0123456789abcdef', substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), i, 1)) - 1)),
          lambda a, d: 16 * a + d) AS h FROM worded WHERE source) LEFT JOIN weighed USING (r)
), ordered AS (
  SELECT *, row_number() OVER (PARTITION BY fits ORDER BY score DESC, doc_id) AS place, count(*) FILTER (fits) OVER () AS n
  FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN fits AND place <= 5 * n // 100 THEN place END AS rank
FROM ordered
"""

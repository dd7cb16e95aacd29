"""Language-model scores by stupid backoff, computed as joins of n-grams with count tables.

Every word of the corpus is scored by how often it follows its two predecessors elsewhere: the relative
frequency of the trigram; if it occurs nowhere else, that of the bigram times a factor; else that of the
word times the factor again.  Counts are over all documents, less the occurrence that is scored, so a
text is not its own evidence.

n-grams are named by 64-bit hashes, and rows are packed: the corpus is stored as blocks of words, a block sends
each of its different n-grams once, sorted, to the part of the count table that the leading bits of the
hash name, and gets the totals back in the same order.  So an n-gram that is in every text costs one
entry per block, a part of the table holds a bounded number of entries, and the exchange has some five
bytes per entry instead of a row.  The longest n-grams are asked for last, and only those whose two shorter
ones occur more than once: the others occur once, as any n-gram is at most as frequent as its parts.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..storage import durable
from .common import small_batches, table, text_bytes

ORDER = 3
FACTOR = 0.4
#: Words of a block, and entries of a part of the count table.
BLOCK_WORDS = 1 << 20
PART_ENTRIES = 1 << 21
#: Stretches of documents in a block, which bounds it where texts are short or empty.
MOST_STRETCHES = 100_000
#: Bits of an n-gram's name; two different ones share a name with a probability of 2**-HASH_BITS.
HASH_BITS = 64
SEED = 42

_MIX = np.uint64(0x9E3779B97F4A7C15)


def _packed(values: np.ndarray) -> bytes:
    """Numbers as compressed byte planes."""
    wide = np.ascontiguousarray(values)
    planes = wide.view(np.uint8).reshape(-1, wide.itemsize).T
    return zstandard.compress(planes.tobytes(), 1)


def _unpacked(data: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(planes.T).view(kind).reshape(-1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    x = x + _MIX
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(words: np.ndarray, place: np.ndarray, order: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For n = 1 to ``order``: hashes of the n-grams that end at a word, and at which words one does.

    ``place`` is how many words of the same document stand before a word in the array.
    """
    current, found = _mixed(words), []
    for n in range(1, order + 1):
        if n > 1:
            longer = np.zeros_like(current)
            longer[1:] = _mixed(current[:-1] * _MIX + words[1:])
            current = longer
        found.append((current >> np.uint64(64 - HASH_BITS), place >= n - 1))
    return found


# --- Blocks of words -----------------------------------------------------------------------------

_BLOCK = pa.schema(
    [
        ("block", pa.int64()), ("doc_keys", pa.list_(pa.int64())), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("contexts", pa.list_(pa.int64())),
        ("words", pa.binary()), ("places", pa.binary()), ("n_words", pa.int64()),
    ]
)
_BLOCK_SQL = (
    "block long, doc_keys array<long>, doc_ids array<long>, lengths array<long>, contexts array<long>, "
    "words binary, places binary, n_words long"
)


def word_blocks(documents: DataFrame, id_col: str, text_col: str, order: int, block_words: int) -> DataFrame:
    """The corpus as stored blocks of at most ``block_words`` words.

    A block has stretches of documents; a document that goes on from an earlier block starts with the
    words that its first n-grams need (``contexts``), which are not counted again.  Words are what
    stands between blanks and the characters 9 to 13, with A-Z in lower case, as XXH64 hashes.
    """

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        known: dict[bytes, int] = {}
        pieces, stretches = [], []
        held = number = ordinal = 0

        def row() -> pa.RecordBatch:
            numbers = np.concatenate(pieces) if pieces else np.zeros(0, np.int32)
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in known), np.uint64, len(known))
            keys, ids, lengths, contexts = (list(c) for c in zip(*stretches, strict=True))
            columns = [
                [(part << 32) + number], [keys], [ids], [lengths], [contexts],
                [_packed(hashes)], [_packed(numbers)], [len(numbers) - sum(contexts)],
            ]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _BLOCK, strict=True)], schema=_BLOCK
            )

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for doc_id, text in zip(doc_ids, text_bytes(batch.column(1)), strict=True):
                words, at, key = text.lower().split(), 0, (part << 40) + ordinal
                ordinal += 1
                while True:
                    context = min(at, order - 1)
                    some = words[at - context : at + block_words - held]
                    numbers = np.fromiter((known.setdefault(w, len(known)) for w in some), np.int32, len(some))
                    pieces.append(numbers)
                    stretches.append((key, doc_id, len(some), context))
                    held, at = held + len(some) - context, at + len(some) - context
                    if held >= block_words or len(stretches) >= MOST_STRETCHES:
                        yield row()
                        known, pieces, stretches = {}, [], []
                        held, number = 0, number + 1
                    if at >= len(words):
                        break
        if stretches:
            yield row()

    rows = documents.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return durable(rows.mapInArrow(blocks, _BLOCK_SQL))


def _layout(lengths: list[int], contexts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For each word of a block: its place in its stretch, and whether the block owns it."""
    lengths, contexts = np.array(lengths, np.int64), np.array(contexts, np.int64)
    starts = np.cumsum(lengths) - lengths
    place = np.arange(lengths.sum()) - np.repeat(starts, lengths)
    return place, place >= np.repeat(contexts, lengths)


def _block_ngrams(words: bytes, places: bytes, lengths, contexts, order: int):
    hashes = _unpacked(words, np.uint64)[_unpacked(places, np.int32)]
    place, owned = _layout(lengths, contexts)
    return ngrams(hashes, place, order), place, owned


def _entries(grams, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different n-grams of a block in ascending order, and how often its own words end one."""
    keys = np.concatenate([g[there] for g, there in grams])
    keys.sort()
    first = _firsts(keys)
    counts = np.diff(np.append(first, len(keys))).astype(np.uint32)
    keys = keys[first]
    # The few words that only give context are asked for, not counted.
    others = np.concatenate([g[there & ~owned] for g, there in grams])
    np.subtract.at(counts, np.searchsorted(keys, others), np.uint32(1))
    return keys, counts


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Places at which a new value begins."""
    return np.flatnonzero(np.concatenate([np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]]))


def _answered(grams, totals: np.ndarray) -> list[np.ndarray]:
    """Counts of the n-grams at their words; ``totals`` go with the different ones in ascending order."""
    keys = np.concatenate([g[there] for g, there in grams])
    order = np.argsort(keys)
    keys = keys[order]
    sizes = np.diff(np.append(_firsts(keys), len(keys)))
    found = np.empty(len(keys), np.int64)
    found[order] = np.repeat(totals, sizes)
    counts, at = [], 0
    for gram, there in grams:
        count = np.zeros(len(gram), np.int64)
        n = int(there.sum())
        count[there] = found[at : at + n]
        counts.append(count)
        at += n
    return counts


# --- Count tables --------------------------------------------------------------------------------


def _shorter(grams):
    """All but the longest n-grams; those of order one have no longer ones."""
    return grams[: max(1, len(grams) - 1)]


def _longest(grams, counts: list[np.ndarray]):
    """The longest n-grams that may occur more than once, by the ``counts`` of the shorter ones."""
    hashes, there = grams[-1]
    often = counts[-1] > 1
    there = there & often
    there[1:] &= often[:-1]
    return [(hashes, there)]


def _totals_of(parts: list[dict] | None, longest: bool) -> np.ndarray:
    """What the table answered about the shorter or the longest n-grams of a block."""
    own = sorted((p for p in parts or [] if p["longest"] == longest), key=lambda p: p["part"])
    return np.concatenate([np.zeros(0, np.int64), *(_unpacked(p["totals"], np.int64) for p in own)])


def requests(blocks: DataFrame, order: int, bits: int, longest: bool = False) -> DataFrame:
    """``part``, ``block``, ``entries`` and ``counts``: the n-grams of each block by leading bits.

    The shorter n-grams are asked for first; with their answers in ``parts``, the longest can be.
    """
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("entries", pa.binary()), ("counts", pa.binary())])

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, lengths, contexts, words, places, *parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                grams, _, owned = _block_ngrams(words, places, lengths, contexts, order)
                wanted = _shorter(grams)
                if longest:
                    wanted = _longest(grams, _answered(wanted, _totals_of(parts[0], False)))
                keys, counts = _entries(wanted, owned)
                cuts = np.searchsorted(keys, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(HASH_BITS - bits)) if bits else []
                cuts = [0, *cuts, len(keys)]
                rows = [
                    (part, block, _packed(np.diff(keys[a:b], prepend=np.uint64(0))), _packed(counts[a:b]))
                    for part, (a, b) in enumerate(zip(cuts, cuts[1:]))
                    if b > a
                ]
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    narrow = blocks.select("block", "lengths", "contexts", "words", "places", *(["parts"] if longest else []))
    return narrow.mapInArrow(asked, "part int, block long, entries binary, counts binary")


_ANSWER = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("totals", pa.binary())])


def _totals(group: pa.Table) -> pa.Table:
    """A part of the count table: sums the counts of equal n-grams and answers every block."""
    keys = [np.cumsum(_unpacked(e.as_py(), np.uint64), dtype=np.uint64) for e in group.column("entries")]
    counts = [_unpacked(c.as_py(), np.uint32) for c in group.column("counts")]
    sizes = [len(k) for k in keys]
    keys, counts = np.concatenate(keys), np.concatenate(counts).astype(np.int64)
    order = np.argsort(keys, kind="stable")  # merges sorted runs
    ordered = keys[order]
    first = _firsts(ordered)
    sums = np.add.reduceat(counts[order], first)
    totals = np.empty(len(keys), np.int64)
    totals[order] = np.repeat(sums, np.diff(np.append(first, len(keys))))
    answers = [_packed(t) for t in np.split(totals, np.cumsum(sizes)[:-1])]
    return pa.table([group.column("part"), group.column("block"), pa.array(answers, pa.binary())], schema=_ANSWER)


def count_table(asked: DataFrame) -> DataFrame:
    """``part``, ``block``, ``totals``: what each block asked for, counted over all blocks."""
    return asked.groupBy("part").applyInArrow(_totals, "part int, block long, totals binary")


# --- Scores --------------------------------------------------------------------------------------


def _logs(grams, counts: list[np.ndarray], place: np.ndarray, n_words: int, factor: float) -> np.ndarray:
    """Logarithm of the score of each word; ``counts`` go with ``grams``."""
    others = max(1, n_words - 1)
    tried = np.minimum(place, len(grams) - 1)  # how often the score can be backed off
    out = np.log(factor) * tried + np.log(np.maximum(1, counts[0] - 1) / others)
    done = np.zeros(len(place), bool)
    for n in range(len(grams) - 1, 0, -1):
        seen = ~done & grams[n][1] & (counts[n] > 1)
        at = np.flatnonzero(seen)
        out[at] = np.log(factor) * (tried[at] - n) + np.log((counts[n][at] - 1) / (counts[n - 1][at - 1] - 1))
        done |= seen
    return out


def _with_answers(blocks: DataFrame, answers: DataFrame) -> DataFrame:
    # As many answers for a block as the table has parts, together the size of the block.
    gathered = answers.groupBy("block").agg(F.collect_list(F.struct("longest", "part", "totals")).alias("parts"))
    return blocks.join(gathered, "block", "left")


def _scores(blocks: DataFrame, answers: DataFrame, order: int, n_words: int, factor: float) -> DataFrame:
    """``doc_key``, ``doc_id``, ``n_words``, ``log_score`` per stretch of a document."""
    schema = pa.schema([("doc_key", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("log_score", pa.float64())])

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                doc_keys, doc_ids, lengths, contexts, words, places, parts = row
                grams, place, owned = _block_ngrams(words, places, lengths, contexts, order)
                counts = _answered(_shorter(grams), _totals_of(parts, False))
                if order > 1:
                    # Those that were not asked for occur once, and count no more than zero here.
                    counts += _answered(_longest(grams, counts), _totals_of(parts, True))
                logs = np.where(owned, _logs(grams, counts, place, n_words, factor), 0.0)
                ends = np.cumsum(np.array(lengths, np.int64))
                sums = [float(logs[e - n : e].sum()) for e, n in zip(ends.tolist(), lengths, strict=True)]
                own = [n - c for n, c in zip(lengths, contexts, strict=True)]
                columns = [doc_keys, doc_ids, own, sums]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    rows = _with_answers(blocks, answers).select("doc_keys", "doc_ids", "lengths", "contexts", "words", "places", "parts")
    return rows.mapInArrow(scored, "doc_key long, doc_id long, n_words long, log_score double")


def backoff_scores(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
    factor: float = FACTOR,
    block_words: int = BLOCK_WORDS,
    part_entries: int = PART_ENTRIES,
) -> DataFrame:
    """One row per document: id, n_words, log_score, mean_log.

    log_score is the sum of the natural logarithms of the words' scores.  For word w after u and v, with
    c the count of occurrences other than this one: c(uvw) / c(uv) if c(uvw) > 0, else factor * c(vw) /
    c(v) if c(vw) > 0, else factor**2 * max(1, c(w)) / (number of other words); at the start of a
    document only what stands before counts.  A document without words, NULL included, has 0, 0.0 and
    NULL.  Repeated rows are documents of their own, and evidence for each other.
    """
    small_batches(documents.sparkSession)
    blocks = word_blocks(documents, id_col, text_col, order, block_words)
    n_words = blocks.agg(F.sum("n_words")).first()[0] or 0

    def bits(orders: int) -> int:
        return max(0, (n_words * orders // part_entries).bit_length())

    asked = requests(blocks, order, bits(max(1, order - 1)))
    answers = durable(count_table(asked)).withColumn("longest", F.lit(False))
    if order > 1:
        asked = requests(_with_answers(blocks, answers), order, bits(1), longest=True)
        answers = answers.unionByName(durable(count_table(asked)).withColumn("longest", F.lit(True)))
    stretches = _scores(blocks, answers, order, n_words, factor)
    whole = stretches.groupBy("doc_key").agg(
        F.max("doc_id").alias(id_col), F.sum("n_words").alias("n_words"), F.sum("log_score").alias("log_score")
    )
    return whole.select(
        id_col,
        "n_words",
        F.round("log_score", 4).alias("log_score"),
        F.when(F.col("n_words") > 0, F.round(F.col("log_score") / F.col("n_words"), 4)).alias("mean_log"),
    )


def lm_backoff(spark, sf_dir) -> DataFrame:
    return backoff_scores(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS d, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
words AS (SELECT d, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM split),
placed AS (
  SELECT d, i, w, lag(w, 1) OVER doc AS v, lag(w, 2) OVER doc AS u FROM words WINDOW doc AS (PARTITION BY d ORDER BY i)),
c1 AS (SELECT w, count(*) AS n FROM placed GROUP BY w),
c2 AS (SELECT v, w, count(*) AS n FROM placed WHERE v IS NOT NULL GROUP BY v, w),
c3 AS (SELECT u, v, w, count(*) AS n FROM placed WHERE u IS NOT NULL GROUP BY u, v, w),
counted AS (
  SELECT p.*, c1.n AS n_w, cv.n AS n_v, c2.n AS n_vw, cuv.n AS n_uv, c3.n AS n_uvw
  FROM placed p JOIN c1 ON p.w = c1.w LEFT JOIN c1 cv ON p.v = cv.w
  LEFT JOIN c2 ON p.v = c2.v AND p.w = c2.w LEFT JOIN c2 cuv ON p.u = cuv.v AND p.v = cuv.w
  LEFT JOIN c3 ON p.u = c3.u AND p.v = c3.v AND p.w = c3.w),
scored AS (
  SELECT d, ln(CASE
      WHEN n_uvw > 1 THEN CAST(n_uvw - 1 AS DOUBLE) / (n_uv - 1)
      WHEN n_vw > 1 THEN (CASE WHEN u IS NULL THEN 1.0 ELSE 0.4 END)::DOUBLE * (n_vw - 1) / (n_v - 1)
      ELSE (CASE WHEN v IS NULL THEN 1.0 WHEN u IS NULL THEN 0.4 ELSE 0.16 END)::DOUBLE
           * greatest(1, n_w - 1) / greatest(1, (SELECT count(*) FROM words) - 1) END) AS s
  FROM counted),
summed AS (SELECT d, sum(s) AS s FROM scored GROUP BY d)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(coalesce(s, 0.0), 4) AS log_score,
       CASE WHEN len(ws) > 0 THEN round(s / len(ws), 4) END AS mean_log
FROM split LEFT JOIN summed ON split.d = summed.d
"""

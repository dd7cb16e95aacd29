"""Periodic runs of words, found by Baier grouping.

A run is a stretch of words in which words ``period`` apart are equal, at least two periods long, that no
neighbour extends.  Every run has a root that is a Lyndon word, the longest one that begins at its place,
under the order of the words or under the reverse of it.  The first phase of Baier's suffix sorter groups
the suffixes by just that word: groups are taken from the highest to the lowest, and a suffix whose group
is taken lengthens the context of the nearest lower suffix to its left.  The context length of a suffix
when its group is taken is its entry of the Lyndon array.  Both arrays give the candidate roots, and the
longest common extensions of a root and its shifted copy to the right and to the left give the run.

A word that occurs once in a stretch is in no run of it, so such words cut a text into pieces, which are
sorted together; nothing is lost, and a text without repetition costs little more than counting its words.
Every document is treated by itself, so the operator needs no shuffle.
"""

import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, small_batches, table, text_bytes

MIN_WORDS = 12
#: Times that pieces are cut at words which occur once in them; more cuts only save work.
CUTS = 3
#: Output rows hold whole texts, so they leave a task in small batches.
ROWS_OUT = 200

RUN = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


# --- Words of one document -------------------------------------------------------------------------


def lyndon_lengths(order: np.ndarray) -> list[int]:
    """Length of the longest Lyndon word that begins at each place, by the sorter's first phase.

    ``order`` has non-negative numbers; the end of the text counts as lower than all of them.
    """
    n = len(order)
    if not n:
        return []
    sorted_places = np.argsort(order, kind="stable")
    values = order[sorted_places]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    # Places are numbered from 1; 0 and n + 1 are the ends of the list of those not taken yet.
    members = [part.tolist() for part in np.split(sorted_places + 1, first[1:])]
    group = np.empty(n + 2, np.int64)
    group[sorted_places + 1] = np.repeat(np.arange(len(first)), np.diff(np.append(first, n)))
    group = group.tolist()
    size = [len(part) for part in members]
    context = [1] * len(members)
    lower = list(range(-1, len(members) - 1))
    higher = list(range(1, len(members) + 1))
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    lengths = [0] * (n + 2)

    def lengthen(places: list[int], old: int, by: int) -> None:
        """Move ``places`` of one group to a new one right above it, whose context is longer."""
        if len(places) == size[old]:
            context[old] += by
            return
        new, above = len(members), higher[old]
        members.append(places)
        size.append(len(places))
        size[old] -= len(places)
        context.append(context[old] + by)
        lower.append(old)
        higher.append(above)
        higher[old] = new
        if above < len(lower) and lower[above] == old:
            lower[above] = new
        for place in places:
            group[place] = new

    current = len(members) - 1
    higher[current] = n * 2 + 2  # above all groups there will be
    while current >= 0:
        length = context[current]
        counts: dict[int, int] = {}
        for place in members[current]:
            if group[place] == current:
                lengths[place] = length
                before, after = left[place], right[place]
                right[before], left[after] = after, before
                counts[before] = counts.get(before, 0) + 1
        counts.pop(0, None)
        if len(counts) == 1:
            ((place, times),) = counts.items()
            lengthen([place], group[place], times * length)
        elif counts:
            moved: dict[tuple[int, int], list[int]] = {}
            for place, times in counts.items():
                moved.setdefault((times, group[place]), []).append(place)
            # The more often a context is appended, the higher the new group.
            for times, old in sorted(moved, reverse=True):
                lengthen(moved[times, old], old, times * length)
        current = lower[current]
    return lengths[1 : n + 1]


def _common(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common beginning, compared in growing steps."""
    n, done, step = min(len(a), len(b)), 0, 32
    while done < n:
        differs = a[done : min(n, done + step)] != b[done : min(n, done + step)]
        at = int(differs.argmax())
        if differs[at]:
            return done + at
        done, step = done + len(differs), step * 2
    return n


def _extended(symbols: np.ndarray, lengths: np.ndarray, min_words: int) -> set[tuple[int, int, int]]:
    """Runs (start, length, period) whose roots are the longest Lyndon words ``lengths``."""
    n = len(symbols)
    places = np.flatnonzero(np.arange(n) + lengths < n)
    shifted = places + lengths[places]
    follows = symbols[places] == symbols[shifted]
    precedes = (places > 0) & (symbols[places - 1] == symbols[shifted - 1])
    backwards = symbols[::-1]
    found, reach = set(), {}
    for i, j in zip(places[follows | precedes].tolist(), shifted[follows | precedes].tolist(), strict=True):
        period = j - i
        # Roots of one period inside one stretch belong together.
        if j <= reach.get(period, 0):
            continue
        stop = j + _common(symbols[i:], symbols[j:])
        start = i - _common(backwards[n - i :], backwards[n - j :])
        reach[period] = stop
        if stop - start >= max(min_words, 2 * period):
            found.add((start, stop - start, period))
    return found


def pieces(symbols: np.ndarray, min_words: int, cuts: int = CUTS) -> list[tuple[int, int]]:
    """Stretches (start, stop) of at least ``min_words`` that hold every run."""
    stretches = [(0, len(symbols))]
    for _ in range(cuts):
        smaller = []
        for start, stop in stretches:
            _, which, count = np.unique(symbols[start:stop], return_inverse=True, return_counts=True)
            again = np.concatenate([[False], count[which] > 1, [False]])
            edges = np.flatnonzero(again[1:] != again[:-1]).reshape(-1, 2) + start
            smaller += [(a, b) for a, b in edges.tolist() if b - a >= min_words]
        if smaller == stretches:
            break
        stretches = smaller
    return stretches


def runs_of(words: list, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of at least ``min_words`` words, by start and period."""
    if len(words) < min_words:
        return []
    times = Counter(words)
    if len(times) == len(words):
        return []
    numbers = {word: k for k, word in enumerate(times, 1)}
    symbols = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    kept = pieces(symbols, min_words)
    if not kept:
        return []
    # Pieces follow each other behind a lowest symbol; for comparisons these symbols are all unlike.
    parts, order = [], []
    for k, (start, stop) in enumerate(kept, 1):
        parts += [[-k], symbols[start:stop]]
        order += [[0], symbols[start:stop]]
    text, order = np.concatenate(parts), np.concatenate(order)
    origin = np.concatenate([np.arange(start - 1, stop) for start, stop in kept])
    reverse = np.where(order > 0, order.max() + 1 - order, 0)
    found = set()
    for ranks in (order, reverse):
        found |= _extended(text, np.array(lyndon_lengths(ranks), np.int64), min_words)
    return sorted(((int(origin[s]), n, p) for s, n, p in found), key=lambda run: (run[0], run[2]))


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words that no run contains after its first period."""
    if not runs:
        return words
    kept = np.ones(len(words), bool)
    for start, length, period in runs:
        kept[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(kept)]


# --- On tables ---------------------------------------------------------------------------------------


def find_runs(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
    edit: Callable[[object, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """One row per row of ``documents``: its id, ``n_words``, ``runs`` and the ``collapsed`` text.

    Words are what white space (ASCII) separates.  ``runs`` has start, length and period of every run of at
    least ``min_words`` words and two periods, by start and period; ``collapsed`` joins by one space the
    words that no run contains after its first period.  ``edit`` may change a row's words beforehand.
    A NULL or empty text has no words, no runs and an empty collapsed text; a text of any length is treated
    whole, in memory that grows with its words; repeated rows and NULL ids have rows of their own; equal
    runs from several roots count once; an empty table gives no rows; other columns are ignored.
    """
    small_batches(documents.sparkSession)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS_OUT):
                part = batch.slice(first, ROWS_OUT)
                counts, runs, texts = [], [], []
                for row_id, text in zip(part.column(0).to_pylist(), text_bytes(part.column(1)), strict=True):
                    words = text.split()
                    if edit is not None:
                        words = edit(row_id, words)
                    rows = runs_of(words, min_words)
                    counts.append(len(words))
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in rows])
                    texts.append(b" ".join(collapsed(words, rows)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(counts, pa.int64()),
                        pa.array(runs, _RUN_TYPE),
                        pa.array(texts, pa.binary()).cast(pa.string()),
                    ],
                    [id_col, "n_words", "runs", "collapsed"],
                )

    id_type = documents.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, n_words bigint, runs {RUN}, collapsed string"
    return documents.select(id_col, text_col).mapInArrow(found, schema)


def collapse_runs(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **named) -> DataFrame:
    """``documents`` with every text collapsed, all other columns as they are.

    Rows are edited in place: NULL ids, repeated rows and extra columns stay; a NULL text stays NULL.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    row = fresh(documents, "row")
    found = find_runs(documents.select(whole.alias(row), F.col(text_col)), row, text_col, **named)
    text = F.when(F.col(f"`{row}`.`{text_col}`").isNotNull(), F.col("collapsed"))
    return found.select(
        *[(text if c == text_col else F.col(f"`{row}`.`{c}`")).alias(c) for c in documents.columns]
    )


def with_loops(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The query's test texts: a tenth of the documents goes round in a loop from some word on."""
    if doc_id is None or not words:
        return words
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    loop = words[a : a + p]
    return words[:a] + (loop * -(-(n - a) // len(loop)))[: n - a]


def longest(runs: Column) -> Column:
    """The run of the greatest length; ties go to the smallest start, then period.  NULL without runs."""
    keyed = F.transform(runs, lambda r: F.struct((-r.length).alias("k"), r.start, r.period, r.length))
    return F.array_min(keyed)


def periodic_runs(spark, sf_dir) -> DataFrame:
    """One row per document with the digests of its runs and of its collapsed text."""
    documents = table(spark, sf_dir, "documents")
    found = find_runs(documents, edit=with_loops)
    best = F.col("best")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    return found.withColumn("best", longest(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.start.alias("start"),
        best.length.alias("length"),
        best.period.alias("period"),
        F.floor(F.lit(1000) * best.length / best.period).alias("exponent_milli"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

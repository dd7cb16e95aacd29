"""Benchmark decontamination with a generalised suffix automaton over words.

The normalised test items are put into suffix automata.  Training texts stream through them word by
word: the state after a word stands for the longest run of words, ending there, that occurs in some
item, and its length is tracked.  Where that length reaches the window, the last words are a window of
an item; which items is noted at the states.  Spans found this way are reported, or cut out of the
text, and a document that consists of them too far goes as a whole.
"""

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.functions import arrow_udf

from .common import fresh, small_batches, table, text_bytes

WINDOW = 10
#: Words of test items in one automaton; more items make more automata, each a pass of its own.
AUTOMATON_WORDS = 100_000
#: A document of which at least this share of words is hit goes as a whole.
MOST_COVERAGE = 0.5

_SEPARATORS = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Lower-cases A-Z and turns everything between words into blanks; bytes above 0x7F belong to words.
_NORMAL = bytes(
    c + 32 if 0x41 <= c <= 0x5A else 32 if c in _SEPARATORS else c for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_NORMAL).split()


class Automaton:
    """Generalised suffix automaton of word sequences.

    State 0 is the root.  For each state: the transitions, the length of its longest run, its suffix
    link, and for the windows that end there what to report.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.step: list[dict] = [{}]
        self.length, self.link = [0], [-1]
        ids = sorted({item_id for item_id, words in items if words})
        number = {item_id: k for k, item_id in enumerate(ids)}
        self.ids = ids
        ends: list[list[tuple[int, int]]] = []
        for item_id, words in items:
            if not words:
                continue
            state, visited = 0, []
            for word in words:
                state = self._extend(state, word)
                visited.append(state)
            ends.append((number[item_id], words))
        self._annotate(ends)
        self.shortest = min((min(window, len(words)) for _, words in ends), default=1)
        self.vocabulary = {word for _, words in ends for word in words}

    def _new(self, length: int) -> int:
        self.step.append({})
        self.length.append(length)
        self.link.append(0)
        return len(self.step) - 1

    def _clone(self, p: int, word: bytes, q: int) -> int:
        """Split the runs of ``q`` that continue those of ``p`` off into a state of their own."""
        clone = self._new(self.length[p] + 1)
        self.step[clone] = dict(self.step[q])
        self.link[clone] = self.link[q]
        self.link[q] = clone
        while p >= 0 and self.step[p].get(word) == q:
            self.step[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.step[last].get(word)
        if q is not None:  # another item had this run already
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
        state, p = self._new(self.length[last] + 1), last
        while p >= 0 and word not in self.step[p]:
            self.step[p][word] = state
            p = self.link[p]
        if p >= 0:
            q = self.step[p][word]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
        return state

    def _annotate(self, items) -> None:
        """Which items have a window ending at a state, by the length of the window.

        The state whose runs include the last ``n`` words is the one on the chain of suffix links with
        length[link] < n <= length.  ``reports[state]`` has (n, items) of that state alone; ``above``
        leads to the next state up the chain that has a report.
        """
        self.reports: dict[int, dict[int, set[int]]] = {}
        for number, words in items:
            n, state, run = min(self.window, len(words)), 0, 0
            for k, word in enumerate(words):
                state = self.step[state][word]
                run += 1
                while self.length[self.link[state]] >= n:
                    state = self.link[state]
                run = min(run, self.length[state])
                if k + 1 >= n:
                    self.reports.setdefault(state, {}).setdefault(n, set()).add(number)
        self.above = [0] * len(self.step)
        for state in sorted(range(1, len(self.step)), key=self.length.__getitem__):
            up = self.link[state]
            self.above[state] = up if up in self.reports else self.above[up]

    def spans(self, words: list[bytes]) -> tuple[list[list[int]], list[str]]:
        """Hit spans (first word, one past the last; merged, in order), and the ids of items found."""
        hits: list[list[int]] = []
        found: set[int] = set()
        # Only stretches of words that items have, long enough for a window, enter the automaton.
        known = np.fromiter(map(self.vocabulary.__contains__, words), np.int8, len(words))
        edges = np.flatnonzero(np.diff(known, prepend=0, append=0)).reshape(-1, 2)
        for first, stop in edges[edges[:, 1] - edges[:, 0] >= self.shortest].tolist():
            self._stream(words, first, stop, hits, found)
        return hits, sorted(self.ids[k] for k in found)

    def _stream(self, words, first, stop, hits, found) -> None:
        step, length, link, above, reports = self.step, self.length, self.link, self.above, self.reports
        state = run = 0
        for k in range(first, stop):
            word = words[k]
            nxt = step[state].get(word)
            while nxt is None and state:
                state = link[state]
                run = length[state]
                nxt = step[state].get(word)
            if nxt is None:
                continue
            state = nxt
            run += 1
            at, reach = state, 0
            while at:
                if at in reports:
                    for n, items in reports[at].items():
                        if n <= run:
                            reach = max(reach, n)
                            found.update(items)
                at = above[at]
            if reach:
                start = k + 1 - reach
                while hits and hits[-1][0] >= start:
                    hits.pop()
                if hits and hits[-1][1] >= start:
                    hits[-1][1] = k + 1
                else:
                    hits.append([start, k + 1])


def _groups(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[str, bytes]]]:
    """Items in groups of at most ``AUTOMATON_WORDS`` words, or one item if that has more."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("binary")
    ).where(F.col(text_col).isNotNull())
    group, size = [], 0
    for item_id, text in items.toLocalIterator():
        n = len(words_of(bytes(text)))
        if group and size + n > AUTOMATON_WORDS:
            yield sorted(group)
            group, size = [], 0
        group.append((item_id, bytes(text)))
        size += n
    yield sorted(group)


_built: dict = {}


def _automaton(group: list[tuple[str, bytes]], window: int) -> Automaton:
    """The automaton of a group; a worker keeps those it built, which are as many as there are groups."""
    key = (window, hashlib.sha256(repr(group).encode()).digest())
    if key not in _built:
        _built[key] = Automaton([(item_id, words_of(text)) for item_id, text in group], window)
    return _built[key]


_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _as_struct(n_words, spans, items) -> pa.StructArray:
    return pa.StructArray.from_arrays(
        [
            pa.array(n_words, pa.int64()),
            pa.array(spans, pa.list_(pa.list_(pa.int64()))),
            pa.array(items, pa.list_(pa.string())),
        ],
        ["n_words", "spans", "items"],
    )


def _search(groups: list[list[tuple[str, bytes]]], window: int, text: Column) -> Column:
    @arrow_udf(_FOUND)
    def found(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        automata = [_automaton(group, window) for group in groups]
        for texts in batches:
            counts, spans, items = [], [], []
            for value in text_bytes(texts):
                words = words_of(value)
                each = [a.spans(words) for a in automata]
                counts.append(len(words))
                spans.append(each[0][0] if len(each) == 1 else _union([s for s, _ in each]))
                items.append(sorted({i for _, ids in each for i in ids}))
            yield _as_struct(counts, spans, items)

    return found(text)


def _union(lists: list[list[list[int]]]) -> list[list[int]]:
    out: list[list[int]] = []
    for start, stop in sorted(span for spans in lists for span in spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return out


def find_hits(
    documents: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> tuple[DataFrame, str]:
    """``documents`` with a struct (n_words, spans, items) under a free name, and that name.

    A window is ``window`` consecutive words of an item, or the whole of a shorter one; a word inside
    any occurrence of a window is hit.  ``spans`` are merged word ranges, ``items`` the ids, as text, of
    the items with occurring windows, sorted; a NULL id is the empty text, repeated ids count once.
    NULL texts and items have no words.  The items are a stated query set: they pass through the
    driver in bounded groups, one automaton each, and go to the tasks with the function.
    """
    small_batches(documents.sparkSession)
    column = fresh(documents, "benchmark_hits")
    groups = list(_groups(benchmark, item_id_col, item_text_col))
    return documents.withColumn(column, _search(groups, window, F.col(text_col))), column


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **named) -> DataFrame:
    """One row per document: id, n_words, n_hit, n_items, items_sha256, contaminated.

    items_sha256 is that of the item ids, sorted as text and joined by commas (of nothing: of the empty
    text).  Repeated rows stay repeated.
    """
    marked, hits = find_hits(documents.select(id_col, named.get("text_col", "text")), benchmark, **named)
    n_hit = F.aggregate(f"{hits}.spans", F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    return marked.select(
        id_col,
        F.col(f"{hits}.n_words").alias("n_words"),
        n_hit.alias("n_hit"),
        F.size(f"{hits}.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(f"{hits}.items", ","), 256).alias("items_sha256"),
        (F.size(f"{hits}.spans") > 0).alias("contaminated"),
    )


_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def cut(text: bytes, spans: list[list[int]]) -> bytes:
    """The text without the words of ``spans`` and what stands between them."""
    places = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for first, stop in spans:
        out.append(text[at : places[first][0]])
        at = places[stop - 1][1]
    return b"".join([*out, text[at:]])


@arrow_udf(T.StringType())
def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    rest = [
        cut(value, gone).decode() for value, gone in zip(text_bytes(texts), spans.to_pylist(), strict=True)
    ]
    return pa.array(rest, pa.string())


def remove_benchmark(
    documents: DataFrame,
    benchmark: DataFrame,
    most_coverage: float = MOST_COVERAGE,
    text_col: str = "text",
    length_col: str | None = "n_chars",
    **named,
) -> DataFrame:
    """``documents`` without the words of benchmark windows; all columns stay.

    Spans are cut out of the text, and a document of which at least ``most_coverage`` of the words is
    hit goes as a whole.  A text without hits stays as it is, NULL included; ``length_col``, where there
    is one, follows the text that was cut.
    """
    marked, hits = find_hits(documents, benchmark, text_col=text_col, **named)
    spans = F.col(f"{hits}.spans")
    n_hit = F.aggregate(spans, F.lit(0).cast("long"), lambda total, s: total + s[1] - s[0])
    kept = marked.where((F.size(spans) == 0) | (n_hit < F.col(f"{hits}.n_words") * most_coverage))
    clean, touched = kept.where(F.size(spans) == 0), kept.where(F.size(spans) > 0)
    touched = touched.withColumn(text_col, _without(F.col(text_col), spans))
    if length_col in documents.columns:
        kind = documents.schema[length_col].dataType
        touched = touched.withColumn(length_col, F.length(text_col).cast(kind))
    return clean.unionByName(touched).drop(hits)


def benchmark_decontamination(spark, sf_dir) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL),
sized AS (
  SELECT item_id, words, least(10, len(words)) AS n FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM (SELECT item_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM sized)),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
grams AS (
  SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS gram
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i
        FROM docs, (SELECT DISTINCT n FROM sized) WHERE len(words) >= n)),
found AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN windows w ON g.n = w.n AND g.gram = w.gram),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS k FROM found) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h ON d.doc_id = h.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

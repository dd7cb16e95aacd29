"""Backoff scores, mixing, decontamination: brute force on small data, and the awkward rows."""

import math
import random
from collections import Counter

import pytest

from territory_analytics.llm import backoff, decontaminate, mixing

RNG = random.Random(12)


def prose(n, kinds=12, rng=RNG):
    return " ".join(rng.choice("abcdefghijkl"[:kinds]) for _ in range(n))


def brute_scores(texts, order, factor):
    split = [(t or "").encode().lower().split() for t in texts]
    counts = Counter()
    for words in split:
        for n in range(1, order + 1):
            counts.update(tuple(words[k : k + n]) for k in range(len(words) - n + 1))
    total = sum(map(len, split))
    out = []
    for words in split:
        score = 0.0
        for k in range(len(words)):
            most = min(k, order - 1)
            for n in range(most, -1, -1):
                gram, before = tuple(words[k - n : k + 1]), tuple(words[k - n : k])
                if n and counts[gram] > 1:
                    score += math.log(factor ** (most - n) * (counts[gram] - 1) / (counts[before] - 1))
                    break
                if not n:
                    score += math.log(factor**most * max(1, counts[gram] - 1) / max(1, total - 1))
        out.append((len(words), score))
    return out


@pytest.mark.parametrize("order, block, part", [(3, 1 << 20, 1 << 20), (3, 7, 40), (2, 5, 25), (1, 3, 10), (4, 11, 60)])
def test_scores_by_brute_force(spark, order, block, part):
    texts = [prose(60), prose(33), None, "", "solo", prose(1), "A b A b \x0b a", prose(200, 4), "\n", prose(33)]
    ids = [5, 5, 7, None, 8, 9, None, 10, 11, 12]
    docs = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts)], "doc_id long, text string, n_words int")
    got = backoff.backoff_scores(docs.repartition(3), order=order, block_words=block, part_entries=part).collect()
    expected = [
        (i, n, round(s, 4), round(s / n, 4) if n else None)
        for i, (n, s) in zip(ids, brute_scores(texts, order, backoff.FACTOR))
    ]
    key = lambda r: (repr(r[0]), r[1], r[2])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(expected, key=key), strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-4)
        assert a[3] == b[3] if b[3] is None else a[3] == pytest.approx(b[3], abs=2e-4)


def test_trigrams_with_a_single_bigram_are_not_asked_for(spark):
    texts = ["a b c d e f", "a b c x y z", "b c d"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    blocks = backoff.word_blocks(docs, "doc_id", "text", 3, 1 << 20)
    asked = backoff.requests(blocks, 3, 0)
    answers = backoff.count_table(asked).withColumn("longest", backoff.F.lit(False))
    last = backoff.requests(backoff._with_answers(blocks, answers), 3, 0, longest=True)
    sizes = [[len(backoff._unpacked(r["counts"], "uint32")) for r in x.collect()] for x in (asked, last)]
    # Nine words and eight bigrams, but of the trigrams only "a b c" and "b c d".
    assert sizes == [[17], [2]]


def test_no_documents_no_scores(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert backoff.backoff_scores(docs).count() == 0


def test_targets_fill_up_and_share_the_rest(spark):
    sizes = {"a": 1000, "b": 10, "c": 400, "d": 0, None: 50}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    total = sum(sizes.values())
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2]))
    assert sum(got.values()) == pytest.approx(total)
    assert all(got[s] <= 3 * sizes[s] + 1e-9 for s in sizes)
    level = got["a"] / weights["a"]
    for s in sizes:
        assert got[s] == pytest.approx(min(3 * sizes[s], level * weights[s]))


def mixed(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target double")


def test_mix_comes_near_its_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TIME_SLOTS", 8)
    monkeypatch.setattr(mixing, "LAST_ROWS", 5)
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(40), rng.choices(["a", "b", "c", "d"], [1, 8, 2, 3])[0], 0.5) for k in range(900)]
    report = mixing.mix_report(mixed(spark, rows)).collect()
    total = sum(r.size for r in report)
    assert len(report) == 900 and 0 <= total - sum(r.taken for r in report) <= 40
    for source in "abcd":
        own = [r for r in report if dict((x[0], x[2]) for x in rows)[r.doc_id] == source]
        assert sum(r.size for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= 80
        assert all(r.taken in (0, r.size, 2 * r.size, 3 * r.size) for r in own)
    again = mixing.mix_report(mixed(spark, rows[::-1]).repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, report))
    kept = Counter(r.doc_id for r in mixing.mix(mixed(spark, rows)).collect())
    assert all(kept[r.doc_id] * r.size == r.taken for r in report)


def test_mix_of_awkward_rows(spark):
    rows = [(1, "a b", None, 1.0), (1, "a b", None, 1.0), (None, None, "s", None), (None, "", "s", 0.0),
            (2, "x " * 50_000, "t", 0.0), (3, "é é", "s", 0.0), (3, "é é", "", 0.0)]
    docs = mixed(spark, rows)
    report = mixing.mix_report(docs).collect()
    assert sorted(r.size for r in report) == [0, 0, 2, 2, 2, 2, 50_000]
    assert all(r.taken <= 3 * r.size for r in report)
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix_report(docs.limit(0)).count() == 0
    nothing = docs.where("size(split(text, ' ')) = 1 OR text IS NULL")
    assert all(r.taken == 0 and r.target == 0 for r in mixing.mix_report(nothing).collect())


def brute_hits(words, items, window):
    hit, found = set(), set()
    for item_id, item in items:
        n = min(window, len(item))
        for a in range(len(item) - n + 1 if n else 0):
            for k in range(len(words) - n + 1):
                if words[k : k + n] == item[a : a + n]:
                    hit.update(range(k, k + n))
                    found.add(item_id)
    return hit, found


@pytest.mark.parametrize("window", [1, 2, 4, 10])
def test_automaton_by_brute_force(window):
    rng = random.Random(window)
    for _ in range(60):
        kinds = rng.choice([2, 3, 6])
        items = [
            (str(rng.randrange(4)), prose(rng.choice([0, 1, 2, 3, 5, 9, 14]), kinds, rng).encode().split())
            for _ in range(rng.randrange(6))
        ]
        automaton = decontaminate.Automaton(items, window)
        for _ in range(5):
            words = prose(rng.randrange(40), kinds + 1, rng).encode().split()
            spans, found = automaton.spans(words)
            hit, names = brute_hits(words, items, window)
            assert {k for a, b in spans for k in range(a, b)} == hit
            assert found == sorted(names)
            assert all(x[1] < y[0] for x, y in zip(spans, spans[1:]))


def test_words_of_texts():
    assert decontaminate.words_of("It's ÀÉ-42_x\x7fK z".encode()) == [b"it", b"s", "ÀÉ".encode(), b"42", b"x", "k z".encode()]


ITEM = "one two three four five six seven eight nine ten eleven"
DOCS = [
    (1, f"Start. One, two three FOUR five six-seven eight nine ten! And a long tail of other words {'x ' * 30}", 1),
    (2, "one two three four five six seven eight nine", 1), (None, ITEM, 1), (3, None, 1), (4, "", 1),
    (5, "the short item, again", 1), (5, "the short item, again", 1), (6, "nothing here", None), (7, "w " * 80_000, 1),
]
ITEMS = [(10, ITEM, 0), (9, f"zero {ITEM}", 0), (9, f"zero {ITEM}", 0), (8, None, 0), (None, "Short ITEM", 0), (7, "...", 0)]


def tables(spark):
    docs = spark.createDataFrame([(*d[:2], len(d[1] or ""), "s") for d in DOCS], "doc_id long, text string, n_chars long, benchmark_hits string")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string, n_words int")


@pytest.mark.parametrize("words", [100_000, 3])
def test_contamination_of_awkward_rows(spark, monkeypatch, words):
    import hashlib

    monkeypatch.setattr(decontaminate, "AUTOMATON_WORDS", words)
    docs, items = tables(spark)
    got = sorted((tuple(r) for r in decontaminate.contamination(docs, items).collect()), key=repr)
    sequences = [("" if i is None else str(i), decontaminate.words_of((t or "").encode())) for i, t, _ in ITEMS]
    expected = []
    for doc_id, text, _ in DOCS:
        own = decontaminate.words_of((text or "").encode())
        hit, names = brute_hits(own, sequences, 10)
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        expected.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    assert got == sorted(expected, key=repr)
    assert decontaminate.contamination(docs.limit(0), items).count() == 0
    assert not decontaminate.contamination(docs, items.limit(0)).where("contaminated").count()


def test_benchmark_words_are_cut_out(spark):
    docs, items = tables(spark)
    rest = decontaminate.remove_benchmark(docs, items)
    assert rest.columns == docs.columns and rest.dtypes == docs.dtypes
    texts = {r.doc_id: r for r in rest.collect()}
    assert set(texts) == {1, 2, 3, 4, 6, 7}  # the others consist of benchmark words by half or more
    assert texts[1].text == f"Start. ! And a long tail of other words {'x ' * 30}" and texts[1].n_chars == len(texts[1].text)
    assert texts[2].text == DOCS[1][1] and texts[3].text is None and texts[7].n_chars == 160_000

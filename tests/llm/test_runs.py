"""Periodic runs: Lyndon arrays and runs against their definitions, the query, the awkward rows."""

import hashlib
import random
import zlib

import numpy as np

from territory_analytics.llm import runs


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def lyndon_by_definition(symbols):
    def is_lyndon(word):
        return all(word < word[k:] + word[:k] for k in range(1, len(word)))

    n = len(symbols)
    return [max(k for k in range(1, n - i + 1) if is_lyndon(symbols[i : i + k])) for i in range(n)]


def runs_by_definition(words, least):
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        start = 0
        while start + q < n:
            stop = start
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop + q - start
            part = words[start : start + length]
            if stop > start and length >= max(least, 2 * q):
                if all(part[d:] != part[: length - d] for d in range(1, q)):
                    found.append((start, length, q))
            start = max(stop, start + 1)
    return sorted(found, key=lambda run: (run[0], run[2]))


def random_words(rng, most=60):
    n, kinds = rng.randint(0, most), rng.randint(1, 6)
    words = [rng.randint(0, kinds) for _ in range(n)]
    if n > 4 and rng.random() < 0.5:
        a = rng.randrange(n)
        words = words[:a] + [words[a + (i - a) % (1 + (n - a) // 3)] for i in range(a, n)]
    return words


def test_lyndon_array_by_definition():
    rng = random.Random(1)
    for _ in range(800):
        symbols = [rng.randint(0, rng.randint(1, 4)) for _ in range(rng.randint(0, 13))]
        assert runs.lyndon_lengths(np.array(symbols, np.int64)) == lyndon_by_definition(symbols)


def test_runs_by_definition():
    rng = random.Random(2)
    for _ in range(1500):
        words, least = random_words(rng), rng.choice([2, 4, 12])
        assert runs.runs_of(words, least) == runs_by_definition(words, least)


def test_nested_and_long_runs():
    inner = list("ab") * 7 + ["c"]
    found = runs.runs_of(inner * 3)
    assert found == runs_by_definition(inner * 3, 12) and len(found) == 4
    assert runs.runs_of(["x"] * 200_000) == [(0, 200_000, 1)]
    a, b = ["a"], ["a", "b"]
    while len(b) < 400:
        a, b = b, b + a
    assert runs.runs_of(b) == runs_by_definition(b, 12)


def test_pieces_lose_no_run():
    rng = random.Random(3)
    for _ in range(300):
        words = np.array(random_words(rng, 80), np.int64)
        kept = runs.pieces(words, 12)
        for start, length, _ in runs_by_definition(words.tolist(), 12):
            assert any(a <= start and start + length <= b for a, b in kept)


AWKWARD = [
    (0, "a b c d e f " * 3, "x", 1),
    (0, "a b c d e f " * 3, "x", 1),
    (7, None, None, None),
    (8, "", "y", 2),
    (9, " \t\n ", "y", 2),
    (None, "é ü " * 30, "y", 3),
    (10, "one " * 60_000, "y", 3),
    (12, " ".join(f"w{k}" for k in range(3_000)), "y", 3),
]


def awkward(spark):
    return spark.createDataFrame(AWKWARD, "doc_id long, text string, runs string, row int")


def test_operator_on_awkward_rows(spark):
    docs = awkward(spark)
    found = runs.find_runs(docs).collect()
    assert len(found) == len(AWKWARD)
    by_id = {r.doc_id: r for r in found}
    assert [tuple(r) for r in by_id[0].runs] == [(0, 18, 6)] and by_id[0].collapsed == "a b c d e f"
    assert by_id[7].n_words == by_id[8].n_words == by_id[9].n_words == 0
    assert by_id[7].collapsed == "" and by_id[9].runs == []
    assert [tuple(r) for r in by_id[None].runs] == [(0, 30, 1)]
    assert [tuple(r) for r in by_id[10].runs] == [(0, 60_000, 1)] and by_id[10].collapsed == "one"
    assert by_id[12].runs == [] and by_id[12].n_words == 3_000
    assert runs.find_runs(docs.limit(0)).count() == 0


def test_texts_are_collapsed_in_place(spark):
    docs = awkward(spark)
    out = runs.collapse_runs(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: (r.text, r.runs, r.row) for r in out.collect()}
    assert texts[0] == ("a b c d e f", "x", 1) and texts[7] == (None, None, None)
    assert texts[10] == ("one", "y", 3)


def query_by_definition(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode())
    n = len(words)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = runs_by_definition(words, 12)
    gone = {i for s, k, q in found for i in range(s + q, s + k)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
    return (
        doc_id,
        len(found),
        *((best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4),
        hashlib.sha256(lines.encode()).hexdigest(),
        hashlib.sha256(kept).hexdigest(),
    )


def test_query_against_brute_force(spark, folder):
    rng = random.Random(4)
    texts = [" ".join(f"w{x}" for x in random_words(rng, 200)) for _ in range(300)]
    texts += [None, "", "one", "loop the loop " * 20]
    table = [(k, text) for k, text in enumerate(texts)]
    spark.createDataFrame(table, "doc_id long, text string").write.parquet(f"{folder}/documents.parquet")
    got = runs.periodic_runs(spark, folder)
    assert rows(got) == sorted((query_by_definition(*row) for row in table), key=repr)
    assert sum(r.n_runs > 0 for r in got.collect()) > 30

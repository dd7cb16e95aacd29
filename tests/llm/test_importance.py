"""Importance resampling: checksums, buckets and draws against their definitions, the awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from territory_analytics.llm import importance


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    lowered = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    return WORD.findall(lowered)


def buckets_of(text):
    words = words_of(text)
    return [
        zlib.crc32(b" ".join(words[i : i + k])) % 10_000
        for k in (1, 2, 3)
        for i in range(len(words) - k + 1)
    ]


def test_checksums_of_spans_of_any_length():
    rng = random.Random(1)
    text = np.frombuffer(rng.randbytes(5_000), np.uint8)
    starts = np.array([rng.randrange(5_000) for _ in range(400)])
    sizes = [rng.choice([0, 1, 3, 4, 63, 64, 65, 127, 128, 129, 300, 2_000]) for _ in starts]
    stops = np.minimum(5_000, starts + sizes)
    want = [zlib.crc32(text[a:b].tobytes()) for a, b in zip(starts, stops)]
    assert importance.span_checksums(text, starts, stops).tolist() == want


TEXTS = ["", "one", "a b", "A-b  c.d", " Éa ü x", "x" * 500 + " y z " + "w" * 200, "...", "q " * 50, "0A9z`{"]


@pytest.mark.parametrize("looked_up", [100, 2_000_000])
def test_buckets_by_definition(monkeypatch, looked_up):
    monkeypatch.setattr(importance, "LOOKED_UP", looked_up)
    rng = random.Random(2)
    texts = TEXTS + ["".join(rng.choice("abcABC 12.,éü") for _ in range(rng.randrange(400))) for _ in range(60)]
    got = [[] for _ in texts]
    for document, bucket in importance.bucketed((t.encode() for t in texts), 10_000):
        for d, b in zip(document.tolist(), bucket.tolist()):
            got[d].append(b)
    assert [sorted(x) for x in got] == [sorted(buckets_of(t)) for t in texts]


def by_definition(documents, target):
    source, wanted = Counter(), Counter()
    for _, text in documents:
        source.update(buckets_of(text))
    for _, text in target:
        wanted.update(buckets_of(text))
    s_all, t_all = float(sum(source.values())), float(sum(wanted.values()))

    def gain(b):
        return math.floor(1000 * math.log(((wanted[b] + 1) * (s_all + 10_000)) / ((source[b] + 1) * (t_all + 10_000))))

    out = []
    for doc_id, text in documents:
        found = buckets_of(text)
        weight = sum(map(gain, found))
        name = "" if doc_id is None else str(doc_id)
        h = int(hashlib.sha256(f"42:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, len(words_of(text))])
    fit = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[4] = place
    return sorted((tuple(r[:5]) for r in out), key=repr)


def corpus():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(300)]
    docs = [(k, " ".join(rng.choices(words, k=rng.randrange(5, 120)))) for k in range(400)]
    docs += [(400, None), (401, ""), (402, "!!"), (403, docs[0][1]), (404, "Long" * 5_000 + " x y"), (405, "Wort ü " * 20_000)]
    target = [(k, " ".join(rng.choices(words[:40], k=60))) for k in range(20)] + [(20, None)]
    return docs, target


def test_query_against_brute_force(spark, folder):
    docs, target = corpus()
    spark.createDataFrame(docs, "doc_id long, text string").repartition(5).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(target, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    got = importance.importance_resampling(spark, folder)
    assert rows(got) == by_definition(docs, target)
    assert got.where("rank IS NOT NULL").count() == 5 * sum(len(words_of(t)) >= 20 for _, t in docs) // 100


def test_draw_prefers_the_target(spark):
    docs, target = corpus()
    docs += [(1_000 + k, " ".join(target[k][1].split()[::-1])) for k in range(10)]
    drawn = importance.resample(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(target, "item_id long, text string"),
    )
    ids = {r.doc_id for r in drawn.where("rank IS NOT NULL").collect()}
    assert ids >= {1_000 + k for k in range(10)}


def test_awkward_rows(spark):
    text = " ".join(f"w{k}" for k in range(25))
    docs = spark.createDataFrame(
        [(None, text, 1, 2, "x"), (None, text, 1, 2, "x"), (3, text, None, 3, "x"), (3, text, 1, 2, "x"), (4, None, 1, 2, "x")],
        "doc_id long, text string, part int, weight int, fits string",
    )
    target = spark.createDataFrame([(1, "w1 w2 w3")], "item_id long, text string")
    got = importance.resample(docs, target, share_percent=100).collect()
    assert len(got) == 5 and sorted(r.rank for r in got if r.rank) == [1, 2, 3, 4]
    assert next(r for r in got if r.doc_id == 4).rank is None
    same = [r.rank for r in got if r.doc_id is None]
    assert abs(same[0] - same[1]) == 1
    assert importance.resample(docs.limit(0), target).count() == 0
    assert importance.resample(docs, target.limit(0)).count() == 5


def test_ties_go_to_the_smaller_id(spark):
    from pyspark.sql import functions as F

    scored = spark.range(200).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("score"))
    got = importance.ranked(scored.repartition(7), F.col("doc_id") != 5, "doc_id", 100).collect()
    want = sorted((r for r in got if r.doc_id != 5), key=lambda r: (-r.score, r.doc_id))[:100]
    assert [r.rank for r in want] == list(range(1, 101))
    assert sum(r["rank"] is not None for r in got) == 100

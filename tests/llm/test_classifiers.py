"""Quality and toxicity: the learning parts on small data, and the awkward rows."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from territory_analytics.llm import quality, toxicity

GOOD = "The river ran past the old mill, and people from the town met there. Nobody was in a hurry."
BAD = "The%%% river### ran*** past$$$ the&&& old%%% mill### and*** people$$$"


def corpus(spark, n=60):
    rows = [(k, (GOOD if k % 3 else BAD) + f" Number {k}.", "x", 1) for k in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, quality_score string, _kind int")


def labels(spark, n=60, column="quality"):
    return spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(n)], f"doc_id long, {column} int")


def test_features_are_bounded_for_any_text():
    for text in (b"", b" ", b"a", b"\n\n", b"|||", "é".encode() * 50_000, b"x" * 300_000):
        row = quality.features(text)
        assert len(row) == quality.N_FEATURES
        assert all(np.isfinite(v) and -0.01 <= v <= 3 for v in row)


def test_prior_is_found_from_scores():
    rng = np.random.default_rng(0)
    positive = rng.normal(2, 1, 4000)
    unlabelled = np.concatenate([rng.normal(2, 1, 2800), rng.normal(-2, 1, 1200)])
    assert quality.estimate_prior(positive, unlabelled) == pytest.approx(0.7, abs=0.07)


def test_unlabelled_text_is_told_apart_without_negatives():
    rng = np.random.default_rng(1)
    shape = (600, quality.N_FEATURES)
    positive = rng.normal(0, 0.1, shape)
    hidden = np.concatenate([rng.normal(0, 0.1, shape), rng.normal(1, 0.1, (300, shape[1]))])
    model = quality.train(positive.astype(np.float32), hidden.astype(np.float32))
    assert model.score(hidden[:600]).mean() > 0.9
    assert model.score(hidden[600:]).mean() < 0.1


def test_rejected_documents_go_and_columns_stay(spark):
    docs = corpus(spark)
    kept = quality.keep_good(docs, labels(spark))
    assert kept.columns == docs.columns
    texts = [r.text for r in kept.collect()]
    assert len(texts) == 40 and all("%%%" not in t for t in texts)


def test_quality_of_awkward_rows(spark):
    docs = corpus(spark).unionByName(
        spark.createDataFrame(
            [(None, GOOD, "x", 1), (3, None, None, None), (900, "", "x", 1), (900, "", "x", 1)],
            "doc_id long, text string, quality_score string, _kind int",
        )
    )
    model = quality.fit(docs, labels(spark).where("quality = 1"))
    rows = docs.select("doc_id", quality.score(model, F.col("text")).alias("s")).collect()
    assert len(rows) == 64 and all(0 <= r.s <= 1 for r in rows)
    empty = docs.limit(0)
    assert quality.fit(empty, labels(spark)) is None
    assert quality.fit(docs, labels(spark).limit(0)) is None
    assert quality.keep_good(empty, labels(spark)).count() == 0


def brute_kernel(a: str, b: str) -> float:
    """Gap-weighted subsequences of three characters within a span, by the definition."""

    def weights(word):
        marked, found = f"^{word}$", {}
        for i, j, k in itertools.combinations(range(len(marked)), 3):
            if k - i < toxicity.SPAN:
                key = marked[i] + marked[j] + marked[k]
                found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i + 1)
        return found

    x, y = weights(a), weights(b)
    norm = np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    return (sum(v * y.get(k, 0) for k, v in x.items()) / norm) ** toxicity.POWER


def test_kernel_by_definition():
    words = ["goblin", "gobblin", "gxoblin", "oblin", "a", "at", "banana", "strawberry", "berry"]
    kernel = toxicity.Kernel(["goblin", "banana", "berry"])
    expected = [[brute_kernel(w, z) for z in kernel.landmarks] for w in words]
    assert np.allclose(kernel(words), expected, atol=1e-5)
    long_word = "x" * 40 + "goblin" + "y" * 40
    assert kernel([long_word])[0, 0] > kernel(["strawberry"])[0, 0]


def test_reading_of_disguised_words():
    assert toxicity.units(b"g.o.b-l_in!") == ["goblin"]
    assert toxicity.units(b"g0bl1n$$$") == ["goblin"]
    assert toxicity.units(b"half-way") == ["halfway", "half", "way"]
    assert toxicity.units(b"12:30") == [] and toxicity.units(b"***") == []
    assert toxicity.spelled_out([b"a", b"g", b"o", b"it", b"x", b"y"]) == [b"ago"]


def toxic_corpus():
    rng = np.random.default_rng(3)
    plain = ["river", "garden", "window", "letter", "morning", "teacher", "market", "silver", "wonder"]
    texts, toxic = [], []
    for k in range(240):
        words = list(rng.choice(plain, 60))
        if bad := k % 4 == 0:
            words[int(rng.integers(60))] = ["goblin", "weaselface"][k // 4 % 2]
        for at in range(9, 60, 10):
            words[at] += "."
        texts.append(" ".join(words).encode())
        toxic.append(bad)
    return texts, np.array(toxic)


def test_machine_finds_insults_and_their_disguises():
    texts, toxic = toxic_corpus()
    model = toxicity.train(texts[:160], toxic[:160], 0.25)
    scorer = toxicity.Scorer(model)
    scores = model.probability(scorer.decisions(texts[160:]))
    assert ((scores >= 0.3) == toxic[160:]).all()
    for word in ("g.oblin", "gobblin", "g0blin", "g o b l i n", "weasel-face"):
        assert model.probability(scorer.decisions([f"The {word} of the garden.".encode()]))[0] >= 0.3, word
    assert (model.probability(scorer.decisions([b"", b" ", b"river " * 20_000])) < 0.3).all()
    assert toxicity.train(texts, np.zeros(240, bool), 0.0) is None


def test_toxicity_of_awkward_rows(spark):
    texts, toxic = toxic_corpus()
    rows = [(k, t.decode(), "a") for k, t in enumerate(texts)]
    rows += [(None, "a goblin", "b"), (3, None, "c"), (500, "", None), (500, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label string")
    known = spark.createDataFrame(
        [(k, int(b)) for k, b in enumerate(toxic)] + [(None, 1), (7, None)], "doc_id long, toxic int"
    )
    model = toxicity.fit(docs, known)
    found = docs.select("doc_id", toxicity.score(model, F.col("text")).alias("s")).collect()
    assert len(found) == 244 and all(0 <= r.s <= 1 for r in found)
    assert toxicity.fit(docs, known.limit(0)) is None
    assert docs.select(toxicity.score(None, F.col("text")).alias("s")).distinct().count() == 1

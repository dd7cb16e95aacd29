"""Exact and near duplicates, repeated passages: brute force on small data, and the awkward rows."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

import corpus_pipeline
from territory_analytics import storage
from territory_analytics.llm import components, exact, linking, passages, simhash

RNG = random.Random(5)
WORDS = [f"w{k}" for k in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choices(WORDS, k=n))


def test_components_by_brute_force(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)]
    links += [(1000 + k, 1001 + k) for k in range(60)] + [(5000, 5000 - k) for k in range(1, 50)] + [(7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    got = {r.node: r.root for r in components.components(df).collect()}
    assert got == {x: find(x) for x in root}
    assert components.components(df.limit(0)).count() == 0


def brute_print(text, width):
    words = (text or "").encode().lower().split()
    parts = [b" ".join(words[k : k + width]) for k in range(len(words) - width + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_by_definition(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    for text in ("", "One", "one TWO", "É É\x0bé", prose(200), "a " * 50):
        got = simhash.fingerprint(simhash.shingle_hashes(text.encode(), 3))
        assert got % 2**64 == brute_print(text, 3), text


@pytest.mark.parametrize("distance", [0, 1, 2])
def test_close_pairs_by_brute_force(spark, distance):
    rng = random.Random(8)
    points = {0, 2**64 - 1, 2**63, 1}
    for _ in range(60):
        seed = rng.getrandbits(64)
        for _ in range(6):
            points.add(seed ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(4))))
    signed = [int(np.uint64(p).astype(np.int64)) for p in points]
    df = spark.createDataFrame([(p,) for p in signed] + [(None,)], "fp long")
    got = {tuple(r) for r in simhash.close_pairs(df, max_distance=distance).collect()}
    near = {
        (a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= distance
    }
    assert got == near
    with pytest.raises(ValueError):
        simhash.close_pairs(df, max_distance=3)


def broadcasts(df):
    df.collect()
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def test_cells_of_fingerprints_are_never_broadcast(spark):
    df = storage.durable(spark.range(200).selectExpr("xxhash64(id) AS fp"))
    assert broadcasts(df.join(df.distinct(), "fp"))
    assert not broadcasts(simhash.close_pairs(df))


def test_near_duplicates_of_awkward_rows(spark):
    a = prose(120)
    rows = [(9, a), (4, a), (4, a), (None, a), (7, ""), (8, None), (None, " "), (3, prose(80)), (2, "x" * 200_000)]
    docs = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, fp string")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=repr)
    expected = []
    for doc_id, text in rows:
        mates = [d for d, t in rows if brute_print(t, 3) == brute_print(text, 3) and d is not None]
        expected.append((doc_id, f"{brute_print(text, 3):016x}", min(mates)))
    assert got == sorted(expected, key=repr)
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each_group_stays(spark):
    a, b = prose(300), prose(300)
    rows = [
        (5, a, 1), (2, a.upper(), 2), (8, b, 3), (8, b, 3), (1, prose(300), 4), (None, a, 5),
        (6, "", 6), (3, None, 7), (None, prose(50), 8), (20, "short text", 9), (21, "x " * 100_000, 10),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept_id int")
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(r.kept_id for r in kept.collect()) == [2, 3, 4, 7, 8, 9, 10]
    assert simhash.keep_one_per_group(docs.limit(0)).count() == 0


def test_the_stage_broadcasts_no_cells(spark, monkeypatch):
    rows = [(k, prose(30)) for k in range(40)]
    seen, close_pairs = [], simhash.close_pairs
    monkeypatch.setattr(simhash, "close_pairs", lambda *a: seen.append(close_pairs(*a)) or seen[-1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert corpus_pipeline.one_of_each_group(spark, docs, "").count() == 40
    assert len(seen) == 1 and not broadcasts(seen[0])


def test_groups_of_the_stage_by_brute_force(spark):
    """Texts with a few changed words: some pairs within two bits, some only reachable over others."""
    base, rows = [prose(400).split() for _ in range(6)], []
    for k in range(150):
        words = list(base[k % 6])
        for place in range(k // 6 % 4):
            words[(k * 37 + place * 91) % 400] = f"w{k}"
        rows.append((1_000 - k, " ".join(words)))
    prints = {d: brute_print(t, 3) for d, t in rows}
    groups = {d: {d} for d in prints}
    for x in prints:
        for y in prints:
            if (prints[x] ^ prints[y]).bit_count() <= 2 and groups[x] is not groups[y]:
                both = groups[x] | groups[y]
                for d in both:
                    groups[d] = both
    want = sorted({min(g) for g in groups.values()})
    assert 6 < len(want) < 150
    kept = simhash.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_groups_are_linked_without_all_pairs(spark):
    # 40 similar items, and 70 that match nothing, under one key; links are equal last digits of 10.
    members = [(1, k * 10) for k in range(40)] + [(1, 1000 + k * 10 + k % 9 + 1) for k in range(70)]
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        return pairs.where("a % 10 = b % 10")

    found = linking.verified_links(spark.createDataFrame(members, "key long, node long"), verify)
    got = components.components(found).groupBy("root").count().collect()
    assert sorted(r["count"] for r in got) == sorted([40] + [len(range(k, 70, 9)) for k in range(9)])
    assert sum(seen) < 110 * 109 / 2


def test_directory_doubles_until_buckets_fit():
    loads = np.array([1, 1, 1, 1, 90, 2, 2, 2, 0, 0, 0, 0, 5, 5, 5, 5])
    directory = exact.Directory(loads, 12)
    assert directory.bits == 4
    held = {}
    for cell, load in enumerate(loads):
        held.setdefault(directory.bucket(cell << 60), []).append(load)
    assert sorted(map(sum, held.values())) == [0, 2, 4, 4, 10, 10, 90]
    assert exact.Directory(np.array([3]), 12).bucket(2**64 - 1) == 0


def test_exact_duplicates_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(exact, "COMBINE_BYTES", 600)
    a = prose(30)
    rows = [(1, a), (5, a), (None, a), (5, a), (2, a + " "), (7, ""), (8, None), (None, "alone"), (3, "É"), (9, "x" * 100_000)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, hash int")
    got = sorted(map(tuple, exact.exact_duplicates(docs).collect()), key=repr)
    expected = []
    for doc_id, text in rows:
        same = [d for d, t in rows if (t or "") == (text or "")]
        keep = max((d for d in same if d is not None), default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((doc_id, keep, len(same), doc_id == keep, sha))
    assert got == sorted(expected, key=repr)
    assert exact.exact_duplicates(docs.limit(0)).count() == 0


def test_equal_hashes_are_told_apart_by_bytes(spark, monkeypatch, folder):
    monkeypatch.setattr(exact.xxhash, "xxh64_intdigest", lambda *_: 77)
    entries = []
    for batch in exact._combined(exact.Directory(np.array([1]), 5))(
        iter([__import__("pyarrow").RecordBatch.from_pydict({"id": [1, 2, 3], "text": [b"a", b"b", b"a"]})])
    ):
        entries += batch.to_pylist()
    assert [(e["hash"], e["text"], e["last_id"], e["copies"]) for e in entries] == [(77, b"a", 3, 2), (77, b"b", 2, 1)]
    spark.createDataFrame(
        [(e["hash"], e["text"], e["last_id"], e["copies"], 0) for e in entries],
        "hash long, text binary, last_id long, copies long, bucket int",
    ).write.partitionBy("bucket").parquet(f"{folder}/index")
    got = sorted((r.keep_id, r.group_size) for r in exact.classes(spark, f"{folder}/index").collect())
    assert got == [(2, 1), (3, 2)]


def test_bands_are_tuned_for_recall():
    bands, rows = passages.tune(0.8, 0.995, 12)
    assert (bands, rows) == (6, 2) and 1 - (1 - 0.8**rows) ** bands >= 0.995


def test_any_long_run_has_a_paragraph_of_its_own():
    rng = random.Random(4)
    for n in (49, 50, 80):
        passage = prose(n, rng).encode().split()
        units = []
        for _ in range(2):
            words = prose(rng.randrange(60), rng).encode().split() + passage + prose(40, rng).encode().split()
            grams = passages.shingles(words)
            units.append(set(passages.identity(grams, passages.starts(grams)).tolist()))
        assert units[0] & units[1]


def test_repeated_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(6)
    passage, line = prose(60, rng), prose(55, rng)
    changed = passage.split()
    changed[2] = "other"
    rows = [
        (1, f"{prose(70, rng)} {passage} {prose(30, rng)}"), (2, f"{prose(10, rng)}\n{passage}\n{prose(90, rng)}"),
        (3, prose(200, rng)), (4, f"{line}\n{prose(50, rng)}"), (None, f"{prose(20, rng)} {line}"), (5, None), (6, ""),
        (7, "short"), (8, " ".join(changed)), (9, "again " * 500), (10, prose(150, rng)),
    ]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, doc_key string")
    got = passages.repeated_passages(docs).collect()
    assert {r.doc_id for r in got} == {1, 2, 8, 4, None}
    assert {r.doc_id for r in got if r.removed} == {2, 8, None}
    assert {r.keep_id for r in got} == {1, 4}
    rest = passages.remove_repeats(docs)
    assert rest.columns == docs.columns
    texts = {r.doc_id: r.text for r in rest.collect()}
    before = dict(rows)
    assert all(texts[k] == before[k] for k in (1, 3, 4, 5, 6, 7, 9, 10))
    assert len(texts[2].split()) < len(before[2].split()) - passages.PARAGRAPH + 1
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_one_document_in_two_rows_is_no_repetition(spark):
    text = prose(90)
    docs = spark.createDataFrame([(1, text), (1, text), (2, prose(90))], "doc_id long, text string")
    assert passages.repeated_passages(docs).count() == 0


def test_changed_paragraphs_are_linked(spark):
    """Exact links among all pairs, with a band made of one common line and little else."""
    rng = random.Random(9)
    line = prose(8, rng)
    texts = [f"{prose(7, rng)} {line} {prose(7, rng)}" for _ in range(150)]
    whole = prose(passages.PARAGRAPH, rng).split()
    for k in (0, 1, passages.PARAGRAPH - 1):
        texts.append(" ".join([*whole[:k], "other", *whole[k + 1 :]]))
    texts.append(" ".join(whole))
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string")
    found = {frozenset(r) for r in passages.links(docs, "text", 0.8).collect()}

    def sets(text):
        words = text.split()
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    grams = [passages.shingles(t.encode().split()) for t in texts]
    units = [int(passages.identity(g, np.array([0]))[0]) for g in grams]
    starts = [passages.starts(g).tolist() for g in grams]
    near = set()
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets(texts[a]), sets(texts[b])
            if len(x & y) / len(x | y) >= 0.8 and starts[a] and starts[b]:
                near.add(frozenset((units[a], units[b])))
    assert all(s in ([], [0]) for s in starts)
    assert found <= near and len(near - found) <= len(near) // 10


def test_map_names_every_paragraph(spark):
    rng = random.Random(3)
    units = [rng.getrandbits(64) - 2**63 for _ in range(500)] + [0, -1, 2**24 - 1, -(2**63)]
    bits = np.frombuffer(passages._map_of(spark.createDataFrame([(u,) for u in units], "unit long")), np.uint8)
    places = {u & (2**24 - 1) for u in units}
    assert len(bits) == 2**24 // 8
    assert set(np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist()) == places


def test_large_groups_are_split_without_losing_a_pair(spark):
    rng = random.Random(11)
    common = list(range(5))
    sets = [sorted({*common, *rng.sample(range(100, 100_000), 15)}) for _ in range(120)]
    for k in range(0, 60, 3):  # some are near copies
        sets.append(sorted({*sets[k][:-1], 200_000 + k}))
    members = spark.createDataFrame([(7, k) for k in range(len(sets))] + [(8, 0), (8, 1)], "key long, node long")
    shingles = spark.createDataFrame(list(enumerate(sets)), "node long, shingles array<long>")
    split = linking.split_large(members, shingles, 0.8).collect()
    groups = {}
    for key, node in split:
        groups.setdefault(key, set()).add(node)
    assert {0, 1} in groups.values()
    together = {frozenset((a, b)) for g in groups.values() for a in g for b in g if a < b}
    for a in range(len(sets)):
        for b in range(a):
            x, y = set(sets[a]), set(sets[b])
            if len(x & y) >= 0.8 * len(x | y):
                assert frozenset((a, b)) in together
    assert len(together) < 100


def linked(spark, members, near):
    """Components that ``verified_links`` and brute force find, and the pairs that were verified."""
    seen = set()

    def verify(pairs):
        rows = [tuple(r) for r in pairs.collect()]
        assert len(rows) == len(set(rows)) and not seen & set(rows)
        seen.update(rows)
        return spark.createDataFrame([r for r in rows if near(*r)], "a long, b long")

    got = components.components(linking.verified_links(spark.createDataFrame(members, "key long, node long"), verify))
    groups = {}
    for key, node in members:
        groups.setdefault(key, set()).add(node)
    links = [(a, b) for g in groups.values() for a in g for b in g if a < b and near(a, b)]
    whole = components.components(spark.createDataFrame(links, "a long, b long"))
    return set(map(tuple, got.collect())), set(map(tuple, whole.collect())), seen


def test_large_groups_of_unlike_items_lose_no_link(spark):
    # Items that match nothing, but for three pairs among them.
    few = {(3, 280), (200, 201), (20, 299)}
    got, whole, _ = linked(spark, [(1, k) for k in range(300)], lambda a, b: (a, b) in few)
    assert got == whole and len(got) == 6


def test_items_that_matched_unlike_hubs_are_compared(spark):
    # A chain under one key, and two classes that only their least central items join.
    chain = [(1, k) for k in range(90)]
    small = [(2, 1000 + k) for k in range(40)]

    def near(a, b):
        if a >= 1000:
            return (a, b) in {(1000, 1032), (1001, 1033), (1032, 1033)}
        return b - a == 1

    got, whole, _ = linked(spark, chain + small, near)
    assert got == whole and len({root for _, root in got}) == 2


def test_every_text_of_a_paragraph_has_a_start():
    rng = random.Random(13)
    for n in range(passages.PARAGRAPH, 90):
        for _ in range(20):
            at = passages.starts(passages.shingles(prose(n, rng).encode().split()))
            assert len(at) and at.max() + passages.PARAGRAPH <= n


def test_copies_of_short_documents_are_found(spark):
    rng = random.Random(14)
    texts = [prose(n, rng) for n in range(passages.PARAGRAPH, 49)]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts + texts)], "doc_id long, text string")
    got = {r.doc_id for r in passages.repeated_passages(docs).where("removed").collect()}
    assert got == set(range(len(texts), 2 * len(texts)))


def test_edited_passages_are_found(spark):
    """Recall against brute force: lines with one changed word, and edited runs in the middle of a text."""
    rng = random.Random(15)
    rows, similar = [], set()
    for k in range(40):
        line = prose(60, rng).split()
        edited = [*line[:30], "other", *line[31:]]
        x, y = ({tuple(w[j : j + 5]) for j in range(len(w) - 4)} for w in (line, edited))
        if len(x & y) / len(x | y) >= 0.8:
            similar.add(100 + k)
        rows.append((k, f"{prose(40, rng)}\n{' '.join(line)}\n{prose(40, rng)}"))
        rows.append((100 + k, f"{prose(15, rng)}\n{' '.join(edited)}\n{prose(60, rng)}"))
    for k in range(40):
        run = prose(120, rng).split()
        rows.append((200 + k, f"{prose(9, rng)} {' '.join(run)} {prose(9, rng)}"))
        run[40], run[80] = "one", "other"
        rows.append((300 + k, f"{prose(20, rng)} {' '.join(run)} {prose(3, rng)}"))
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).where("removed").collect()
    assert len(similar) == 40 and similar <= {r.doc_id for r in got}
    assert all(any(r.doc_id == d and r.start <= 15 and r.stop >= 75 for r in got) for d in similar)
    found = {r.doc_id for r in got} & set(range(300, 340))
    assert len(found) >= 36


def test_whole_passages_are_reported_and_removed(spark):
    rng = random.Random(16)
    passage, whole = prose(60, rng), prose(200, rng)
    before, after = prose(17, rng), prose(25, rng)
    rows = [
        (1, f"{prose(33, rng)} {passage} {prose(40, rng)}"), (2, f"{before}\n{passage}\n{after}"),
        (3, whole), (4, f"own words {whole}"), (5, whole),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.start, r.stop) for r in passages.repeated_passages(docs).collect()}
    assert {(1, 33, 93), (2, 17, 77), (3, 0, 200), (4, 2, 202), (5, 0, 200)} <= got
    texts = {r.doc_id: r.text for r in passages.remove_repeats(docs).collect()}
    assert texts[2].split() == f"{before} {after}".split()
    assert texts[3] == whole and texts[4].split() == ["own", "words"] and texts[5] == ""


def test_units_of_several_texts_are_those_of_each():
    rng = random.Random(21)
    texts = [prose(n, rng).encode() for n in (0, 3, 21, 22, 30, 49, 50, 51, 200, 400)] + [b"again " * 90]
    texts += [b"\n".join(prose(n, rng).encode() for n in (25, 4, 60, 22))]
    together = passages.Units(texts)
    keys, units = together.keys(6, 2)
    for k, text in enumerate(texts):
        alone = passages.Units([text])
        own = together.text == k
        got = zip(together.start[own] - together.first[k], together.stop[own] - together.first[k], together.unit[own])
        assert sorted(got) == sorted(zip(alone.start, alone.stop, alone.unit))
        assert sorted(keys[together.text[units] == k]) == sorted(alone.keys(6, 2)[0])


def test_only_units_that_documents_share_are_stored(spark):
    rng = random.Random(22)
    passage = prose(60, rng)
    rows = [(k, prose(80, rng)) for k in range(30)] + [(40 + k, f"{prose(9, rng)} {passage} {prose(30, rng)}") for k in range(2)]
    rows.append((50, " ".join([prose(60, rng)] * 2)))  # repeated in itself alone
    named = spark.createDataFrame([(d, d, t) for d, t in rows], "doc_id long, doc_key long, text string")
    units, shared = passages.shared_units(named, *passages.tune())
    assert {r.doc_id for r in units.collect()} == {40, 41}
    assert {k for r in units.collect() for k in r["keys"]} == {r.key for r in shared.collect()}


def test_paragraphs_with_two_other_shingles_share_a_key():
    rng = random.Random(23)
    words = prose(passages.PARAGRAPH, rng).encode().split()
    for shift, cut in ((0, 1), (0, 2), (1, 0), (2, 0), (1, 1)):
        other = [*words[shift : len(words) - cut], *prose(shift + cut, rng).encode().split()]
        found = []
        for text in (words, other):
            own = passages.Units([b" ".join(text)])
            assert own.at.tolist() == [0]
            keys, units = own.keys(6, 2)
            found.append(set(keys[units == 0].tolist()))
        assert found[0] & found[1]


def test_sketches_of_similar_paragraphs_are_near():
    rng = random.Random(24)
    most, unlike = passages.most_unlike(0.8), []
    for k in range(300):
        words = prose(49, rng).encode().split()
        edited = [*words[:24], b"other", *words[25:]]
        sides = []
        for text in (words, edited, prose(49, rng).encode().split()):
            sketch = passages._sketch(passages.shingles(text), np.array([0]), np.array([49]))
            sides.append([int(x) & (2**64 - 1) for x in sketch[:, 0]])
        far = [sum((x ^ y).bit_count() for x, y in zip(sides[0], side)) for side in sides[1:]]
        assert far[0] <= most
        unlike.append(far[1] > most)
    assert sum(unlike) > 290


def test_words_are_those_of_split():
    rng = random.Random(25)
    for size in [*range(40), 700]:
        text = bytes(rng.choice(b"aB \n\t\x0b\x0c\r\x1c\x00\xc3\xa9z") for _ in range(size))
        begins, ends = passages.split(text)
        assert [text[a:b] for a, b in zip(begins, ends)] == text.split()
        pairs = set(zip(text.lower().split(), passages.hashed(text).tolist()))
        assert len(pairs) == len({word for word, _ in pairs}) == len({value for _, value in pairs})
    long = b" ".join(b"x" * k for k in range(1, 2 * passages.LONG_WORD))
    assert len(set(passages.hashed(long).tolist())) == 2 * passages.LONG_WORD - 1


def test_a_key_of_many_copies_is_two_rows_a_chunk():
    pa = __import__("pyarrow")
    batch = pa.RecordBatch.from_pydict({"doc_key": pa.array(range(50), pa.int64()), "text": [prose(30, random.Random(1))] * 50})
    rows = [r for b in passages._keys(6, 2)(iter([batch])) for r in b.to_pylist()]
    docs = {}
    for r in rows:
        docs.setdefault(r["key"], []).append(r["doc_key"])
    assert docs and all(found == [0, 49] for found in docs.values())


def test_matches_grow_as_far_as_both_sides_agree():
    def by_words(a, b, at, end, low, high):
        if end - at != high - low or (a[at:end] != b[low:high]).any():
            x, y = passages._folded(a[at:end]), passages._folded(b[low:high])
            one, two = np.flatnonzero(np.isin(x, y)), np.flatnonzero(np.isin(y, x))
            if len(one):
                at, end, low, high = at + one[0], at + one[-1] + 5, low + two[0], low + two[-1] + 5
        while at and low and a[at - 1] == b[low - 1]:
            at, low = at - 1, low - 1
        while end < len(a) and high < len(b) and a[end] == b[high]:
            end, high = end + 1, high + 1
        return at, end, low, high

    rng = np.random.default_rng(26)
    for _ in range(60):
        a = rng.integers(0, 50, 200).astype(np.uint64)
        b = np.concatenate([rng.integers(0, 50, 3).astype(np.uint64), a])
        b[rng.integers(0, 200, 4)] = 99
        at, size = rng.integers(0, 140, 20), rng.choice([22, 49], 20)
        low = np.clip(at + rng.integers(0, 6, 20), 0, 140)
        spans = at, at + size, low, low + size
        got = passages.extended(a, b, *spans)
        assert [tuple(map(int, x)) for x in zip(*got)] == [tuple(map(int, by_words(a, b, *x))) for x in zip(*spans)]


def test_tables_that_no_result_reads_are_removed(spark):
    passage = prose(60, random.Random(27))
    rows = [(k, f"{passage} {prose(20, random.Random(k))}") for k in range(3)]
    before = storage._stored.get(spark.sparkContext.applicationId, [])[:]
    got = passages.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"))
    left = [p for p in storage._stored[spark.sparkContext.applicationId] if p not in before]
    columns = [set(spark.read.parquet(p).columns) for p in left]
    assert not any({"keys", "words"} & c for c in columns)
    assert {(r.doc_id, r.removed) for r in got.collect()} == {(0, False), (1, True), (2, True)}


def test_roots_of_the_rounds_are_components_of_the_links(spark):
    # A chain under one key takes several rounds; a second key joins its end to another chain.
    members = [(1, k) for k in range(90, 0, -1)] + [(2, 1), (2, 300)] + [(3, 300 + k) for k in range(80)] + [(4, 900), (4, 901)]
    steps = {(k, k + 1) for k in range(1, 90)} | {(1, 300)} | {(300 + k, 301 + k) for k in range(79)}

    def verify(pairs):
        return spark.createDataFrame([tuple(r) for r in pairs.collect() if tuple(r) in steps], "a long, b long")

    links, roots = linking.linked(spark.createDataFrame(members, "key long, node long"), verify)
    got = {r.node: r.root for r in roots.collect()}
    assert got == {r.node: r.root for r in components.components(links).collect()}
    assert got == {k: 1 for k in [*range(1, 91), *range(300, 380)]}
    links, roots = linking.linked(spark.createDataFrame([], "key long, node long"), verify)
    assert links.count() == roots.count() == 0

"""The pipeline's stages on the smallest tables, and registered queries against SQL."""

from collections import Counter
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from territory_analytics.llm import decontaminate, queries, simhash
from territory_analytics.llm.common import table
from territory_analytics.storage import durable

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    docs, found = table(spark, DATA, "documents"), {}
    found["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, DATA))
        found[name] = docs
    return found


def test_stages_keep_the_columns_of_documents(stages):
    columns = stages["documents"].columns
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert stages[name].columns == columns and stages[name].count() > 0, name


def test_low_quality_goes_and_good_documents_stay(spark, stages):
    labels = {r.doc_id: r.quality for r in table(spark, DATA, "labels").collect()}
    kept = {r.doc_id for r in stages["quality_classifier"].collect()}
    good = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in good) >= 0.97 * len(good)


def test_no_two_documents_of_a_group_stay(stages):
    before = {r.doc_id: r.text for r in stages["quality_classifier"].collect()}
    after = {r.doc_id for r in stages["simhash_near_dedup"].collect()}
    prints = {d: simhash.fingerprint(simhash.shingle_hashes(t.encode(), 3)) for d, t in before.items()}

    def similar(a, b):
        return ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 2

    for a in after:
        assert not any(a < b and similar(a, b) for b in after)
    for gone in before.keys() - after:
        assert any(similar(gone, other) for other in before if other != gone)


def test_no_benchmark_window_is_left(spark, stages):
    left = decontaminate.contamination(stages["benchmark_decontamination"], table(spark, DATA, "benchmark"))
    assert left.where("contaminated").count() == 0
    before = {r.doc_id: r.text for r in stages["simhash_near_dedup"].collect()}
    for row in stages["benchmark_decontamination"].collect():
        assert row.text == before[row.doc_id] or len(row.text) < len(before[row.doc_id])


def test_all_mixed_documents_are_in_the_files(stages):
    mixed = Counter(r.doc_id for r in stages["mixing"].collect())
    assert Counter(r.doc_id for r in stages["token_planes"].collect()) == mixed
    assert max(mixed.values()) <= 3


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    want = con.execute(queries.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = queries.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == sorted(map(repr, want.fetchall()))

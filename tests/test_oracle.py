"""Registered queries against their SQL counterparts; ``ORACLE_ALL=1`` runs every one."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from territory_analytics.plans.oracle import ORACLE
from territory_analytics.plans.queries import QUERIES
from territory_analytics.plans.standin import TABLES

DATA = "/root/testdata/sf0.001"
SOME = (
    "keep_latest", "clean_certificates", "clean_sales", "enriched_fact", "price_quantiles",
    "quantiles_by_counting", "area_kpi", "area_profile", "flagship_opportunities", "rank_by_counting",
    "quality_counts_dirty", "serve_opportunities", "serve_opportunities_fallback",
    "label_distribution_topn", "filter_choices", "map_features", "compare_normalised",
    "geo_priority_union", "page_set_status", "union_by_name_scan", "tolerant_csv_scan",
    "partition_replace", "exact_sample", "daily_run", "stream_refresh",
    "map_opportunities", "map_layer_points", "dimension_tables", "arrondissement_names", "default_types",
    "failed_gate", "signals", "headline_kpis", "typed_grain",
    "clustered_market", "clustered_dwellings",
)
CHOSEN = sorted(QUERIES) if os.environ.get("ORACLE_ALL") else SOME

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows_as_sql(spark, sql, name):
    got = QUERIES[name](spark, DATA)
    want = sql.execute(ORACLE[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    expected = sorted(map(repr, want.fetchall()))
    assert sorted(repr(tuple(r)) for r in got.select(*columns).collect()) == expected


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry(spark):
    flagship = entry_points.entry(spark)
    assert flagship.count() > 0 and "score_opportunite" in flagship.columns

import math
import random
import struct

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from territory_analytics.operators import profiles, ranking
from territory_analytics.operators.quantiles import grouped_quantiles, largest_group
from territory_analytics.operators.ranking import rank_in_group

SHARES = {"q10": ("v", 0.1), "q25": ("v", 0.25), "q50": ("v", 0.5), "q90": ("v", 0.9), "w50": ("w", 0.5)}


def skewed(spark, n=3000):
    """A third of all rows in one group, a third of those one value, some groups tiny or empty."""
    random.seed(3)
    data = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else random.choice(["a", "b", "c", None])
        v = 42.0 if i % 9 == 0 else random.choice([random.lognormvariate(7, 2), -random.random(), 1e-7, 0.0])
        data.append((key, v, float(random.randint(0, 50)) if i % 5 else None))
    data += [("single", 7.5, None), ("pair", 1.0, 2.0), ("pair", 2.0, 3.0), ("blank", None, None)]
    return spark.createDataFrame(data, "k string, v double, w double"), data


def expected(data, column, p):
    index = {"v": 1, "w": 2}[column]
    groups = {}
    for row in data:
        groups.setdefault(row[0], []).append(row[index])
    out = {}
    for key, xs in groups.items():
        xs = [x for x in xs if x is not None]
        out[key] = float(np.quantile(xs, p)) if xs else None
    return out


@pytest.mark.parametrize("limit", [10**6, 50, 1])
def test_exact_quantiles_of_skewed_groups(spark, limit):
    df, data = skewed(spark)
    got = {r["k"]: r for r in grouped_quantiles(
        df, ["k"], SHARES, others=[F.count("*").alias("n")], limit=limit).collect()}
    assert sum(r["n"] for r in got.values()) == len(data)
    for name, (column, p) in SHARES.items():
        for key, value in expected(data, column, p).items():
            assert got[key][name] == (None if value is None else pytest.approx(value, rel=1e-12)), (key, name)


def test_both_plans_agree_to_the_last_bit(spark):
    df, _ = skewed(spark)
    plain = {r["k"]: tuple(r) for r in grouped_quantiles(df, ["k"], SHARES).collect()}
    counted = {r["k"]: tuple(r) for r in grouped_quantiles(df, ["k"], SHARES, limit=5).collect()}
    assert plain == counted


def test_both_plans_order_nan_infinities_zeros_and_subnormals_alike(spark):
    odd = [float("nan")] * 9 + [float("inf")] * 6 + [float("-inf")] * 4 + [0.0, -0.0, 5e-324, -5e-324, None]
    values = odd + [float(k) for k in range(-10, 10)] + [1e308, -1e308, 1e-300]
    random.seed(1)
    random.shuffle(values)
    rows = [("hot" if k % 3 else "b", v) for k, v in enumerate(values * 3)] + [("n", None), ("z", -0.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    wanted = {f"q{p}": ("v", p / 20) for p in range(21)}
    bits = []
    for limit in (10**6, 3):
        found = grouped_quantiles(df, ["k"], wanted, limit=limit).collect()
        bits.append({r["k"]: [None if x is None else struct.pack(">d", x) for x in r[1:]] for r in found})
    assert bits[0] == bits[1]
    top = {r["k"]: r["q20"] for r in grouped_quantiles(df, ["k"], wanted, limit=3).collect()}
    assert math.isnan(top["hot"]) and top["n"] is None and top["z"] == 0.0


def test_whole_table_without_keys(spark):
    df, data = skewed(spark)
    both = [grouped_quantiles(df, [], {"m": ("v", 0.5)}, limit=n).first()["m"] for n in (10**6, 10)]
    xs = [r[1] for r in data if r[1] is not None]
    assert both[0] == both[1] == pytest.approx(float(np.median(xs)))


def test_one_repeated_value_is_not_an_unbounded_slot(spark):
    df = spark.range(5000).select(F.lit("k").alias("k"), F.lit(3.25).alias("v"))
    assert grouped_quantiles(df, ["k"], {"m": ("v", 0.5)}, limit=10).first()["m"] == 3.25


def test_tightly_packed_values_with_outliers(spark):
    """Values that differ in the last digits only need several rounds of finer slots."""
    xs = [1000.0 + i * 1e-9 for i in range(2000)] + [1005.0, 995.0]
    df = spark.createDataFrame([("k", x) for x in xs], "k string, v double")
    got = grouped_quantiles(df, ["k"], {"m": ("v", 0.5), "t": ("v", 0.99)}, limit=20).first()
    assert got["m"] == pytest.approx(np.median(xs), rel=1e-15)
    assert got["t"] == pytest.approx(np.quantile(xs, 0.99), rel=1e-15)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.floats(-1e9, 1e9, allow_nan=False, width=32), min_size=1, max_size=60))
def test_any_values(spark, xs):
    df = spark.createDataFrame([(float(x),) for x in xs], "v double")
    got = grouped_quantiles(df, [], {"m": ("v", 0.3)}, limit=3).first()["m"]
    assert got == pytest.approx(float(np.quantile(xs, 0.3)), rel=1e-9, abs=1e-9)


def test_group_bound(spark):
    df, _ = skewed(spark)
    assert largest_group(df, ["k"]) == 1000
    assert largest_group(df, []) == df.count()
    assert largest_group(df.limit(0), ["k"]) == 0


@pytest.mark.parametrize("limit", [10**6, 20])
def test_rank_shares_ties_and_puts_null_last(spark, limit):
    df, data = skewed(spark, 600)
    ranked = rank_in_group(df, ["k"], "v", "r", limit=limit).collect()
    assert len(ranked) == len(data)
    for row in ranked:
        peers = [d[1] for d in data if d[0] == row["k"]]
        if row["v"] is None:
            above = sum(p is not None for p in peers)
        else:
            above = sum(p is not None and p > row["v"] for p in peers)
        assert row["r"] == above + 1


@pytest.mark.parametrize("limit", [10**6, 20])
def test_parent_position_laws(spark, limit):
    df, data = skewed(spark, 600)
    placed = profiles.parent_position(df, ["k"], "v", "gap", "z", median="mid", limit=limit)
    assert placed.count() == len(data)
    by_key = placed.groupBy("k").agg(F.avg("z").alias("z"), F.first("mid").alias("mid")).collect()
    medians = expected(data, "v", 0.5)
    for row in by_key:
        if row["k"] in ("single", "blank"):
            assert row["z"] is None
        else:
            assert abs(row["z"]) < 0.01
        assert row["mid"] == (None if medians[row["k"]] is None else pytest.approx(medians[row["k"]]))


def test_position_flag_and_score_are_the_same_for_any_limit(spark):
    df, _ = skewed(spark, 600)
    homes = df.withColumns({"type_bien": F.lit("maison"), "nb_dpe": F.lit(40), "pct_passoires": F.lit(12.5)})
    profile = homes.withColumnRenamed("k", "departement").withColumnRenamed("v", "prix_m2_median")
    results = []
    for limit in (10**6, 100, 20):
        placed = profiles.parent_position(
            profile, ["departement", "type_bien"], "prix_m2_median", "gap", "z", limit=limit
        )
        flag = profiles.underpriced(F.col("z"), 1.0)
        score = profiles.opportunity_score(F.col("z"), F.col("pct_passoires"))
        results.append(sorted(map(repr, placed.select("*", flag.alias("f"), score.alias("s")).collect())))
    assert results[0] == results[1] == results[2]


def test_only_oversized_groups_are_ranked_by_counting(spark, monkeypatch):
    df, _ = skewed(spark, 600)
    seen = []
    counted = ranking._value_ranks
    monkeypatch.setattr(ranking, "_value_ranks", lambda hot, *a: seen.append(hot.count()) or counted(hot, *a))
    split = sorted(map(repr, rank_in_group(df, ["k"], "v", "r", limit=150).collect()))
    assert seen == [200]
    assert split == sorted(map(repr, rank_in_group(df, ["k"], "v", "r").collect()))


def test_two_scans_find_the_quantile_of_any_distribution(spark, monkeypatch):
    """A hot group over all magnitudes, one packed into a hair's breadth, one with a value that fills half of it."""
    from territory_analytics.operators import quantiles

    n = 60_000
    x = F.rand(3)
    df = spark.range(n).select(
        F.element_at(F.array(F.lit("wide"), F.lit("packed"), F.lit("heavy")), (F.col("id") % 3 + 1).cast("int")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.exp(x * 600 - 300))
        .when(F.col("id") % 3 == 1, 1 + x * 1e-12)
        .otherwise(F.when(F.col("id") % 2 == 0, 7.25).otherwise(x * 20)).alias("v"),
    )
    df = quantiles.durable(df)
    wanted = {f"q{k}": ("v", p) for k, p in enumerate((0.0, 0.1, 0.5, 0.77, 1.0))}
    scans = []
    plain = quantiles._placed_in
    monkeypatch.setattr(quantiles, "_placed_in", lambda rows, keys, b: scans.append(1) or plain(rows, keys, b))
    counted = sorted(map(tuple, grouped_quantiles(df, ["k"], wanted, limit=15_000).collect()))
    assert counted == sorted(map(tuple, grouped_quantiles(df, ["k"], wanted, limit=10**6).collect()))
    assert scans == [1]


def test_a_sketch_that_errs_is_made_up_for(spark, monkeypatch):
    from territory_analytics.operators import quantiles

    df = spark.range(5_000).select(F.lit("a").alias("k"), (F.col("id") * 7 % 5_000).cast("double").alias("v"))
    plain = quantiles._brackets

    def wrong(rows, keys, asked, reach):
        found = plain(rows, keys, asked, reach)
        return found.withColumn("_low", F.col("_high")) if reach < 0.01 else found

    monkeypatch.setattr(quantiles, "_brackets", wrong)
    got = grouped_quantiles(df, ["k"], {"m": ("v", 0.5), "h": ("v", 0.9)}, limit=1_000).first()
    assert (got["m"], got["h"]) == (2499.5, 4499.1)


@pytest.mark.parametrize("limit", [2, 100])
def test_ranks_with_names_the_operator_uses_itself(spark, limit):
    data = [("a", v, str(v)) for v in (5.0, 3.0, 3.0, None)] + [("b", 1.0, "x")]
    df = spark.createDataFrame(data, "n string, File double, above string")
    got = {(r["n"], r["File"]): r["top"] for r in rank_in_group(df, ["n"], "File", "top", limit=limit).collect()}
    assert got == {("a", 5.0): 1, ("a", 3.0): 2, ("a", None): 4, ("b", 1.0): 1}


def test_parent_statistics_leave_columns_of_their_own_names_alone(spark):
    df = spark.createDataFrame([("p", 1.0, 7, 8, 9), ("p", 3.0, 7, 8, 9)], "k string, v double, _mean int, _spread int, _median int")
    got = sorted(profiles.parent_position(df, ["k"], "v", "gap", "z").collect(), key=lambda r: r["v"])
    assert [tuple(r[c] for c in ("_mean", "_spread", "_median", "gap", "z")) for r in got] == [(7, 8, 9, -50.0, -1.0), (7, 8, 9, 50.0, 1.0)]

"""Order, quantile and join operators against brute force, on small fixtures with a hot group."""

from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from newsmill.operators import aggregates as agg
from newsmill.operators import joins, ordering
from newsmill.operators.quantiles import exact_quantiles, medians, value_range
from newsmill.session import broadcast_if_small

PROBS = {"low": 0.0, "q1": 0.25, "median": 0.5, "p90": 0.9, "high": 1.0}


def skewed(spark, n=900):
    """A third of all rows in one group."""
    rows = [(i, "hot" if i % 3 == 0 else f"g{i % 7}", float((i * 7919) % 101) - 50) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, g string, v double")


def test_quantiles_of_a_hot_group(spark):
    rows, df = skewed(spark)
    found = {r["g"]: r for r in exact_quantiles(df, ["v"], PROBS, ["g"]).collect()}
    for g in {r[1] for r in rows}:
        values = [r[2] for r in rows if r[1] == g]
        assert found[g]["n"] == len(values)
        for name, p in PROBS.items():
            assert found[g][name] == pytest.approx(np.quantile(values, p))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e12, 1e12), st.sampled_from([0.0, -0.0, 1e-9, 5.0])), min_size=1, max_size=60))
def test_quantiles_of_any_numbers(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = [v for v in values if v is not None]
    found = exact_quantiles(df, ["v"], PROBS).collect()
    if not known:
        assert found == []
        return
    for name, p in PROBS.items():
        assert found[0][name] == pytest.approx(np.quantile(known, p), rel=1e-9, abs=1e-12)


def test_quantiles_beyond_the_broadcast_bound(spark, monkeypatch):
    from newsmill.operators import quantiles

    rows, df = skewed(spark)
    monkeypatch.setattr(quantiles, "BROADCAST_BYTES", 0)
    found = {r["g"]: r["median"] for r in quantiles.exact_quantiles(df, ["v"], {"median": 0.5}, ["g"]).collect()}
    assert found["hot"] == np.median([r[2] for r in rows if r[1] == "hot"])


def test_value_ranges_rise_with_the_value(spark):
    values = sorted([-1e18, -3.5, -1.0, -1e-3, 0.0, 1e-3, 0.5, 1.0, 1.0000001, 1e6, 1e6 + 1, 1e18])
    df = spark.createDataFrame([(v,) for v in values], "v double")
    ranges = [r[0] for r in df.orderBy("v").select(value_range(F.col("v"))).collect()]
    assert ranges == sorted(ranges)


def test_null_groups_and_null_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, 5.0), ("b", None)], "g string, v double")
    assert [(r["g"], r["n"], r["q"]) for r in exact_quantiles(df, ["v"], {"q": 0.5}, ["g"]).collect()] == [("a", 1, 1.0)]
    assert medians(df, ["v"]).first()[0] == 3.0


def test_position_over_many_ranges(spark):
    ids = [i * i * 3 + 1 for i in range(500)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)], "id long")
    found = {r["id"]: r["position"] for r in ordering.position(df, "id", ranges=37).collect()}
    assert found == {v: i for i, v in enumerate(ids)}
    kept = sorted(r[0] for r in ordering.every_kth(df, "id", 7, ranges=37).collect())
    assert kept == ids[::7]
    with pytest.raises(ValueError):
        ordering.every_kth(df, "id", 0)


def test_group_position_and_prefix_sum(spark):
    rows, df = skewed(spark)
    found = ordering.group_position(df, ["g"], "id", width=50).collect()
    by_group: dict = {}
    for r in sorted(rows):
        by_group.setdefault(r[1], []).append(r[0])
    assert {r["id"]: r["position"] for r in found} == {i: p for ids in by_group.values() for p, i in enumerate(ids)}
    summed = ordering.prefix_sum(df, ["g"], F.floor(F.col("id") / 50), [F.col("id")], F.col("v"), "before").collect()
    for r in summed:
        assert r["before"] == sum(x[2] for x in rows if x[1] == r["g"] and x[0] < r["id"])


def test_keep_first_takes_ties_by_the_last_key(spark):
    df = spark.createDataFrame([(3, "a", 5), (1, "a", 5), (2, "a", 4), (9, "b", 1)], "id int, g string, v int")
    kept = ordering.keep_first(df, [F.col("g")], [F.desc("v"), F.col("id")], 2).collect()
    assert sorted(r["id"] for r in kept) == [1, 3, 9]


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("how", ["inner", "left", "right", "outer"])
def test_joins_with_hot_and_null_keys(spark, how, hot, monkeypatch):
    if hot:
        monkeypatch.setattr(joins, "HOT_ROWS", 0)
        monkeypatch.setattr(joins, "HOT_SAMPLE", 1.0)
    left = [(None, "x"), (1, "a"), (1, "b"), (1, "c"), (2, "d"), (9, "e")]
    right = [(None, "y"), (1, "p"), (1, "q"), (3, "r")]
    a = spark.createDataFrame(left, "record_id int, name string")
    b = spark.createDataFrame([(None if k is None else str(k), v) for k, v in right], "record_id string, name string")
    expected = [(k, x, y) for k, x in left for j, y in right if k is not None and k == j]
    if how in ("left", "outer"):
        expected += [(2, "d", None), (9, "e", None)]
    if how in ("right", "outer"):
        expected += [(3, None, "r")]
    found = [(r["record_id"], r["name_mysql"], r["name_mongo"]) for r in joins.merge(a, b, how=how).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)
    counts = {r["join_type"]: r["row_count"] for r in joins.join_counts(a, b).collect()}
    assert counts[how] == len(expected)


def test_join_counts_of_nothing(spark):
    none = spark.createDataFrame([], "record_id int")
    assert {r["row_count"] for r in joins.join_counts(none, none).collect()} == {0}


def test_group_means_with_and_without_broadcast(spark, monkeypatch):
    rows, df = skewed(spark)
    rows = [*rows, (9999, None, 3.0)]
    df = spark.createDataFrame(rows, "id long, g string, v double")

    def check():
        out = joins.with_group_means(df, "g", ["v"])
        for r in out.collect():
            values = [x[2] for x in rows if x[1] == r["g"]]
            assert (r["category_avg_v"] is None) if r["g"] is None else r["category_avg_v"] == pytest.approx(np.mean(values))
        assert out.count() == len(rows)

    check()
    monkeypatch.setattr(joins, "broadcast_if_small", lambda d: broadcast_if_small(d, 2))
    check()


def test_large_groups(spark):
    rows, df = skewed(spark)
    assert {r[0] for r in joins.large_groups(df, "g", 200).select("g").distinct().collect()} == {"hot"}


def test_field_upsert_keeps_what_is_not_given(spark):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "filename string, width int, exif string")
    new = spark.createDataFrame([("a", None, ["width"]), ("c", 3, ["width"])], "filename string, width int, given array<string>")
    found = sorted(tuple(r) for r in joins.merge_fields(old, new, "filename", "given").collect())
    assert found == [("a", None, "x"), ("b", 2, "y"), ("c", 3, None)]
    plain = sorted(tuple(r) for r in joins.merge_fields(old, new.drop("given"), "filename").collect())
    assert plain == found


def test_upsert_last_row_wins(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "c", 1), (2, "d", 2), (3, "e", 1)], "k int, v string, seq int")
    assert sorted((r["k"], r["v"]) for r in joins.upsert(old, new, "k", ["seq"]).collect()) == [(1, "a"), (2, "d"), (3, "e")]


def test_overlap_of_nothing(spark):
    none = spark.createDataFrame([], "record_id int")
    some = spark.createDataFrame([(1,), (1,), (2,)], "record_id int")
    assert tuple(joins.overlap(none, some, "record_id", "record_id").first()) == (0, 0.0, 0, 2)


def test_histogram_edges(spark):
    flat = spark.createDataFrame([(2.0,), (2.0,), (None,)], "v double")
    assert [(r["bin"], r["count"]) for r in agg.histogram(flat, "v", 10).collect()] == [(0, 2)]
    df = spark.createDataFrame([(float(i),) for i in range(11)], "v double")
    counts = {r["bin"]: r["count"] for r in agg.histogram(df, "v", 10).collect()}
    assert counts == {**{i: 1 for i in range(9)}, 9: 2}


def test_scaling_of_a_constant(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    assert [r["scaled"] for r in agg.scaled(df, "v").collect()] == [0.0, 0.0]


def test_correlation_uses_complete_pairs(spark):
    rows = [(1.0, 2.0, None), (2.0, None, 1.0), (3.0, 5.0, None), (4.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    found = {(r["column_a"], r["column_b"]): r["corr"] for r in agg.correlations(df, ["a", "b", "c"]).collect()}
    assert ("a", "c") not in found
    assert found["a", "b"] == pytest.approx(np.corrcoef([1, 3, 4], [2, 5, 7])[0, 1])


def test_distinct_counts_by_estimate(spark):
    _, df = skewed(spark)
    exact = {r["column"]: r["nunique"] for r in agg.distinct_counts(df).collect()}
    near = {r["column"]: r["nunique"] for r in agg.distinct_counts(df, relative_error=0.02).collect()}
    assert exact["id"] == 900 and abs(near["id"] - 900) < 90 and near["g"] == exact["g"] == 8


def test_long_values_are_counted_without_moving_them(spark, monkeypatch):
    from newsmill.operators import aggregates

    long = "x" * 40
    values = ["b"] * 5 + ["a"] * 5 + [None] * 4 + [long + "2"] * 3 + [long + "1"] * 3 + [long + "3"] * 3 + ["", "", "z"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v string, i long")
    counts = Counter(values)
    want = sorted(counts, key=lambda v: (-counts[v], v is None, v or ""))
    for top in (1, 2, 3, 4, 5, 20):
        got = {r["rank"]: (r.value, r["count"], r.nunique) for r in aggregates.value_counts(df, ["v"], top).collect()}
        assert got == {k + 1: (v, counts[v], len(counts) - 1) for k, v in enumerate(want[:top])}
    (row,) = aggregates.describe_all(df, ["v"]).collect()
    assert (row["count"], row.unique, row.top, row.freq) == (len(values) - 4, len(counts) - 1, "a", 5)
    plan = aggregates._value_groups(aggregates._told_apart(df, ["v"]))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan and all("value#" not in line for line in plan.split("\n") if "Exchange" in line)
    assert aggregates.value_counts(df.limit(0), ["v"]).count() == 0

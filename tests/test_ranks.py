import random

import numpy as np
import pytest
from compare import rows
from pyspark.sql import functions as F

from txnlens.operators import ranks
from txnlens.operators.ranks import running_totals


def test_running_totals_equal_a_plain_sum(spark):
    random.seed(1)
    data = [(random.choice("ab") if i % 9 else None, i, random.randint(-5, 5)) for i in range(500)]
    random.shuffle(data)
    df = spark.createDataFrame(data, "g STRING, k INT, v INT").repartition(7)
    found = ranks.running_totals(df, ["k"], {"run": "v"}, ["g"], with_totals=True)
    sums, want = {}, []
    for g, k, v in sorted(data, key=lambda r: r[1]):
        sums[g] = sums.get(g, 0) + v
        want.append((g, k, v, sums[g]))
    assert [tuple(r)[:4] for r in found.orderBy("k").collect()] == want
    assert {(r["g"], r["run_total"]) for r in found.collect()} == set(sums.items())


def test_running_totals_split_a_hot_group(spark):
    """One group holds most rows; its rows are cut into several slices all the same."""
    df = spark.range(20_000).selectExpr("if(id % 10 = 0, 'cold', 'hot') AS g", "id AS k", "1 AS v")
    found = ranks.running_totals(df, ["k"], {"run": "v"}, ["g"])
    last = {r["g"]: r["n"] for r in found.groupBy("g").agg({"run": "max"}).toDF("g", "n").collect()}
    assert last == {"cold": 2_000, "hot": 18_000}


@pytest.fixture
def every_slice(spark):
    """Small slices are not put together."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


def test_equal_rows_are_cut_into_slices_too(spark, monkeypatch, every_slice):
    """A third of all rows is one and the same row, as when a producer is stuck."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 7, id) AS k", "1 AS v").repartition(6)
    cut = []
    sliced = ranks.sliced
    monkeypatch.setattr(ranks, "sliced", lambda d, keys: cut.append(sliced(d, keys)) or cut[-1])
    found = ranks.running_totals(df, ["k"], {"run": "v"})
    sizes = [r["count"] for r in cut[-1].groupBy("_slice").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000
    assert [r.run for r in found.orderBy("run").collect()] == list(range(1, 30_001))
    assert found.where("k < 7").agg({"run": "max"}).first()[0] == 4


def test_slices_follow_keys_of_any_kind(spark, every_slice):
    rows_ = [(None if i % 11 == 0 else f"g{i % 3}", None if i % 7 == 0 else float(i % 50), i) for i in range(600)]
    df = spark.createDataFrame(rows_, "g STRING, k DOUBLE, _tie LONG").repartition(3)
    cut = ranks.sliced(df, ["g", "k", "_tie"])
    order = [r["_slice"] for r in cut.orderBy("g", "k", "_tie").collect()]
    assert order == sorted(order) and len(set(order)) == 4
    empty = ranks.sliced(df.limit(0), ["g", "k", "_tie"])
    assert empty.columns[-1] == "_slice" and empty.collect() == []


def test_dense_ids_follow_value_order(spark):
    values = [("x", None)] + [("x", f"v{i:03d}") for i in range(300)] + [("y", "b"), ("y", "a")]
    df = spark.createDataFrame(values, "d STRING, value STRING").repartition(5)
    found = rows(ranks.dense_ids(df, ["d"], "value", "id"))
    assert set(found) == {("x", None, 0), *(("x", f"v{i:03d}", i + 1) for i in range(300)), ("y", "a", 0), ("y", "b", 1)}


def test_quantiles_equal_brute_force(spark):
    random.seed(2)
    data = {g: [round(random.gauss(50, 20), 2) for _ in range(n)] for g, n in (("a", 801), ("b", 2), (None, 7))}
    data["a"] += [42.0] * 400
    df = spark.createDataFrame(
        [(g, v) for g, vs in data.items() for v in vs] + [("a", None)], "g STRING, v DOUBLE"
    )
    cuts = {"q1": 0.25, "q2": 0.5, "q9": 0.9}
    mixed = {r["g"]: r for r in ranks.quantiles(df, ["g"], "v", cuts).collect()}
    lower = {r["g"]: r for r in ranks.quantiles(df, ["g"], "v", cuts, interpolate=False).collect()}
    for g, values in data.items():
        assert mixed[g]["n"] == len(values)
        assert (mixed[g]["lowest"], mixed[g]["highest"]) == (min(values), max(values))
        for name, f in cuts.items():
            assert abs(mixed[g][name] - np.quantile(values, f)) < 1e-9
            assert lower[g][name] == np.quantile(values, f, method="inverted_cdf")


def test_thousands_of_slices_plan_in_seconds(spark):
    import time

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        start = time.perf_counter()
        df = spark.range(20_000).select((F.col("id") * 7 % 20_000).alias("k"), F.lit(1).alias("v"))
        found = running_totals(df, ["k"], {"upto": "v"})
        assert found.where("upto <> k + 1").isEmpty()
        assert time.perf_counter() - start < 60
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.llm.vantage import VantageTree, nearest_neighbours, op2_vantage_search

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float((a * b).sum() / math.sqrt((a * a).sum()) / math.sqrt((b * b).sum()))


def good(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, k, step):
    kept = [(i, [np.float32(x) for x in v]) for i, v, *_ in rows if i is not None and good(v)]
    out = {}
    for i, v in kept:
        if i % step == 0:
            near = sorted(((-cosine(v, w), j) for j, w in kept if j != i and len(w) == len(v)))[:k]
            out.setdefault(i, []).append([(n + 1, j, -s) for n, (s, j) in enumerate(near)])
    return out


def frame(spark, rows, parts=3):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0) for i, v in rows], SCHEMA)
    return df.repartition(parts) if rows else df


def same(got, want):
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == {q for q, lists in want.items() if lists[0]}
    for q, rows in by.items():
        expected = sorted(x for lists in want[q] for x in lists)
        assert [x[:2] for x in sorted(rows)] == [x[:2] for x in expected]
        assert np.allclose([x[2] for x in sorted(rows)], [x[2] for x in expected], atol=1e-12)


def test_exact_search_agrees_with_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(700)]
    rows += [(1000 + i, [1.0, 2.0, 0.5, 0.0, -1.0, 3.0]) for i in range(120)]  # many equal vectors
    rows += [(2000 + i, rng.normal(size=3).tolist()) for i in range(60)]  # another length
    rows += [(2100, None), (2150, []), (2200, [0.0] * 6), (2250, [1.0, None, 0, 0, 0, 0]), (2300, [float("nan")] * 6), (2350, [float("inf")] + [1.0] * 5)]
    rows += [(None, [1.0] * 6), (2400, [1.0, 2.0, 3.0, 4.0])]  # the only one of its length
    found = nearest_neighbours(frame(spark, rows).withColumn("_row", F.lit(0)), F.col("vec_id") % 50 == 0, relax=1.0, shard_rows=150, block_queries=7)
    same(found.collect(), brute(rows, 5, 50))


def test_few_candidates_and_repeated_ids(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (7, [1.0, 1.0])]
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in nearest_neighbours(frame(spark, rows), F.col("vec_id") % 50 == 0).collect())
    assert got == [(50, 1, 7), (50, 1, 7)]
    assert nearest_neighbours(frame(spark, []), F.col("vec_id") % 50 == 0).collect() == []


def test_factor_one_is_exact_and_larger_factors_visit_less():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 8))
    vectors = centres[rng.integers(30, size=6000)] + 0.05 * rng.normal(size=(6000, 8))
    tree, queries = VantageTree(np.arange(6000), vectors), vectors[::100]
    taken, recall = [], []
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    for relax in (1.0, 2.0, 8.0):
        best, rows, n = tree.search(np.arange(0, 6000, 100), queries, 5, relax)
        hits = 0
        for q, got in zip(range(0, 6000, 100), rows):
            scores = unit @ unit[q]
            scores[q] = -2
            hits += len(set(tree.ids[got]) & set(np.argsort(-scores)[:5]))
        taken.append(n)
        recall.append(hits / (5 * len(queries)))
    assert recall[0] == 1.0 and taken[0] < 0.6 * 60 * 6000
    assert taken[0] > taken[1] > taken[2] and recall[1] > 0.6


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_the_whole_table(spark, sf):
    folder = f"/root/testdata/{sf}"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want = brute(rows, 5, 50)
    got = op2_vantage_search(spark, folder).collect()
    found = {(r.query_id, r.vec_id) for r in got}
    hits = sum((q, j) in found for q, lists in want.items() for _, j, _ in lists[0])
    assert len(got) == 5 * len(want) and hits / (5 * len(want)) >= 0.9


def test_blocks_of_queries_go_out_in_passes_of_bounded_size(spark, monkeypatch):
    from txnlens.llm import vantage

    blocks = [(0, 40), (1, 60), (2, 10), (3, 200), (4, 5)]
    assert list(vantage._passes(blocks, 100)) == [[0, 1], [2], [3], [4]]
    assert list(vantage._passes([], 100)) == []
    rng = np.random.default_rng(12)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    asks = F.col("vec_id") % 3 == 0

    def found():
        got = vantage.nearest_neighbours(df, asks, shard_rows=70, block_queries=20, relax=1.0)
        return sorted(tuple(r) for r in got.collect())

    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    once = found()
    monkeypatch.setattr(vantage, "_passes", lambda blocks: [[b] for b, _ in blocks])
    assert found() == once and len(once) == 500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before

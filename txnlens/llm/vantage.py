"""Approximate nearest neighbours by cosine with a vantage-point tree per shard.

Vectors are dealt to shards by a hash of their id, so that many copies of one vector spread; each shard
has a bounded number of rows and gets a tree. On unit vectors the largest cosine is the smallest
Euclidean distance, a metric. A node holds a vantage point and the range of its distances to either
half. A half is skipped if the triangle inequality puts all of it, times ``RELAX``, beyond the nearest
found so far. A factor of one skips nothing that could count: the search is exact. Larger factors
skip more and may lose neighbours.

Queries are packed into blocks of a bounded number, which are written once and sent to the shards in passes of
``SENT_BYTES``; all queries of a block go down a tree together. The best of each shard meet in a window per
query that keeps only the first few of each task. Scores are taken on the original vectors in double
precision, row by row, so that equal vectors have equal scores.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do null
ids. Vectors are only compared with those of their length. Rows that repeat an id are candidates
and queries of their own, but never each other's candidates. With fewer candidates than asked, all are
returned. An empty table gives an empty result; columns other than ``vec_id`` and ``embedding`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import table, written

NEAREST = 5
QUERY_STEP = 50
RELAX = 1.1
SHARD_ROWS = 4096
BLOCK_QUERIES = 512
#: Query vectors that go to the tasks at a time.
SENT_BYTES = 32 << 20
LEAF = 128
#: Distances closer than this are not told apart when pruning.
SLACK = 1e-7


class VantageTree:
    """A tree over the rows of a matrix; arrays only, so that it can be stored."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nodes: np.ndarray | None = None, ranges: np.ndarray | None = None):
        if nodes is None:
            order = np.argsort(ids, kind="stable")
            ids, vectors = ids[order], vectors[order]
        self.ids, self.vectors = ids, vectors
        self.norms = np.sqrt((vectors * vectors).sum(axis=1))
        if nodes is None:
            self._found: list[tuple[int, int, int, int]] = []
            self._bounds: list[tuple[float, float, float, float]] = []
            self._order = np.arange(len(ids))
            self._split(0, len(ids))
            nodes = np.array(self._found, dtype=np.int64).reshape(-1, 4)
            ranges = np.array(self._bounds, dtype=np.float64).reshape(-1, 4)
            self.ids, self.vectors, self.norms = ids[self._order], vectors[self._order], self.norms[self._order]
        self.nodes, self.ranges = nodes, ranges

    def _split(self, start: int, end: int) -> int:
        """Order the rows from ``start`` to ``end``; a node is (start, end, inner node, outer node)."""
        number = len(self._found)
        self._found.append((start, end, -1, -1))
        self._bounds.append((0.0, 0.0, 0.0, 0.0))
        if end - start <= LEAF:
            return number
        # The vantage point is the row farthest from the first one.
        part = self._order[start:end]
        first = self._distances(part[0], part)
        at = int(np.argmax(first))
        part[0], part[at] = part[at], part[0]
        rest = part[1:]
        far = self._distances(part[0], rest)
        by = np.argsort(far, kind="stable")
        self._order[start + 1 : end] = rest[by]
        far = far[by]
        half = len(far) // 2
        inner = self._split(start + 1, start + 1 + half)
        outer = self._split(start + 1 + half, end)
        self._found[number] = (start, end, inner, outer)
        self._bounds[number] = (far[0], far[half - 1], far[half], far[-1])
        return number

    def _distances(self, row: int, rows: np.ndarray) -> np.ndarray:
        cosine = self.vectors[rows] @ self.vectors[row] / (self.norms[rows] * self.norms[row])
        return np.sqrt(np.maximum(2 - 2 * cosine, 0))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, nearest: int, relax: float) -> tuple[np.ndarray, np.ndarray, int]:
        """Scores and rows (-inf and -1 where there are fewer) of each query's nearest, best first; scores taken."""
        self._queries, self._query_ids = queries, query_ids
        self._query_norms = np.sqrt((queries * queries).sum(axis=1))
        self._best = np.full((len(queries), nearest), -np.inf)
        self._rows = np.full((len(queries), nearest), -1, dtype=np.int64)
        self._relax, self._taken = relax, 0
        if len(self.nodes):
            self._visit(0, np.arange(len(queries)))
        return self._best, self._rows, self._taken

    def _scores(self, active: np.ndarray, start: int, end: int) -> np.ndarray:
        """Scores to within rounding."""
        self._taken += len(active) * (end - start)
        dots = self._queries[active] @ self.vectors[start:end].T
        return dots / (self._query_norms[active, None] * self.norms[None, start:end])

    def _offer(self, active: np.ndarray, start: int, scores: np.ndarray) -> None:
        own = self.ids[None, start : start + scores.shape[1]] == self._query_ids[active, None]
        better = (scores >= self._best[active, -1:] - SLACK) & ~own
        some = np.flatnonzero(better.any(axis=1))
        if not len(some):
            return
        better, active = better[some], active[some]
        # Those that may count are scored again, in a way that gives equal vectors equal scores.
        at, place = np.nonzero(better)
        left, right = self._queries[active[at]], self.vectors[start + place]
        exact = np.full(better.shape, -np.inf)
        exact[at, place] = (left * right).sum(axis=1) / (self._query_norms[active[at]] * self.norms[start + place])
        value = np.concatenate([self._best[active], exact], axis=1)
        row = np.concatenate([self._rows[active], np.where(better, start + np.arange(scores.shape[1]), -1)], axis=1)
        last = np.iinfo(np.int64).max
        keep = np.lexsort((np.where(row < 0, last, self.ids[row]), -value), axis=-1)[:, : self._best.shape[1]]
        self._best[active] = np.take_along_axis(value, keep, axis=1)
        self._rows[active] = np.take_along_axis(row, keep, axis=1)

    def _visit(self, number: int, active: np.ndarray) -> None:
        start, end, inner, outer = self.nodes[number]
        if inner < 0:
            self._offer(active, start, self._scores(active, start, end))
            return
        scores = self._scores(active, start, start + 1)
        self._offer(active, start, scores)
        far = np.sqrt(np.maximum(2 - 2 * scores[:, 0], 0))
        low_in, high_in, low_out, high_out = self.ranges[number]
        at_least_in = np.maximum(np.maximum(far - high_in, low_in - far), 0)
        at_least_out = np.maximum(np.maximum(low_out - far, far - high_out), 0)
        near_in = at_least_in <= at_least_out
        # Each query first goes to the half that can be nearer.
        for first in (True, False):
            for child, bound, here in ((inner, at_least_in, near_in), (outer, at_least_out, ~near_in)):
                going = here if first else ~here
                best = self._best[active, -1]
                reach = np.where(best > -np.inf, np.sqrt(np.maximum(2 - 2 * best, 0)), np.inf)
                going = going & (bound * self._relax <= reach + SLACK)
                if going.any():
                    self._visit(child, active[going])


def usable(column: str) -> Column:
    """Whether a vector takes part."""
    whole = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(whole & F.exists(column, lambda x: x != 0), F.lit(False))


def _built(rows: pa.Table) -> pa.Table:
    ids = rows.column("vec_id").to_numpy()
    vectors = _matrix(rows.column("_vector"), len(ids))
    tree = VantageTree(ids, vectors)
    parts = [tree.ids, tree.vectors, tree.nodes, tree.ranges]
    head = {"dimension": [vectors.shape[1]], "shard": [rows.column("shard")[0].as_py()]}
    types = [("dimension", pa.int32()), ("shard", pa.int32())] + [(n, pa.binary()) for n in ("ids", "vectors", "nodes", "ranges")]
    data = {**head, **{n: [p.tobytes()] for n, p in zip(("ids", "vectors", "nodes", "ranges"), parts)}}
    return pa.table(data, schema=pa.schema(types))


INDEX = "dimension int, shard int, ids binary, vectors binary, nodes binary, ranges binary"


def _matrix(lists: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = lists.combine_chunks()
    flat = flat.flatten() if isinstance(flat, pa.ListArray) else pa.concat_arrays([c.flatten() for c in flat.chunks])
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _packed(rows: pa.Table) -> pa.Table:
    ids = rows.column("vec_id").to_numpy()
    vectors = _matrix(rows.column("_vector"), len(ids))
    places = rows.column("_row").to_numpy()
    data = {
        "dimension": pa.array([vectors.shape[1]], pa.int32()),
        "block": pa.array([rows.column("_block")[0].as_py()], pa.int64()),
        "query_ids": [ids.tobytes()], "query_rows": [places.tobytes()], "queries": [vectors.tobytes()],
    }
    return pa.table(data)


def _searched(shared, nearest: int, relax: float):
    """Each shard with all blocks of queries of its dimension that were sent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell in batch.to_pylist():
                d = cell["dimension"]
                ids = np.frombuffer(cell["ids"], np.int64)
                tree = VantageTree(
                    ids,
                    np.frombuffer(cell["vectors"]).reshape(-1, d),
                    np.frombuffer(cell["nodes"], np.int64).reshape(-1, 4),
                    np.frombuffer(cell["ranges"]).reshape(-1, 4),
                )
                for dimension, query_ids, rows, vectors in shared.value:
                    if dimension != d:
                        continue
                    query_ids, rows = np.frombuffer(query_ids, np.int64), np.frombuffer(rows, np.int64)
                    best, found, _ = tree.search(query_ids, np.frombuffer(vectors).reshape(-1, d), nearest, relax)
                    query, place = np.nonzero(found >= 0)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x) for x in (rows[query], query_ids[query], ids[found[query, place]], best[query, place])],
                        names=["_row", "query_id", "vec_id", "score"],
                    )

    return run


def _passes(blocks: list[tuple[int, int]], limit: int = SENT_BYTES) -> Iterator[list[int]]:
    """Runs of blocks of at most ``limit`` bytes together; a larger block is a run of its own."""
    run, size = [], 0
    for block, own in blocks:
        if run and size + own > limit:
            yield run
            run, size = [], 0
        run.append(block)
        size += own
    if run:
        yield run


HITS = "_row bigint, query_id bigint, vec_id bigint, score double"


def build_index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard with its tree, written out."""
    shards = max(1, -(-vectors.count() // shard_rows))
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "_row"), F.lit(shards)).cast("int"))
    return written(dealt.groupBy("dimension", "shard").applyInArrow(_built, INDEX), "vantage-index")


def nearest_neighbours(
    embeddings: DataFrame, queries: Column, nearest: int = NEAREST, relax: float = RELAX,
    shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the nearest rows found for those that ``queries`` picks."""
    spark = embeddings.sparkSession
    rows = embeddings.where(F.col("vec_id").isNotNull() & usable("embedding")).select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.col("embedding").cast("array<double>").alias("_vector"),
        F.size("embedding").alias("dimension"),
        queries.alias("_asks"),
    )
    vectors = written(rows, "vectors")
    index = build_index(vectors.drop("_asks"), shard_rows)
    asking = vectors.where("_asks").drop("_asks")
    blocks = max(1, -(-asking.count() // block_queries))
    dealt = asking.withColumn("_block", F.pmod(F.xxhash64("_row"), F.lit(blocks)))
    schema = "dimension int, block bigint, query_ids binary, query_rows binary, queries binary"
    packed = written(dealt.groupBy("dimension", "_block").applyInArrow(_packed, schema), "query-blocks")
    # Blocks are sent to the shards a bounded number of bytes at a time; no shard or block is written again for it.
    sizes = packed.groupBy("block").agg(F.sum(F.length("queries")).alias("bytes")).orderBy("block").collect()
    hits = []
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(batch)
    spark.conf.set(batch, "2")
    try:
        for chosen in _passes([(r["block"], r["bytes"]) for r in sizes]):
            own = packed.where(F.col("block").between(chosen[0], chosen[-1]))
            sent = own.select("dimension", "query_ids", "query_rows", "queries").collect()
            shared = spark.sparkContext.broadcast([tuple(bytes(c) if isinstance(c, bytearray) else c for c in r) for r in sent])
            hits.append(written(index.mapInArrow(_searched(shared, nearest, relax), HITS), "vantage-hits"))
            shared.unpersist()
    finally:
        spark.conf.set(batch, before)
    hits = reduce(DataFrame.unionByName, hits, spark.createDataFrame([], HITS))
    place = F.row_number().over(W.partitionBy("_row").orderBy(F.desc("score"), "vec_id"))
    return hits.withColumn("rank", place).where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def op2_vantage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_STEP == 0)


ENTRIES = {"op2_vantage_search": (op2_vantage_search, None)}

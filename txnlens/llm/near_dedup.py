"""Near duplicates by min-max hashing.

Under each permutation of the shingle hashes both the smallest and the largest value are kept, so a
signature of 252 values takes 126 hash evaluations per shingle. Each of the two agrees between two
sets with a probability of their similarity. The values are cut into bands; sets that agree in a
whole band share a bucket. With 42 bands of 6, a pair at the threshold of 0.8 shares no
bucket with a probability of 3e-6, and less the more alike it is.

Equal sets are one class. Within a bucket, classes are compared with a few hubs at a time, on
their full sets; only classes that are not yet in one component go on to the next round, as long as
a bucket holds two components with an uncompared pair. What is open after the last round are
families of many texts just below the threshold: their members are compared block by block, on
full sets, leaving out blocks of one component. So copies of one text cost their number, not its
square, no pairs of a group are listed, and no link between different components is lost. Pairs are left
out only where the threshold is out of reach: by the sizes of the sets, and after the first round by the
shingles that no other open class has, as those cannot be in any intersection.

Edge cases: null and empty texts have no shingles, are linked with nothing and are their own
component. Rows that repeat an id count as one document with that id. An empty table gives an empty
result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import split_by_filter, table, tidy, whole_text, written
from txnlens.llm.graph import components
from txnlens.llm.shingles import mix, shingle_sets

BANDS, BAND_ROWS = 42, 6
WORDS, PERCENT = 5, 80
#: Hubs that each bucket compares in the rounds.
HUBS = (1, 4, 16)
#: Classes in a block of those that are open after the rounds.
BLOCK = 256
#: Shingles hashed at once, so that they stay in the processor's cache.
HASHED = 1 << 15


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Fixed pseudo-random flips and odd factors, one of each per permutation."""
    seeds = np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
    spread = mix(seeds)
    return spread[:count], spread[count:] | np.uint64(1)


def band_hashes(sets: list[np.ndarray], bands: int = BANDS, rows: int = BAND_ROWS) -> np.ndarray:
    """One 64-bit hash per set and band. Sets must not be empty."""
    count = -(-bands * rows // 2)
    flips, factors = permutations(count)
    values = np.empty((len(sets), 2 * count), dtype=np.uint64)
    at = 0
    while at < len(sets):
        end, size = at, 0
        while end < len(sets) and (end == at or size + len(sets[end]) <= HASHED):
            size += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.concatenate([[0], np.cumsum([len(s) for s in sets[at : end - 1]], dtype=np.int64)]).astype(np.int64)
        for p in range(count):
            permuted = (flat ^ flips[p]) * factors[p]
            values[at:end, p] = np.minimum.reduceat(permuted, starts)
            values[at:end, count + p] = np.maximum.reduceat(permuted, starts)
        at = end
    folded = np.zeros((len(sets), bands), dtype=np.uint64)
    folded += np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        folded = mix(folded * np.uint64(0x9E3779B97F4A7C15) + values[:, j : bands * rows : rows])
    return folded


def _signatures(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            sets = shingle_sets(texts, words)
            full = [i for i, s in enumerate(sets) if len(s)]
            bands: list = [None] * len(sets)
            if full:
                for i, hashes in zip(full, band_hashes([sets[i] for i in full])):
                    bands[i] = hashes.view(np.int64)
            digest = [
                None if not len(s) else np.array([s.sum(), mix(s).sum()], dtype=np.uint64).tobytes() for s in sets
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("_key"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(digest, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                ],
                names=["doc_id", "_key", "n_shingles", "digest", "bands"],
            )

    return run


def _confirmed(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.empty(0))
        for batch in batches:
            ids_a, ids_b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            texts_a, texts_b = batch.column("_text_a"), batch.column("_text_b")
            linked = []
            for i, (a, b) in enumerate(zip(ids_a, ids_b)):
                if last[0] != a:
                    last = (a, shingle_sets([texts_a[i].as_py()], words)[0])
                other = shingle_sets([texts_b[i].as_py()], words)[0]
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                linked.append(100 * both >= percent * (len(last[1]) + len(other) - both))
            kept = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(kept), batch.column("b").filter(kept)], names=["a", "b"]
            )

    return run


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """Per row: ``doc_id``, a key of its text, set size, a 128-bit digest of the set, its band hashes."""
    text = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("_text"))
    keyed = text.select("doc_id", F.unhex(F.md5("_text")).alias("_key"), "_text")
    schema = "doc_id bigint, _key binary, n_shingles bigint, digest binary, bands array<bigint>"
    return keyed.mapInArrow(tidy(_signatures(words)), schema)


def _links(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of classes whose full sets are similar enough."""
    first = texts.select(F.col("class").alias("a"), F.col("_text").alias("_text_a"))
    second = texts.select(F.col("class").alias("b"), F.col("_text").alias("_text_b"))
    return pairs.join(second, "b").join(first, "a").mapInArrow(tidy(_confirmed(words, percent)), "a bigint, b bigint")


def _shingle_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column("_text").to_pylist(), words)
            ids = np.repeat(batch.column("class").to_numpy(), [len(s) for s in sets])
            flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], names=["shingle", "class"])

    return run


def shared_sizes(texts: DataFrame, words: int) -> DataFrame:
    """``class, _common``: how many of a class's shingles stand in another class of ``texts`` as well."""
    rows = texts.select("class", "_text").mapInArrow(tidy(_shingle_rows(words)), "shingle bigint, class bigint")
    alone = rows.groupBy("shingle").agg(F.count("*").alias("_n"), F.min("class").alias("class")).where("_n = 1")
    lonely = alone.groupBy("class").agg(F.count("*").alias("_lonely"))
    found = texts.select("class", "n_shingles").join(lonely, "class", "left")
    return found.select("class", (F.col("n_shingles") - F.coalesce("_lonely", F.lit(0))).alias("_common"))


def mixed_only(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    ends = members.groupBy("bucket").agg(F.min("label").alias("_lo"), F.max("label").alias("_hi"))
    # Written out, the buckets are a plain side of the join, whose hot partitions Spark can split.
    open_buckets = written(ends.where("_lo <> _hi").select("bucket"), "open-buckets")
    return written(members.join(open_buckets, "bucket", "left_semi"), "open-members")


def class_components(docs: DataFrame, classes: DataFrame, words: int, percent: int) -> DataFrame | None:
    """``node, label`` of the classes that have a link, or None without any shared bucket."""
    placed = classes.select(F.explode("bands").alias("bucket"), "class", "n_shingles", F.col("n_shingles").alias("_common"))
    members = mixed_only(placed.withColumn("label", F.col("class")))
    if members.isEmpty():
        return None
    wanted = written(members.select("class").distinct().join(classes.select("class", "_key", "n_shingles"), "class"), "bucket-classes")
    text = docs.select(whole_text().alias("_text"))
    text = text.select(F.unhex(F.md5("_text")).alias("_key"), "_text")
    likely, _ = split_by_filter(text, "_key", wanted)
    texts = likely.join(wanted, "_key").dropDuplicates(["class"]).select("class", "n_shingles", "_text")
    texts = written(texts, "bucket-texts")

    labels = links = tested = None
    for turn, hubs in enumerate(HUBS):
        if turn:
            members = _relabelled(members, labels)
            if turn == 1 and not members.isEmpty():
                open_texts = texts.join(written(members.select("class").distinct(), "open-classes"), "class", "left_semi")
                common = written(shared_sizes(open_texts, words), "shared-sizes")
                able = members.drop("_common").join(common, "class").where(100 * F.col("_common") >= percent * F.col("n_shingles"))
                members = mixed_only(able.select(*members.columns))
            if members.isEmpty():
                return labels
        order = W.partitionBy("bucket").orderBy("class")
        chosen = members.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= hubs)
        chosen = written(chosen.drop("_place"), "hubs")
        hub = chosen.select("bucket", *(F.col(c).alias(f"_hub_{c}") for c in ("class", "n_shingles", "_common", "label")))
        # The intersection is no larger than either side's shared part, the union no smaller than the rest.
        most = F.least("_common", "_hub__common")
        pairs = members.join(hub, "bucket").where(
            (F.col("_hub_class") < F.col("class"))
            & (F.col("_hub_label") != F.col("label"))
            & (100 * most >= percent * (F.col("n_shingles") + F.col("_hub_n_shingles") - most))
        )
        pairs = pairs.select(F.col("_hub_class").alias("a"), F.col("class").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        found = written(_links(pairs, texts, words, percent), "links")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = found if links is None else links.unionByName(found)
        labels = components(links)
        members = members.join(chosen.select("bucket", "class"), ["bucket", "class"], "left_anti")
    members = _relabelled(members, labels)
    if members.isEmpty():
        return labels
    return components(links.unionByName(written(block_links(members, texts, words, percent), "block-links")))


def _relabelled(members: DataFrame, labels: DataFrame) -> DataFrame:
    known = members.drop("label").join(labels.withColumnRenamed("node", "class"), "class", "left")
    return mixed_only(known.withColumn("label", F.coalesce("label", "class")))


def _compared(words: int, percent: int):
    def run(rows: pa.Table) -> pa.Table:
        ids, labels = rows.column("class").to_numpy(), rows.column("label").to_numpy()
        sets = shingle_sets(rows.column("_text").to_pylist(), words)
        sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Shingles of two sets and more get columns; a slice of the columns is multiplied at a time.
        column = np.cumsum(times > 1) - 1
        shared = times[code] > 1
        owner, code = owner[shared], column[code[shared]]
        both = np.zeros((len(sets), len(sets)), dtype=np.float32)
        order = np.argsort(code, kind="stable")
        owner, code = owner[order], code[order]
        for first in range(0, int(code[-1]) + 1 if len(code) else 0, 4096):
            lo, hi = np.searchsorted(code, [first, first + 4096])
            has = np.zeros((len(sets), 4096), dtype=np.float32)
            has[owner[lo:hi], code[lo:hi] - first] = 1
            both += has @ has.T
        union = sizes[:, None] + sizes[None, :] - both
        linked = (100 * both >= percent * union) & (labels[:, None] != labels[None, :])
        a, b = np.nonzero(np.triu(linked, 1))
        return pa.table({"a": pa.array(ids[a], pa.int64()), "b": pa.array(ids[b], pa.int64())})

    return run


def block_links(members: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """All links between classes of different components that are joined by buckets of ``members``.

    Classes joined by buckets are a family. A component of more than a block has blocks of its own; the
    other classes of a family share blocks. Every two blocks are compared in one task, but not two
    of one component.
    """
    heads = written(members.groupBy("bucket").agg(F.min("class").alias("a")), "bucket-heads")
    families = components(members.join(heads, "bucket").select("a", F.col("class").alias("b")))
    families = families.select(F.col("node").alias("class"), F.col("label").alias("family"))
    placed = members.select("class", "label").distinct().join(families, "class")
    placed = written(placed, "families")
    sizes = placed.groupBy("family", "label").agg(F.count("*").alias("_size"))
    own = F.when(F.col("_size") > BLOCK, F.col("label")).otherwise(F.lit(-1))
    sizes = sizes.withColumn("_own", own)
    whole = sizes.groupBy("family", "_own").agg(F.ceil(F.sum("_size") / F.lit(BLOCK)).alias("_blocks"))
    cut = written(sizes.join(whole, ["family", "_own"]).select("family", "label", "_own", "_blocks"), "block-counts")
    block = F.struct(F.col("_own").alias("own"), F.pmod(F.xxhash64("class"), F.col("_blocks")).alias("part"))
    placed = written(placed.join(cut, ["family", "label"]).select("class", "label", "family", block.alias("block")), "blocks")
    blocks = written(placed.select("family", "block").distinct(), "block-list")
    other = blocks.withColumnRenamed("block", "other")
    tasks = blocks.join(other, "family").where(
        ((F.col("block.own") == -1) | (F.col("block.own") != F.col("other.own"))) & (F.col("block") <= F.col("other"))
    )
    tasks = written(tasks.withColumn("task", F.struct("family", "block", "other")), "block-tasks")
    first = tasks.select("family", "block", "task")
    second = tasks.where("block <> other").select("family", F.col("other").alias("block"), "task")
    rows = placed.join(first.unionByName(second), ["family", "block"]).join(texts, "class").select("task", "class", "label", "_text")
    return rows.groupBy("task").applyInArrow(_compared(words, percent), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id, kept``, and ``_key``, ``_keep_key`` of the texts.

    ``kept`` marks the smallest id of the component. Where several texts bear that id,
    ``_keep_key`` names one of them.
    """
    signed = written(signatures(docs, words), "signatures")
    full = signed.where("n_shingles > 0")
    classes = full.groupBy("digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("_first"),
        F.max("n_shingles").alias("n_shingles"),
        F.any_value("bands").alias("bands"),
    )
    classes = classes.select(
        F.monotonically_increasing_id().alias("class"), "digest", "_first", F.col("_first._key").alias("_key"), "n_shingles", "bands"
    )
    classes = written(classes, "classes")
    labels = class_components(docs, classes, words, percent)
    named = classes.select("class", "digest", "_first")
    if labels is None:
        named = named.withColumn("label", F.col("class"))
    else:
        named = named.join(labels.withColumnRenamed("node", "class"), "class", "left")
        named = named.withColumn("label", F.coalesce("label", "class"))
    heads = named.groupBy("label").agg(F.min("_first").alias("_head"))
    heads = named.join(heads, "label").select("digest", "_head")
    joined = full.drop("bands").join(heads, "digest").select(
        "doc_id", "n_shingles", F.col("_head.doc_id").alias("component_id"), "_key", F.col("_head._key").alias("_keep_key")
    )
    none = signed.where("n_shingles = 0").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "_key", F.col("_key").alias("_keep_key")
    )
    return joined.unionByName(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each component, all columns as they were."""
    found = near_duplicates(docs, words, percent)
    gone = found.where(~(F.col("kept") & F.col("_key").eqNullSafe(F.col("_keep_key"))))
    gone = written(gone.select(F.col("doc_id").alias("_gone"), "_key").distinct(), "near-dropped")
    row = docs.select(
        F.struct("*").alias("_doc"), F.col("doc_id").alias("_id"), F.unhex(F.md5(whole_text())).alias("_key")
    )
    likely, rest = split_by_filter(row, "_key", gone)
    same = (likely["_key"] == gone["_key"]) & likely["_id"].eqNullSafe(gone["_gone"])
    return rest.select("_doc.*").unionByName(likely.join(gone, same, "left_anti").select("_doc.*"))


def op6_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), words=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(l) >= 4 THEN list_transform(range(1, len(l) - 2), lambda i: array_to_string(l[i:i + 3], ' '))
      WHEN len(l) > 0 THEN [array_to_string(l, ' ')] ELSE [] END) AS shingle
  FROM w
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT x, y FROM shared JOIN n nx ON x = nx.doc_id JOIN n ny ON y = ny.doc_id WHERE 100 * i >= 80 * (nx.n + ny.n - i)
), both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, both_ways.y FROM reach JOIN both_ways ON reach.other = both_ways.x
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

ENTRIES = {"op6_minmax_near_dedup": (op6_minmax_near_dedup, OP6_SQL)}

"""Merkle manifest of a dataset: stored levels, and a recursive query that climbs them from every leaf.

A leaf is the hash of one row. The leaves of a source, in the order of their ids, are hashed in runs of ``ARITY``,
level by level, until one node is left, the source's subroot; the subroots, in the order of their sources,
give the root in the same way. Every run is a node row: its digest, its children's digests, and the link to the
run that it is a child of.

A Spark recursive query climbs from all leaves at once. In each round a leaf's row meets the run it is in by an equi-join,
puts its own digest among its siblings', takes the hash of both and goes on with the run as the child. A leaf
that claims another digest than the stored one ends with another root. What lies above a run is the same for all its
children, so the siblings of the climb are appended to the row of the run's first leaf alone, and the others
take them from there after the climb; else each leaf would carry the siblings of all levels through every join.

Positions come from a range split of the narrow leaf rows that is written with its partitions' numbers: counts per
partition and source give each partition's first position, so that no source passes through one task.

Edge cases: null fields are ``-``. Rows without source form a source of their own, before all others. Null ids come
first within a source; rows that repeat an id follow each other in the order of their hashes. A source of one
row has its leaf as subroot, a table of one source the subroot as root; the proof of a single row is empty. Null and
empty texts cannot be changed by tampering. An empty table gives an empty result; columns other than the
five of documents are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import fold, table, written
from txnlens.session import scratch_path

ARITY = 16
TAMPER_FOLDS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: The tree over the subroots; the sources' trees are numbered from 0.
ROOT_TREE = -1


def field(value: Column) -> Column:
    """Null as ``-``, else the number of bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``source, doc_id, leaf, claimed`` per row: the stored hash, and that of the row as it is found again."""
    own = [field(F.col(name)) for name in FIELDS]
    changed = [*own[:-1], field(F.translate(F.col("text").cast("string"), _UPPER, _LOWER))]
    return docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        digest(*own).alias("leaf"),
        F.when(fold("doc_id", TAMPER_FOLDS) == 0, digest(*changed)).alias("_changed"),
    ).select("source", "doc_id", "leaf", F.coalesce("_changed", "leaf").alias("claimed"))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``rows`` (a written table) in range order with ``_part`` and ``_at``, and the parts of each group.

    ``_at`` rises by one within a part, so a row's position in its group is ``_at - _first + _before`` of its part
    and group. Repeated rows are told apart by their place in the table, so any number of them can be split.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    told = rows.withColumn("_row", F.monotonically_increasing_id())
    split = told.repartitionByRange(*keys, "_row").sortWithinPartitions(*keys, "_row").drop("_row")
    split = split.withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    split = written(split, "ranged")
    parts = split.groupBy(*group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    whole = W.partitionBy(*(group or [F.lit(0)]))
    before = F.coalesce(F.sum("_n").over(whole.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return split, parts.select(*group, "_part", "_first", before.alias("_before"), F.sum("_n").over(whole).alias("_size"))


def _position() -> Column:
    return F.col("_at") - F.col("_first") + F.col("_before")


def placed_leaves(rows: DataFrame) -> DataFrame:
    """``tree, pos, width, doc_id, digest, claimed``: the number of the source, the place in it and its size."""
    keyed = rows.select(F.struct("source").alias("source"), "doc_id", F.col("leaf").alias("digest"), "claimed")
    split, parts = numbered(keyed, ["source"], ["doc_id", "digest"])
    parts = written(parts, "parts")
    # As a struct, a missing source equals a missing source.
    names, spans = numbered(written(parts.select("source").distinct(), "sources"), [], ["source"])
    trees = names.join(spans, "_part").select("source", _position().alias("tree"))
    parts = written(parts.join(trees, "source"), "parts")
    found = split.join(parts, ["source", "_part"])
    return written(
        found.select("tree", _position().alias("pos"), F.col("_size").alias("width"), "doc_id", "digest", "claimed"), "leaves"
    )


def steps_to_one(width: int, arity: int = ARITY) -> int:
    """How many levels of runs a tree of ``width`` leaves has."""
    steps = 0
    while width > 1:
        width, steps = math.ceil(width / arity), steps + 1
    return steps


def _runs(nodes: DataFrame, level: int, arity: int) -> DataFrame:
    """The next level: nodes of trees that still have several, in runs of ``arity``."""
    at = F.floor(F.col("pos") / arity).cast("bigint")
    children = F.sort_array(F.collect_list(F.struct("pos", "digest")))["digest"]
    runs = nodes.where("width > 1").groupBy("tree", at.alias("at"))
    return runs.agg(children.alias("children"), F.max("width").alias("width")).select(
        "tree",
        F.lit(level).alias("level"),
        F.col("at").alias("pos"),
        F.ceil(F.col("width") / arity).cast("bigint").alias("width"),
        F.sha2(F.array_join("children", ""), 256).alias("digest"),
        F.unhex(F.array_join("children", "")).alias("children"),
    )


def _linked(nodes: DataFrame, single: bool, arity: int) -> DataFrame:
    """Adds the run that a node is a child of, and its slot there; the root has none."""
    inner, top = F.col("width") > 1, F.lit(not single) & (F.col("tree") != ROOT_TREE)
    place = F.when(inner, F.col("pos")).when(top, F.col("tree"))
    return nodes.withColumns(
        {
            "up_tree": F.when(inner, F.col("tree")).when(top, F.lit(ROOT_TREE).cast("bigint")),
            "up_level": F.when(inner, F.col("level") + 1).when(top, F.lit(1)),
            "up_pos": F.floor(place / arity).cast("bigint"),
            "slot": (place % arity).cast("int"),
        }
    )


class Manifest:
    """The stored tree: ``leaf_rows``, ``runs`` with their links, ``subroots`` by tree, and ``root``."""

    def __init__(self, docs: DataFrame, arity: int = ARITY):
        spark = docs.sparkSession
        placed = placed_leaves(written(leaves(docs), "leaf-hashes"))
        # One row per depth of a tree and the number of trees: the sizes decide how many levels there are.
        sizes = placed.agg(F.max("width"), F.max("tree")).first()
        widest, trees = sizes[0] or 0, (sizes[1] if sizes[1] is not None else -1) + 1
        self.arity, self.single = arity, trees == 1
        path = scratch_path(spark, "levels")
        shape = None

        def store(runs: DataFrame, name: str) -> DataFrame:
            nonlocal shape
            linked = _linked(runs, self.single, arity)
            shape = linked.schema
            linked.write.option("compression", "zstd").parquet(f"{path}/step={name}")
            return spark.read.schema(shape).parquet(f"{path}/step={name}")

        first = placed.select("tree", F.lit(0).alias("level"), "pos", "width", "digest")
        level, tops = first, [first.where("width = 1").select("tree", "digest")]
        for height in range(1, steps_to_one(widest, arity) + 1):
            level = store(_runs(level, height, arity), f"source{height}")
            tops.append(level.where("width = 1").select("tree", "digest"))
        subroots = tops[0]
        for more in tops[1:]:
            subroots = subroots.unionByName(more)
        self.subroots = written(subroots, "subroots")

        level = self.subroots.select(
            F.lit(ROOT_TREE).cast("bigint").alias("tree"),
            F.lit(0).alias("level"),
            F.col("tree").alias("pos"),
            F.lit(trees).cast("bigint").alias("width"),
            "digest",
        )
        for height in range(1, steps_to_one(trees, arity) + 1):
            level = store(_runs(level, height, arity), f"root{height}")
        top = level.where("width = 1").select("digest").first()
        self.root = top and top["digest"]
        self.leaf_rows = _linked(placed.withColumn("level", F.lit(0)), self.single, arity)
        self.runs = spark.read.schema(shape).parquet(f"{path}/step=*") if shape else None

    def climb(self) -> DataFrame:
        """``tree, pos, lone, doc_id, leaf, folded, slot, above`` per leaf, digests as bytes.

        ``above`` holds the siblings of the levels over the leaf's own run, in the row of the run's first leaf only.
        """
        start = self.leaf_rows.select(
            "tree",
            "pos",
            (F.col("width") == 1).alias("lone"),
            "doc_id",
            F.unhex("digest").alias("leaf"),
            F.unhex("claimed").alias("folded"),
            "up_tree",
            "up_level",
            "up_pos",
            "slot",
            F.lit(0).alias("height"),
            F.lit(b"").alias("above"),
        )
        if self.runs is None:
            return start.select("tree", "pos", "lone", "doc_id", "leaf", "folded", "slot", "above")
        return self.leaf_rows.sparkSession.sql(
            """
            WITH RECURSIVE climb AS (
              SELECT tree, pos, lone, doc_id, leaf, folded, up_tree, up_level, up_pos, slot, height, above, slot AS first_slot
              FROM {start}
              UNION ALL
              SELECT c.tree, c.pos, c.lone, c.doc_id, c.leaf,
                unhex(sha2(lower(hex(concat(substring(r.children, 1, 32 * c.slot), c.folded, substring(r.children, 32 * c.slot + 33)))), 256)),
                r.up_tree, r.up_level, r.up_pos, r.slot, c.height + 1,
                CASE WHEN c.pos % {arity} <> 0 OR c.height = 0 THEN c.above
                  ELSE concat(c.above, substring(r.children, 1, 32 * c.slot), substring(r.children, 32 * c.slot + 33)) END,
                c.first_slot
              FROM climb c JOIN {runs} r ON c.up_tree = r.tree AND c.up_level = r.level AND c.up_pos = r.pos
            )
            SELECT tree, pos, lone, doc_id, leaf, folded, first_slot AS slot, above FROM climb WHERE up_tree IS NULL
            """,
            start=start,
            runs=self.runs.select("tree", "level", "pos", "children", "up_tree", "up_level", "up_pos", "slot"),
            arity=self.arity,
        )

    def proofs(self) -> DataFrame:
        """``doc_id, leaf, subroot, root, proof, folded_root, verified`` per leaf."""
        run = F.floor(F.col("pos") / self.arity).cast("bigint")
        # Every leaf is a row in every round: the session's limit on rows would stop large tables.
        spark, limit = self.leaf_rows.sparkSession, "spark.sql.cteRecursionRowLimit"
        before = spark.conf.get(limit)
        spark.conf.set(limit, "-1")
        try:
            ended = written(self.climb().withColumn("run", run), "climbed")
        finally:
            spark.conf.set(limit, before)
        # The first leaf of each run stands for it; a lone leaf is a child of a run of the root's tree.
        heads = ended.where(F.col("pos") % self.arity == 0).select("tree", "run", "lone", "above")
        heads = heads.join(self.subroots.select("tree", F.unhex("digest").alias("subroot")), "tree")
        if self.runs is None:
            heads = heads.withColumn("children", F.lit(b""))
        else:
            kin = self.runs.where("level = 1").select(F.col("tree").alias("_tree"), F.col("pos").alias("_run"), "children")
            tree = F.when(F.col("lone"), F.lit(ROOT_TREE)).otherwise(F.col("tree"))
            place = F.when(F.col("lone"), F.floor(F.col("tree") / self.arity)).otherwise(F.col("run"))
            heads = heads.join(kin, (tree == F.col("_tree")) & (place == F.col("_run")), "left")
        found = ended.drop("above", "lone").join(heads.select("tree", "run", "above", "subroot", "children"), ["tree", "run"])
        at = F.col("slot") * 32
        own = F.concat(F.substring("children", F.lit(1), at), F.substring("children", at + 33, F.lit(32 * self.arity)))
        root = F.lit(self.root)
        return found.select(
            "doc_id",
            F.lower(F.hex("leaf")).alias("leaf"),
            F.lower(F.hex("subroot")).alias("subroot"),
            root.alias("root"),
            F.lower(F.hex(F.concat(F.coalesce(own, F.lit(b"")), "above"))).alias("proof"),
            F.lower(F.hex("folded")).alias("folded_root"),
            (F.lower(F.hex("folded")) == root).alias("verified"),
        )


def op13_recursive_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = Manifest(table(spark, sf_dir, "documents")).proofs()
    return found.withColumn("proof", F.sha2("proof", 256)).withColumnRenamed("proof", "proof_sha256")


def _level_sql(name: str, before: str, key: str) -> str:
    """One more level above the nodes of ``before``, with what the leaves below take from it."""
    return f"""
{name}r AS (
  SELECT {key}, p // 16 AS p, any_value((w + 15) // 16) AS w, sha256(string_agg(d, '' ORDER BY p)) AS d, list(d ORDER BY p) AS c
  FROM (SELECT DISTINCT {key}, p, w, d FROM {before}) WHERE w > 1 GROUP BY {key}, p // 16
), {name} AS (
  SELECT b.id, b.s, b.k, b.leaf, coalesce(r.p, b.p) AS p, coalesce(r.w, b.w) AS w, coalesce(r.d, b.d) AS d,
    CASE WHEN r.p IS NULL THEN b.f
      ELSE sha256(array_to_string(r.c[1:b.p % 16], '') || b.f || array_to_string(r.c[b.p % 16 + 2:], '')) END AS f,
    CASE WHEN r.p IS NULL THEN b.proof
      ELSE b.proof || array_to_string(r.c[1:b.p % 16], '') || array_to_string(r.c[b.p % 16 + 2:], '') END AS proof
  FROM {before} b LEFT JOIN {name}r r ON {" AND ".join(f"b.{k} = r.{k}" for k in key.split(", "))} AND b.w > 1 AND b.p // 16 = r.p
)"""


def _sql(levels: int = 6) -> str:
    """All levels written out one by one; enough for 16 to the power of ``levels`` rows of a source."""

    def part(text: str) -> str:
        return f"coalesce(strlen({text})::VARCHAR || ':' || {text}, '-')"

    front = " || ".join(part(f"{c}::VARCHAR") for c in FIELDS[:-1])
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    # DuckDB has no crc32: a fold over the digits of the id, each followed by a step per bit.
    chain = [f"t{i}" for i in range(levels + 1)]
    sql = f"""
WITH rows_ AS (
  SELECT row_number() OVER () AS id, doc_id, source, sha256({front} || {part("text")}) AS leaf,
    sha256({front} || {part(lower)}) AS changed,
    xor(4294967295, list_reduce(list_prepend(4294967295, flatten(list_transform(
        list_filter(string_split(coalesce(doc_id::VARCHAR, ''), ''), lambda x: x <> ''),
        lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crc
  FROM documents
), t0 AS (
  SELECT id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, 0 AS k, leaf,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
    count(*) OVER (PARTITION BY source) AS w, leaf AS d, CASE WHEN crc % 5 = 0 THEN changed ELSE leaf END AS f, '' AS proof
  FROM rows_
)"""
    for i in range(levels):
        sql += "," + _level_sql(chain[i + 1], chain[i], "s")
    sql += f""", u0 AS (
  SELECT id, s, k, leaf, s AS p, (SELECT max(s) + 1 FROM t0) AS w, d, f, proof FROM {chain[-1]}
)"""
    for i in range(levels):
        sql += "," + _level_sql(f"u{i + 1}", f"u{i}", "k")
    return sql + f"""
SELECT r.doc_id, r.leaf, t.d AS subroot, u.d AS root, sha256(u.proof) AS proof_sha256, u.f AS folded_root, u.f = u.d AS verified
FROM u{levels} u JOIN {chain[-1]} t USING (id) JOIN rows_ r USING (id)
"""


OP13_SQL = _sql()

ENTRIES = {"op13_recursive_manifest": (op13_recursive_manifest, OP13_SQL)}

"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Only rows that share a length with another row have their prefix compared, only those that share
the prefix as well take part in the comparison of full hashes. Each step groups narrow keys,
which combine before the shuffle, so a group with a third of all rows costs as much as any other.
The hashes are taken in one scan that carries no text any further.

Edge cases: null text is empty text, and all empty texts are one group. A null ``doc_id`` is larger
than any other, so it stays only where a group has no other id. Rows that repeat an id are
separate members of their group, and exactly one row of each group is kept. An empty table gives
an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import BLANKS, split_by_filter, table, whole_text, written

PREFIX_CHARS = 256


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def digests(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """One narrow row per document: ``_row``, ``doc_id``, length, prefix hash and full hash."""
    text = docs.select("doc_id", normalised(whole_text()).alias("_text"))
    return text.select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        F.length("_text").alias("_length"),
        F.struct(
            F.length("_text").alias("length"),
            F.xxhash64(F.substring("_text", 1, prefix_chars)).alias("prefix"),
        ).alias("_start"),
        F.sha2("_text", 256).alias("text_sha256"),
    )


def refine(rows: DataFrame) -> DataFrame:
    """Groups of two and more equal texts: full hash, ``keep_id``, ``_keep_row``, ``group_size``."""

    # Written out, the keys are a plain side of the join, whose hot partitions Spark can split.
    def shared(df: DataFrame, key: str) -> DataFrame:
        return written(df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1").select(key), "shared-keys")

    by_length = rows.join(shared(rows, "_length"), "_length", "left_semi")
    by_prefix = by_length.join(shared(by_length, "_start"), "_start", "left_semi")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    groups = by_prefix.groupBy("text_sha256").agg(first.alias("_first"), F.count("*").alias("group_size"))
    return groups.where("group_size > 1").select(
        "text_sha256", F.col("_first.doc_id").alias("keep_id"), F.col("_first._row").alias("_keep_row"), "group_size"
    )


def exact_duplicates(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """Per row: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    rows = written(digests(docs, prefix_chars), "exact-digests")
    # Written out, the groups are a plain side of the join as well, so a hot hash can be split.
    found = rows.join(written(refine(rows), "exact-groups"), "text_sha256", "left")
    alone = F.col("group_size").isNull()
    return found.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"),
        (alone | (F.col("_row") == F.col("_keep_row"))).alias("kept"),
        "text_sha256",
    )


def drop_exact(docs: DataFrame, prefix_chars: int = PREFIX_CHARS) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were.

    A row is found again by id and full hash; rows that repeat both are told apart only where there
    are such, and any one of them stays. Rows without a copy pass a filter of fixed size and are not shuffled.
    """
    rows = written(digests(docs, prefix_chars), "exact-digests")
    groups = refine(rows).withColumnRenamed("text_sha256", "_hash")
    same = rows.join(groups, rows["text_sha256"] == groups["_hash"]).where(rows["doc_id"].eqNullSafe(groups["keep_id"]))
    again = same.groupBy("_hash").agg(F.count("*").alias("_n"))
    groups = written(groups.join(again, "_hash").select("_hash", "keep_id", "_n"), "exact-groups")
    hashed = docs.select(
        F.struct("*").alias("_doc"), F.sha2(normalised(whole_text()), 256).alias("_hash"), F.col("doc_id").alias("_id")
    )
    likely, rest = split_by_filter(hashed, "_hash", groups)
    told = likely.join(groups, "_hash", "left").where(F.col("_n").isNull() | F.col("_id").eqNullSafe(F.col("keep_id")))
    once = told.where("coalesce(_n, 1) = 1").select("_doc")
    more = groups.where("_n > 1").select(F.col("_hash").alias("_kept_hash"), "keep_id")
    doubtful, _ = split_by_filter(hashed, "_hash", more.select(F.col("_kept_hash").alias("_hash")))
    same = (doubtful["_hash"] == more["_kept_hash"]) & doubtful["_id"].eqNullSafe(more["keep_id"])
    repeated = doubtful.join(more, same).dropDuplicates(["_hash"]).select("_doc")
    return rest.select("_doc").unionByName(once).unionByName(repeated).select("_doc.*")


def op4_progressive_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


OP4_SQL = r"""
WITH t AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents
), g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY h)
SELECT doc_id, keep_id, n AS group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM t JOIN g USING (h)
"""

ENTRIES = {"op4_progressive_dedup": (op4_progressive_dedup, OP4_SQL)}

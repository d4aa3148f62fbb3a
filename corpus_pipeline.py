"""The corpus pipeline: its stages in order, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and gives a DataFrame, which is written as Parquet and read
again as the next one's ``docs``. All but the last give the columns of documents, and keep every row
that they do not reject:

1. toxicity rejects documents whose score reaches the threshold;
2. exact dedup keeps one row of each group of equal texts;
3. near dedup keeps one document of each component of links at a similarity of 0.8 over five words;
4. mixing takes documents without repeats up to the sources' target weights;
5. the codec gives the ids of the texts that are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlens.llm.common import table, written
from txnlens.llm.exact_dedup import drop_exact
from txnlens.llm.mixing import mix_once
from txnlens.llm.near_dedup import drop_near
from txnlens.llm.pieces import encode_pieces
from txnlens.llm.toxicity import drop_toxic

#: Share of the remaining tokens that the mix may have. Levels with equal weights that lack tokens give
#: their part to their siblings, so only levels far above their weight are cut.
MIX_SHARE = 0.9


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_exact(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_once(docs, MIX_SHARE)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_pieces(docs)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("minhash near dedup", near_dedup),
    ("mixing to target weights", mixing),
    ("sentencepiece codec", encoding),
]

#: Boosted trees, tree splits of a hash sample and subword ids have no SQL form; tests hold ``run`` against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs

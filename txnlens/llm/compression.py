"""Text quality by compression: how much better a text packs with a dictionary of good texts than with one of bad texts.

A bounded sample of labelled rows is drawn by a hash of the id and split by another hash. From the texts of two
thirds of it, cut into pieces, one zstandard dictionary per label is trained, in a task of its own; the last third
calibrates. A text is compressed whole, piece by piece, with either dictionary, as a dictionary only helps at the start of
what is compressed. The margin is the difference of the two sizes over the text's own size, drawn towards
the mean margin as if ``PULL`` bytes of ordinary text came on top, since a few bytes tell nothing. An isotonic
curve over the margins of the calibration part turns it into a score.

Edge cases: null text is empty; empty texts have the mean margin. Rows without label are scored only; an id labelled more than
once counts as good if any label says so; null labels and null ids of labels are left out. With labels of one
kind or a part without one of the kinds, the score is the share of good rows in the sample (0.5 without any). Rows
that repeat an id are scored one by one. An empty table gives an empty result; columns other than ``doc_id``
and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import fold, table, tidy, whole_text, written

FOLDS, HELD_OUT = 3, 1
THRESHOLD = 0.5
#: Bounds of what is learned from: labelled rows, pieces of one text, pieces of one label.
SAMPLE, PIECES_OF_A_TEXT, PIECES_OF_A_LABEL = 12_000, 8, 4_000
PIECE = 2048
DICTIONARY = 112_640
LEVEL = 3
PULL = 64
SEED = 23

#: Below this many pieces zstandard refuses to train.
_FEWEST = 16


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    for start in range(0, len(text), size):
        yield text[start : start + size]


def train(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary of at most ``size`` bytes; few or tiny samples are strung together instead."""
    total = sum(map(len, samples))
    if len(samples) >= _FEWEST:
        try:
            # Training wants several times the bytes of the dictionary.
            return zstandard.train_dictionary(min(size, max(total // 4, 1024)), samples, k=200, d=8, level=LEVEL).as_bytes()
        except zstandard.ZstdError:
            pass
    return b"".join(samples)[-size:]


@lru_cache(maxsize=4)
def compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, level=LEVEL, write_content_size=False, write_dict_id=False)


def packed(text: bytes, dictionary: bytes) -> int:
    """The bytes that a text takes, compressed piece by piece with a dictionary."""
    press = compressor(dictionary).compress
    return sum(len(press(piece)) for piece in pieces(text))


def _drawn_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Some pieces from all over each text, with a hash to draw by."""
    for batch in batches:
        rows: list[tuple[int, int, bytes]] = []
        for doc_id, quality, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "quality", "_text"))):
            count = -(-len(text) // PIECE)
            order = sorted((xxhash.xxh3_64_intdigest(f"{doc_id}:{i}", SEED), i) for i in range(count))
            rows += [(quality, h >> 1, text[i * PIECE : (i + 1) * PIECE]) for h, i in order[:PIECES_OF_A_TEXT]]
        columns = list(zip(*rows)) or [(), (), ()]
        types = (pa.int32(), pa.int64(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["quality", "draw", "piece"])


def _trained(rows: pd.DataFrame) -> pd.DataFrame:
    ordered = rows.sort_values(["draw", "piece"])
    return pd.DataFrame({"quality": [int(ordered["quality"].iloc[0])], "dictionary": [train(list(ordered["piece"]))]})


def dictionaries(sample: DataFrame) -> dict[int, bytes]:
    """One dictionary per label, each trained in its own task from a bounded number of pieces."""
    cut = sample.select("doc_id", "quality", "_text").mapInArrow(tidy(_drawn_pieces), "quality int, draw bigint, piece binary")
    place = F.row_number().over(W.partitionBy("quality").orderBy("draw", "piece"))
    drawn = cut.withColumn("_place", place).where(F.col("_place") <= PIECES_OF_A_LABEL).drop("_place")
    found = drawn.groupBy("quality").applyInPandas(_trained, "quality int, dictionary binary")
    return {r["quality"]: bytes(r["dictionary"]) for r in found.collect()}


def _sized(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``doc_id``, what else is asked for, the text's bytes, and how many more the dictionary of bad texts takes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = shared.value
        for batch in batches:
            sizes, gains = [], []
            for cell in batch.column("_text"):
                text = cell.as_buffer().to_pybytes()
                sizes.append(len(text))
                gains.append(packed(text, bad) - packed(text, good))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality"), pa.array(sizes, pa.int64()), pa.array(gains, pa.int64())],
                names=["doc_id", "quality", "size", "gain"],
            )

    return run


SIZED = "doc_id bigint, quality int, size bigint, gain bigint"


def sample_labels(labels: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` labelled ids: ``doc_id, quality, part``; part 2 calibrates."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(learn)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("quality").cast("int")).alias("quality"))
    share = min(1.0, sample / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.lit(1 << 40)) < int(share * (1 << 40))
    part = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("doc_id")), F.lit(3)).cast("int")
    return known.where(draw).select("doc_id", "quality", part.alias("part"))


def quality_scores(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """``doc_id`` and ``score`` of every row. ``learn`` says which rows of ``labels`` may be learned from."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().cast("binary").alias("_text"))
    # The ids are bounded by the sample's size, so they go to every task.
    drawn = written(sample_labels(labels, learn, sample).coalesce(1), "quality-labels")
    chosen = written(texts.join(F.broadcast(drawn), "doc_id").repartition(8), "quality-sample")
    counted = chosen.groupBy((F.col("part") == 2).alias("tried"), "quality").count().collect()
    sizes = {(r["tried"], r["quality"]): r["count"] for r in counted}
    seen = {q: sum(n for (_, quality), n in sizes.items() if quality == q) for q in (0, 1)}
    known = dictionaries(chosen.where("part < 2")) if all(seen.values()) else {}
    # A label whose texts are all empty has no pieces either.
    if len(known) < 2 or not all(known.values()) or not all(sizes.get((True, q)) for q in (0, 1)):
        share = seen[1] / sum(seen.values()) if sum(seen.values()) else 0.5
        return texts.select("doc_id", F.lit(share).cast("double").alias("score"))

    shared = spark.sparkContext.broadcast((known[1], known[0]))
    tried = written(chosen.where("part = 2").select("doc_id", "quality", "_text").mapInArrow(tidy(_sized(shared)), SIZED), "tried")
    total = tried.agg(F.sum("gain"), F.sum("size")).first()
    mean = total[0] / max(total[1], 1)
    margin = (F.col("gain") + F.lit(mean * PULL)) / (F.col("size") + F.lit(PULL))
    # Equal margins are one point of the curve, so copies weigh without being sorted one by one.
    points = tried.groupBy(F.round(margin, 6).alias("margin")).agg(
        F.avg(F.col("quality").cast("double")).alias("label"), F.count("*").cast("double").alias("weight")
    )
    curve = IsotonicRegression(featuresCol="margin", labelCol="label", weightCol="weight", predictionCol="_calibrated")
    fitted = curve.fit(points)
    asked = texts.select("doc_id", F.lit(None).cast("int").alias("quality"), "_text").mapInArrow(tidy(_sized(shared)), SIZED)
    # The curve is flat between steps; a share of the margin itself keeps the order within a step.
    scored = fitted.transform(asked.select("doc_id", margin.alias("margin")))
    score = F.col("_calibrated") * 0.98 + 0.02 / (1 + F.exp(-20 * F.col("margin")))
    return scored.select("doc_id", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))


def drop_bad(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns as they were; by id, the best text of an id decides."""
    scores = quality_scores(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    best = scores.groupBy(F.struct("doc_id").alias("_key")).agg(F.max("score").alias("_score"))
    keep = best.where(F.col("_score") >= threshold).select("_key")
    row = docs.select(F.struct("*").alias("_doc"), F.struct(F.col("doc_id").cast("bigint").alias("doc_id")).alias("_key"))
    return row.join(keep, "_key", "left_semi").select("_doc.*")


def op12_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = quality_scores(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    return scores.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


ENTRIES = {"op12_compression_quality": (op12_compression_quality, None)}

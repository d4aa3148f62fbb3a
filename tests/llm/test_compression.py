import random
import zlib

import pytest
import zstandard
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.llm.common import fold
from txnlens.llm.compression import (
    PIECE,
    PULL,
    _sized,
    SIZED,
    drop_bad,
    op12_compression_quality,
    packed,
    pieces,
    quality_scores,
    sample_labels,
    train,
)

SF = "/root/testdata/sf0.1"
LABELS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic")])
WORDS = "the river runs past old houses while people walk slowly home under green trees and talk about rain".split()


def good(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)) + "."


def bad(rng, n):
    return " ".join(rng.choice(WORDS).upper() + "!!$$" for _ in range(n))


@pytest.fixture(scope="module")
def corpus(make_docs, spark):
    rng = random.Random(5)
    texts = [(i, bad(rng, 120) if i % 4 == 0 else good(rng, 120)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(0, 400)], LABELS)
    return texts, labels


def anything():
    return F.lit(True)


def test_pieces_cover_the_whole_text():
    text = bytes(range(256)) * 40
    assert b"".join(pieces(text)) == text and max(map(len, pieces(text))) == PIECE
    assert list(pieces(b"")) == []


def test_sizes_are_those_of_zstandard():
    rng = random.Random(1)
    dictionary = train([good(rng, 60).encode() for _ in range(200)])
    text = good(rng, 2000).encode()
    plain = zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary), level=3, write_content_size=False, write_dict_id=False
    )
    assert packed(text, dictionary) == sum(len(plain.compress(text[i : i + PIECE])) for i in range(0, len(text), PIECE))
    assert packed(b"", dictionary) == 0


def test_few_samples_are_strung_together():
    assert train([b"one", b"two"]) == b"onetwo"
    assert packed(b"a" * 9000, train([b"a"] * 50)) < 200


def test_margins_against_brute_force(make_docs, spark):
    rng = random.Random(2)
    first, second = (train([f(rng, 60).encode() for _ in range(100)]) for f in (good, bad))
    rows = [(i, text) for i, text in enumerate(["", None, "é", good(rng, 900), bad(rng, 900), "x" * 5_000_000])]
    shared = spark.sparkContext.broadcast((first, second))
    asked = make_docs(rows).select(
        "doc_id", F.lit(None).cast("int").alias("quality"), F.coalesce("text", F.lit("")).cast("binary").alias("_text")
    )
    found = {r.doc_id: (r["size"], r.gain) for r in asked.mapInArrow(_sized(shared), SIZED).collect()}
    for i, text in rows:
        raw = (text or "").encode()
        assert found[i] == (len(raw), packed(raw, second) - packed(raw, first))
    assert found[3][1] > 0 > found[4][1]


def test_good_and_bad_texts_are_told_apart(corpus, make_docs):
    texts, labels = corpus
    rng = random.Random(9)
    fresh = [(1000 + i, bad(rng, 300) if i % 2 else good(rng, 300)) for i in range(40)] + [(2000, ""), (2001, None)]
    found = {r.doc_id: r.score for r in quality_scores(make_docs(texts + fresh), labels, anything()).collect()}
    assert len(found) == len(texts) + len(fresh) and all(0 <= s <= 1 for s in found.values())
    assert all((found[1000 + i] < 0.5) == (i % 2 == 1) for i in range(40))
    assert found[2000] == found[2001] > 0.5


def test_scores_are_calibrated_on_held_out_rows(spark):
    rows = op12_compression_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    cells = rows.select("score", "predicted", "quality").collect()
    bad_rows = [r for r in cells if r.quality == 0]
    clean = [r for r in cells if r.quality == 1]
    pairs = [(a.score < b.score) + (a.score == b.score) / 2 for a in bad_rows for b in clean]
    assert sum(pairs) / len(pairs) > 0.98
    assert sum(r.predicted == 0 for r in bad_rows) >= 0.95 * len(bad_rows)
    assert sum(r.predicted == 1 for r in clean) >= 0.98 * len(clean)
    assert abs(sum(r.score for r in cells) / len(cells) - len(clean) / len(cells)) < 0.03


def test_held_out_labels_are_not_learned_from(corpus, make_docs, stored_docs, spark):
    texts, labels = corpus
    turned = labels.withColumn("quality", F.when(fold("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    results = []
    for table in (labels, turned):
        folder = stored_docs(texts)
        table.write.parquet(f"{folder}/labels.parquet")
        found = op12_compression_quality(spark, folder).collect()
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in found)
        results.append(sorted((r.doc_id, r.score, r.predicted) for r in found))
    assert results[0] == results[1]


def test_dropping_keeps_good_rows_as_they_were(corpus, make_docs):
    texts, labels = corpus
    docs = make_docs(texts + [(None, "the old houses")]).withColumn("score", F.lit("clash")).withColumn("_key", F.lit(1))
    kept = drop_bad(docs, labels).collect()
    assert {r.doc_id for r in kept} == {i for i, _ in texts if i % 4} | {None}
    assert all(r.score == "clash" and r._key == 1 for r in kept)


def test_labels_of_one_kind_none_and_odd_ones(corpus, make_docs, spark):
    texts, _ = corpus
    docs = make_docs(texts[:20])
    ones = spark.createDataFrame([(i, 1, 0) for i in range(20)], LABELS)
    assert {r.score for r in quality_scores(docs, ones, anything()).collect()} == {1.0}
    none = spark.createDataFrame([(None, 1, 0), (3, None, 0)], LABELS)
    assert {r.score for r in quality_scores(docs, none, anything()).collect()} == {0.5}
    assert quality_scores(make_docs([]), ones, anything()).collect() == []
    empty = make_docs([(i, "" if i % 2 else None) for i in range(60)])
    mixed = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], LABELS)
    assert {r.score for r in quality_scores(empty, mixed, anything()).collect()} == {0.5}
    twice = spark.createDataFrame([(1, 0, 0), (1, 1, 0), (1, None, 0)], LABELS)
    assert [(r.doc_id, r.quality) for r in sample_labels(twice, anything()).collect()] == [(1, 1)]


def test_rows_that_repeat_an_id_are_scored_one_by_one(corpus, make_docs):
    texts, labels = corpus
    rng = random.Random(3)
    more = [(7000, good(rng, 200)), (7000, bad(rng, 200)), (7000, good(rng, 200))]
    found = sorted(r.score for r in quality_scores(make_docs(texts + more), labels, anything()).where("doc_id = 7000").collect())
    assert len(found) == 3 and found[0] < 0.5 < found[1]
    assert PULL > 0

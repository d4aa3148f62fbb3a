"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

The labelled rows are thinned to about ``SAMPLE`` by a hash of their id, whatever the size of the
corpus, and split by another hash into two halves and a calibration part. From each half a lexicon of
words and word beginnings is taken whose documents are toxic far more often; the features of one half
use the lexicon of the other, so the trees never see words weighted by the row itself. Features are
densities of lexicon words, their weights, how near they stand to a second person, and the rates of
capitals, punctuation and obfuscated words. The trees learn from both halves; the isotonic
curve from the calibration part, which uses the lexicon of both halves, as all scoring does.

Texts are turned into features in tasks, the model is applied by Spark ML.

Edge cases: null text is empty; an empty text has zero features and gets the score of such. Rows without
label take part in scoring only; an id labelled more than once counts as toxic if any label says so;
null labels and null ids of labels are left out. With labels of one kind or too few rows for a part, the
score is the share of toxic rows among the sample (0 without any). Rows that repeat an id are scored one
by one. An empty table gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.llm.common import fold, split_by_filter, table, tidy, whole_text, written
from txnlens.llm.shingles import chunks

SAMPLE = 20_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
TREES, TREE_DEPTH = 30, 4
MIN_TOXIC, MIN_WEIGHT = 3, 2.0
STRONG = 3.5
BEGINNINGS = range(4, 9)
WINDOW = 5
SEED = 17

# Pronouns of the second person in the corpus languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deiner ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tuyo usted ustedes vosotros".split()
)
# Characters written in place of letters.
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")

NAMES = (
    "hits strong_hits weight most near_second second_person capitals shouted punctuation marks obfuscated "
    "obfuscated_hits repeated length"
).split()

_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_INNER = re.compile(r"[\W_]+")
_CLOSING, _OPENING = "!?.,;:)]}'\"", "([{'\"¿¡"
_RUN = re.compile(r"(.)\1\1")


def core(token: str) -> str:
    return _EDGES.sub("", token.lower())


def plain(token: str) -> str | None:
    """The word behind look-alike characters and separators, None if there are none."""
    word = token.lower().rstrip(_CLOSING).lstrip(_OPENING)
    if word.isalpha() or not any(map(str.isalpha, word)):
        return None
    bare = _INNER.sub("", word.translate(LOOKALIKES))
    return bare if bare.isalpha() else None


def entries(word: str) -> list[str]:
    """What a word is looked up as: itself, and its beginnings, marked by a star."""
    return [word, *(word[:n] + "*" for n in BEGINNINGS if n <= len(word))] if word else []


class Lexicon:
    """Weights of words, where a beginning is looked for only if the lexicon has one with the word's first letters."""

    def __init__(self, weights: dict[str, float]):
        self._weights = weights
        self._stems = {e[: BEGINNINGS[0]] for e in weights if e.endswith("*")}

    def __call__(self, word: str) -> float:
        if word[: BEGINNINGS[0]] in self._stems:
            return max((self._weights.get(e, 0.0) for e in entries(word)), default=0.0)
        return self._weights.get(word, 0.0)


def token_table(tokens: list[str], lexicon: dict[str, float]) -> np.ndarray:
    """Per distinct token: weight, second person, letters, capitals, punctuation, marks, obfuscated, its weight, run."""
    weight = Lexicon(lexicon)
    out = []
    for token in tokens:
        n, word = len(token), token.lower()
        # With so many distinct characters, none stands three times.
        run = len(set(token)) < n - 1 and _RUN.search(token) is not None
        if word.isalpha() and token.isalpha():
            # Nothing to strip and nothing in place of letters.
            capitals = 0 if token.islower() else sum(map(str.isupper, token))
            shouted = n > 2 and capitals == n
            out.append((weight(word), word in SECOND_PERSON, n, capitals, 0, 0, False, False, run, shouted))
            continue
        word = core(token)
        found = weight(word)
        bare = plain(token)
        hidden = 0.0
        if bare is not None and bare != word:
            hidden = weight(bare)
        letters = sum(map(str.isalpha, token))
        capitals = 0 if token.islower() else sum(map(str.isupper, token))
        out.append(
            (
                max(found, hidden),
                word in SECOND_PERSON,
                letters,
                capitals,
                n - sum(map(str.isalnum, token)),
                token.count("!") + token.count("?"),
                bare is not None,
                hidden > 0,
                run,
                letters > 2 and capitals == letters,
            )
        )
    return np.array(out, dtype=float).reshape(len(tokens), 10)


def features(texts: list[str | None], lexicon: dict[str, float]) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    found = []
    for start, end in chunks(texts):
        split = [(t or "").split() for t in texts[start:end]]
        lengths = np.array([len(s) for s in split])
        flat = np.empty(int(lengths.sum()), dtype=object)
        flat[:] = [w for s in split for w in s]
        codes, distinct = pd.factorize(flat)
        tokens = token_table(list(distinct), lexicon)[codes] if len(codes) else np.zeros((0, 10))
        ends = np.cumsum(lengths)
        for stop, n in zip(ends.tolist(), lengths.tolist()):
            own = tokens[stop - n : stop]
            if not n:
                found.append(np.zeros(len(NAMES)))
                continue
            weights = own[:, 0]
            hits = np.flatnonzero(weights)
            persons = np.flatnonzero(own[:, 1])
            near = 0
            if len(hits) and len(persons):
                at = np.searchsorted(persons, hits)
                left = np.abs(hits - persons[np.maximum(at - 1, 0)])
                right = np.abs(persons[np.minimum(at, len(persons) - 1)] - hits)
                near = int((np.minimum(left, right) <= WINDOW).sum())
            letters = max(own[:, 2].sum(), 1)
            found.append(
                np.array(
                    [
                        len(hits) / n,
                        (weights >= STRONG).sum() / n,
                        weights.sum() / n,
                        weights.max(),
                        near / n,
                        len(persons) / n,
                        own[:, 3].sum() / letters,
                        own[:, 9].sum() / n,
                        own[:, 4].sum() / n,
                        own[:, 5].sum() / n,
                        own[:, 6].sum() / n,
                        own[:, 7].sum() / n,
                        own[:, 8].sum() / n,
                        math.log1p(n),
                    ]
                )
            )
    return np.array(found).reshape(len(texts), len(NAMES))


def _featured(lexicons):
    """Adds ``features``; the row's ``part`` picks the lexicon, if there is such a column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = lexicons.value
        for batch in batches:
            texts = batch.column("_text").to_pylist()
            parts = batch.column("part").to_pylist()
            out = np.zeros((len(texts), len(NAMES)))
            for part in set(parts):
                at = [i for i, p in enumerate(parts) if p == part]
                out[at] = features([texts[i] for i in at], known[part])
            rows = pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("doc_id", "part", "toxic")] + [rows],
                names=["doc_id", "part", "toxic", "features"],
            )

    return run


FEATURED = "doc_id bigint, part int, toxic int, features array<double>"


def _entry_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts of each part and label an entry stands."""
    held: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(held)
        columns = [[k[0] for k in keys], [k[1] for k in keys], [k[2] for k in keys], [held[k] for k in keys]]
        types = (pa.int32(), pa.int32(), pa.string(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "toxic", "entry", "n"])

    for batch in batches:
        for part, toxic, text in zip(*(batch.column(n) for n in ("part", "toxic", "_text"))):
            words = {core(t) for t in text.as_py().split()}
            p, t = part.as_py(), toxic.as_py()
            held.update((p, t, e) for e in {e for w in words for e in entries(w)})
            if len(held) >= 500_000:
                yield out()
                held = Counter()
    if held:
        yield out()


def weigh(toxic: int, clean: int, all_toxic: int, all_clean: int) -> float:
    """A cautious log odds ratio: one standard error below the smoothed estimate."""
    odds = math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))
    return odds - math.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))


def lexicons(sample: DataFrame) -> dict[int, dict[str, float]]:
    """By part: half 0 gets the lexicon of half 1 and the other way round, part 2 that of both."""
    halves = sample.where("part < 2")
    counted = halves.select("part", "toxic", "_text").mapInArrow(tidy(_entry_counts), "part int, toxic int, entry string, n bigint")
    toxic, clean = F.when(F.col("toxic") == 1, F.col("n")), F.when(F.col("toxic") == 0, F.col("n"))
    sums = [
        F.coalesce(F.sum(F.when(F.col("part") == p, c)), F.lit(0)).alias(f"{name}{p}")
        for p in (0, 1)
        for name, c in (("toxic", toxic), ("clean", clean))
    ]
    # Bounded by the sample; entries that can't pass the tests are left behind.
    likely = counted.groupBy("entry").agg(*sums).where(
        f"toxic0 + toxic1 >= {MIN_TOXIC} AND 2 * (toxic0 + toxic1) > clean0 + clean1"
    )
    sizes = {(r["part"], r["toxic"]): r["count"] for r in halves.groupBy("part", "toxic").count().collect()}
    rows = likely.collect()
    found: dict[int, dict[str, float]] = {}
    for target, sources in ((0, (1,)), (1, (0,)), (2, (0, 1))):
        all_toxic = sum(sizes.get((p, 1), 0) for p in sources)
        all_clean = sum(sizes.get((p, 0), 0) for p in sources)
        found[target] = {}
        for r in rows:
            n = sum(r[f"toxic{p}"] for p in sources)
            if n >= MIN_TOXIC and (w := weigh(n, sum(r[f"clean{p}"] for p in sources), all_toxic, all_clean)) >= MIN_WEIGHT:
                found[target][r["entry"]] = w
    return found


def sample_labels(labels: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """About ``sample`` labelled ids: ``doc_id, toxic, part``."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(learn)
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = min(1.0, sample / max(known.count(), 1))
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.lit(1 << 40)) < int(share * (1 << 40))
    place = F.pmod(F.xxhash64(F.lit(SEED + 1), F.col("doc_id")), F.lit(5))
    part = F.when(place < 2, 0).when(place < 4, 1).otherwise(2)
    return known.where(draw).select("doc_id", "toxic", part.cast("int").alias("part"))


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> DataFrame:
    """``doc_id`` and ``score`` of every row. ``learn`` says which rows of ``labels`` may be learned from."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("_text"))
    # The ids are bounded by the sample's size, so they go to every task.
    drawn = written(sample_labels(labels, learn, sample).coalesce(1), "labels")
    chosen = written(texts.join(F.broadcast(drawn), "doc_id").repartition(8), "sample")
    sizes = {(r["part"] == 2, r["toxic"]): r["count"] for r in chosen.groupBy("part", "toxic").count().collect()}
    seen = {t: sum(n for (_, toxic), n in sizes.items() if toxic == t) for t in (0, 1)}
    if not all(sizes.get((part, t)) for part in (False, True) for t in (0, 1)):
        share = seen[1] / max(seen[0] + seen[1], 1)
        return texts.select("doc_id", F.lit(share).cast("double").alias("score"))

    shared = spark.sparkContext.broadcast(lexicons(chosen))
    rows = written(chosen.mapInArrow(tidy(_featured(shared)), FEATURED), "sample-features")
    rows = rows.withColumn("features", array_to_vector("features")).withColumn("label", F.col("toxic").cast("double"))
    trees = GBTClassifier(
        maxIter=TREES, maxDepth=TREE_DEPTH, stepSize=0.15, subsamplingRate=0.8, minInstancesPerNode=3, seed=SEED
    ).fit(rows.where("part < 2"))

    def raised(df: DataFrame) -> DataFrame:
        return trees.transform(df).withColumn("_chance", vector_to_array("probability")[1])

    calibration = IsotonicRegression(featuresCol="_chance", labelCol="label", predictionCol="_calibrated")
    curve = calibration.fit(raised(rows.where("part = 2")).select("_chance", "label"))
    # The curve is flat between steps; a share of the uncalibrated value keeps the order within a step.
    asked = texts.select("doc_id", "_text", F.lit(2).alias("part"), F.lit(None).cast("int").alias("toxic"))
    asked = asked.mapInArrow(tidy(_featured(shared)), FEATURED).withColumn("features", array_to_vector("features"))
    scored = curve.transform(raised(asked).select("doc_id", "_chance"))
    score = F.col("_calibrated") * 0.98 + F.col("_chance") * 0.02
    return scored.select("doc_id", F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below ``threshold``, all columns as they were.

    Ids are scored; where rows repeat an id with several texts, its highest score decides for all.
    """
    scores = toxicity_scores(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    gone = scores.where(F.col("score") >= threshold).select(F.struct("doc_id").alias("_key")).distinct()
    gone = written(gone, "toxic")
    # As a struct, a null id equals a null id.
    row = docs.select(F.struct("*").alias("_doc"), F.struct(F.col("doc_id").cast("bigint").alias("doc_id")).alias("_key"))
    likely, rest = split_by_filter(row, "_key", gone)
    return rest.select("_doc").unionByName(likely.join(gone, "_key", "left_anti").select("_doc")).select("_doc.*")


def op3_boosted_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scores = toxicity_scores(docs, labels, fold("doc_id", FOLDS) != HELD_OUT)
    return scores.select(
        "doc_id",
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


ENTRIES = {"op3_boosted_toxicity": (op3_boosted_toxicity, None)}

"""Encoding, imputing, evaluation, training and scoring queries."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions import messages as msg
from txnlens.ml import pipeline as pl
from txnlens.ml import train as tr
from txnlens.ml.evaluate import confusion_metrics, ranking_metrics
from txnlens.ml.score import score_or_reject, scored
from txnlens.ml.split import hash_split
from txnlens.registry import oracle as sql
from txnlens.registry.batch import SPLIT, SPLIT_SIDE
from txnlens.registry.streams import messages, run_to_files
from txnlens.schemas import CATEGORICAL, NUMERIC, SCORING_NAMES
from txnlens.session import once, scratch_path, settle
from txnlens.sinks.metadata import model_path, read_metadata, write_metadata
from txnlens.sources.tables import transactions

DS = "2025-05-25"
TRAINING_COLUMNS = [*pl.FEATURE_SOURCES, pl.LABEL]


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir, TRAINING_COLUMNS)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.model_input(_raw(spark, sf_dir))


def _string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.value_index(_features(spark, sf_dir))


def _onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each value's vector has its one, read from the index that the encoder takes; sizes from its metadata."""
    df = _features(spark, sf_dir)
    encoded = Pipeline(stages=pl.encoders(df)).fit(df).transform(df)
    sizes = {c: encoded.schema[f"{c}_ohe"].metadata["ml_attr"]["num_attrs"] for c in CATEGORICAL}
    return pl.by_value(
        encoded,
        CATEGORICAL,
        {
            "vector_size": lambda c: F.lit(sizes[c]),
            "set_at": lambda c: F.col(f"{c}_index").cast("int"),
        },
    )


def _filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The numbers without gaps. They are passed over for the medians, the scale and the result, so they are written first."""
    numbers = settle(_features(spark, sf_dir).select("transaction_id", *NUMERIC), "numbers")
    return pl.imputed(numbers, NUMERIC)


def _scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = pl.scaled(_filled(spark, sf_dir), NUMERIC)
    return rows.select("transaction_id", *(F.round(c, 4).alias(c) for c in NUMERIC))


def rule_scored(df: DataFrame) -> DataFrame:
    """Score by a fixed rule, so that evaluation can be checked without a model."""
    amount = F.col("transaction_amount").cast("double")
    score = F.col("is_night_time") * 0.4 + F.col("address_mismatch") * 0.3 + amount / 200000.0
    return df.select(pl.LABEL, score.alias("score"), (score >= 0.75).cast("int").alias("prediction"))


def _auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking_metrics(rule_scored(_features(spark, sf_dir)), "score", pl.LABEL)


def _confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return confusion_metrics(rule_scored(_features(spark, sf_dir)), "prediction", pl.LABEL)


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six metrics of a model that scores by the fixed rule, written and read again."""
    path = model_path(scratch_path(spark, "model"), "Fixed Rule", DS)
    ruled = rule_scored(_features(spark, sf_dir)).persist()
    found = confusion_metrics(ruled, "prediction", pl.LABEL).first().asDict()
    found |= ranking_metrics(ruled, "score", pl.LABEL).first().asDict() | {"training_time_seconds": 0.0}
    ruled.unpersist()
    write_metadata(spark, path, "Fixed Rule", DS, {name: found[name] for name in tr.METRICS})
    return read_metadata(spark, path).select(
        "model_name", "training_date", F.explode("metrics").alias("metric", "value")
    )


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors of all rows; the stages are fitted on the training side only.

    The length is that of the vector column, the sums are taken from the parts that are joined in it.
    """
    # Each stage passes over the rows, so what they read is written first.
    rows = pl.training_input(_raw(spark, sf_dir)).select("transaction_id", *CATEGORICAL, *NUMERIC)
    stored = settle(rows, "features")
    train, test = hash_split(stored, "transaction_id")
    vectors = pl.fit_preprocessor(train).transform(train.unionByName(test))
    size = vectors.schema[pl.FEATURES].metadata["ml_attr"]["num_attrs"]
    numbers = F.aggregate(vector_to_array("scaled_numbers"), F.lit(0.0), lambda a, x: a + x)
    return vectors.select(
        "transaction_id", F.lit(size).cast("bigint").alias("n_features"), F.round(numbers, 3).alias("numbers_sum")
    )


def _trained(spark: SparkSession, sf_dir: str) -> str:
    """The whole training job over the stored transactions, run once for all queries of a session.

    Leaves the store, and tables of what was tried and of the calls that were asked to train.
    """

    def build(base: str) -> None:
        def train() -> None:
            done = tr.train_and_store(_raw(spark, sf_dir), base, DS)
            tr.results_frame(spark, done.compared).coalesce(1).write.parquet(f"{base}/compared")
            grid = [
                (place, *(t.settings[k] for k in ("numTrees", "maxDepth", "minInstancesPerNode", "impurity")), t.metrics["auc"], t.metrics["recall"])
                for place, t in enumerate(done.grid, 1)
            ]
            kinds = "place INT, num_trees INT, max_depth INT, min_instances INT, impurity STRING, auc DOUBLE, recall DOUBLE"
            spark.createDataFrame(grid, kinds).coalesce(1).write.parquet(f"{base}/grid")

        calls = [(i + 1, tr.train_if_absent(spark, base, train)) for i in range(2)]
        spark.createDataFrame(calls, "call INT, trained BOOLEAN").write.parquet(f"{base}/calls")

    return once(spark, f"trained {sf_dir}", build, sf_dir)


def _rate(*columns: str):
    return sum(F.col(c).between(0, 1).cast("int") for c in columns) == len(columns)


def _ranked(column: str, order: str):
    """Whether each row is no better than those before it. One row per model."""
    from pyspark.sql import Window as W

    return F.col(column) <= F.coalesce(F.lag(column).over(W.orderBy(order)), F.lit(1.0))


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forests that were tried, whether their metrics are rates, and whether they stand best AUC first."""
    tried = spark.read.parquet(f"{_trained(spark, sf_dir)}/grid")
    told = tried.withColumn("in_range", _rate("auc", "recall")).withColumn("ranked", _ranked("auc", "place"))
    return told.select("num_trees", "max_depth", "min_instances", "impurity", "in_range", "ranked")


def _compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four learners, with the settings of the best forest: tested rows, ranges, and the order by F1."""
    from pyspark.sql import Window as W

    found = spark.read.parquet(f"{_trained(spark, sf_dir)}/compared")
    placed = found.withColumn("_place", F.row_number().over(W.orderBy(F.monotonically_increasing_id())))
    told = placed.withColumn("ranked", _ranked("f1", "_place"))
    rates = _rate("auc", "pr_auc", "recall", "precision", "f1")
    return told.select("model", F.col("tested").alias("n_tested"), rates.alias("in_range"), "ranked")


def _train_and_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored: is the winner the best by F1, which metrics are kept, and do its scores survive the store?"""
    base = _trained(spark, sf_dir)
    best = spark.read.parquet(f"{base}/compared").orderBy(F.desc("f1"), "model").first()
    _, _, meta = tr.stored(spark, base, DS)
    row = (meta["training_date"], meta["metrics"]["f1"] == best["f1"], ",".join(sorted(meta["metrics"])))
    return spark.createDataFrame([row], "training_date STRING, best_is_stored BOOLEAN, metrics STRING")


def _boosted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boosted trees alone, the slowest of the learners."""
    data = tr.prepare(_raw(spark, sf_dir))
    name = "Gradient-Boosted Trees"
    trained = tr.fit_all({name: (tr.classifiers({})[name], {})}, data)
    data.release()
    rates = _rate("auc", "pr_auc", "recall", "precision", "f1")
    return tr.results_frame(spark, trained).select("model", F.col("tested").alias("n_tested"), rates.alias("in_range"))


def _save_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by the stored winner, and by a copy of it that was stored and loaded once more."""
    fitted, model, meta = tr.stored(spark, _trained(spark, sf_dir), DS)
    again = scratch_path(spark, "models")
    tr.store(spark, again, DS, DS, fitted, tr.Trained(meta["model_name"], model, meta["metrics"], {}))
    raw = _raw(spark, sf_dir)
    # Ids repeat, so equal rows are counted on both sides.
    sides = [
        scored(raw, *pair).select("transaction_id", "probability", F.lit(sign).alias("_sign"))
        for pair, sign in (((fitted, model), 1), (tr.stored(spark, again, DS)[:2], -1))
    ]
    counted = sides[0].unionByName(sides[1]).groupBy("transaction_id", "probability").agg(
        F.count_if(F.col("_sign") == 1).alias("_n"), F.abs(F.sum("_sign")).alias("_differing")
    )
    return counted.agg(F.sum("_n").alias("n_rows"), F.sum("_differing").alias("n_differing"))


def _train_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first call trains and stores, the second finds the model and does not."""
    return spark.read.parquet(f"{_trained(spark, sf_dir)}/calls")


def _score_columns(rows: DataFrame) -> DataFrame:
    """What the records determine of their scores; the probability only has a range."""
    return rows.select(
        "transaction_id", "timestamp", F.col("amount").cast("decimal(10,2)").cast("double").alias("amount"),
        "payment_method", "product_category", "error", F.col("probability").between(0, 1).alias("in_range"),
        (F.col("is_fraud") == (F.col("probability") > 0.5)).alias("agrees"),
    )


def _score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted, model, _ = tr.stored(spark, _trained(spark, sf_dir), DS)
    return _score_columns(scored(_raw(spark, sf_dir), fitted, model))


def _score_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs of batch scoring: results without error, and rejected records with theirs."""
    fitted, model, _ = tr.stored(spark, _trained(spark, sf_dir), DS)
    results, rejected = score_or_reject(_raw(spark, sf_dir), fitted, model)
    both = results.unionByName(rejected)
    return both.select(
        "transaction_id", "timestamp", "error", F.col("probability").isNotNull().alias("is_scored")
    )


def _score_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages without label, validated and scored by the functions that score a table."""
    fitted, model, _ = tr.stored(spark, _trained(spark, sf_dir), DS)
    judged = msg.with_reason(msg.decode(messages(spark, sf_dir, names=SCORING_NAMES)), labelled=False)
    stream = msg.valid(judged, SCORING_NAMES)
    return _score_columns(run_to_files(scored(stream, fitted, model), "scored"))


def _categories(select: str) -> str:
    """SQL over (feature, value, n, place) of the four filled categorical columns."""
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, coalesce({c}, 'unknown') AS value, COUNT(*) AS n FROM tx GROUP BY 2"
        for c in CATEGORICAL
    )
    ranked = f"""
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY feature ORDER BY n DESC, value) - 1 AS INTEGER)
    AS place, CAST(COUNT(*) OVER (PARTITION BY feature) AS INTEGER) AS size
  FROM ({parts})
)"""
    return sql.over(select, sql.TX, ranked)


_MEDIANS = ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in NUMERIC)
_FILLED = ", ".join(
    f"coalesce(CAST(f.{c} AS DOUBLE), CAST(m_{c} AS DOUBLE)) AS {c}"
    if c in ("transaction_amount", "amount_per_quantity")
    else f"coalesce(f.{c}, m_{c}) AS {c}"
    for c in NUMERIC
)
FILLED = f"""
filled AS (
  SELECT transaction_id, {_FILLED} FROM feat f, (SELECT {_MEDIANS} FROM feat) m
)"""
_SCALED = ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 4) AS {c}" for c in NUMERIC
)

RULED = """
ruled AS (
  SELECT is_fraudulent, is_night_time * CAST(0.4 AS DOUBLE) + address_mismatch * CAST(0.3 AS DOUBLE)
    + CAST(transaction_amount AS DOUBLE) / CAST(200000 AS DOUBLE) AS score
  FROM feat
)"""

CONFUSION = """
confusion AS (
  SELECT COUNT(*) FILTER (score >= 0.75 AND is_fraudulent = 1) AS tp,
    COUNT(*) FILTER (score >= 0.75 AND is_fraudulent = 0) AS fp,
    COUNT(*) FILTER (score < 0.75 AND is_fraudulent = 1) AS fn,
    COUNT(*) FILTER (score < 0.75 AND is_fraudulent = 0) AS tn
  FROM ruled
),
rates AS (
  SELECT *, CAST(tp AS DOUBLE) / (tp + fp) AS p1, CAST(tp AS DOUBLE) / (tp + fn) AS r1,
    CAST(tn AS DOUBLE) / (tn + fn) AS p0, CAST(tn AS DOUBLE) / (tn + fp) AS r0,
    CAST(tp + fn AS DOUBLE) / (tp + fp + fn + tn) AS s1,
    CAST(tn + fp AS DOUBLE) / (tp + fp + fn + tn) AS s0
  FROM confusion
),
metrics AS (
  SELECT tp, fp, fn, tn, round(CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn), 8) AS recall,
    round(s1 * p1 + s0 * p0, 8) AS "precision",
    round(s1 * 2 * p1 * r1 / (p1 + r1) + s0 * 2 * p0 * r0 / (p0 + r0), 8) AS f1,
    round(p1, 8) AS fraud_precision, round(r1, 8) AS fraud_recall
  FROM rates
)"""

AUC = """
per_score AS (
  SELECT score, COUNT(*) FILTER (is_fraudulent = 1) AS pos, COUNT(*) FILTER (is_fraudulent = 0) AS neg
  FROM ruled GROUP BY score
),
curve AS (
  SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp, SUM(pos) OVER () AS p, SUM(neg) OVER () AS n
  FROM per_score WINDOW w AS (ORDER BY score DESC)
),
points AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS prec FROM curve
),
steps AS (
  SELECT *, CASE WHEN tp - pos + fp - neg > 0
    THEN CAST(tp - pos AS DOUBLE) / (tp - pos + fp - neg) ELSE prec END AS prec_before
  FROM points
)"""

RANKING = """SELECT CAST(MAX(p) AS BIGINT) AS positives, CAST(MAX(n) AS BIGINT) AS negatives,
  round(SUM(CAST(pos AS DOUBLE) * (n - fp + CAST(neg AS DOUBLE) / 2))
    / (CAST(MAX(p) AS DOUBLE) * MAX(n)), 8) AS auc,
  round(SUM(CAST(pos AS DOUBLE) * (prec + prec_before) / 2) / MAX(p), 8) AS pr_auc
FROM steps"""

_LABELLED = f"""
labelled AS (
  SELECT *, {SPLIT_SIDE} FROM feat WHERE is_fraudulent IS NOT NULL
)"""
_TRAIN_MEDIANS = ", ".join(f"quantile_disc({c}, 0.5) FILTER (split = 'train') AS m_{c}" for c in NUMERIC)
_TRAIN_FILLED = ", ".join(f"CAST(coalesce(f.{c}, m_{c}) AS DOUBLE) AS {c}" for c in NUMERIC)
_TRAIN_SUM = " + ".join(
    f"({c} - avg({c}) FILTER (split = 'train') OVER ()) / stddev_samp({c}) FILTER (split = 'train') OVER ()" for c in NUMERIC
)
_WIDTH = " + ".join(
    f"(SELECT COUNT(DISTINCT coalesce({c}, 'unknown')) + 1 FROM labelled WHERE split = 'train')" for c in CATEGORICAL
)
VECTORS = f"""
train_filled AS (
  SELECT transaction_id, split, {_TRAIN_FILLED} FROM labelled f, (SELECT {_TRAIN_MEDIANS} FROM labelled) m
)"""

TESTED = "(SELECT COUNT(*) FROM split WHERE is_fraudulent IS NOT NULL AND split = 'test')"

SCORED = """SELECT transaction_id, transaction_date AS "timestamp", CAST(transaction_amount AS DOUBLE) AS amount,
  coalesce(payment_method, 'unknown') AS payment_method, coalesce(product_category, 'unknown') AS product_category,
  CAST(NULL AS VARCHAR) AS error, true AS in_range, true AS agrees FROM tx"""

ENTRIES = {
    "ml_string_index": (
        _string_index,
        _categories("SELECT feature, value, place AS value_index, n FROM ranked"),
    ),
    "ml_onehot": (
        _onehot,
        _categories("SELECT feature, value, size + 1 AS vector_size, place AS set_at, n FROM ranked"),
    ),
    "ml_impute_median": (
        _filled,
        sql.over("SELECT * FROM filled", sql.TX, sql.FEATURES, FILLED),
    ),
    "ml_scale_numeric": (
        _scale,
        sql.over(f"SELECT transaction_id, {_SCALED} FROM filled", sql.TX, sql.FEATURES, FILLED),
    ),
    "ml_eval_auc": (
        _auc,
        sql.over(
            RANKING,
            sql.TX, sql.FEATURES, RULED, AUC,
        ),
    ),
    "ml_eval_confusion": (
        _confusion,
        sql.over("SELECT * FROM metrics", sql.TX, sql.FEATURES, RULED, CONFUSION),
    ),
    "ml_model_metadata": (
        _metadata,
        sql.over(
            f"""SELECT 'Fixed Rule' AS model_name, '{DS}' AS training_date, metric, value
            FROM (SELECT f1, "precision", recall, auc, pr_auc, CAST(0 AS DOUBLE) AS training_time_seconds
              FROM metrics, ({RANKING}))
            UNPIVOT (value FOR metric IN (f1, "precision", recall, auc, pr_auc, training_time_seconds))""",
            sql.TX, sql.FEATURES, RULED, CONFUSION, AUC,
        ),
    ),
    # Of models, the SQL gives what their input determines.
    "ml_features": (
        _vectors,
        sql.over(
            f"""SELECT transaction_id, CAST({_WIDTH} + {len(NUMERIC)} AS BIGINT) AS n_features,
            round({_TRAIN_SUM}, 3) AS numbers_sum FROM train_filled""",
            sql.TX, sql.FEATURES, _LABELLED, VECTORS,
        ),
    ),
    "ml_rf_grid": (
        _grid,
        "SELECT *, true AS in_range, true AS ranked FROM (VALUES "
        + ", ".join(
            f"({g['numTrees']}, {g['maxDepth']}, {g['minInstancesPerNode']}, '{g['impurity']}')" for g in tr.FOREST_GRID
        )
        + ") AS grid (num_trees, max_depth, min_instances, impurity)",
    ),
    "ml_compare": (
        _compare,
        sql.over(
            f"""SELECT model, {TESTED} AS n_tested, true AS in_range, true AS ranked
            FROM (VALUES {", ".join(f"('{name}')" for name in tr.MODELS)}) AS learners (model)""",
            sql.TX, SPLIT,
        ),
    ),
    "ml_train_and_store": (
        _train_and_store,
        f"SELECT '{DS}' AS training_date, true AS best_is_stored, '{','.join(sorted(tr.METRICS))}' AS metrics",
    ),
    "ml_gbt": (
        _boosted,
        sql.over(f"SELECT 'Gradient-Boosted Trees' AS model, {TESTED} AS n_tested, true AS in_range", sql.TX, SPLIT),
    ),
    "ml_save_load": (_save_load, sql.over("SELECT COUNT(*) AS n_rows, 0 AS n_differing FROM tx", sql.TX)),
    "ml_train_if_absent": (
        _train_if_absent,
        "SELECT * FROM (VALUES (1, true), (2, false)) AS calls (call, trained)",
    ),
    "ml_score_batch": (_score_batch, sql.over(SCORED, sql.TX)),
    "ml_score_rejects": (
        _score_rejects,
        sql.over(
            """SELECT transaction_id, transaction_date AS "timestamp",
            CASE WHEN coalesce(transaction_date, '') = '' THEN 'missing_date' WHEN ts IS NULL THEN 'unreadable_date' END AS error,
            coalesce(transaction_date, '') <> '' AND ts IS NOT NULL AS is_scored FROM feat""",
            sql.TX, sql.FEATURES,
        ),
    ),
    "st_score": (
        _score_stream,
        sql.over(SCORED + " WHERE transaction_date IS NOT NULL AND transaction_date <> ''", sql.TX),
    ),
}

"""Feature pipeline: index, encode, impute, assemble, scale."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    FeatureHasher,
    Imputer,
    ImputerModel,
    OneHotEncoder,
    StandardScaler,
    VectorAssembler,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.functions import features as fx
from txnlens.ml.index import IndexJoin
from txnlens.operators.ranks import quantiles, running_totals
from txnlens.schemas import CATEGORICAL, NUMERIC
from txnlens.session import scratch_path

HASH_SLOTS = 1 << 18

LABEL = "is_fraudulent"
WEIGHT = "class_weight"
FEATURES = "features"

# Columns the pipeline adds. Input that brings its own is stripped of them first.
INDEXED = [f"{name}_index" for name in CATEGORICAL]
ENCODED = [f"{name}_ohe" for name in CATEGORICAL]
IMPUTED = [f"{name}_imputed" for name in NUMERIC]
ADDED = [*INDEXED, *ENCODED, *IMPUTED, "numbers", "scaled_numbers", "raw_features", FEATURES,
         "rawPrediction", "probability", "prediction"]

FEATURE_SOURCES = [
    "transaction_id",
    "transaction_amount",
    "transaction_date",
    "payment_method",
    "product_category",
    "quantity",
    "customer_age",
    "customer_location",
    "device_used",
    "shipping_address",
    "billing_address",
    "account_age_days",
    "transaction_hour",
]


def model_input(df: DataFrame) -> DataFrame:
    """Raw transactions with the derived feature columns, for training and scoring."""
    plain = df.drop(*ADDED).withColumn("transaction_amount", F.col("transaction_amount").cast("double"))
    return fx.with_model_features(plain)


def training_input(df: DataFrame) -> DataFrame:
    """Model input of the labelled rows, weighted by class."""
    labelled = df.where(F.col(LABEL).isNotNull())
    return fx.with_class_weight(model_input(labelled), LABEL)


def by_value(df: DataFrame, columns: Sequence[str], extra: dict[str, Callable[[str], Column]] | None = None) -> DataFrame:
    """Distinct (feature, value, ...) rows of the columns with their count ``n``, in one pass."""
    rows = [
        F.struct(
            F.lit(name).alias("feature"),
            F.col(name).alias("value"),
            *(make(name).alias(out) for out, make in (extra or {}).items()),
        )
        for name in columns
    ]
    long = df.select(F.inline(F.array(*rows)))
    return long.groupBy(*long.columns).agg(F.count("*").alias("n"))


def value_index(df: DataFrame, columns: Sequence[str] = tuple(CATEGORICAL)) -> DataFrame:
    """``feature, value, n, value_index``: places by frequency, then value, from 0.

    Counted and ranked by range slices, so no task and no driver holds a vocabulary.
    """
    counted = by_value(df, columns).where(F.col("value").isNotNull()).withColumn("_rarer", -F.col("n"))
    ranked = running_totals(counted, ["_rarer", "value"], {"_place": F.lit(1)}, ["feature"])
    return ranked.select("feature", "value", "n", (F.col("_place") - 1).cast("int").alias("value_index"))


def index_join(df: DataFrame, columns: Sequence[str]) -> IndexJoin:
    """The index of ``df`` as a stage, stored in the shared scratch folder until the model is stored."""
    return IndexJoin.fit(value_index(df, columns), columns, scratch_path(df.sparkSession, "value-index"))


def encoders(df: DataFrame, hashed: Sequence[str] = ()) -> list:
    """One-hot stages. The columns named in ``hashed`` go into a fixed number of slots without an index."""
    small = [c for c in CATEGORICAL if c not in hashed]
    hashers = [
        FeatureHasher(inputCols=[c], outputCol=f"{c}_ohe", numFeatures=HASH_SLOTS) for c in hashed
    ]
    if not small:
        return hashers
    onehot = OneHotEncoder(
        inputCols=[f"{c}_index" for c in small], outputCols=[f"{c}_ohe" for c in small], handleInvalid="keep"
    )
    return [index_join(df, small), onehot, *hashers]


def fit_preprocessor(df: DataFrame, centred: bool = False, hashed: Sequence[str] = ()) -> PipelineModel:
    """Stages from model input to the feature vector, fitted on ``df``.

    Values are indexed by a joined table, so any number of them will do; ``hashed`` names categorical columns
    that go into a fixed number of slots, which keeps vectors short. ``centred`` subtracts the mean from every feature, also from the one-hot ones,
    which makes each vector as long as the vocabulary. By default only the numbers are scaled
    and the one-hot part stays sparse: trees split the same way on both, and logistic
    regression scales internally.
    """
    imputer = median_imputer(df, NUMERIC, IMPUTED)
    encoding = encoders(df, hashed)
    if centred:
        stages = [
            imputer,
            *encoding,
            VectorAssembler(
                inputCols=[*ENCODED, *IMPUTED], outputCol="raw_features", handleInvalid="keep"
            ),
            StandardScaler(inputCol="raw_features", outputCol=FEATURES, withMean=True, withStd=True),
        ]
    else:
        # Fitted before the index is joined, so the scaler's pass does not carry the joins.
        stages = [
            imputer,
            VectorAssembler(inputCols=IMPUTED, outputCol="numbers", handleInvalid="keep"),
            StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=True, withStd=True),
            *encoding,
            VectorAssembler(
                inputCols=[*ENCODED, "scaled_numbers"], outputCol=FEATURES, handleInvalid="keep"
            ),
        ]
    return Pipeline(stages=stages).fit(df)


def exact_medians(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """The middle value of each column, a value that does occur; one number per column."""
    pairs = [
        F.struct(F.lit(name).alias("column_name"), F.col(name).cast("double").alias("value"))
        for name in columns
    ]
    values = df.select(F.inline(F.array(*pairs))).where(~F.isnan("value"))
    found = quantiles(values, ["column_name"], "value", {"median": 0.5}, interpolate=False)
    return {row["column_name"]: row["median"] for row in found.collect()}


def median_imputer(df: DataFrame, columns: list[str], outputs: list[str]) -> ImputerModel:
    """Fills nulls and NaN by the exact median of the column; whole numbers stay whole.

    The medians are ranked in a distributed way. The mean of one row is that row, so fitting on a
    row of medians makes them a stage that can be stored. A column without values gets 0.
    """
    medians = exact_medians(df, columns)
    row = df.sparkSession.createDataFrame(
        [tuple(float(medians.get(c, 0.0)) for c in columns)], ", ".join(f"{c} DOUBLE" for c in columns)
    )
    return Imputer(inputCols=columns, outputCols=outputs, strategy="mean").fit(row)


def imputed(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns with their gaps filled by the stage of the pipeline."""
    filled = median_imputer(df, columns, [f"_filled_{c}" for c in columns]).transform(df)
    return filled.select(*(F.col(f"_filled_{c}").alias(c) if c in columns else F.col(c) for c in df.columns))


def scaled(df: DataFrame, columns: list[str]) -> DataFrame:
    """Each column in standard deviations from its mean, without a vector in the result."""
    from pyspark.ml.functions import vector_to_array

    assembled = VectorAssembler(inputCols=columns, outputCol="numbers").transform(df)
    scaler = StandardScaler(
        inputCol="numbers", outputCol="scaled_numbers", withMean=True, withStd=True
    ).fit(assembled)
    values = scaler.transform(assembled).withColumn("_values", vector_to_array("scaled_numbers"))
    kept = [c for c in df.columns if c not in columns]
    return values.select(*kept, *(F.col("_values")[i].alias(c) for i, c in enumerate(columns)))

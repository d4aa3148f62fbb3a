"""Profiles of raw transactions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.functions import features as fx


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, all columns in one pass; one output row per column."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).alias("nulls")) for c in df.columns]
    return counts.select(F.inline(F.array(*pairs)))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count("*").alias("n"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def class_balance(df: DataFrame) -> DataFrame:
    """Fraud and non-fraud counts, share and imbalance; no fraud gives a null imbalance."""
    fraud, other = F.col("fraud_count"), F.col("non_fraud_count")
    return fx.class_totals(df).select(
        "fraud_count",
        "non_fraud_count",
        F.round(F.try_divide(fraud, fraud + other), 6).alias("fraud_ratio"),
        F.round(F.try_divide(other, fraud), 6).alias("imbalance"),
    )


def split_ratio(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and fraud share of both splits."""
    marked = train.select(F.lit("train").alias("split"), "is_fraudulent").unionByName(
        test.select(F.lit("test").alias("split"), "is_fraudulent")
    )
    fraud = F.count_if(F.col("is_fraudulent") == 1)
    return marked.groupBy("split").agg(
        F.count("*").alias("n"), F.round(fraud / F.count("*"), 6).alias("fraud_ratio")
    )

"""Surrogate keys that last: a stored key table to which every day only adds.

A value keeps the id it got on the day it first appeared. Each day's values are held against all stored keys by
an anti-join; only the new ones are numbered, in value order, from the highest id so far upwards, and appended. Facts of all
days can be joined to one dimension then, and a day that is run again finds its values numbered already.

One job at a time may extend a key table, as for any daily table.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators.ranks import dense_ids

KEYS = "dimension STRING, value STRING, id BIGINT, since STRING"


def stored_keys(spark: SparkSession, path: str) -> DataFrame:
    """``dimension, value, id, since``: all keys, with the day they were given."""
    try:
        return spark.read.schema(KEYS).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], KEYS)


def day_values(raw: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """``dimension, value``: the distinct values of a day, all dimensions in one scan. Null is a value of its own."""
    pairs = [
        F.struct(F.lit(dimension).alias("dimension"), F.col(column).cast("string").alias("value"))
        for dimension, column in columns.items()
    ]
    return raw.select(F.inline(F.array(*pairs))).distinct()


def extend_keys(values: DataFrame, path: str, ds: str) -> DataFrame:
    """Give ids to the values that have none yet and store them as of day ``ds``; returns all keys.

    ``values`` are distinct ``dimension, value`` rows. The first day numbers them from 0 in value order, nulls first.
    """
    spark = values.sparkSession
    known = stored_keys(spark, path)
    # As structs, nulls are equal.
    pair = F.struct("dimension", "value")
    new = values.withColumn("_pair", pair).join(known.select(pair.alias("_pair")), "_pair", "left_anti").drop("_pair")
    highest = known.groupBy("dimension").agg(F.max("id").alias("_highest"))
    placed = dense_ids(new, ["dimension"], "value", "_place").join(highest, "dimension", "left")
    ids = placed.select(
        "dimension", "value", (F.coalesce(F.col("_highest") + 1, F.lit(0)) + F.col("_place")).cast("bigint").alias("id")
    )
    ids.write.mode("append").parquet(f"{path}/since={ds}")
    return stored_keys(spark, path)

"""Exploration queries over raw transactions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.functions import features as fx
from txnlens.operators.ranks import box

TOP = 10
SPIKE_DAYS = 7


def _fraud(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("is_fraudulent") == 1)


def fraud_by(raw: DataFrame, column: str) -> DataFrame:
    """Fraud rows per value; rows without a value are left out."""
    return (
        _fraud(raw)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("fraud_count"))
    )


def top_fraud(raw: DataFrame, column: str, limit: int = TOP) -> DataFrame:
    return fraud_by(raw, column).orderBy(F.desc("fraud_count"), column).limit(limit)


def transactions_by_hour(raw: DataFrame) -> DataFrame:
    return (
        raw.where(F.col("transaction_hour").isNotNull())
        .groupBy("transaction_hour")
        .agg(F.count("*").alias("transaction_count"))
        .orderBy("transaction_hour")
    )


def account_age_box(raw: DataFrame) -> DataFrame:
    return box(raw.where(F.col("is_fraudulent").isNotNull()), ["is_fraudulent"], "account_age_days")


def device_fraud(raw: DataFrame) -> DataFrame:
    return (
        raw.where(F.col("is_fraudulent").isNotNull() & F.col("device_used").isNotNull())
        .groupBy("device_used", "is_fraudulent")
        .agg(F.count("*").alias("transaction_count"))
    )


def amount_vs_age(raw: DataFrame, more: Sequence[str] = ()) -> DataFrame:
    """Points of the amount / account-age scatter; rows lacking a coordinate have no point."""
    return raw.select(
        *more,
        F.col("transaction_amount").cast("double").alias("transaction_amount"),
        "account_age_days",
        "is_fraudulent",
    ).where(
        F.col("transaction_amount").isNotNull()
        & F.col("account_age_days").isNotNull()
        & F.col("is_fraudulent").isNotNull()
    )


def scatter_sample(raw: DataFrame, size: int, seed: int = 42) -> DataFrame:
    """``size`` points of the scatter per label: those with the least hashes of their transaction.

    A point is in the sample or not whatever the partitioning, and each task sends at most ``size`` of a label
    to the shuffle.
    """
    draw = F.md5(F.concat_ws("|", F.lit(str(seed)), "transaction_id", F.coalesce("transaction_date", F.lit(""))))
    points = amount_vs_age(raw.withColumn("_draw", draw), ["transaction_id", "_draw"])
    order = W.partitionBy("is_fraudulent").orderBy("_draw", "transaction_amount", "account_age_days")
    return points.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= size).drop("_draw", "_place")


def amount_fraud_correlation(raw: DataFrame) -> DataFrame:
    amount, label = F.col("transaction_amount").cast("double"), F.col("is_fraudulent")
    return raw.agg(
        F.round(F.corr(amount, label.cast("double")), 6).alias("correlation"),
        F.count_if(amount.isNotNull() & label.isNotNull()).alias("n"),
    )


def fraud_by_hour_device(raw: DataFrame, devices: list[str]) -> DataFrame:
    """Heat map: one row per hour, one column per device.

    The device list is given, so Spark needs no extra job to find the columns.
    """
    table = (
        _fraud(raw)
        .where(F.col("transaction_hour").isNotNull())
        .groupBy("transaction_hour")
        .pivot("device_used", devices)
        .count()
    )
    return table.fillna(0, subset=devices)


def daily(raw: DataFrame) -> DataFrame:
    """One row per day: transactions, amount and fraud share."""
    day = fx.event_date("transaction_date")
    return (
        raw.select(
            day.alias("transaction_day"), "transaction_amount", "is_fraudulent"
        )
        .where(F.col("transaction_day").isNotNull())
        .groupBy("transaction_day")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("transaction_amount").cast("double").alias("total_amount"),
            F.avg(F.col("is_fraudulent").cast("double")).alias("fraud_share"),
        )
    )


def daily_spikes(raw: DataFrame, days: int = SPIKE_DAYS) -> DataFrame:
    """Days whose amount or fraud share departs from the days before.

    The window sorts one row per calendar day, a number the calendar bounds.
    """
    before = W.orderBy("transaction_day").rowsBetween(-days, -1)
    frame = daily(raw)
    columns = ["transaction_day", F.col("total_amount"), F.round("fraud_share", 6).alias("fraud_share")]
    for source, name in (("total_amount", "amount_z"), ("fraud_share", "fraud_z")):
        spread = F.stddev_samp(source).over(before)
        gap = F.col(source) - F.avg(source).over(before)
        # A spread this far below one cent or one row in a million is rounding noise.
        columns.append(F.round(F.when(spread > 1e-9, gap / spread), 4).alias(name))
    return frame.select(*columns)

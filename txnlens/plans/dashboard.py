"""Dashboard aggregates over fraud results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.functions import features as fx
from txnlens.operators.ranks import box, running_totals


def dashboard_rows(results: DataFrame) -> DataFrame:
    """Fraud results as the dashboard shows them: payment names tidied, time parsed.

    Rows whose time cannot be read are dropped; they could not be placed on any chart.
    """
    changed = {"timestamp": fx.strict_event_time("timestamp")}
    if "payment_method" in results.columns:
        changed["payment_method"] = fx.payment_name("payment_method")
    return results.withColumns(changed).where(F.col("timestamp").isNotNull())


def fraud_split(rows: DataFrame) -> DataFrame:
    """Share of fraud and normal rows; the total of two rows needs no sort."""
    kind = F.when(F.col("is_fraud"), "Fraud").otherwise("Normal")
    counts = rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def amount_box(rows: DataFrame) -> DataFrame:
    return box(rows, ["is_fraud"], "amount")


def amount_box_by_payment(rows: DataFrame) -> DataFrame:
    return box(rows, ["payment_method", "is_fraud"], "amount")


def payment_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("payment_method", "is_fraud").agg(F.count("*").alias("n"))


def fraud_rate_by_payment(rows: DataFrame) -> DataFrame:
    return rows.groupBy("payment_method").agg(
        F.round(F.avg(F.col("is_fraud").cast("int")) * 100, 6).alias("fraud_rate"),
        F.count("transaction_id").alias("n"),
    )


def payment_daily(rows: DataFrame) -> DataFrame:
    return rows.groupBy(
        F.to_date("timestamp").alias("day"), "payment_method", "is_fraud"
    ).agg(F.count("*").alias("n"))


def counters(rows: DataFrame) -> DataFrame:
    """Totals of fraud and normal rows; the same code runs on a stream."""
    return rows.groupBy("is_fraud").agg(F.count("*").alias("n"))


def cumulative_trend(rows: DataFrame) -> DataFrame:
    """Running fraud and normal totals per day; the window sees one row per day."""
    by_day = rows.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count_if("is_fraud").alias("_fraud"), F.count_if(~F.col("is_fraud")).alias("_normal")
    )
    upto = W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return by_day.select(
        "day",
        F.sum("_fraud").over(upto).alias("fraud_total"),
        F.sum("_normal").over(upto).alias("normal_total"),
    )


def trend_points(rows: DataFrame) -> DataFrame:
    """Running totals after every single message, in time and id order."""
    fraud = F.col("is_fraud").cast("bigint")
    points = rows.select("timestamp", "transaction_id", "is_fraud")
    return running_totals(
        points, ["timestamp", "transaction_id"], {"fraud_total": fraud, "normal_total": 1 - fraud}
    )


def latest(rows: DataFrame, limit: int | None = None) -> DataFrame:
    """All rows, newest first, with their ``place`` from 1; ``limit`` keeps the first ones only.

    Without a limit the rows are split by range, so no task sorts the whole history.
    """
    if limit is not None:
        newest = rows.orderBy(F.desc("timestamp"), "transaction_id").limit(limit)
        first = W.orderBy(F.desc("timestamp"), "transaction_id")
        return newest.withColumn("place", F.row_number().over(first).cast("bigint"))
    newer = rows.withColumn("_age", -F.unix_micros("timestamp"))
    placed = running_totals(newer, ["_age", "transaction_id"], {"place": F.lit(1)})
    return placed.drop("_age").orderBy("place")

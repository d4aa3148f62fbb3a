"""Dashboard aggregates from stored parts, so that new rows are read once and old ones never again.

A part has one row per day, payment method and finding: how many rows, and a mergeable sketch of their amounts. All
aggregates of the dashboard follow from parts. A daily job writes the part of its day; a stream adds the part of each
batch to the days it touches.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.operators.ranks import running_totals
from txnlens.operators.sketches import merged, sketched, sketched_box
from txnlens.sinks.daily import write_day
from txnlens.sinks.upsert import KeyedTable

PARTS = (
    "series STRING, day TIMESTAMP, payment_method STRING, is_fraud BOOLEAN, n BIGINT, "
    "amounts_n BIGINT, amounts_lowest DOUBLE, amounts_highest DOUBLE, amounts BINARY"
)
KEY = ["series", "day", "payment_method", "is_fraud"]


def parts_table(path: str) -> KeyedTable:
    return KeyedTable(path, PARTS, "series", "day", "month", 1)


def parts(rows: DataFrame) -> DataFrame:
    """The parts of dashboard rows."""
    series = F.concat_ws("|", "payment_method", F.col("is_fraud").cast("string"))
    placed = rows.withColumns({"day": F.date_trunc("day", "timestamp"), "series": series})
    return placed.groupBy(*KEY).agg(F.count("*").alias("n"), *sketched("amount"))


def added(both: DataFrame) -> DataFrame:
    """Parts of the same day, payment method and finding as one."""
    return both.groupBy(*KEY).agg(F.sum("n").alias("n"), *merged())


def fraud_split(found: DataFrame) -> DataFrame:
    kind = F.when(F.col("is_fraud"), "Fraud").otherwise("Normal")
    counts = found.groupBy(kind.alias("kind")).agg(F.sum("n").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy()), 6))


def payment_counts(found: DataFrame) -> DataFrame:
    return found.groupBy("payment_method", "is_fraud").agg(F.sum("n").alias("n"))


def fraud_rate_by_payment(found: DataFrame) -> DataFrame:
    frauds = F.coalesce(F.sum(F.when(F.col("is_fraud"), F.col("n"))), F.lit(0))
    rate = F.round(frauds / F.sum("n") * 100, 6)
    return found.groupBy("payment_method").agg(rate.alias("fraud_rate"), F.sum("n").alias("n"))


def payment_daily(found: DataFrame) -> DataFrame:
    return found.groupBy(F.to_date("day").alias("day"), "payment_method", "is_fraud").agg(F.sum("n").alias("n"))


def amount_box(found: DataFrame) -> DataFrame:
    return sketched_box(found, ["is_fraud"])


def amount_box_by_payment(found: DataFrame) -> DataFrame:
    return sketched_box(found, ["payment_method", "is_fraud"])


def cumulative_trend(found: DataFrame) -> DataFrame:
    """Running fraud and normal totals per day; the window sees one row per day."""
    by_day = found.groupBy(F.to_date("day").alias("day")).agg(
        F.coalesce(F.sum(F.when(F.col("is_fraud"), F.col("n"))), F.lit(0)).alias("_fraud"),
        F.coalesce(F.sum(F.when(~F.col("is_fraud"), F.col("n"))), F.lit(0)).alias("_normal"),
    )
    upto = W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    return by_day.select(
        "day", F.sum("_fraud").over(upto).alias("fraud_total"), F.sum("_normal").over(upto).alias("normal_total")
    )


def add_day(rows: DataFrame, base: str, ds: str) -> None:
    """Store what the dashboard needs of one day's rows; running a day again replaces it.

    Beside the parts these are the running totals after every row, counted from the start of the day, and
    the day's totals, from which the start of each day follows.
    """
    write_day(parts(rows), f"{base}/parts", ds)
    fraud = F.col("is_fraud").cast("bigint")
    points = rows.select("timestamp", "transaction_id", "is_fraud")
    counted = running_totals(points, ["timestamp", "transaction_id"], {"fraud_total": fraud, "normal_total": 1 - fraud})
    write_day(counted, f"{base}/points", ds)
    totals = rows.agg(
        F.coalesce(F.sum(fraud), F.lit(0)).alias("fraud"), F.coalesce(F.sum(1 - fraud), F.lit(0)).alias("normal")
    )
    write_day(totals, f"{base}/totals", ds)


def trend_points(spark: SparkSession, base: str) -> DataFrame:
    """Running totals after every row of all stored days; days follow each other in the order of ``ds``."""
    totals = spark.read.schema("fraud BIGINT, normal BIGINT, ds STRING").parquet(f"{base}/totals")
    # One row per day.
    before = W.orderBy("ds").rowsBetween(W.unboundedPreceding, -1)
    starts = totals.select(
        F.col("ds").alias("_ds"),
        F.coalesce(F.sum("fraud").over(before), F.lit(0)).alias("_fraud"),
        F.coalesce(F.sum("normal").over(before), F.lit(0)).alias("_normal"),
    )
    kinds = "timestamp TIMESTAMP, transaction_id STRING, is_fraud BOOLEAN, fraud_total BIGINT, normal_total BIGINT, ds STRING"
    points = spark.read.schema(kinds).parquet(f"{base}/points")
    found = points.join(starts, F.col("ds") == F.col("_ds"))
    return found.select(
        "timestamp",
        "transaction_id",
        "is_fraud",
        (F.col("fraud_total") + F.col("_fraud")).alias("fraud_total"),
        (F.col("normal_total") + F.col("_normal")).alias("normal_total"),
    )


def stored_parts(spark: SparkSession, base: str) -> DataFrame:
    """The parts of all days; none before the first day."""
    try:
        return spark.read.schema(f"{PARTS}, ds STRING").parquet(f"{base}/parts")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{PARTS}, ds STRING")

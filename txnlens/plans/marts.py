"""The six report datasets over the typed star schema, and the chart roll-up on them.

Each aggregates the fact by its foreign key before joining the dimension: the ids are
unique per dimension, so the answer is the same and only one row per id is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHART_ROW_LIMIT = 10_000


def _count_by(fact: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    counts = fact.groupBy(key).agg(F.count("*").alias("_n"))
    return (
        counts.join(dim, key)
        .groupBy(name)
        .agg(F.sum("_n").alias("transaction_count"))
        .orderBy(F.desc("transaction_count"), name)
    )


def payment_distribution(fact: DataFrame, payments: DataFrame) -> DataFrame:
    return _count_by(fact, payments, "payment_method_id", "payment_method")


def device_volume(fact: DataFrame, devices: DataFrame) -> DataFrame:
    return _count_by(fact, devices, "device_id", "device_type")


def average_amount_by_age(fact: DataFrame, customers: DataFrame) -> DataFrame:
    """Average over fact rows joined to every state row of their customer.

    Joining first would multiply a busy customer's facts by all their states. Sums per
    customer times the number of states per age group give the same weighted average.
    """
    sums = fact.groupBy("customer_id").agg(
        F.sum("transaction_amount").alias("_amount"), F.count("transaction_amount").alias("_n")
    )
    states = customers.groupBy("customer_id", "age_group").agg(F.count("*").alias("_states"))
    states = states.withColumn("_states", F.col("_states").cast("decimal(10,0)"))
    amount = F.sum(F.col("_amount") * F.col("_states")).cast("double")
    return (
        sums.join(states, "customer_id")
        .groupBy("age_group")
        .agg((amount / F.sum(F.col("_n") * F.col("_states")).cast("double")).alias("_average"))
        .select("age_group", F.round("_average", 6).alias("average_amount"))
    )


def transactions_by_month(fact: DataFrame) -> DataFrame:
    """Counts by calendar month; the same month of different years is one row."""
    ts = F.col("transaction_timestamp")
    return (
        fact.groupBy(
            F.date_format(ts, "MMMM").alias("transaction_month"),
            F.month(ts).alias("month_number"),
        )
        .agg(F.count("*").alias("transaction_count"))
        .orderBy("month_number")
    )


def fraud_proportion(fact: DataFrame) -> DataFrame:
    kind = F.when(F.col("is_fraudulent"), "Fraudulent").otherwise("Non-Fraudulent")
    return fact.groupBy(kind.alias("transaction_type")).agg(
        F.count("*").alias("transaction_count")
    )


def amount_by_category(fact: DataFrame, categories: DataFrame) -> DataFrame:
    sums = fact.groupBy("product_category_id").agg(F.sum("transaction_amount").alias("_amount"))
    return (
        sums.join(categories, "product_category_id")
        .groupBy("product_category")
        .agg(F.sum("_amount").cast("double").alias("total_transaction_amount"))
    )


def chart(
    dataset: DataFrame,
    dimensions: list[str],
    metric: Column,
    name: str,
    limit: int = CHART_ROW_LIMIT,
) -> DataFrame:
    """Roll-up a chart runs over a dataset; its row limit keeps the first rows by dimension."""
    return dataset.groupBy(*dimensions).agg(metric.alias(name)).orderBy(*dimensions).limit(limit)

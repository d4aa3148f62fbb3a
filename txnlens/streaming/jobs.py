"""Streaming jobs over message streams.

Offsets and state live in a checkpoint folder, results in files written once per batch or
in keyed tables, so a job that is restarted neither loses nor repeats rows.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txnlens.functions import messages as msg
from txnlens.plans import dashboard, increments
from txnlens.sinks.upsert import KeyedTable, upsert
from txnlens.sources.streams import FRAUD_TOPIC, TRANSACTION_TOPIC

def to_files(stream: DataFrame, path: str, name: str, **trigger) -> StreamingQuery:
    """Append a stream to Parquet files, each input row exactly once.

    By default the job works off what is there and ends; pass ``processingTime`` to keep
    it running. No batch waits for a fixed number of rows.
    """
    return (
        stream.writeStream.queryName(name)
        .format("parquet")
        .option("compression", "zstd")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def keyed_messages(results: DataFrame) -> DataFrame:
    """Result rows as ``key, value``: messages of one transaction share a partition and so keep their order."""
    value = msg.encoded_result([F.col(c) for c in results.columns])
    return results.select(F.col("transaction_id").alias("key"), value.alias("value"))


def to_broker(
    results: DataFrame, servers: str, topic: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Send result rows as messages; needs the Kafka connector on the class path."""
    return (
        keyed_messages(results)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all")
        .option("kafka.retries", "5")
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def run_id(spark: SparkSession, path: str) -> str:
    """The id that a stream's checkpoint keeps over restarts; a fresh checkpoint has another one."""
    return json.loads(spark.read.text(f"{path}/checkpoint/metadata").first()[0])["id"]


def each_batch(
    stream: DataFrame,
    path: str,
    name: str,
    act: Callable[[DataFrame, int], None],
    mode: str = "append",
    **trigger,
) -> StreamingQuery:
    return (
        stream.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", f"{path}/checkpoint")
        .foreachBatch(act)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def detected(messages: DataFrame) -> DataFrame:
    """Fraud results of the valid transaction messages."""
    return msg.valid(msg.with_reason(msg.decode(messages))).select(*msg.result_columns())


def set_aside(messages: DataFrame) -> DataFrame:
    return msg.quarantined(msg.with_reason(msg.decode(messages)))


def persist_topics(
    messages: DataFrame,
    transactions: KeyedTable,
    results: KeyedTable,
    rejected: str,
    path: str,
    name: str,
    **trigger,
) -> StreamingQuery:
    """Store both topics in their keyed tables, and what cannot be stored with its reason."""

    routes = (
        (TRANSACTION_TOPIC, msg.coerced_transactions, transactions),
        (FRAUD_TOPIC, msg.coerced_results, results),
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        run = run_id(batch.sparkSession, path)
        for topic, coerce, table in routes:
            judged = coerce(batch.where(F.col("topic") == topic))
            # Only the text of what is set aside is written, so no other is held.
            judged = judged.withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))).persist()
            try:
                failed = judged.where(F.col("reason").isNotNull()).select("reason", "value")
                failed.write.mode("overwrite").parquet(f"{rejected}/topic={topic}/batch={batch_id}")
                kept = judged.where(F.col("reason").isNull()).drop("reason", "value")
                upsert(kept, table, run, batch_id, arrival=["position"])
            finally:
                judged.unpersist()

    return each_batch(messages, path, name, store, **trigger)


def _upsert_once(changed: DataFrame, table: KeyedTable, path: str, batch_id: int) -> None:
    """Merge the changed groups of an aggregate, which are worked out once: each use would update the state again."""
    kept = changed.persist()
    try:
        upsert(kept, table, run_id(changed.sparkSession, path), batch_id, arrival=[])
    finally:
        kept.unpersist()


def live_counters(results: DataFrame, path: str, name: str, **trigger) -> StreamingQuery:
    """Running fraud and normal totals; state and output are two rows."""

    table = counter_table(path)

    def replace(totals: DataFrame, batch_id: int) -> None:
        rows = totals.select("is_fraud", F.lit(EPOCH).cast("timestamp").alias("since"), "n")
        _upsert_once(rows, table, path, batch_id)

    rows = dashboard.dashboard_rows(results)
    return each_batch(dashboard.counters(rows), path, name, replace, "complete", **trigger)


#: Totals have no time of their own.
EPOCH = "1970-01-01"


def counter_table(path: str) -> KeyedTable:
    return KeyedTable(f"{path}/data", "is_fraud BOOLEAN, since TIMESTAMP, n BIGINT", "is_fraud", "since", "year", 1)


#: The columns of a table of daily windows.
WINDOWS = "series STRING, day TIMESTAMP, payment_method STRING, is_fraud BOOLEAN, n BIGINT"


def daily_windows(
    results: DataFrame, table: KeyedTable, delay: str, path: str, name: str, **trigger
) -> StreamingQuery:
    """Counts per day, payment method and finding, corrected as late rows arrive.

    Days older than the newest row by more than ``delay`` are closed and leave the state, and rows of theirs are
    dropped; ``daily_counts`` keeps them.
    """
    rows = dashboard.dashboard_rows(results).withWatermark("timestamp", delay)
    counts = (
        rows.groupBy(F.window("timestamp", "1 day"), "payment_method", "is_fraud")
        .agg(F.count("*").alias("n"))
        .select(
            F.concat_ws("|", "payment_method", F.col("is_fraud").cast("string")).alias("series"),
            F.col("window.start").alias("day"),
            "payment_method",
            "is_fraud",
            "n",
        )
    )

    def merge(changed: DataFrame, batch_id: int) -> None:
        _upsert_once(changed, table, path, batch_id)

    return each_batch(counts, path, name, merge, "update", **trigger)


def without_repeats(rows: DataFrame, keys: list[str], time_column: str, delay: str) -> DataFrame:
    """The first of the rows that share ``keys`` within ``delay`` of each other."""
    return rows.withWatermark(time_column, delay).dropDuplicatesWithinWatermark(keys)


def live_dashboard(results: DataFrame, table: KeyedTable, path: str, name: str, **trigger) -> StreamingQuery:
    """Keep the parts that all dashboard aggregates follow from, a batch at a time.

    The table is the state: it grows by days, payment methods and findings and not by rows, and rows may come
    in any order and as late as they like.
    """

    def add(batch: DataFrame, batch_id: int) -> None:
        # Read twice by the merge: for the partitions that it touches, and for its rows.
        new = increments.parts(batch).persist()
        try:
            upsert(new, table, run_id(batch.sparkSession, path), batch_id, combine=increments.added)
        finally:
            new.unpersist()

    return each_batch(dashboard.dashboard_rows(results), path, name, add, **trigger)


#: The columns of a table of daily counts that are corrected by late rows.
DAILY_COUNTS = "series STRING, day TIMESTAMP, payment_method STRING, is_fraud BOOLEAN, n BIGINT, n_late BIGINT"


def daily_counts(
    results: DataFrame, table: KeyedTable, delay: str, path: str, name: str, **trigger
) -> StreamingQuery:
    """Counts per day, payment method and finding, in which late rows correct days that were closed.

    A day is closed once a batch has held rows newer than it by more than ``delay``. Rows of closed days would leave a
    windowed aggregation without a trace; here they go to ``<path>/late`` as they are, a folder per batch,
    and their days are counted anew, with the number of late rows beside the number of all.
    """
    newest = f"{path}/newest"

    def count(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen = _newest(spark, newest, batch_id - 1)
        closed = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        told = batch.withColumn("_late", F.coalesce(F.col("timestamp") < closed, F.lit(False))).persist()
        try:
            told.where("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            series = F.concat_ws("|", "payment_method", F.col("is_fraud").cast("string"))
            placed = told.withColumns({"day": F.date_trunc("day", "timestamp"), "series": series})
            counts = placed.groupBy("series", "day", "payment_method", "is_fraud").agg(
                F.count("*").alias("n"), F.count_if("_late").alias("n_late")
            )
            upsert(counts, table, run_id(spark, path), batch_id, combine=_counted)
            # Batches take turns in two folders, so the one before is there while this one is written.
            latest = told.agg(F.greatest(F.max("timestamp"), F.lit(seen).cast("timestamp")).alias("newest"))
            latest.coalesce(1).write.mode("overwrite").parquet(f"{newest}/{batch_id % 2}")
        finally:
            told.unpersist()

    return each_batch(dashboard.dashboard_rows(results), path, name, count, **trigger)


def _counted(both: DataFrame) -> DataFrame:
    return both.groupBy("series", "day", "payment_method", "is_fraud").agg(
        F.sum("n").alias("n"), F.sum("n_late").alias("n_late")
    )


def _newest(spark: SparkSession, path: str, batch_id: int) -> datetime | None:
    """The newest time of all batches up to ``batch_id``."""
    if batch_id < 0:
        return None
    return spark.read.schema("newest TIMESTAMP").parquet(f"{path}/{batch_id % 2}").first()[0]


def with_predictions(records: DataFrame, predictions: DataFrame, delay: str, within: str) -> DataFrame:
    """Two streams of one topic each, brought together by transaction: the first record and the first prediction.

    A prediction belongs to a record if it is made not before it and at most ``within`` later. Both sides keep
    what may still find a partner, and the ids that have been seen, for ``delay``.
    """
    first = records.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["transaction_id"])
    judged = predictions.select(
        F.col("transaction_id").alias("_id"), F.col("predicted_at"), F.col("is_fraud").alias("predicted_fraud")
    )
    judged = judged.withWatermark("predicted_at", delay).dropDuplicatesWithinWatermark(["_id"])
    after = F.col("predicted_at").between(F.col("timestamp"), F.col("timestamp") + F.expr(f"INTERVAL {within}"))
    return first.join(judged, (F.col("transaction_id") == F.col("_id")) & after).drop("_id")

"""Streaming jobs, run over the replayed tables until all input is worked off."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions import messages as msg
from txnlens.registry import oracle as sql
from txnlens.registry.storage import RAW_SQL
from txnlens.schemas import RAW_NAMES, SCORING_NAMES, STORED_RESULTS, STORED_TRANSACTIONS
from txnlens.session import once, scratch_path
from txnlens.sinks.upsert import KeyedTable, read_table
from txnlens.sources.streams import both_topics, file_stream, write_in_order, write_messages
from txnlens.sources.tables import transactions
from txnlens.streaming import jobs

# The history is streamed in the order of its days.
DELAY = "2 days"


def messages(
    spark: SparkSession, sf_dir: str, damage: bool = False, names: list[str] = RAW_NAMES, files_per_batch: int = 1000
) -> DataFrame:
    """The stored transactions as a stream of messages, encoded once per session by a batch job.

    Jobs that keep rows in their state until the watermark has passed them take few files at a time.
    """
    kind = f"messages {sf_dir} {damage} {len(names)}"
    folder = once(spark, kind, lambda base: write_messages(spark, sf_dir, f"{base}/messages", damage, names), sf_dir)
    return file_stream(spark, f"{folder}/messages", files_per_batch)


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:8]}"


def run_to_files(stream: DataFrame, kind: str) -> DataFrame:
    """All rows of a stream, through a file sink."""
    spark = stream.sparkSession
    path = scratch_path(spark, kind)
    jobs.to_files(stream, path, _name(kind)).awaitTermination()
    kinds = T.StructType([T.StructField(f.name, f.dataType) for f in stream.schema.fields])
    return spark.read.schema(kinds).parquet(f"{path}/data")


def cents(column: str):
    """A 32-bit amount as the exact two-decimal number it came from."""
    return F.col(column).cast("decimal(10,2)").cast("double").alias(column)


def _raw_rows(df: DataFrame) -> DataFrame:
    return df.withColumn("transaction_amount", cents("transaction_amount"))


def _replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = run_to_files(messages(spark, sf_dir), "replay")
    return _raw_rows(msg.decode(stored).select(*msg.record_columns()))


def _parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = msg.decode(messages(spark, sf_dir, damage=True))
    readable = decoded.where(F.col("fields").isNotNull()).select(*msg.record_columns())
    return _raw_rows(run_to_files(readable, "parsed"))


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = msg.with_reason(msg.decode(messages(spark, sf_dir, damage=True))).select("reason")
    rows = run_to_files(judged, "validated")
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


def _validated_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to score lack the label, so they are asked for the other 15 keys."""
    stream = messages(spark, sf_dir, damage=True, names=SCORING_NAMES)
    judged = msg.with_reason(msg.decode(stream), labelled=False).select("reason")
    rows = run_to_files(judged, "validated")
    return rows.groupBy("reason").agg(F.count("*").alias("n"))


def _quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_to_files(jobs.set_aside(messages(spark, sf_dir, damage=True)), "quarantine")
    return rows.select("reason", "transaction_id")


def _results(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = run_to_files(jobs.detected(messages(spark, sf_dir, damage=True)), "results")
    return rows.withColumn("amount", cents("amount"))


def _coerced_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = msg.coerced_transactions(messages(spark, sf_dir, damage=True))
    rows = run_to_files(judged.where(F.col("reason").isNull()).select(*RAW_NAMES), "coerced")
    return _raw_rows(rows).withColumn(
        "transaction_date", F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss")
    )


def _coerced_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid = msg.valid(msg.with_reason(msg.decode(messages(spark, sf_dir))))
    results = valid.select(msg.encoded_result().alias("value"), F.lit(0).alias("position"))
    judged = msg.coerced_results(results)
    kept = judged.where(F.col("reason").isNull()).drop("reason", "value", "position")
    rows = run_to_files(kept, "coerced")
    return rows.select(
        "transaction_id",
        "is_fraud",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        cents("amount"),
        "payment_method",
        "product_category",
        "error",
    )


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "routed")
    stored = KeyedTable(f"{path}/transactions", STORED_TRANSACTIONS, "transaction_id", "transaction_date", "year", 4)
    found = KeyedTable(f"{path}/fraud_results", STORED_RESULTS, "transaction_id", "timestamp", "year", 4)
    jobs.persist_topics(
        both_topics(messages(spark, sf_dir)), stored, found, f"{path}/rejected", path, _name("routed")
    ).awaitTermination()
    sides = [
        read_table(spark, stored).select(
            F.lit("transactions").alias("stored_in"),
            "transaction_id",
            F.col("transaction_date").alias("moment"),
            F.col("transaction_amount").alias("amount"),
        ),
        read_table(spark, found).select(
            F.lit("fraud_results").alias("stored_in"),
            "transaction_id",
            F.col("timestamp").alias("moment"),
            "amount",
        ),
    ]
    rows = sides[0].unionByName(sides[1])
    return rows.select(
        "stored_in",
        "transaction_id",
        F.date_format("moment", "yyyy-MM-dd HH:mm:ss").alias("moment"),
        cents("amount"),
    )


def _counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "counters")
    results = jobs.detected(messages(spark, sf_dir))
    jobs.live_counters(results, path, _name("counters")).awaitTermination()
    return read_table(spark, jobs.counter_table(path)).select("is_fraud", "n")


def _daily_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "windows")
    target = KeyedTable(f"{path}/daily", jobs.WINDOWS, "series", "day", "year", 1)
    results = jobs.detected(messages(spark, sf_dir))
    jobs.daily_windows(results, target, DELAY, path, _name("windows")).awaitTermination()
    return read_table(spark, target).select(
        F.to_date("day").alias("day"), "payment_method", "is_fraud", "n"
    )


def _without_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row delivered twice, as an at-least-once broker may do; one of each is left."""
    names = ["order_key", "line_number", "order_date", "customer_id"]

    def build(base: str) -> None:
        lines = transactions(spark, sf_dir, names).withColumn("order_date", F.to_timestamp("order_date"))
        write_in_order(lines, f"{base}/lines", F.to_date("order_date"))

    folder = once(spark, f"lines {sf_dir}", build, sf_dir)
    kinds = spark.read.parquet(f"{folder}/lines").schema
    streams = [spark.readStream.schema(kinds).parquet(f"{folder}/lines") for _ in range(2)]
    single = jobs.without_repeats(
        streams[0].union(streams[1]), ["order_key", "line_number"], "order_date", DELAY
    )
    kept = run_to_files(single, "dedup")
    return kept.withColumn("order_date", F.date_format("order_date", "yyyy-MM-dd HH:mm:ss"))


MESSAGES = """
messages AS (
  SELECT * REPLACE (
      CASE WHEN l_orderkey % 41 <> 0 AND l_orderkey % 43 = 0 THEN '' ELSE transaction_date END
        AS transaction_date,
      CASE WHEN l_orderkey % 41 <> 0 AND l_orderkey % 43 <> 0 AND l_orderkey % 47 = 0 THEN NULL
        ELSE quantity END AS quantity,
      CASE WHEN l_orderkey % 41 <> 0 THEN device_used END AS device_used),
    CASE WHEN l_orderkey % 53 = 0 THEN 'invalid_json'
         WHEN l_orderkey % 41 = 0 THEN 'missing_columns'
         WHEN transaction_date IS NULL OR l_orderkey % 43 = 0 THEN 'missing_date'
         WHEN is_fraudulent IS NULL THEN 'missing_label'
         WHEN l_orderkey % 47 = 0 THEN 'bad_type' END AS reason
  FROM tx
)"""

# Stored transactions: the date has to be complete and no number may be missing.
STORABLE = """try_strptime(transaction_date, '%Y-%m-%d %H:%M:%S') IS NOT NULL
  AND quantity IS NOT NULL AND customer_age IS NOT NULL AND transaction_hour IS NOT NULL
  AND is_fraudulent IS NOT NULL"""

ENTRIES = {
    "st_replay": (_replayed, sql.over(f"SELECT {RAW_SQL} FROM tx", sql.TX)),
    "st_parse_json": (
        _parsed,
        sql.over(
            f"SELECT {RAW_SQL} FROM messages WHERE reason IS DISTINCT FROM 'invalid_json'",
            sql.TX, MESSAGES,
        ),
    ),
    "st_validate": (
        _validated,
        sql.over("SELECT reason, COUNT(*) AS n FROM messages GROUP BY reason", sql.TX, MESSAGES),
    ),
    "st_validate_scoring": (
        _validated_scoring,
        sql.over(
            """SELECT CASE WHEN reason = 'missing_label' THEN CASE WHEN l_orderkey % 47 = 0 THEN 'bad_type' END
            ELSE reason END AS reason, COUNT(*) AS n FROM messages GROUP BY 1""",
            sql.TX, MESSAGES,
        ),
    ),
    "st_quarantine": (
        _quarantined,
        sql.over(
            """SELECT reason, CASE WHEN reason <> 'invalid_json' THEN transaction_id END
            AS transaction_id FROM messages WHERE reason IS NOT NULL""",
            sql.TX, MESSAGES,
        ),
    ),
    "st_fraud_results": (
        _results,
        sql.over(
            """SELECT transaction_id, is_fraudulent <> 0 AS is_fraud, transaction_date AS "timestamp",
            CAST(transaction_amount AS DOUBLE) AS amount, payment_method, product_category,
            CAST(NULL AS VARCHAR) AS error FROM messages WHERE reason IS NULL""",
            sql.TX, MESSAGES,
        ),
    ),
    "st_coerce_transactions": (
        _coerced_transactions,
        sql.over(
            f"""SELECT * EXCLUDE (l_orderkey, l_linenumber, l_partkey, l_suppkey, order_date, reason)
            REPLACE (CASE WHEN l_orderkey % 41 = 0 THEN 'unknown' ELSE device_used END
              AS device_used, CAST(transaction_amount AS DOUBLE) AS transaction_amount)
            FROM messages WHERE reason IS DISTINCT FROM 'invalid_json' AND {STORABLE}""",
            sql.TX, MESSAGES,
        ),
    ),
    "st_coerce_fraud": (
        _coerced_results,
        sql.over(
            """SELECT transaction_id, is_fraud, strftime(try_strptime("timestamp",
              '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS "timestamp", amount, payment_method,
            product_category, CAST(NULL AS VARCHAR) AS error FROM results
            WHERE try_strptime("timestamp", '%Y-%m-%d %H:%M:%S') IS NOT NULL""",
            sql.TX, sql.RESULTS,
        ),
    ),
    "st_route_topics": (
        _routed,
        sql.over(
            f"""SELECT 'transactions' AS stored_in, transaction_id, transaction_date AS moment,
              CAST(transaction_amount AS DOUBLE) AS amount FROM tx WHERE {STORABLE}
            UNION ALL
            SELECT 'fraud_results', transaction_id, strftime("timestamp", '%Y-%m-%d %H:%M:%S'),
              amount FROM dash""",
            sql.TX, sql.RESULTS,
        ),
    ),
    "st_counters": (
        _counters,
        sql.over("SELECT is_fraud, COUNT(*) AS n FROM dash GROUP BY 1", sql.TX, sql.RESULTS),
    ),
    "st_daily_window": (
        _daily_windows,
        sql.over(
            """SELECT CAST("timestamp" AS DATE) AS day, payment_method, is_fraud, COUNT(*) AS n
            FROM dash GROUP BY 1, 2, 3""",
            sql.TX, sql.RESULTS,
        ),
    ),
    "st_dedup": (
        _without_repeats,
        sql.over(
            """SELECT DISTINCT l_orderkey AS order_key, l_linenumber AS line_number, order_date,
            customer_id FROM tx""",
            sql.TX,
        ),
    ),
}

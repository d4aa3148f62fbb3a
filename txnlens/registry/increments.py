"""Queries over stored parts: sketches per day, dashboards that grow by day or by batch, late rows, matched streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators.sketches import sketched, sketched_box, within_error
from txnlens.plans import dashboard, increments
from txnlens.registry import batch as reg
from txnlens.registry import oracle as sql
from txnlens.registry.streams import messages, run_to_files
from txnlens.session import once, scratch_path
from txnlens.sinks.upsert import KeyedTable, read_table
from txnlens.sources.streams import file_stream, message_rows
from txnlens.sources.tables import transactions
from txnlens.streaming import jobs

DELAY = "2 days"

#: Message files of one batch where rows wait in the state.
FILES_AT_A_TIME = 4

#: First days of the periods that daily jobs of the queries stand for.
PERIODS = ["1900-01-01", "1994-01-01", "1997-01-01"]


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dashboard rows of the stored transactions, amounts as the messages have them."""
    rows = dashboard.dashboard_rows(reg.batch_results(spark, sf_dir))
    return rows.withColumn("amount", F.col("amount").cast("float"))


def _stored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dashboard rows without their category, joined once per session: daily runs and checks pass over them many times."""

    def build(base: str) -> None:
        rows = _rows(spark, sf_dir).drop("product_category")
        rows.write.option("compression", "zstd").parquet(f"{base}/rows")

    return spark.read.parquet(f"{once(spark, f'dashboard rows {sf_dir}', build, sf_dir)}/rows")


def _days(spark: SparkSession, sf_dir: str) -> str:
    """Three runs of the daily job, the second of them twice; each reads the rows of its own period."""

    def build(base: str) -> None:
        for i in (0, 1, 2, 1):
            upto = PERIODS[i + 1] if i + 1 < len(PERIODS) else "9999-01-01"
            own = (F.col("timestamp") >= PERIODS[i]) & (F.col("timestamp") < upto)
            increments.add_day(_stored_rows(spark, sf_dir).where(own), base, PERIODS[i])

    return once(spark, f"days {sf_dir}", build, sf_dir)


def _trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return increments.trend_points(spark, _days(spark, sf_dir))


def _checked(box: DataFrame, rows: DataFrame, group: list[str], column: str) -> DataFrame:
    """What rows determine of a sketched box: sizes, ends, and that each quantile is within its error."""
    found = within_error(box, rows, group, column)
    return found.withColumns({c: F.round(c, 2) for c in ("lowest", "highest")})


def _box(group: list[str]):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        box = sketched_box(increments.stored_parts(spark, _days(spark, sf_dir)), group)
        return _checked(box, _stored_rows(spark, sf_dir), group, "amount")

    return query


def _age_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account age by label, sketched per device and label and merged over the devices."""
    raw = transactions(spark, sf_dir, ["device_used", "account_age_days", "is_fraudulent"])
    raw = raw.where(F.col("is_fraudulent").isNotNull())
    parts = raw.groupBy("device_used", "is_fraudulent").agg(*sketched("account_age_days", "ages"))
    return _checked(sketched_box(parts, ["is_fraudulent"], "ages"), raw, ["is_fraudulent"], "account_age_days")


def _live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The parts that a stream of the valid messages has left, worked off once per session."""

    def build(base: str) -> None:
        results = jobs.detected(messages(spark, sf_dir))
        table = increments.parts_table(f"{base}/parts")
        jobs.live_dashboard(results, table, base, f"live_{uuid.uuid4().hex[:8]}").awaitTermination()

    return read_table(spark, increments.parts_table(f"{once(spark, f'live {sf_dir}', build, sf_dir)}/parts"))


def _live_query(build):
    return lambda spark, sf_dir: build(_live(spark, sf_dir))


def _live_box(build, group: list[str]):
    return lambda spark, sf_dir: _checked(build(_live(spark, sf_dir)), _stored_rows(spark, sf_dir), group, "amount")


def _late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in two deliveries: a fifth of them, of all days, comes after all the others."""
    path = scratch_path(spark, "late")
    table = KeyedTable(f"{path}/counts", jobs.DAILY_COUNTS, "series", "day", "year", 1)
    rows = message_rows(spark, sf_dir)
    late = F.col("position") % 5 == 0
    for part in (~late, late):
        rows.where(part).drop("transaction_date").write.mode("append").parquet(f"{path}/inbox")
        results = jobs.detected(file_stream(spark, f"{path}/inbox"))
        jobs.daily_counts(results, table, DELAY, path, f"late_{uuid.uuid4().hex[:8]}").awaitTermination()
    counts = read_table(spark, table)
    aside = spark.read.parquet(f"{path}/late").groupBy(F.to_date("timestamp").alias("day"), "payment_method", "is_fraud")
    kept = aside.agg(F.count("*").alias("n_aside"))
    found = counts.select(F.to_date("day").alias("day"), "payment_method", "is_fraud", "n", "n_late")
    joined = found.join(kept, ["day", "payment_method", "is_fraud"], "left")
    return joined.withColumn("n_aside", F.coalesce("n_aside", F.lit(0)))


def _matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records and predictions as two streams, each prediction delivered twice; ids are completed by their time.

    Both take the history in the order of its days, a few files at a time, so the state holds some days and not all.
    """
    results = dashboard.dashboard_rows(jobs.detected(messages(spark, sf_dir, files_per_batch=FILES_AT_A_TIME)))
    key = F.concat_ws("|", "transaction_id", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    records = results.select(key.alias("transaction_id"), "timestamp", "payment_method", "amount")
    again = dashboard.dashboard_rows(jobs.detected(messages(spark, sf_dir, files_per_batch=FILES_AT_A_TIME)))
    judged = again.select(
        key.alias("transaction_id"), F.expr("timestamp + INTERVAL 5 SECONDS").alias("predicted_at"), "is_fraud"
    )
    twice = judged.withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    rows = run_to_files(jobs.with_predictions(records, twice, DELAY, "1 minute"), "matched")
    return rows.select(
        "transaction_id",
        "payment_method",
        F.col("amount").cast("decimal(10,2)").cast("double").alias("amount"),
        "predicted_fraud",
    )


def _checked_sql(source: str, group: str, value: str) -> str:
    return f"""SELECT {group}, COUNT({value}) AS n, CAST(MIN({value}) AS DOUBLE) AS lowest,
      CAST(MAX({value}) AS DOUBLE) AS highest, true AS within_error FROM {source} WHERE {value} IS NOT NULL GROUP BY {group}"""


def _dash(name: str) -> str:
    return reg.ENTRIES[name][1]


ENTRIES = {
    "dash_sketch_box": (_box(["is_fraud"]), sql.over(_checked_sql("dash", "is_fraud", "amount"), sql.TX, sql.RESULTS)),
    "dash_sketch_box_payment": (
        _box(["payment_method", "is_fraud"]),
        sql.over(_checked_sql("dash", "payment_method, is_fraud", "amount"), sql.TX, sql.RESULTS),
    ),
    "eda_sketch_account_age": (
        _age_box,
        sql.over(
            _checked_sql("tx", "is_fraudulent", "account_age_days").replace("WHERE", "WHERE is_fraudulent IS NOT NULL AND"),
            sql.TX,
        ),
    ),
    "dash_trend_incremental": (_trend, _dash("dash_trend_points")),
    "st_dash_fraud_split": (_live_query(increments.fraud_split), _dash("dash_fraud_split")),
    "st_dash_payment_hist": (_live_query(increments.payment_counts), _dash("dash_payment_hist")),
    "st_dash_fraud_rate": (_live_query(increments.fraud_rate_by_payment), _dash("dash_fraud_rate_payment")),
    "st_dash_payment_daily": (_live_query(increments.payment_daily), _dash("dash_payment_daily")),
    "st_dash_cumulative_trend": (_live_query(increments.cumulative_trend), _dash("dash_cumulative_trend")),
    "st_dash_box": (
        _live_box(increments.amount_box, ["is_fraud"]),
        sql.over(_checked_sql("dash", "is_fraud", "amount"), sql.TX, sql.RESULTS),
    ),
    "st_dash_box_payment": (
        _live_box(increments.amount_box_by_payment, ["payment_method", "is_fraud"]),
        sql.over(_checked_sql("dash", "payment_method, is_fraud", "amount"), sql.TX, sql.RESULTS),
    ),
    "st_late_rows": (
        _late,
        sql.over(
            """SELECT CAST("timestamp" AS DATE) AS day, payment_method, is_fraud, COUNT(*) AS n,
            COUNT(*) FILTER (late AND "timestamp" < newest - INTERVAL 2 DAYS) AS n_late,
            COUNT(*) FILTER (late AND "timestamp" < newest - INTERVAL 2 DAYS) AS n_aside
            FROM (SELECT *, CAST(split_part(transaction_id, '-', 3) AS BIGINT) % 5 = 0 AS late FROM dash),
              (SELECT max("timestamp") AS newest FROM dash WHERE CAST(split_part(transaction_id, '-', 3) AS BIGINT) % 5 <> 0)
            GROUP BY 1, 2, 3""",
            sql.TX, sql.RESULTS,
        ),
    ),
    "st_first_match": (
        _matched,
        sql.over(
            """SELECT transaction_id || '|' || strftime("timestamp", '%Y-%m-%d %H:%M:%S') AS transaction_id,
            payment_method, amount, is_fraud AS predicted_fraud FROM dash""",
            sql.TX, sql.RESULTS,
        ),
    ),
}

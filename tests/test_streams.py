import datetime
import json

import pytest
from compare import rows
from pyspark.sql import functions as F

from test_messages import GOOD, without
from txnlens.functions import messages as msg
from txnlens.plans import dashboard
from txnlens.schemas import STORED_RESULTS, STORED_TRANSACTIONS
from txnlens.sinks.upsert import KeyedTable, read_table
from txnlens.sources.streams import FRAUD_TOPIC, TRANSACTION_TOPIC, both_topics, file_stream, write_in_order
from txnlens.streaming import jobs


def write_messages(spark, path, messages, topic=TRANSACTION_TOPIC, start=0):
    texts = [m if isinstance(m, str) else json.dumps(m) for m in messages]
    data = [(topic, t, start + i) for i, t in enumerate(texts)]
    spark.createDataFrame(data, "topic STRING, value STRING, position BIGINT").coalesce(1).write.mode(
        "append"
    ).parquet(path)


def numbered(count, **values):
    return [GOOD | {"Transaction ID": f"t{i}"} | values for i in range(count)]


@pytest.fixture
def inbox(tmp_path):
    return str(tmp_path / "inbox")


def drain(query):
    query.awaitTermination()


def test_stream_equals_batch_and_a_restart_adds_only_new_rows(spark, inbox, tmp_path):
    """23 messages in three files: no batch size leaves a tail waiting."""
    out = str(tmp_path / "out")
    damaged = [GOOD | {"Quantity": "two"}, "{broken", without("Device Used")]
    for part in (numbered(10), numbered(13)[10:], [*damaged]):
        write_messages(spark, inbox, part)

    def run():
        drain(jobs.to_files(jobs.detected(file_stream(spark, inbox, 1)), out, "results"))
        return spark.read.parquet(f"{out}/data")

    batch = jobs.detected(spark.read.parquet(inbox))
    assert rows(run()) == rows(batch) and batch.count() == 13
    assert rows(run()) == rows(batch)
    write_messages(spark, inbox, numbered(14)[13:])
    assert run().count() == 14


def test_rejects_are_kept_with_their_reason(spark, inbox, tmp_path):
    write_messages(spark, inbox, [GOOD, GOOD | {"Transaction Date": ""}, "{broken"])
    out = str(tmp_path / "out")
    drain(jobs.to_files(jobs.set_aside(file_stream(spark, inbox)), out, "rejects"))
    found = spark.read.parquet(f"{out}/data").select("reason", "transaction_id")
    assert rows(found) == [("invalid_json", None), ("missing_date", "t1")]


def test_topics_are_stored_apart_and_later_messages_win(spark, inbox, tmp_path):
    path = str(tmp_path / "job")
    stored = KeyedTable(f"{path}/t", STORED_TRANSACTIONS, "transaction_id", "transaction_date", "month", 2)
    found = KeyedTable(f"{path}/r", STORED_RESULTS, "transaction_id", "timestamp", "month", 2)
    result = {"transaction_id": "t0", "is_fraud": True, "timestamp": "2025-05-24 10:00:00", "amount": 1.5}

    def run():
        drain(jobs.persist_topics(file_stream(spark, inbox, 1), stored, found, f"{path}/x", path, "topics"))

    write_messages(spark, inbox, numbered(3) + [GOOD | {"Transaction ID": None}])
    run()
    write_messages(spark, inbox, [GOOD | {"Transaction ID": "t0", "Quantity": 9}], start=100)
    write_messages(spark, inbox, [result, result | {"timestamp": "bad"}], FRAUD_TOPIC)
    run()
    assert rows(read_table(spark, stored).select("transaction_id", "quantity")) == [
        ("t0", 9), ("t1", 2), ("t2", 2),
    ]
    assert rows(read_table(spark, found).select("transaction_id", "is_fraud", "amount")) == [("t0", True, 1.5)]
    rejected = spark.read.parquet(f"{path}/x").groupBy("topic", "reason").count()
    assert rows(rejected) == [(FRAUD_TOPIC, "bad_value", 1), (TRANSACTION_TOPIC, "missing_key", 1)]


def test_valid_transactions_are_followed_by_their_result(spark):
    messages = [(TRANSACTION_TOPIC, json.dumps(GOOD), 0), (TRANSACTION_TOPIC, "{broken", 1)]
    df = spark.createDataFrame(messages, "topic STRING, value STRING, position BIGINT")
    assert sorted(r.topic for r in both_topics(df).collect()) == [
        FRAUD_TOPIC, TRANSACTION_TOPIC, TRANSACTION_TOPIC,
    ]


def test_messages_to_the_broker_have_their_transaction_as_key(spark):
    row = [("t1", True, "2025-05-24 10:00:00")]
    found = jobs.keyed_messages(spark.createDataFrame(row, "transaction_id STRING, is_fraud BOOLEAN, timestamp STRING"))
    message = found.first()
    assert message.key == "t1" and json.loads(message.value)["is_fraud"] is True


def test_files_are_dated_in_the_order_of_their_days(spark, tmp_path):
    df = spark.range(400).selectExpr("id", "date_add(date'2025-01-01', cast(pmod(id * 7, 40) AS int)) AS day").repartition(5)
    write_in_order(df, f"{tmp_path}/out", F.col("day"))
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/out")
    seen = []
    drain(jobs.each_batch(stream, str(tmp_path), "order", lambda b, _: seen.extend(r.day for r in b.orderBy("day").collect())))
    assert len(seen) == 400 and seen == sorted(seen)


def test_topics_may_be_missing_from_the_first_batch(spark, inbox, tmp_path):
    path = str(tmp_path / "job")
    stored = KeyedTable(f"{path}/t", STORED_TRANSACTIONS, "transaction_id", "transaction_date", "month", 2)
    found = KeyedTable(f"{path}/r", STORED_RESULTS, "transaction_id", "timestamp", "month", 2)
    write_messages(spark, inbox, numbered(2))
    drain(jobs.persist_topics(file_stream(spark, inbox, 1), stored, found, f"{path}/x", path, "one"))
    assert read_table(spark, stored).count() == 2 and read_table(spark, found).count() == 0
    # Another job with a fresh checkpoint on the same tables starts at batch 0 again.
    other = str(tmp_path / "other")
    write_messages(spark, f"{inbox}2", [GOOD | {"Transaction ID": "late"}])
    drain(jobs.persist_topics(file_stream(spark, f"{inbox}2", 1), stored, found, f"{other}/x", other, "two"))
    assert sorted(r.transaction_id for r in read_table(spark, stored).collect()) == ["late", "t0", "t1"]


def test_counters_carry_on_after_a_restart(spark, inbox, tmp_path):
    path = str(tmp_path / "counters")

    def run():
        drain(jobs.live_counters(jobs.detected(file_stream(spark, inbox, 1)), path, "counters"))
        return rows(read_table(spark, jobs.counter_table(path)).select("is_fraud", "n"))

    write_messages(spark, inbox, numbered(4))
    assert run() == [(True, 4)]
    write_messages(spark, inbox, numbered(2, **{"Is Fraudulent": 0}) + numbered(1))
    assert run() == [(False, 2), (True, 5)]


def test_daily_windows_take_late_rows_until_they_close(spark, inbox, tmp_path):
    path = str(tmp_path / "windows")
    target = KeyedTable(f"{path}/daily", jobs.WINDOWS, "series", "day", "month", 1)

    def run(*dates):
        write_messages(spark, inbox, [GOOD | {"Transaction Date": f"{d} 10:00:00"} for d in dates])
        stream = jobs.detected(file_stream(spark, inbox, 1))
        drain(jobs.daily_windows(stream, target, "2 days", path, "windows"))
        return {r.day.day: r.n for r in read_table(spark, target).collect()}

    assert run("2025-05-01", "2025-05-02", "2025-05-02") == {1: 1, 2: 2}
    assert run("2025-05-01") == {1: 2, 2: 2}
    assert run("2025-05-10") == {1: 2, 2: 2, 10: 1}
    # Day 1 closed when day 10 was seen: this row is beyond the delay.
    assert run("2025-05-01", "2025-05-10") == {1: 2, 2: 2, 10: 2}


def test_repeats_within_the_delay_are_dropped(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    moment = datetime.datetime(2025, 5, 24, 10)

    def run(*ids):
        data = [(i, moment) for i in ids]
        spark.createDataFrame(data, "id STRING, at TIMESTAMP").write.mode("append").parquet(source)
        stream = spark.readStream.schema("id STRING, at TIMESTAMP").parquet(source)
        drain(jobs.to_files(jobs.without_repeats(stream, ["id"], "at", "1 hour"), out, "dedup"))
        return sorted(r.id for r in spark.read.parquet(f"{out}/data").collect())

    assert run("a", "a", "b") == ["a", "b"]
    assert run("b", "c") == ["a", "b", "c"]


def test_latest_rows_and_running_totals(spark):
    at = [datetime.datetime(2025, 5, d, 10) for d in (1, 1, 2)]
    df = spark.createDataFrame(
        [("a", True, at[0], "PayPal"), ("b", False, at[1], "PayPal"), ("c", True, at[2], "x")],
        "transaction_id STRING, is_fraud BOOLEAN, timestamp TIMESTAMP, payment_method STRING",
    )
    assert [(r.transaction_id, r.place) for r in dashboard.latest(df, 2).collect()] == [("c", 1), ("a", 2)]
    assert [(r.transaction_id, r.place) for r in dashboard.latest(df).collect()] == [("c", 1), ("a", 2), ("b", 3)]
    assert [tuple(r)[1:] for r in dashboard.cumulative_trend(df).orderBy("day").collect()] == [(1, 1), (2, 1)]
    assert [tuple(r)[3:] for r in dashboard.trend_points(df).orderBy("transaction_id").collect()] == [
        (1, 0), (1, 1), (2, 1),
    ]
    share = {r.kind: r.share for r in dashboard.fraud_split(df).collect()}
    assert share == {"Fraud": round(2 / 3, 6), "Normal": round(1 / 3, 6)}


def test_parsing_runs_once_per_message(spark):
    """The filter on the reason must not repeat the JSON parsing below it."""
    df = spark.range(1).select(F.col("id").cast("string").alias("value"), F.col("id").alias("position"))
    judged = msg.with_reason(msg.decode(df))
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    plan = msg.valid(judged)._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.unset("spark.sql.debug.maxToStringFields")
    parsing = [line.strip(" +-:")[:8] for line in plan.splitlines() if "json" in line.lower()]
    assert parsing == ["Generate"]

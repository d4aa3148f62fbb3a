import datetime

from compare import rows
from pyspark.sql import functions as F

from test_messages import GOOD
from test_streams import drain, write_messages
from txnlens.operators.sketches import RANK_ERROR, merged, sketched, sketched_box, within_error
from txnlens.plans import dashboard, eda, increments
from txnlens.sinks.upsert import KeyedTable, read_table, upsert
from txnlens.sources.streams import file_stream
from txnlens.streaming import jobs

RESULTS = "transaction_id STRING, is_fraud BOOLEAN, timestamp TIMESTAMP, amount DOUBLE, payment_method STRING"


def at(day, hour=10):
    return datetime.datetime(2025, 5, day, hour)


def results(spark, *found):
    return spark.createDataFrame(list(found), RESULTS)


def test_merged_sketches_keep_the_stated_rank_error(spark):
    skewed = spark.range(200_000).select(
        (F.col("id") % 7).alias("part"), F.lit("a").alias("g"), F.pow(F.rand(3) * 100, F.lit(3)).alias("v")
    ).persist()
    parts = skewed.groupBy("part", "g").agg(*sketched("v", "s"))
    box = sketched_box(parts, ["g"], "s")
    found = within_error(box, skewed, ["g"], "v").first()
    assert found.n == 200_000 and found.within_error is True
    ends = skewed.agg(F.min("v"), F.max("v")).first()
    assert (found.lowest, found.highest) == (ends[0], ends[1])
    wrong = box.withColumn("median", F.col("q1"))
    assert within_error(wrong, skewed, ["g"], "v").first().within_error is False
    assert RANK_ERROR < 0.25
    skewed.unpersist()


def test_sketches_of_nothing_nulls_and_single_values(spark):
    df = spark.createDataFrame(
        [("a", None), ("a", float("nan")), ("b", 3.0), ("c", 1.0), ("c", 2.0), ("c", 9.0), (None, 5.0)], "g STRING, v DOUBLE"
    )
    box = sketched_box(df.groupBy("g").agg(*sketched("v", "s")), ["g"], "s")
    assert rows(box.select("g", "n", "lowest", "median", "highest")) == [
        ("b", 1, 3.0, 3.0, 3.0), ("c", 3, 1.0, 2.0, 9.0), (None, 1, 5.0, 5.0, 5.0),
    ]
    none = df.where("false").groupBy("g").agg(*sketched("v", "s"))
    assert sketched_box(none, ["g"], "s").count() == 0
    assert none.groupBy("g").agg(*merged("s")).count() == 0


def test_parts_give_what_the_rows_give(spark):
    df = results(
        spark,
        *((f"t{i}", i % 3 == 0, at(1 + i % 4), float(i), "PayPal" if i % 2 else None) for i in range(60)),
    )
    parts = increments.parts(df)
    assert rows(increments.fraud_split(parts)) == rows(dashboard.fraud_split(df))
    assert rows(increments.payment_counts(parts)) == rows(dashboard.payment_counts(df))
    assert rows(increments.fraud_rate_by_payment(parts)) == rows(dashboard.fraud_rate_by_payment(df))
    assert rows(increments.payment_daily(parts)) == rows(dashboard.payment_daily(df))
    assert rows(increments.cumulative_trend(parts)) == rows(dashboard.cumulative_trend(df))
    twice = increments.added(parts.unionByName(parts))
    assert twice.agg(F.sum("n"), F.sum("amounts_n")).first()[:] == (120, 120)


def test_two_runs_equal_one_and_a_corrected_day_moves_the_later_ones(spark, tmp_path):
    first = results(spark, ("a", True, at(1), 1.0, "x"), ("b", False, at(1), 2.0, "x"))
    second = results(spark, ("c", True, at(2), 3.0, "y"), ("d", True, at(2, 11), 4.0, "y"))
    base = f"{tmp_path}/apart"
    assert increments.stored_parts(spark, base).count() == 0
    increments.add_day(first, base, "2025-05-01")
    increments.add_day(second, base, "2025-05-02")
    whole = first.unionByName(second)
    assert rows(increments.trend_points(spark, base)) == rows(dashboard.trend_points(whole))
    assert rows(increments.payment_counts(increments.stored_parts(spark, base))) == rows(dashboard.payment_counts(whole))
    longer = first.unionByName(results(spark, ("e", True, at(1, 12), 9.0, "x")))
    increments.add_day(longer, base, "2025-05-01")
    assert rows(increments.trend_points(spark, base)) == rows(dashboard.trend_points(longer.unionByName(second)))
    increments.add_day(first.where("false"), base, "2025-05-01")
    assert rows(increments.trend_points(spark, base)) == rows(dashboard.trend_points(second))


def test_a_live_dashboard_counts_every_batch_once(spark, tmp_path):
    inbox, path = f"{tmp_path}/inbox", f"{tmp_path}/job"
    table = increments.parts_table(f"{path}/parts")

    def run(name, *dates):
        sent = [GOOD | {"Transaction ID": f"{name}{i}", "Transaction Date": f"{d} 10:00:00"} for i, d in enumerate(dates)]
        write_messages(spark, inbox, sent)
        drain(jobs.live_dashboard(jobs.detected(file_stream(spark, inbox, 1)), table, path, "live"))
        return {r.day.day: r.n for r in increments.payment_daily(read_table(spark, table)).collect()}

    assert run("a", "2025-05-01", "2025-05-02", "2025-05-02") == {1: 1, 2: 2}
    assert run("b", "2025-05-20", "2025-05-01") == {1: 2, 2: 2, 20: 1}
    # The last batch again, as after a crash before the stream noted it.
    last = spark.read.parquet(f"{inbox}").where("false")
    batch = dashboard.dashboard_rows(jobs.detected(last))
    upsert(increments.parts(batch), table, jobs.run_id(spark, path), 1, combine=increments.added)
    assert {r.day.day: r.n for r in increments.payment_daily(read_table(spark, table)).collect()} == {1: 2, 2: 2, 20: 1}
    assert increments.amount_box(read_table(spark, table)).first().n == 5


def test_late_rows_are_set_aside_and_correct_closed_days(spark, tmp_path):
    inbox, path = f"{tmp_path}/inbox", f"{tmp_path}/job"
    table = KeyedTable(f"{path}/counts", jobs.DAILY_COUNTS, "series", "day", "month", 1)

    def run(*dates):
        write_messages(spark, inbox, [GOOD | {"Transaction Date": f"{d} 10:00:00"} for d in dates])
        drain(jobs.daily_counts(jobs.detected(file_stream(spark, inbox, 1)), table, "2 days", path, "late"))
        return {r.day.day: (r.n, r.n_late) for r in read_table(spark, table).collect()}

    def aside():
        return sorted(r.timestamp.day for r in spark.read.parquet(f"{path}/late").collect())

    assert run("2025-05-01", "2025-05-09") == {1: (1, 0), 9: (1, 0)} and aside() == []
    # Day 1 is closed, day 8 is not; order within a batch plays no part.
    assert run("2025-05-08", "2025-05-01", "2025-05-12") == {1: (2, 1), 8: (1, 0), 9: (1, 0), 12: (1, 0)}
    assert aside() == [1]
    assert run("2025-05-09")[9] == (2, 1) and aside() == [1, 9]
    # An older batch does not turn the clock back.
    assert run("2025-05-11")[11] == (1, 0) and run("2025-05-02")[2] == (1, 1)


def test_records_meet_the_first_prediction_of_their_id(spark, tmp_path):
    path = str(tmp_path)

    def send(name, data, schema):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(f"{path}/{name}")

    record, judged = "transaction_id STRING, timestamp TIMESTAMP", "transaction_id STRING, predicted_at TIMESTAMP, is_fraud BOOLEAN"

    def run():
        sides = [spark.readStream.schema(s).parquet(f"{path}/{n}") for n, s in (("records", record), ("judged", judged))]
        drain(jobs.to_files(jobs.with_predictions(*sides, "1 day", "1 hour"), f"{path}/out", "matched"))
        return rows(spark.read.parquet(f"{path}/out/data").select("transaction_id", "predicted_fraud"))

    send("records", [("a", at(1)), ("b", at(1)), ("a", at(1, 11))], record)
    send("judged", [("a", at(1), True), ("c", at(1), True)], judged)
    assert run() == [("a", True)]
    # A second finding of the same id, one too late for its record, one before its record, and one in time.
    send("judged", [("a", at(1), False), ("b", at(1, 13), True)], judged)
    send("records", [("c", at(1, 11))], record)
    assert run() == [("a", True)]
    send("records", [("d", at(2))], record)
    send("judged", [("d", at(2), False)], judged)
    assert run() == [("a", True), ("d", False)]


def test_the_sample_is_the_same_at_any_partitioning(spark):
    df = spark.range(3000).select(
        F.concat(F.lit("t"), "id").alias("transaction_id"), F.lit("x").alias("transaction_date"),
        F.col("id").cast("double").alias("transaction_amount"), F.col("id").cast("int").alias("account_age_days"),
        (F.col("id") % 50 == 0).cast("int").alias("is_fraudulent"),
    )
    found = [rows(eda.scatter_sample(df.repartition(n), 70)) for n in (1, 9)]
    assert found[0] == found[1] and len(found[0]) == 130
    plan = eda.scatter_sample(df, 70)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert rows(eda.scatter_sample(df.where("false"), 70)) == []



def test_checked_rows_are_not_shuffled_to_the_few_groups_of_a_box(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("double").alias("v"))
    found = within_error(sketched_box(df.groupBy("g").agg(*sketched("v", "s")), ["g"], "s"), df, ["g"], "v")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r.within_error for r in found.collect()] == [True] * 3


def test_daily_runs_and_checks_share_one_join_of_the_tables(spark, sf_dir, monkeypatch):
    from txnlens.registry import increments as queries

    made, rows_of = [], queries._rows
    monkeypatch.setattr(queries, "_rows", lambda *given: made.append(given) or rows_of(*given))
    monkeypatch.setattr("txnlens.session._BUILT", {})
    boxes = queries.ENTRIES["dash_sketch_box_payment"][0](spark, sf_dir)
    assert {r.within_error for r in boxes.collect()} == {True} and len(made) == 1

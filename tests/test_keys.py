from compare import rows
from pyspark.sql import functions as F

from test_star import raw_frame
from txnlens.operators.keys import day_values, extend_keys, stored_keys
from txnlens.plans.daily import run_daily, write_star
from txnlens.sinks.daily import write_day

DAY1, DAY2, DAY3 = "2025-05-23", "2025-05-24", "2025-05-25"


def values(spark, *found, dimension="d"):
    return spark.createDataFrame([(dimension, v) for v in found], "dimension STRING, value STRING")


def ids(keys, dimension="d"):
    return {r.value: r.id for r in keys.where(F.col("dimension") == dimension).collect()}


def test_ids_of_a_day_are_unchanged_by_later_days(spark, tmp_path):
    path = str(tmp_path)
    assert ids(extend_keys(values(spark, "m", None, "z"), path, DAY1)) == {None: 0, "m": 1, "z": 2}
    assert ids(extend_keys(values(spark, "a", "m", "b"), path, DAY2)) == {None: 0, "m": 1, "z": 2, "a": 3, "b": 4}
    again = extend_keys(values(spark, "m", None, "z", "c"), path, DAY1)
    assert ids(again) == {None: 0, "m": 1, "z": 2, "a": 3, "b": 4, "c": 5}
    assert {r.value: r.since for r in again.collect()}["c"] == DAY1


def test_a_day_that_is_run_again_adds_nothing(spark, tmp_path):
    first = rows(extend_keys(values(spark, "x", "y"), str(tmp_path), DAY1))
    assert rows(extend_keys(values(spark, "x", "y"), str(tmp_path), DAY1)) == first
    assert rows(extend_keys(values(spark), str(tmp_path), DAY2)) == first


def test_dimensions_are_numbered_apart(spark, tmp_path):
    path = str(tmp_path)
    extend_keys(values(spark, "x", "y"), path, DAY1)
    keys = extend_keys(values(spark, "y", dimension="e"), path, DAY2)
    assert ids(keys) == {"x": 0, "y": 1} and ids(keys, "e") == {"y": 0}


def test_ids_do_not_depend_on_partitioning(spark, tmp_path):
    many = [f"v{i:04d}" for i in range(500)]
    found = []
    for parts in (1, 7):
        path = f"{tmp_path}/{parts}"
        extend_keys(values(spark, *many[::3]).repartition(parts), path, DAY1)
        found.append(ids(extend_keys(values(spark, *many).repartition(parts), path, DAY2)))
    assert found[0] == found[1] and sorted(found[0].values()) == list(range(500))


def test_values_of_all_columns_in_one_scan(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 2)], "x STRING, y INT")
    assert rows(day_values(df, {"first": "x", "second": "y"})) == [
        ("first", "a"), ("first", None), ("second", "1"), ("second", "2"),
    ]


def test_facts_of_all_days_join_one_dimension(spark, tmp_path):
    base = str(tmp_path)
    run_daily(spark, raw_frame(spark, {"payment_method": "m"}, {"payment_method": "z"}), base, DAY1)
    run_daily(spark, raw_frame(spark, {"payment_method": "a"}, {"payment_method": "z"}), base, DAY2)
    assert rows(spark.table("dim_payment_methods")) == [("a", 2), ("z", 1)]
    facts = spark.read.parquet(f"{base}/fact_transactions")
    keys = stored_keys(spark, f"{base}/keys").where("dimension = 'dim_payment_methods'")
    joined = facts.join(keys, facts.payment_method_id == keys.id)
    assert rows(joined.select(F.col("ds").cast("string"), "value")) == [
        (DAY1, "m"), (DAY1, "z"), (DAY2, "a"), (DAY2, "z"),
    ]


def test_a_day_that_has_become_empty_is_replaced(spark, tmp_path):
    base = str(tmp_path)
    for file_format in ("parquet", "csv"):
        path = f"{base}/{file_format}"
        df = spark.createDataFrame([(1, "a")], "x INT, y STRING")
        write_day(df, path, DAY1, file_format)
        write_day(df, path, DAY2, file_format)
        write_day(df.where("false"), path, DAY2, file_format)
        stored = spark.read.schema("x INT, y STRING, ds STRING").option("header", True).format(file_format).load(path)
        assert rows(stored) == [(1, "a", DAY1)]


def test_a_star_of_an_empty_day_is_empty(spark, tmp_path):
    base = str(tmp_path)
    write_star(raw_frame(spark, {}), base, DAY3)
    write_star(raw_frame(spark, {}).where("false"), base, DAY3)
    assert spark.read.parquet(f"{base}/fact_transactions").isEmpty()
    assert not stored_keys(spark, f"{base}/keys").isEmpty()

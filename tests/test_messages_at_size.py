import datetime

import pytest
from compare import rows
from pyspark.sql import functions as F

from test_messages import GOOD
from test_streams import drain, write_messages
from txnlens.sinks.upsert import KeyedTable
from txnlens.sources import streams
from txnlens.streaming import jobs


@pytest.fixture
def tables(spark, tmp_path):
    """Order tables with a repeated and a missing parent key."""
    moment = datetime.datetime(1995, 3, 1)
    made = {
        "nation": ([(1, "FRANCE"), (2, "PERU")], "n_nationkey INT, n_name STRING"),
        "customer": ([(7, 1, "BUILDING"), (8, 2, None)], "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING"),
        "supplier": ([(3, 2), (4, None)], "s_suppkey BIGINT, s_nationkey INT"),
        "part": ([(5, "STEEL"), (6, "BRASS")], "p_partkey BIGINT, p_type STRING"),
        "orders": ([(i, 7 + i % 2, moment) for i in range(1, 300)], "o_orderkey BIGINT, o_custkey BIGINT, o_orderdate TIMESTAMP"),
        "lineitem": (
            [
                (i if i % 50 else None, 5 + i % 3, 3 + i % 2, 1, 2.0, 100.0 + i, "R", "F", moment + datetime.timedelta(days=i % 40))
                for i in range(1, 301)
            ],
            "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
            "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP",
        ),
    }
    base = str(tmp_path / "tables")
    for name, (data, kinds) in made.items():
        spark.createDataFrame(data, kinds).write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.mark.parametrize("damage", [False, True])
def test_messages_are_encoded_after_they_are_put_in_order(spark, tables, tmp_path, monkeypatch, damage):
    """The text of a message is several times as long as its sources: it takes no part in the shuffle."""
    shuffled, write = [], streams.write_in_order

    def spied(frame, path, day, *more):
        shuffled.extend(frame.columns)
        write(frame, path, day, *more)

    monkeypatch.setattr(streams, "write_in_order", spied)
    streams.write_messages(spark, tables, f"{tmp_path}/out", damage)
    assert "l_orderkey" in shuffled and not {"value", "ip_address", "transaction_id"} & set(shuffled)
    want = streams.message_rows(spark, tables, damage).drop("transaction_date")
    found = spark.read.schema(streams.FILE_SCHEMA).parquet(f"{tmp_path}/out")
    assert found.count() == 300 and rows(found) == rows(want)


def test_the_groups_of_a_stream_are_worked_out_once_for_a_batch(spark, tmp_path, monkeypatch):
    """A merge uses them for the partitions it touches and for the rows; the state is updated for the first use only."""
    inbox, kept, merge = str(tmp_path / "inbox"), [], jobs.upsert

    def spied(batch, *more, **named):
        kept.append(batch.is_cached)
        merge(batch, *more, **named)

    monkeypatch.setattr(jobs, "upsert", spied)
    write_messages(spark, inbox, [GOOD])
    found = jobs.detected(streams.file_stream(spark, inbox))
    target = KeyedTable(f"{tmp_path}/daily", jobs.WINDOWS, "series", "day", "month", 1)
    drain(jobs.daily_windows(found, target, "2 days", f"{tmp_path}/w", "windows"))
    drain(jobs.live_counters(found, f"{tmp_path}/c", "counters"))
    assert len(kept) >= 2 and all(kept)


def test_only_texts_that_are_set_aside_are_held(spark, tmp_path, monkeypatch):
    from txnlens.schemas import STORED_RESULTS, STORED_TRANSACTIONS
    from txnlens.functions import messages as msg

    held, coerce = [], msg.coerced_transactions
    inbox, path = str(tmp_path / "inbox"), str(tmp_path / "job")

    class Spied:
        def __init__(self, frame):
            self.frame = frame

        def withColumn(self, *column):
            held.extend(self.frame.withColumn(*column).select("reason", "value").collect())
            return self.frame.withColumn(*column)

        def persist(self):
            held.extend(self.frame.select("reason", "value").collect())
            return self.frame.persist()

    monkeypatch.setattr(msg, "coerced_transactions", lambda batch: Spied(coerce(batch)))
    write_messages(spark, inbox, [GOOD, "{broken"])
    stored = KeyedTable(f"{path}/t", STORED_TRANSACTIONS, "transaction_id", "transaction_date", "month", 2)
    found = KeyedTable(f"{path}/r", STORED_RESULTS, "transaction_id", "timestamp", "month", 2)
    drain(jobs.persist_topics(streams.file_stream(spark, inbox), stored, found, f"{path}/x", path, "held"))
    assert sorted((r.reason or "", r.value) for r in held) == [("", None), (msg.INVALID_JSON, "{broken")]

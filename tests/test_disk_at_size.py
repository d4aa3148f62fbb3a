import glob
import json
import os
import time

from pyspark.sql import functions as F

from test_messages import GOOD
from test_messages_at_size import tables  # noqa: F401
from test_streams import drain, write_messages
from txnlens import registry
from txnlens.functions import messages as msg
from txnlens.registry import storage
from txnlens.session import settle
from txnlens.sources import streams
from txnlens.streaming import jobs


def shuffled(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirsString() for f in glob.glob(f"{d}/**/shuffle_*.data", recursive=True)}


def test_shuffled_files_of_a_step_are_gone_at_its_end(spark):
    held = []

    def query(spark, _):
        before = shuffled(spark)
        # The plan is still held, so no collection of the driver's memory would remove its files.
        held.append(spark.range(1000).repartition(3, "id").groupBy("id").count())
        stored = settle(held[0], "groups")
        for _ in range(50):
            if not shuffled(spark) - before:
                return stored
            time.sleep(0.2)
        raise AssertionError("shuffled files stay")

    assert registry._with_settings(query)(spark, "").count() == 1000


def test_joined_lines_are_ordered_from_files_and_named_last(spark, tables, tmp_path, monkeypatch):  # noqa: F811
    """The bounds of the order are drawn without joining again, and the names of nations are not shuffled."""
    seen, removed, write, remove = [], [], streams.write_in_order, streams.remove

    def spied(frame, *more):
        seen.append((frame.columns, frame.inputFiles()))
        write(frame, *more)

    monkeypatch.setattr(streams, "write_in_order", spied)
    monkeypatch.setattr(streams, "remove", lambda spark, path: (removed.append(path), remove(spark, path)))
    streams.write_messages(spark, tables, f"{tmp_path}/out")
    (columns, files), = seen
    assert "s_nationkey" in columns and not any("nation" in c and c not in ("s_nationkey", "c_nationkey") for c in columns)
    assert files and all(removed[0].split("/")[-1] in f for f in files)
    assert not os.path.exists(removed[0].removeprefix("file://"))


def test_messages_lie_in_the_order_of_their_days(spark, tables, tmp_path):  # noqa: F811
    """Joins end an order, so the names come before the sort."""
    streams.write_messages(spark, tables, f"{tmp_path}/out")
    found = 0
    for file in glob.glob(f"{tmp_path}/out/*.parquet"):
        decoded = msg.decode(spark.read.schema(streams.FILE_SCHEMA).parquet(file).coalesce(1))
        days = [r[0] for r in decoded.select(F.to_date(F.col("record")["Transaction Date"].try_cast("timestamp"))).collect()]
        # Dates that are null or not complete have no day in the order.
        days = [d for d in days if d is not None]
        found += len(days)
        assert sum(a > b for a, b in zip(days, days[1:])) <= 2
    assert found > 250


def test_landed_text_and_streamed_rows_are_compressed(spark, tables, tmp_path):  # noqa: F811
    assert all(f.endswith(".csv.gz") for f in storage.ENTRIES["src_partition_pruned"][0](spark, tables).inputFiles())
    typed = storage.ENTRIES["src_star_typed"][0](spark, tables)
    assert typed.count() == 300 and all(f.endswith(".csv.gz") for f in typed.inputFiles())
    write_messages(spark, str(tmp_path / "inbox"), [GOOD])
    drain(jobs.to_files(streams.file_stream(spark, str(tmp_path / "inbox")), str(tmp_path / "job"), "kept"))
    files = glob.glob(f"{tmp_path}/job/data/*.parquet")
    assert files and all(".zstd." in f for f in files)
    assert spark.read.parquet(*files).first()["value"] == json.dumps(GOOD)


def test_rows_are_joined_once_for_all_landed_days(spark, tables, monkeypatch):  # noqa: F811
    landed, land = [], storage.land
    monkeypatch.setattr(storage, "land", lambda df, *more: (landed.extend(df.inputFiles()), land(df, *more)))
    # Six lines have no order key, so no day.
    assert storage.ENTRIES["src_partition_pruned"][0](spark, tables).count() == 294
    assert landed and not any("lineitem" in f for f in landed)

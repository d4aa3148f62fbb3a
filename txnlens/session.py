"""Session settings and the shared scratch folder."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A restart goes on from the last batch; states of older ones need not be kept.
    "spark.sql.streaming.minBatchesToRetain": "2",
    # Stream state in RocksDB may outgrow executor memory.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}

# Spark removes the shuffled files of a job's step once the step has ended. By itself it waits until the driver's memory
# fills, so that a job of several steps holds the files of all of them.
RELEASING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def session(app: str = "txnlens", **conf: str) -> SparkSession:
    """Build or get a session. The master comes from spark-submit, never from here."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**SESSION_CONF, **RELEASING, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_settings(spark: SparkSession) -> None:
    """Apply the settings to a session somebody else built."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)


def release_shuffles(spark: SparkSession) -> None:
    """Have the shuffled files of each step removed at its end, in a session somebody else built."""
    for key, value in RELEASING.items():
        spark.conf.set(key, value)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, as in a local session, a folder below
    the warehouse is used; a cluster without the setting needs a warehouse that all machines reach.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    own = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    spark.sparkContext.setCheckpointDir(own)
    return own


#: Scratch paths of this process, in the order in which they were handed out.
_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    _MADE.append(f"{scratch_root(spark)}/txnlens/{name}-{uuid.uuid4().hex}")
    return _MADE[-1]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of scratch tables that nothing reads any more."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def scratch_of_a_job(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables that a job made once it has ended and its results are stored elsewhere."""
    before = len(_MADE)
    try:
        yield
    finally:
        for path in _MADE[before:]:
            remove(spark, path)
        gone = set(_MADE[before:])
        del _MADE[before:]
        for key in [k for k, path in _BUILT.items() if path in gone]:
            del _BUILT[key]


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The result survives lost executors, is not recomputed by later stages, and carries
    its measured file size, from which Catalyst itself picks broadcast or shuffle joins.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_BUILT: dict[tuple[str, str, str | None], str] = {}


def table_files(spark: SparkSession, folder: str) -> str:
    """A mark of the files that the tables of ``folder`` have now: names, sizes and times of change."""
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/*.parquet")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    for table in fs.globStatus(pattern) or []:
        files = fs.listStatus(table.getPath()) if table.isDirectory() else [table]
        found += [(f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in files]
    return hashlib.sha256(repr(sorted(found)).encode()).hexdigest()


def once(spark: SparkSession, name: str, build: Callable[[str], None], source: str | None = None) -> str:
    """A folder that ``build`` fills, once per application; later calls get the same folder.

    What is made of the tables in the folder ``source`` is made again once one of their files has changed.
    """
    key = (spark.sparkContext.applicationId, name, source and table_files(spark, source))
    if key not in _BUILT:
        path = scratch_path(spark, "built")
        build(path)
        _BUILT[key] = path
    return _BUILT[key]

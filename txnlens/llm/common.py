"""What the corpus operators share: reading tables, text forms, written intermediate tables."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.session import scratch_path, use_settings

#: Bytes of ASCII white space, as a class of regular expressions.
BLANKS = r"[\x20\x09-\x0D]+"

#: Rows that Python workers hold at once: documents can be long.
BATCH_ROWS = 512


def prepare(spark: SparkSession) -> None:
    """Session settings that the operators rely on."""
    use_settings(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, or to ``folder``, which its maker removes.

    The files survive lost executors, fix row numbers taken before, and tell the planner
    their size.
    """
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Have the driver find the plans that nobody holds any more, so that Spark removes the files they shuffled.

    It does so by itself only when the driver's memory fills, which large tables do not hasten.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def whole_text(name: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def tidy(run: Callable) -> Callable:
    """``run`` over batches, giving memory back to the system at its end.

    Python workers live on between tasks and stages; without this, what one stage needed stays with
    them while the next one runs.
    """

    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return tidied


def fold(name: str, folds: int) -> Column:
    """crc32 of the id's text, modulo ``folds``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit(""))) % F.lit(folds)


#: Bits of the fixed-size filter: 8 MB, whatever the size of the tables.
FILTER_BITS = 1 << 26
_SLICE = 1 << 15


def split_by_filter(df: DataFrame, key: str, wanted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of ``df`` whose ``key`` may be among those of ``wanted``, and those whose key is not.

    A bit per key is set in a table of ``FILTER_BITS`` bits, which is broadcast, as its size is
    fixed. So wide rows that a following join would drop are not shuffled for it. A set bit proves
    nothing: with many keys more rows pass, and the join decides.
    """

    def place(column: Column) -> Column:
        return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))

    bits = wanted.where(F.col(key).isNotNull()).select(place(F.col(key)).alias("_bit"))
    slices = bits.groupBy(F.floor(F.col("_bit") / _SLICE).alias("_slice")).agg(
        F.bitmap_construct_agg(F.col("_bit") % _SLICE).alias("_bits")
    )
    slices = F.broadcast(written(slices, "filter"))
    at = df.withColumn("_bit", place(F.col(key))).withColumn("_slice", F.floor(F.col("_bit") / _SLICE))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast((_bit % 32768) div 8 as int) + 1, 1)")), 16, 10).cast("int")
    isset = F.coalesce(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1, F.lit(False))
    told = at.join(slices, "_slice", "left").withColumn("_likely", isset & F.col(key).isNotNull())
    return told.where("_likely").select(*df.columns), told.where("NOT _likely").select(*df.columns)

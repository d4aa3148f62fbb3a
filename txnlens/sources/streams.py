"""Message streams: from a broker or from files; the stored tables written as messages."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.functions import messages as msg
from txnlens.functions.features import strict_event_time
from txnlens.functions.messages import encode
from txnlens.schemas import RAW_NAMES
from txnlens.session import remove, scratch_path
from txnlens.sources.tables import transaction_columns, transaction_lines, transactions, with_nations

# Topic names.
TRANSACTION_TOPIC = "transaction_topic"
FRAUD_TOPIC = "fraud_topic"

MESSAGE_SOURCES = [*RAW_NAMES, "order_key", "part_key"]

# What the columns of a message are made of.
LINE_COLUMNS = {
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag",
    "l_linestatus", "l_shipdate", "o_custkey", "c_nationkey", "c_mktsegment", "p_type", "s_nationkey",
}

FILE_SCHEMA = "topic STRING, value STRING, position BIGINT"


def broker_stream(
    spark: SparkSession, servers: str, topics: list[str], starting: str = "latest", **options: str
) -> DataFrame:
    """Kafka messages; needs the Kafka connector on the class path.

    The jobs here write the transaction id as the key. Messages of one key share a partition as
    long as the topic keeps its number of partitions, and then their offsets give their order.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .options(**options)
        .load()
        .select("topic", F.col("value").cast("string"), F.col("offset").alias("position"))
    )


def file_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Messages stored as Parquet files."""
    return (
        spark.readStream.schema(FILE_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    )


def write_in_order(
    rows: DataFrame,
    path: str,
    day: Column,
    shaped: Callable[[DataFrame], DataFrame] | None = None,
    completed: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Write rows as files in the order of their day, and date the files in that order.

    ``shaped`` makes the written columns of the ordered rows, so that only its input is shuffled and sorted. What
    ``completed`` joins by broadcasts is not shuffled either; it comes before the sort, as joins end the order of rows.

    A file stream takes the oldest files first, so it reads the history in time order. Only the
    names of the files come to the driver, as they do when the stream lists them.
    """
    spark = rows.sparkSession
    split = rows.withColumn("_day", day).repartitionByRange("_day")
    ordered = (completed(split) if completed else split).sortWithinPartitions("_day").drop("_day")
    (shaped(ordered) if shaped else ordered).write.option("compression", "zstd").parquet(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files = sorted((f.getPath() for f in fs.listStatus(folder)), key=lambda f: f.getName())
    newest = max((fs.getFileStatus(f).getModificationTime() for f in files), default=0)
    for age, file in enumerate(reversed(files)):
        fs.setTimes(file, newest - 1000 * age, -1)


def message_rows(
    spark: SparkSession, sf_dir: str, damage: bool = False, names: Sequence[str] = tuple(RAW_NAMES)
) -> DataFrame:
    """The stored transactions as messages with the keys of ``names``.

    With ``damage`` some messages are spoilt by fixed rules on their order key, so that
    they hold every kind of message a consumer has to set aside.
    """
    rows = transactions(spark, sf_dir, MESSAGE_SOURCES)
    return _encoded(rows, damage, names, "transaction_date")


def _encoded(rows: DataFrame, damage: bool, names: Sequence[str], *kept: str) -> DataFrame:
    value = encode(names)
    if damage:
        value = damaged(value, F.col("order_key"))
    return rows.select(
        F.lit(TRANSACTION_TOPIC).alias("topic"), value.alias("value"), F.col("part_key").alias("position"), *kept
    )


def write_messages(
    spark: SparkSession, sf_dir: str, path: str, damage: bool = False, names: Sequence[str] = tuple(RAW_NAMES)
) -> None:
    """Encode the messages once, in a batch job; streams read the files.

    The text of a message is several times as long as what it is made of, so rows are put in order before. The joined
    rows are stored between the joins and the ordering: the ordering draws its bounds from them and joins nothing again,
    and the files that the joins shuffled are gone before it shuffles its own.
    """
    lines = transaction_lines(spark, sf_dir, MESSAGE_SOURCES)
    day = F.to_date(strict_event_time(transaction_columns(["transaction_date"])[0]))

    def shaped(ordered: DataFrame) -> DataFrame:
        return _encoded(ordered.select(*transaction_columns(MESSAGE_SOURCES)), damage, names)

    def completed(split: DataFrame) -> DataFrame:
        return with_nations(spark, sf_dir, split)

    read = [c for c in lines.columns if c in LINE_COLUMNS]
    joined = scratch_path(spark, "lines")
    lines.select(*read).write.option("compression", "zstd").parquet(joined)
    write_in_order(spark.read.schema(lines.select(*read).schema).parquet(joined), path, day, shaped, completed)
    remove(spark, joined)


def damaged(value: Column, key: Column) -> Column:
    cut = F.substring(value, 1, 40)
    no_device = F.regexp_replace(value, '"Device Used":"[^"]*",', "")
    no_date = F.regexp_replace(value, '"Transaction Date":("[^"]*"|null)', '"Transaction Date":""')
    no_number = F.regexp_replace(value, '"Quantity":[^,]*', '"Quantity":"many"')
    return (
        F.when(key % 53 == 0, cut)
        .when(key % 41 == 0, no_device)
        .when(key % 43 == 0, no_date)
        .when(key % 47 == 0, no_number)
        .otherwise(value)
    )


def both_topics(rows: DataFrame) -> DataFrame:
    """The transaction messages, each valid one followed by its result message."""
    judged = msg.with_reason(msg.decode(rows))
    flat = judged.select("topic", "value", "position", "reason", *msg.record_columns())
    result = F.when(F.col("reason").isNull(), msg.encoded_result())
    pair = F.array(
        F.struct("topic", "value", "position"),
        F.struct(F.lit(FRAUD_TOPIC).alias("topic"), result.alias("value"), "position"),
    )
    return flat.select(F.inline(pair)).where(F.col("value").isNotNull())

"""CSV, JSON and landing-folder readers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.schemas import MESSAGE_KEYS, RAW, STAR_DDL


def read_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType = RAW,
    multi_line: bool = False,
    encoding: str = "UTF-8",
) -> DataFrame:
    """Transactions from CSV with a header line.

    Columns bind by position, and a cell that does not fit its type becomes null.
    ``multi_line`` is off by default: quoted line breaks make a file unsplittable, so one
    task would have to read it whole.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("multiLine", multi_line)
        .option("encoding", encoding)
        .option("escape", '"')
    )
    return reader.csv(path)


def read_first_existing(spark: SparkSession, paths: Sequence[str], **options) -> DataFrame:
    """CSV from the first of the paths that exists; the last error is raised if none does."""
    for path in paths[:-1]:
        try:
            return read_csv(spark, path, **options)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return read_csv(spark, paths[-1], **options)


def landing_path(base: str, ds: str) -> str:
    """Landing folder of one day, ``ds`` given as yyyy-MM-dd."""
    year, month, day = ds.split("-")
    return f"{base}/YYYY={year}/MM={month}/DD={day}"


def read_landing(spark: SparkSession, base: str, first: str, last: str) -> DataFrame:
    """Transactions landed from day ``first`` to day ``last``.

    The days are folder names, so the filter prunes folders before any file is opened.
    """
    fields = [*RAW.fields, *(T.StructField(name, T.StringType()) for name in ("YYYY", "MM", "DD"))]
    landed = read_csv(spark, base, schema=T.StructType(fields))
    day = F.concat_ws("-", "YYYY", "MM", "DD")
    return landed.where(day.between(first, last)).withColumn("ds", day).drop("YYYY", "MM", "DD")


def read_json_records(
    spark: SparkSession, path: str | Sequence[str], one_array: bool = False
) -> DataFrame:
    """Records with message keys; a missing key gives null.

    Files hold one record per line, or with ``one_array`` a list, read by one task per file.
    """
    keys = T.StructType([T.StructField(MESSAGE_KEYS[f.name], f.dataType) for f in RAW.fields])
    return spark.read.schema(keys).option("multiLine", one_array).json(path).toDF(*RAW.names)


def create_star_views(spark: SparkSession, base: str, ds: str, file_format: str = "csv") -> None:
    """Typed views over the star tables of one day.

    Each call points the views at the asked day, so they never stay on the first one.
    """
    for name, ddl in STAR_DDL.items():
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY VIEW {name} ({ddl}) USING {file_format} "
            f"OPTIONS (path '{base}/{name}/ds={ds}', header 'true', escape '\"')"
        )

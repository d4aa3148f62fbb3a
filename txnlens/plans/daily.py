"""The daily batch: land, model, publish views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from txnlens.operators import star
from txnlens.sinks.daily import write_day
from txnlens.sources.files import create_star_views


def write_star(raw: DataFrame, base: str, ds: str, file_format: str = "parquet") -> None:
    """Write the six star tables of one day; running a day again replaces it.

    Surrogate ids come from a key table that the days share, so they last.

    The raw rows are stored first and read back, so the source text is parsed once and not
    once per table. Text files hold what the writer has, and the views give it types;
    other formats carry types, so the tables are typed before they are written.
    """
    spark = raw.sparkSession
    write_day(raw, f"{base}/raw_transactions", ds)
    path = f"{base}/raw_transactions/ds={ds}"
    stored = spark.read.schema(raw.schema).parquet(path)
    for name, table in star.star(stored, f"{base}/keys", ds).items():
        shaped = table if file_format == "csv" else star.typed(name, table)
        write_day(shaped, f"{base}/{name}", ds, file_format)


def run_daily(spark: SparkSession, raw: DataFrame, base: str, ds: str) -> None:
    """All steps of one day, for an explicit day."""
    write_star(raw, base, ds)
    create_star_views(spark, base, ds, "parquet")

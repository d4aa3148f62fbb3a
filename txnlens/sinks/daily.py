"""Daily tables and landing folders, replaced one day at a time."""

from __future__ import annotations

from pyspark.sql import DataFrame

from txnlens.schemas import MESSAGE_KEYS
from txnlens.sources.files import landing_path


#: Text takes much less room when compressed. Such a file is read by one task, so none grows beyond so many rows.
TEXT = {"header": "true", "escape": '"', "compression": "gzip", "maxRecordsPerFile": "1000000"}


def write_day(df: DataFrame, path: str, ds: str, file_format: str = "parquet") -> None:
    """Replace the rows of day ``ds``, also by none; the other days stay as they are.

    The day's own folder is overwritten: an overwrite by partitions found in the rows would leave the old
    rows of a day that has become empty.
    """
    options = {"csv": TEXT, "parquet": {"compression": "zstd"}}.get(file_format, {})
    df.write.mode("overwrite").options(**options).format(file_format).save(f"{path}/ds={ds}")


def land(df: DataFrame, base: str, ds: str, encoding: str = "UTF-8") -> None:
    """Replace the landed raw CSV of one day, with the message keys as header."""
    (
        df.toDF(*(MESSAGE_KEYS.get(c, c) for c in df.columns))
        .write.mode("overwrite")
        .options(**TEXT, encoding=encoding)
        .csv(landing_path(base, ds))
    )

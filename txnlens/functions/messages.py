"""JSON messages: encode, decode, validate, coerce.

A transaction message is one JSON object with the raw column headers as keys. Decoding
keeps two readings of it: ``record`` with declared types, and ``fields`` with every present
key as text, because a missing key and a key holding null mean different things here.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txnlens.functions.features import strict_event_time
from txnlens.schemas import (
    FRAUD_RESULT_MESSAGE,
    MESSAGE_KEYS,
    RAW_COLUMNS,
    RAW_MESSAGE,
    RAW_NAMES,
    SCORING_NAMES,
)

UNREADABLE = "_unreadable"

# How the JSON parser hands over a bare NaN token as text.
NAN_TOKEN = '"NaN"'

# Why a message was set aside, in the order the rules are tried.
INVALID_JSON = "invalid_json"
MISSING_COLUMNS = "missing_columns"
MISSING_DATE = "missing_date"
MISSING_LABEL = "missing_label"
BAD_TYPE = "bad_type"
BAD_VALUE = "bad_value"
MISSING_KEY = "missing_key"


def encode(names: Sequence[str] = tuple(RAW_NAMES)) -> Column:
    """The transaction columns as message text; null columns stay as null keys."""
    record = F.struct(*(F.col(name).alias(MESSAGE_KEYS[name]) for name in names))
    return F.to_json(record, {"ignoreNullFields": "false"})


def decode(messages: DataFrame, schema: T.StructType = RAW_MESSAGE) -> DataFrame:
    """Add ``record`` (typed) and ``fields`` (text by key) to a frame of messages.

    Messages have their text in ``value`` and their order of arrival in ``position``.
    """
    marked = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    record = F.from_json("value", marked, {"columnNameOfCorruptRecord": UNREADABLE})
    fields = F.from_json("value", "map<string,string>")
    return _computed_once(messages, ["*"], [record.alias("record"), fields.alias("fields")])


def _computed_once(df: DataFrame, kept: list[str], columns: list[Column]) -> DataFrame:
    """Add columns that are computed once per row, whatever is filtered later.

    The optimizer moves filters below a projection and repeats its expressions for every
    use in them. It never moves them below the unnesting of a one-element array.
    """
    return df.select(*kept, F.inline(F.array(F.struct(*columns))))


def with_reason(decoded: DataFrame, labelled: bool = True) -> DataFrame:
    """Add ``reason``: null for a valid message, else the first rule it breaks.

    One badly typed value sets aside its own message only. Messages to score carry no
    label, so ``labelled=False`` asks for the other 15 keys.
    """
    names = RAW_NAMES if labelled else SCORING_NAMES
    keys = [MESSAGE_KEYS[name] for name in names]
    fields = F.col("fields")
    date = fields[MESSAGE_KEYS["transaction_date"]]
    label = fields[MESSAGE_KEYS["is_fraudulent"]]
    complete = F.size(F.array_except(F.array(*(F.lit(k) for k in keys)), F.map_keys(fields))) == 0
    reason = (
        F.when(fields.isNull(), INVALID_JSON)
        .when(~complete, MISSING_COLUMNS)
        .when(date.isNull() | (date == ""), MISSING_DATE)
    )
    if labelled:
        reason = reason.when(label.isNull(), MISSING_LABEL)
    reason = reason.when(F.col("record")[UNREADABLE].isNotNull(), BAD_TYPE)
    return decoded.withColumn("reason", reason)


def record_columns(names: Sequence[str] = tuple(RAW_NAMES)) -> list[Column]:
    """The typed columns of a decoded message. A NaN token in a text field counts as null."""
    kinds = {name: kind for name, _, kind in RAW_COLUMNS}
    columns = []
    for name in names:
        column = F.col("record")[MESSAGE_KEYS[name]]
        if isinstance(kinds[name], T.StringType):
            column = F.nullif(column, F.lit(NAN_TOKEN))
        columns.append(column.alias(name))
    return columns


def valid(judged: DataFrame, names: Sequence[str] = tuple(RAW_NAMES)) -> DataFrame:
    return judged.where(F.col("reason").isNull()).select(*record_columns(names))


def quarantined(judged: DataFrame) -> DataFrame:
    """Rejected messages with their text, their id if it can be read, and the reason."""
    rejected = judged.where(F.col("reason").isNotNull())
    id_key = MESSAGE_KEYS["transaction_id"]
    return rejected.select("reason", F.col("fields")[id_key].alias("transaction_id"), "value")


def result_columns() -> list[Column]:
    """The seven result fields of a valid transaction; its label is passed on as the finding."""
    return [
        F.col("transaction_id"),
        F.col("is_fraudulent").cast("boolean").alias("is_fraud"),
        F.col("transaction_date").alias("timestamp"),
        F.col("transaction_amount").alias("amount"),
        F.col("payment_method"),
        F.col("product_category"),
        F.lit(None).cast("string").alias("error"),
    ]


def encoded_result(columns: Sequence[Column] | None = None) -> Column:
    """Result fields as message text, null fields included."""
    fields = result_columns() if columns is None else columns
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def _as_text(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages decoded with every field of ``schema`` as text."""
    fields = [T.StructField(name, T.StringType()) for name in schema.names]
    return decode(messages, T.StructType(fields))


def _or_default(key: str, found: Column, default: Column) -> Column:
    """The value found, or the default if the key is missing and not merely null."""
    return F.coalesce(found, F.when(~F.map_contains_key("fields", key), default))


def _text(key: str) -> Column:
    return _or_default(key, F.nullif(F.col("record")[key], F.lit(NAN_TOKEN)), F.lit("unknown"))


def _number(key: str, kind: str) -> Column:
    """Number of a key; whole numbers drop their fraction, so they are read as decimals first."""
    text = F.col("record")[key]
    if kind == "float":
        text = F.when(text == NAN_TOKEN, "NaN").otherwise(text)
    return _or_default(key, text.try_cast("double").try_cast(kind), F.lit(0).cast(kind))


def _moment(key: str, now: Column) -> Column:
    return _or_default(key, strict_event_time(F.col("record")[key]), now)


def coerced_transactions(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Messages as stored transactions, with ``reason`` set where they cannot be stored.

    A missing key gets a default; a key that is present but unreadable rejects the row.
    """
    now = F.current_timestamp() if now is None else now
    columns, needed = [], []
    for name, key, kind in RAW_COLUMNS:
        if name == "transaction_date":
            columns.append(_moment(key, now).alias(name))
            needed.append(name)
        elif isinstance(kind, T.StringType):
            columns.append(_text(key).alias(name))
        else:
            columns.append(_number(key, kind.simpleString()).alias(name))
            needed.append(name)
    return _judged(_as_text(messages, RAW_MESSAGE), columns, needed)


def coerced_results(messages: DataFrame, now: Column | None = None) -> DataFrame:
    """Result messages as stored fraud results, with ``reason`` where they cannot be stored."""
    now = F.current_timestamp() if now is None else now
    record = F.col("record")
    finding = F.lower(record["is_fraud"])
    columns = [
        _text("transaction_id").alias("transaction_id"),
        F.coalesce(~finding.isin("false", "0", "0.0", ""), F.lit(False)).alias("is_fraud"),
        _moment("timestamp", now).alias("timestamp"),
        _number("amount", "float").alias("amount"),
        _text("payment_method").alias("payment_method"),
        _text("product_category").alias("product_category"),
        record["error"].alias("error"),
    ]
    return _judged(_as_text(messages, FRAUD_RESULT_MESSAGE), columns, ["timestamp", "amount"])


def _judged(decoded: DataFrame, columns: list[Column], needed: list[str]) -> DataFrame:
    """Coerced columns and the reason they cannot be stored: one of ``needed`` unreadable."""
    parsed = F.col("fields").isNotNull().alias("_parsed")
    coerced = _computed_once(decoded, ["value", "position"], [*columns, parsed])
    reason = (
        F.when(~F.col("_parsed"), INVALID_JSON)
        .when(reduce(or_, (F.col(name).isNull() for name in needed)), BAD_VALUE)
        .when(F.col("transaction_id").isNull(), MISSING_KEY)
    )
    return coerced.withColumn("reason", reason).drop("_parsed")

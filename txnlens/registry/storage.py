"""Queries that write tables to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.operators import star
from txnlens.operators.keys import stored_keys
from txnlens.plans.daily import write_star
from txnlens.registry import oracle as sql
from txnlens.schemas import MESSAGE_KEYS, RAW_NAMES, STORED_RESULTS
from txnlens.session import scratch_path, settle
from txnlens.sinks.daily import land, write_day
from txnlens.sinks.upsert import KeyedTable, read_newest_first, upsert
from txnlens.sources.files import (
    create_star_views,
    landing_path,
    read_csv,
    read_first_existing,
    read_json_records,
    read_landing,
)
from txnlens.sources.tables import transactions

DS = "2025-05-25"

RAW_SQL = ", ".join(
    "CAST(transaction_amount AS DOUBLE) AS transaction_amount" if n == "transaction_amount" else n
    for n in RAW_NAMES
)


def _exact(df: DataFrame) -> DataFrame:
    """Amounts in cents again after their way through 32-bit floats."""
    amount = F.col("transaction_amount").cast("decimal(10,2)").cast("double")
    return df.withColumn("transaction_amount", amount)


def _landed(spark: SparkSession, sf_dir: str, encoding: str = "UTF-8") -> str:
    base = scratch_path(spark, "landing")
    land(transactions(spark, sf_dir), base, DS, encoding)
    return base


def _csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed(spark, sf_dir)
    return _exact(read_csv(spark, landing_path(base, DS)))


def _latin1(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed(spark, sf_dir, "ISO-8859-1")
    return _exact(read_csv(spark, landing_path(base, DS), encoding="ISO-8859-1"))


def _fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed(spark, sf_dir)
    paths = [f"{base}/transaction_data.csv", landing_path(base, DS)]
    return _exact(read_first_existing(spark, paths))


def _pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All transactions, landed over three days; a later day is not part of the range.

    The rows are joined once for all days.
    """
    base = scratch_path(spark, "landing")
    raw = settle(transactions(spark, sf_dir, [*RAW_NAMES, "order_key"]), "raw")
    days = [raw.where(F.col("order_key") % 3 == day).drop("order_key") for day in range(3)]
    for day, part in enumerate(days):
        land(part, base, f"2025-05-{23 + day}")
    land(days[0], base, "2025-06-01")
    return _exact(read_landing(spark, base, "2025-05-23", "2025-05-25"))


def _json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "records")
    raw = transactions(spark, sf_dir)
    raw.toDF(*(MESSAGE_KEYS[c] for c in raw.columns)).write.json(path, compression="gzip")
    return _exact(read_json_records(spark, path))


def _star_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch_path(spark, "star")
    write_star(transactions(spark, sf_dir), base, DS, "csv")
    create_star_views(spark, base, DS)
    return spark.sql(
        """
        SELECT f.transaction_id, f.customer_id,
          CAST(f.transaction_amount AS DOUBLE) AS transaction_amount, f.quantity,
          f.is_fraudulent, date_format(f.transaction_timestamp, 'yyyy-MM-dd HH:mm:ss')
            AS transaction_timestamp,
          p.payment_method, c.product_category, d.device_type
        FROM fact_transactions f
        LEFT JOIN dim_payment_methods p ON f.payment_method_id = p.payment_method_id
        LEFT JOIN dim_product_categories c ON f.product_category_id = c.product_category_id
        LEFT JOIN dim_devices d ON f.device_id = d.device_id
        """
    )


def _lasting_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days, of which the second and third bring new values; the first runs once more at the end.

    Facts of all days are joined to one dimension each.
    """
    keys, base = scratch_path(spark, "keys"), scratch_path(spark, "star")
    raw = transactions(
        spark, sf_dir, ["transaction_id", "payment_method", "product_category", "device_used", "part_key"]
    )
    days = {f"2025-05-{23 + d}": raw.where(F.pmod("part_key", F.lit(3)) == d).drop("part_key") for d in range(3)}
    for ds, part in [*days.items(), next(iter(days.items()))]:
        dims = star.lasting_dims(part, keys, ds)
        write_day(star.fact_transactions(part, dims), f"{base}/facts", ds)
    facts = spark.read.parquet(f"{base}/facts").withColumn("ds", F.col("ds").cast("string"))
    known = stored_keys(spark, keys)
    for name, (_, column, key) in star.CATEGORY_DIMS.items():
        looked_up = known.where(F.col("dimension") == name)
        looked_up = looked_up.select(F.col("value").alias(column), F.col("id").cast("string").alias(key))
        facts = facts.join(looked_up, key, "left")
    columns = [c for _, column, key in star.CATEGORY_DIMS.values() for c in (column, key)]
    return facts.select("ds", "transaction_id", *columns)


def _daily_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days, the second written wrongly first and then again: it is replaced. A third has become empty."""
    path = scratch_path(spark, "daily")
    raw = transactions(
        spark, sf_dir, ["transaction_id", "transaction_amount", "payment_method", "order_key"]
    )
    even = raw.where(F.col("order_key") % 2 == 0).drop("order_key")
    odd = raw.where(F.col("order_key") % 2 == 1).drop("order_key")
    write_day(even, path, "2025-05-24")
    write_day(even, path, "2025-05-25")
    write_day(odd, path, "2025-05-25")
    write_day(even, path, "2025-05-26")
    write_day(even.where("false"), path, "2025-05-26")
    stored = spark.read.parquet(path)
    return stored.select(
        "transaction_id",
        F.col("transaction_amount").cast("double").alias("transaction_amount"),
        "payment_method",
        F.col("ds").cast("string").alias("ds"),
    )


def _upsert_twice(rows: DataFrame, table: KeyedTable, arrival: list[str]) -> None:
    """Odd suppliers arrive in a second batch, which is delivered twice."""
    second = F.col("supplier_key") % 2 == 1
    for batch_id, part in ((0, ~second), (1, second), (1, second)):
        upsert(rows.where(part), table, "two batches", batch_id, arrival)


def _upsert_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines keyed by order, line number and order date: these keys do repeat."""
    kept = (
        "transaction_id STRING, transaction_date TIMESTAMP, customer_id STRING, transaction_amount DECIMAL(10,2), "
        "payment_method STRING, quantity INT"
    )
    table = KeyedTable(scratch_path(spark, "upsert"), kept, "transaction_id", "transaction_date", "year", 4)
    names = ["order_key", "line_number", "order_date", "customer_id", "transaction_amount",
             "payment_method", "quantity", "part_key", "supplier_key"]
    raw = transactions(spark, sf_dir, names)
    rows = raw.select(
        F.concat_ws("-", F.col("order_key").cast("string"), F.col("line_number").cast("string")).alias(
            "transaction_id"
        ),
        F.to_timestamp("order_date").alias("transaction_date"),
        "customer_id",
        "transaction_amount",
        "payment_method",
        "quantity",
        "part_key",
        "supplier_key",
    )
    _upsert_twice(rows, table, ["part_key", "supplier_key"])
    return read_newest_first(spark, table).select(
        "transaction_id",
        F.date_format("transaction_date", "yyyy-MM-dd HH:mm:ss").alias("transaction_date"),
        "customer_id",
        F.col("transaction_amount").cast("double").alias("transaction_amount"),
        "payment_method",
        "quantity",
    )


def _upsert_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = KeyedTable(scratch_path(spark, "upsert"), STORED_RESULTS, "transaction_id", "timestamp", "year", 4)
    names = ["order_key", "line_number", "order_date", "transaction_amount", "is_fraudulent",
             "payment_method", "product_category", "part_key", "supplier_key"]
    raw = transactions(spark, sf_dir, names)
    rows = raw.where(F.col("is_fraudulent").isNotNull()).select(
        F.concat_ws("-", F.col("order_key").cast("string"), F.col("line_number").cast("string")).alias(
            "transaction_id"
        ),
        F.col("is_fraudulent").cast("boolean").alias("is_fraud"),
        F.to_timestamp("order_date").alias("timestamp"),
        F.col("transaction_amount").alias("amount"),
        "payment_method",
        "product_category",
        F.lit(None).cast("string").alias("error"),
        "part_key",
        "supplier_key",
    )
    _upsert_twice(rows, table, ["part_key", "supplier_key"])
    return read_newest_first(spark, table).select(
        "transaction_id",
        "is_fraud",
        F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.col("amount").cast("decimal(10,2)").cast("double").alias("amount"),
        "payment_method",
        "product_category",
        "error",
    )


def _keyed_sql(name: str, column: str) -> str:
    """Ids in the order of the first day, then the value, from 0."""
    return f"""
{name} AS (
  SELECT {column} AS value, row_number() OVER (ORDER BY min(l_partkey % 3), {column} NULLS FIRST) - 1 AS id
  FROM tx GROUP BY {column}
)"""


_RAW_ROWS = sql.over(f"SELECT {RAW_SQL} FROM tx", sql.TX)

# The last arrived line of each key. All orders by the columns that can still differ.
_LAST = """
last AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber, order_date
    ORDER BY l_suppkey % 2 DESC, l_partkey DESC, l_suppkey DESC, {rest}) AS place
  FROM tx {where}
)"""

ENTRIES = {
    "src_csv_roundtrip": (_csv, _RAW_ROWS),
    "src_latin1": (_latin1, _RAW_ROWS),
    "src_fallback": (_fallback, _RAW_ROWS),
    "src_json_records": (_json_records, _RAW_ROWS),
    "src_partition_pruned": (
        _pruned,
        sql.over(
            f"""SELECT {RAW_SQL}, '2025-05-' || (23 + l_orderkey % 3) AS ds
            FROM tx""",
            sql.TX,
        ),
    ),
    "src_star_typed": (
        _star_typed,
        sql.over(
            """SELECT transaction_id, customer_id,
            CAST(transaction_amount AS DOUBLE) AS transaction_amount, quantity,
            coalesce(is_fraudulent = 1, false) AS is_fraudulent,
            strftime(ts, '%Y-%m-%d %H:%M:%S') AS transaction_timestamp,
            payment_method, product_category, device_used AS device_type FROM feat""",
            sql.TX, sql.FEATURES,
        ),
    ),
    "star_lasting_keys": (
        _lasting_keys,
        sql.over(
            """SELECT '2025-05-' || (23 + l_partkey % 3) AS ds, transaction_id,
            payment_method, CAST(p.id AS VARCHAR) AS payment_method_id,
            product_category, CAST(c.id AS VARCHAR) AS product_category_id,
            device_used AS device_type, CAST(d.id AS VARCHAR) AS device_id
            FROM tx LEFT JOIN pays p ON payment_method = p.value LEFT JOIN cats c ON product_category = c.value
            LEFT JOIN devs d ON device_used = d.value""",
            sql.TX, _keyed_sql("pays", "payment_method"), _keyed_sql("cats", "product_category"),
            _keyed_sql("devs", "device_used"),
        ),
    ),
    "sink_daily_overwrite": (
        _daily_overwrite,
        sql.over(
            """SELECT transaction_id, CAST(transaction_amount AS DOUBLE) AS transaction_amount,
            payment_method, CASE WHEN l_orderkey % 2 = 0 THEN '2025-05-24' ELSE '2025-05-25' END AS ds
            FROM tx""",
            sql.TX,
        ),
    ),
    "sink_upsert_transactions": (
        _upsert_transactions,
        sql.over(
            """SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
            order_date AS transaction_date, customer_id,
            CAST(transaction_amount AS DOUBLE) AS transaction_amount, payment_method, quantity
            FROM last WHERE place = 1""",
            sql.TX,
            _LAST.format(rest="customer_id DESC, transaction_amount DESC, quantity DESC", where=""),
        ),
    ),
    "sink_upsert_fraud": (
        _upsert_fraud,
        sql.over(
            """SELECT l_orderkey || '-' || l_linenumber AS transaction_id,
            is_fraudulent <> 0 AS is_fraud, order_date AS "timestamp",
            CAST(transaction_amount AS DOUBLE) AS amount, payment_method, product_category,
            CAST(NULL AS VARCHAR) AS error
            FROM last WHERE place = 1""",
            sql.TX,
            _LAST.format(
                rest="is_fraudulent DESC, transaction_amount DESC",
                where="WHERE is_fraudulent IS NOT NULL",
            ),
        ),
    ),
}

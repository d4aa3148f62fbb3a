"""Raw transactions derived from the order tables.

The real transaction files are not shipped, so the 16 raw columns are computed from
``lineitem`` and its parents. Each query names the columns it needs, and only the parents
that feed those columns are joined; the others would add shuffles for nothing. All joins
keep every line item, and parents have unique keys, so the row set never depends on the
columns asked for.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txnlens.schemas import MOMENT, RAW_NAMES

PARENTS_OF = {
    "customer_id": {"orders"},
    "customer_age": {"orders"},
    "order_date": {"orders"},
    "customer_location": {"orders", "customer"},
    "product_category": {"part"},
    "shipping_address": {"supplier"},
    "billing_address": {"orders", "customer", "supplier"},
}

# Keys of the line item, for callers that need a finer or coarser key than the id.
LINE_KEYS = {
    "order_key": "l_orderkey",
    "line_number": "l_linenumber",
    "part_key": "l_partkey",
    "supplier_key": "l_suppkey",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(
    spark: SparkSession,
    sf_dir: str,
    columns: Iterable[str] | None = None,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Raw transactions with the asked columns (all 16 by default).

    ``lines`` replaces the line-item table, e.g. by the same table read as a stream.
    """
    wanted = list(columns) if columns is not None else list(RAW_NAMES)
    joined = with_nations(spark, sf_dir, transaction_lines(spark, sf_dir, wanted, lines))
    return joined.select(*transaction_columns(wanted))


def transaction_lines(
    spark: SparkSession, sf_dir: str, wanted: Iterable[str], lines: DataFrame | None = None
) -> DataFrame:
    """Line items with their parents; ``with_nations`` completes them for ``transaction_columns``.

    The source columns are several times narrower than the texts made of them, so rows that are shuffled
    anyway are shuffled in this form.
    """
    parents = set().union(*(PARENTS_OF.get(name, set()) for name in wanted))
    joined = lines if lines is not None else table(spark, sf_dir, "lineitem")
    if "orders" in parents:
        orders = _orders(spark, sf_dir, "customer" in parents)
        joined = joined.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    if "part" in parents:
        part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
        joined = joined.join(part, F.col("l_partkey") == F.col("p_partkey"), "left")
    if "supplier" in parents:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        joined = joined.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"), "left")
    return joined


def with_nations(spark: SparkSession, sf_dir: str, joined: DataFrame) -> DataFrame:
    """The names of the nations that ``joined`` has keys of.

    They come last, so that shuffles carry keys, and suppliers, of two numbers each, are broadcast up to a larger
    number of them. The table of nations is broadcast in any case: a shuffle by so few keys would put all lines into as
    few tasks, and end the order that lines may have.
    """
    for key, name in (("c_nationkey", "customer_nation"), ("s_nationkey", "supplier_nation")):
        if key in joined.columns:
            nation = table(spark, sf_dir, "nation").select(
                F.col("n_nationkey").alias(f"{name}_key"), F.col("n_name").alias(name)
            )
            joined = joined.join(F.broadcast(nation), F.col(key) == F.col(f"{name}_key"), "left")
    return joined


def transaction_columns(wanted: Iterable[str]) -> list[Column]:
    """Transaction columns as expressions over ``transaction_lines`` with the names of their nations."""
    expressions = _expressions()
    return [expressions[name].alias(name) for name in wanted]


def _orders(spark: SparkSession, sf_dir: str, with_customer: bool) -> DataFrame:
    """Orders, with their customer joined here: there are fewer orders than line items,
    so the line items are shuffled once for both parents."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if not with_customer:
        return orders
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    return orders.join(customer, F.col("o_custkey") == F.col("c_custkey"), "left")


def _expressions() -> dict[str, Column]:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    part, supplier, buyer = F.col("l_partkey"), F.col("l_suppkey"), F.col("o_custkey")
    seconds = (order * 7919 + part * 104729 + line) % 86400
    moment = F.timestamp_add("SECOND", seconds, F.col("l_shipdate"))
    hour = (seconds / 3600).cast("int")
    price = F.col("l_extendedprice")
    billed = F.when(part % 3 == 0, F.col("customer_nation")).otherwise(F.col("supplier_nation"))
    expressions = {
        "transaction_id": F.concat_ws("-", *(c.cast("string") for c in (order, line, part, supplier))),
        "customer_id": buyer.cast("string"),
        "transaction_amount": price.cast("decimal(10,2)"),
        "transaction_date": F.when(order % 211 == 0, None)
        .when(order % 223 == 0, "not a date")
        .when(order % 227 == 0, F.date_format("l_shipdate", "yyyy-MM-dd"))
        .otherwise(F.date_format(moment, MOMENT)),
        "payment_method": F.when(order % 97 == 0, None)
        .when(order % 4 == 0, "debit card")
        .when(order % 4 == 1, "bank transfer")
        .when(order % 4 == 2, "PayPal")
        .otherwise("credit card"),
        "product_category": F.col("p_type"),
        "quantity": F.when(part % 103 == 0, None)
        .when(part % 101 == 0, 0)
        .otherwise(F.col("l_quantity").cast("int")),
        "customer_age": F.when(buyer % 89 == 0, None).otherwise((15 + buyer % 60).cast("int")),
        "customer_location": F.when(buyer % 79 == 0, None).otherwise(
            F.concat(F.col("customer_nation"), F.lit(", Côte "), F.col("c_mktsegment"))
        ),
        "device_used": F.when(part % 3 == 0, "desktop").when(part % 3 == 1, "mobile").otherwise("tablet"),
        "ip_address": F.concat_ws(
            ".",
            F.lit("10"),
            (order % 256).cast("string"),
            (part % 256).cast("string"),
            (supplier % 256).cast("string"),
        ),
        "shipping_address": F.when(supplier % 37 == 0, None).otherwise(F.col("supplier_nation")),
        "billing_address": F.when(buyer % 73 == 0, None).otherwise(billed),
        "is_fraudulent": F.when(order % 131 == 0, None)
        .when(
            (F.col("l_returnflag") == "R")
            & (F.col("l_linestatus") == "F")
            & ((seconds < 43200) | (price > 50000)),
            1,
        )
        .otherwise(0),
        "account_age_days": (part % 365).cast("int"),
        "transaction_hour": F.when(order % 83 == 0, None).otherwise(hour),
        "order_date": F.date_format("o_orderdate", MOMENT),
    }
    return expressions | {name: F.col(key) for name, key in LINE_KEYS.items()}

"""Star schema: five dimensions and one fact, from raw transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnlens.functions import features as fx
from txnlens.operators.keys import day_values, extend_keys
from txnlens.operators.ranks import dense_ids
from txnlens.schemas import STAR_DDL
from txnlens.session import settle

# table -> (raw column, dimension column, id column)
CATEGORY_DIMS = {
    "dim_payment_methods": ("payment_method", "payment_method", "payment_method_id"),
    "dim_product_categories": ("product_category", "product_category", "product_category_id"),
    "dim_devices": ("device_used", "device_type", "device_id"),
}


def category_dims(raw: DataFrame, names: list[str] | None = None) -> dict[str, DataFrame]:
    """The value lists with surrogate ids, all found in one scan of the raw rows.

    Ids are dense and follow value order, so the same set of values always gets the same ids,
    whatever the partitioning. A null among the values is a row of its own. They suit a star that is built
    as a whole; one that grows by days takes ``lasting_dims``.
    """
    names = list(names or CATEGORY_DIMS)
    values = day_values(raw, {name: CATEGORY_DIMS[name][0] for name in names})
    numbered = settle(dense_ids(values, ["dimension"], "value", "id"), "dimensions")
    return {name: _dimension(numbered, name) for name in names}


def lasting_dims(raw: DataFrame, keys: str, ds: str) -> dict[str, DataFrame]:
    """The value lists of a day with ids from the key table at ``keys``, which the day's new values extend.

    A value has the same id on all days, so facts of any days join the dimensions of any later day.
    """
    values = settle(day_values(raw, {name: column for name, (column, _, _) in CATEGORY_DIMS.items()}), "values")
    known = extend_keys(values, keys, ds)
    pair = F.struct("dimension", "value").alias("_pair")
    own = settle(known.withColumn("_pair", pair).join(values.select(pair), "_pair", "left_semi"), "dimensions")
    return {name: _dimension(own, name) for name in CATEGORY_DIMS}


def _dimension(numbered: DataFrame, name: str) -> DataFrame:
    _, column, key = CATEGORY_DIMS[name]
    return numbered.where(F.col("dimension") == name).select(F.col("value").alias(column), F.col("id").alias(key))


def dim_customers(raw: DataFrame) -> DataFrame:
    """Distinct customer states; a customer with changing data has several rows."""
    return raw.select(
        "customer_id",
        "customer_age",
        "customer_location",
        "account_age_days",
        fx.age_group("customer_age").alias("age_group"),
    ).distinct()


def dim_time(raw: DataFrame) -> DataFrame:
    return (
        fx.with_time_parts(raw)
        .select(
            fx.moment_text("transaction_timestamp").alias("time_id"),
            "transaction_hour",
            "transaction_dayofweek",
            "transaction_month",
            "transaction_year",
        )
        .distinct()
    )


def fact_transactions(raw: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """The fact as written out: text timestamp, text label, text foreign keys.

    A null category finds no dimension row, so its key is null. The dimensions are read
    from files, so their size is measured and the planner broadcasts them only if small.
    A report that reads few columns passes a narrow ``raw`` and few ``dims``; it gets the
    fact columns these can give.
    """
    fact = raw
    if "transaction_date" in raw.columns:
        ts = fx.moment_text(fx.event_time("transaction_date"))
        fact = fact.withColumn("transaction_timestamp", ts)
    if "is_fraudulent" in raw.columns:
        fact = fact.withColumn("is_fraudulent", fx.label_text("is_fraudulent"))
    for name, dim in dims.items():
        raw_column, column, key = CATEGORY_DIMS[name]
        looked_up = dim.select(
            F.col(column).alias(f"_{column}"), F.col(key).cast("string").alias(key)
        )
        fact = fact.join(looked_up, F.col(raw_column) == F.col(f"_{column}"), "left")
    return fact.select(*(c for c in _names("fact_transactions") if c in fact.columns))


def star(raw: DataFrame, keys: str | None = None, ds: str | None = None) -> dict[str, DataFrame]:
    """All six tables; with a key table, ids that last over days."""
    dims = category_dims(raw) if keys is None else lasting_dims(raw, keys, ds)
    return {
        "dim_customers": dim_customers(raw),
        **dims,
        "dim_time": dim_time(raw),
        "fact_transactions": fact_transactions(raw, dims),
    }


def typed(name: str, df: DataFrame) -> DataFrame:
    """A star table with the types the reports declare for it."""
    kinds = dict(part.split(" ", 1) for part in STAR_DDL[name].split(", "))
    return df.select(*(F.col(c).try_cast(kinds[c]).alias(c) for c in df.columns))


def _names(name: str) -> list[str]:
    return [part.split(" ", 1)[0] for part in STAR_DDL[name].split(", ")]

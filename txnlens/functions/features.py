"""Derived columns. All are built-in expressions, so they stay inside codegen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.schemas import CATEGORICAL, MOMENT

# Display names of the payment methods, by lower-case text.
PAYMENT_NAMES = {
    "credit card": "Credit Card",
    "debit card": "Debit Card",
    "bank transfer": "Bank Transfer",
    "paypal": "PayPal",
}

# The weight factor of fraud rows, and in the functions below the age bounds and the night hours.
FRAUD_WEIGHT_FACTOR = 5.0


def event_time(text: Column | str) -> Column:
    """Timestamp of a text; unreadable text gives null instead of failing the job."""
    return F.try_to_timestamp(_col(text))


def strict_event_time(text: Column | str) -> Column:
    """Timestamp only if the text has the full ``yyyy-MM-dd HH:mm:ss`` form."""
    return F.try_to_timestamp(_col(text), F.lit(MOMENT))


def event_date(text: Column | str) -> Column:
    return event_time(text).cast("date")


def moment_text(ts: Column | str) -> Column:
    return F.date_format(ts, MOMENT)


def age_group(age: Column | str) -> Column:
    age = _col(age)
    return (
        F.when(age.isNull(), "Unknown")
        .when(age < 20, "Under 20")
        .when(age < 30, "20-29")
        .when(age < 40, "30-39")
        .when(age < 50, "40-49")
        .otherwise("50+")
    )


def flag(condition: Column) -> Column:
    """1 where the condition is true, else 0; an unknown condition counts as 0."""
    return F.when(condition, 1).otherwise(0)


def address_mismatch(shipping: Column | str, billing: Column | str) -> Column:
    return flag(_col(shipping) != _col(billing))


def amount_per_quantity(amount: Column | str, quantity: Column | str) -> Column:
    amount, quantity = _col(amount).cast("double"), _col(quantity)
    return F.when(quantity > 0, amount / quantity).otherwise(amount)


def is_weekend(day_of_week: Column | str) -> Column:
    return flag(_col(day_of_week).isin(1, 7))


def is_night_time(hour: Column | str) -> Column:
    hour = _col(hour)
    return flag((hour >= 22) | (hour <= 5))


def label_text(label: Column | str) -> Column:
    """Label as the text booleans of the star schema; null counts as false."""
    return F.when(_col(label) == 1, "true").otherwise("false")


def payment_name(method: Column | str) -> Column:
    """Display name of a payment method; null, empty or unlisted gives ``unknown``."""
    pairs = [F.lit(part) for pair in PAYMENT_NAMES.items() for part in pair]
    names = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(names, F.lower(_col(method))), F.lit("unknown"))


def with_time_parts(df: DataFrame) -> DataFrame:
    """Timestamp, day of week (1 = Sunday), month and year of the transaction."""
    ts = event_time("transaction_date")
    return df.select(
        "*",
        ts.alias("transaction_timestamp"),
        F.dayofweek(ts).alias("transaction_dayofweek"),
        F.month(ts).alias("transaction_month"),
        F.year(ts).alias("transaction_year"),
    )


def with_date_parts(df: DataFrame) -> DataFrame:
    """Day of month, day of week and month of the transaction date."""
    day = event_date("transaction_date")
    return df.withColumns(
        {
            "day_of_month": F.dayofmonth(day),
            "day_of_week": F.dayofweek(day),
            "month": F.month(day),
        }
    )


def with_model_features(df: DataFrame) -> DataFrame:
    """The model input columns, for training and scoring, batch and stream alike."""
    dated = with_date_parts(df)
    derived = dated.withColumns(
        {
            "address_mismatch": address_mismatch("shipping_address", "billing_address"),
            "amount_per_quantity": amount_per_quantity("transaction_amount", "quantity"),
            "is_weekend": is_weekend("day_of_week"),
            "is_night_time": is_night_time("transaction_hour"),
        }
    )
    return fill_unknown(derived)


def fill_unknown(df: DataFrame) -> DataFrame:
    return df.fillna("unknown", subset=[c for c in CATEGORICAL if c in df.columns])


def class_totals(df: DataFrame, label: str = "is_fraudulent") -> DataFrame:
    """One row: number of fraud and non-fraud rows, in one pass."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("fraud_count"),
        F.count_if(F.col(label) == 0).alias("non_fraud_count"),
    )


def with_class_weight(df: DataFrame, label: str = "is_fraudulent") -> DataFrame:
    """Weight fraud rows up by class imbalance; rows without label weigh as non-fraud.

    The totals are one row by construction, so joining them in copies one row per task.
    """
    total = F.col("fraud_count") + F.col("non_fraud_count")
    weights = class_totals(df, label).select(
        (F.try_divide("non_fraud_count", total) * FRAUD_WEIGHT_FACTOR).alias("_fraud_weight"),
        F.try_divide("fraud_count", total).alias("_other_weight"),
    )
    return (
        df.join(F.broadcast(weights))
        .withColumn(
            "class_weight",
            F.when(F.col(label) == 1, F.col("_fraud_weight")).otherwise(F.col("_other_weight")),
        )
        .drop("_fraud_weight", "_other_weight")
    )


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value

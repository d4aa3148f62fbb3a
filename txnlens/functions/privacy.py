"""Pseudonyms for personal columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pseudonym(column: Column | str, salt: str) -> Column:
    """Salted SHA-256: equal inputs stay joinable, the input is not readable; null stays null."""
    value = F.col(column) if isinstance(column, str) else column
    return F.sha2(F.concat(F.lit(salt), value), 256)


def masked_ip(column: Column | str) -> Column:
    """IPv4 address with its last octet hidden."""
    value = F.col(column) if isinstance(column, str) else column
    return F.regexp_replace(value, r"\.[0-9]+$", ".0")


def pseudonymise(df: DataFrame, salt: str) -> DataFrame:
    """Hide the person behind a transaction in every column that names one."""
    hidden = ["customer_id", "shipping_address", "billing_address"]
    changed = {name: pseudonym(name, salt) for name in hidden if name in df.columns}
    if "ip_address" in df.columns:
        changed["ip_address"] = masked_ip("ip_address")
    return df.withColumns(changed)

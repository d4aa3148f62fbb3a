"""Every query by name, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from txnlens.session import release_shuffles, use_settings

Query = Callable[[SparkSession, str], DataFrame]


def entries() -> dict[str, tuple[Query, str | None]]:
    from txnlens.registry import batch, increments, models, storage, streams

    found: dict[str, tuple[Query, str | None]] = {}
    for module in (batch, storage, streams, increments, models):
        for name, entry in module.ENTRIES.items():
            if name in found:
                raise ValueError(f"query {name} is registered twice")
            query, sql = entry
            found[name] = (_with_settings(query), sql)
    return found


def _with_settings(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_settings(spark)
        release_shuffles(spark)
        return query(spark, sf_dir)

    return run

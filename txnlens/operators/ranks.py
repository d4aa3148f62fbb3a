"""Running totals, dense ids and exact quantiles without a single-task sort.

A window without partition keys sorts everything in one task, and one partitioned by a few
groups sorts a whole group in one. Here the rows are split by range on group and sort key
instead; each slice is summed on its own, and the totals of the slices before it are added.
Only those totals, one row per slice and group in it, are ordered per group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.session import settle


def sliced(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` written out in even ranges of ``keys``, with ``_slice``: the number of the range that a row is in.

    Spark's range partitioner draws the bounds; the number of its partition is stored with the rows, so it stays
    the same however often they are read, and neither bounds nor an expression over them pass through the driver here.
    """
    split = df.repartitionByRange(*(F.col(k).asc_nulls_first() for k in keys))
    return settle(split.withColumn("_slice", F.spark_partition_id()), "sliced")


def running_totals(
    df: DataFrame,
    order_by: Sequence[str],
    sums: Mapping[str, Column | str],
    group: Sequence[str] = (),
    with_totals: bool = False,
) -> DataFrame:
    """Add inclusive running sums per group in ``order_by`` order (ascending, nulls first).

    ``with_totals`` adds the whole sum of the group as ``<name>_total`` too. Rows that are
    equal in group and order are numbered, so that any number of them can be cut into
    slices as well; which of them comes first is arbitrary.

    The split input is written out: its files give the same numbers however often they are
    read, and the input is not computed again for the totals and the sums.
    """
    parts = {f"_part_{i}": (name, value) for i, (name, value) in enumerate(sums.items())}
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    order = [*order_by, "_tie"]
    # As one struct, groups holding nulls compare as equal. Join and window share the key,
    # so the rows are shuffled once for both.
    cut = sliced(numbered, [*group, *order]).withColumn("_group", F.struct(F.lit(0), *group))
    totals = cut.groupBy("_slice", "_group").agg(
        *(F.sum(value).alias(f"{key}_sum") for key, (_, value) in parts.items())
    )
    whole = W.partitionBy("_group")
    before = whole.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_slice",
        "_group",
        *(F.coalesce(F.sum(f"{key}_sum").over(before), F.lit(0)).alias(key) for key in parts),
        *(F.sum(f"{key}_sum").over(whole).alias(f"{key}_all") for key in parts if with_totals),
    )
    within = (
        W.partitionBy("_slice", "_group")
        .orderBy(*order)
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    running = [
        (F.col(key) + F.sum(value).over(within)).alias(name) for key, (name, value) in parts.items()
    ]
    ends = [F.col(f"{key}_all").alias(f"{name}_total") for key, (name, _) in parts.items() if with_totals]
    joined = cut.join(offsets, ["_slice", "_group"])
    return joined.select(*(F.col(c) for c in df.columns), *running, *ends)


def dense_ids(values: DataFrame, group: Sequence[str], column: str, id_name: str) -> DataFrame:
    """Number distinct values 0..n-1 in value order (nulls first) within each group."""
    counted = running_totals(values, [column], {"_seen": F.lit(1)}, group)
    return counted.select(*values.columns, (F.col("_seen") - 1).cast("bigint").alias(id_name))


def quantiles(
    df: DataFrame,
    group: Sequence[str],
    column: str,
    fractions: Mapping[str, float],
    interpolate: bool = True,
) -> DataFrame:
    """Exact quantiles of a column per group, one output column per named fraction.

    Rows are first counted per (group, value), which combines before the shuffle, so a
    group holding most rows costs no more than its distinct values; the counts are then
    ranked by running totals. Nulls are left out. With ``interpolate`` a fraction between
    two rows gives the linear mix of both, without it the lower value at rank ceil(f * n).
    """
    by = list(group)
    counts = (
        df.where(F.col(column).isNotNull())
        .groupBy(*by, F.col(column).alias("_value"))
        .agg(F.count("*").alias("_n"))
    )
    ranked = running_totals(counts, ["_value"], {"_until": "_n"}, by, with_totals=True)
    until, size = F.col("_until"), F.col("_until_total")
    first = until - F.col("_n")
    value = F.col("_value").cast("double") if interpolate else F.col("_value")

    def at(rank: Column) -> Column:
        return F.max(F.when((first <= rank) & (rank < until), value))

    picks = []
    for name, fraction in fractions.items():
        if interpolate:
            place = (size - 1) * F.lit(fraction)
            low, high = at(F.floor(place)), at(F.ceil(place))
            share = F.max(place - F.floor(place))
            picks.append((low + (high - low) * share).alias(name))
        else:
            rank = F.greatest(F.ceil(size * F.lit(fraction)) - 1, F.lit(0))
            picks.append(at(rank).alias(name))
    return ranked.groupBy(*by).agg(
        F.max(size).alias("n"),
        F.min("_value").alias("lowest"),
        F.max("_value").alias("highest"),
        *picks,
    )


def box(df: DataFrame, group: Sequence[str], column: str) -> DataFrame:
    """Five-number summary per group, with the outlier fences at 1.5 times the IQR."""
    cuts = quantiles(df, group, column, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    return cuts.select(
        *group,
        "n",
        F.col("lowest").cast("double").alias("lowest"),
        *(F.round(name, 6).alias(name) for name in ("q1", "median", "q3")),
        F.col("highest").cast("double").alias("highest"),
        F.round(F.col("q1") - 1.5 * spread, 6).alias("lower_fence"),
        F.round(F.col("q3") + 1.5 * spread, 6).alias("upper_fence"),
    )

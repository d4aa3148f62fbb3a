"""Quantiles from mergeable sketches: approximate, with a stated bound on the rank.

A KLL sketch keeps a bounded number of values whatever the number of rows, and sketches of parts
merge to the sketch of the whole, so a part is never read again: days, groups and stream batches each leave one.
With ``K`` values per level the rank of an estimate is off by less than ``RANK_ERROR`` of the rows with a probability above
99 %; a sketch of fewer rows than that is exact. Least and largest value are kept apart and exact.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnlens.session import settle

K = 1024
RANK_ERROR = 0.01

FRACTIONS = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def sketched(column: str, name: str = "amounts") -> list[Column]:
    """Aggregates over rows: number of values, least, largest and the sketch. Nulls and NaN are left out."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    return [
        F.count(value).alias(f"{name}_n"),
        F.min(value).alias(f"{name}_lowest"),
        F.max(value).alias(f"{name}_highest"),
        F.kll_sketch_agg_double(value, F.lit(K)).alias(name),
    ]


def merged(name: str = "amounts") -> list[Column]:
    """Aggregates over rows of ``sketched``: the same columns for the whole."""
    return [
        F.sum(f"{name}_n").alias(f"{name}_n"),
        F.min(f"{name}_lowest").alias(f"{name}_lowest"),
        F.max(f"{name}_highest").alias(f"{name}_highest"),
        F.kll_merge_agg_double(name).alias(name),
    ]


def estimates(fractions: Mapping[str, float], name: str = "amounts") -> list[Column]:
    """Quantiles of a sketch; null where it has no values."""
    return [
        F.when(F.col(f"{name}_n") > 0, F.kll_sketch_get_quantile_double(name, F.lit(f))).alias(out)
        for out, f in fractions.items()
    ]


def sketched_box(parts: DataFrame, group: Sequence[str], name: str = "amounts") -> DataFrame:
    """Five-number summary per group of all parts, with the outlier fences at 1.5 times the IQR."""
    whole = parts.groupBy(*group).agg(*merged(name)).where(F.col(f"{name}_n") > 0)
    cuts = whole.select(
        *group,
        F.col(f"{name}_n").alias("n"),
        F.col(f"{name}_lowest").alias("lowest"),
        *estimates(FRACTIONS, name),
        F.col(f"{name}_highest").alias("highest"),
    )
    spread = F.col("q3") - F.col("q1")
    return cuts.withColumns({"lower_fence": F.col("q1") - 1.5 * spread, "upper_fence": F.col("q3") + 1.5 * spread})


def within_error(box: DataFrame, rows: DataFrame, group: Sequence[str], column: str, error: float = RANK_ERROR) -> DataFrame:
    """``group, n, lowest, highest, within_error``: whether each quantile of ``box`` has its rank among ``rows``, one pass."""
    value = F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))
    # As a struct, groups holding nulls are equal.
    held = rows.where(value.isNotNull()).select(F.struct(*group).alias("_group"), value.alias("_value"))
    # Written first, so the planner knows that a few groups are small and the rows are not shuffled to them.
    cuts = settle(box.select(F.struct(*group).alias("_group"), "n", "lowest", "highest", *FRACTIONS), "cuts")
    counts = [c for q in FRACTIONS for c in (F.count_if(F.col("_value") < F.col(q)).alias(f"_{q}_below"), F.count_if(F.col("_value") <= F.col(q)).alias(f"_{q}_upto"))]
    ranks = held.join(cuts, "_group").groupBy("_group", "n", "lowest", "highest").agg(*counts)
    fits = F.lit(True)
    for q, fraction in FRACTIONS.items():
        fits &= (F.col(f"_{q}_below") <= (fraction + error) * F.col("n")) & (F.col(f"_{q}_upto") >= (fraction - error) * F.col("n"))
    return ranks.select("_group.*", "n", "lowest", "highest", fits.alias("within_error"))

"""Train/test split by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_SHARE = 0.8
SEED = 42


def hash_split(
    df: DataFrame, key: str, share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key, so a row's side never depends on partitioning.

    ``randomSplit`` gives another split whenever file layout or parallelism change, and a
    recomputed partition may then leak rows between both sides.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key), F.lit(""))))
    bucket = F.conv(F.substring(digest, 1, 7), 16, 10).cast("bigint") % 1000
    chosen = bucket < int(share * 1000)
    return df.where(chosen), df.where(~chosen)

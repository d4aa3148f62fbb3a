"""Shards by balanced label propagation.

Documents of equal text are linked. Each linked document starts in a shard given by a hash; in each
round the documents of a group are drawn to the shards that hold most of the group, as many shards
as its size needs. Departures are matched with arrivals: the rows that ask to move are counted per pair of
shards, and moves are granted round cycles of shards, which leave all sizes as they are, and into free room. Of those
that ask, a hash picks who may. Rounds go on until next to nothing moves. Documents without links have no preference;
they and those beyond a shard's size are dealt out last, so that the shards' row counts differ by one at most.

Links are never listed as pairs: a round counts rows per group and shard, picks targets from those
counts and joins them back. Only one number per pair of shards comes to the driver. Slots are numbered in
buckets of bounded size, so no shard or group is sorted in one task.

Edge cases: null text has size 16, the crc32 of the empty string and the group of empty texts. Null and
repeated ids are rows like any other. With fewer rows than shards some shards stay empty. An empty table
gives an empty result; columns other than ``doc_id`` and ``text`` are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from txnlens.llm.common import table, whole_text, written

SHARDS = 40
#: Rounds end once fewer of those that ask to move may.
STILL = 0.01
OVERHEAD = 16
#: Rows that are numbered together.
BUCKET_ROWS = 20_000
#: Share of a shard that one group may fill before it is drawn to another shard as well.
GROUP_SHARE = 0.5


def _pick(values: Sequence[float], index: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), index + 1)


def numbered(df: DataFrame, by: list[str], buckets: int, order: Column) -> DataFrame:
    """Adds ``_place``: gapless numbers from 0 within ``by``, in buckets of ``_part`` and ``order``.

    ``_part`` splits what would be too large for one bucket. Rows that agree in everything are
    numbered in any order.
    """
    kept = df.columns
    parted = df.withColumn("_bucket", F.pmod(order, F.lit(buckets)))
    keys = [*by, "_bucket", "_part"]
    sizes = parted.groupBy(*keys).agg(F.count("*").alias("_n"))
    before = W.partitionBy(*by).orderBy("_bucket", "_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = written(sizes.withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n"), "offsets")
    within = W.partitionBy(*keys).orderBy(order, "_row")
    place = (F.row_number().over(within) - 1 + F.col("_offset")).cast("bigint")
    return parted.join(offsets, keys).withColumn("_place", place).select(*kept, "_place")


def circulation(asked: dict[tuple[int, int], int], room: Sequence[int]) -> dict[tuple[int, int], int]:
    """How many of the rows that ask to go from one shard to another may, so that no shard gets beyond its room.

    A row that leaves makes room for one that comes, so moves are granted round cycles of shards, first the shortest,
    and along chains that end in free room. What is left over has neither.
    """
    left = {move: n for move, n in asked.items() if n > 0}
    room, granted = list(room), dict.fromkeys(asked, 0)

    def grant(moves: list[tuple[int, int]], n: int) -> None:
        for move in moves:
            granted[move] += n
            left[move] -= n
            if not left[move]:
                del left[move]

    for s, t in list(left):
        if s < t and (s, t) in left and (t, s) in left:
            grant([(s, t), (t, s)], min(left[s, t], left[t, s]))
    while cycle := _cycle(left):
        grant(cycle, min(left[move] for move in cycle))
    moved = True
    while moved:
        moved = False
        for s, t in sorted(left):
            if n := min(left.get((s, t), 0), room[t]):
                grant([(s, t)], n)
                room[t] -= n
                room[s] += n
                moved = True
    return granted


def _cycle(moves: dict[tuple[int, int], int]) -> list[tuple[int, int]] | None:
    """Moves that lead round a cycle of shards, if there are any."""
    onward: dict[int, list[int]] = {}
    for s, t in sorted(moves):
        onward.setdefault(s, []).append(t)
    done: set[int] = set()
    for start in sorted(onward):
        path, branches = [start], [iter(onward[start])]
        while path:
            following = next(branches[-1], None)
            if following is None:
                done.add(path.pop())
                branches.pop()
            elif following in path:
                round_ = path[path.index(following) :]
                return list(zip(round_, [*round_[1:], following]))
            elif following not in done:
                path.append(following)
                branches.append(iter(onward.get(following, ())))
    return None


def propagate(linked: DataFrame, shards: int, size: int) -> DataFrame:
    """Adds ``_shard`` to rows with ``_row``, ``_group`` and ``_group_size``; ``size`` rows fit in a shard.

    Rounds go on until one moves next to nothing. Every move takes a row to a shard with no fewer of its group, so
    groups only grow together and the rounds come to an end.
    """
    start = F.pmod(F.xxhash64("_row", "_group"), F.lit(shards)).cast("int")
    state = written(linked.withColumn("_shard", start), "shards")
    wanted = F.greatest(F.lit(1), F.ceil(F.col("_group_size") / F.lit(max(1.0, GROUP_SHARE * size)))).cast("int")
    turn = 0
    while True:
        held = written(state.groupBy("_group", "_group_size", "_shard").agg(F.count("*").alias("_held")), "held")
        load = {r["_shard"]: r["n"] for r in held.groupBy("_shard").agg(F.sum("_held").alias("n")).collect()}
        room = [max(0, size - load.get(s, 0)) for s in range(shards)]

        # A group has a row for each shard at most, so its ranking is small whatever its size. Of equals, another
        # one comes first in each round, so a refused move is not asked for again and again.
        best = W.partitionBy("_group").orderBy(F.desc("_held"), F.xxhash64("_group", "_shard", F.lit(turn)), "_shard")
        ranked = held.withColumn("_rank", F.row_number().over(best)).withColumn("_wanted", wanted)
        targets = ranked.where("_rank <= _wanted").groupBy("_group").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_rank", "_shard"))), lambda x: x["_shard"]).alias("_targets")
        )
        apart = ranked.where("_rank > _wanted").join(targets, "_group").select("_group", "_shard", "_targets")
        place = F.pmod(F.xxhash64("_row", F.lit(turn)), F.size("_targets")).cast("int")
        asking = state.join(written(apart, "moving"), ["_group", "_shard"]).select(
            "_row", "_group", F.col("_shard").alias("_from"), F.element_at("_targets", place + 1).alias("_to")
        )
        asking = written(asking.withColumn("_part", F.lit(0)), "asking")
        # One number per pair of shards.
        asked = {(r["_from"], r["_to"]): r["count"] for r in asking.groupBy("_from", "_to").count().collect()}
        granted = circulation(asked, room)
        moved, movers = sum(granted.values()), sum(asked.values())
        if moved <= movers * STILL:
            return state
        cells = [int(granted.get((s, t), 0)) for s in range(shards) for t in range(shards)]
        buckets = max(1, -(-max(asked.values()) // BUCKET_ROWS))
        order = numbered(asking, ["_from", "_to"], buckets, F.xxhash64("_group", F.lit(turn)))
        goes = F.col("_place") < _pick(cells, F.col("_from") * shards + F.col("_to"))
        going = written(order.where(goes).select("_row", "_to"), "going")
        told = state.join(going, "_row", "left").withColumn("_shard", F.coalesce("_to", "_shard"))
        state = written(told.select(*state.columns), "shards")
        turn += 1


def balanced_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; row counts differ by one at most."""
    text = docs.select("doc_id", whole_text().alias("_text"), F.col("text").isNull().alias("_none"))
    rows = text.select(
        F.monotonically_increasing_id().alias("_row"),
        "doc_id",
        (F.octet_length("_text") + OVERHEAD).cast("bigint").alias("size"),
        F.crc32("_text").alias("text_crc32"),
        F.unhex(F.md5("_text")).alias("_group"),
    )
    rows = written(rows, "shard-rows")
    groups = written(rows.groupBy("_group").agg(F.count("*").alias("_group_size")), "groups")
    total = rows.count()
    per_shard, more = divmod(total, shards)
    quota = [per_shard + (s < more) for s in range(shards)]
    buckets = max(1, -(-total // BUCKET_ROWS))

    # A group larger than a bucket is cut by its rows' hash; most groups have one part.
    part = F.pmod(F.xxhash64("_row"), F.ceil(F.col("_group_size") / F.lit(BUCKET_ROWS)))
    linked = rows.join(groups.where("_group_size > 1"), "_group")
    state = propagate(linked, shards, per_shard).withColumn("_part", part)
    placed = written(numbered(state, ["_shard"], -(-buckets // shards), F.xxhash64("_group")), "placed")
    fits = F.col("_place") < _pick(quota, F.col("_shard"))
    columns = ["doc_id", "size", "text_crc32"]
    settled = placed.where(fits).select(*columns, F.col("_shard").alias("shard"), F.col("_place").alias("slot"))

    taken = {r["shard"]: r["n"] for r in settled.groupBy("shard").agg(F.count("*").alias("n")).collect()}
    left = [q - taken.get(s, 0) for s, q in enumerate(quota)]
    alone = rows.join(groups.where("_group_size = 1"), "_group").withColumn("_part", F.lit(0).cast("bigint"))
    free = alone.select("_row", *columns, "_part").unionByName(
        placed.where(~fits).select("_row", *columns, F.lit(0).cast("bigint").alias("_part"))
    )
    free = numbered(free.withColumn("_all", F.lit(0)), ["_all"], buckets, F.xxhash64("_row"))
    ends = list(accumulate(left))
    shard = sum((F.col("_place") >= F.lit(e)).cast("int") for e in ends)
    free = free.withColumn("shard", shard)
    begins = [taken.get(s, 0) - (ends[s] - left[s]) for s in range(shards)]
    dealt = free.select(*columns, "shard", (F.col("_place") + _pick(begins, F.col("shard"))).alias("slot"))
    return settled.unionByName(dealt).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_shards(table(spark, sf_dir, "documents"))


ENTRIES = {"op8_label_shards": (op8_label_shards, None)}

"""Sharding by balanced label propagation: linked documents gather, sizes stay even.

Links are groups (here: equal texts); a group is a hub its documents are linked to, so a
group of n costs n links and not n * n. Labels are shards. A shard takes ``1 / FINE`` more
than its even share at most; documents larger than that are the exception.

1. Groups larger than ``1 / FINE`` of a shard, of which there cannot be more than ``FINE``
   times the number of shards, come first, largest first: each goes whole to the fullest
   shard that has the room, or, where no shard has it, to as few shards as its bytes need.
2. Documents of the other groups start on a shard chosen by hash. Each round counts every
   group's bytes by shard (combined before the shuffle) and asks to move its documents to
   the shard that holds most of it and has room.
3. Moves obey quotas: what a shard holds and takes, less what leaves it, stays within its
   capacity. Moves are decided by hash buckets of whole groups, other ones each round; a
   bucket that does not fit is skipped. A move makes its groups whole, so each moves once at
   most; rounds are written to the shared folder and end when nothing moves.
4. Groups that are cut even then go whole where room is left, and so do documents without
   links. Those larger than ``1 / FINE`` of a shard are dealt out largest first; the others
   by running sums of their bytes, summed by hash bucket first.

No window or list holds more than a hash bucket of a shard or of a group, or the shards of
one group. The driver sees sums by shard and bucket, the few large groups of step 1 and the
few large documents of step 4.

Defined cases: a null text has no bytes and no links; empty texts are equal to each other; a
null id is carried; rows that repeat are linked like other equal texts; an empty table gives
an empty one; other columns are not read.
"""

from __future__ import annotations

import heapq
from itertools import accumulate, count

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tablecheck.sources.scratch import staged

SHARDS = 24
FINE = 64
#: Hash buckets in which rows are numbered: so many at least, and more so that a bucket has
#: about ``BUCKET_ROWS`` at most.
BUCKETS, BUCKET_ROWS = 1024, 1_000_000
#: Hash buckets of the groups that want to one shard.
TURNS = 128


def buckets_for(rows: int) -> int:
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def _bucket(value: Column, salt: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), value), F.lit(buckets)).cast("int")


def _looked_up(values: dict[int, int] | list[int], key: Column) -> Column:
    """A table of a fixed number of entries as an expression."""
    listed = [values[i] for i in range(len(values))]
    return F.element_at(F.lit(listed), key + 1) if listed else F.lit(None)


def homes(groups: list[tuple[str, int, int]], shards: int, capacity: float) -> dict[str, list[tuple[int, int]]]:
    """``group: [(shard, rows), ...]`` for ``(group, rows, bytes of a row)``."""
    room, found = [capacity] * shards, {}
    for group, n, size in sorted(groups, key=lambda g: (-g[1] * g[2], g[0])):
        fitting = [s for s in range(shards) if room[s] >= n * size]
        pieces = [(min(fitting, key=lambda s: (room[s], s)), n)] if fitting else []
        left = 0 if fitting else n
        while left:
            own = min(range(shards), key=lambda s: (-room[s] + sum(k * size for t, k in pieces if t == s), s))
            held = sum(k * size for t, k in pieces if t == own)
            took = min(left, max(1, int((room[own] - held) // size)))
            pieces.append((own, took))
            left -= took
        for s, k in pieces:
            room[s] -= k * size
        found[group] = pieces
    return found


def _placed_groups(hot: DataFrame, found: dict[str, list[tuple[int, int]]], buckets: int) -> DataFrame:
    """Documents of large groups on the shards that ``homes`` gave them."""
    spark = hot.sparkSession
    whole = spark.createDataFrame([(g, p[0][0]) for g, p in found.items() if len(p) == 1], "group string, shard int")
    placed = hot.join(whole, "group")
    split = {g: p for g, p in found.items() if len(p) > 1}
    if not split:
        return placed
    names = spark.createDataFrame([(g,) for g in split], "group string")
    cut = staged(
        hot.join(names, "group").withColumn("bucket", _bucket(F.col("row"), "piece", buckets)), "split"
    )
    counts = {(r["group"], r["bucket"]): r["n"] for r in
              cut.groupBy("group", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    offsets = []
    for g, pieces in split.items():
        before = [0, *accumulate(counts.get((g, b), 0) for b in range(buckets))][:-1]
        ends, targets = list(accumulate(k for _, k in pieces)), [s for s, _ in pieces]
        offsets += [(g, b, n, ends, targets) for b, n in enumerate(before) if (g, b) in counts]
    # a hash bucket of a group that no shard can hold; there are few such groups
    held = spark.createDataFrame(offsets, "group string, bucket int, before long, ends array<long>, targets array<int>")
    order = W.partitionBy("group", "bucket").orderBy("order", "row")
    numbered = cut.withColumn("place", F.row_number().over(order)).join(held, ["group", "bucket"])
    passed = F.size(F.filter("ends", lambda end: end < F.col("before") + F.col("place")))
    return placed.unionByName(
        numbered.withColumn("shard", F.element_at("targets", passed + 1))
        .drop("bucket", "before", "ends", "targets", "place")
    )


def admitted(wishes: np.ndarray, loads: np.ndarray, capacity: float) -> np.ndarray:
    """Which hash buckets may move: ``wishes[to, bucket, from]`` are bytes.

    All that want to move do at first; a shard that would end above its capacity then skips
    buckets that do not fit, until no shard has to.
    """
    taken = wishes.any(axis=2)
    while True:
        moved = wishes * taken[:, :, None]
        after = loads + moved.sum(axis=(1, 2)) - moved.sum(axis=(0, 1))
        over = np.flatnonzero((after > capacity) & taken.any(axis=1))
        if not len(over):
            return taken
        for s in over:
            sizes = moved[s].sum(axis=1)
            room = capacity - (after[s] - sizes.sum())
            for turn in np.flatnonzero(taken[s]):
                taken[s, turn] = sizes[turn] <= room
                room -= sizes[turn] * taken[s, turn]


def _propagated(linked: DataFrame, shards: int, capacity: float, fixed: list[int]) -> DataFrame:
    """``linked`` (``row, group, size, shard, ...``) after propagation; ``fixed`` bytes are there before."""
    linked = staged(linked, "linked")
    for number in count():
        cells = staged(linked.groupBy("group", "shard").agg(F.sum("size").alias("held")), "cells")
        loads = np.array(fixed, np.int64)
        for r in cells.groupBy("shard").agg(F.sum("held").alias("held")).collect():
            loads[r["shard"]] += r["held"]
        room = [max(0, int(capacity - load)) for load in loads]
        totals = cells.groupBy("group").agg(
            F.sum("held").alias("whole"),
            F.collect_list(F.struct("held", F.xxhash64("group", "shard").alias("tie"), "shard")).alias("cells"),
        ).where(F.size("cells") > 1)
        best = F.array_max(F.transform("cells", lambda c: F.struct(
            (_looked_up(room, c["shard"]) >= F.col("whole") - c["held"]).alias("fits"), c["held"], c["tie"], c["shard"],
        )))
        targets = totals.select("group", best["shard"].alias("target"))
        asked = staged(linked.join(targets, "group", "left").withColumn(
            "wanted", F.when(F.col("target") != F.col("shard"), F.col("target"))
        ).withColumn("turn", _bucket(F.col("group"), f"turn {number}", TURNS)).drop("target"), "asked")
        wishes = np.zeros((shards, TURNS, shards), np.int64)
        wanting = asked.where("wanted IS NOT NULL").groupBy("wanted", "turn", "shard")
        for r in wanting.agg(F.sum("size").alias("n")).collect():
            wishes[r["wanted"], r["turn"], r["shard"]] = r["n"]
        taken = [(int(s), int(t), True) for s, t in zip(*np.nonzero(admitted(wishes, loads, capacity)), strict=True)]
        if not taken:
            break
        # shards times turns rows at most, whatever the input
        moves = F.broadcast(linked.sparkSession.createDataFrame(taken, "wanted int, turn int, moves boolean"))
        linked = staged(
            asked.join(moves, ["wanted", "turn"], "left")
            .withColumn("shard", F.when(F.col("moves"), F.col("wanted")).otherwise(F.col("shard")))
            .drop("wanted", "turn", "moves"), "linked",
        )
    return linked


def _loads(placed: DataFrame, shards: int) -> list[int]:
    held = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.sum("size").alias("n")).collect()}
    return [held.get(s, 0) for s in range(shards)]


def _gathered(linked: DataFrame, fixed: list[int], total: int, buckets: int) -> DataFrame:
    """``linked`` with every group that is still cut placed whole where room is left."""
    cut = staged(linked.groupBy("group").agg(
        F.min("shard").alias("first"), F.max("shard").alias("last"), F.sum("size").alias("size"),
        F.min("row").alias("row"), F.min("order").alias("order"),
    ).where("first <> last").drop("first", "last"), "cut")
    if cut.isEmpty():
        return linked
    whole = _loads(linked.join(cut.select("group"), "group", "left_anti"), len(fixed))
    settled = _filled(cut, [a + b for a, b in zip(fixed, whole, strict=True)], total, buckets)
    return staged(
        linked.join(settled.select("group", F.col("shard").alias("settled")), "group", "left")
        .withColumn("shard", F.coalesce("settled", "shard")).drop("settled"), "linked",
    )


def _filled(singles: DataFrame, loads: list[int], total: int, buckets: int) -> DataFrame:
    """Documents without links (or whole groups), placed so that all shards come out even."""
    shards = len(loads)
    level = total / shards
    heap = [(load, s) for s, load in enumerate(loads)]
    heapq.heapify(heap)
    large = F.col("size") > level / FINE
    dealt: dict[int, int] = {}
    for r in sorted(singles.where(large).select("row", "size").collect(), key=lambda r: (-r["size"], r["row"])):
        load, s = heapq.heappop(heap)
        dealt[r["row"]] = s
        heapq.heappush(heap, (load + r["size"], s))
    loads = [load for load, _ in sorted(heap, key=lambda x: x[1])]
    spark = singles.sparkSession
    placed = spark.createDataFrame(list(dealt.items()), "row long, shard int")
    small = singles.where(~large).withColumn("bucket", _bucket(F.col("row"), "fill", buckets))
    sums = [0] * buckets
    for r in small.groupBy("bucket").agg(F.sum("size").alias("n")).collect():
        sums[r["bucket"]] = r["n"]
    free = [max(0.0, level - load) for load in loads]
    scale = sum(sums) / sum(free) if sum(free) else 0.0
    bounds = list(accumulate(f * scale for f in free))[:-1]
    before = [0, *accumulate(sums)][:-1]
    order = W.partitionBy("bucket").orderBy("order", "row").rowsBetween(W.unboundedPreceding, 0)
    middle = _looked_up(before, F.col("bucket")) + F.sum("size").over(order) - F.col("size") / 2
    shard = F.size(F.filter(F.lit(bounds or [float("inf")]), lambda b: b <= middle)).cast("int")
    return singles.where(large).join(F.broadcast(placed), "row").unionByName(
        small.withColumn("shard", shard).drop("bucket")
    )


def _slots(placed: DataFrame, shards: int, buckets: int) -> DataFrame:
    """Places without gaps within every shard."""
    cut = staged(placed.withColumn("bucket", _bucket(F.col("row"), "slot", buckets)), "placed")
    counts = {(r["shard"], r["bucket"]): r["n"] for r in
              cut.groupBy("shard", "bucket").agg(F.count(F.lit(1)).alias("n")).collect()}
    before = [
        n for s in range(shards)
        for n in [0, *accumulate(counts.get((s, b), 0) for b in range(buckets))][:-1]
    ]
    offsets = cut.sparkSession.createDataFrame(
        [(i // buckets, i % buckets, n) for i, n in enumerate(before)], "shard int, bucket int, before long"
    )
    order = W.partitionBy("shard", "bucket").orderBy("order", "row")
    numbered = cut.withColumn("place", F.row_number().over(order))
    return numbered.join(offsets, ["shard", "bucket"]).withColumn(
        "slot", (F.col("before") + F.col("place") - 1).cast("long")
    )


def balanced_shards(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``key, size, text_crc32, group, shard, slot`` for every row; ``size`` is the text's UTF-8
    bytes plus 8, ``group`` tells equal texts (null for null texts)."""
    body = F.col("t").cast("binary")
    nodes = staged(
        docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("t")).select(
            F.monotonically_increasing_id().alias("row"), "id",
            (F.coalesce(F.octet_length("t"), F.lit(0)) + 8).cast("long").alias("size"),
            F.crc32(F.coalesce(body, F.lit(b""))).alias("text_crc32"), F.md5(body).alias("group"),
            F.xxhash64(F.col("id").cast("string"), F.md5(body)).alias("order"),
        ), "nodes",
    )
    total, rows = nodes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    buckets = buckets_for(rows)
    counted = nodes.where("group IS NOT NULL").groupBy("group").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = staged(counted, "groups")  # read plainly, so that the join below can be split
    marked = staged(nodes.join(groups, "group", "left"), "marked")
    level = max(1.0, total / shards)
    capacity = level * (1 + 1 / FINE)
    large = F.col("n") * F.col("size") > level / FINE
    hot = marked.where("n > 1").where(large)
    found = homes([tuple(r) for r in hot.groupBy("group").agg(F.first("n"), F.first("size")).collect()], shards, capacity)
    placed = staged(_placed_groups(hot, found, buckets).drop("n"), "placed-groups")
    fixed = _loads(placed, shards)
    linked = marked.where("n > 1").where(~large).drop("n").withColumn(
        "shard", F.pmod(F.xxhash64(F.lit("start"), "row"), F.lit(shards)).cast("int")
    )
    linked = _gathered(_propagated(linked, shards, capacity, fixed), fixed, total, buckets)
    loads = [a + b for a, b in zip(fixed, _loads(linked, shards), strict=True)]
    singles = marked.where("n IS NULL").drop("n")
    placed = placed.unionByName(linked).unionByName(_filled(singles, loads, total, buckets))
    return _slots(placed, shards, buckets).select(F.col("id").alias(key), "size", "text_crc32", "group", "shard", "slot")

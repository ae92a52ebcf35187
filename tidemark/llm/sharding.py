"""Sharding by best-fit-decreasing bin packing of indivisible groups."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.shared import attach, cut, number_rows, set_aside

#: Groups that one task packs at once.
LOT_GROUPS = 20_000

#: Groups of at least a shard's size over this are packed first, on the driver: there are at most this many times as many as shards.
HEAD_PARTS = 64

#: Where large groups are divided: a group over a shard's size is dealt by row hash into parts of about a shard's size over this.
SPLIT_PARTS = 8


class CapacityTree:
    """A height-balanced search tree of (remaining capacity, bin); finds the tightest bin that holds a size."""

    def __init__(self, items: Iterable[tuple[int, int]] = ()):
        self.root: list | None = None
        for item in items:
            self.add(item)

    @staticmethod
    def _height(node: list | None) -> int:
        return node[3] if node else 0

    def _balanced(self, node: list) -> list:
        left, right = self._height(node[1]), self._height(node[2])
        if left > right + 1:
            if self._height(node[1][2]) > self._height(node[1][1]):
                node[1] = self._lift(node[1], 2, 1)
            return self._lift(node, 1, 2)
        if right > left + 1:
            if self._height(node[2][1]) > self._height(node[2][2]):
                node[2] = self._lift(node[2], 1, 2)
            return self._lift(node, 2, 1)
        node[3] = 1 + max(left, right)
        return node

    def _lift(self, node: list, side: int, other: int) -> list:
        """Rotate so that the child on ``side`` comes above its parent."""
        child = node[side]
        node[side], child[other] = child[other], node
        for changed in (node, child):
            changed[3] = 1 + max(self._height(changed[1]), self._height(changed[2]))
        return child

    def add(self, item: tuple[int, int]) -> None:
        def into(node):
            if node is None:
                return [item, None, None, 1]
            side = 1 if item < node[0] else 2
            node[side] = into(node[side])
            return self._balanced(node)

        self.root = into(self.root)

    def remove(self, item: tuple[int, int]) -> None:
        def without(node, target):
            if target == node[0]:
                if node[1] is None or node[2] is None:
                    return node[1] or node[2]
                following = node[2]
                while following[1] is not None:
                    following = following[1]
                node[0] = following[0]
                node[2] = without(node[2], following[0])
            else:
                side = 1 if target < node[0] else 2
                node[side] = without(node[side], target)
            return self._balanced(node)

        self.root = without(self.root, item)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The entry of least remaining capacity that is at least ``size``."""
        node, found = self.root, None
        while node is not None:
            if node[0][0] >= size:
                node, found = node[1], node[0]
            else:
                node = node[2]
        return found

    def roomiest(self) -> tuple[int, int] | None:
        node = self.root
        while node is not None and node[2] is not None:
            node = node[2]
        return node[0] if node else None


def best_fit_decreasing(sizes: list[int], capacity: int, room: list[int] | None = None) -> tuple[list[int], list[int]]:
    """Bin of each item, and what each bin has left. Items enter in order of size, largest first, ties in the order given.

    With ``room`` the bins are fixed at those capacities, and an item that fits none goes to the roomiest, which then
    has less than nothing left. Without it, such an item opens a bin of ``capacity``.
    """
    left = list(room or [])
    tree = CapacityTree((r, i) for i, r in enumerate(left))
    bins = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[k]
        entry = tree.tightest(size)
        if entry is None and room is None:
            entry = (max(capacity, size), len(left))
            left.append(entry[0])
        else:
            entry = entry or tree.roomiest()
            tree.remove(entry)
        bins[k] = entry[1]
        left[entry[1]] = entry[0] - size
        tree.add((left[entry[1]], entry[1]))
    return bins, left


def shard_rooms(sizes: list[int], total: int, n_shards: int) -> list[int]:
    """What each shard is to hold: a group of more than an even share of what the larger ones leave fills a shard, the others are even."""
    rooms, rest = [], total
    for size in sorted(sizes, reverse=True):
        shards = n_shards - len(rooms)
        if shards < 2 or size * shards <= rest:
            break
        rooms.append(size)
        rest -= size
    shards = n_shards - len(rooms)
    return rooms + [max(1, -(-rest // shards))] * shards


def shard_groups(rows: DataFrame, key: str, size: str, n_shards: int | None = None, capacity: int | None = None, divide_large: bool = False) -> DataFrame:
    """Add ``shard`` (int) and ``slot`` (long, gapless from 0 in its shard) to rows; equal keys are one indivisible group.

    With ``n_shards`` the capacity is the least that can hold all, and shards come out near equal in bytes. With
    ``capacity`` as many shards are opened as best fit decreasing needs, up to ``LOT_GROUPS`` groups; more are packed in lots,
    whose bins are then packed like groups, so that lots don't each keep a shard part empty. A group larger than a shard's share has a
    shard of its own, and the others share the rest evenly; with ``divide_large`` it is dealt instead, by a hash of its rows, into
    parts that are packed like groups. With ``n_shards`` the few largest groups are packed first, on the driver; the others are dealt into lots of ``LOT_GROUPS`` and each lot fills
    its share of what the shards have left, so that no task or driver holds more than a bounded number of groups.
    Rows need a non-null key and size and an ``doc_id`` column, which orders a shard. Input columns named ``shard`` or ``slot`` are
    replaced, all others carried along. Repeated rows are rows of one group; an empty table gives no rows.
    """
    if (n_shards is None) == (capacity is None):
        raise ValueError("give either n_shards or capacity")
    rows, restored = set_aside(rows, list(dict.fromkeys(["doc_id", key, size])), ["shard", "slot"])
    rows = cut(rows)
    groups = rows.groupBy(key).agg(F.sum(size).alias("_bytes"))
    total, n_groups = groups.agg(F.coalesce(F.sum("_bytes"), F.lit(0)), F.count("*")).first()
    n_rows = rows.count()
    fixed = n_shards is not None
    capacity = max(1, -(-total // n_shards)) if fixed else capacity
    if divide_large:
        large = cut(groups.where(F.col("_bytes") > capacity).select(F.col(key), F.ceil(F.col("_bytes") * SPLIT_PARTS / F.lit(capacity)).alias("_parts")))
        rows = attach(rows, large, key, large.count()).withColumn("_part", F.coalesce(F.pmod(F.xxhash64("doc_id"), F.col("_parts")), F.lit(0))).drop("_parts")
    else:
        rows = rows.withColumn("_part", F.lit(0).cast("long"))
    units = rows.groupBy(key, "_part").agg(F.sum(size).alias("_bytes"))
    unit_type = T.StructType([rows.schema[key], T.StructField("_part", T.LongType()), T.StructField("shard", T.IntegerType())])
    lots = max(1, -(-n_groups // LOT_GROUPS))
    lot = F.pmod(F.xxhash64(key, "_part"), F.lit(lots)).cast("int")

    if fixed:
        least = max(1, capacity // HEAD_PARTS)
        units = cut(units)
        head = sorted(((r["_bytes"], str(r[key]), r["_part"], r[key]) for r in units.where(F.col("_bytes") >= least).collect()), key=lambda r: (-r[0], r[1], r[2]))
        bins, left = best_fit_decreasing([r[0] for r in head], capacity, shard_rooms([r[0] for r in head], total, n_shards))
        left = [max(0, x) for x in left]
        shares = [x / max(1, sum(left)) for x in left]

        def pack(lot_rows: pd.DataFrame) -> pd.DataFrame:
            lot_rows = lot_rows.sort_values(["_bytes", key, "_part"], ascending=[False, True, True])
            sizes = lot_rows["_bytes"].astype(int).tolist()
            # Whole bytes that add up to the lot's: the fractions' running sum is rounded, from a shard that depends on the lot.
            whole, running, turn = sum(sizes), 0.0, int(lot_rows["_lot"].iloc[0]) % len(shares)
            room = [0] * len(shares)
            for i in [*range(turn, len(shares)), *range(turn)]:
                room[i] = round((running + shares[i]) * whole) - round(running * whole)
                running += shares[i]
            lot_bins, _ = best_fit_decreasing(sizes, 0, room)
            return lot_rows[[key, "_part"]].assign(shard=pd.Series(lot_bins, index=lot_rows.index, dtype="int32"))

        tail = units.where(F.col("_bytes") < least).withColumn("_lot", lot)
        placed = tail.groupBy("_lot").applyInPandas(pack, unit_type)
        if head:
            first = [(r[3], r[2], b) for r, b in zip(head, bins)]
            placed = placed.unionByName(rows.sparkSession.createDataFrame(first, unit_type))
    else:

        def pack_open(lot_rows: pd.DataFrame) -> pd.DataFrame:
            lot_rows = lot_rows.sort_values(["_bytes", key, "_part"], ascending=[False, True, True])
            lot_bins, _ = best_fit_decreasing(lot_rows["_bytes"].astype(int).tolist(), capacity)
            return lot_rows[[key, "_part", "_bytes"]].assign(_bin=[int(lot_rows["_lot"].iloc[0]) << 32 | b for b in lot_bins])

        def pack_bins(lot_rows: pd.DataFrame) -> pd.DataFrame:
            lot_rows = lot_rows.sort_values(["_bytes", "_bin"], ascending=[False, True])
            lot_bins, _ = best_fit_decreasing(lot_rows["_bytes"].astype(int).tolist(), capacity)
            return lot_rows[["_bin", "_bytes"]].assign(_to=[int(lot_rows["_lot"].iloc[0]) << 32 | b for b in lot_bins])

        wide = T.StructType([*unit_type.fields[:2], T.StructField("_bytes", T.LongType()), T.StructField("_bin", T.LongType())])
        placed = cut(units.withColumn("_lot", lot).groupBy("_lot").applyInPandas(pack_open, wide))
        bins = cut(placed.groupBy("_bin").agg(F.sum("_bytes").alias("_bytes")))
        n_bins = bins.count()
        placed = placed.drop("_bytes")
        # Each lot leaves bins part empty: bins are packed like groups, until one lot holds them or few are saved.
        while lots > 1:
            before, lots = n_bins, -(-n_bins // LOT_GROUPS)
            merged = cut(bins.withColumn("_lot", F.pmod(F.xxhash64("_bin", F.lit(n_bins)), F.lit(lots)).cast("int")).groupBy("_lot").applyInPandas(pack_bins, "_bin long, _bytes long, _to long"))
            placed = cut(attach(placed, merged.select("_bin", "_to"), "_bin", n_bins, "inner").drop("_bin").withColumnRenamed("_to", "_bin"))
            bins = cut(merged.groupBy(F.col("_to").alias("_bin")).agg(F.sum("_bytes").alias("_bytes")))
            n_bins = bins.count()
            if n_bins > 0.9 * before:
                break
        from pyspark.sql import Window as W

        shards = cut(bins.select("_bin", (F.row_number().over(W.orderBy("_bin")) - 1).cast("int").alias("shard")))
        placed = attach(placed, shards, "_bin", n_bins, "inner").select(key, "_part", "shard")
    sharded = cut(rows.join(cut(placed), [key, "_part"]).drop("_part"))
    return restored(number_rows(sharded, ["shard"], ["doc_id"], "slot", n_rows))

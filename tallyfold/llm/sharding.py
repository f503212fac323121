"""Sharding by best-fit-decreasing bin packing of groups that stay together.

Groups are rows of equal text. Items sorted by size enter the bin with the least room that still fits, found in a
balanced (AVL) tree of bins by room.

For a wanted number of bins the smallest capacity that fits is searched by halving. A group larger than 1/UNITS of the
whole is an item of its own (there are fewer than UNITS of those, whatever the input); all others fall by a hash of their
text into UNITS items. So the packing sees 2 * UNITS items at most, while each of them is a tiny part of a bin.

For a given capacity groups are dealt by hash into slices of about SLICE_BINS bins, which tasks pack apart from each other: a
slice leaves one bin partly empty at most beyond what packing does. Groups of 1/SLICE_BINS of a bin or more are items, smaller
ones share SLICE_BINS ** 2 items of a slice, each about as small, so a task packs a bounded number of items whatever the input.

Defined cases: null texts are one group, empty texts another; equal rows get neighbouring slots; a null doc_id is a
key like any other; an empty table gives no row. Other columns of the input are carried along; columns named size,
shard, slot are replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.llm.store import settle

UNITS = 1 << 13
#: Bins that a task packs where the capacity is given.
SLICE_BINS = 64
#: Rows that are numbered in one task; a shard has as many slices as it takes.
SLICE_ROWS = 50_000
LEAST_SLICES = 64


class _Node:
    __slots__ = ("key", "left", "right", "height")

    def __init__(self, key):
        self.key, self.left, self.right, self.height = key, None, None, 1


def _height(node) -> int:
    return node.height if node else 0


def _turn(node, side: str):
    """Rotate so that the child on the other side comes up."""
    other = "left" if side == "right" else "right"
    up = getattr(node, other)
    setattr(node, other, getattr(up, side))
    setattr(up, side, node)
    for x in (node, up):
        x.height = 1 + max(_height(x.left), _height(x.right))
    return up


def _balanced(node):
    node.height = 1 + max(_height(node.left), _height(node.right))
    lean = _height(node.left) - _height(node.right)
    if abs(lean) < 2:
        return node
    side, other = ("left", "right") if lean > 0 else ("right", "left")
    child = getattr(node, side)
    if _height(getattr(child, other)) > _height(getattr(child, side)):
        setattr(node, side, _turn(child, side))
    return _turn(node, other)


class RoomTree:
    """Balanced tree of (room, bin) pairs."""

    def __init__(self):
        self.root = None

    def add(self, key: tuple[int, int]) -> None:
        def into(node):
            if node is None:
                return _Node(key)
            side = "left" if key < node.key else "right"
            setattr(node, side, into(getattr(node, side)))
            return _balanced(node)

        self.root = into(self.root)

    def take(self, room: int) -> tuple[int, int] | None:
        """Remove and return the pair with the least room that is ``room`` or more."""
        best, node = None, self.root
        while node:
            if node.key[0] >= room:
                best, node = node.key, node.left
            else:
                node = node.right

        def least(node):
            return least(node.left) if node.left else node.key

        def without(node, key):
            if key == node.key:
                if not node.left or not node.right:
                    return node.left or node.right
                node.key = key = least(node.right)
                node.right = without(node.right, key)
            elif key < node.key:
                node.left = without(node.left, key)
            else:
                node.right = without(node.right, key)
            return _balanced(node)

        if best is not None:
            self.root = without(self.root, best)
        return best


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """Bin of each item; an item above the capacity has a bin of its own, into which nothing more goes."""
    tree, bins, out = RoomTree(), 0, [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.take(sizes[i])
        if found is None:
            found, bins = (capacity, bins), bins + 1
        out[i] = found[1]
        if found[0] > sizes[i]:
            tree.add((found[0] - sizes[i], found[1]))
    return out


def pack_into(sizes: list[int], bins: int) -> list[int]:
    """Best fit decreasing with the smallest capacity for which ``bins`` bins are enough."""
    if not sizes:
        return []
    low, high = max(max(sizes), -(-sum(sizes) // bins)), max(sizes) + -(-sum(sizes) // bins)
    best = best_fit_decreasing(sizes, high)
    while low < high:
        middle = (low + high) // 2
        packed = best_fit_decreasing(sizes, middle)
        if max(packed) < bins:
            best, high = packed, middle
        else:
            low = middle + 1
    return best


class Packing(NamedTuple):
    shards: DataFrame
    n_shards: int


def utf8_size(text: Column, overhead: int) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(overhead)


def _into_bins(groups: DataFrame, rows: DataFrame, whole: int, n_shards: int) -> DataFrame:
    """Rows with the shard of their group, for a wanted number of shards."""
    spark = groups.sparkSession
    large = F.col("size") * UNITS > F.lit(whole)
    own = groups.where(large).select(F.col("text_group").alias("item"), "size").collect()  # fewer than UNITS
    unit = F.pmod("text_group", F.lit(UNITS))
    units = groups.where(~large).groupBy(unit.alias("item")).agg(F.sum("size").alias("size")).collect()  # UNITS or fewer
    items = sorted([(True, *r) for r in own] + [(False, *r) for r in units])
    bins = pack_into([r[2] for r in items], n_shards)
    placed = spark.createDataFrame([(a, b, s) for (a, b, _), s in zip(items, bins)], "own boolean, item long, shard int")
    singles = placed.where("own").select(F.col("item").alias("text_group"), F.col("shard").alias("own_shard"))
    shared = placed.where("not own").select("item", F.col("shard").alias("unit_shard"))
    return rows.join(F.broadcast(singles), "text_group", "left").join(
        F.broadcast(shared), unit == F.col("item"), "left").select(
        "doc", "key", "size", "text_group", F.coalesce("own_shard", "unit_shard").alias("shard"))


def _by_capacity(groups: DataFrame, rows: DataFrame, whole: int, capacity: int) -> tuple[DataFrame, int]:
    """Rows with the shard of their group, and the number of shards, for a given capacity."""
    n_slices = max(1, -(-whole // (capacity * SLICE_BINS)))
    hashed = F.xxhash64("text_group", F.lit(1))
    small = F.col("size") * SLICE_BINS < capacity
    dealt = groups.select("text_group", "size", F.pmod(hashed, F.lit(n_slices)).alias("slice"), (~small).alias("own"),
                          F.when(small, F.pmod(F.xxhash64("text_group", F.lit(2)), F.lit(SLICE_BINS**2))).otherwise(F.col("text_group")).alias("item"))
    items = dealt.groupBy("slice", "own", "item").agg(F.sum("size").alias("size"))

    def pack(slice_: pd.DataFrame) -> pd.DataFrame:
        ordered = slice_.sort_values(["own", "item"])
        return ordered[["slice", "own", "item"]].assign(bin=best_fit_decreasing(ordered["size"].tolist(), capacity))

    packed = settle(items.groupBy("slice").applyInPandas(pack, "slice long, own boolean, item long, bin long"))
    bins = packed.groupBy("slice").agg((F.max("bin") + 1).alias("n"))
    # a row for each slice
    before = settle(bins.select("slice", (F.sum("n").over(Window.orderBy("slice")) - F.col("n")).alias("before"), "n"))
    total = before.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shard = packed.join(before, "slice").select("slice", "own", "item", (F.col("before") + F.col("bin")).cast("int").alias("shard"))
    of_group = dealt.join(shard, ["slice", "own", "item"]).select("text_group", "shard")
    return rows.join(of_group, "text_group").select("doc", "key", "size", "text_group", "shard"), total


def shard_documents(docs: DataFrame, n_shards: int | None = None, capacity: int | None = None,
                    overhead: int = 16) -> Packing:
    """``docs`` with size, shard and slot.

    With ``n_shards`` sizes are near equal; with ``capacity`` the number of shards is made small instead. Groups are
    never split, so a group above the capacity has a shard of its own, which is larger.
    """
    if (n_shards is None) == (capacity is None):
        raise ValueError("give n_shards or capacity")
    spark = docs.sparkSession
    kept = [docs[c] for c in docs.columns if c not in ("size", "shard", "slot")]
    text = F.col("text").cast("string")
    # what equal texts share; texts that share it by chance only stay together too
    group = F.xxhash64(text, F.octet_length(text))
    rows = docs.select(F.struct(*kept).alias("doc"), F.col("doc_id").alias("key"), group.alias("text_group"),
                       utf8_size(text, overhead).alias("size"))
    groups = settle(rows.groupBy("text_group").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")))
    whole = groups.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows, total = (_into_bins(groups, rows, whole[0], n_shards), n_shards) if n_shards else _by_capacity(groups, rows, whole[0], capacity)
    # slots without one task for each shard: number within hashed slices, then add the slices before
    slices = max(LEAST_SLICES, -(-whole[1] // (max(total, 1) * SLICE_ROWS)))
    rows = rows.withColumn("part", F.pmod(F.xxhash64("key", "text_group"), F.lit(slices)))
    counts = rows.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n"))
    before = settle(counts.select("shard", "part", (F.sum("n").over(
        Window.partitionBy("shard").orderBy("part")) - F.col("n")).alias("before")))
    number = F.row_number().over(Window.partitionBy("shard", "part").orderBy(F.asc_nulls_first("key"), "text_group"))
    slotted = rows.withColumn("number", number).join(before, ["shard", "part"])
    return Packing(slotted.select("doc.*", "size", "shard", (F.col("before") + F.col("number") - 1).alias("slot")), total)

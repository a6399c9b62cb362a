"""Sharding by best-fit-decreasing bin packing.

Documents with equal text form an indivisible group. Groups, largest first, enter the bin whose remaining capacity is the
smallest that still holds them; the bins are kept in a balanced tree ordered by remaining capacity. Groups of one size are
interchangeable, so only the number of groups per size class is packed on the driver: classes are exact below 2,048 bytes and
rounded up to 11 significant bits above, which bounds them by about 55,000 whatever the corpus. Spark then numbers the groups of
each class and the documents of each shard with distributed running totals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import spread_rank, utf8
from leadlake.session import cut_lineage

PRECISION = 11  # significant bits of a size class
Node = tuple  # (priority, key, left, right)


class CapacityTree:
    """Treap of (remaining capacity, bin); priorities are a fixed hash of the key, so the shape depends on content only."""

    def __init__(self) -> None:
        self.root: Node | None = None

    def _split(self, node: Node | None, key: tuple[int, int]) -> tuple[Node | None, Node | None]:
        if node is None:
            return None, None
        priority, own, left, right = node
        if own < key:
            low, high = self._split(right, key)
            return (priority, own, left, low), high
        low, high = self._split(left, key)
        return low, (priority, own, high, right)

    def _merge(self, low: Node | None, high: Node | None) -> Node | None:
        if low is None or high is None:
            return low or high
        if low[0] > high[0]:
            return (low[0], low[1], low[2], self._merge(low[3], high))
        return (high[0], high[1], self._merge(low, high[2]), high[3])

    def add(self, key: tuple[int, int]) -> None:
        low, high = self._split(self.root, key)
        self.root = self._merge(self._merge(low, (hash((key, 0x9E3779B9)), key, None, None)), high)

    def remove(self, key: tuple[int, int]) -> None:
        low, rest = self._split(self.root, key)
        _, high = self._split(rest, (key[0], key[1] + 1))
        self.root = self._merge(low, high)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The smallest (remaining, bin) with remaining >= size."""
        node, found = self.root, None
        while node is not None:
            if node[1][0] >= size:
                found, node = node[1], node[2]
            else:
                node = node[3]
        return found


def best_fit_decreasing(classes: list[tuple[int, int]], capacity: int) -> Iterator[tuple[int, int, int]]:
    """``(size, bin, number of groups)`` for ``classes`` of (size, number of groups); no size exceeds ``capacity``."""
    tree, bins = CapacityTree(), 0
    for size, number in sorted(classes, reverse=True):
        while number:
            spot = tree.tightest(size)
            if spot is None:
                spot, bins = (capacity, bins), bins + 1
            else:
                tree.remove(spot)
            fits = min(number, spot[0] // size)
            yield size, spot[1], fits
            tree.add((spot[0] - fits * size, spot[1]))
            number -= fits


def even_packing(classes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int]]:
    """Best fit into exactly ``shards`` bins of the least capacity that suffices.

    A group larger than an even part of what is left gets a bin of its own, so that it does not loosen the others.
    """
    classes = sorted(((s, n) for s, n in classes if n), reverse=True)
    alone, left = [], shards
    while classes and left > 1 and classes[0][0] * left >= sum(s * n for s, n in classes):
        size, number = classes[0]
        left -= 1
        alone.append((size, left, 1))
        classes = ([(size, number - 1)] if number > 1 else []) + classes[1:]
    if not classes:
        return alone
    low = max(classes[0][0], math.ceil(sum(s * n for s, n in classes) / left))

    def bins(capacity: int) -> int:
        return max(b for _, b, _ in best_fit_decreasing(classes, capacity)) + 1

    high = low
    while bins(high) > left:
        high = high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        if bins(middle) <= left:
            high = middle
        else:
            low = middle + 1
    return [*alone, *best_fit_decreasing(classes, high)]


def size_class(size: str) -> Column:
    """Size rounded up to PRECISION significant bits."""
    bits = F.greatest(F.length(F.bin(size)) - PRECISION, F.lit(0))
    step = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    above = F.col(size) + step - 1
    return (above - F.pmod(above, step)).cast("long")


def measured(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, text_crc32, text_key)``: UTF-8 bytes plus one, checksum and SHA-256 of the text; null counts as empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(utf8()) + 1).cast("long").alias("size"),
        F.crc32(utf8()).cast("long").alias("text_crc32"), F.unhex(F.sha2(utf8(), 256)).alias("text_key"))


def _placed(docs: DataFrame, plan) -> DataFrame:
    rows = cut_lineage(measured(docs))
    groups = cut_lineage(rows.groupBy("text_key").agg(F.sum("size").alias("bytes")).withColumn("class", size_class("bytes")))
    classes = [(r["class"], r["n"]) for r in groups.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()]
    spans: dict[int, tuple[list[int], list[int]]] = {}
    for size, shard, number in plan(classes):
        ends, bins = spans.setdefault(size, ([], []))
        ends.append((ends[-1] if ends else 0) + number)
        bins.append(shard)
    spark = docs.sparkSession
    table = spark.createDataFrame([(s, e, b) for s, (e, b) in spans.items()], "class long, ends array<long>, bins array<int>")
    ranked = spread_rank(groups, ["class"], ["text_key"], sum(n for _, n in classes), "at")
    # one row per size class, bounded by PRECISION
    shards = ranked.join(F.broadcast(table), "class").select(
        "text_key", F.element_at("bins", F.size(F.filter("ends", lambda e: e <= F.col("at"))) + 1).alias("shard"))
    placed = cut_lineage(rows.join(shards, "text_key").select("doc_id", "size", "text_crc32", "shard"))
    result = spread_rank(placed, ["shard"], ["doc_id", "text_crc32", "size"], placed.count(), "slot")
    return result.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def pack(docs: DataFrame, capacity: int) -> DataFrame:
    """Every document in as few shards of ``capacity`` bytes as best fit finds; a group beyond the capacity has a shard alone.

    Columns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; ``slot`` counts from 0 without gaps in each shard. Null
    and empty texts are one group. Repeated rows are rows of one group. Other columns are ignored.
    """
    def plan(classes):
        large = [(s, n) for s, n in classes if s > capacity]
        rest = list(best_fit_decreasing([(s, n) for s, n in classes if s <= capacity], capacity))
        next_bin = max((b for _, b, _ in rest), default=-1) + 1
        for size, number in sorted(large, reverse=True):
            for _ in range(number):
                rest.append((size, next_bin, 1))
                next_bin += 1
        return rest

    return _placed(docs, plan)


def pack_into(docs: DataFrame, shards: int) -> DataFrame:
    """Every document in ``shards`` shards of near-equal bytes: best fit with the least capacity that needs no further shard.

    Columns and cases as in ``pack``; shards that no group needs stay empty.
    """
    return _placed(docs, lambda classes: even_packing(classes, shards))

"""Comparison of all rows that share a bucket, without a task that holds a whole bucket.

A bucket is cut into blocks of about ``size`` rows by a hash. Each pair of blocks is one group of at most two blocks, so a
task's memory is bounded and a hot bucket spreads over many tasks. Pairs exist only inside a task, as index arrays; the
caller reduces them to counts or to spanning edges.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 1024
# Pairs held at a time.
PAIRS = 2_000_000


def block_groups(rows: DataFrame, member: str, size: int = BLOCK) -> DataFrame:
    """Rows of buckets (columns ``tag`` int, ``key`` long) with two or more rows, one copy for each pair of blocks they belong to.

    ``member`` is the unique column within a bucket that deals rows into blocks. Adds ``lo``, ``hi`` and ``block``.
    """
    counts = rows.groupBy("tag", "key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    blocks = F.ceil(F.col("_n") / F.lit(size)).cast("int")
    placed = rows.join(counts, ["tag", "key"]).withColumn("_blocks", blocks).withColumn(
        "block", F.pmod(F.xxhash64(member), F.col("_blocks")).cast("int"))
    copies = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return copies.withColumn("lo", F.least("block", "_other")).withColumn("hi", F.greatest("block", "_other")).drop(
        "_n", "_blocks", "_other")


def partner_ranges(group: np.ndarray, cross: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First partner of each row and number of partners, for rows sorted by group and block.

    Inside one block a row meets the rows after it; between two blocks the rows of the first meet all of the second.
    """
    n = len(group)
    first = np.r_[True, group[1:] != group[:-1]]
    at = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    ends = np.r_[starts[1:], n]
    low = block == block[starts][at]
    n_low = np.add.reduceat(low.astype(np.int64), starts)
    begin = np.where(cross, (starts + n_low)[at], np.arange(n) + 1)
    count = np.where(cross & ~low, 0, ends[at] - begin)
    single = cross & (n_low == ends - starts)[at]  # only one of the two blocks has rows
    return begin, np.where(single, 0, count)


def map_pairs(groups: DataFrame, fn: Callable[[pa.Table, np.ndarray, np.ndarray], pa.Table], schema: str) -> DataFrame:
    """Apply ``fn(rows, i, j)`` to chunks of whole groups, where ``i`` and ``j`` are the row numbers of all pairs to compare."""
    names = ("tag", "key", "lo", "hi")

    def handle(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        columns = {c: rows.column(c).to_numpy() for c in (*names, "block")}
        change = np.zeros(rows.num_rows, dtype=bool)
        for c in names:
            change[1:] |= columns[c][1:] != columns[c][:-1]
        group = np.cumsum(change)
        begin, count = partner_ranges(group, columns["lo"] != columns["hi"], columns["block"])
        part = np.cumsum(count) // PAIRS
        part = part[np.searchsorted(group, group, side="left")]  # all rows of a group go by its first row
        for p in np.unique(part):
            at = np.flatnonzero(part == p)
            low, high = at[0], at[-1] + 1
            n = count[low:high]
            if not n.sum():
                continue
            i = np.repeat(np.arange(high - low), n)
            j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin[low:high] - low, n)
            yield from fn(rows.slice(low, high - low), i, j).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([*held, batch])
            change = np.zeros(rows.num_rows, dtype=bool)
            for c in names:
                values = rows.column(c).to_numpy()
                change[1:] |= values[1:] != values[:-1]
            last = int(np.flatnonzero(change)[-1]) if change.any() else 0
            if last:
                yield from handle(rows.slice(0, last))
            held = rows.slice(last).combine_chunks().to_batches()
        if held:
            yield from handle(pa.Table.from_batches(held))

    ordered = groups.repartition(*names).sortWithinPartitions(*names, "block")
    return ordered.mapInArrow(run, schema)


def spanning_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row number that each of ``n`` rows reaches over the links (i, j)."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(label, before):
            break
    return label

"""Helpers shared by the corpus operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage return.
# ``bytes.split()`` without arguments cuts at exactly these characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def task_count(spark: SparkSession, rows: int, rows_per_task: int) -> int:
    """Reducers for ``rows`` rows: the session's number, or more when tasks would exceed ``rows_per_task``."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / rows_per_task))


def utf8(column: str = "text") -> Column:
    """The UTF-8 bytes of a text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def packed(docs: DataFrame) -> Column:
    """All columns of ``docs`` as one struct ``kept``, so that no helper column can clash with them."""
    return F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("kept")


def unpacked(docs: DataFrame, **replaced: Column) -> list[Column]:
    """The columns that ``packed`` holds, with some replaced."""
    return [replaced.get(c, F.col("kept").getField(c)).alias(c) for c in docs.columns]


def batch_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]], schema: str) -> DataFrame:
    """Apply ``fn`` to every Arrow batch; it yields any number of batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from fn(batch)

    return df.mapInArrow(run, schema)


def sub_batches(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that ``column`` has about ``limit`` bytes in each part (one row at least)."""
    sizes = np.diff(np.frombuffer(batch.column(column).buffers()[1], np.int32)[
        batch.column(column).offset:batch.column(column).offset + batch.num_rows + 1])
    group = np.cumsum(sizes, dtype=np.int64) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for start, end in zip(edges, edges[1:]):
        if end > start:
            yield batch.slice(start, end - start)


def running_start(df: DataFrame, keys: list[str], sub: str, amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over the smaller values of ``sub``, for each ``keys`` and ``sub``.

    This is the first half of a distributed running total: only one row per key and sub-bucket meets the window.
    """
    sums = df.groupBy(*keys, sub).agg(F.sum(amount).alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(sub).rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(*keys, sub, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias(name))


def spread_rank(df: DataFrame, keys: list[str], order: list[str], rows: int, name: str,
                rows_per_task: int = 100_000) -> DataFrame:
    """Add ``name``: a gapless number from 0 within ``keys``, in an order fixed by the values of ``order``.

    ``df`` must be stored (it is read twice) and ``keys`` not null. A key's rows are dealt over sub-buckets by a hash of
    ``order``, numbered there, and shifted by the sizes of the sub-buckets before; so no key meets one task.
    """
    parts = max(1, math.ceil(rows / rows_per_task))
    dealt = df.withColumn("_sub", F.pmod(F.xxhash64(*order), F.lit(parts)))
    start = running_start(dealt, keys, "_sub", F.lit(1).cast("long"), "_start")
    inside = F.row_number().over(Window.partitionBy(*keys, "_sub").orderBy(*order)) - 1
    return dealt.withColumn("_inside", inside).join(start, [*keys, "_sub"]).withColumn(
        name, (F.col("_start") + F.col("_inside")).cast("long")).drop("_sub", "_inside", "_start")

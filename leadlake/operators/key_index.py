"""An index of the keys that a table holds, so that a batch is checked against the table without scanning it.

An index is a folder of runs. A run holds distinct keys, dealt by hash to buckets of about ``BUCKET_KEYS`` keys however many keys the
run has, one folder per bucket; beside each lies a Bloom filter of the bucket's hashes. A batch looks up the filters of the buckets that
its own keys fall into, reads only the buckets whose filter answers, and compares whole keys there: filters and hashes never decide alone.
What is read is bounded by the keys of the batch times the size of one bucket, for every run, whatever the size of the table.

Runs are merged by size: ``FAN`` runs of one level become one run of the next, so there are at most ``FAN`` runs for each power of ``FAN``
in the number of batches, and a key is rewritten once per level.

A run is named by its batch and written whole before its mark, the empty table ``done``. Runs without a mark are not read. A
batch that is replayed ignores the run that it left behind, gives the same answer again and replaces that run.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadlake.operators.dedup import keep_first

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keys of a bucket, on average.
BUCKET_KEYS = 65_536
# Runs of one level that become one of the next.
FAN = 8
# Bits of a filter per key, and probes per key: about one false answer in a hundred.
BITS_PER_KEY, PROBES = 10, 7
MARK = "buckets int, level int, replaces array<string>"


@dataclass(frozen=True)
class Run:
    name: str
    buckets: int
    level: int
    replaces: tuple[str, ...]


def _probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit positions, one row per probe. The hash is mixed again, because all hashes of a bucket share a remainder."""
    h = hashes.astype(np.int64).view(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    first, step = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return (first + np.arange(PROBES, dtype=np.uint64)[:, None] * step) % np.uint64(bits)


def bloom(hashes: np.ndarray) -> bytes:
    """Filter of the hashes."""
    bits = 8 * max(1, -(-len(hashes) * BITS_PER_KEY // 8))
    flags = np.zeros(bits, dtype=np.uint8)
    flags[_probes(hashes, bits).ravel()] = 1
    return np.packbits(flags).tobytes()


def may_contain(filter_bytes: bytes, hashes: np.ndarray) -> np.ndarray:
    """False only for hashes that the filter does not hold."""
    flags = np.frombuffer(filter_bytes, dtype=np.uint8)
    at = _probes(hashes, 8 * len(flags))
    return ((flags[at >> np.uint64(3)] >> (np.uint64(7) - (at & np.uint64(7))).astype(np.uint8)) & 1).all(axis=0)


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.col("_h"), F.lit(buckets)).cast("int")


def _filesystem(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def _finished(spark: SparkSession, folder: str) -> dict[str, Run]:
    """All marked runs, also those that a merged run stands for."""
    fs, pattern = _filesystem(spark, os.path.join(folder, "*", "done", "_SUCCESS"))
    marks = [f.getPath().getParent().toString() for f in fs.globStatus(pattern) or []]
    if not marks:
        return {}
    name = F.element_at(F.split(F.input_file_name(), "/"), -3)
    rows = spark.read.schema(MARK).parquet(*marks).select(F.url_decode(name).alias("name"), "*").collect()
    return {r["name"]: Run(r["name"], r["buckets"], r["level"], tuple(r["replaces"])) for r in rows}


def runs(spark: SparkSession, folder: str, ignore: str | None = None) -> list[Run]:
    """Runs that together hold the indexed keys, without run ``ignore``."""
    found = _finished(spark, folder)
    merged = {name for run in found.values() for name in run.replaces}
    return sorted((r for r in found.values() if r.name not in merged and r.name != ignore), key=lambda r: r.name)


def _write(keys: DataFrame, columns: Sequence[str], folder: str, name: str, count: int, level: int = 0,
           replaces: Sequence[str] = ()) -> None:
    """Write distinct ``keys`` as one run. A bucket's file is sorted by hash; a bucket is one task's group."""
    spark = keys.sparkSession
    path = os.path.join(folder, name)
    fs, mark = _filesystem(spark, os.path.join(path, "done"))
    fs.delete(mark, True)  # a run that is being replaced must not be read
    buckets = max(1, -(-count // BUCKET_KEYS))
    dealt = keys.select(*columns).withColumn("_h", _hash(columns)).withColumn("bucket", _bucket(buckets))
    dealt.repartition("bucket").sortWithinPartitions("bucket", "_h").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/keys")
    hashes = spark.read.schema("_h bigint, bucket int").parquet(f"{path}/keys")

    def filters(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"bucket": group["bucket"].iloc[:1], "bits": [bloom(group["_h"].to_numpy())]})

    hashes.groupBy("bucket").applyInPandas(filters, "bucket int, bits binary").write.mode("overwrite").partitionBy(
        "bucket").parquet(f"{path}/filters")
    spark.createDataFrame([(buckets, level, list(replaces))], MARK).coalesce(1).write.mode("overwrite").parquet(f"{path}/done")


def add_keys(keys: DataFrame, columns: Sequence[str], folder: str, name: str) -> None:
    """Add distinct keys that the index does not hold, as the run of batch ``name``."""
    _write(keys, columns, folder, name, keys.count())


def rebuild(table: DataFrame, columns: Sequence[str], folder: str, name: str) -> None:
    """Index all keys of a table that exists already, as the only run."""
    keys = table.select(*columns).distinct()
    _write(keys, columns, folder, name, keys.count(), replaces=[r.name for r in runs(table.sparkSession, folder)])


def _paths(spark: SparkSession, folder: str, part: str, wanted: dict[str, set[int] | None]) -> list[str]:
    """Folders of the wanted buckets (None: all) of each run that exist; the driver handles names of folders to read, as any scan does."""
    out = []
    for name, buckets in wanted.items():
        fs, path = _filesystem(spark, os.path.join(folder, name, part))
        out += [p for p in (f.getPath().toString() for f in fs.listStatus(path))
                if (tail := p.rsplit("/", 1)[1]).startswith("bucket=") and (buckets is None or int(tail[7:]) in buckets)]
    return out


def _read(spark: SparkSession, schema: str | T.StructType, paths: Sequence[str]) -> DataFrame:
    """The buckets' rows with their run and bucket, which the path names."""
    steps = F.split(F.input_file_name(), "/")
    return spark.read.schema(schema).parquet(*paths).withColumns({
        "run": F.url_decode(F.element_at(steps, -4)),
        "bucket": F.substring_index(F.element_at(steps, -2), "=", -1).cast("int"),
    })


def buckets_to_read(keys: DataFrame, columns: Sequence[str], folder: str, ignore: str | None = None) -> dict[str, set[int] | None]:
    """For each run the buckets that may hold one of the distinct ``keys``; None for a run of fewer keys than these, which is read whole."""
    spark = keys.sparkSession
    present, count = runs(spark, folder, ignore), keys.count()
    wanted: dict[str, set[int] | None] = {r.name: None for r in present if r.buckets * BUCKET_KEYS <= count}
    larger = [r for r in present if r.name not in wanted]
    if not larger or not count:
        return wanted if count else {}
    places = F.array(*[F.struct(F.lit(r.name).alias("run"), _bucket(r.buckets).alias("bucket")) for r in larger])
    asked = keys.select(_hash(columns).alias("_h")).distinct().select("_h", F.inline(places))
    touched: dict[str, set[int] | None] = {r.name: set() for r in larger}
    for row in asked.select("run", "bucket").distinct().collect():
        touched[row["run"]].add(row["bucket"])
    paths = _paths(spark, folder, "filters", touched)
    if not paths:
        return wanted

    def answer(mine: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        """The bucket, if its filter holds a hash of the batch. A group has fewer than about BUCKET_KEYS hashes, as the run is the larger."""
        hit = len(mine) and len(filters) and may_contain(filters["bits"].iloc[0], mine["_h"].to_numpy()).any()
        return (mine if hit else mine.iloc[:0])[["run", "bucket"]].head(1)

    by_bucket = lambda df: df.groupBy("run", "bucket")
    stored = _read(spark, "bits binary", paths)
    for row in by_bucket(asked).cogroup(by_bucket(stored)).applyInPandas(answer, "run string, bucket int").collect():
        wanted.setdefault(row["run"], set()).add(row["bucket"])
    return wanted


def known_keys(keys: DataFrame, columns: Sequence[str], folder: str, ignore: str | None = None) -> DataFrame:
    """Those of the distinct ``keys`` that the index holds; null equals null."""
    spark = keys.sparkSession
    mine = keys.select(*columns)
    paths = _paths(spark, folder, "keys", buckets_to_read(mine, columns, folder, ignore))
    if not paths:
        return mine.limit(0)
    stored = spark.read.schema(mine.schema).parquet(*paths).select(
        *[F.col(c).alias(f"_{c}") for c in columns], _hash(columns).alias("_g"))
    asked = mine.withColumn("_h", _hash(columns))
    same = reduce(and_, [asked[c].eqNullSafe(stored[f"_{c}"]) for c in columns])
    return asked.join(stored, (asked["_h"] == stored["_g"]) & same, "left_semi").select(*columns)


def merge_runs(spark: SparkSession, key_schema: T.StructType, folder: str, ignore: str | None = None) -> None:
    """Merge each level that has ``FAN`` runs. Runs of unfinished batches must be named by ``ignore``.

    The old runs stay until the new one has its mark; a merge that was interrupted is done again.
    """
    columns = key_schema.names
    while True:
        present = runs(spark, folder, ignore)
        full = [level for level in {r.level for r in present} if sum(r.level == level for r in present) >= FAN]
        if not full:
            return
        level = min(full)
        old = [r for r in present if r.level == level]
        paths = _paths(spark, folder, "keys", {r.name: None for r in old})
        keys = spark.read.schema(key_schema).parquet(*paths) if paths else spark.createDataFrame([], key_schema)
        # Runs hold different keys, as each was checked against those before it.
        _write(keys, columns, folder, f"level{level + 1}-{old[0].name}", keys.count(), level + 1, [r.name for r in old])


def append_new(batch: DataFrame, columns: Sequence[str], order: Sequence[Column], path: str, folder: str, name: str) -> None:
    """Append to ``path`` the first row of each key that the index in ``folder`` does not hold, and index it.

    Rows go to ``path/write_id=name``, which a replay of the same batch replaces as a whole. One writer at a time; a name is used
    for one batch only, whose predecessors are finished.
    """
    spark = batch.sparkSession
    key_schema = batch.select(*columns).schema
    merge_runs(spark, key_schema, folder, ignore=name)
    fresh = keep_first(batch, columns, order).persist()
    try:
        known = known_keys(fresh, columns, folder, ignore=name)
        known = known.select(*[F.col(c).alias(f"_{c}") for c in columns])
        same = reduce(and_, [fresh[c].eqNullSafe(known[f"_{c}"]) for c in columns])
        target = os.path.join(path, f"write_id={name}")
        fresh.join(known, same, "left_anti").write.mode("overwrite").parquet(target)
    finally:
        fresh.unpersist()
    added = spark.read.schema(batch.schema).parquet(target).select(*columns)
    add_keys(added, columns, folder, name)

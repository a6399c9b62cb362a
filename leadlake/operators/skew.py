"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.session import cut_lineage

# A key is hot when it has more than 1/HOT_SHARE of the rows. There are fewer than HOT_SHARE such keys,
# whatever the size of the table, so a table of hot keys is always small enough to broadcast.
HOT_SHARE = 1000
# Below this many rows a key is never hot.
HOT_ROWS = 100_000


def hot_limit(total: int) -> int:
    return max(total // HOT_SHARE, HOT_ROWS)


def skew_safe_lookup(big: DataFrame, small: DataFrame, key: str, weight: str, total: int) -> DataFrame:
    """Inner join of ``big`` (at most ``total`` rows) with ``small``, whose ``key`` is unique and whose
    ``weight`` column counts the key's rows in ``big``; the weight is not part of the result.

    Rows of hot keys meet a broadcast of fewer than HOT_SHARE entries and are not shuffled. In the shuffle join
    of the others no key holds more than 1/HOT_SHARE of the rows.
    """
    limit = hot_limit(total)
    if total <= limit:
        return big.join(small.drop(weight), key)
    small = cut_lineage(small)  # read three times
    hot = F.broadcast(small.filter(F.col(weight) > limit).drop(weight))
    heavy = big.join(hot, key)
    light = big.join(hot.select(key), key, "left_anti").join(small.filter(F.col(weight) <= limit).drop(weight), key)
    return heavy.unionByName(light)


def salted_join(big: DataFrame, small: DataFrame, key: str, total: int) -> DataFrame:
    """Inner join where hot keys of ``big`` (at most ``total`` rows) are split into parts of about ``hot_limit`` rows and their rows of
    ``small`` repeated for each part. Both sides may have several rows per key; only the list of hot keys is broadcast."""
    limit = hot_limit(total)
    if total <= limit:
        return big.join(small, key)
    hot = F.broadcast(
        big.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
        .select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_parts"))
    )
    parts = F.coalesce("_parts", F.lit(1))
    spread = F.pmod(F.xxhash64(*big.columns), parts).cast("int")
    left = big.join(hot, key, "left").withColumn("_salt", spread).drop("_parts")
    right = small.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    return left.join(right, [key, "_salt"]).drop("_salt")

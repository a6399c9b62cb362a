"""Similarity joins over distinct texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.functions import similarity

# Texts per task of the key function: enough to pay for a task, few enough to keep its output below a gigabyte.
FEWEST_TEXTS, MOST_TEXTS = 2_000, 200_000


def _tasks(total: int, cores: int) -> int:
    """Tasks for ``total`` texts: all cores if there is work for them, more when tasks would become too large."""
    return max(min(cores, -(-total // FEWEST_TEXTS)), -(-total // MOST_TEXTS), 1)


def _keyed(nodes: DataFrame, side: str, threshold: int, role: str, total: int) -> DataFrame:
    """Node rows repeated once per block key. The key is a hash of (group, block); a collision only adds a
    candidate, which the verification removes. The rows are spread first: a small table of texts is a lot of
    work per byte, and adaptive coalescing looks at bytes."""
    width = _tasks(total, nodes.sparkSession.sparkContext.defaultParallelism)
    keyed = similarity.with_block_keys(nodes.repartition(width), threshold, role)
    return keyed.select("*", F.explode("keys").alias("_key")).select(
        F.xxhash64("grp", "_key").alias(f"block_{side}"),
        F.col("signature").alias(f"sig_{side}"),
        F.length("text").alias(f"len_{side}"),
        *[F.col(c).alias(f"{c}_{side}") for c in ("text", "grp", "own") if c in nodes.columns],
    )


def candidate_pairs(short: DataFrame, long: DataFrame, threshold: int, total: int) -> DataFrame:
    """Pairs of nodes in one group that pass the lossless filters, each once: ``text_a, own_a, text_b, own_b``.

    Both inputs have ``grp`` (equality group) and ``text`` (words sorted, not empty); a short node may be looked
    up in a group other than its ``own``. ``total`` is at least the number of rows of ``long`` and at most a
    small multiple of it. The left side of a result is never longer than the right side.

    With D the most insertions plus deletions a pair may have, a true pair differs by at most D in length, in at
    most D signature bits and in at most D Levenshtein edits. The cheap tests come first, and all run inside the
    join, before a pair is emitted.
    """
    a = _keyed(short, "a", threshold, "short", total)
    b = _keyed(long, "b", threshold, "long", total)
    if "own" not in short.columns:
        a = a.withColumn("own_a", F.col("grp_a"))
    budget = similarity.edit_budget(F.col("len_a"), F.col("len_b"), threshold)
    same_length_order = F.when(
        F.col("text_a") == F.col("text_b"), F.col("own_a") < F.col("grp_b")
    ).otherwise(F.col("text_a") < F.col("text_b"))
    flipped = F.bit_count(F.col("sig_a").bitwiseXOR(F.col("sig_b")))
    condition = (
        (F.col("block_a") == F.col("block_b"))
        & (F.col("len_a") <= F.col("len_b"))
        & (flipped * 100 <= (F.col("len_a") + F.col("len_b")) * (100 - threshold))  # whole numbers, most end here
        & (F.col("len_b") - F.col("len_a") <= budget) & (flipped <= budget)
        # Equality of the groups, written so that it stays a filter and the join key stays one number.
        & (F.col("grp_a") <= F.col("grp_b")) & (F.col("grp_a") >= F.col("grp_b"))
        & ((F.col("len_a") < F.col("len_b")) | same_length_order)
        & (F.call_function("levenshtein", F.col("text_a"), F.col("text_b"), budget) >= 0)
    )
    # Size estimates ignore that explode multiplies rows, so the planner would broadcast a side of any real size.
    # A sort-merge join spills and lets AQE split the partitions of frequent blocks.
    return a.hint("merge").join(b, condition).select(
        "text_a", "own_a", "text_b", F.col("grp_b").alias("own_b")
    ).distinct()


def similar_pairs(short: DataFrame, long: DataFrame, threshold: int, total: int) -> DataFrame:
    """Candidate pairs whose exact similarity reaches the threshold, with the ``score``."""
    pairs = candidate_pairs(short, long, threshold, total)
    return pairs.withColumn("score", similarity.similarity("text_a", "text_b")).filter(F.col("score") >= threshold)

"""Mixing sources to target weights by weighted fair queueing.

Every source may give each document up to ``MAX_EPOCHS`` times. The copies of a source are shuffled (by a hash of document and
epoch, so reruns agree), and each gets a virtual finish time: the words of its source up to and including
it, divided by the source's target. All copies in the order of their finish times are the mix: at any point of this order all
sources have come equally far towards their targets. Targets add up to the budget, so the total reaches it at time 1; a copy
that is being taken then is cut to the words its source still lacks, and what would begin later is left out.

Running totals are kept in two steps (totals of narrow slices, then rows within a slice), so neither a
large source nor the global order meets one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import WORD, packed, running_start, unpacked
from leadlake.session import cut_lineage

WEIGHTS = (5, 2, 1)
SHARE = 1.5  # words of the mix per word of the input
MAX_EPOCHS = 2
ROWS_PER_SLICE = 100_000


def word_count(text: str = "text") -> Column:
    """Number of words; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(source, place, source_size, target)``, one row per source.

    Sources in code point order, null last, take ``weights`` in turn. A target stops at ``epochs`` times its source; what is
    over is shared by weight among the others. With sources sorted by size per weight, those before the first that stays
    below its limit are full, and the level of that first one holds for all after it.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") - 1) % len(weights) + 1)
    sums = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))  # one row per source from here on
    full = sums.withColumn("place", place).withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    by_limit = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    level = (F.lit(share) * F.sum("source_size").over(Window.partitionBy())
             - F.coalesce(F.sum("cap").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
             ) / F.sum("weight").over(by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    below = F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))
    return full.withColumn("level", level).withColumn("common", F.max(below).over(Window.partitionBy())).select(
        "source", "place", "source_size",
        F.least(F.col("cap").cast("double"), F.col("common") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, epochs: int = MAX_EPOCHS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, finishes)``, one row per document, whether taken or not.

    ``taken`` counts the words of all copies taken; only the copy at its source's target may be cut. ``finishes`` has the finish time
    of each copy of which at least half is taken. Null text has size 0 and takes nothing; null is a source of its own; rows that
    repeat are documents of their own. Documents of equal hash are ordered by id, size and row, so reruns give
    the same rows. Other columns are ignored.
    """
    sizes = cut_lineage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count().alias("size"), F.monotonically_increasing_id().alias("row")))
    targets = cut_lineage(source_targets(sizes, weights, share, epochs))
    copies = sizes.count() * epochs
    slices = max(1, math.ceil(copies / ROWS_PER_SLICE))

    key = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("epoch").cast("string")))
    drawn = sizes.filter("size > 0").join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "row", "place", "target",
        F.explode(F.sequence(F.lit(1), F.lit(epochs))).alias("epoch")).withColumn("key", key)
    # within a source: epoch after epoch, each in the order of its hash
    part = (F.col("epoch") - 1) * slices + F.floor(
        F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 2.0 ** 32 * slices)
    drawn = cut_lineage(drawn.withColumn("part", part.cast("long")))
    shuffled = ("epoch", "key", "doc_id", "size", "row")
    inside = F.sum("size").over(Window.partitionBy("place", "part").orderBy(*shuffled).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    start = F.col("before") + F.col("inside") - F.col("size")
    timed = drawn.withColumn("inside", inside).join(
        running_start(drawn, ["place"], "part", F.col("size"), "before"), ["place", "part"]).select(
        "row", "size", "place", "epoch", "key", "doc_id",
        F.least("size", F.floor("target") - start).alias("words"),
        F.least((start + F.col("size")) / F.col("target"), F.lit(1.0)).alias("finish")).filter("words > 0")
    timed = cut_lineage(timed.withColumn("slice", F.floor(F.col("finish") * slices)))
    # over all sources: the order of finish times, again slice by slice, up to the budget
    before = running_start(timed, [], "slice", F.col("words"), "before")
    budget = sizes.agg((F.sum("size") * F.lit(share)).alias("budget"))  # one row
    reached = F.sum("words").over(Window.partitionBy("slice").orderBy("finish", "place", *shuffled).rowsBetween(
        Window.unboundedPreceding, Window.currentRow))
    taken = timed.withColumn("reached", reached).join(before, "slice").join(F.broadcast(budget)).filter(
        F.col("before") + F.col("reached") <= F.col("budget")).groupBy("row").agg(
        F.sum("words").alias("taken"),
        F.sort_array(F.collect_list(F.when(2 * F.col("words") >= F.col("size"), F.col("finish")))).alias("finishes"))
    return sizes.join(taken, "row", "left").join(
        targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("finishes", F.array().cast("array<double>")).alias("finishes"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each row of ``docs``, with all its columns, as often as ``mix`` takes at least half of it.

    Rows are range-sorted by finish time, so any prefix of the table is mixed in the same proportions. Documents without words, null texts
    among them, never enter; an empty table gives no rows.
    """
    wanted = mix(docs, **options).filter(F.size("finishes") > 0).select("doc_id", "source", "size", "finishes").withColumn(
        "n", F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("finishes")))
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("id"), F.col("source").cast("string").alias("origin"),
                       word_count().alias("words"), "text")
    numbered = rows.withColumn("place", F.row_number().over(Window.partitionBy("id", "origin", "words").orderBy("text")))
    taken = numbered.join(wanted, F.col("id").eqNullSafe(F.col("doc_id")) & F.col("origin").eqNullSafe(F.col("source"))
                          & (F.col("words") == F.col("size")) & (F.col("place") == F.col("n")))
    return taken.select("kept", "id", F.explode("finishes").alias("finish")).orderBy("finish", "id").select(*unpacked(docs))

"""Identities that grow batch by batch, without resolving stored records again.

A store is a folder with one sub-folder per batch: the batch's new ``members`` (what the rules compare, per anchor), the ``labels`` of its
new anchors, and ``merges`` of identities that the batch found to be one. A batch is compared with stored members that it can match
(equal email or domain, similar company); its edges contract onto stored identities, so the graph that has to be solved is as large
as the batch, not as the store. An identity keeps its label for ever, or is reported as merged into an older one.

Each of the three tables is written whole before the batch's mark, an empty table ``done``, appears. A batch that was interrupted has no
mark, is not read, and may simply be run again.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.operators.components import connected_components
from leadlake.operators.identity import DEFAULT_THRESHOLD, MEMBER, member_edges, members_of
from leadlake.session import cut_lineage

TABLES = {
    "members": ", ".join(f"{c} string" for c in MEMBER),
    "labels": "anchor string, label string",
    "merges": "retired string, kept string",
}


def _batches(spark: SparkSession, folder: str) -> list[str]:
    marks = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "batch-*", "done", "_SUCCESS"))
    found = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    return sorted(f.getPath().getParent().getParent().toString() for f in found or [])


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    batches = _batches(spark, folder)
    if not batches:
        return spark.createDataFrame([], TABLES[table])
    return spark.read.schema(TABLES[table]).parquet(*(os.path.join(b, table) for b in batches))


def merged_labels(spark: SparkSession, folder: str) -> DataFrame:
    """``(retired, kept)``: for every label that was ever retired, the one that stands for it now."""
    merges = cut_lineage(_read(spark, folder, "merges"))
    groups = connected_components(merges, "retired", "kept")
    alive = groups.join(merges.select(F.col("retired").alias("id")), "id", "left_anti").select("component", F.col("id").alias("kept"))
    return merges.join(groups.withColumnRenamed("id", "retired"), "retired").join(alive, "component").select(
        "retired", alive["kept"]).distinct()


def labels(spark: SparkSession, folder: str) -> DataFrame:
    """``(id, component)`` of all stored anchors, as ``golden_records`` takes it."""
    stored = _read(spark, folder, "labels")
    now = merged_labels(spark, folder).withColumnRenamed("retired", "label")
    return stored.join(now, "label", "left").select(F.col("anchor").alias("id"), F.coalesce("kept", "label").alias("component"))


def add_batch(leads: DataFrame, folder: str, threshold: int = DEFAULT_THRESHOLD) -> DataFrame:
    """Resolve ``leads`` against the store and add them; returns the ``(retired, kept)`` labels that this batch merged.

    Records that are already stored change nothing. A store has one writer at a time and one threshold.
    """
    spark = leads.sparkSession
    stored, known = _read(spark, folder, "members"), labels(spark, folder)
    # Except compares nulls as equal.
    new = cut_lineage(members_of(leads, threshold).select(*MEMBER).subtract(stored.select(*MEMBER)))
    touched = _touched(stored, new)
    edges = member_edges(cut_lineage(touched.unionByName(new)), threshold, fresh=new)
    known = cut_lineage(known)
    vertex = lambda end: F.coalesce(F.col(f"{end}_label"), F.col(end)).alias(end)
    named = lambda end: known.select(F.col("id").alias(end), F.col("component").alias(f"{end}_label"))
    contracted = edges.join(named("src"), "src", "left").join(named("dst"), "dst", "left").select(vertex("src"), vertex("dst"))
    groups = connected_components(contracted)
    old = known.select(F.col("component").alias("id"), F.lit(True).alias("old")).distinct()
    marked = cut_lineage(groups.join(old, "id", "left"))
    # The smallest stored label stands for its group; a group of new anchors is named by its smallest.
    kept = marked.groupBy("component").agg(F.coalesce(F.min(F.when(F.col("old"), F.col("id"))), F.min("id")).alias("kept"))
    final = marked.join(kept, "component").select("id", "old", "kept")
    merges = final.filter("old and id != kept").select(F.col("id").alias("retired"), "kept")
    fresh = new.select("anchor").distinct().join(known.select(F.col("id").alias("anchor")), "anchor", "left_anti")
    fresh_labels = fresh.join(final.select(F.col("id").alias("anchor"), "kept"), "anchor", "left").select(
        "anchor", F.coalesce("kept", "anchor").alias("label"))
    path = os.path.join(folder, f"batch-{len(_batches(spark, folder)):08d}-{uuid.uuid4().hex}")
    new.write.parquet(os.path.join(path, "members"))
    fresh_labels.write.parquet(os.path.join(path, "labels"))
    merges.write.parquet(os.path.join(path, "merges"))
    spark.createDataFrame([], "done boolean").write.parquet(os.path.join(path, "done"))
    return spark.read.schema(TABLES["merges"]).parquet(os.path.join(path, "merges"))


def _touched(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Stored members with an email, domain or company that the new ones can match.

    Companies are similar, not equal, so all stored members with a company stay in; only their texts are compared.
    """
    has = lambda column: stored.filter(F.col(column).isNotNull() & (F.col(column) != "")).join(
        new.select(column).distinct(), column, "left_semi").select(*MEMBER)
    return has("n_email").unionByName(has("m_domain")).unionByName(stored.filter("n_company is not null").select(*MEMBER)).distinct()

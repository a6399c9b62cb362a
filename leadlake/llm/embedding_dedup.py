"""Near-duplicate vectors by Euclidean p-stable hashing.

Unit vectors at cosine c are sqrt(2 - 2c) apart. Each of TABLES tables buckets a vector by HASHES quantised Gaussian
projections floor((a.x + b) / WIDTH); close vectors meet in some table, and every pair that meets is checked by its exact cosine
in double precision. A pair at the threshold 0.98 (distance 0.2) agrees in one projection with probability 0.92, in a
table with 0.26, in at least one table with 0.999; unrelated vectors (distance 1.41) meet in a table with 1e-5.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.blocks import block_groups, map_pairs, spanning_labels
from leadlake.llm.common import batch_map
from leadlake.operators.components import connected_components
from leadlake.session import cut_lineage

COSINE = 0.98
TABLES = 24
HASHES = 16
WIDTH = 2.0
SEED = 20
# Pairs whose cosine is computed at a time.
CHUNK = 50_000


def projections(dimension: int, tables: int = TABLES, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions and offsets, the same in every task."""
    random = np.random.default_rng((SEED, dimension))
    return random.standard_normal((dimension, tables * hashes)), random.uniform(0, WIDTH, tables * hashes)


def bucket_keys(unit: np.ndarray, tables: int = TABLES, hashes: int = HASHES) -> np.ndarray:
    """A 64-bit bucket key for each row of unit vectors and each table."""
    directions, offsets = projections(unit.shape[1], tables, hashes)
    cells = np.floor((unit @ directions + offsets) / WIDTH).astype(np.int64).reshape(len(unit), tables, hashes)
    keys = np.full((len(unit), tables), unit.shape[1], dtype=np.uint64)
    for h in range(hashes):
        keys = (keys ^ cells[:, :, h].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def _matrix(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Rows of a list column by vector length: (row numbers, matrix)."""
    lengths = column.value_lengths().to_numpy()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    return [(at, flat[starts[at][:, None] + np.arange(n)])
            for n in np.unique(lengths) for at in [np.flatnonzero(lengths == n)]]


def hashed(classes: DataFrame, tables: int = TABLES, hashes: int = HASHES) -> DataFrame:
    """Add ``keys``, one bucket key per table, to rows with ``id``, ``label``, ``vector`` (not null, finite, not zero)."""
    def run(batch: pa.RecordBatch):
        keys = np.zeros((batch.num_rows, tables), dtype=np.int64)
        for at, vectors in _matrix(batch.column("vector")):
            scale = np.abs(vectors).max(axis=1, keepdims=True)  # against overflow of the squares
            unit = vectors / scale
            keys[at] = bucket_keys(unit / np.linalg.norm(unit, axis=1, keepdims=True), tables, hashes)
        label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
        keys ^= (label * np.int64(0x2545F4914F6CDD1D))[:, None]
        lists = pa.ListArray.from_arrays(np.arange(0, keys.size + 1, tables, dtype=np.int32), pa.array(keys.ravel()))
        yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "keys"])

    return batch_map(classes, run, "id long, label long, vector array<double>, copies long, low long, keys array<long>")


def links(classes: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(id, linked, root)``: for rows of ``hashed`` (stored), the copies linked to ``id`` in one comparison, and a row it reaches.

    A pair is counted only in its first common table, so the sum of ``linked`` over an id counts each partner once.
    """
    narrow = classes.select("id", F.posexplode("keys").alias("tag", "key"))
    groups = block_groups(narrow, "id").join(classes, "id")

    def run(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
        rows = rows.combine_chunks()
        ids, tag, label, copies = (rows.column(c).to_numpy() for c in ("id", "tag", "label", "copies"))
        keys = np.stack(rows.column("keys").to_numpy())
        near = np.zeros(len(i), dtype=bool)
        column = rows.column("vector").combine_chunks()
        column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
        where, unit = np.zeros(len(ids), dtype=np.int64), {}
        length = column.value_lengths().to_numpy()
        for at, vectors in _matrix(column):
            where[at] = np.arange(len(at))
            scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
            unit[vectors.shape[1]] = scaled / np.linalg.norm(scaled, axis=1, keepdims=True)
        same = np.flatnonzero((label[i] == label[j]) & (length[i] == length[j]))
        for size, vectors in unit.items():
            pairs = same[length[i[same]] == size]
            for start in range(0, len(pairs), CHUNK):
                p = pairs[start:start + CHUNK]
                near[p] = np.einsum("ij,ij->i", vectors[where[i[p]]], vectors[where[j[p]]]) >= cosine
        i, j = i[near], j[near]
        linked = np.zeros(len(ids), dtype=np.int64)
        for start in range(0, len(i), CHUNK):
            a, b = i[start:start + CHUNK], j[start:start + CHUNK]
            first = (keys[a] == keys[b]).argmax(axis=1) == tag[a]
            np.add.at(linked, a[first], copies[b[first]])
            np.add.at(linked, b[first], copies[a[first]])
        root = spanning_labels(len(ids), i, j)
        out = np.flatnonzero((linked > 0) | (root != np.arange(len(ids))))
        return pa.table({"id": ids[out], "linked": linked[out], "root": ids[root[out]]})

    return map_pairs(groups, run, "id long, linked long, root long")


def near_duplicates(embeddings: DataFrame, cosine: float = COSINE, tables: int = TABLES, hashes: int = HASHES) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector (columns ``vec_id``, ``embedding``, ``label``).

    Vectors link within a label if their cosine is ``cosine`` or more; equal vectors always do. A vector links with nothing if its
    label or it is null, if it is empty or all zeros, or holds null or non-finite numbers: 0 links, its own
    component, kept. A row without ``vec_id`` counts as a partner; its ``kept`` is null. Vectors of different lengths
    do not link. Copies are compared once. Other columns are ignored.
    """
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.col("label").isNotNull() & F.coalesce(finite & F.exists("vector", lambda x: x != 0), F.lit(False))
    rows = cut_lineage(rows.withColumn("usable", usable))
    grouped = rows.filter("usable").groupBy("label", "vector").agg(
        F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("low"))
    classes = cut_lineage(hashed(grouped.select(
        F.monotonically_increasing_id().alias("id"), "label", "vector", "copies", "low"), tables, hashes))
    found = cut_lineage(links(classes, cosine))
    labels = connected_components(found.filter("id <> root").select(F.col("id").alias("src"), F.col("root").alias("dst")))
    counted = found.groupBy("id").agg(F.sum("linked").alias("linked"))
    member = cut_lineage(
        classes.drop("keys").join(counted, "id", "left").join(labels, "id", "left").select(
            "label", "vector", "low", F.coalesce("component", "id").alias("component"),
            (F.coalesce("linked", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "component").select("label", "vector", "n_links", "component_id")
    linked = rows.filter("usable").join(named, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                 F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))

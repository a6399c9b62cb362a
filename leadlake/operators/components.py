"""Connected components with alternating star contractions (Kiveris et al., SoCC 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.operators.skew import skew_safe_lookup
from leadlake.session import cut_lineage

def _large_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Connect every larger neighbour of a vertex to the smallest vertex around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    lowest = both.groupBy("src").agg(F.min("dst").alias("low"), F.count(F.lit(1)).alias("degree")).withColumn(
        "low", F.least("src", "low")
    )
    linked = skew_safe_lookup(both, lowest, "src", "degree", 2 * n_edges)
    return linked.filter(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))


def _small_star(edges: DataFrame, n_edges: int) -> DataFrame:
    """Connect a vertex and its smaller neighbours to the smallest of them (edges point to the smaller end)."""
    lowest = edges.groupBy("src").agg(F.min("dst").alias("low"), F.count(F.lit(1)).alias("degree"))
    linked = skew_safe_lookup(edges, lowest, "src", "degree", n_edges)
    moved = linked.filter(F.col("dst") != F.col("low")).select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    kept = lowest.select("src", F.col("low").alias("dst"))
    return moved.unionByName(kept).distinct()


def _is_star_forest(edges: DataFrame) -> bool:
    """Every vertex points to one root and no root points anywhere."""
    inner = edges.join(edges.select(F.col("src").alias("dst")).distinct(), "dst", "left_semi")
    return inner.isEmpty()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(id, component)`` for every vertex that has an edge; the component is its smallest vertex.

    Rounds grow with the logarithm of the longest path, not with its length. Each round is cut by a reliable
    checkpoint. Vertices without edges are not listed.
    """
    a, b = F.col(src), F.col(dst)
    current = cut_lineage(
        edges.filter(a != b).select(F.greatest(a, b).alias("src"), F.least(a, b).alias("dst")).distinct()
    )
    size = current.count()  # a contraction never adds edges, so this bounds all rounds
    forest = size == 0
    while not forest:
        current = cut_lineage(_small_star(_large_star(current, size), size))
        forest = _is_star_forest(current)
    members = current.select(F.col("src").alias("id"), F.col("dst").alias("component"))
    roots = current.select(F.col("dst").alias("id"), F.col("dst").alias("component")).distinct()
    return members.unionByName(roots)

"""Parquet layers: union of sources, snapshots by run, empty-safe reads."""

from __future__ import annotations

from functools import reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_layer(spark: SparkSession, path: str, schema: str | None = None, merge_schema: bool = False) -> DataFrame:
    """All Parquet files below a folder, partition folders included.

    With a schema, a missing or empty folder gives an empty table and the schema inference pass is skipped.
    """
    reader = spark.read.option("mergeSchema", str(merge_schema).lower())
    if schema:
        reader = reader.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if schema and error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Rows of all tables; columns by name, absent ones null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def write_snapshot(df: DataFrame, path: str, run_id: str) -> None:
    """Add one run to a table that is partitioned by ``run_id``; repeating a run replaces only that run,
    also by no rows."""
    folder = quote(run_id, safe=" .,-_+@()$&!;~|<>")  # as Spark names partition folders
    df.drop("run_id").write.mode("overwrite").parquet(f"{path}/run_id={folder}")


def latest_snapshot(df: DataFrame, run_column: str = "run_id") -> DataFrame:
    """Rows of the newest run. The join side is one row, and a partitioned run column is pruned by it."""
    newest = df.agg(F.max(run_column).alias(run_column))
    return df.join(F.broadcast(newest), run_column, "left_semi")


def fetch_insights(spark: SparkSession, table: str = "gold.ai_lead_insights") -> DataFrame:
    """A warehouse table with lower-case column names."""
    df = spark.table(table)
    return df.toDF(*[c.lower() for c in df.columns])

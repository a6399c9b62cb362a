"""Layer health, latest reports and metric snapshots."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions.scoring import LEVELS

# Errors that mean "no table here yet"; any other error is raised.
ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per named table."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
              for name, df in layers.items()]
    return reduce(DataFrame.unionByName, counts)


def _layer_health(spark: SparkSession, name: str, path: str) -> DataFrame:
    """Files, rows and size of one folder. The file listing reads no content, the row count only footers."""
    try:
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.parquet").load(path)
            .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))
        )
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
    except AnalysisException as error:
        if error.getCondition() not in ABSENT:
            raise
        return spark.range(1).select(
            F.lit(name).alias("layer"), F.lit("EMPTY").alias("status"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("files", "rows", "size_kb")]
        )
    facts = files.unionByName(rows, allowMissingColumns=True).agg(*(F.max(c).alias(c) for c in ("files", "bytes", "rows")))
    return facts.select(
        F.lit(name).alias("layer"),
        F.when(F.col("rows") > 0, "OK").otherwise("EMPTY").alias("status"),
        "files", "rows", F.floor(F.col("bytes") / 1024).alias("size_kb"),
    )


def layer_health(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """One row per layer folder; a missing or empty folder has status EMPTY."""
    return reduce(DataFrame.unionByName, [_layer_health(spark, name, path) for name, path in paths.items()])


def overall_status(health: DataFrame) -> DataFrame:
    ok = F.bool_and(F.col("status") == "OK")
    return health.agg(F.when(ok, "HEALTHY").otherwise("NEEDS ATTENTION").alias("platform_status"))


def write_report(results: DataFrame, folder: str) -> None:
    """Add the few rows of a report to a folder as one JSON file that holds an array."""
    listed = F.to_json(F.sort_array(F.collect_list(F.struct(*results.columns))), {"ignoreNullFields": "false"})
    results.agg(listed.alias("value")).write.mode("append").text(folder)


def latest_report(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Rows of the newest JSON report in a folder (one JSON object per line or one array per file)."""
    listed = spark.read.format("binaryFile").load(folder).select("path", "modificationTime")  # a listing, no content
    newest = listed.agg(F.max_by("path", F.struct("modificationTime", "path"))).first()[0]
    if newest is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("multiLine", "true").json(newest)


def metrics_snapshot(layers: dict[str, DataFrame], gold: DataFrame, snapshot_at: Column | None = None,
                     previous_runs: int = 0) -> DataFrame:
    """Gauges as rows ``snapshot_at, metric, label, value``: rows per layer, leads per level, mean score, run count."""
    stamp = F.current_timestamp() if snapshot_at is None else snapshot_at
    counts = layer_counts(layers).select(
        F.lit("record_count").alias("metric"), F.col("layer").alias("label"), F.col("row_count").cast("double").alias("value")
    )
    facts = gold.agg(
        *[F.count_if(F.col("intent_level") == level).cast("double").alias(level) for level in LEVELS],
        F.bround(F.avg("lead_score"), 2).alias("score"),
    )
    entry = lambda metric, label, value: F.struct(
        F.lit(metric).alias("metric"), F.lit(label).alias("label"), value.alias("value"))
    rows = F.array(
        *[entry("leads_by_level", level, F.col(level)) for level in LEVELS],
        entry("avg_lead_score", "all", F.col("score")),
        entry("pipeline_runs_total", "all", F.lit(float(previous_runs + 1))),
    )
    gauges = facts.select(F.explode(rows).alias("m")).select("m.*")
    return counts.unionByName(gauges).select(stamp.alias("snapshot_at"), "*")

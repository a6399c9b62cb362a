"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for these jobs. AQE merges reducers up to the advisory size, splits skewed join partitions and
# demotes joins to broadcast only when the measured side is below the threshold. It never uses more reducers than
# spark.sql.shuffle.partitions: set that to about the shuffled bytes over the advisory size (``reducers_for``).
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def reducers_for(shuffled_bytes: int, advisory: int = 128 << 20) -> int:
    """A value of spark.sql.shuffle.partitions for jobs that shuffle so many bytes."""
    return max(200, -(-shuffled_bytes // advisory))


def build_session(app: str = "leadlake", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the defaults above; keyword settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and intermediate tables.

    A cluster must name it in ``spark.checkpoint.dir``. Only a local session, where driver and executors
    are one process, may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="leadlake-")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint, so a lost executor never replays the whole iteration history."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")

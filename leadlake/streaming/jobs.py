"""Bronze and silver as Structured Streaming jobs."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from leadlake import profiles
from leadlake.operators.dedup import keep_first
from leadlake.operators.key_index import append_new
from leadlake.operators.medallion import clean_leads, parse_envelope
from leadlake.operators.monitoring import ABSENT
from leadlake.schemas import BRONZE_LEAD

BRONZE_TRIGGER = "30 seconds"
SILVER_TRIGGER = "60 seconds"
# Most bytes of a micro-batch's keys that are broadcast.
BROADCAST_BYTES = 32 << 20
# Folders that a task of bronze writes side by side. Without a value Spark sorts the rows of a task by folder before it writes them, in
# memory that grows with the task; a task with more folders than this sorts its remaining rows.
OPEN_FOLDERS = 32
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _trigger(writer, every: str | None):
    """A processing-time trigger, or all available data and then stop."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_bronze(messages: DataFrame, path: str, checkpoint: str, every: str | None = BRONZE_TRIGGER) -> StreamingQuery:
    """Append parsed messages to Parquet, one folder per source. Exactly once through checkpoint and file log."""
    # The sink reads this from the session with every micro-batch, so it has to stay set.
    messages.sparkSession.conf.set("spark.sql.maxConcurrentOutputFileWriters", str(OPEN_FOLDERS))
    writer = (
        parse_envelope(messages).writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).partitionBy("source").outputMode("append")
    )
    return _trigger(writer, every).start()


def read_bronze_stream(spark: SparkSession, path: str, schema: str = BRONZE_LEAD, files_per_batch: int | None = None) -> DataFrame:
    """Streaming scan of a bronze folder with a fixed schema."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.parquet(path)


def clean_stream(bronze: DataFrame, profile: str = "stream") -> DataFrame:
    """Cleaned rows with processing time and layer tag, not yet deduplicated."""
    return clean_leads(bronze, profile, carry=("kafka_timestamp",)).withColumns(
        {"processed_at": F.current_timestamp(), "layer": F.lit("silver")}
    )


def start_silver(bronze: DataFrame, path: str, checkpoint: str, every: str | None = SILVER_TRIGGER,
                 dedup: str = "exact", delay: str = "1 day") -> StreamingQuery:
    """Append cleaned leads, one per (email, source).

    ``exact``      state holds every key ever seen; disk-backed, but it grows with the table.
    ``watermark``  state holds keys of the last ``delay`` of event time; a repeat after that passes again.
    ``table``      no state: each micro-batch drops keys that the silver table already has. The check against
                   the table also makes a replayed batch harmless.
    ``index``      no state: as ``table``, but against an index of keys in ``checkpoint/keys``, so what a micro-batch reads
                   follows its own keys, not the table. Rows carry the batch that wrote them in ``write_id``.
    """
    keys = list(profiles.STREAM.dedup_keys)
    cleaned = clean_stream(bronze)
    if dedup == "table":
        writer = cleaned.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, _: append_new_keys(batch.drop("kafka_timestamp"), path, keys)
        )
        return _trigger(writer, every).start()
    if dedup == "index":
        writer = cleaned.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
            lambda batch, number: _append_by_index(batch.drop("kafka_timestamp"), number, path, f"{checkpoint}/keys", keys)
        )
        return _trigger(writer, every).start()
    if dedup == "watermark":
        unique = cleaned.withWatermark("kafka_timestamp", delay).dropDuplicatesWithinWatermark(keys)
    else:
        unique = cleaned.dropDuplicates(keys)
    bronze.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    writer = (
        unique.drop("kafka_timestamp").writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).outputMode("append")
    )
    return _trigger(writer, every).start()


def append_new_keys(batch: DataFrame, path: str, keys: list[str]) -> None:
    """Append the first row of each key that the table at ``path`` does not have (null keys compare equal).

    The table is scanned for its key columns only. While the keys of the batch are small by counted bytes they are broadcast and the table
    is not shuffled; a larger batch is joined by shuffle.
    """
    fresh = keep_first(batch, keys, [F.col("lead_id").asc_nulls_last()]).persist()
    try:
        wanted = fresh.select(*[F.col(k).alias(f"_{k}") for k in keys])
        size = reduce(add, [F.coalesce(F.octet_length(k), F.lit(0)) + 16 for k in keys])
        if (fresh.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        try:
            table = batch.sparkSession.read.parquet(path).select(*keys)
        except AnalysisException as error:
            if error.getCondition() not in ABSENT:
                raise
            new = fresh  # first batch: no table yet
        else:
            match = lambda left, right: reduce(and_, [left[k].eqNullSafe(right[f"_{k}"]) for k in keys])
            known = table.join(wanted, match(table, wanted), "left_semi").distinct().toDF(*[f"_{k}" for k in keys])
            new = fresh.join(known, match(fresh, known), "left_anti")
        new.write.mode("append").parquet(path)
    finally:
        fresh.unpersist()


def _append_by_index(batch: DataFrame, number: int, path: str, folder: str, keys: list[str]) -> None:
    """One micro-batch through the key index. The query's id lasts as long as its checkpoint, so a batch has one name for ever."""
    stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    append_new(batch, keys, [F.col("lead_id").asc_nulls_last()], path, folder, f"{stream}-{number:010d}")


def run_streams(spark: SparkSession) -> None:
    """Wait until any of the running queries ends."""
    spark.streams.awaitAnyTermination()

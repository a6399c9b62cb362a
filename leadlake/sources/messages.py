"""Message broker source and sink. The transforms take any table of envelope shape, so files work as well."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_topic_stream(spark: SparkSession, topic: str, servers: str, **options: str) -> DataFrame:
    """Streaming scan from the earliest offset that tolerates expired data."""
    reader = (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("failOnDataLoss", "false")
    )
    return reader.options(**options).load()


def read_topic(spark: SparkSession, topic: str, servers: str, **options: str) -> DataFrame:
    """Everything in a topic up to now, as a batch."""
    reader = (
        spark.read.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
        .option("startingOffsets", "earliest").option("endingOffsets", "latest").option("failOnDataLoss", "false")
    )
    return reader.options(**options).load()


def to_key_value(records: DataFrame, key: str | None = None) -> DataFrame:
    """Records as ``key, value``: the key column as text (null without one) and the whole record as JSON."""
    key_column = F.col(key).cast("string") if key else F.lit(None).cast("string")
    value = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.select(key_column.alias("key"), value.alias("value"))


def write_topic(records: DataFrame, topic: str, servers: str, key: str | None = None) -> None:
    """Publish records; a write is confirmed by all replicas."""
    (
        to_key_value(records, key).write.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("kafka.acks", "all").option("topic", topic).save()
    )

"""Deliveries with retries, as a log of tries that only grows.

The state of a delivery follows from its tries alone, so a run that was interrupted or repeated finds the same work again, and what was sent
is never due. Waiting times double with every failed try.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.sources.tables import read_layer

TRIES = "delivery_id string, channel string, tried_at timestamp, status string, error string"
MAX_TRIES = 5
FIRST_WAIT_SECONDS = 60
MOST_DOUBLINGS = 16


def tries(spark: SparkSession, folder: str) -> DataFrame:
    return read_layer(spark, folder, TRIES)


def record(results: DataFrame, folder: str) -> None:
    """Append the tries of one run; the same try recorded twice counts once."""
    columns = [c.split()[0] for c in TRIES.split(", ")]
    results.select(*columns).write.mode("append").parquet(folder)


def state(log: DataFrame, max_tries: int = MAX_TRIES, first_wait: int = FIRST_WAIT_SECONDS) -> DataFrame:
    """One row per delivery: tries, last status (``sent`` once any try was), and when it is due again, if ever.

    ``sent`` and ``failed`` come from the log; a delivery that failed ``max_tries`` times is ``dead``.
    """
    latest = F.struct("tried_at", "status", "error")
    once = log.select("delivery_id", "channel", "tried_at", "status", "error").distinct()
    per = once.groupBy("delivery_id").agg(
        F.min("channel").alias("channel"),
        F.count_distinct("tried_at").alias("tries"),
        F.max("tried_at").alias("last_try"),
        F.bool_or(F.col("status") == "sent").alias("_sent"),
        F.max(latest)["error"].alias("_error"),
    )
    status = F.when(F.col("_sent"), "sent").when(F.col("tries") >= max_tries, "dead").otherwise("failed")
    wait = F.make_interval(secs=F.lit(first_wait) * F.pow(F.lit(2), F.least(F.col("tries") - 1, F.lit(MOST_DOUBLINGS))))
    return per.select(
        "delivery_id", "channel", "tries", status.alias("status"), "last_try",
        F.when(status == "failed", F.col("last_try") + wait).alias("next_try"),
        F.when(status != "sent", F.col("_error")).alias("error"),
    )


def due(outbox: DataFrame, states: DataFrame, now: Column) -> DataFrame:
    """Rows of the outbox that were never tried, or failed and have waited long enough; ``delivery_id`` is unique on both sides."""
    blocked = states.filter((F.col("status") != "failed") | (F.col("next_try") > now)).select("delivery_id")
    return outbox.join(blocked, "delivery_id", "left_anti")


def summary(states: DataFrame) -> DataFrame:
    """Deliveries and tries by channel and status."""
    return states.groupBy("channel", "status").agg(F.count(F.lit(1)).alias("deliveries"), F.sum("tries").alias("tries"))

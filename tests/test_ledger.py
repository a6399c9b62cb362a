"""Deliveries with retries: waiting times, the end after too many tries, repeated runs."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from leadlake.operators import ledger

START = datetime(2026, 6, 1)


def log(spark, *rows):
    return spark.createDataFrame([(d, "slack", START + timedelta(seconds=s), status, None if status == "sent" else f"e{s}")
                                  for d, s, status in rows], ledger.TRIES)


def states(spark, *rows, **limits):
    return {r.delivery_id: r for r in ledger.state(log(spark, *rows), **limits).collect()}


def test_state_follows_from_the_tries(spark):
    got = states(spark, ("a", 0, "failed"), ("a", 60, "failed"), ("b", 0, "failed"), ("b", 60, "sent"), ("b", 90, "failed"),
                 ("c", 0, "failed"), ("c", 0, "failed"), *[("d", s, "failed") for s in range(3)], max_tries=3)
    assert {k: (r.tries, r.status) for k, r in got.items()} == {"a": (2, "failed"), "b": (3, "sent"), "c": (1, "failed"), "d": (3, "dead")}
    assert got["a"].next_try == START + timedelta(seconds=60 + 120) and got["c"].next_try == START + timedelta(seconds=60)
    assert got["b"].next_try is None and got["d"].next_try is None
    assert got["a"].error == "e60" and got["b"].error is None and got["d"].error == "e2"
    assert states(spark) == {}
    assert states(spark, *[("z", s, "failed") for s in range(100)], max_tries=200)["z"].tries == 100


def test_a_run_that_is_repeated_sends_nothing_twice(spark, tmp_path):
    folder = str(tmp_path / "log")
    box = spark.createDataFrame([("a", "slack"), ("b", "n8n"), ("c", None)], "delivery_id string, channel string")
    sent = []
    for second in (0, 1, 59, 60, 61, 300):
        now = F.lit(START + timedelta(seconds=second))
        todo = ledger.due(box, ledger.state(ledger.tries(spark, folder)), now)
        sent += [(second, r.delivery_id) for r in todo.collect()]
        status = F.when((F.col("delivery_id") == "a") & F.lit(second == 0), "failed").otherwise("sent")
        results = todo.withColumns({"tried_at": now, "status": status, "error": F.lit(None).cast("string")})
        ledger.record(results, folder)
    assert sorted(sent) == [(0, "a"), (0, "b"), (0, "c"), (60, "a")]
    summary = {tuple(r) for r in ledger.summary(ledger.state(ledger.tries(spark, folder))).collect()}
    assert summary == {("slack", "sent", 1, 2), ("n8n", "sent", 1, 1), (None, "sent", 1, 1)}

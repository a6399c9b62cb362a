"""Expectations in pass, fail, missing-column and empty form; health and metrics."""

import json
import time

import pytest
from pyspark.sql import functions as F

from leadlake.operators import monitoring, quality

SCHEMA = "email string, lead_id string, source string, intent_level string, ingested_at string"
def now():
    return F.lit("2026-06-15 00:00:00").cast("timestamp")

GOOD = [("alice@test.com", "lead_001", "apollo", "hot", "2026-06-01T00:00:00"),
        ("bob@test.com", "lead_002", "hubspot", "warm", "2026-06-02T00:00:00+00:00")]
BAD = [("alice@test.com", "lead_001", "x", "hot", "2027-01-01T00:00:00"), (None, "lead_001", None, "odd", "not a date"),
       ("a@b", "lead_003", "x", None, None)]

CASES = [
    (quality.no_nulls("email"), 1, "FAIL — 1 nulls found in email"),
    (quality.unique("lead_id"), 1, "FAIL — 1 duplicates in lead_id"),
    (quality.unique("email"), 1, "FAIL — 1 duplicates in email"),
    (quality.values_in_set("source", ("apollo", "hubspot")), 3, "FAIL — 3 rows with invalid values"),
    (quality.row_count_above(4), 3, "FAIL — only 3 rows, expected >= 4"),
    (quality.no_future_dates("ingested_at"), 1, "FAIL — 1 future dates"),
    (quality.email_format("email"), 2, "FAIL — 2 invalid emails"),
]


def run(spark, rows, *checks):
    return quality.run_suite(spark.createDataFrame(rows, SCHEMA), checks, "L", now()).collect()


@pytest.mark.parametrize("check", [c for c, _, _ in CASES if c.min_rows is None], ids=lambda c: c.expectation)
def test_pass(spark, check):
    row = run(spark, GOOD, check)[0]
    assert (row.passed, row.status, row.message) == (True, "PASS", "PASS")
    assert isinstance(row.passed, bool)


@pytest.mark.parametrize("check, bad, message", CASES, ids=lambda c: getattr(c, "expectation", ""))
def test_fail(spark, check, bad, message):
    row = run(spark, BAD, check)[0]
    assert (row.passed, row.status, row.message) == (False, "FAIL", message)
    counts = [row.null_count, row.duplicate_count, row.future_count, row.invalid_count]
    assert row.total_rows == 3 and (check.min_rows or [c for c in counts if c is not None] == [bad])


@pytest.mark.parametrize("make, status", [
    (quality.no_nulls, "FAIL"), (quality.unique, "FAIL"), (lambda c: quality.values_in_set(c, ("x",)), "FAIL"),
    (quality.email_format, "FAIL"), (quality.no_future_dates, "SKIP")])
def test_missing_column(spark, make, status):
    row = run(spark, GOOD, make("absent"))[0]
    assert (row.status, row.passed) == (status, status == "SKIP")
    assert row.message == f"{status} — column absent not found"


def test_empty_table(spark):
    rows = run(spark, [], *[c for c, _, _ in CASES])
    assert [r.passed for r in rows] == [True, True, True, True, False, True, True]
    assert rows[0].null_pct == 0


def test_one_aggregate_per_table(spark):
    df = quality.run_suite(spark.createDataFrame(GOOD, SCHEMA), quality.SUITES["BRONZE"], "BRONZE", now())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_invalid_values_and_summary(spark):
    bad = spark.createDataFrame(BAD, SCHEMA)
    assert {(r.invalid_value, r.row_count) for r in quality.invalid_values(bad, "source", ("apollo",)).collect()} == {("x", 2), (None, 1)}
    results = quality.run_suite(bad, [quality.no_nulls("email"), quality.row_count_above(1), quality.no_future_dates("absent")], "L", now())
    assert quality.summary(results).first() == (3, 2, 1, 1, 66.7)
    assert quality.failures(results).count() == 1


def test_health_of_folders(spark, tmp_path):
    path = str(tmp_path / "full")
    spark.range(10).withColumn("source", F.col("id") % 2).repartition(1).write.partitionBy("source").parquet(path)
    empty = str(tmp_path / "empty")
    (tmp_path / "empty").mkdir()
    health = monitoring.layer_health(spark, {"full": path, "empty": empty, "absent": str(tmp_path / "absent")})
    rows = {r.layer: r for r in health.collect()}
    assert (rows["full"].status, rows["full"].files, rows["full"].rows) == ("OK", 2, 10)
    assert rows["empty"].status == rows["absent"].status == "EMPTY"
    assert monitoring.overall_status(health).first()[0] == "NEEDS ATTENTION"
    assert monitoring.overall_status(health.filter("layer = 'full'")).first()[0] == "HEALTHY"


def test_latest_report(spark, tmp_path):
    for name, passed in (("quality_1.json", False), ("quality_2.json", True)):
        (tmp_path / name).write_text(json.dumps([{"layer": "GOLD", "passed": passed}] * 2))
        time.sleep(1.1)
    rows = monitoring.latest_report(spark, str(tmp_path), "layer string, passed boolean").collect()
    assert [r.passed for r in rows] == [True, True]


def test_several_unique_checks_do_not_multiply_rows(spark):
    df = spark.createDataFrame([(1, "a", -0.0), (1, "b", 0.0), (None, "b", None), (2, None, 1.0)], "i int, s string, d double")
    checks = [quality.unique(c) for c in ("i", "s", "d", "i", "gone")] + [quality.no_nulls("s")]
    results = quality.run_suite(df, checks, "T")
    assert "Expand" not in results._jdf.queryExecution().executedPlan().toString()
    rows = results.orderBy("check_no").collect()
    assert [r.duplicate_count for r in rows] == [2, 2, 2, 2, None, None] and [r.total_rows for r in rows] == [4] * 6
    assert rows[4].status == "FAIL" and rows[5].null_count == 1
    empty = quality.run_suite(df.limit(0), checks[:2], "T").collect()
    assert [(r.duplicate_count, r.passed) for r in empty] == [(0, True)] * 2

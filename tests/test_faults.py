"""Errors that must not pass silently, and rules that must not change with size."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from leadlake.operators import activation, insights, monitoring, quality, summary
from leadlake.sources import generator, tables
from leadlake.streaming import jobs


def gold_of(spark, hot, cold):
    return spark.range(hot + cold).select(
        F.col("id").cast("string").alias("lead_id"), F.when(F.col("id") < hot, "hot").otherwise("cold").alias("intent_level"))


@pytest.mark.parametrize("hot,cold,blocks", [(999, 1000, 24), (1000, 1001, 24), (1000, 1000, 25), (3, 1, 37)])
def test_bar_has_one_rule_for_all_sizes(spark, hot, cold, blocks):
    rows = {r.intent_level: r for r in summary.intent_share(gold_of(spark, hot, cold)).collect()}
    assert len(rows["hot"].bar) == blocks and rows["warm"].bar == ""


def test_shares_round_half_to_even(spark):
    rows = {r.intent_level: r.share_pct for r in summary.intent_share(gold_of(spark, 13, 3)).collect()}
    assert (rows["hot"], rows["cold"]) == (81.2, 18.8)
    assert summary.intent_share(gold_of(spark, 0, 0)).filter("share_pct <> 0 or bar <> ''").count() == 0


def test_table_without_key_column_is_not_taken_for_absent(spark, tmp_path):
    path = str(tmp_path / "silver")
    batch = spark.createDataFrame([("1", "a@b.c", "apollo")], "lead_id string, email string, source string")
    batch.drop("source").write.parquet(path)
    with pytest.raises(AnalysisException):
        jobs.append_new_keys(batch, path, ["email", "source"])
    fresh = str(tmp_path / "fresh")
    for _ in range(2):
        jobs.append_new_keys(batch, fresh, ["email", "source"])
    assert spark.read.parquet(fresh).count() == 1


def test_unreadable_layer_is_not_reported_empty(spark, tmp_path):
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"this is no parquet file")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        monitoring.layer_health(spark, {"broken": str(tmp_path / "broken")}).collect()
    health = monitoring.layer_health(spark, {"absent": str(tmp_path / "absent")})
    assert health.first().status == "EMPTY"
    assert "Join" not in health._jdf.queryExecution().executedPlan().toString()


def test_repeating_a_run_without_rows_empties_it(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    tables.write_snapshot(rows, path, "2026-06-01T10:00:00")
    tables.write_snapshot(rows, path, "other")
    tables.write_snapshot(rows.limit(0), path, "2026-06-01T10:00:00")
    left = spark.read.parquet(path)
    assert {(r.id, str(r.run_id)) for r in left.collect()} == {(1, "other"), (2, "other")}


def test_latest_report_reads_one_file(spark, tmp_path):
    folder = str(tmp_path / "reports")
    for status in ("old", "new"):
        monitoring.write_report(spark.createDataFrame([(1, status), (2, None)], "no int, status string"), folder)
    rows = monitoring.latest_report(spark, folder, "no int, status string")
    assert [tuple(r) for r in rows.orderBy("no").collect()] == [(1, "new"), (2, None)]
    assert len(rows.inputFiles()) == 1


def test_answers_of_a_lead_are_one(spark):
    lead = spark.createDataFrame([("1", "a@b.c", 5)], "lead_id string, email string, employee_count int")
    answers = spark.createDataFrame(
        [("1", "oops"), ("1", '{"intent_score": 90, "employee_count": "many"}'), ("1", '{"intent_score": 10, "x": [1]}'), ("1", None)],
        "lead_id string, response string")
    got = insights.run_stage(lead, insights.INTENT, answers).collect()
    assert len(got) == 1 and got[0].intent_score == 10 and got[0].extra == {"x": "[1]"} and got[0].employee_count == 5
    again = insights.run_stage(insights.run_stage(lead, insights.INTENT, answers), insights.OUTREACH, spark.createDataFrame(
        [("1", '{"x": "new", "y": 2, "email": "n@b.c"}')], "lead_id string, response string")).first()
    assert again.extra == {"x": "new", "y": "2"} and again.email == "n@b.c"


def test_rank_follows_score(spark):
    rows = activation.activation_leads(generator.sample_insights(spark), ranked=True).collect()
    assert [(r["rank"], r.intent_level) for r in rows] == [(1, "hot"), (2, "warm")]
    assert generator.sample_insights(spark).columns.__len__() == 24


def test_summary_of_exact_half(spark):
    checks = [quality.row_count_above(1)] * 13 + [quality.row_count_above(9)] * 3
    assert quality.summary(quality.run_suite(spark.range(2), checks, "X")).first().pass_rate == 81.2

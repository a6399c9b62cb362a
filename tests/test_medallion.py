"""Bronze, silver and gold: where the profiles differ, score boundaries, and the plans."""

import pytest
from pyspark.sql import functions as F

from leadlake.functions import scoring
from leadlake.operators import medallion, summary
from leadlake.schemas import BRONZE_LEAD
from leadlake.sources import generator

COLUMNS = [part.strip().split(" ")[0] for part in BRONZE_LEAD.split(",")]


def raw(spark, *rows):
    base = {"lead_id": "l1", "source": "apollo", "first_name": "Ann", "last_name": "Lee", "email": "ann@x.com",
            "ingested_at": "2026-06-01T00:00:00"}
    return spark.createDataFrame([tuple({**base, **r}.get(c) for c in COLUMNS) for r in rows], BRONZE_LEAD)


def silver(df, profile):
    return medallion.silver_leads(medallion.bronze_leads(df) if profile == "warehouse" else df, profile)


@pytest.mark.parametrize("profile, kept", [("warehouse", {"a"}), ("stream", {"a", "b", "c"}), ("local", {"a", "c"})])
def test_row_filter(spark, profile, kept):
    df = raw(spark, {"lead_id": "a"}, {"lead_id": "b", "email": None}, {"lead_id": "c", "email": "None"})
    assert {r.lead_id for r in silver(df, profile).collect()} == kept


@pytest.mark.parametrize("profile, count", [("warehouse", 1), ("stream", 2), ("local", 1)])
def test_dedup_key(spark, profile, count):
    df = raw(spark, {"lead_id": "a"}, {"lead_id": "b", "source": "hubspot"}, {"lead_id": "c", "email": " ANN@x.com"})
    assert silver(df, profile).count() == count


def test_null_emails_are_one_group_per_source(spark):
    df = raw(spark, {"lead_id": "a", "email": None}, {"lead_id": "b", "email": None},
             {"lead_id": "c", "email": None, "source": "hubspot"})
    assert silver(df, "stream").count() == 2


def test_dedup_winner(spark):
    df = raw(spark, {"lead_id": "old"}, {"lead_id": "new", "ingested_at": "2026-06-02T00:00:00"})
    assert silver(df, "warehouse").first().lead_id == "new"
    assert medallion.silver_leads(df, "local", ("ingested_at",)).first().lead_id == "old"
    missing = raw(spark, {"lead_id": "new"}, {"lead_id": "untimed", "ingested_at": None})
    assert silver(missing, "warehouse").first().lead_id == "untimed"


@pytest.mark.parametrize("profile, name", [("warehouse", None), ("stream", "Lee"), ("local", "Lee")])
def test_full_name_with_missing_part(spark, profile, name):
    assert silver(raw(spark, {"first_name": None}), profile).first().full_name == name


@pytest.mark.parametrize("profile, domain", [("warehouse", "b"), ("stream", "b@c"), ("local", "b")])
def test_domain_of_two_ats(spark, profile, domain):
    assert silver(raw(spark, {"email": "a@b@c"}), profile).first().email_domain == domain
    assert silver(raw(spark, {"email": "none at all"}), profile).first().email_domain == ""


@pytest.mark.parametrize("profile, title", [("warehouse", "cto"), ("stream", " CTO "), ("local", "cto")])
def test_job_title(spark, profile, title):
    assert silver(raw(spark, {"job_title": " CTO "}), profile).first().job_title == title


@pytest.mark.parametrize("profile, none, blank, tab", [
    ("warehouse", "unknown", "", "\tvp"), ("stream", "none", "", "\tvp"), ("local", "none", "unknown", "vp")])
def test_seniority(spark, profile, none, blank, tab):
    for value, expected in (("None", none), ("", blank), ("\tVP", tab), (None, "unknown")):
        assert silver(raw(spark, {"seniority": value}), profile).first().seniority == expected


def test_completeness_of_blank_text(spark):
    df = raw(spark, {"company_name": "", "job_title": "", "company_domain": None})
    score = lambda p: medallion.score_leads(silver(df, p), p).first().completeness_score
    assert (score("warehouse"), score("stream"), score("local")) == (10, 7, 6)


@pytest.mark.parametrize("employees, points", [
    (None, 5), (9, 5), (10, 10), (49, 10), (50, 15), (199, 15), (200, 25), (999, 25), (1000, 30)])
def test_company_size(spark, employees, points):
    assert spark.range(1).select(scoring.company_size_points(F.lit(employees).cast("int")).alias("p")).first().p == points


@pytest.mark.parametrize("score, level, action", [
    (39, "cold", "enrich_data"), (40, "cool", "add_to_nurture"), (59, "cool", "add_to_nurture"),
    (60, "warm", "send_case_study"), (79, "warm", "send_case_study"), (80, "hot", "schedule_demo")])
def test_levels(spark, score, level, action):
    found = scoring.intent_level(F.lit(score))
    assert spark.range(1).select(found.alias("l"), scoring.recommended_action(found).alias("a")).first() == (level, action)


def test_all_combinations(spark):
    gold = medallion.gold_leads(silver(generator.all_combinations(spark), "warehouse"))
    assert {r.intent_level: r.lead_count for r in summary.score_distribution(gold).collect()} == {
        "hot": 21, "warm": 15, "cool": 3, "cold": 1}
    assert summary.score_stats(gold).first() == (76.875, 100, 35)


def test_bad_casts(spark):
    df = raw(spark, {}).withColumn("employee_count", F.lit("many"))
    assert medallion.bronze_leads(df).first().employee_count is None
    with pytest.raises(Exception):
        medallion.bronze_leads(df, strict=True).collect()


def test_offset_is_ignored_in_wall_clock_time(spark):
    row = medallion.bronze_leads(raw(spark, {"ingested_at": "2026-06-01T10:00:00+05:00"})).first()
    assert (row.ingested_at.hour, row.ingested_at.tzinfo) == (10, None)


def test_hot_email_is_reduced_before_the_shuffle(spark):
    df = raw(spark, {}).crossJoin(spark.range(1000)).drop("id")
    plan = silver(df, "warehouse")._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(email", 1)
    assert "WindowGroupLimit" in above and "WindowGroupLimit" in below and "Partial" in below


def test_generated_leads_do_not_depend_on_partitions(spark):
    one, many = (generator.generate_leads(spark.range(0, 500, 1, n), 3).drop("ingested_at") for n in (1, 7))
    assert one.exceptAll(many).isEmpty() and one.select("lead_id").distinct().count() == 500
    assert one.filter("lead_id = 'lead_0007'").count() == 1

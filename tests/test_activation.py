"""Insights, outbox, warehouse tables, sources and the end-to-end run."""

import json

import pytest
from pyspark.sql import functions as F

from leadlake.operators import activation, insights, medallion, warehouse
from leadlake.plans import pipeline
from leadlake.sources import generator, messages, payloads, tables


@pytest.fixture(scope="module")
def gold(spark):
    silver = medallion.silver_leads(medallion.bronze_leads(generator.all_combinations(spark)))
    return medallion.gold_leads(silver)


def test_fixed_answers(gold):
    row = insights.build_insights(gold.filter("lead_id = 'Bob-FinanceHub'")).first()
    assert (row.lead_score, row.score_intent_level, row.intent_level, row.intent_score) == (100, "hot", "cool", 50)
    assert (row.company_summary, row.company_stage, row.likely_tech_stack, row.pain_points) == ("Unable to enrich", "unknown", [], [])
    assert (row.buying_readiness, row.best_contact_channel, row.enrichment_confidence) == ("unknown", "email", 0)
    assert (row.urgency, row.deal_size_estimate, row.next_best_action) == ("medium", "smb", "Send introductory email")
    assert row.email_subject == "Quick question about FinanceHub"
    assert row.email_body.startswith("Hi Bob Smith,\n\nI saw") and row.email_body.endswith("\n\nBest,\nSales Team")
    assert row.cadence == ["Email day 0", "Follow-up day 3", "Final attempt day 7"] and row.pipeline_version == "1.0"


def test_answers_overlay_the_lead(spark, gold):
    leads = gold.select("lead_id", "intent_level").filter("lead_id like '%-TechCorp'")
    answers = spark.createDataFrame([
        ("Bob-TechCorp", '{"intent_score": 91, "intent_level": "hot", "intent_signals": ["a", "b"]}'),
        ("Alice-TechCorp", '{"intent_score": 5}'), ("Carol-TechCorp", "oops"), ("David-TechCorp", None), ("Emma-TechCorp", "[1]"),
    ], "lead_id string, response string")
    rows = {r.lead_id: r for r in insights.run_stage(leads, insights.INTENT, answers).collect()}
    bob, alice = rows["Bob-TechCorp"], rows["Alice-TechCorp"]
    assert (bob.intent_score, bob.intent_level, bob.intent_signals, bob.urgency) == (91, "hot", ["a", "b"], None)
    assert (alice.intent_score, alice.intent_level) == (5, "hot")
    assert all(rows[f"{n}-TechCorp"].intent_score == 50 for n in ("Carol", "David", "Emma", "Grace"))
    assert [r.lead_id for r in insights.rejected_responses(answers).collect()] == ["Emma-TechCorp"]


def test_scorer_function(gold):
    def scorer(prompts):
        assert prompts.columns == ["lead_id", "system_prompt", "user_prompt"]
        return prompts.select("lead_id", F.to_json(F.struct(F.length("user_prompt").alias("intent_score"))).alias("response"))
    row = insights.build_insights(gold, 3, {"intent": scorer})
    assert row.count() == 3 and row.filter("intent_score > 50").count() == 3


def test_prompt_defaults(spark):
    df = spark.createDataFrame([("l1", None)], "lead_id string, full_name string")
    prompt = insights.prompts(df, insights.INTENT).first().user_prompt
    assert "Name: None" in prompt and "Company: Unknown" in prompt and "Pain points: []" in prompt and "Records: 1" in prompt


def test_alert_payload(spark):
    leads = activation.activation_leads(generator.sample_insights(spark))
    rows = {r.lead_id: json.loads(r.p) for r in leads.select("lead_id", activation.alert_payload(leads.columns).alias("p")).collect()}
    blocks = rows["sample_1"]["blocks"]
    assert [b["type"] for b in blocks] == ["header", "section", "section", "section", "section", "divider"]
    assert blocks[0]["text"] == {"type": "plain_text", "text": "🔥 Hot Lead Alert — Ines Okafor"}
    assert blocks[1]["fields"][2]["text"] == "*Intent Score:*\n95/100" and blocks[1]["fields"][3]["text"] == "*Urgency:*\n🚨 critical"
    assert blocks[3]["text"]["text"] == "*📧 Suggested Email Subject:*\n_An idea for Northwind_" and blocks[5] == {"type": "divider"}
    assert rows["sample_2"]["blocks"][0]["text"]["text"].startswith("☀️")


def test_workflow_payload(spark):
    leads = activation.activation_leads(generator.sample_insights(spark))
    body = json.loads(leads.filter("lead_id = 'sample_1'").select(activation.workflow_payload(leads.columns)).first()[0])
    assert body["workflow_type"] == "hot_lead" and set(body["lead"]) == set(activation.WORKFLOW_FIELDS)
    assert body["lead"]["intent_score"] == 95 and body["lead"]["linkedin_message"] == "Hello Ines"


def test_outbox_sends_once(spark):
    leads = activation.activation_leads(generator.sample_insights(spark), ranked=True)
    assert [r.intent_score for r in leads.collect()] == [95, 72]
    first = activation.outbox(leads)
    assert first.count() == first.select("delivery_id").distinct().count() == 4
    assert activation.outbox(leads, first).isEmpty()
    assert activation.outbox(leads, first.filter("channel = 'slack'")).select("channel").distinct().collect()[0][0] == "n8n"


def test_ranks_of_equal_and_absent_scores(spark):
    """Leads without a score come last, and one score may span slices."""
    rows = [(f"lead{i:04d}", "hot" if i % 2 else "warm", 70 if i % 3 else None if i % 5 else 90 + i % 7) for i in range(900)]
    frame = spark.createDataFrame(rows + [("cold", "cold", 99)], "lead_id string, intent_level string, intent_score int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = [(r.lead_id, r.intent_score, r["rank"]) for r in activation.activation_leads(frame, ranked=True).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    want = sorted(rows, key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
    assert got == [(lead, score, i) for i, (lead, _, score) in enumerate(want, 1)]


def test_warehouse_tables(spark):
    df = spark.createDataFrame([("a", "None", ["x"], "bronze"), ("nan", "b", None, "bronze")], "id string, t string, l array<string>, layer string")
    rows = warehouse.prepare_for_warehouse(df).select("ID", "T", "L").collect()
    assert [tuple(r) for r in rows] == [("a", None, '["x"]'), (None, "b", None)]
    assert warehouse.load_table(df, "load_target") and not warehouse.load_table(df.limit(0), "load_target")
    assert warehouse.load_table(df.filter("id = 'a'"), "load_target") and spark.table("load_target").count() == 1
    assert warehouse.insights_table(generator.sample_insights(spark)).columns[:2] == ["LEAD_ID", "FULL_NAME"]
    warehouse.load_table(warehouse.insights_table(generator.sample_insights(spark)), "insight_target")
    assert tables.fetch_insights(spark, "insight_target").columns[0] == "lead_id"


def test_published_models(spark):
    gold = pipeline.publish_models(generator.all_combinations(spark))
    assert gold.count() == 40 and len(gold.columns) == 18
    assert {t.name: t.isTemporary for t in spark.catalog.listTables() if t.name in ("bronze_leads", "silver_leads")} == {
        "bronze_leads": True, "silver_leads": False}


def test_flattened_payloads(spark):
    person = {"id": "p1", "first_name": "Ann", "email": "a@x.com", "title": "CTO", "score": 7.5, "organization": {"name": "Acme", "estimated_num_employees": 12}}
    people = spark.createDataFrame([(json.dumps(person),), (json.dumps({"id": "p2", "organization": None}),)], "payload string")
    rows = payloads.flatten_people(people).orderBy("lead_id").collect()
    assert (rows[0].company_name, rows[0].employee_count, rows[0].job_title, rows[1].company_name) == ("Acme", 12, "CTO", None)
    assert json.loads(rows[0].raw_payload) == person and rows[0].ingested_at.endswith("+00:00")
    contact = {"id": "c1", "properties": {"firstname": "Bo", "jobtitle": "CEO", "hs_lead_status": "new"}}
    sent = pipeline.land_and_publish(people, spark.createDataFrame([(json.dumps(contact),)], "payload string"))
    record = sent["crm_events"].first()
    assert record.key == "c1" and json.loads(record.value)["event_type"] == "contact_sync"
    envelopes = [df.select(F.col("key").cast("binary"), F.col("value").cast("binary"), F.lit(t).alias("topic"), F.lit(0).alias("partition"),
                           F.lit(1).cast("bigint").alias("offset"), F.current_timestamp().alias("timestamp")) for t, df in sent.items()]
    assert {r.lead_id for r in pipeline.bronze_from_topics(*envelopes).collect()} == {"p1", "p2", "c1"}


def test_message_without_key(spark):
    row = messages.to_key_value(spark.createDataFrame([(1, None)], "a int, b string")).first()
    assert (row.key, row.value) == (None, '{"a":1,"b":null}')


def test_read_layer(spark, tmp_path):
    assert tables.read_layer(spark, str(tmp_path / "absent"), "a int").isEmpty()
    path = str(tmp_path / "runs")
    for run, size in (("r1", 3), ("r2", 2), ("r2", 4)):
        tables.write_snapshot(spark.range(size), path, run)
    df = tables.read_layer(spark, path)
    assert df.count() == 7 and tables.latest_snapshot(df).count() == 4


def test_batch_run(spark, tmp_path):
    layout = pipeline.Layout(str(tmp_path))
    for run in ("r1", "r2", "r2"):
        result = pipeline.run_batch(spark, generator.all_combinations(spark), layout, run)
    assert {r.intent_level: r.lead_count for r in result.collect()} == {"hot": 21, "warm": 15, "cool": 3, "cold": 1}
    assert [pipeline.latest_layer(spark, layout, layer).count() for layer in pipeline.LAYERS] == [40, 40, 40, 40, 10]
    checks = pipeline.check_layers(spark, layout)
    assert checks.count() == 16 and checks.filter("not passed").isEmpty()

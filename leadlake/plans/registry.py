"""The driver's queries: every operator over the given tables, or over leads derived from them.

``oracles.py`` holds the SQL each of them is compared with.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.functions import scoring, text
from leadlake.operators import (
    activation, answers, components, identity, identity_store, insights, ledger, medallion, monitoring, quality, summary, warehouse,
)
from leadlake.plans import pipeline
from leadlake.plans.fixtures import leads, leads_from, messages, table
from leadlake.operators.skew import skew_safe_lookup
from leadlake.session import cut_lineage, scratch_path
from leadlake.sources import generator, payloads, tables
from leadlake.sources import messages as broker
from leadlake.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
READ_ORDER = ("lead_id", "ingested_at")
CLOCK = "2026-06-15 00:00:00"


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _time_text(name: str = "ingested_at"):
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _bronze(spark, sf):
    return medallion.bronze_leads(leads(spark, sf))


def _cleaned(spark, sf):
    return medallion.clean_leads(_bronze(spark, sf))


def _silver(spark, sf):
    return medallion.silver_leads(_bronze(spark, sf))


def _gold(spark, sf):
    return medallion.gold_leads(_silver(spark, sf)).drop("scored_at")


def _gold_of(spark, sf, profile):
    silver = medallion.silver_leads(leads(spark, sf), profile, READ_ORDER)
    return medallion.gold_leads(silver, profile).drop("scored_at")


# ------------------------------------------------------------------------------------ sources and sinks

@query
def scan_leads(spark, sf):
    return leads(spark, sf)


@query
def union_sources(spark, sf):
    raw = leads(spark, sf)
    return tables.union_by_name(
        raw.filter("source = 'apollo'").select("lead_id", "source", "email", "employee_count", "apollo_score"),
        raw.filter("source = 'hubspot'").select("email", "lead_id", "lead_status", "source"),
    )


@query
def latest_snapshot(spark, sf):
    runs = leads(spark, sf).select("lead_id", "source", F.substring("ingested_at", 1, 10).alias("run_id"))
    return tables.latest_snapshot(runs)


@query
def flatten_people(spark, sf):
    organization = F.when(F.col("company_name").isNotNull(), F.struct(
        F.col("company_name").alias("name"), F.col("company_domain").alias("primary_domain"), "industry",
        F.col("employee_count").alias("estimated_num_employees"),
    ))
    person = F.struct(
        F.col("lead_id").alias("id"), "first_name", "last_name", "email", F.col("job_title").alias("title"), "seniority",
        F.col("apollo_score").alias("score"), organization.alias("organization"),
    )
    raw = leads(spark, sf).select(F.to_json(person).alias("payload"))
    return payloads.flatten_people(raw).drop("ingested_at", "raw_payload", "linkedin_url", "company_linkedin")


@query
def flatten_contacts(spark, sf):
    properties = F.struct(
        F.col("first_name").alias("firstname"), F.col("last_name").alias("lastname"), "email",
        F.col("company_name").alias("company"), F.col("job_title").alias("jobtitle"),
        F.col("lead_status").alias("hs_lead_status"), F.col("ingested_at").alias("createdate"),
    )
    raw = leads(spark, sf).select(F.to_json(F.struct(F.col("lead_id").alias("id"), properties.alias("properties"))).alias("payload"))
    return payloads.flatten_contacts(raw).drop("ingested_at", "raw_payload")


@query
def filter_titles_size(spark, sf):
    return payloads.search_filter(leads(spark, sf)).select("lead_id", "email", "job_title", "employee_count")


@query
def to_key_value(spark, sf):
    records = leads(spark, sf).select("lead_id", "source", "email", "employee_count")
    return broker.to_key_value(records, "lead_id")


@query
def generated_leads(spark, sf):
    ids = table(spark, sf, "customer").select("c_custkey")
    return generator.generate_leads(ids, seed=7).drop("ingested_at")


@query
def bronze_parse(spark, sf):
    envelope = table(spark, sf, "events").select(
        F.col("event_id").cast("string").cast("binary").alias("key"), F.col("props").cast("binary").alias("value"),
        F.col("event_type").alias("topic"), F.pmod("user_id", F.lit(4)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"), F.col("ts").alias("timestamp"),
    )
    return medallion.parse_envelope(envelope, "k bigint").select(
        "kafka_key", "topic", "partition", "offset", _time_text("kafka_timestamp"), "k", "is_corrupt", "layer"
    )


# -------------------------------------------------------------------------------------- medallion layers

@query
def bronze_leads(spark, sf):
    return _bronze(spark, sf).withColumn("ingested_at", _time_text())


@query
def silver_leads(spark, sf):
    return _silver(spark, sf).withColumn("ingested_at", _time_text())


@query
def silver_stream_filter(spark, sf):
    return medallion.clean_leads(leads(spark, sf), "stream")


@query
def silver_stream(spark, sf):
    return medallion.silver_leads(leads(spark, sf), "stream", READ_ORDER)


@query
def silver_local(spark, sf):
    return medallion.silver_leads(leads(spark, sf), "local", READ_ORDER)


@query
def gold_scores(spark, sf):
    return _gold(spark, sf)


@query
def gold_stream(spark, sf):
    return _gold_of(spark, sf, "stream")


@query
def gold_local(spark, sf):
    return _gold_of(spark, sf, "local")


@query
def completeness_variants(spark, sf):
    silver = medallion.clean_leads(leads(spark, sf), "local")
    return silver.select(
        "lead_id", "email",
        scoring.completeness_points("company_domain").alias("by_company_domain"),
        scoring.completeness_points("email_domain").alias("by_email_domain"),
        scoring.completeness_points("email_domain", truthy=True).alias("by_filled_text"),
    )


@query
def email_domain_variants(spark, sf):
    email = text.lower_trim("email")
    return leads(spark, sf).select(
        "lead_id", "email", text.domain_after_first_at(email).alias("after_first_at"),
        text.domain_part_two(email).alias("part_two"), text.normal_domain("email").alias("normal_domain"),
    )


@query
def full_name_variants(spark, sf):
    names = ("first_name", "last_name")
    return leads(spark, sf).select(
        "lead_id", text.name_skip_nulls(*names).alias("skip_nulls"),
        text.name_null_if_any_null(*names).alias("null_if_any"), text.name_stripped(*names).alias("stripped"),
    )


@query
def normalize_enums(spark, sf):
    out = [F.col("lead_id")]
    for name in ("seniority", "industry"):
        out += [
            text.enum_null_unknown(name).alias(f"{name}_stream"), text.enum_sentinel_unknown(name).alias(f"{name}_warehouse"),
            text.enum_blank_unknown(name).alias(f"{name}_local"),
        ]
    return leads(spark, sf).select(*out)


# ---------------------------------------------------------------------------------- summaries and top-k

@query
def score_distribution(spark, sf):
    return summary.score_distribution(_gold(spark, sf))


@query
def intent_share(spark, sf):
    return summary.intent_share(_gold(spark, sf))


@query
def score_stats(spark, sf):
    return summary.score_stats(_gold(spark, sf))


@query
def top_leads(spark, sf):
    return summary.top_leads(medallion.score_leads(_cleaned(spark, sf)), 10).select("lead_id", "email", "lead_score")


@query
def top5_leads(spark, sf):
    return summary.top_by_score(_gold(spark, sf))


def _stored_layers(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Silver and gold, each computed once."""
    silver = cut_lineage(_silver(spark, sf))
    return silver, cut_lineage(medallion.gold_leads(silver).drop("scored_at"))


@query
def layer_counts(spark, sf):
    silver, gold = _stored_layers(spark, sf)
    return monitoring.layer_counts({
        "raw": leads(spark, sf), "bronze": _bronze(spark, sf), "silver": silver, "gold": gold,
        "lineitem": table(spark, sf, "lineitem"), "events": table(spark, sf, "events"),
    })


# ----------------------------------------------------------------------------------- identity resolution

@query
def idr_normalize(spark, sf):
    raw = medallion.clean_leads(leads(spark, sf), "stream")
    return identity.normal_forms(raw).select("lead_id", "source", "m_email", "m_domain", "m_name", "m_company")


@query
def global_id(spark, sf):
    return _silver(spark, sf).select("lead_id", text.global_id("email", "email_domain").alias("global_id"))


@query
def idr_exact_email_groups(spark, sf):
    return identity.exact_email_groups(_cleaned(spark, sf))


@query
def idr_domain_candidates(spark, sf):
    return identity.domain_candidates(_cleaned(spark, sf))


@query
def idr_domain_pairs(spark, sf):
    return identity.domain_pairs(_cleaned(spark, sf))


@query
def idr_company_pairs(spark, sf):
    return identity.company_pairs(_cleaned(spark, sf))


@query
def idr_match_log(spark, sf):
    return identity.match_log(_cleaned(spark, sf))


@query
def idr_pair_priority(spark, sf):
    """Pairs explained by each rule, first rule first."""
    return identity.match_log(_cleaned(spark, sf)).groupBy("match_type", "confidence").agg(
        F.sum("pair_count").alias("pair_count"), F.count(F.lit(1)).alias("node_pairs")
    )


@query
def connected_components(spark, sf):
    """Leads linked by the same email or by the same name and company domain, so that chains occur."""
    people = cut_lineage(_cleaned(spark, sf).select("lead_id", "email", "full_name", "company_domain"))
    total = people.count()
    def star(keys):
        known = people.dropna(subset=keys)
        first = known.groupBy(*keys).agg(F.min("lead_id").alias("dst"), F.count(F.lit(1)).alias("size"))
        return skew_safe_lookup(known, first, keys, "size", total).filter("lead_id > dst").select(F.col("lead_id").alias("src"), "dst")
    return components.connected_components(star(["email"]).unionByName(star(["full_name", "company_domain"])))


@query
def golden_records(spark, sf):
    return identity.golden_records(_cleaned(spark, sf))


@query
def idr_incremental(spark, sf):
    """Golden records from identities that were resolved in two batches."""
    cleaned = cut_lineage(_cleaned(spark, sf))
    folder = scratch_path(spark, "identities")
    half = F.pmod(F.xxhash64("lead_id"), F.lit(2))
    for part in (0, 1):
        identity_store.add_batch(cleaned.filter(half == part), folder)
    return identity.golden_records(cleaned, identity_store.labels(spark, folder))


@query
def golden_records_strict(spark, sf):
    """Only rules of confidence above 90, that is equal emails."""
    return identity.golden_records(_cleaned(spark, sf), threshold=95)


@query
def idr_multi_source(spark, sf):
    return identity.multi_source(identity.golden_records(_cleaned(spark, sf))).select(
        "global_id", "full_name", "email", "sources", "source_count", "record_count"
    )


@query
def idr_stats(spark, sf):
    return identity.resolution_stats(identity.golden_records(_cleaned(spark, sf)))


# ------------------------------------------------------------------------------------------------ quality

def _clock():
    return F.lit(CLOCK).cast("timestamp")


def _results(df: DataFrame) -> DataFrame:
    return df.withColumn("valid_values", F.array_join("valid_values", ","))


def _silver_as_stored(spark, sf):
    return _silver(spark, sf).withColumn("ingested_at", _time_text())


@query
def dq_no_nulls(spark, sf):
    checks = [quality.no_nulls(c) for c in ("lead_id", "email", "full_name", "company_name", "employee_count")]
    return _results(quality.run_suite(_silver_as_stored(spark, sf), checks, "SILVER", _clock()))


@query
def dq_unique(spark, sf):
    checks = [quality.unique(c) for c in ("lead_id", "email", "company_name")]
    return _results(quality.run_suite(_cleaned(spark, sf), checks, "CLEANED", _clock()))


@query
def dq_values_in_set(spark, sf):
    checks = [quality.values_in_set("source", ("apollo", "hubspot", "salesforce", "unknown")),
              quality.values_in_set("seniority", ("c_suite", "vp", "director", "manager")),
              quality.values_in_set("no_such_column", ("x",))]
    return _results(quality.run_suite(_silver_as_stored(spark, sf), checks, "SILVER", _clock()))


@query
def dq_invalid_values(spark, sf):
    return quality.invalid_values(leads(spark, sf), "seniority", ("c_suite", "director", "manager"))


@query
def dq_row_count(spark, sf):
    checks = [quality.row_count_above(1), quality.row_count_above(10**9)]
    return _results(quality.run_suite(table(spark, sf, "lineitem"), checks, "LINEITEM", _clock()))


@query
def dq_no_future_dates(spark, sf):
    checks = [quality.no_future_dates("ingested_at"), quality.no_future_dates("absent_at")]
    return _results(quality.run_suite(leads(spark, sf), checks, "RAW", _clock()))


@query
def dq_email_format(spark, sf):
    return _results(quality.run_suite(leads(spark, sf), [quality.email_format("email")], "RAW", _clock()))


def _suite(spark, sf):
    silver, gold = _stored_layers(spark, sf)
    return quality.run_layers(
        {"BRONZE": leads(spark, sf), "SILVER": silver.withColumn("ingested_at", _time_text()), "GOLD": gold}, now=_clock())


@query
def dq_suite(spark, sf):
    return _results(_suite(spark, sf))


@query
def dq_failures(spark, sf):
    return quality.failures(_suite(spark, sf)).select("layer", "expectation", "column", "message")


@query
def dq_summary(spark, sf):
    return quality.summary(_suite(spark, sf))


@query
def dq_summary_halves(spark, sf):
    """13 of 16 checks pass, which is an exact half at one decimal."""
    checks = [quality.row_count_above(1)] * 13 + [quality.row_count_above(10**12)] * 3
    return quality.summary(quality.run_suite(table(spark, sf, "lineitem"), checks, "LINEITEM", _clock()))


@query
def json_report_latest(spark, sf):
    """Two reports are written; the newer one is read back."""
    folder = scratch_path(spark, "reports")
    columns = ("layer", "check_no", "expectation", "status", "passed", "total_rows")
    for limit in (1, 10**12):
        results = quality.run_suite(table(spark, sf, "orders"), [quality.row_count_above(limit), quality.no_nulls("o_orderkey")],
                                    "ORDERS", _clock())
        monitoring.write_report(results.select(*columns), folder)
    return monitoring.latest_report(spark, folder, "layer string, check_no int, expectation string, status string, "
                                                   "passed boolean, total_rows long")


@query
def dq_lineitem(spark, sf):
    checks = [
        quality.row_count_above(1), quality.no_nulls("l_orderkey"), quality.unique("l_orderkey"),
        quality.values_in_set("l_returnflag", ("A", "N")), quality.no_nulls("l_shipdate"),
    ]
    return _results(quality.run_suite(table(spark, sf, "lineitem"), checks, "LINEITEM", _clock()))


@query
def dq_documents(spark, sf):
    checks = [quality.row_count_above(1), quality.no_nulls("text"), quality.values_in_set("lang", ("en", "de")),
              quality.unique("doc_id")]
    return _results(quality.run_suite(table(spark, sf, "documents"), checks, "DOCUMENTS", _clock()))


# --------------------------------------------------------------------------------------------- monitoring

@query
def metrics_snapshot(spark, sf):
    silver, gold = _stored_layers(spark, sf)
    return monitoring.metrics_snapshot({"bronze": _bronze(spark, sf), "silver": silver, "gold": gold}, gold).drop("snapshot_at")


@query
def layer_health(spark, sf):
    paths = {name: f"{sf}/{name}.parquet" for name in ("customer", "orders", "lineitem", "events")}
    return monitoring.layer_health(spark, {**paths, "absent": f"{sf}/absent.parquet"}).drop("size_kb")


# ----------------------------------------------------------------------------------------------- insights

def _responses(gold: DataFrame) -> DataFrame:
    """Answers of the intent stage: complete enough for hot leads, unusable for warm and cool, none for cold."""
    hot = F.concat(F.lit('{"intent_score": '), F.col("lead_score").cast("string"), F.lit(', "urgency": "high"}'))
    return gold.filter("intent_level <> 'cold'").select(
        "lead_id",
        F.when(F.col("intent_level") == "hot", hot).when(F.col("intent_level") == "warm", "no json here")
        .otherwise("[1, 2]").alias("response"),
    )


_INTENT_COLUMNS = ("intent_score", "intent_level", "urgency", "deal_size_estimate", "next_best_action", "ai_reasoning")


@query
def insights_fallback(spark, sf):
    built = insights.build_insights(_gold(spark, sf), max_leads=None)
    return warehouse.nested_to_json(built).drop("processed_at")


@query
def arrays_to_json(spark, sf):
    staged = insights.run_stage(_gold(spark, sf).select("lead_id", "full_name", "company_name"), insights.OUTREACH)
    return warehouse.nested_to_json(staged).select("lead_id", "cadence")


@query
def insights_parse(spark, sf):
    parsed = insights.parse_responses(_responses(_gold(spark, sf)), insights.INTENT)
    return parsed.select("lead_id", "parsed", *_INTENT_COLUMNS, F.to_json("intent_signals").alias("intent_signals"))


@query
def insights_merge(spark, sf):
    gold = _gold(spark, sf)
    merged = insights.run_stage(gold, insights.INTENT, _responses(gold))
    return merged.select("lead_id", "lead_score", *_INTENT_COLUMNS)


@query
def insights_merge_duplicates(spark, sf):
    """Several answers for a lead count as one: usable ones first, then by text."""
    gold = _gold(spark, sf)
    hot = gold.filter("intent_level = 'hot'").select("lead_id")
    answers = hot.select("lead_id", F.explode(F.array(*map(F.lit, (
        '{"intent_score": 90}', "no json here", '{"intent_score": 10}')))).alias("response"))
    return insights.run_stage(gold, insights.INTENT, answers).select("lead_id", "intent_score")


@query
def insights_overlay_extra(spark, sf):
    """An answer replaces columns of the lead in their type; what names no column is kept as text."""
    gold = _gold(spark, sf)
    answer = '{"email": "new@example.com", "employee_count": 7, "urgency": "high", "note": "call", "tags": ["a", "b"]}'
    answers = gold.filter("intent_level = 'hot'").select("lead_id", F.lit(answer).alias("response")).distinct()
    merged = insights.run_stage(gold, insights.INTENT, answers)
    return merged.select("lead_id", "email", "employee_count", "urgency", F.to_json("extra").alias("extra"))


@query
def insights_rejected(spark, sf):
    return insights.rejected_responses(_responses(_gold(spark, sf)))


def _steady_model(pairs):
    return [json.dumps({"enrichment_confidence": len(user) % 101}) for _, user in pairs]


def _shaky_model(pairs):
    """No answer for one seniority, text without JSON for another."""
    good = _steady_model(pairs)
    return [None if "Seniority: vp" in user else "no json here" if "Seniority: director" in user else reply
            for (_, user), reply in zip(pairs, good)]


@query
def insights_cached(spark, sf):
    """Three runs over one store of answers: the second asks again what failed in the first, the third asks nothing. By prompt, because
    ``lead_id`` is not unique here."""
    asked = cut_lineage(insights.prompts(_gold_of(spark, sf, "local"), insights.ENRICHMENT))
    folder = scratch_path(spark, "answers")
    for run, model in (("1", _shaky_model), ("2", _steady_model), ("3", _steady_model)):
        answers.ask(asked, model, folder, run)
    tries = answers.stored(spark, folder)
    per_prompt = tries.groupBy("digest").agg(F.count(F.lit(1)).alias("asks"), F.max("run").alias("last_run"))
    confidence = F.from_json("response", insights.ENRICHMENT.schema)["enrichment_confidence"].alias("enrichment_confidence")
    distinct = answers.with_digest(asked).groupBy("digest").agg(
        F.sha2(F.first("user_prompt"), 256).alias("prompt_sha256"), F.count(F.lit(1)).alias("leads"))
    return distinct.join(answers.usable_answers(tries).select("digest", confidence), "digest", "left").join(per_prompt, "digest").drop("digest")


@query
def insights_select(spark, sf):
    return warehouse.insights_table(insights.build_insights(_gold(spark, sf), max_leads=None)).drop("PROCESSED_AT")


@query
def prompt_render(spark, sf):
    leads_in = _gold_of(spark, sf, "local")
    return insights.prompts(leads_in, insights.ENRICHMENT).select("lead_id", "user_prompt")


# ---------------------------------------------------------------------------------------------- activation

def _scored_insights(spark, sf):
    """Insights whose level comes from the lead score, so that hot and warm leads exist."""
    gold = cut_lineage(_gold(spark, sf))
    answers = gold.select("lead_id", F.to_json(F.struct(
        F.col("lead_score").alias("intent_score"), "intent_level",
        F.when(F.col("intent_level") == "hot", "critical").otherwise("medium").alias("urgency"),
        F.lit("smb").alias("deal_size_estimate"), F.col("recommended_action").alias("next_best_action"),
        F.lit("score").alias("ai_reasoning"),
    )).alias("response"))
    return insights.build_insights(gold, None, {"intent": answers})


@query
def activation_leads(spark, sf):
    return activation.activation_leads(_scored_insights(spark, sf)).drop("processed_at")


@query
def activation_ranked(spark, sf):
    return activation.activation_leads(_scored_insights(spark, sf), ranked=True).select("lead_id", "intent_score", "rank")


@query
def alert_text(spark, sf):
    active = activation.activation_leads(_scored_insights(spark, sf))
    parts = activation.alert_parts(active.columns)
    return active.select("lead_id", *[c.alias(n) for n, c in parts.items()])


@query
def alert_payload(spark, sf):
    active = activation.activation_leads(_scored_insights(spark, sf))
    return active.select("lead_id", activation.alert_payload(active.columns).alias("payload"))


@query
def workflow_payload(spark, sf):
    active = activation.activation_leads(_scored_insights(spark, sf))
    return active.select("lead_id", activation.workflow_payload(active.columns, triggered_at=F.lit(CLOCK)).alias("payload"))


def _outbox(spark, sf):
    active = cut_lineage(activation.activation_leads(_scored_insights(spark, sf)))
    first = activation.outbox(active.filter("intent_level = 'hot'"), triggered_at=F.lit(CLOCK))
    return first, activation.outbox(active, first.filter("channel = 'slack'"), triggered_at=F.lit(CLOCK))


@query
def outbox(spark, sf):
    """Deliveries of a second run, after the alerts of hot leads were delivered by a first one."""
    return _outbox(spark, sf)[1].drop("payload")


@query
def delivery_summary(spark, sf):
    first, rest = _outbox(spark, sf)
    done = first.filter("channel = 'slack'").withColumn("status", F.lit("sent"))
    tried = rest.withColumn("status", F.when(F.col("channel") == "n8n", "sent").otherwise("failed"))
    return activation.delivery_summary(done.unionByName(tried))


@query
def delivery_ledger(spark, sf):
    """Five runs of a sender that loses some messages once and others for ever; three tries at most."""
    box = cut_lineage(activation.outbox(activation.activation_leads(_scored_insights(spark, sf)), triggered_at=F.lit(CLOCK)))
    folder = scratch_path(spark, "ledger")
    digit = F.substring("delivery_id", 1, 1)
    lost = (digit < "4") & (F.col("channel") == "slack")
    for number, second in enumerate((0, 30, 60, 200, 600)):
        now = F.lit(CLOCK).cast("timestamp") + F.make_interval(secs=F.lit(second))
        fails = lost | digit.between("4", "7") if number == 0 else lost
        todo = ledger.due(box, ledger.state(ledger.tries(spark, folder), max_tries=3), now)
        ledger.record(todo.select("delivery_id", "channel", now.alias("tried_at"), F.when(fails, "failed").otherwise("sent").alias("status"),
                                  F.when(fails, "timeout").alias("error")), folder)
    states = ledger.state(ledger.tries(spark, folder), max_tries=3)
    return states.select("delivery_id", "channel", "tries", "status", _time_text("last_try"), _time_text("next_try"), "error")


# ----------------------------------------------------------------------------------------------- warehouse

@query
def warehouse_prepare(spark, sf):
    raw = leads(spark, sf).withColumns({"layer": F.lit("bronze"), "topic": F.lit("leads")})
    return warehouse.prepare_for_warehouse(raw).drop("LOADED_AT")


@query
def warehouse_prepare_unified(spark, sf):
    """The variant that keeps the text 'None'."""
    return warehouse.prepare_for_warehouse(leads(spark, sf), missing=(text.NAN_TEXT,)).drop("LOADED_AT").select(
        "LEAD_ID", "EMAIL", "SENIORITY", "INDUSTRY"
    )


@query
def warehouse_roundtrip(spark, sf):
    """Bronze view, silver and gold tables; the gold table is loaded again in upper case and fetched in lower case."""
    run = spark.sparkContext.applicationId.replace("-", "_")
    pipeline.publish_models(leads(spark, sf), *(f"{name}_{run}" for name in ("bronze_leads", "silver_leads", "gold_scores")))
    gold = spark.table(f"gold_scores_{run}")
    loaded = warehouse.load_table(warehouse.prepare_for_warehouse(gold), f"warehouse_gold_{run}")
    assert loaded
    return tables.fetch_insights(spark, f"warehouse_gold_{run}").select("lead_id", "email", "lead_score", "intent_level")


@query
def batch_pipeline(spark, sf):
    """All layers written and read back, checked from their stored form."""
    layout = pipeline.Layout(scratch_path(spark, "lake"))
    pipeline.run_batch(spark, leads(spark, sf), layout, "2026-06-15")
    return quality.summary(pipeline.check_layers(spark, layout, _clock())).crossJoin(
        pipeline.latest_layer(spark, layout, "gold/lead_scores").agg(
            F.count(F.lit(1)).alias("gold_rows"), F.sum("lead_score").alias("gold_score")))


@query
def landed_messages(spark, sf):
    """Landed payloads of both sources as keyed messages of their topics."""
    raw = leads(spark, sf)
    people = raw.filter("source = 'apollo'").select(F.to_json(F.struct(F.col("lead_id").alias("id"), "email")).alias("payload"))
    contacts = raw.filter("source = 'hubspot'").select(F.to_json(F.struct(
        F.col("lead_id").alias("id"), F.struct("email").alias("properties"))).alias("payload"))
    topics = pipeline.land_and_publish(people, contacts)
    return tables.union_by_name(*(df.select(F.lit(topic).alias("topic"), "key") for topic, df in topics.items()))


# ----------------------------------------------------------------------------------------------- streaming

def _message_stream(spark, sf):
    """The derived leads as a stream of messages, from a file stream over the customer table."""
    schema = table(spark, sf, "customer").schema
    customers = spark.readStream.schema(schema).parquet(f"{sf}/customer*.parquet")
    return messages(leads_from(spark, customers))


def _streamed_bronze(spark, sf) -> str:
    folder = scratch_path(spark, "stream")
    jobs.start_bronze(_message_stream(spark, sf), f"{folder}/bronze", f"{folder}/cp_bronze", every=None).awaitTermination()
    return folder


_BRONZE_OUT = ("lead_id", "source", "first_name", "last_name", "email", "job_title", "seniority", "company_name",
               "company_domain", "industry", "employee_count", "apollo_score", "lead_status", "ingested_at")


@query
def stream_bronze(spark, sf):
    folder = _streamed_bronze(spark, sf)
    return spark.read.parquet(f"{folder}/bronze").select(*_BRONZE_OUT, "kafka_key", "topic", "is_corrupt", "layer")


@query
def stream_restart(spark, sf):
    """A second start on the same checkpoint adds nothing."""
    folder = _streamed_bronze(spark, sf)
    jobs.start_bronze(_message_stream(spark, sf), f"{folder}/bronze", f"{folder}/cp_bronze", every=None).awaitTermination()
    return spark.read.parquet(f"{folder}/bronze").select("lead_id", "source", "email", "topic")


@query
def stream_silver(spark, sf):
    """State-based deduplication keeps an arbitrary row per key, so only the keys are compared."""
    folder = _streamed_bronze(spark, sf)
    bronze = jobs.read_bronze_stream(spark, f"{folder}/bronze")
    jobs.start_silver(bronze, f"{folder}/silver", f"{folder}/cp_silver", every=None).awaitTermination()
    return spark.read.parquet(f"{folder}/silver").select("email", "source", "email_domain", "layer")


@query
def stream_silver_table(spark, sf):
    folder = _streamed_bronze(spark, sf)
    bronze = jobs.read_bronze_stream(spark, f"{folder}/bronze")
    jobs.start_silver(bronze, f"{folder}/silver", f"{folder}/cp_silver", every=None, dedup="table").awaitTermination()
    return spark.read.parquet(f"{folder}/silver").select("email", "source", "email_domain", "layer")


@query
def stream_silver_index(spark, sf):
    """Bronze arrives in several micro-batches, each checked against the index of the ones before."""
    folder = _streamed_bronze(spark, sf)
    bronze = jobs.read_bronze_stream(spark, f"{folder}/bronze", files_per_batch=2)
    jobs.start_silver(bronze, f"{folder}/silver", f"{folder}/cp_silver", every=None, dedup="index").awaitTermination()
    return spark.read.parquet(f"{folder}/silver").select("email", "source", "email_domain", "layer")

"""Lead insights: three stages of model answers laid over the lead, with a fixed answer where none is usable.

The model itself is outside: a stage renders its prompt, somebody answers, and the answers come back as a
table ``lead_id, response``. ``scorer`` may also be any function from prompts to responses, for example one
built on ``mapInPandas``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import schemas
from leadlake.functions import templates
from leadlake.operators.summary import top_leads

PIPELINE_VERSION = "1.0"

_U = "Unknown"


def _literals(**values) -> Callable[[list[str]], dict[str, Column]]:
    def column(value):
        if isinstance(value, list):
            return F.array(*map(F.lit, value)).cast("array<string>")
        return F.lit(value)
    return lambda columns: {name: column(value) for name, value in values.items()}


def _outreach_fallback(columns: list[str]) -> dict[str, Column]:
    # The default mail and follow-up steps.
    company = templates.field(columns, "company_name", "your team")
    name = templates.field(columns, "full_name", "there")
    body = (
        ",\n\nI saw you're working on initiatives in your area. We'd love to share a brief idea that has helped "
        "similar teams.\n\nBest,\nSales Team"
    )
    return {
        "email_subject": F.concat(F.lit("Quick question about "), company),
        "email_body": F.concat(F.lit("Hi "), name, F.lit(body)),
        "cadence": F.array(*map(F.lit, ["Email day 0", "Follow-up day 3", "Final attempt day 7"])),
    }


@dataclass(frozen=True)
class Stage:
    name: str
    schema: str
    system_prompt: str
    prompt_head: str
    prompt_fields: dict[str, tuple[str, str | None]]
    prompt_tail: str
    fallback: Callable[[list[str]], dict[str, Column]]

    def prompt(self, columns: list[str]) -> Column:
        return templates.lines(columns, self.prompt_head, self.prompt_fields, self.prompt_tail)


ENRICHMENT = Stage(
    name="enrichment",
    schema=schemas.ENRICHMENT,
    system_prompt=(
        "Describe the lead's company for a sales team. Answer with one JSON object and nothing else: company_summary "
        "(one sentence), company_stage (startup, growth, enterprise or public), likely_tech_stack (3 items), "
        "pain_points (2 items), buying_readiness (low, medium or high), best_contact_channel (email, linkedin, phone "
        "or event), enrichment_confidence (0 to 100)."
    ),
    prompt_head="Lead",
    prompt_fields={
        "Name": ("full_name", _U), "Job title": ("job_title", _U), "Seniority": ("seniority", _U),
        "Company": ("company_name", _U), "Industry": ("industry", _U), "Employee count": ("employee_count", _U),
        "Email domain": ("email_domain", _U),
    },
    prompt_tail="Answer in JSON.",
    # The answer of a stage without a usable response.
    fallback=_literals(
        company_summary="Unable to enrich", company_stage="unknown", likely_tech_stack=[], pain_points=[],
        buying_readiness="unknown", best_contact_channel="email", enrichment_confidence=0,
    ),
)

INTENT = Stage(
    name="intent",
    schema=schemas.INTENT,
    system_prompt=(
        "Judge how ready the lead is to buy. Answer with one JSON object and nothing else: intent_score (0 to 100), "
        "intent_level (cold, cool, warm or hot), intent_signals (3 items), urgency (low, medium, high or critical), "
        "deal_size_estimate (smb, mid_market or enterprise), next_best_action, ai_reasoning (1 or 2 sentences)."
    ),
    prompt_head="Lead",
    prompt_fields={
        "Name": ("full_name", _U), "Job title": ("job_title", _U), "Seniority": ("seniority", _U),
        "Company": ("company_name", _U), "Industry": ("industry", _U), "Employee count": ("employee_count", _U),
        "Lead status": ("lead_status", _U), "Company stage": ("company_stage", _U),
        "Buying readiness": ("buying_readiness", _U), "Pain points": ("pain_points", None),
        "Sources": ("sources", "unknown"), "Records": ("record_count", "1"),
    },
    prompt_tail="Answer in JSON.",
    # The answer of a stage without a usable response.
    fallback=_literals(
        intent_score=50, intent_level="cool", intent_signals=[], urgency="medium", deal_size_estimate="smb",
        next_best_action="Send introductory email", ai_reasoning="Unable to assess intent",
    ),
)

OUTREACH = Stage(
    name="outreach",
    schema=schemas.OUTREACH,
    system_prompt=(
        "Write a short personal sales mail. Answer with one JSON object and nothing else: email_subject, email_body "
        "(3 to 5 sentences), cadence (list of follow-up steps)."
    ),
    prompt_head="Lead",
    prompt_fields={
        "Name": ("full_name", _U), "Job title": ("job_title", _U), "Company": ("company_name", _U),
        "Pain points": ("pain_points", None), "Best contact channel": ("best_contact_channel", "email"),
    },
    prompt_tail="Answer in JSON.",
    fallback=_outreach_fallback,
)

STAGES = (ENRICHMENT, INTENT, OUTREACH)
Responses = DataFrame | Callable[[DataFrame], DataFrame] | None


def prompts(leads: DataFrame, stage: Stage) -> DataFrame:
    """``lead_id, system_prompt, user_prompt`` of one stage."""
    return leads.select(
        "lead_id", F.lit(stage.system_prompt).alias("system_prompt"), stage.prompt(leads.columns).alias("user_prompt")
    )


def _usable(response: Column) -> Column:
    """Text that is a JSON object."""
    return F.json_object_keys(response).isNotNull()


def _typed(text: Column, dtype: str) -> Column:
    """A JSON value, kept as text, in the type of the column it replaces; null if it does not fit."""
    if dtype == "string":
        return text
    return F.from_json(text, dtype) if dtype.startswith(("array", "struct", "map")) else text.try_cast(dtype)


def overlay(leads: DataFrame, stage: Stage, response: Column, lead_columns: list[str] | None = None) -> DataFrame:
    """Lay one answer over the lead: a key in the answer replaces the column of that name, other columns stay.

    Text that is not JSON gives the stage's fixed answer for all of its keys. Keys outside the stage replace a column of
    ``lead_columns`` in its type; those that name no column go to the map column ``extra``. With ``lead_columns`` None
    only the stage's keys count.
    """
    fallback = stage.fallback(leads.columns)
    keys = F.json_object_keys(response)
    with_answer = leads.select("*", F.from_json(response, stage.schema).alias("_answer"), keys.alias("_keys"),
                               F.from_json(response, "map<string,string>").alias("_all"))
    added = {}
    for name, default in fallback.items():
        before = F.col(name) if name in leads.columns else F.lit(None)
        answered = F.when(F.array_contains("_keys", name), F.col("_answer")[name]).otherwise(before)
        added[name] = F.when(F.col("_keys").isNull(), default).otherwise(answered)
    if lead_columns is not None:
        dtypes = dict(leads.dtypes)
        known = [*fallback, *lead_columns]
        for name in lead_columns:
            if name not in fallback and name != "extra":
                added[name] = F.when(F.array_contains("_keys", name), _typed(F.col("_all")[name], dtypes[name])).otherwise(
                    F.col(name))
        none = F.create_map().cast("map<string,string>")
        others = F.when(F.col("_keys").isNotNull(), F.map_filter("_all", lambda k, _: ~k.isin(known)))
        others = F.coalesce(others, none)
        if "extra" in leads.columns:
            earlier = F.map_filter(F.coalesce("extra", none), lambda k, _: ~F.map_contains_key(others, k))
            others = F.map_concat(earlier, others)
        added["extra"] = others
    return with_answer.withColumns(added).drop("_answer", "_keys", "_all")


def parse_responses(responses: DataFrame, stage: Stage) -> DataFrame:
    """Answers as typed columns ``lead_id, parsed, ...`` with the fixed answer where the text is unusable."""
    parsed = responses.select("lead_id", "response", _usable(F.col("response")).alias("parsed"))
    return overlay(parsed, stage, F.col("response")).drop("response")


def one_per_lead(responses: DataFrame) -> DataFrame:
    """``lead_id, _response``: of several answers the first by text, usable ones before others."""
    order = F.struct(~F.coalesce(_usable(F.col("response")), F.lit(False)), F.col("response"))
    return responses.groupBy("lead_id").agg(F.min_by("response", order).alias("_response"))


def run_stage(leads: DataFrame, stage: Stage, responses: Responses = None) -> DataFrame:
    """One stage. Without responses every lead gets the fixed answer; leads without a response do too."""
    if callable(responses):
        responses = responses(prompts(leads, stage))
    if responses is None:
        return leads.withColumns(stage.fallback(leads.columns))
    joined = leads.join(one_per_lead(responses), "lead_id", "left")
    return overlay(joined, stage, F.col("_response"), leads.columns).drop("_response")


def rejected_responses(responses: DataFrame) -> DataFrame:
    """Answers that are JSON but not an object: they cannot be laid over a lead and need attention."""
    is_json = F.try_parse_json("response").isNotNull()
    return responses.filter(is_json & ~_usable(F.col("response")))


def build_insights(gold: DataFrame, max_leads: int | None = 10, responses: dict[str, Responses] | None = None) -> DataFrame:
    """Top leads through the three stages.

    ``score_intent_level`` keeps the level that came from the score, because the intent stage overwrites
    ``intent_level``.
    """
    responses = responses or {}
    leads = top_leads(gold, max_leads).withColumn("score_intent_level", F.col("intent_level"))
    for stage in STAGES:
        leads = run_stage(leads, stage, responses.get(stage.name))
    return leads.withColumn("pipeline_version", F.lit(PIPELINE_VERSION)).withColumn("processed_at", F.current_timestamp())

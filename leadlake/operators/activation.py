"""Activation: hot and warm leads become messages in an outbox, one per channel, each delivered once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.functions.templates import field, lookup
from leadlake.session import cut_lineage

CHANNELS = ("slack", "n8n")
ACTIVE_LEVELS = ("hot", "warm")

# Fixed values of the alert.
LEVEL_ICONS = {"hot": "🔥", "warm": "☀️", "cool": "❄️", "cold": "🧊"}
URGENCY_ICONS = {"critical": "🚨", "high": "⚡", "medium": "📌", "low": "📝"}
DEFAULT_LEVEL_ICON = "📋"
DEFAULT_URGENCY_ICON = "📌"

# Lead fields of the workflow message.
WORKFLOW_FIELDS = (
    "lead_id", "full_name", "email", "company_name", "job_title", "intent_level", "intent_score", "urgency",
    "next_best_action", "email_subject", "email_body", "linkedin_message", "key_value_prop",
)
# Columns the activation reads from the insight table.
ACTIVATION_FIELDS = (
    "lead_id", "full_name", "email", "company_name", "job_title", "intent_level", "intent_score", "urgency",
    "deal_size_estimate", "next_best_action", "email_subject", "email_body", "linkedin_message", "key_value_prop",
    "ai_reasoning", "processed_at",
)


def activation_leads(insights: DataFrame, ranked: bool = False) -> DataFrame:
    """Hot and warm leads. ``ranked`` adds ``rank`` by intent score, ties by lead id, and orders by it (for reports).

    Leads without a score come last.
    """
    lower = insights.toDF(*[c.lower() for c in insights.columns])
    active = lower.filter(F.col("intent_level").isin(*ACTIVE_LEVELS))
    active = active.select(*[c for c in ACTIVATION_FIELDS if c in active.columns])
    if not ranked:
        return active
    # range slices of the order are numbered in parallel and shifted by the sizes of the slices before
    order = [F.col("intent_score").desc_nulls_last(), F.col("lead_id").asc_nulls_first()]
    sliced = cut_lineage(active.repartitionByRange(*order).withColumn("_slice", F.spark_partition_id()))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n"))
    start = sizes.select("_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_above"))
    inside = F.row_number().over(Window.partitionBy("_slice").orderBy(*order))
    ranks = sliced.withColumn("_inside", inside).join(F.broadcast(start), "_slice")  # one row per slice
    return ranks.withColumn("rank", F.col("_above") + F.col("_inside")).select(*active.columns, "rank").orderBy("rank")


def _or(columns, name: str, default: str = "N/A") -> Column:
    return field(columns, name, default)


def _icon(columns, name: str, table: dict[str, str], absent: str, default: str) -> Column:
    return lookup(table, F.col(name) if name in columns else F.lit(absent), default)


def alert_parts(columns: Sequence[str]) -> dict[str, Column]:
    """Texts of the alert by place."""
    level = _icon(columns, "intent_level", LEVEL_ICONS, "cold", DEFAULT_LEVEL_ICON)
    urgency = _icon(columns, "urgency", URGENCY_ICONS, "medium", DEFAULT_URGENCY_ICON)
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    return {
        "header": text(level, " Hot Lead Alert — ", _or(columns, "full_name", "Unknown")),
        "company": text("*Company:*\n", _or(columns, "company_name")),
        "title": text("*Title:*\n", _or(columns, "job_title")),
        "score": text("*Intent Score:*\n", _or(columns, "intent_score", "0"), "/100"),
        "urgency": text("*Urgency:*\n", urgency, " ", _or(columns, "urgency")),
        "deal_size": text("*Deal Size:*\n", _or(columns, "deal_size_estimate")),
        "email": text("*Email:*\n", _or(columns, "email")),
        "action": text("*🎯 Next Best Action:*\n", _or(columns, "next_best_action")),
        "subject": text("*📧 Suggested Email Subject:*\n_", _or(columns, "email_subject"), "_"),
        "reasoning": text("*🤖 AI Reasoning:*\n", _or(columns, "ai_reasoning")),
    }


def alert_payload(columns: Sequence[str]) -> Column:
    """Chat alert as JSON blocks. Blocks share one struct type; unused fields are null and not written."""
    parts = alert_parts(columns)
    no_text = F.lit(None).cast("struct<type:string,text:string>")
    no_fields = F.lit(None).cast("array<struct<type:string,text:string>>")
    words = lambda kind, name: F.struct(F.lit(kind).alias("type"), parts[name].alias("text"))
    block = lambda kind, text=no_text, fields=no_fields: F.struct(
        F.lit(kind).alias("type"), text.alias("text"), fields.alias("fields"))
    facts = F.array(*[words("mrkdwn", n) for n in ("company", "title", "score", "urgency", "deal_size", "email")])
    blocks = [
        block("header", words("plain_text", "header")),
        block("section", fields=facts),
        *[block("section", words("mrkdwn", n)) for n in ("action", "subject", "reasoning")],
        block("divider"),
    ]
    return F.to_json(F.struct(F.array(*blocks).alias("blocks")))


def workflow_payload(columns: Sequence[str], workflow_type: str = "hot_lead", triggered_at: Column | None = None) -> Column:
    """Workflow message as JSON; absent fields are written as null."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx") if triggered_at is None else triggered_at
    value = lambda name: (F.col(name) if name in columns else F.lit(None).cast("string")).alias(name)
    return F.to_json(
        F.struct(
            F.lit(workflow_type).alias("workflow_type"),
            stamp.alias("triggered_at"),
            F.struct(*[value(name) for name in WORKFLOW_FIELDS]).alias("lead"),
        ),
        {"ignoreNullFields": "false"},
    )


def outbox(leads: DataFrame, delivered: DataFrame | None = None, key: Sequence[str] = ("lead_id", "email"),
           triggered_at: Column | None = None) -> DataFrame:
    """One pending delivery per lead and channel, minus those whose ``delivery_id`` was delivered before.

    The id depends on the lead and the channel only, so a repeated or restarted run sends nothing twice.
    """
    columns = leads.columns
    identity = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in key])
    per_channel = F.explode(F.array(
        F.struct(F.lit(CHANNELS[0]).alias("channel"), alert_payload(columns).alias("payload")),
        F.struct(F.lit(CHANNELS[1]).alias("channel"), workflow_payload(columns, triggered_at=triggered_at).alias("payload")),
    ))
    rows = leads.select(identity.alias("_identity"), "lead_id", per_channel.alias("m")).select(
        F.sha2(F.concat_ws("\x1f", "m.channel", "_identity"), 256).alias("delivery_id"),
        "lead_id", "m.channel", "m.payload", F.lit("pending").alias("status"),
    )
    if delivered is not None:
        rows = rows.join(delivered.select("delivery_id"), "delivery_id", "left_anti")
    return rows


def delivery_summary(deliveries: DataFrame) -> DataFrame:
    """Leads, sent alerts, started workflows and failed deliveries, in one row."""
    sent = F.col("status") == "sent"
    return deliveries.agg(
        F.count_distinct("lead_id").alias("total"),
        F.count_if(sent & (F.col("channel") == CHANNELS[0])).alias("slack"),
        F.count_if(sent & (F.col("channel") == CHANNELS[1])).alias("n8n"),
        F.count_if(F.col("status") == "failed").alias("failed"),
    )

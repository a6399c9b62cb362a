"""Bronze, silver and gold layers as single projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake import profiles
from leadlake.functions import scoring, text
from leadlake.operators.dedup import keep_first
from leadlake.schemas import BRONZE_LEAD

TYPED_COLUMNS = {
    "employee_count": "int",
    "apollo_score": "double",
    "ingested_at": "timestamp_ntz",
}


def parse_envelope(messages: DataFrame, schema: str = BRONZE_LEAD) -> DataFrame:
    """Broker messages to bronze rows: envelope columns, parsed fields, load time and layer tag.

    The raw text stays in ``raw_value`` and ``is_corrupt`` marks text that is not a JSON object, because a
    failed parse alone looks like a row of nulls.
    """
    value = F.col("value").cast("string")
    parsed = messages.select(
        F.col("key").cast("string").alias("kafka_key"),
        "topic",
        "partition",
        "offset",
        F.col("timestamp").alias("kafka_timestamp"),
        value.alias("raw_value"),
        F.from_json(value, schema).alias("data"),
        F.json_object_keys(value).isNull().alias("is_corrupt"),
    )
    return parsed.select(
        "kafka_key",
        "topic",
        "partition",
        "offset",
        "kafka_timestamp",
        "data.*",
        "raw_value",
        "is_corrupt",
        F.current_timestamp().alias("bronze_loaded_at"),
        F.lit("bronze").alias("layer"),
    )


def bronze_leads(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed bronze rows that carry a lead id. ``strict`` raises on a bad cast instead of giving null."""
    def typed(name: str) -> Column:
        column = F.col(name)
        target = TYPED_COLUMNS[name]
        return (column.cast(target) if strict else column.try_cast(target)).alias(name)

    plain = ("lead_id", "source", "first_name", "last_name", "email", "job_title", "seniority",
             "company_name", "company_domain", "industry")
    return raw.filter(F.col("lead_id").isNotNull() & (F.col("lead_id") != text.NONE_TEXT)).select(
        *plain, *[typed(name) for name in TYPED_COLUMNS]
    )


def clean_leads(bronze: DataFrame, profile: str = "warehouse", carry: tuple[str, ...] = ()) -> DataFrame:
    """Row filter and cleaning of one profile, without deduplication."""
    p = profiles.get(profile)
    email = p.email()
    extra = [c for c in (*p.extra, *carry) if c in bronze.columns]
    source = F.col("source")
    return bronze.filter(p.keep()).select(
        "lead_id",
        (F.coalesce(source, F.lit(text.UNKNOWN)) if p.name == "local" else source).alias("source"),
        p.full_name("first_name", "last_name").alias("full_name"),
        email.alias("email"),
        p.domain(email).alias("email_domain"),
        p.job_title("job_title").alias("job_title"),
        p.seniority("seniority").alias("seniority"),
        p.company_name("company_name").alias("company_name"),
        p.company_domain("company_domain").alias("company_domain"),
        p.industry("industry").alias("industry"),
        "employee_count",
        *extra,
    )


def silver_leads(bronze: DataFrame, profile: str = "warehouse", read_order: tuple[str, ...] = ("lead_id",)) -> DataFrame:
    """Cleaned leads, one per deduplication key of the profile.

    ``read_order`` names the columns that define "first seen" (partition and offset for messages). The
    warehouse profile takes the latest row, a missing time counting as latest, and breaks ties with it.
    """
    p = profiles.get(profile)
    carry = tuple(c for c in read_order if c in bronze.columns and c not in ("lead_id", "source", *p.extra))
    cleaned = clean_leads(bronze, p, carry)
    order = [F.col(c).asc_nulls_last() for c in read_order]
    if p.latest_wins:
        order.insert(0, F.col("ingested_at").desc_nulls_first())
    return keep_first(cleaned, p.dedup_keys, order).drop(*carry)


def score_leads(silver: DataFrame, profile: str = "warehouse", rules: scoring.ScoreRules = scoring.RULES) -> DataFrame:
    """Silver rows plus the four part scores, total, intent level and recommended action."""
    p = profiles.get(profile)
    employees = F.col("employee_count")
    if dict(silver.dtypes)["employee_count"] == "string":
        employees = employees.try_cast("int")
    parts = {
        "seniority_score": scoring.seniority_points(F.col("seniority"), rules),
        "company_size_score": scoring.company_size_points(employees, rules),
        "industry_score": scoring.industry_points(F.col("industry"), rules),
        "completeness_score": scoring.completeness_points(p.completeness_domain, p.completeness_truthy, rules),
    }
    scored = silver.withColumns(parts).withColumn("lead_score", sum((F.col(c) for c in parts), F.lit(0)))
    level = scoring.intent_level(F.col("lead_score"), rules)
    return scored.withColumn("intent_level", level).withColumn(
        "recommended_action", scoring.recommended_action(F.col("intent_level"), rules)
    )


# Output columns of the gold layer, streamed and in the warehouse.
GOLD_COLUMNS = (
    "lead_id", "source", "full_name", "email", "company_name", "industry", "seniority", "employee_count",
    "lead_score", "seniority_score", "company_size_score", "industry_score", "completeness_score",
    "intent_level", "recommended_action",
)
GOLD_WAREHOUSE_COLUMNS = (
    "lead_id", "source", "full_name", "email", "email_domain", "job_title", "seniority", "company_name",
    "industry", "employee_count", "seniority_score", "company_size_score", "industry_score",
    "completeness_score", "lead_score", "intent_level", "recommended_action",
)


def gold_leads(silver: DataFrame, profile: str = "warehouse", rules: scoring.ScoreRules = scoring.RULES) -> DataFrame:
    """Gold layer of one profile, with the scoring time."""
    p = profiles.get(profile)
    scored = score_leads(silver, p, rules)
    now = F.current_timestamp().alias("scored_at")
    if p.name == "warehouse":
        return scored.select(*GOLD_WAREHOUSE_COLUMNS, now)
    return scored.select(*GOLD_COLUMNS, now, F.lit("gold").alias("layer"))

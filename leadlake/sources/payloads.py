"""Nested source records to flat lead rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.schemas import CONTACT_PAYLOAD, PERSON_PAYLOAD

# Titles and company sizes the person search asks for.
SEARCH_TITLES = ("CEO", "CTO", "VP of Engineering", "Head of Data")
SEARCH_EMPLOYEES = (1, 500)
# Contact properties requested from the CRM.
CONTACT_PROPERTIES = (
    "firstname", "lastname", "email", "company", "jobtitle", "phone", "hs_lead_status", "createdate",
)


def _iso(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")


def flatten_people(raw: DataFrame, payload: str = "payload", ingested_at: Column | None = None) -> DataFrame:
    """Person records (JSON text) to leads; the text is kept as ``raw_payload``. A missing company gives nulls."""
    stamp = _iso(F.current_timestamp()) if ingested_at is None else ingested_at
    return raw.select(F.col(payload).alias("raw"), F.from_json(payload, PERSON_PAYLOAD).alias("p")).select(
        F.col("p.id").alias("lead_id"),
        F.lit("apollo").alias("source"),
        "p.first_name", "p.last_name", "p.email",
        F.col("p.title").alias("job_title"),
        "p.seniority", "p.linkedin_url",
        F.col("p.organization.name").alias("company_name"),
        F.col("p.organization.primary_domain").alias("company_domain"),
        F.col("p.organization.industry").alias("industry"),
        F.col("p.organization.estimated_num_employees").alias("employee_count"),
        F.col("p.organization.linkedin_url").alias("company_linkedin"),
        F.col("p.score").alias("apollo_score"),
        stamp.alias("ingested_at"),
        F.col("raw").alias("raw_payload"),
    )


def flatten_contacts(raw: DataFrame, payload: str = "payload", ingested_at: Column | None = None) -> DataFrame:
    """CRM contacts (JSON text) to leads; the text is kept as ``raw_payload``."""
    stamp = _iso(F.current_timestamp()) if ingested_at is None else ingested_at
    return raw.select(F.col(payload).alias("raw"), F.from_json(payload, CONTACT_PAYLOAD).alias("c")).select(
        F.col("c.id").alias("lead_id"),
        F.lit("hubspot").alias("source"),
        F.col("c.properties.firstname").alias("first_name"),
        F.col("c.properties.lastname").alias("last_name"),
        F.col("c.properties.email").alias("email"),
        F.col("c.properties.company").alias("company_name"),
        F.col("c.properties.jobtitle").alias("job_title"),
        F.col("c.properties.phone").alias("phone"),
        F.col("c.properties.hs_lead_status").alias("lead_status"),
        F.col("c.properties.createdate").alias("created_at"),
        stamp.alias("ingested_at"),
        F.lit("contact_sync").alias("event_type"),
        F.col("raw").alias("raw_payload"),
    )


def search_filter(leads: DataFrame, titles=SEARCH_TITLES, employees=SEARCH_EMPLOYEES) -> DataFrame:
    """The person search as a filter on flat leads."""
    return leads.filter(F.col("job_title").isin(*titles) & F.col("employee_count").between(*employees))

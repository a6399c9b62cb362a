"""Shaping tables for the warehouse and writing them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.functions.text import NAN_TEXT, NONE_TEXT

# Pipeline columns that warehouse tables do not have.
INTERNAL_COLUMNS = (
    "layer", "kafka_key", "kafka_offset", "kafka_partition", "topic", "partition", "offset", "bronze_loaded_at",
    "raw_payload",
)
# Columns of the insight table, in order, as far as present.
INSIGHT_COLUMNS = (
    "lead_id", "full_name", "email", "company_name", "industry", "seniority", "lead_score", "intent_score",
    "intent_level", "urgency", "deal_size_estimate", "next_best_action", "company_summary", "company_stage",
    "buying_readiness", "best_contact_channel", "email_subject", "email_body", "linkedin_message", "key_value_prop",
    "ai_reasoning", "processed_at",
)


def upper_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])


def keep_present(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Lists, structs and maps as JSON text."""
    nested = [n for n, t in df.dtypes if t.startswith(("array", "struct", "map"))]
    return df.withColumns({n: F.to_json(n) for n in nested}) if nested else df


def text_to_null(df: DataFrame, missing: Sequence[str] = (NAN_TEXT, NONE_TEXT)) -> DataFrame:
    """Missing-value texts of string columns become null."""
    texts = [n for n, t in df.dtypes if t == "string"]
    return df.withColumns({n: F.when(~F.col(n).isin(*missing), F.col(n)) for n in texts}) if texts else df


def prepare_for_warehouse(df: DataFrame, missing: Sequence[str] = (NAN_TEXT, NONE_TEXT),
                          loaded_at: Column | None = None) -> DataFrame:
    """Without internal columns, nested values as text, missing-value texts as null, upper-case names, load time."""
    stamp = F.current_timestamp() if loaded_at is None else loaded_at
    kept = df.drop(*[c for c in INTERNAL_COLUMNS if c in df.columns])
    return upper_names(text_to_null(nested_to_json(kept), missing)).withColumn("LOADED_AT", stamp)


def insights_table(insights: DataFrame) -> DataFrame:
    return upper_names(keep_present(insights, INSIGHT_COLUMNS))


def load_table(df: DataFrame, name: str) -> bool:
    """Replace a managed table. An empty input leaves the table alone and returns False."""
    if df.isEmpty():
        return False
    df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return True


def materialize(df: DataFrame, name: str, kind: str = "table") -> DataFrame:
    """Publish a model as a session ``view`` or a managed ``table`` and return it."""
    if kind == "view":
        df.createOrReplaceTempView(name)
    else:
        df.write.mode("overwrite").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)

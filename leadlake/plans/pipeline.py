"""End-to-end jobs over folders."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from leadlake.operators import identity, insights, medallion, quality, summary, warehouse
from leadlake.schemas import BRONZE_LEAD
from leadlake.sources import messages, payloads, tables


@dataclass(frozen=True)
class Layout:
    """Folders of the layers below one root."""

    root: str

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"


LAYERS = ("bronze/leads", "silver/leads", "gold/lead_scores", "unified", "ai_insights")


def run_batch(spark: SparkSession, raw: DataFrame, layout: Layout, run_id: str, profile: str = "warehouse",
              max_leads: int | None = 10) -> DataFrame:
    """Raw leads through all layers, each written once and read back by the next; returns the distribution.

    Every layer is a snapshot of the run: repeating a run replaces it, readers take the latest.
    """
    def stored(df: DataFrame, layer: str) -> DataFrame:
        tables.write_snapshot(df, layout.path(layer), run_id)
        back = spark.read.schema(df.schema.add("run_id", "string")).parquet(layout.path(layer))
        return back.filter(back.run_id == run_id).drop("run_id")

    bronze = stored(raw, "bronze/leads")
    typed = medallion.bronze_leads(bronze) if profile == "warehouse" else bronze
    silver = stored(medallion.silver_leads(typed, profile), "silver/leads")
    gold = stored(medallion.gold_leads(silver, profile), "gold/lead_scores")
    stored(identity.resolve(silver), "unified")
    stored(warehouse.nested_to_json(insights.build_insights(gold, max_leads)), "ai_insights")
    return summary.score_distribution(gold)


def latest_layer(spark: SparkSession, layout: Layout, layer: str) -> DataFrame:
    """Rows of the newest run of a layer."""
    return tables.latest_snapshot(tables.read_layer(spark, layout.path(layer))).drop("run_id")


def check_layers(spark: SparkSession, layout: Layout, now: Column | None = None) -> DataFrame:
    """Quality results of the three layers of the newest run; ``now`` fixes the clock."""
    names = {"BRONZE": "bronze/leads", "SILVER": "silver/leads", "GOLD": "gold/lead_scores"}
    return quality.run_layers({name: latest_layer(spark, layout, layer) for name, layer in names.items()}, now=now)


def publish_models(raw: DataFrame, bronze: str = "bronze_leads", silver: str = "silver_leads",
                   gold: str = "gold_lead_scores") -> DataFrame:
    """Warehouse models: bronze as a view, silver and gold as tables."""
    bronze_view = warehouse.materialize(medallion.bronze_leads(raw), bronze, "view")
    silver_table = warehouse.materialize(medallion.silver_leads(bronze_view), silver)
    return warehouse.materialize(medallion.gold_leads(silver_table), gold)


def land_and_publish(people: DataFrame | None, contacts: DataFrame | None, key: str = "lead_id") -> dict[str, DataFrame]:
    """Landed source payloads as keyed messages per topic."""
    out = {}
    if people is not None:
        out["apollo_leads"] = messages.to_key_value(payloads.flatten_people(people), key)
    if contacts is not None:
        out["crm_events"] = messages.to_key_value(payloads.flatten_contacts(contacts), key)
    return out


def bronze_from_topics(*topics: DataFrame, schema: str = BRONZE_LEAD) -> DataFrame:
    """Bronze rows of several topics, so that no topic is left unread."""
    return tables.union_by_name(*[medallion.parse_envelope(t, schema) for t in topics])

"""Score summaries and top-k reports over gold leads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.functions.scoring import LEVELS
from leadlake.operators.dedup import keep_first


def score_distribution(gold: DataFrame) -> DataFrame:
    """Leads and mean score per intent level."""
    return gold.groupBy("intent_level").agg(
        F.count("lead_id").alias("lead_count"), F.avg("lead_score").alias("avg_score")
    )


# Blocks of a bar that stands for all leads: one block per two percent.
WHOLE_BAR = 50


def intent_share(gold: DataFrame) -> DataFrame:
    """Count, share and bar for every level in fixed order, absent levels included. One pass, one row shuffled.

    The share is rounded half to even; the bar has a block for every full two percent, on a table of any size.
    """
    counts = gold.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("intent_level") == level).alias(level) for level in LEVELS],
    )
    rows = F.explode(F.array(*[
        F.struct(F.lit(i).alias("level_order"), F.lit(level).alias("intent_level"), F.col(level).alias("lead_count"))
        for i, level in enumerate(LEVELS, 1)
    ]))
    return counts.select("total", rows.alias("r")).select(
        "r.*",
        F.when(F.col("total") > 0, F.bround(100 * F.col("r.lead_count") / F.col("total"), 1)).otherwise(0.0).alias("share_pct"),
        F.expr(f"repeat('█', cast({WHOLE_BAR} * r.lead_count div greatest(total, 1) as int))").alias("bar"),
    )


def score_stats(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.avg("lead_score").alias("avg_score"),
        F.max("lead_score").alias("max_score"),
        F.min("lead_score").alias("min_score"),
    )


def top_leads(gold: DataFrame, n: int | None = 10) -> DataFrame:
    """Best leads by score, one per email (ties by lead id); all of them when ``n`` is None."""
    best = keep_first(gold, ["email"], [F.desc("lead_score"), F.col("lead_id")])
    return best if n is None else best.orderBy(F.desc("lead_score"), "lead_id").limit(n)


def top_by_score(gold: DataFrame, n: int = 5) -> DataFrame:
    """The n highest scores, planned as TakeOrderedAndProject."""
    return gold.orderBy(F.desc("lead_score"), "lead_id").limit(n).select(
        "lead_id", "full_name", "company_name", "lead_score", "intent_level", "recommended_action"
    )

"""Lead score: four parts, total, intent level and recommended action."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScoreRules:
    """Fixed values of the score. Bands are (lower bound, result), highest first."""

    seniority: dict[int, tuple[str, ...]] = field(default_factory=lambda: {
        40: ("c_suite", "vp"),
        30: ("director",),
        20: ("manager",),
        10: ("senior",),
    })
    company_size: tuple[tuple[int, int], ...] = ((1000, 30), (200, 25), (50, 15), (10, 10))
    industry: dict[int, tuple[str, ...]] = field(default_factory=lambda: {
        20: ("software", "technology", "saas", "fintech", "information technology"),
        15: ("finance", "banking", "healthcare"),
    })
    floor: int = 5
    completeness: dict[str, int] = field(default_factory=lambda: {
        "email": 3, "company_name": 2, "job_title": 2, "domain": 3,
    })
    levels: tuple[tuple[int, str], ...] = ((80, "hot"), (60, "warm"), (40, "cool"))
    lowest_level: str = "cold"
    actions: dict[str, str] = field(default_factory=lambda: {
        "hot": "schedule_demo", "warm": "send_case_study", "cool": "add_to_nurture", "cold": "enrich_data",
    })


RULES = ScoreRules()
LEVELS = ("hot", "warm", "cool", "cold")


def _banded(value: Column, bands, default) -> Column:
    expr = F.when(value >= bands[0][0], bands[0][1])
    for bound, result in bands[1:]:
        expr = expr.when(value >= bound, result)
    return expr.otherwise(default)


def _listed(value: Column, table: dict[int, tuple[str, ...]], default: int) -> Column:
    expr = F
    for points, members in table.items():
        expr = expr.when(value.isin(*members), points)
    return expr.otherwise(default)


def seniority_points(value: Column, rules: ScoreRules = RULES) -> Column:
    return _listed(value, rules.seniority, rules.floor)


def company_size_points(value: Column, rules: ScoreRules = RULES) -> Column:
    return _banded(value, rules.company_size, rules.floor)


def industry_points(value: Column, rules: ScoreRules = RULES) -> Column:
    return _listed(value, rules.industry, rules.floor)


def completeness_points(domain_column: str, truthy: bool = False, rules: ScoreRules = RULES) -> Column:
    """Points for each filled field; ``truthy`` also treats '' as missing."""
    total = F.lit(0)
    for name, points in rules.completeness.items():
        column = F.col(domain_column if name == "domain" else name)
        filled = (F.coalesce(column, F.lit("")) != "") if truthy else column.isNotNull()
        total = total + F.when(filled, points).otherwise(0)
    return total


def intent_level(score: Column, rules: ScoreRules = RULES) -> Column:
    return _banded(score, rules.levels, rules.lowest_level)


def recommended_action(level: Column, rules: ScoreRules = RULES) -> Column:
    expr = F
    for name in LEVELS[:-1]:
        expr = expr.when(level == name, rules.actions[name])
    return expr.otherwise(rules.actions[rules.lowest_level])

"""Three rule sets for the medallion layers.

The same flow exists in three dialects that differ in null handling, deduplication key and cleaning. A
profile keeps them apart; nothing outside this table asks which dialect is running.

``warehouse``  strict rows, one per email, latest wins. Deterministic, the default.
``stream``     one row per (email, source); rows without email but with an id are kept.
``local``      one row per email, first seen wins; empty text counts as missing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake.functions import text


def _plain(name: str) -> Column:
    return F.col(name)


def _lower_trim(name: str) -> Column:
    return text.lower_trim(name)


def _lower_strip_blank(name: str) -> Column:
    return F.coalesce(text.strip(F.lower(F.col(name))), F.lit(""))


@dataclass(frozen=True)
class Profile:
    name: str
    keep: Callable[[], Column]
    email: Callable[[], Column]
    domain: Callable[[Column], Column]
    full_name: Callable[..., Column]
    job_title: Callable[[str], Column]
    seniority: Callable[[str], Column]
    company_name: Callable[[str], Column]
    company_domain: Callable[[str], Column]
    industry: Callable[[str], Column]
    extra: tuple[str, ...]
    dedup_keys: tuple[str, ...]
    latest_wins: bool
    completeness_domain: str
    completeness_truthy: bool


WAREHOUSE = Profile(
    name="warehouse",
    keep=lambda: F.col("email").isNotNull() & (F.col("email") != text.NONE_TEXT),
    email=lambda: text.lower_trim("email"),
    domain=text.domain_part_two,
    full_name=text.name_null_if_any_null,
    job_title=_lower_trim,
    seniority=text.enum_sentinel_unknown,
    company_name=F.trim,
    company_domain=_lower_trim,
    industry=text.enum_sentinel_unknown,
    extra=("apollo_score", "ingested_at"),
    dedup_keys=("email",),
    latest_wins=True,
    completeness_domain="email_domain",
    completeness_truthy=False,
)

STREAM = Profile(
    name="stream",
    keep=lambda: F.col("email").isNotNull() | F.col("lead_id").isNotNull(),
    email=lambda: text.lower_trim("email"),
    domain=text.domain_after_first_at,
    full_name=text.name_skip_nulls,
    job_title=_plain,
    seniority=text.enum_null_unknown,
    company_name=F.trim,
    company_domain=_plain,
    industry=text.enum_null_unknown,
    extra=("lead_status",),
    dedup_keys=("email", "source"),
    latest_wins=False,
    completeness_domain="company_domain",
    completeness_truthy=False,
)

LOCAL = Profile(
    name="local",
    keep=lambda: F.coalesce(F.col("email"), F.lit("")) != "",
    email=lambda: text.strip(F.lower(F.col("email"))),
    domain=text.domain_part_two,
    full_name=text.name_stripped,
    job_title=_lower_strip_blank,
    seniority=text.enum_blank_unknown,
    company_name=lambda c: F.coalesce(text.strip(c), F.lit("")),
    company_domain=_lower_strip_blank,
    industry=text.enum_blank_unknown,
    extra=("lead_status", "ingested_at"),
    dedup_keys=("email",),
    latest_wins=False,
    completeness_domain="email_domain",
    completeness_truthy=True,
)

PROFILES = {p.name: p for p in (WAREHOUSE, STREAM, LOCAL)}


def get(profile: str | Profile) -> Profile:
    return profile if isinstance(profile, Profile) else PROFILES[profile]

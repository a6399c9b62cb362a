"""Data expectations, compiled to one aggregate per table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: what a well-formed email looks like.
EMAIL_PATTERN = r"^[^@]+@[^@]+\.[^@]+$"

PASS, FAIL, SKIP = "PASS", "FAIL", "SKIP"


@dataclass(frozen=True)
class Check:
    expectation: str
    column: str | None = None
    min_rows: int | None = None
    valid_values: tuple[str, ...] | None = None


def no_nulls(column: str) -> Check:
    return Check("expect_column_no_nulls", column)


def unique(column: str) -> Check:
    return Check("expect_column_unique", column)


def values_in_set(column: str, valid_values: Sequence[str]) -> Check:
    return Check("expect_values_in_set", column, valid_values=tuple(valid_values))


def row_count_above(min_rows: int) -> Check:
    return Check("expect_row_count_above", min_rows=min_rows)


def no_future_dates(column: str) -> Check:
    return Check("expect_no_future_dates", column)


def email_format(column: str) -> Check:
    return Check("expect_email_format", column)


# The suites of the three layers.
SUITES: dict[str, tuple[Check, ...]] = {
    "BRONZE": (row_count_above(1), no_nulls("lead_id"), no_nulls("source"), no_nulls("ingested_at")),
    "SILVER": (
        row_count_above(1), no_nulls("lead_id"), no_nulls("email"), unique("email"), email_format("email"),
        values_in_set("source", ("apollo", "hubspot", "salesforce", "unknown")), no_future_dates("ingested_at"),
    ),
    "GOLD": (
        row_count_above(1), no_nulls("lead_id"), no_nulls("lead_score"),
        values_in_set("intent_level", ("hot", "warm", "cool", "cold")),
        values_in_set("recommended_action", ("schedule_demo", "send_case_study", "add_to_nurture", "enrich_data")),
    ),
}


def _bad_rows(check: Check, dtypes: dict[str, str], now: Column) -> Column:
    """Aggregate that counts what breaks the expectation (for the row count: the rows)."""
    if check.expectation == "expect_row_count_above":
        return F.count(F.lit(1))
    if check.column not in dtypes:
        return F.lit(0).cast("bigint")
    column = F.col(check.column)
    if check.expectation == "expect_column_no_nulls":
        return F.count_if(column.isNull())
    if check.expectation == "expect_values_in_set":
        return F.count_if(~F.coalesce(column.isin(*check.valid_values), F.lit(False)))
    if check.expectation == "expect_email_format":
        return F.count_if(~F.coalesce(column.rlike(EMAIL_PATTERN), F.lit(False)))
    moment = F.try_to_timestamp(column) if dtypes[check.column] == "string" else column.cast("timestamp")
    return F.count_if(moment > now)


def _result(check: Check, bad: Column, total: Column, known: bool) -> Column:
    """Result struct of one check from its count."""
    kind = check.expectation
    where = check.column or ""
    null_of = lambda t: F.lit(None).cast(t)
    count_as = lambda *kinds: (bad if kind in kinds else null_of("bigint"))
    if not known:
        status = SKIP if kind == "expect_no_future_dates" else FAIL
        passed, message = F.lit(status == SKIP), F.lit(f"{status} — column {where} not found")
        bad = null_of("bigint")
    else:
        failure = {
            "expect_column_no_nulls": F.concat(bad.cast("string"), F.lit(f" nulls found in {where}")),
            "expect_column_unique": F.concat(bad.cast("string"), F.lit(f" duplicates in {where}")),
            "expect_values_in_set": F.concat(bad.cast("string"), F.lit(" rows with invalid values")),
            "expect_row_count_above": F.concat(
                F.lit("only "), bad.cast("string"), F.lit(f" rows, expected >= {check.min_rows}")),
            "expect_no_future_dates": F.concat(bad.cast("string"), F.lit(" future dates")),
            "expect_email_format": F.concat(bad.cast("string"), F.lit(" invalid emails")),
        }[kind]
        passed = (bad >= check.min_rows) if kind == "expect_row_count_above" else (bad == 0)
        message = F.when(passed, F.lit(PASS)).otherwise(F.concat(F.lit(f"{FAIL} — "), failure))
    count_as = lambda *kinds: (bad if kind in kinds else null_of("bigint"))
    null_pct = F.when(total > 0, F.bround(100 * bad / total, 2)).otherwise(F.lit(0.0))
    valid = F.array(*map(F.lit, check.valid_values)) if check.valid_values else null_of("array<string>")
    return F.struct(
        F.lit(kind).alias("expectation"),
        F.lit(check.column).cast("string").alias("column"),
        F.when(passed, F.lit(SKIP if not known else PASS)).otherwise(F.lit(FAIL)).alias("status"),
        passed.alias("passed"),
        message.alias("message"),
        total.alias("total_rows"),
        count_as("expect_column_no_nulls").alias("null_count"),
        (null_pct if kind == "expect_column_no_nulls" else null_of("double")).alias("null_pct"),
        count_as("expect_column_unique").alias("duplicate_count"),
        F.lit(check.min_rows).cast("bigint").alias("min_rows"),
        count_as("expect_no_future_dates").alias("future_count"),
        count_as("expect_values_in_set", "expect_email_format").alias("invalid_count"),
        valid.alias("valid_values"),
    )


def _counts(df: DataFrame, checks: Sequence[Check], dtypes: dict[str, str], now: Column) -> DataFrame:
    """One row: ``total`` and ``bad_<i>`` of every check.

    Everything but uniqueness is one aggregate without a shuffle of rows. The distinct values of each column under a uniqueness check are
    counted by a branch of their own, which reads and shuffles that column only: several distinct counts in one aggregate would
    send each row once per column. The branches meet as one-row tables.
    """
    names = [f"bad_{i}" for i in range(len(checks))]
    own = {i: check.column for i, check in enumerate(checks) if check.expectation == "expect_column_unique" and check.column in dtypes}
    parts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[_bad_rows(check, dtypes, now).cast("bigint").alias(names[i]) for i, check in enumerate(checks) if i not in own],
    )
    if not own:
        return parts
    for column in dict.fromkeys(own.values()):
        distinct = df.select(F.col(column).alias("_v")).distinct().agg(F.count("_v").alias("_n"))
        parts = parts.unionByName(distinct.select(*[F.col("_n").alias(names[i]) for i, c in own.items() if c == column]), True)
    merged = parts.agg(*[F.max(c).alias(c) for c in ("total", *names)])
    return merged.withColumns({names[i]: F.col("total") - F.col(names[i]) for i in own})


def run_suite(df: DataFrame, checks: Sequence[Check], layer: str, now: Column | None = None) -> DataFrame:
    """One row per check. No column is read more than twice, whatever the number of checks; ``df`` should be a stored table.

    A missing column fails its check; only the date check skips. ``now`` fixes the clock.
    """
    now = F.current_timestamp() if now is None else now
    dtypes = dict(df.dtypes)
    counts = _counts(df, checks, dtypes, now)
    results = F.array(*[
        _result(check, F.col(f"bad_{i}"), F.col("total"), check.column is None or check.column in dtypes)
        for i, check in enumerate(checks)
    ])
    return counts.select(F.posexplode(results).alias("position", "r")).select(
        F.lit(layer).alias("layer"), (F.col("position") + 1).alias("check_no"), "r.*"
    )


def invalid_values(df: DataFrame, column: str, valid_values: Sequence[str]) -> DataFrame:
    """Every distinct value outside the set, with its rows: the detail behind a failed set check.

    Rows, not one list, because a broken column may hold any number of values.
    """
    outside = ~F.coalesce(F.col(column).isin(*valid_values), F.lit(False))
    return df.filter(outside).groupBy(F.col(column).cast("string").alias("invalid_value")).agg(
        F.count(F.lit(1)).alias("row_count")
    )


def run_layers(layers: dict[str, DataFrame], suites: dict[str, Sequence[Check]] | None = None,
               now: Column | None = None) -> DataFrame:
    """Results of all layers in one table."""
    suites = suites or SUITES
    results = [run_suite(df, suites[name], name, now) for name, df in layers.items()]
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out


def failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed"))


def summary(results: DataFrame) -> DataFrame:
    """Checks, passed (skipped ones included), failed, skipped, pass rate in percent (rounded half to even)."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("failed"),
        F.count_if(F.col("status") == SKIP).alias("skipped"),
    )
    rate = F.when(F.col("total_checks") > 0, F.bround(100 * F.col("passed") / F.col("total_checks"), 1)).otherwise(0.0)
    return counts.withColumn("pass_rate", rate)

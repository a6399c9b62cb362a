"""Stored model answers: each distinct prompt is asked until it has one usable answer, and never again.

An answer is kept under the digest of its prompt, so leads with the same prompt share it and a later run asks only what is new or
failed. Every try is a row ``digest, run, response, error``; the table only grows by appends.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.operators.insights import _usable
from leadlake.operators.skew import skew_safe_lookup
from leadlake.session import cut_lineage
from leadlake.sources.tables import read_layer

# Executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ANSWERS = "digest string, run string, response string, error string"
# From (system prompt, user prompt) pairs to texts in the same order; None where there is no answer.
Model = Callable[[Sequence[tuple[str, str]]], Sequence[str | None]]


def with_digest(prompts: DataFrame) -> DataFrame:
    """Prompts with the digest of both texts; a null text counts as different from an empty one."""
    part = lambda c: F.coalesce(F.concat(F.length(c).cast("string"), F.lit(":"), F.col(c)), F.lit("-"))
    return prompts.withColumn("digest", F.sha2(F.concat(part("system_prompt"), part("user_prompt")), 256))


def stored(spark: SparkSession, folder: str) -> DataFrame:
    """All tries so far."""
    return read_layer(spark, folder, ANSWERS)


def usable_answers(tries: DataFrame) -> DataFrame:
    """``digest, response``: the first usable answer by run, then text."""
    return tries.filter(_usable(F.col("response"))).groupBy("digest").agg(F.min_by("response", F.struct("run", "response")).alias("response"))


def _caller(model: Model, run: str, batch_rows: int, attempts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def call(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for start in range(0, len(frame), batch_rows):
                part = frame.iloc[start:start + batch_rows]
                pairs = list(zip(part["system_prompt"], part["user_prompt"]))
                replies, error = [None] * len(pairs), [None] * len(pairs)
                for _ in range(attempts):
                    open_ = [i for i, reply in enumerate(replies) if reply is None]
                    if not open_:
                        break
                    try:
                        got = list(model([pairs[i] for i in open_]))
                        if len(got) != len(open_):
                            raise ValueError(f"{len(got)} answers to {len(open_)} prompts")
                    except Exception as problem:  # a model that is down must not end the run; the try is recorded
                        for i in open_:
                            error[i] = f"{type(problem).__name__}: {problem}"
                        continue
                    for i, reply in zip(open_, got):
                        replies[i], error[i] = reply, None if reply is not None else "no answer"
                yield pd.DataFrame({"digest": part["digest"].to_numpy(), "run": run, "response": pd.Series(replies, dtype=object),
                                    "error": pd.Series(error, dtype=object)})
    return call


def ask(prompts: DataFrame, model: Model, folder: str, run: str, batch_rows: int = 32, attempts: int = 3) -> DataFrame:
    """Ask what has no usable answer yet and return ``lead_id, response`` of all prompts that have one.

    The model gets at most ``batch_rows`` prompts at a time and each prompt up to ``attempts`` times in a run; text that is not a JSON
    object is stored and asked again by the next run. A task that is repeated asks its prompts again; only its last answers are stored.
    """
    spark = prompts.sparkSession
    keyed = cut_lineage(with_digest(prompts))
    distinct = keyed.groupBy("digest").agg(
        F.first("system_prompt").alias("system_prompt"), F.first("user_prompt").alias("user_prompt"), F.count(F.lit(1)).alias("n"))
    distinct = cut_lineage(distinct)
    known = usable_answers(stored(spark, folder)).select("digest")
    new = distinct.join(known, "digest", "left_anti").select("digest", "system_prompt", "user_prompt")
    new.mapInPandas(_caller(model, run, batch_rows, attempts), ANSWERS).write.mode("append").parquet(folder)
    answers = usable_answers(stored(spark, folder)).join(distinct.select("digest", "n"), "digest")
    return skew_safe_lookup(keyed.select("lead_id", "digest"), answers, "digest", "n", keyed.count()).select("lead_id", "response")


def cached(model: Model, folder: str, run: str, **limits: int) -> Callable[[DataFrame], DataFrame]:
    """A scorer for ``insights.run_stage`` and ``build_insights``."""
    return lambda prompts: ask(prompts, model, folder, run, **limits)

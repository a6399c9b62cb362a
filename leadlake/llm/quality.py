"""Quality rules: fixed document statistics, two hard rules, and boosted trees over the statistics.

The trees learn from labelled documents (a bounded sample) and may only get stricter as repetition, symbols, capitals or
exclamation marks grow. They are flat numpy arrays, scored for a whole Arrow batch at a time. The threshold is calibrated
on labelled rows that the trees did not see, so that nearly all good documents stay.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm import boosting
from leadlake.llm.common import batch_map

# Most labelled documents used to fit; they are picked by a hash of doc_id.
MAX_LABELLED = 20_000
# Share of good validation documents that the trees may reject.
FALSE_REJECTS = 0.001
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

_SPACE = b" \t\n\v\f\r"
_SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
_START = (np.arange(256) & 0xC0) != 0x80  # bytes that begin a code point
_UPPER = np.arange(ord("A"), ord("Z") + 1)
_LETTER = np.r_[_UPPER, _UPPER + 32]
_DIGIT = np.arange(ord("0"), ord("9") + 1)

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_distinct", "n_upper",
              "n_letters", "n_digits", "n_marks", "longest_word")
BASE = STATISTICS[:5]
# Features of the trees; those of MONOTONE may only push a document in one direction (+1: towards rejection).
FEATURES = ("log_words", "word_length", "symbols", "dup_lines", "repeats", "distinct", "upper", "digits", "marks",
            "longest", "line_length")
MONOTONE = {FEATURES.index(name): sign for name, sign in
            {"symbols": 1, "dup_lines": 1, "repeats": 1, "distinct": -1, "upper": 1, "marks": 1}.items()}


def statistics(text: bytes) -> tuple[int, ...]:
    """The values of STATISTICS for one text."""
    words = text.split()
    if not words:
        return (0,) * 2 + (sum(text.count(bytes([s])) for s in _SYMBOLS),) + (0,) * (len(STATISTICS) - 3)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    spaces = int(count[list(_SPACE)].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    grams = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(grams)) < len(grams):
        seen = Counter(grams)
        often = np.fromiter((seen[g] > 1 for g in grams), bool, len(grams))
        covered = np.zeros(len(words), dtype=bool)
        for shift in range(3):
            covered[shift:shift + len(grams)] |= often
        repeated = int(covered.sum())
    return (
        len(words), int(count[_START].sum()) - spaces, int(count[_SYMBOLS].sum()), len(lines) - len(set(lines)), repeated,
        len(lines), len(set(words)), int(count[_UPPER].sum()), int(count[_LETTER].sum()), int(count[_DIGIT].sum()),
        int(count[ord("!")]), max(map(len, words)),
    )


def feature_matrix(stats: np.ndarray) -> np.ndarray:
    """Features of FEATURES from rows of STATISTICS."""
    s = dict(zip(STATISTICS, stats.T.astype(float)))
    words, chars, lines = (np.maximum(s[c], 1) for c in ("n_words", "word_chars", "n_lines"))
    return np.stack([
        np.log1p(s["n_words"]), s["word_chars"] / words, s["n_symbols"] / chars, s["n_dup_lines"] / lines,
        s["n_repeat_words"] / words, s["n_distinct"] / words, s["n_upper"] / np.maximum(s["n_letters"], 1),
        s["n_digits"] / chars, s["n_marks"] / chars, s["longest_word"], words / lines,
    ], axis=1)


def base_failed(stats: np.ndarray) -> np.ndarray:
    words, repeats = (stats[:, STATISTICS.index(c)] for c in ("n_words", "n_repeat_words"))
    return (words < MIN_WORDS) | (100 * repeats > MAX_REPEAT_PERCENT * words)


def batch_statistics(batch: pa.RecordBatch) -> np.ndarray:
    texts = pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()
    return np.array([statistics(t) for t in texts], dtype=np.int64).reshape(len(texts), len(STATISTICS))


@dataclass(frozen=True)
class Verdict:
    """Fitted trees and the log-odds from which a document is rejected; without trees all that pass the rules are kept."""

    forest: boosting.Forest | None
    limit: float

    def kept(self, stats: np.ndarray) -> np.ndarray:
        keep = ~base_failed(stats)
        if self.forest is not None and keep.any():
            keep &= self.forest.margin(feature_matrix(stats)) < self.limit
        return keep


def labelled_sample(labels: DataFrame, column: str, limit: int) -> DataFrame:
    """At most ``limit`` labelled ids with one 0/1 label each, picked by a hash; contradicting labels count as 0."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).groupBy(
        F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(column).cast("int").alias("label"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def fit_verdict(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Verdict:
    """Fit trees and threshold on the labelled documents of a sample of at most ``limit`` ids.

    Ids that repeat give only one row. With fewer than 50 usable rows or one class no trees are fitted.
    """
    sample = F.broadcast(labelled_sample(labels, "quality", limit))  # two numbers a row, at most ``limit`` rows
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def run(batch: pa.RecordBatch):
        stats = batch_statistics(batch)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), *(pa.array(c) for c in stats.T)], ["doc_id", "label", *STATISTICS])

    schema = "doc_id long, label int, " + ", ".join(f"{c} long" for c in STATISTICS)
    found = batch_map(texts.join(sample, "doc_id"), run, schema)
    rows = found.dropDuplicates(["doc_id"]).orderBy("doc_id").limit(limit).collect()
    data = np.array([tuple(r) for r in rows], dtype=np.int64).reshape(len(rows), 2 + len(STATISTICS))
    data = data[~base_failed(data[:, 2:])]
    bad = 1 - data[:, 1]
    if len(data) < 50 or bad.min() == bad.max():
        return Verdict(None, np.inf)
    check = np.arange(len(data)) % 4 == 3
    features = feature_matrix(data[:, 2:])
    forest = boosting.fit(features[~check], bad[~check], MONOTONE)
    good = np.sort(forest.margin(features[check & (bad == 0)]))
    spare = int(len(good) * FALSE_REJECTS)
    limit_at = good[len(good) - 1 - spare] if len(good) else 0.0
    return Verdict(forest, float(max(np.nextafter(limit_at, np.inf), 0.0)))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, the statistics of BASE, ``base_failed`` and ``kept``.

    Null text counts as empty and fails; a null ``doc_id`` is assessed but never used to learn. Repeated rows are assessed
    each. Other columns are ignored.
    """
    verdict = fit_verdict(docs, labels)

    def run(batch: pa.RecordBatch):
        stats = batch_statistics(batch)
        columns = [batch.column("doc_id"), *(pa.array(c) for c in stats.T[:len(BASE)]),
                   pa.array(base_failed(stats)), pa.array(verdict.kept(stats))]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", *BASE, "base_failed", "kept"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, kept boolean"
    return batch_map(texts, run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that ``assess`` keeps, with all their columns. Null and empty texts have no words and go; repeated rows are judged alike; an
    empty table gives no rows."""
    verdict = fit_verdict(docs, labels)
    return batch_map(docs, lambda batch: [batch.filter(pa.array(verdict.kept(batch_statistics(batch))))], docs.schema)

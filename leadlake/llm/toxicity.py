"""Toxicity by compression distance: a zstandard dictionary of ordinary text against one of toxic text.

Both dictionaries begin with content that zstandard selects from ordinary training windows. The toxic one goes on with the word
beginnings that mark toxic training texts (frequent there, many times rarer elsewhere), the ordinary one with as many
bytes that match nothing, so that a window without toxic material is compressed alike by both. Each text is cut into
windows of whole words, each window is compressed with both, and the bytes that the toxic dictionary saves are summed up per document.
Boosted trees on a part of the labelled rows that the dictionaries have not seen turn these savings into a probability, the calibrated
threshold of the classifier.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm import boosting
from leadlake.llm.common import batch_map
from leadlake.llm.quality import labelled_sample

# Most labelled documents used to fit (picked by a hash of doc_id); of these the whole texts.
MAX_LABELLED = 8_000
# One labelled document in CALIBRATION is kept from the dictionaries to fit the trees.
CALIBRATION = 4
WINDOW = 128
DICTIONARY = 16_384
# Lengths in bytes of word beginnings, the least share of toxic texts that hold one, and how much rarer it is elsewhere.
STEM = range(5, 16)
STEM_SHARE = 0.015
STEM_RATIO = 20
THRESHOLD = 0.3
FEATURES = ("largest", "three_largest", "mean", "total", "windows_saved", "share_saved", "log_windows")
MONOTONE = {FEATURES.index(name): 1 for name in ("largest", "three_largest", "mean")}


def windows(text: bytes, size: int = WINDOW) -> list[bytes]:
    """The lower-case text in windows of at most ``size`` bytes, cut after a space where the second half has one."""
    text = b" " + text.lower() if text else text
    out, start = [], 0
    while start < len(text):
        end = min(len(text), start + size)
        if end < len(text):
            space = text.rfind(b" ", start + size // 2, end)
            end = space if space > 0 else end
        out.append(text[start:end])
        start = end
    return out


def _words(text: bytes) -> set[bytes]:
    """Lower-case words: letters and all bytes beyond ASCII."""
    letters = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
    return set(text.lower().translate(letters).split())


def _beginnings(text: bytes) -> set[bytes]:
    return {(b" " + w)[:k] for w in _words(text) for k in STEM if k <= len(w) + 1}


def toxic_stems(toxic: list[bytes], ordinary: list[bytes]) -> list[bytes]:
    """Word beginnings typical of toxic texts, most frequent first; none begins another."""
    often: Counter[bytes] = Counter()
    for text in toxic:
        often.update(_beginnings(text))
    least = max(4, STEM_SHARE * len(toxic) + 3)
    often = Counter({g: n for g, n in often.items() if n >= least})
    elsewhere: Counter[bytes] = Counter()
    for text in ordinary:
        elsewhere.update(_beginnings(text) & often.keys())
    typical = [(n, len(g), g) for g, n in often.items()
               if n / len(toxic) > STEM_RATIO * (elsewhere[g] + 1) / len(ordinary)]
    chosen: list[bytes] = []
    for _, _, g in sorted(typical, reverse=True):
        if not any(g.startswith(c) or c.startswith(g) for c in chosen):
            chosen.append(g)
    return chosen


def without_copies(texts: list[tuple[bytes, int]]) -> list[tuple[bytes, int]]:
    """Texts of which less than a fifth of the five-word runs came up before, so that copies don't make a word frequent.

    A fixed eighth of all runs, chosen by checksum, stands for all of them.
    """
    seen: set[int] = set()
    fresh = []
    for text, label in texts:
        words = text.split()
        sums = (crc32(b" ".join(words[k:k + 5])) for k in range(max(1, len(words) - 4)))
        runs = {s for s in sums if s % 8 == 0}
        if not runs or 5 * len(runs & seen) < len(runs):
            fresh.append((text, label))
        seen |= runs
    return fresh


@dataclass(frozen=True)
class Model:
    """Raw contents of the two dictionaries and the trees; ``forest`` is None if there was too little to learn from."""

    ordinary: bytes
    toxic: bytes
    forest: boosting.Forest | None
    prior: float

    def compressors(self) -> list[zstandard.ZstdCompressor]:
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY2, min_match=4, window_log=18, hash_log=15, chain_log=16, search_log=7,
            target_length=32, write_content_size=0, write_checksum=0, write_dict_id=0)
        made = []
        for content in (self.ordinary, self.toxic):
            content = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            content.precompute_compress(compression_params=settings)
            made.append(zstandard.ZstdCompressor(dict_data=content, compression_params=settings))
        return made

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.forest is None:
            return np.full(len(features), self.prior)
        return 1 / (1 + np.exp(-self.forest.margin(features)))


def savings(text: bytes, ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor) -> tuple[float, ...]:
    """The values of FEATURES: bytes that the toxic dictionary saves over the windows of a text."""
    parts = windows(text)
    if not parts:
        return (0.0,) * len(FEATURES)
    saved = np.array([len(ordinary.compress(w)) - len(toxic.compress(w)) for w in parts], dtype=float)
    top = np.sort(saved)[::-1][:3]
    hits = float((saved >= 2).sum())
    return (top[0], top.mean(), saved.mean(), saved.sum(), hits, hits / len(saved), float(np.log1p(len(saved))))


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED) -> Model:
    """Fit on at most ``limit`` labelled documents that are not held out, with their whole texts.

    With fewer than 10 documents of either label the score is the share of toxic labels.
    """
    sample = F.broadcast(labelled_sample(labels.filter(~held_out()), "toxic", limit))  # two numbers a row
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(sample, "doc_id")

    def lowered(batch: pa.RecordBatch):
        keep = [text.lower() for text in _texts(batch)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), pa.array(keep, pa.binary())],
                                         ["doc_id", "label", "text"])

    for_trees = F.pmod(F.xxhash64("doc_id"), F.lit(CALIBRATION)) == 0
    rows = batch_map(known.filter(~for_trees), lowered, "doc_id long, label int, text binary").dropDuplicates(
        ["doc_id"]).orderBy("doc_id").limit(limit).collect()
    all_labels = [r.label for r in rows]
    prior = float(np.mean(all_labels)) if rows else 0.0
    fresh = without_copies([(bytes(r.text), r.label) for r in rows])
    toxic, ordinary = ([t for t, label in fresh if label == k] for k in (1, 0))
    if min(len(toxic), len(ordinary)) < 10:
        return Model(b"", b"", None, prior)
    parts = [w for t in ordinary for w in windows(t)]
    try:
        content = zstandard.train_dictionary(DICTIONARY, parts).as_bytes()
    except zstandard.ZstdError:  # too few windows to select from
        content = b"".join(parts)[-DICTIONARY:]
    content = content[-DICTIONARY + 2048:]  # what precedes it are entropy tables
    marks = b"".join(reversed(toxic_stems(toxic, ordinary))) + b" "
    model = Model(content + bytes(len(marks)), content + marks, None, prior)

    def measure(batch: pa.RecordBatch):
        pair = model.compressors()
        values = np.array([savings(t, *pair) for t in _texts(batch)], dtype=float).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), *map(pa.array, values.T)],
                                         ["doc_id", "label", *FEATURES])

    schema = "doc_id long, label int, " + ", ".join(f"{f} double" for f in FEATURES)
    rows = batch_map(known.filter(for_trees), measure, schema).dropDuplicates(["doc_id"]).orderBy("doc_id").limit(
        limit).collect()
    data = np.array([tuple(r) for r in rows], dtype=float).reshape(len(rows), 2 + len(FEATURES))
    if len(data) < 30 or data[:, 1].min() == data[:, 1].max():
        return model
    return Model(model.ordinary, model.toxic, boosting.fit(data[:, 2:], data[:, 1], MONOTONE, trees=30, depth=3, least_weight=1.0), prior)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row per document (columns ``doc_id``, ``text``; others are ignored).

    Null and empty texts have no windows and save nothing; they get the score of such a text. A null ``doc_id`` counts as not held out
    and is never learned from. Repeated rows are scored each.
    """
    model = train(docs, labels)

    def run(batch: pa.RecordBatch):
        pair = model.compressors() if model.forest is not None else None
        texts = _texts(batch)
        values = np.zeros((len(texts), len(FEATURES)))
        if pair:
            values = np.array([savings(t, *pair) for t in texts], dtype=float)
        score = model.score(values)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("held_out"), pa.array(score),
             pa.array((score >= THRESHOLD).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"),
                       F.col("text").cast("string").alias("text"))
    return batch_map(rows, run, "doc_id long, held_out boolean, score double, predicted int")

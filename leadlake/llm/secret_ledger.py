"""Secret scans with an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. A ledger, a Parquet table in a shared folder, holds which rule
versions have scanned which blob, and what they found. A scan compares the blobs of its input with the ledger, scans each blob
once with the rule versions that have not seen it, appends the result, and joins the findings of all blobs back to their paths. So
copies cost nothing, a new version of a path costs its own blob, and a new rule version is run alone.

Texts travel compressed and only as far as they are unseen: the work list (blob, rules to run) is a stored table, and where it
is small enough, texts are dropped by it before they move.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leadlake.llm.common import batch_map, packed, utf8
from leadlake.operators.skew import skew_safe_lookup
from leadlake.session import scratch_path


class Rule(NamedTuple):
    """A pattern over UTF-8 bytes; ``group`` must have ``least`` bytes, or the match is dropped. ``hints``: a text without any
    of these lower-case byte strings cannot match."""

    kind: str
    version: int
    pattern: bytes
    group: int = 0
    least: int = 0
    hints: tuple[bytes, ...] = ()

    @property
    def key(self) -> str:
        return f"{self.kind}@{self.version}"


# The base rules, in the order in which kinds are listed.
BASE = (
    Rule("assign", 1, rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12,
         (b"passw", b"secret", b"token", b"api")),
    Rule("access", 1, rb"AKIA[A-Z0-9]+", 0, 18, (b"akia",)),
    Rule("hex", 1, rb"[0-9a-f]{16,}"),
)
# Further rules for public formats: key blocks, signed tokens, addresses with a password, tokens with a known beginning.
ADDED = (
    Rule("pem", 1, rb"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", hints=(b"private key",)),
    Rule("jwt", 1, rb"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", hints=(b"eyj",)),
    Rule("login", 1, rb"[a-z][a-z0-9+.-]{1,15}://[^\x00-\x20/:@\"'<>]{1,64}:[^\x00-\x20/:@\"'<>]{4,128}@", hints=(b"://",)),
    Rule("prefixed", 1, rb"(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}"
                        rb"|[rs]k_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})", hints=(b"gh", b"glpat-", b"xox", b"k_live_", b"aiza")),
)
RULES = BASE + ADDED

LEDGER = "blob binary, rules array<string>, findings array<struct<rule:string,start:int,end:int>>"
# A work list of up to so many blobs (about 32 bytes each) is broadcast to drop seen texts before they move.
BROADCAST_BLOBS = 100_000


def content_address(column: str = "text") -> Column:
    """SHA-256 of a text's UTF-8 bytes, 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(utf8(column), 256))


def find(text: bytes, rules: Sequence[Rule]) -> list[tuple[str, int, int]]:
    """``(rule key, start, end)`` in code points, by rule and start; leftmost matches that do not overlap within a rule.

    A match whose group is too short is dropped, and the search goes on behind it.
    """
    found: list[tuple[str, int, int]] = []
    lower = text.lower()
    for rule in rules:
        if rule.hints and not any(h in lower for h in rule.hints):
            continue
        at = chars = 0  # code points before the byte ``at``
        for hit in re.finditer(rule.pattern, text):
            if hit.end(rule.group) - hit.start(rule.group) < rule.least:
                continue
            start = chars + len(text[at:hit.start()].decode("utf-8", "replace"))
            chars = start + len(hit.group().decode("utf-8", "replace"))
            at = hit.end()
            found.append((rule.key, start, chars))
    return found


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """All rows that scans have appended; none for a folder without scans."""
    marks = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(folder, "run-*", "_SUCCESS"))
    runs = marks.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(marks)
    done = [r.getPath().getParent().toString() for r in runs or []]
    return spark.read.schema(LEDGER).parquet(*done) if done else spark.createDataFrame([], LEDGER)


def _work(blobs: DataFrame, ledger: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(blob, rules)``: what has to be scanned, with the rule versions that have not seen the blob."""
    seen = ledger.select("blob", F.explode("rules").alias("rule"))
    wanted = F.array(*(F.lit(r.key) for r in rules))
    missing = F.array_except(wanted, F.coalesce(F.flatten(F.collect_list("past")), F.array().cast("array<string>")))
    both = blobs.select("blob", F.lit(1).alias("here"), F.lit(None).cast("array<string>").alias("past")).unionByName(
        seen.filter(F.col("rule").isin([r.key for r in rules])).groupBy("blob").agg(F.collect_set("rule").alias("past"))
        .withColumn("here", F.lit(0)))
    return both.groupBy("blob").agg(F.max("here").alias("here"), missing.alias("rules")).filter(
        (F.col("here") == 1) & (F.size("rules") > 0)).select("blob", "rules")


def _packed_texts(texts: DataFrame) -> DataFrame:
    """``(blob, packed)``: compressed texts, each once per blob."""
    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3).compress
        seen: dict[bytes, bytes] = {}
        for blob, text in zip(batch.column("blob"), batch.column("text")):
            key = blob.as_py()
            if key not in seen:
                seen[key] = pack(text.as_buffer())
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.binary())],
                                         names=["blob", "packed"])

    return batch_map(texts, fn, "blob binary, packed binary").groupBy("blob").agg(F.min("packed").alias("packed"))


def _scan(todo: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Ledger rows for ``(blob, packed, rules)``."""
    by_key = {r.key: r for r in rules}
    kinds = pa.list_(pa.struct([("rule", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        findings = []
        for text, keys in zip(batch.column("packed"), batch.column("rules").to_pylist()):
            hits = find(unpack(text.as_buffer()), [by_key[k] for k in keys])
            findings.append([{"rule": rule, "start": start, "end": end} for rule, start, end in hits])
        yield pa.RecordBatch.from_arrays(
            [batch.column("blob"), batch.column("rules"), pa.array(findings, kinds)], names=["blob", "rules", "findings"])

    return batch_map(todo.select("blob", "packed", "rules"), fn, LEDGER)


def scan(versions: DataFrame, folder: str, rules: Sequence[Rule] = RULES, broadcast_blobs: int = BROADCAST_BLOBS) -> int:
    """Bring the ledger up to date with all texts of ``versions``; the number of blobs that had to be scanned.

    Each scan appends one finished folder to the ledger; one that was interrupted leaves a folder without success mark, which
    is never read, and is simply run again. Two scans at once may both scan a blob, which changes no result. Rule versions
    are named ``kind@version``: raise a version when a pattern changes.
    """
    spark = versions.sparkSession
    texts = versions.select(content_address().alias("blob"), utf8().alias("text"))
    path = scratch_path(spark, "secret-work")
    _work(texts.select("blob").distinct(), read_ledger(spark, folder), rules).write.parquet(path)
    work = spark.read.parquet(path)
    n = work.count()
    if not n:
        return 0
    if n <= broadcast_blobs:
        texts = texts.join(F.broadcast(work.select("blob")), "blob", "left_semi")
    todo = _packed_texts(texts).join(work, "blob")
    _scan(todo, rules).write.parquet(os.path.join(folder, f"run-{uuid.uuid4().hex}"))
    return n


def findings(versions: DataFrame, folder: str, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Columns of ``versions`` but ``text`` as struct ``kept``, ``blob``, and ``findings`` of ``rules``:
    ``array<struct<start, place, end, kind>>`` in code points, sorted by start, order of the rules and end.

    Null texts count as empty, repeated rows are reported each. Blobs that no scan has seen have no findings: ``scan`` first.
    """
    order = F.create_map(*(F.lit(x) for i, r in enumerate(rules) for x in (r.key, i)))
    kinds = F.create_map(*(F.lit(x) for r in rules for x in (r.key, r.kind)))
    known = F.filter(F.array_distinct(F.flatten(F.collect_list("findings"))), lambda f: f["rule"].isin([r.key for r in rules]))
    found = read_ledger(versions.sparkSession, folder).filter(F.size("findings") > 0).groupBy("blob").agg(known.alias("hits")).select(
        "blob", F.array_sort(F.transform("hits", lambda f: F.struct(
            f["start"].alias("start"), order[f["rule"]].alias("place"), f["end"].alias("end"), kinds[f["rule"]].alias("kind"),
        ))).alias("hits"))
    paths = versions.select(packed(versions.drop("text")), content_address().alias("blob"))
    sizes = paths.groupBy("blob").agg(F.count(F.lit(1)).alias("n"))
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    small = sizes.join(found, "blob", "left").select("blob", "n", F.coalesce("hits", none).alias("findings"))
    return skew_safe_lookup(paths, small, "blob", "n", versions.count())


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def report(docs: DataFrame, folder: str | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, one row per row of ``docs``.

    Counts and ``base_sha256`` cover the base rules, ``spans`` all rules. ``folder`` is the ledger, by default a new one below the
    shared folder. Null text counts as empty, repeated rows are reported each, other columns are ignored.
    """
    folder = folder or scratch_path(docs.sparkSession, "secret-ledger")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scan(texts, folder, rules)
    names = [r.kind for r in BASE]
    of = lambda kind: F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("findings", lambda f: f["kind"].isin(names))
    return findings(texts, folder, rules).select(
        "kept.doc_id", *map(of, names), F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("findings")).alias("spans"))

"""Removal of repeated passages by blockwise suffix sorting with a difference cover.

A byte goes if a WINDOW-byte string that covers it also starts anywhere else in the corpus. Two suffixes share such a
string exactly if they are neighbours, with a common prefix of WINDOW bytes, in the sorted order of all suffixes. The order is
built one bucket at a time:

1. The bucket of a suffix is the least hash among the GRAM-byte strings in its first WINDOW bytes (its anchor), so equal prefixes
   share a bucket. Neighbouring suffixes mostly have the same anchor; a run of them is a *stretch*, described by position,
   length and content hash. Buckets with one stretch cannot hold a repeat and are left out.
2. Stretches of equal content are one class: its suffixes repeat if it occurs twice. Only where a bucket has several classes
   must their suffixes be sorted; then one stretch of each class brings its bytes to the bucket.
3. Within a bucket suffixes are ordered by their first COVER bytes. Longer ties are resolved by ranks, computed before, of the suffixes
   at positions of a difference cover (9 of 64): both suffixes reach such a position after the same number of bytes, fewer than
   COVER, and there the rank of the next WINDOW - COVER bytes decides. Positions count from the anchor, which equal prefixes
   share. Memory is that of one bucket's stretches, not of full prefixes.

A bucket with more than BUCKET classes is not sorted in one task: each of its suffixes becomes a row with a 128-bit hash of
its prefix, and repeats are counted by an ordinary aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import batch_map
from leadlake.session import scratch_path

WINDOW = 400
GRAM = 48
COVER = 64
# Every difference modulo COVER occurs between two of these residues.
RESIDUES = (1, 2, 3, 6, 15, 17, 35, 43, 60)
# Most classes of a bucket that one task sorts; bytes of stretches sorted at a time; suffixes hashed at a time.
BUCKET = 2048
BATCH = 1 << 19
PIECE = 1 << 18
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD)

STRETCH = "did long, tkey long, s long, more array<long>, n int, a int, h long, c long"


@cache
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64."""
    up = np.full(size, base, dtype=np.uint64)
    down = np.full(size, pow(base, -1, 1 << 64), dtype=np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _prefix(data: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of a polynomial hash, and the inverse powers that normalise it."""
    up, down = _powers(base, PIECE + 2 * WINDOW)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return sums, down


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return x ^ (x >> np.uint64(29))


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(x) - width + 1
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def stretches(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stretches of a text piece: first suffix, number of suffixes, anchor (from the first), bucket and content hash."""
    sums, down = _prefix(data, _BASES[0])
    grams = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[:len(data) - GRAM + 1])
    order = (grams & ~np.uint64(0xFFFFFFFF)) | np.arange(len(grams), dtype=np.uint64)  # of equal hashes the first
    anchor = (_sliding_min(order, WINDOW - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    count = np.diff(np.r_[first, len(anchor)])
    sums, down = _prefix(data, _BASES[1])
    content = _mixed((sums[first + count + WINDOW - 1] - sums[first]) * down[first])
    return first, count, anchor[first] - first, grams[anchor[first]].view(np.int64), content.view(np.int64)


def _pieces(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The text in pieces of PIECE suffixes; a piece has the bytes that its last prefixes need."""
    data = np.frombuffer(text, np.uint8)
    for base in range(0, max(0, len(data) - WINDOW + 1), PIECE):
        yield base, data[base:base + PIECE + WINDOW - 1]


def text_stretches(text: bytes) -> list[tuple]:
    """``(s, more, n, a, h, c)`` for the stretch classes of one text; ``more`` lists further starts of the same class."""
    starts: dict[tuple, list[int]] = {}
    for base, data in _pieces(text):
        first, count, anchor, bucket, content = stretches(data)
        for s, *same in zip((first + base).tolist(), count.tolist(), anchor.tolist(), bucket.tolist(), content.tolist()):
            starts.setdefault(tuple(same), []).append(s)
    return [(s[0], s[1:] or None, *same) for same, s in starts.items()]


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return pc.fill_null(batch.column("text"), "").cast(pa.binary()).to_pylist()


def _find_stretches(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("did", pa.int64()), ("tkey", pa.int64()), ("s", pa.int64()), ("more", pa.list_(pa.int64())),
                        ("n", pa.int32()), ("a", pa.int32()), ("h", pa.int64()), ("c", pa.int64())])
    rows: list[tuple] = []
    for did, tkey, text in zip(batch.column("did").to_pylist(), batch.column("tkey").to_pylist(), _texts(batch)):
        rows += [(did, tkey, *stretch) for stretch in text_stretches(text)]
        if len(rows) > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _ranked(codes: np.ndarray) -> tuple[np.ndarray, int]:
    values, rank = np.unique(codes, return_inverse=True)
    return rank.astype(np.int64).ravel(), len(values)


def repeated_suffixes(data: list[bytes], anchors: np.ndarray) -> list[np.ndarray]:
    """For each stretch (its bytes and anchor offset) of whole buckets: which of its suffixes equal another for WINDOW bytes."""
    size = np.array([len(d) for d in data])
    offset = np.cumsum(size) - size
    text = np.frombuffer(b"".join(data) + bytes(2 * WINDOW), np.uint8)
    total = int(size.sum())
    # ranks of the first 8, 16, 32 and COVER bytes from each position
    words = np.zeros(total + WINDOW, dtype=np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | text[k:k + len(words)].astype(np.uint64)
    rank, kinds = _ranked(words)
    length = 8
    while length < COVER:
        ahead = np.r_[rank[length:], np.zeros(length, dtype=np.int64)]
        rank, kinds = _ranked(rank * kinds + ahead)
        length *= 2
    owner = np.repeat(np.arange(len(data)), size)
    place = np.arange(total) - offset[owner]
    residue = (place - anchors[owner]) % COVER
    # ranks of the next WINDOW - COVER bytes at the positions of the difference cover
    covered = np.isin(residue, RESIDUES) & (place + WINDOW - COVER <= size[owner])
    at = np.flatnonzero(covered)
    depth = WINDOW - COVER
    sample, number = rank[at], kinds
    for shift in [*range(COVER, depth - COVER, COVER), depth - COVER]:
        sample, number = _ranked(sample * kinds + rank[at + shift])
    cover_rank = np.full(total, -1, dtype=np.int64)
    cover_rank[at] = sample
    # the suffixes themselves, sorted by first bytes, then by cover rank, then by what the cover rank leaves
    suffix = np.flatnonzero(place + WINDOW <= size[owner])
    ahead = np.array([min((r - x) % COVER for r in RESIDUES) for x in range(COVER)])
    keys = (rank[suffix + WINDOW - COVER], cover_rank[suffix + ahead[residue[suffix]]], residue[suffix], rank[suffix])
    order = np.lexsort(keys)
    same = np.ones(max(0, len(order) - 1), dtype=bool)
    for key in keys:
        same &= key[order][1:] == key[order][:-1]
    repeated = np.zeros(total, dtype=bool)
    repeated[suffix[order[1:][same]]] = True
    repeated[suffix[order[:-1][same]]] = True
    return [repeated[o:o + s - WINDOW + 1] for o, s in zip(offset.tolist(), size.tolist())]


def _runs(flags: np.ndarray) -> tuple[list[int], list[int]]:
    edges = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return edges[::2].tolist(), edges[1::2].tolist()


CLASS_SPANS = "h long, c long, n int, starts array<int>, ends array<int>"
_SPAN_SCHEMA = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("n", pa.int32()), ("starts", pa.list_(pa.int32())),
                          ("ends", pa.list_(pa.int32()))])


def _sort_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort bucket after bucket; rows come ordered by bucket, then class. Small buckets are sorted together."""
    def handle(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        found = []
        flags = repeated_suffixes([r[4] for r in rows], np.array([r[3] for r in rows]))
        for (h, c, n, *_), flag in zip(rows, flags):
            if flag.any():
                found.append((h, c, n, *_runs(flag)))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*found), _SPAN_SCHEMA)],
                                             schema=_SPAN_SCHEMA)

    ready: list[tuple] = []  # whole buckets
    bucket: list[tuple] = []
    weight = 0
    for batch in batches:
        for row in zip(*(batch.column(k).to_pylist() for k in ("h", "c", "n", "a", "data"))):
            if bucket and row[0] != bucket[-1][0]:
                ready += bucket
                bucket = []
                if weight > BATCH:
                    yield from handle(ready)
                    ready, weight = [], 0
            if not bucket or row[:3] != bucket[-1][:3]:  # a repeated row of documents brings its stretch twice
                bucket.append(row)
                weight += len(row[4])
    if ready or bucket:
        yield from handle(ready + bucket)


def _hash_suffixes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """One row per suffix with a 128-bit hash of its prefix, for buckets too large for one task."""
    for h, c, n, data in zip(*(batch.column(k).to_pylist() for k in ("h", "c", "n", "data"))):
        values = []
        for base in _BASES:
            sums, down = _prefix(np.frombuffer(data, np.uint8), base)
            values.append(pa.array(_mixed((sums[WINDOW:] - sums[:-WINDOW]) * down[:n]).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, h)), pa.array(np.full(n, c)), pa.array(np.full(n, n, np.int32)),
             pa.array(np.arange(n, dtype=np.int32)), *values], ["h", "c", "n", "i", "w1", "w2"])


def _removed(flagged: list[dict] | None, size: int) -> list[tuple[int, int]]:
    """Maximal byte runs covered by flagged prefixes."""
    if not flagged:
        return []
    begin, end = [], []
    for f in flagged:
        for s in (f["s"], *(f["more"] or ())):
            begin += [s + a for a in f["starts"]]
            end += [s + b + WINDOW - 1 for b in f["ends"]]
    begin, end = np.array(begin), np.array(end)
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    fresh = np.r_[True, begin[1:] > end[:-1]]
    return list(zip(begin[fresh].tolist(), end[np.r_[np.flatnonzero(fresh)[1:] - 1, len(end) - 1]].tolist()))


def _stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it, so that its lineage ends there."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def flagged_stretches(texts: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(did, tkey, flagged)``: for each text of ``texts`` (``did``, ``tkey``, ``text``) with repeats its stretches and, in each, the
    runs of suffixes that repeat. A text's list is bounded by its own length."""
    found = _stored(batch_map(texts, _find_stretches, STRETCH), "stretches")
    shared = found.groupBy("h").agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("more").isNotNull()).alias("_more")).filter(
        F.col("_more") | (F.col("_n") > 1)).select("h")
    # Repeated rows have equal stretches; these count, but are listed once.
    same = [c for c in found.columns if c != "more"]
    candidates = _stored(found.join(shared, "h", "left_semi").groupBy(*same).agg(
        F.first("more").alias("more"), F.count(F.lit(1)).alias("copies")), "candidates")
    classes = _stored(candidates.groupBy("h", "c", "n", "a").agg(
        F.sum(F.col("copies") * (1 + F.coalesce(F.size("more"), F.lit(0)))).alias("times"), F.min(F.struct("did", "tkey", "s")).alias("one")),
        "classes")
    several = classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    asked = classes.join(several, "h").select("one.did", "one.tkey", F.struct(
        "one.s", "n", "a", "h", "c", "times", "kinds").alias("want")).groupBy("did", "tkey").agg(
        F.collect_list("want").alias("wants"))

    def bring(batch: pa.RecordBatch):
        wants = batch.column("wants").to_pylist()
        rows = [(w["h"], w["c"], w["n"], w["a"], w["times"], w["kinds"], t[w["s"]:w["s"] + w["n"] + WINDOW - 1])
                for t, ws in zip(_texts(batch), wants) if ws for w in ws]
        types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)],
                                             ["h", "c", "n", "a", "times", "kinds", "data"])

    # a left join, so that this side of documents is shuffled just as in the last join of remove_repeats, and only once
    brought = batch_map(texts.join(asked, ["did", "tkey"], "left").select("text", "wants"), bring,
                        "h long, c long, n int, a int, times long, kinds long, data binary")
    largest = several.agg(F.max("kinds")).first()[0] or 0
    small = brought if largest <= bucket else brought.filter(F.col("kinds") <= bucket)
    sorted_spans = small.repartition("h").sortWithinPartitions("h", "c", "n").select("h", "c", "n", "a", "data").mapInArrow(
        _sort_buckets, CLASS_SPANS)
    if largest > bucket:
        large = _stored(batch_map(brought.filter(F.col("kinds") > bucket).dropDuplicates(["h", "c", "n"]), _hash_suffixes,
                                  "h long, c long, n int, i int, w1 long, w2 long"), "suffixes")
        twice = large.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
        counted = large.join(twice, ["w1", "w2"], "left_semi").groupBy("h", "c", "n").agg(
            F.array_sort(F.collect_list("i")).alias("starts")).withColumn(
            "ends", F.transform("starts", lambda i: i + 1))
        sorted_spans = sorted_spans.unionByName(counted)
    whole = classes.filter("times > 1").select("h", "c", "n", F.array(F.lit(0)).alias("starts"), F.array("n").alias("ends"))
    alone = sorted_spans.join(classes.filter("times = 1").select("h", "c", "n"), ["h", "c", "n"], "left_semi")
    spans = whole.unionByName(alone)
    return candidates.join(spans, ["h", "c", "n"]).groupBy("did", "tkey").agg(
        F.collect_list(F.struct("s", "more", "starts", "ends")).alias("flagged"))


def remove_repeats(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``(doc_id, kept, n_bytes, n_removed, n_spans)``: each text without its repeated bytes (``kept`` is binary).

    Works on the UTF-8 bytes of ``text``; matches never cross documents. Null and empty texts, and those shorter than WINDOW, stay
    as they are. Rows that repeat are documents of their own, so both lose what they share. Other columns are ignored.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("did"),
        F.xxhash64(F.col("doc_id").isNull(), "text").alias("tkey"), F.col("text").cast("string").alias("text"))

    def run(batch: pa.RecordBatch):
        kept, sizes, spans = [], [], []
        for text, flagged in zip(_texts(batch), batch.column("flagged").to_pylist()):
            gone = _removed(flagged, len(text))
            edges = [0, *(e for span in gone for e in span), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            sizes.append(len(text))
            spans.append(len(gone))
        size = np.array(sizes, dtype=np.int64)
        left = np.array([len(k) for k in kept], dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(kept, pa.binary()), pa.array(size), pa.array(size - left),
             pa.array(np.array(spans, dtype=np.int64))], ["doc_id", "kept", "n_bytes", "n_removed", "n_spans"])

    flagged = flagged_stretches(texts, bucket)
    return batch_map(texts.join(flagged, ["did", "tkey"], "left").select("doc_id", "text", "flagged"), run,
                     "doc_id long, kept binary, n_bytes long, n_removed long, n_spans long")


def report(docs: DataFrame) -> DataFrame:
    """``remove_repeats`` with a SHA-256 (lowercase hex) in place of the remaining bytes."""
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

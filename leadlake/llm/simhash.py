"""Near-duplicate documents by SimHash with a generalised pigeonhole search.

The 64 bits are grouped into partitions of correlated bits. With thresholds t_i whose sum is ``distance - parts + 1``, two
fingerprints within ``distance`` bits differ in at most t_i bits of some partition i (a threshold of -1 skips it). A
dynamic program picks the thresholds with the fewest estimated candidates; estimates come from a bounded sample and
only steer the cost. Two values within t bits agree once the same t bits are masked, so each fingerprint
enters one bucket per choice of t masked bits, and all pairs of a bucket are verified by their bit distance.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.blocks import block_groups, map_pairs, spanning_labels
from leadlake.llm.common import batch_map, packed, unpacked, utf8
from leadlake.operators.components import connected_components
from leadlake.session import cut_lineage

SHINGLE = 4
DISTANCE = 4
SEED = 42
# Fingerprints sampled to choose partitions and thresholds.
SAMPLE = 4096
# Cost of one bucket row (shuffled and sorted) in compared pairs.
ROW_COST = 150
# Shingles whose bits are counted at a time.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of the bytes of a text; a bit is set if over half of the shingles set it. No words: zero."""
    words = text.lower().split()  # bytes: only A-Z change, only the six white space characters cut
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1][: max(1, len(words) - shingle + 1)].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[at:at + CHUNK], stops[at:at + CHUNK])],
                          dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, *carried: str) -> DataFrame:
    """``(doc_id, fp, *carried)`` for every row; ``fp`` holds the 64 bits as a signed long, ``carried`` names columns of longs."""
    def run(batch: pa.RecordBatch):
        prints = np.array([fingerprint(t, shingle) for t in batch.column("text").to_pylist()], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64)), *map(batch.column, carried)],
                                         ["doc_id", "fp", *carried])

    doc_id = F.col("doc_id").cast("long")
    schema = ", ".join(f"{c} long" for c in ("doc_id", "fp", *carried))
    return batch_map(docs.select(doc_id.alias("doc_id"), utf8().alias("text"), *carried), run, schema)


def correlated_parts(bits: np.ndarray, parts: int) -> list[list[int]]:
    """Deal the 64 bit positions into equal groups, each grown from its most correlated bits."""
    spread = bits.any(axis=0) & ~bits.all(axis=0)
    related = np.zeros((64, 64))
    if spread.sum() > 1:
        related[np.ix_(spread, spread)] = np.abs(np.corrcoef(bits[:, spread], rowvar=False))
    np.fill_diagonal(related, 0)
    free, groups = set(range(64)), []
    for size in (64 // parts + (k < 64 % parts) for k in range(parts)):
        seed = max(sorted(free), key=lambda b: related[b, sorted(free)].sum())
        group = [seed]
        while len(group) < size:
            group.append(max(sorted(free - set(group)), key=lambda b: related[b, group].sum()))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def allocate(sample: np.ndarray, total: int, distance: int = DISTANCE) -> tuple[list[list[int]], list[int]]:
    """Partitions and thresholds with the least estimated cost for ``total`` fingerprints.

    For each number of partitions a dynamic program over (partition, thresholds spent) minimises rows and candidates.
    """
    total = max(total, 1)
    bits = ((sample[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int8)
    pairs_per_sample_pair = (total / max(len(sample), 1)) ** 2
    best: tuple[float, list[list[int]], list[int]] | None = None
    for parts in range(1, distance + 2):
        groups = correlated_parts(bits, parts)
        spend = distance - parts + 1
        cost = []
        for group in groups:
            mask = np.uint64(sum(1 << b for b in group))
            counts = np.zeros(spend + 2)
            for at in range(0, len(sample), 512):
                apart = np.bitwise_count((sample[at:at + 512, None] ^ sample[None, :]) & mask)
                counts += np.bincount(np.minimum(apart, spend + 1).ravel(), minlength=spend + 2)
            counts[0] -= len(sample)
            # random values of this width, so that rare coincidences that a sample misses count too
            random_pairs = len(sample) ** 2 * np.array([comb(len(group), t) for t in range(spend + 1)]) / 2.0 ** len(group)
            near = np.maximum(np.cumsum(counts[:spend + 1]), np.cumsum(random_pairs)) / 2
            cost.append([0.0, *(near[t] * pairs_per_sample_pair + ROW_COST * total * comb(len(group), t)
                                for t in range(spend + 1))])  # index 0 is threshold -1
        table = {0: (0.0, [])}  # sum of (threshold + 1) so far: cost and thresholds
        for options in cost:
            grown: dict[int, tuple[float, list[int]]] = {}
            for spent, (value, chosen) in table.items():
                for t, more in enumerate(options):
                    key = spent + t
                    if key <= spend + parts and (key not in grown or value + more < grown[key][0]):
                        grown[key] = (value + more, [*chosen, t - 1])
            table = grown
        value, chosen = table[spend + parts]
        if best is None or value < best[0]:
            best = (value, groups, chosen)
    return best[1], best[2]


def bucket_masks(groups: list[list[int]], thresholds: list[int]) -> list[int]:
    """For each bucket family the bits that must agree: a partition without ``threshold`` of its bits."""
    masks = []
    for group, threshold in zip(groups, thresholds):
        if threshold >= 0:
            for free in combinations(group, threshold):
                masks.append(sum(1 << b for b in group if b not in free))
    return masks


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def linked_prints(prints: DataFrame, total: int, distance: int = DISTANCE) -> DataFrame:
    """Edges ``(src, dst)`` that connect the same fingerprints as all links of ``distance`` bits or fewer do.

    ``prints`` holds ``total`` distinct values in ``fp`` and is stored.
    """
    chosen = prints.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()  # at most SAMPLE values
    sample = np.array([r.fp for r in chosen], dtype=np.int64).view(np.uint64)
    masks = bucket_masks(*allocate(sample, total, distance))
    buckets = F.array(*(F.struct(F.lit(k).alias("tag"), F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("key"))
                        for k, m in enumerate(masks)))
    rows = prints.select("fp", F.explode(buckets).alias("b")).select("b.tag", "b.key", "fp")

    def links(rows: pa.Table, i: np.ndarray, j: np.ndarray) -> pa.Table:
        fp = rows.column("fp").to_numpy()
        near = np.bitwise_count((fp[i] ^ fp[j]).view(np.uint64)) <= distance
        label = spanning_labels(len(fp), i[near], j[near])
        at = np.flatnonzero(label != np.arange(len(fp)))
        return pa.table({"src": fp[at], "dst": fp[label[at]]})

    return map_pairs(block_groups(rows, "fp"), links, "src long, dst long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs`` (columns ``doc_id``, ``text``; others are ignored).

    ``component_id`` is the smallest ``doc_id`` reachable over fingerprints at ``distance`` bits or fewer. Null and empty
    texts have fingerprint zero and link like any other. A row without ``doc_id`` takes part in links and gets the
    smallest id of its component (null if it has none). Repeated rows stay repeated. Only one row
    per distinct fingerprint is compared, so copies cost nothing.
    """
    return _labelled(docs, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _labelled(docs: DataFrame, shingle: int, distance: int, *carried: str) -> DataFrame:
    """``(doc_id, fp, *carried, component, component_id)``; ``component`` is one of the component's fingerprints."""
    rows = cut_lineage(fingerprints(docs, shingle, *carried))
    classes = cut_lineage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    total = classes.count()
    labels = connected_components(linked_prints(classes.select("fp"), total, distance)).select(
        F.col("id").alias("fp"), "component")
    member = classes.join(labels, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    member = cut_lineage(member)
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    named = member.join(lowest, "component").select("fp", "component", "component_id")
    return rows.join(named, "fp")


def keep_representatives(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """``docs`` with all columns, but of each component only the document whose ``doc_id`` names it.

    Of a component's rows that repeat this ``doc_id`` the first by text stays; a ``doc_id`` with unrelated texts may name several
    components and stays once in each. Rows without ``doc_id`` cannot name a component and all stay.
    """
    digest = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))  # tells texts of one doc_id apart
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", digest.alias("digest"))
    labels = _labelled(texts, shingle, distance, "digest")
    names = labels.filter(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("name"), F.col("digest").alias("of"), "component").distinct()
    first = Window.partitionBy("component").orderBy(F.col("text").asc_nulls_first())
    rows = docs.select(packed(docs), F.col("doc_id").cast("long").alias("id"), "text", digest.alias("digest"))
    chosen = rows.join(names, (F.col("id") == F.col("name")) & (F.col("digest") == F.col("of")))
    single = chosen.withColumn("place", F.row_number().over(first)).filter("place = 1").select("kept")
    return single.unionByName(rows.filter(F.col("id").isNull()).select("kept")).select(*unpacked(docs))

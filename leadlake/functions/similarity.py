"""Token-sort similarity and the block keys that make its self-join cheap and lossless.

The similarity of two strings is 100 * (1 - d / (len1 + len2)), where d counts the insertions and deletions
that turn one into the other, d = len1 + len2 - 2 * LCS. It is applied to strings whose words are sorted.

A pair scores at least t exactly when d <= D = floor((1 - t/100) * (len1 + len2)); d also has the parity of the length
difference. Cut the shorter string into floor(D/2) + 1 segments: D edits cannot put two into each of them, so one segment has
at most one edit. Then this segment and the part of the longer string that it became have a *deletion variant* in common:
both are equal after at most one character is taken out of each. The variant, with the number of segments and the place and
length of this one, is a join key that loses no pair, and it is nearly twice as long as a segment that would have to
be unchanged (D + 1 segments), so that few pairs share one by chance. The first segment from the left that has at most
one edit more than twice its number before it will do, which bounds how far its part can be shifted. Longer strings use
unchanged segments, rounded positions and no lengths.

Keys, signatures and similarities are computed for whole Arrow batches: strings of one length are a matrix of code points.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Executors need not have this package: its functions travel inside the UDF.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Above this length of the shorter string keys are unchanged segments that drop the lengths and round the position, which
# keeps the number of keys linear in the length.
EXACT_LENGTH_LIMIT = 24
# Numbers held at a time, about: keys of a batch, or code points compared.
HELD = 1 << 22


def _grid(m: int) -> int:
    """Width of a position bucket for a shorter string of m characters."""
    return 1 << max(0, m.bit_length() - 4)


def _memo(fn):
    """Cache per argument tuple, in a form that can be pickled."""
    seen: dict = {}

    def cached(*args):
        if args not in seen:
            seen[args] = fn(*args)
        return seen[args]

    return cached


def edit_budget(shorter: Column, longer: Column, threshold: float) -> Column:
    """Most insertions plus deletions a pair of these lengths may have, with the parity of their difference."""
    most = F.floor((shorter + longer) * F.lit(round(1 - threshold / 100, 10)) + F.lit(1e-9)).cast("int")
    return most - F.pmod(most - (longer - shorter), F.lit(2))


def _budget(m: int, n: int, share: float) -> int:
    """Edit budget for lengths m <= n, lowered to the parity of n - m; negative when no pair can match."""
    d = int((m + n) * share + 1e-9)
    return d - (d - (n - m)) % 2 if d >= n - m else -1


def _cuts(m: int, parts: int) -> list[tuple[int, int]]:
    """(start, length) of an even partition of m characters."""
    short, longer = divmod(m, parts)
    bounds = [i * short + max(0, i - (parts - longer)) for i in range(parts + 1)]
    return [(bounds[i], bounds[i + 1] - bounds[i]) for i in range(parts)]


@_memo
def _longest_partner(m: int, share: float) -> int:
    n = m
    while _budget(m, n + 1, share) >= 0 or _budget(m, n + 2, share) >= 0:
        n += 1
    return n


@_memo
def _largest_budget(m: int, share: float) -> int:
    return max(_budget(m, n, share) for n in range(m, _longest_partner(m, share) + 1))


def _short_plan(m: int, share: float) -> set[tuple]:
    """What a string of length m emits as the shorter one: ``(tag, start, size, without)``. A key is the text of ``size`` characters from
    ``start``, less the one at offset ``without`` if that is not negative, together with the tag."""
    if m <= EXACT_LENGTH_LIMIT:
        budgets = {_budget(m, n, share) for n in range(m, _longest_partner(m, share) + 1)} - {-1}
        return {
            (((d // 2 + 1), k, size, size - (x >= 0)), start, size, x)
            for d in budgets
            for k, (start, size) in enumerate(_cuts(m, d // 2 + 1))
            for x in range(-1, size if d else 0)
        }
    grid = _grid(m)
    return {
        ((0, grid, bucket, size), start, size, -1)
        for i, (start, size) in enumerate(_cuts(m, _largest_budget(m, share) + 1))
        for bucket in range(max(0, start - i) // grid, (start + i) // grid + 1)
    }


def _parts(d: int, delta: int, k: int, last: bool) -> Iterator[tuple[int, int, int]]:
    """Ways in which segment ``k`` can have at most one edit: shift of its part, characters that it loses, and that it gains."""
    for before, inside in ((2 * k, 0), (2 * k, 1), (2 * k + 1, 0)):
        if before + inside > d or (k == 0 and before):
            continue
        for shift in range(-before, before + 1):
            for lost, gained in ((0, 0),) if not inside else ((1, 0), (0, 1), (1, 1)):
                if abs(delta - shift - gained + lost) <= (0 if last else d - before - inside):
                    yield shift, lost, gained


def _long_plan(n: int, share: float) -> set[tuple]:
    """What a string of length n emits as the longer one."""
    partners = [m for m in range(1, n + 1) if _longest_partner(m, share) >= n and _budget(m, n, share) >= 0]
    plan = set()
    for m in partners:
        if m <= EXACT_LENGTH_LIMIT:
            d = _budget(m, n, share)
            cuts = _cuts(m, d // 2 + 1)
            for k, (start, size) in enumerate(cuts):
                for shift, lost, gained in _parts(d, n - m, k, k == len(cuts) - 1):
                    begin, width = start + shift, size - lost + gained
                    if begin >= 0 and begin + width <= n:
                        tag = (len(cuts), k, size, size - lost)
                        plan |= {(tag, begin, width, x) for x in (range(width) if gained else (-1,))}
    shapes = {
        (_grid(m), size)
        for m in partners if m > EXACT_LENGTH_LIMIT
        for _, size in _cuts(m, _largest_budget(m, share) + 1)
    }
    return plan | {((0, grid, place // grid, size), place, size, -1) for grid, size in shapes for place in range(n - size + 1)}


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 bits that depend on all bits of each number (the finalizer of SplitMix64, fixed values)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _weights(n: int) -> np.ndarray:
    """An odd factor for each place of a text."""
    return _mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)


class KeyTable:
    """Keys of all strings of one length: sums of code points times the factor of their place, plus the hash of the tag.

    Unchanged parts are taken from one moving sum per size; parts without a character from one product of matrices.
    """

    def __init__(self, length: int, share: float, role: str):
        plan = sorted((_short_plan if role == "short" else _long_plan)(length, share))
        whole = [e for e in plan if e[3] < 0]
        cut = [e for e in plan if e[3] >= 0]
        self.seeds = np.array([self._seed(e[0]) for e in whole + cut], np.uint64)
        self.whole = {size: np.array([e[1] for e in whole if e[2] == size]) for size in sorted({e[2] for e in whole})}
        self.order = [i for size in self.whole for i, e in enumerate(whole) if e[2] == size]
        self.product = np.zeros((length, len(cut)), np.uint64)
        for column, (_, start, size, without) in enumerate(cut):
            rest = [start + x for x in range(size) if x != without]
            self.product[rest, column] = _weights(len(rest))
        self.size = len(plan)

    @staticmethod
    def _seed(tag: tuple) -> int:
        seed = np.zeros(1, np.uint64)
        for number in tag:
            seed = _mixed(seed * np.uint64(31) + np.uint64(number + 1))
        return int(seed[0])

    def keys(self, codes: np.ndarray) -> np.ndarray:
        """A row of keys for each row of code points; repeated ones are all but the first set to 0, which is no key."""
        codes = codes.astype(np.uint64) + np.uint64(1)
        out = np.zeros((len(codes), self.size), np.uint64)
        at = 0
        for size, starts in self.whole.items():
            moving = np.lib.stride_tricks.sliding_window_view(codes, size, axis=1) @ _weights(size)
            out[:, self.order[at:at + len(starts)]] = moving[:, starts]
            at += len(starts)
        out[:, at:] = codes @ self.product
        out = np.sort(_mixed(out + self.seeds), axis=1)
        out[:, 1:][out[:, 1:] == out[:, :-1]] = 0
        return out


def _code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of all strings (no nulls) in a row, and start and length of each."""
    length = pc.utf8_length(texts).to_numpy().astype(np.int64)
    data = pc.binary_join(pa.scalar(texts.to_pylist(), pa.list_(texts.type)), "").as_py() if len(texts) else ""
    return np.frombuffer(data.encode("utf-32-le"), np.uint32), np.cumsum(length) - length, length


def _signatures(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes), np.int64)
    for kind in range(21):
        counts = np.minimum((codes % 21 == kind).sum(axis=1), 3)
        out |= ((1 << counts) - 1) << (3 * kind)
    return out


def signature_of(text: str) -> int:
    """63 bits: for each of 21 character classes three bits that say count >= 1, >= 2, >= 3. One insertion or
    deletion changes one count by one and so flips at most one bit."""
    return int(_signatures(_code_points(pa.array([text], pa.string()))[0][None, :])[0])


def batch_keys(texts: pa.Array, share: float, role: str, tables: dict[int, KeyTable]) -> tuple[pa.Array, np.ndarray]:
    """Keys and signature of each string of an array without nulls; ``tables`` keeps the tables by length."""
    flat, start, length = _code_points(texts)
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # rows, keys in a row each, keys of all rows
    signature = np.zeros(len(texts), np.int64)
    for n in np.unique(length).tolist():
        rows = np.flatnonzero(length == n)
        if n not in tables:
            tables[n] = KeyTable(n, share, role)
        step = max(1, HELD // max(tables[n].size, n))
        for part in (rows[i:i + step] for i in range(0, len(rows), step)):
            codes = flat[start[part][:, None] + np.arange(n)]
            signature[part] = _signatures(codes)
            keys = tables[n].keys(codes)
            real = keys != 0
            found.append((part, real.sum(axis=1), keys[real].view(np.int64)))
    counts = np.zeros(len(texts), np.int64)
    for part, n_keys, _ in found:
        counts[part] = n_keys
    offsets = np.r_[0, np.cumsum(counts)]
    values = np.zeros(offsets[-1], np.int64)
    for part, n_keys, keys in found:
        values[np.repeat(offsets[part] - (np.cumsum(n_keys) - n_keys), n_keys) + np.arange(len(keys))] = keys
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)), signature


def keys_of(text: str, share: float, role: str) -> list[int]:
    """Join keys of one string as the ``short`` or ``long`` side."""
    return batch_keys(pa.array([text], pa.string()), share, role, {})[0][0].as_py()


def with_block_keys(nodes: DataFrame, threshold: float, role: str) -> DataFrame:
    """Adds ``keys`` and the bit ``signature`` of ``text``."""
    share = round(1 - threshold / 100, 10)
    names = nodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, KeyTable] = {}
        for batch in batches:
            keys, signature = batch_keys(batch.column("text"), share, role, tables)
            yield pa.RecordBatch.from_arrays([*batch.columns, keys, pa.array(signature)], names=[*names, "keys", "signature"])

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in nodes.schema)
    return nodes.mapInArrow(run, f"{columns}, keys array<bigint>, signature bigint")


# ------------------------------------------------------------------------------------------- similarity

# Characters in a machine word: 56 bits, so that a carry stays in the word until it is passed on.
LIMB = 56
# Pairs compared at a time.
PAIRS = 2048


def lcs_lengths(left: pa.Array, right: pa.Array) -> np.ndarray:
    """Length of the longest common subsequence of each pair of strings (Hyyrö 2004), bit-parallel in the characters of the longer
    string and side by side over pairs of similar length."""
    (a, a_start, a_length), (b, b_start, b_length) = _code_points(left), _code_points(right)
    top = max(a.max(initial=0), b.max(initial=0))
    kind = np.uint8 if top < 254 else np.uint32
    a_end, b_end = np.iinfo(kind).max, np.iinfo(kind).max - 1  # neither occurs, and they differ
    a, b = (np.append(x.astype(kind), np.array([end], kind)) for x, end in ((a, a_end), (b, b_end)))
    full = np.uint64((1 << LIMB) - 1)
    out = np.zeros(len(left), np.int64)
    order = np.lexsort((b_length, a_length))
    for rows in (order[i:i + PAIRS] for i in range(0, len(order), PAIRS)):
        limbs = max(1, -(-int(a_length[rows].max()) // LIMB))
        rows_at_once = max(1, HELD // (64 * limbs))
        for part in (rows[i:i + rows_at_once] for i in range(0, len(rows), rows_at_once)):
            place = np.arange(64)[None, :] + LIMB * np.arange(limbs)[:, None]
            inside = (place[None] < a_length[part][:, None, None]) & (np.arange(64) < LIMB)
            text = a[np.where(inside, a_start[part][:, None, None] + place, len(a) - 1)]
            row = np.full((len(part), limbs), full)
            for j in range(int(b_length[part].max())):
                letter = b[np.where(j < b_length[part], b_start[part] + j, len(b) - 1)]
                mask = np.packbits(text == letter[:, None, None], axis=2, bitorder="little").view(np.uint64)[:, :, 0]
                hit = row & mask
                kept, carry = row & ~hit, np.zeros(len(part), np.uint64)
                for limb in range(limbs):
                    total = row[:, limb] + hit[:, limb] + carry
                    carry = total >> np.uint64(LIMB)
                    row[:, limb] = (total & full) | kept[:, limb]
            out[part] = limbs * LIMB - np.bitwise_count(row).sum(axis=1).astype(np.int64)
    return out


def lcs_length(a: str, b: str) -> int:
    """Length of the longest common subsequence of two strings."""
    return int(lcs_lengths(pa.array([a], pa.string()), pa.array([b], pa.string()))[0])


def similarity(a: Column | str, b: Column | str) -> Column:
    """Similarity 0..100 of two strings (no nulls) whose words are already sorted."""

    @F.arrow_udf(T.DoubleType())
    def ratio(left: pa.Array, right: pa.Array) -> pa.Array:
        total = (pc.utf8_length(left).to_numpy() + pc.utf8_length(right).to_numpy()).astype(np.int64)
        safe = np.maximum(total, 1)
        return pa.array((1.0 - (total - 2 * lcs_lengths(left, right)) / safe) * 100.0)

    columns = [F.col(c) if isinstance(c, str) else c for c in (a, b)]
    # Declared non-deterministic, so that the optimizer does not repeat it inside filters that it infers or pushes down, even
    # below a distinct.
    return ratio.asNondeterministic()(*columns)

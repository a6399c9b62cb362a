"""Fill-in-the-middle transformation: a document is cut into prefix, middle and suffix, and the parts change places.

The text lies in one bytearray. Its line ends are scanned for the two cuts, a sentinel is inserted before each part, and
neighbouring blocks change places by three reversals (reverse each block, then both together), which needs no second copy of the
text. ``restore`` finds the sentinels, runs the inverse rotation and takes the sentinels out, so the text comes back byte for byte.

- psm: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
- spm: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
- plain: the text as it is; for empty texts, texts that hold a sentinel, and the share that is not transformed
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import batch_map, packed, sub_batches, utf8

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
# Percent of the documents that are transformed, and percent of these that take the form spm.
RATE, SPM_RATE = 100, 50
# Bytes that a reversal holds beside the buffer.
STEP = 1 << 16
# Bytes of text in a batch that a task sends back.
BATCH = 16 << 20


def reverse(buffer: np.ndarray, start: int, end: int) -> None:
    """Reverse ``buffer[start:end]`` in place; both ends meet in steps of bounded size."""
    while end - start > 1:
        n = min(STEP, (end - start) // 2)
        head = buffer[start:start + n].copy()
        buffer[start:start + n] = buffer[end - n:end][::-1]
        buffer[end - n:end] = head[::-1]
        start, end = start + n, end - n


def rotate(buffer: np.ndarray, start: int, cut: int, end: int) -> None:
    """Exchange the blocks ``[start, cut)`` and ``[cut, end)`` in place."""
    reverse(buffer, start, cut)
    reverse(buffer, cut, end)
    reverse(buffer, start, end)


def line_ends(text: bytes | bytearray) -> np.ndarray:
    """End of each line, the last of which may lack its line feed."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.r_[ends, len(text)] if len(text) and not text.endswith(b"\n") else ends


def arrange(text: bytes, cuts: tuple[int, int], form: str) -> bytearray:
    """The text in ``form``, cut at two byte offsets."""
    if form == PLAIN:
        return bytearray(text)
    first, second = cuts
    out = bytearray(text)
    out[second:second] = SUFFIX
    out[first:first] = MIDDLE
    out[0:0] = PREFIX
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(np.frombuffer(out, np.uint8), middle if form == PSM else 0, suffix, len(out))
    return out


def rebuild(output: bytes, form: str) -> bytearray:
    """The text that ``arrange`` was given, from its output and the form."""
    out = bytearray(output)
    if form == PLAIN:
        return out
    middle = out.index(MIDDLE)
    if form == PSM:  # P S M to P M S
        suffix = out.index(SUFFIX)
        rotate(np.frombuffer(out, np.uint8), suffix, middle, len(out))
    else:  # S P M to P M S
        rotate(np.frombuffer(out, np.uint8), 0, out.index(PREFIX), len(out))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):  # each occurs once: the text has none, and none can arise across a joint
        at = out.index(sentinel)
        del out[at:at + len(sentinel)]
    return out


def code_points(text: bytes | bytearray | memoryview) -> int:
    return int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80))


def _draws(seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers drawn from ``doc_id`` (null draws like an empty id)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


SCHEMA = "kept {kept}, n long, form string, prefix_chars long, middle_chars long, output binary"


def transform(docs: DataFrame, seed: int = 7, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """The columns of ``docs`` but ``text`` as struct ``kept``, ``n`` (lines), ``form``, ``prefix_chars``, ``middle_chars``
    and ``output`` (UTF-8).

    Units are lines. The cuts are drawn from ``seed`` and ``doc_id``, so equal rows give equal results and rows without id draw
    alike. A null text counts as empty; empty texts and texts with a sentinel are plain, where the two lengths are null.
    """
    sent = docs.select(packed(docs.drop("text")), utf8().alias("text"), *_draws(seed))
    kept = sent.schema["kept"].dataType

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in sub_batches(batch, "text", BATCH):
            rows: list[tuple] = []
            drawn = zip(*(part.column(c).to_pylist() for c in ("text", "h1", "h2", "h3", "h4")))
            for text, h1, h2, h3, h4 in drawn:
                ends = np.r_[0, line_ends(text)]
                n = len(ends) - 1
                if not text or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)) or h3 % 100 >= rate:
                    rows.append((n, PLAIN, None, None, text))
                    continue
                units = sorted((h1 % (n + 1), h2 % (n + 1)))
                first, second = int(ends[units[0]]), int(ends[units[1]])
                form = SPM if h4 % 100 < spm_rate else PSM
                view = memoryview(text)
                rows.append((n, form, code_points(view[:first]), code_points(view[first:second]),
                             bytes(arrange(text, (first, second), form))))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column("kept"), *columns], names=[
                "kept", "n", "form", "prefix_chars", "middle_chars", "output"])

    return batch_map(sent, fn, SCHEMA.format(kept=kept.simpleString()))


def restore(transformed: DataFrame) -> DataFrame:
    """Adds ``restored`` (UTF-8), made from ``output`` and ``form`` alone."""
    columns = transformed.columns

    def fn(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for part in sub_batches(batch, "output", BATCH):
            pairs = zip(part.column("output").to_pylist(), part.column("form").to_pylist())
            texts = pa.array([bytes(rebuild(output, form)) for output, form in pairs], pa.binary())
            yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*columns, "restored"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in transformed.schema)
    return batch_map(transformed, fn, f"{schema}, restored binary")


def report(docs: DataFrame) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256)``, one row per row of ``docs``.

    Repeated rows are reported each; other columns are ignored; an empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return restore(transform(texts)).select(
        "kept.doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))

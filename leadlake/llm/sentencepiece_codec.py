"""SentencePiece encoding and decoding with a streaming Viterbi search.

The best segmentation is the one with the highest sum of piece scores, as in unigram inference; of equal sums the piece that begins
first wins. The search reads a text once, left to right. It keeps scores for the last ``longest piece`` positions only, because no
piece reaches further back, and backpointers since the last commit. As soon as the best paths of all these positions
run through one boundary, nothing to come can change what lies before it, and the ids up to there are committed.

If no piece of the vocabulary has a space after another character (the usual case), all paths converge in front of
each space that follows a word. Then a text is a row of independent words, and a bounded memory of words saves most searches.

The vocabulary file is read on the driver; its pieces (tens of thousands, bounded by the file) go along with the tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlake.llm.common import batch_map, sub_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# A character without a piece costs this much more than the worst piece, and becomes its UTF-8 bytes.
UNKNOWN_PENALTY = 10.0
# Positions between two looks for a common boundary, and words remembered by a worker.
LOOK = 64
MEMORY = 200_000
# Words up to this length are solved whole and remembered, longer ones go through the streaming search.
LONGEST_WORD = 48
BATCH_BYTES = 1 << 21


@dataclass(frozen=True)
class Vocabulary:
    """Pieces that texts can match (with plain spaces), their ids and scores; ids of the 256 bytes; bytes of every id."""

    pieces: tuple[str, ...]
    ids: tuple[int, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]
    id_bytes: tuple[bytes, ...]


def load(path: str = MODEL) -> Vocabulary:
    """Read a SentencePiece model file. It must have byte pieces; control and unknown pieces match nothing."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces, ids, scores, byte_ids, id_bytes = [], [], [], {}, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
            id_bytes.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            id_bytes.append(b"")
        else:
            plain = piece.replace("▁", " ")
            pieces.append(plain)
            ids.append(i)
            scores.append(model.get_score(i))
            id_bytes.append(plain.encode())
    if len(byte_ids) != 256:
        raise ValueError(f"{path} has no pieces for single bytes")
    return Vocabulary(tuple(pieces), tuple(ids), tuple(scores), tuple(byte_ids[b] for b in range(256)), tuple(id_bytes))


class Encoder:
    """Viterbi search over one vocabulary."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = vocabulary
        self.matcher = ahocorasick.Automaton()
        for piece, number, score in zip(vocabulary.pieces, vocabulary.ids, vocabulary.scores):
            self.matcher.add_word(piece, (len(piece), number, score))
        self.matcher.make_automaton()
        self.longest = max(map(len, vocabulary.pieces))
        self.single = {p for p in vocabulary.pieces if len(p) == 1}
        self.unknown = min(vocabulary.scores) - UNKNOWN_PENALTY
        self.by_word = not any(re.search("[^ ] ", p) for p in vocabulary.pieces)
        # control characters that no piece contains stand alone on every path
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in vocabulary.pieces))
        self.cut = re.compile(f" *[^ {alone}]+| +" + (f"|[{alone}]" if alone else "")).findall
        self.words: dict[str, tuple[int, ...]] = {}

    def _ids(self, text: str, number: int) -> Iterable[int]:
        """Ids of a step: its piece, or the bytes of a character without one."""
        return (number,) if number >= 0 else (self.vocabulary.byte_ids[b] for b in text.encode("utf-8", "surrogatepass"))

    def search(self, text: str) -> Iterator[int]:
        """Ids of the best segmentation, yielded as soon as they are certain."""
        keep = self.longest
        best = [0.0] * (keep + 1)  # score of the position modulo keep + 1
        back: dict[int, tuple[int, int]] = {}  # position -> where its last piece begins, and its id (-1: unknown)
        done = 0
        found = self.matcher.iter(text)
        upcoming = next(found, None)
        for end in range(1, len(text) + 1):
            top, origin, chosen = -np.inf, -1, -1
            steps = []
            while upcoming is not None and upcoming[0] == end - 1:
                steps.append(upcoming[1])
                upcoming = next(found, None)
            if len(steps) > 1:
                steps.sort(reverse=True)  # longest first: of equal sums the earliest beginning wins
            for length, number, score in steps:
                total = best[(end - length) % (keep + 1)] + score
                if total > top:
                    top, origin, chosen = total, end - length, number
            if text[end - 1] not in self.single:
                total = best[(end - 1) % (keep + 1)] + self.unknown
                if total > top:
                    top, origin, chosen = total, end - 1, -1
            best[end % (keep + 1)] = top
            back[end] = (origin, chosen)
            if end % LOOK == 0:
                common = self._common(back, range(max(done, end - keep + 1), end + 1), done)
                if common > done:
                    yield from self._commit(text, back, done, common)
                    done = common
        if text:
            yield from self._commit(text, back, done, len(text))

    @staticmethod
    def _common(back: dict[int, tuple[int, int]], survivors: Iterable[int], done: int) -> int:
        """The last boundary that the best paths of all survivors share."""
        open_ = set(survivors)
        while len(open_) > 1:
            last = max(open_)
            open_.remove(last)
            open_.add(back[last][0] if last > done else done)
        return open_.pop()

    def _commit(self, text: str, back: dict[int, tuple[int, int]], done: int, end: int) -> list[int]:
        path = []
        at = end
        while at > done:
            origin, number = back[at]
            path.append((origin, at, number))
            at = origin
        for position in range(done + 1, end + 1):
            del back[position]
        return [i for a, b, number in reversed(path) for i in self._ids(text[a:b], number)]

    def _word(self, word: str) -> tuple[int, ...]:
        """The search for a short text whose characters all have pieces: nothing is committed before its end."""
        best = [0.0] + [-np.inf] * len(word)
        origin, piece = [0] * len(best), [0] * len(best)
        for last, (length, number, score) in self.matcher.iter(word):  # of equal ends the longest first
            total = best[last + 1 - length] + score
            if total > best[last + 1]:
                best[last + 1], origin[last + 1], piece[last + 1] = total, last + 1 - length, number
        out, at = [], len(word)
        while at:
            out.append(piece[at])
            at = origin[at]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        """Ids of a text with a space put in front; an empty text has none."""
        if not text:
            return []
        text = " " + text
        if not self.by_word:
            return list(self.search(text))
        out: list[int] = []
        words = self.words
        for word in self.cut(text):
            ids = words.get(word)
            if ids is None:
                if len(word) > LONGEST_WORD:
                    out.extend(self.search(word))
                    continue
                ids = self._word(word) if self.single.issuperset(word) else tuple(self.search(word))
                if len(words) >= MEMORY:
                    words.clear()
                words[word] = ids
            out += ids
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids, without the space in front. Bytes that are no UTF-8 become replacement characters."""
        return b"".join(map(self.vocabulary.id_bytes.__getitem__, ids)).decode("utf-8", "replace")[1:]


_ENCODERS: dict[Vocabulary, Encoder] = {}


def encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder for a vocabulary, kept between tasks."""
    if vocabulary not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[vocabulary] = Encoder(vocabulary)
    return _ENCODERS[vocabulary]


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``(doc_id, n_tokens, token_ids, round_trip)``, one row per document (columns ``doc_id``, ``text``; others are ignored).

    ``round_trip`` tells whether decoding the ids gives the text again. Null counts as empty: no ids, and the round trip holds.
    Literal U+2581 characters are encoded as bytes, so they come back as they were. Repeated rows are encoded each.
    """
    vocabulary = load(model)

    def run(batch: pa.RecordBatch):
        codec = encoder(vocabulary)
        filled = pa.RecordBatch.from_arrays([batch.column("doc_id"), pc.fill_null(batch.column("text"), "")], ["doc_id", "text"])
        for part in sub_batches(filled, "text", BATCH_BYTES):
            counts, flat, same = [], [], []
            for text in part.column("text").to_pylist():
                ids = codec.encode(text)
                counts.append(len(ids))
                flat.append(np.array(ids, dtype=np.int32))
                same.append(codec.decode(ids) == text)
            offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(flat))), pa.array(same)],
                ["doc_id", "n_tokens", "token_ids", "round_trip"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return batch_map(rows, run, "doc_id long, n_tokens long, token_ids array<int>, round_trip boolean")


def decode_documents(rows: DataFrame, model: str = MODEL) -> DataFrame:
    """``(doc_id, text)`` from ``doc_id`` and ``token_ids``; null ids give an empty text."""
    vocabulary = load(model)

    def run(batch: pa.RecordBatch):
        codec = encoder(vocabulary)
        texts = [codec.decode(ids or ()) for ids in batch.column("token_ids").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return batch_map(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("token_ids").cast("array<int>").alias(
        "token_ids")), run, "doc_id long, text string")

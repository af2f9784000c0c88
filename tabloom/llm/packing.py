"""Packing of token ids into sequences: dynamic programming over cut positions.

Rows keep their order inside each partition of the input. Their ids, each row closed by
an end id, form one stream per partition; a sequence is a stretch of it of at most `LENGTH` ids. Cuts are
free at the end of a row, cost SENTENCE_CUT behind the end of a sentence and WORD_CUT elsewhere,
which is offered only in stretches without any other place to cut. A sequence is padded to LENGTH, or not at all at a
power of two. The best cuts minimise padding plus cut costs:

    cost[j] = cut[j] + min(cost[i] + pad(at[j] - at[i]))   over at[j] - LENGTH <= at[i] < at[j]

As pad is LENGTH - at[j] + at[i], the minimum is that of cost[i] + at[i] over a sliding window,
kept in a queue of increasing values. The partition is read as a stream: the program runs over about RUN ids at a time, its
sequences but the last are handed out, and the rest is carried over.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Callable, Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from tabloom.llm.arrow import in_arrow, slices

LENGTH = 2048
END_ID = 1
SENTENCE_CUT, WORD_CUT = 4, 64
WORD_STEP = 64  # distance of the cuts offered in long stretches without a sentence end
POWERS = 3  # the largest powers of two below LENGTH are tried as whole sequences
RUN = 1 << 18
MAX_KNOWN_WORDS = 300_000
PIECE_BYTES = 1 << 19  # texts are encoded in slices of about this size

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)

# What a byte is to the encoder: other, a letter, punctuation, a blank that ends a word.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2
_KIND[[ord(" "), ord("\n")]] = 3


def _byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes each byte: itself if it prints, else a letter from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in prints]
    return {**{b: chr(b) for b in prints}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class WordEncoder:
    """Ids of texts through a bounded memory of known words.

    The vocabulary splits at white space and between a letter and other printable ASCII before
    anything else, so the ids of a text are those of its pieces in a row, and each
    distinct piece is encoded once. A text that holds a special string of the vocabulary is encoded as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = _byte_letters()
        self.sentence_ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for mark in (".", "!", "?", "!!", "...", "\u3002"):
            self.sentence_ends[self.tokenizer.encode(mark, add_special_tokens=False).ids[-1:]] = True
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.begin, self.sizes = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def _plain(self, word: bytes) -> str | None:
        """The word as the model spells it, if splitting and normalizing would leave it as it is."""
        if word.isalpha() and word.islower():
            return word.decode()
        text = word.decode()
        if text.isalpha() and text.lower() == text and "\u03c2" not in text and is_normalized("NFC", text):
            return "".join(map(self.letters.__getitem__, word))
        return None

    def _learn(self, words: list[bytes]) -> None:
        spelled = [self._plain(w) for w in words]
        rest = [w.decode() for w, s in zip(words, spelled, strict=True) if s is None]
        slow = iter(self.tokenizer.encode_batch_fast(rest, add_special_tokens=False))
        tokenize = self.tokenizer.model.tokenize
        found = [next(slow).ids if s is None else [t.id for t in tokenize(s)] for s in spelled]
        first, slots = len(self.known), len(self.known) + len(words)
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        new = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        while len(self.ids) < self.used + len(new):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while len(self.begin) < slots:
            self.begin, self.sizes = (np.concatenate([x, np.zeros_like(x)]) for x in (self.begin, self.sizes))
        self.ids[self.used : self.used + len(new)] = new
        self.begin[first:slots] = self.used + np.cumsum(sizes) - sizes
        self.sizes[first:slots] = sizes
        self.used += len(new)
        self.known.update(zip(words, range(first, slots), strict=True))

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text."""
        whole = pa.array(np.zeros(len(texts), bool))
        for mark in self.special:
            whole = pc.or_(whole, pc.fill_null(pc.match_substring(texts, mark), False))
        if not pc.any(whole).as_py():
            yield from self._encode_pieces(texts)
            return
        rest = self._encode_pieces(pc.if_else(whole, "", texts))
        for text, alone, ids in zip(texts, whole.to_pylist(), rest, strict=True):
            yield np.array(self.tokenizer.encode(text.as_py(), add_special_tokens=False).ids, np.uint32) if alone else ids

    def _encode_pieces(self, texts: pa.Array) -> Iterator[np.ndarray]:
        flat = pc.fill_null(texts, "").cast(pa.binary())
        bounds = np.frombuffer(flat.buffers()[1], np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
        data = np.frombuffer(flat.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        low = _LOWER[data]
        kind = _KIND[low]
        held = kind != 3
        fresh = np.ones(len(low), bool)  # a piece starts here
        fresh[1:] = (kind[:-1] == 3) | ((kind[1:] == 2) & (kind[:-1] == 1))
        fresh[bounds[:-1][bounds[:-1] < len(low)]] = True
        fresh &= held
        kept = np.cumsum(held)
        offsets = np.append(kept[fresh] - 1, kept[-1] if len(kept) else 0).astype(np.int32)
        text_of = np.concatenate([[0], np.cumsum(fresh)])[bounds]
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(low[held]))]
        pieces = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers).dictionary_encode()
        words = pieces.dictionary.to_pylist()
        if len(self.known) > MAX_KNOWN_WORDS:
            self._forget()
        unknown = [w for w in words if w not in self.known]
        if unknown:
            self._learn(unknown)
        slots = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))[pieces.indices.to_numpy()]
        sizes = self.sizes[slots]
        ends = np.cumsum(sizes)
        ids = self.ids[np.repeat(self.begin[slots] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[text_of]
        for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
            yield ids[start:stop]


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def cut_places(ids: np.ndarray, sentence_end: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in one row where it may be cut, the last at its end, and what a cut costs there."""
    ends = np.flatnonzero(sentence_end[ids[:-1]]) + 1
    places = np.append(ends, len(ids))
    costs = np.full(len(places), float(SENTENCE_CUT))
    costs[-1] = 0.0
    step = min(WORD_STEP, length)
    gaps = np.diff(places, prepend=0)
    long = np.flatnonzero(gaps > step)
    if len(long):
        extra = np.concatenate([np.arange(places[k] - gaps[k] + step, places[k], step) for k in long])
        places = np.concatenate([places, extra])
        costs = np.concatenate([costs, np.full(len(extra), float(WORD_CUT))])
        order = np.argsort(places, kind="stable")
        places, costs = places[order], costs[order]
    if len(places) > 1 and places[-2] == places[-1]:
        places, costs = np.delete(places, -2), np.delete(costs, -2)
    return places, costs


def best_cuts(at: list[int], costs: list[float], length: int = LENGTH) -> tuple[list[int], float]:
    """Indices of the chosen places, the last place included, and their cost.

    `at` increases, in steps of at most `length`; the stream starts at 0.
    """
    at, costs = [0, *at], [0.0, *costs]
    index = {p: i for i, p in enumerate(at)}
    powers = [1 << k for k in range(length.bit_length() - 1)][-POWERS:]
    total, came_from = [0.0] * len(at), [0] * len(at)
    queue: deque[int] = deque([0])
    for j in range(1, len(at)):
        here = at[j]
        while at[queue[0]] < here - length:
            queue.popleft()
        i = queue[0]
        best = total[i] + at[i] + length - here
        if best > 0:
            for power in powers:
                k = index.get(here - power)
                if k is not None and total[k] < best:
                    best, i = total[k], k
        total[j], came_from[j] = best + costs[j], i
        value = total[j] + here
        while queue and total[queue[-1]] + at[queue[-1]] >= value:
            queue.pop()
        queue.append(j)
    chosen, j = [], len(at) - 1
    while j:
        chosen.append(j - 1)
        j = came_from[j]
    return chosen[::-1], total[-1]


class _Stream:
    """Rows waiting to be packed: ids, where they start in their row, places to cut."""

    def __init__(self, partition: int, length: int):
        self.partition, self.length, self.sequences = partition, length, 0
        self.rows: list[tuple[int | None, int, int, np.ndarray]] = []  # id, start, tokens of the row, ids
        self.at: list[int] = []
        self.costs: list[float] = []
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray, sentence_end: np.ndarray) -> None:
        places, costs = cut_places(ids, sentence_end, self.length)
        self.at.extend((places + self.size).tolist())
        self.costs.extend(costs.tolist())
        self.rows.append((doc_id, 0, len(ids), ids))
        self.size += len(ids)

    def pack(self, last: bool) -> list[tuple]:
        """Pieces of all sequences but the last, which is carried over unless the stream ends."""
        chosen, _ = best_cuts(self.at, self.costs, self.length)
        if not last:
            chosen = chosen[:-1]
        out, row, offset_in_row, done = [], 0, 0, 0
        for c in chosen:
            offset = 0
            while done < self.at[c]:
                doc_id, start, tokens, ids = self.rows[row]
                n = min(len(ids) - offset_in_row, self.at[c] - done)
                piece = ids[offset_in_row : offset_in_row + n]
                out.append(
                    (doc_id, start + offset_in_row, n, zlib.crc32(piece.astype("<u4").tobytes()), tokens,
                     (self.partition << 40) + self.sequences, offset)
                )
                offset, offset_in_row, done = offset + n, offset_in_row + n, done + n
                if offset_in_row == len(ids):
                    row, offset_in_row = row + 1, 0
            self.sequences += 1
        self.rows = self.rows[row:]
        if self.rows and offset_in_row:
            doc_id, start, tokens, ids = self.rows[0]
            self.rows[0] = (doc_id, start + offset_in_row, tokens, ids[offset_in_row:])
        k = chosen[-1] + 1 if chosen else 0
        self.at, self.costs, self.size = [p - done for p in self.at[k:]], self.costs[k:], self.size - done
        return out


def _table(pieces: list[tuple]) -> pa.RecordBatch:
    names = [part.split()[0] for part in PIECES.split(", ")]
    columns = list(zip(*pieces, strict=True)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in columns], names)


def _packer(path: str, length: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, stream = _encoder(path), None
        for batch in batches:
            for part in slices(batch, 1, PIECE_BYTES):
                stream = stream or _Stream(part.column(2)[0].as_py(), length)
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode(part.column(1)), strict=True):
                    stream.add(doc_id, np.append(ids, np.uint32(END_ID)), encoder.sentence_ends)
                    if stream.size >= RUN:
                        yield _table(stream.pack(last=False))
        if stream:
            yield _table(stream.pack(last=True))

    return pack


def pack_documents(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None, length: int = LENGTH
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    `vocabulary` is the path of the tokenizer file, which every executor must have. A null or empty text is its end
    id alone; a row without an id is packed with a null id; repeated rows are packed each. No shuffle: each partition of
    the input is packed by itself, in memory of about RUN ids and its longest text, and ends with
    one sequence that may be short. An empty table gives an empty result.
    """
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.spark_partition_id().alias("part")
    )
    return rows.transform(in_arrow, _packer(path, length), PIECES)

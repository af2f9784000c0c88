"""Repeated byte strings of documents, by merged Burrows-Wheeler transforms.

A byte goes if a string of SPAN bytes that covers it also starts in a document with a smaller id. Strings are judged
on the input and never cross documents.

1. Documents are written as chunks of some MB. Each string of SPAN bytes (a window) is known by the least hash among
   its strings of GRAM bytes, its key; equal windows have equal keys. Neighbouring windows with one key form a segment.
   About one byte in sixteen begins one.
2. Keys alone are dealt out by hash, once for each chunk. Those that several chunks or documents have come
   back as marks. A key with more than HOT contexts is marked as hot.
3. Segments with marked keys are dealt out by key; windows of a hot key one by one, by their own
   hash. So all equal windows meet in one group, and no group is large. Equal segments of a chunk travel once.
4. The distinct segments of a group are cut into shards. Each shard's suffixes are sorted alone, which gives its Burrows-Wheeler
   transform. The transforms are merged by refining their interleave: a pass over the merged transform
   that deals its positions out by the two symbols before them turns an order by h symbols into one by h + 2.
   Positions are in one block while their first h symbols agree. After SPAN symbols the blocks are the
   repeated intervals, and suffixes of different shards were never compared.
5. The least id of a block is the owner of its windows. It returns to the chunks; windows of later documents go.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from tabloom.llm.arrow import in_arrow, slices
from tabloom.llm.common import written

SPAN, GRAM = 50, 20
LONG_GRAM = 34
GRAMS = SPAN - GRAM + 1  # strings of GRAM bytes in a window, and windows of a segment at most
CHUNK_BYTES = 4 << 20
SLICE_BYTES = 1 << 20  # bytes that are hashed at a time
SENT_BYTES = 32 << 20  # segment bytes that a task gathers before it sends them
GROUP_BYTES = 24 << 20  # bytes that meet in one group, about
MERGE_BYTES = 1 << 19  # bytes that are merged at a time
SHARD_BYTES = 1 << 16
HOT = 1 << 13
STEP = 2  # symbols by which a pass refines the order
LAST = np.iinfo(np.int64).max

_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93], np.uint64)


def _words(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as one number; 8 zero bytes follow the data."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded.data, strides=(1,))


def _hash_at(words: np.ndarray, at: np.ndarray | slice, size: int, seed: int = 0) -> np.ndarray:
    """Hashes of the `size` bytes (8 or more) from positions `at` on; a slice has the positions of a stretch."""
    offsets = [*range(0, size - 7, 8)] + ([size - 8] if size % 8 else [])
    total: np.ndarray | None = None
    with np.errstate(over="ignore"):
        for i, o in enumerate(offsets):
            part = words[at.start + o : at.stop + o] if isinstance(at, slice) else words[at + o]
            total = part + np.uint64(seed) if total is None else total + part
            total *= _FACTORS[i % 2]
            total ^= total >> np.uint64(29)
        total *= _FACTORS[2]
    total ^= total >> np.uint64(32)
    return total


def _least(hashes: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbouring hashes."""
    have = 1
    while have < width:
        step = min(have, width - have)
        hashes = np.minimum(hashes[:-step], hashes[step:])
        have += step
    return hashes


class Chunk:
    """Some documents in a row: their bytes, ends and ids (None: no id)."""

    def __init__(self, data: np.ndarray, ends: np.ndarray, ids: list[int | None]) -> None:
        self.data, self.ends = data, ends
        self.starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
        self.known = np.array([i is not None for i in ids], bool)
        self.ids = np.array([i or 0 for i in ids], np.int64)
        self.words = _words(data)
        self._segments()

    def _segments(self) -> None:
        """`begin`, `windows`, `key` and `doc` of all segments of documents with an id."""
        begins, sizes, keys = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
        for low in range(0, len(self.data) - SPAN + 1, SLICE_BYTES):
            high = min(low + SLICE_BYTES, len(self.data) - SPAN + 1)
            least = _least(_hash_at(self.words, slice(low, high + GRAMS - 1), GRAM), GRAMS)
            opens = np.ones(high - low, bool)
            opens[1:] = least[1:] != least[:-1]
            # A window must end within its document.
            for cuts in (self.starts, self.ends - SPAN + 1):
                cuts = cuts[(cuts > low) & (cuts < high)]
                opens[cuts - low] = True
            begin = np.flatnonzero(opens)
            begins.append(begin + low)
            sizes.append(np.diff(np.append(begin, high - low)))
            keys.append(least[begin])
        begin, windows, key = np.concatenate(begins), np.concatenate(sizes), np.concatenate(keys)
        parts = -(-windows // GRAMS)
        if (parts > 1).any():
            number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
            begin, key = np.repeat(begin, parts) + number * GRAMS, np.repeat(key, parts)
            windows = np.minimum(np.repeat(windows, parts) - number * GRAMS, GRAMS)
        doc = np.searchsorted(self.ends, begin, "right")
        doc = np.minimum(doc, max(len(self.ends) - 1, 0))
        good = (begin + SPAN <= self.ends[doc]) & self.known[doc] if len(self.ends) else np.zeros(len(begin), bool)
        self.begin, self.windows, self.key, self.doc = begin[good], windows[good], key[good], doc[good]

    def keys(self, groups: int) -> tuple[np.ndarray, ...]:
        """(key, group, contexts, shared) of the distinct keys, by group, then key."""
        key, first, inverse, count = np.unique(self.key, return_index=True, return_inverse=True, return_counts=True)
        owner = self.ids[self.doc]
        shared = np.zeros(len(key), bool)
        shared[inverse[owner != owner[first][inverse]]] = True
        contexts = np.minimum(count, 1)
        several = np.flatnonzero(count[inverse] > 1)
        if len(several):
            sample, _ = _distinct(self.words, self.begin[several], self.windows[several])
            contexts = np.maximum(contexts, np.bincount(inverse[several[sample]], minlength=len(key)))
        group = (key % np.uint64(groups)).astype(np.int64)
        order = np.lexsort((key, group))
        return key[order], group[order], contexts[order], shared[order]

    def keep(self, marks: np.ndarray, groups: int) -> None:
        """Leaves only segments with marked keys, those of hot keys window by window.

        Adds `sample`, one segment for each distinct text, and `member`, the number of each segment's text among them.
        """
        key, _, _, _ = self.keys(groups)
        order = np.argsort(key)
        mark = marks[order][np.searchsorted(key[order], self.key)]
        plain, hot = mark == 1, np.flatnonzero(mark == 2)
        times = self.windows[hot]
        begin = np.repeat(self.begin[hot], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        alone = _hash_at(self.words, begin, SPAN)
        doc = np.repeat(self.doc[hot], times)
        self.key = np.concatenate([self.key[plain], alone])
        self.begin = np.concatenate([self.begin[plain], begin])
        self.windows = np.concatenate([self.windows[plain], np.ones(len(begin), np.int64)])
        self.doc = np.concatenate([self.doc[plain], doc])
        self.sample, self.member = _distinct(self.words, self.begin, self.windows)


def _distinct(words: np.ndarray, begin: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One index for each distinct segment text, and the number of each segment's text; texts are compared, not hashes."""
    last = begin + windows - 1
    offsets = [*range(0, SPAN - 7, 8), SPAN - 8]
    seed = 0
    while True:
        with np.errstate(over="ignore"):
            name = (_hash_at(words, begin, SPAN, seed) * _FACTORS[3]) ^ _hash_at(words, last, SPAN, seed) ^ windows.astype(np.uint64) * _FACTORS[1]
        _, sample, member = np.unique(name, return_index=True, return_inverse=True)
        like = sample[member]
        same = windows == windows[like]
        for at, other in ((begin, begin[like]), (last, last[like])):
            for o in offsets:
                same &= words[at + o] == words[other + o]
        if same.all():
            return sample, member
        seed += 1


def _packed(*columns: np.ndarray) -> bytes:
    """Columns as one compressed string: their sizes, then all first bytes of a column, all second ones, ..."""
    sizes = np.array([len(c) for c in columns], np.int64).tobytes()
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(len(c), c.dtype.itemsize).T.tobytes() if len(c) else b"" for c in columns]
    return zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(planes))


def _unpacked(blob: bytes, *kinds: type) -> list[np.ndarray]:
    plain = zstandard.ZstdDecompressor().decompress(blob)
    sizes, at, columns = np.frombuffer(plain, np.int64, len(kinds)), 8 * len(kinds), []
    for size, kind in zip(sizes.tolist(), map(np.dtype, kinds), strict=True):
        planes = np.frombuffer(plain, np.uint8, size * kind.itemsize, at)
        columns.append(np.ascontiguousarray(planes.reshape(kind.itemsize, size).T).view(kind).reshape(size))
        at += size * kind.itemsize
    return columns


def _steps(numbers: np.ndarray) -> np.ndarray:
    return np.diff(numbers, prepend=numbers.dtype.type(0))


def _joined(columns: list[np.ndarray], kind: type) -> np.ndarray:
    return np.concatenate(columns) if columns else np.empty(0, kind)


_PACKED_ARROW = ["chunk", "ids", "ends", "data"]
_PACKED = "chunk long, ids array<long>, ends array<long>, data binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) rows as chunks."""
    number = TaskContext.get().partitionId() << 33
    ids, texts, size = [], [], 0

    def chunk() -> pa.RecordBatch:
        ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(texts))
        columns = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([ends], pa.list_(pa.int64())), pa.array([data], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, _PACKED_ARROW)

    for batch in batches:
        for piece in slices(batch, 1, SLICE_BYTES):
            for doc_id, text in zip(piece.column(0).to_pylist(), piece.column(1).cast(pa.binary()).to_pylist(), strict=True):
                text = text or b""
                if texts and size + len(text) > CHUNK_BYTES:
                    yield chunk()
                    number, ids, texts, size = number + 1, [], [], 0
                ids.append(doc_id)
                texts.append(text)
                size += len(text)
    if texts:
        yield chunk()


def _chunk(ids: list[int | None], ends: list[int], data: bytes) -> Chunk:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return Chunk(plain, np.array(ends, np.int64), ids)


def _chunks(batch: pa.RecordBatch) -> Iterator[tuple[int, Chunk, list]]:
    """(number, chunk, further columns) of each row."""
    for i in range(batch.num_rows):
        number, ids, ends, data, *rest = (c[i].as_py() for c in batch.columns)
        yield number, _chunk(ids, ends, data), rest


def _sent(held: list[tuple[np.ndarray, ...]], kinds: tuple[type, ...], pack) -> Iterator[pa.RecordBatch]:
    """(bucket, blob) rows of gathered columns; the first column is the group."""
    if not held:
        return
    group, *columns = (_joined([h[i] for h in held], kind) for i, kind in enumerate((np.int64, *kinds)))
    order = np.argsort(group, kind="stable")
    group = group[order]
    head = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(group))
    for low, high in zip(head[:-1], head[1:], strict=True):
        at = order[low:high]
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(group[low])]), pa.array([pack(*(c[at] for c in columns))], pa.binary())], ["bucket", "blob"]
        )


def _send_keys(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    def pack(key, chunk, contexts, shared) -> bytes:
        return _packed(_steps(chunk), key, contexts, shared)

    kinds, held, size = (np.uint32, np.int64, np.uint8, np.uint8), [], 0
    for batch in batches:
        for number, chunk, _ in _chunks(batch):
            key, group, contexts, shared = chunk.keys(groups)
            short = (key // np.uint64(groups)).astype(np.uint32)
            held.append((group, short, np.full(len(key), number), np.minimum(contexts, 255).astype(np.uint8), shared.astype(np.uint8)))
            size += 16 * len(key)
            if size > SENT_BYTES:
                yield from _sent(held, kinds, pack)
                held, size = [], 0
    yield from _sent(held, kinds, pack)


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[bytes]]]:
    """Blobs of each bucket of a sorted stream."""
    current, held = None, []
    for batch in batches:
        for bucket, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if bucket != current and held:
                yield current, held
                held = []
            current = bucket
            held.append(blob)
    if held:
        yield current, held


def _mark(batches: Iterator[pa.RecordBatch], hot: int) -> Iterator[pa.RecordBatch]:
    """(chunk, bucket, blob): marks of the keys of each chunk; 1: others have it, 2: in many contexts."""
    for bucket, blobs in _groups(batches):
        parts = [_unpacked(b, np.int64, np.uint32, np.uint8, np.uint8) for b in blobs]
        chunk = np.concatenate([np.cumsum(p[0]) for p in parts])
        key, contexts, shared = (np.concatenate([p[i] for p in parts]) for i in (1, 2, 3))
        _, member, count = np.unique(key, return_inverse=True, return_counts=True)
        several = (count > 1) | (np.bincount(member, shared) > 0)
        mark = np.where(several, np.where(np.bincount(member, contexts) > hot, 2, 1), 0).astype(np.uint8)[member]
        # A chunk's keys stay in the order in which it sent them.
        head = np.append(np.flatnonzero(np.diff(chunk, prepend=-1)), len(chunk))
        numbers, blobs = [], []
        for low, high in zip(head[:-1], head[1:], strict=True):
            numbers.append(int(chunk[low]))
            blobs.append(_packed(mark[low:high]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(numbers), pa.array([bucket] * len(numbers)), pa.array(blobs, pa.binary())], ["chunk", "bucket", "blob"]
        )


def _marked(chunk: Chunk, marks: list[dict], groups: int) -> Chunk:
    chunk.keep(_joined([_unpacked(m["blob"], np.uint8)[0] for m in marks or []], np.uint8), groups)
    return chunk


def _bytes_of(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of some stretches in a row."""
    at = np.repeat(begin - (np.cumsum(size) - size), size)
    return data[at + np.arange(len(at))]


def _send_segments(batches: Iterator[pa.RecordBatch], key_groups: int, groups: int) -> Iterator[pa.RecordBatch]:
    """Distinct segments of each chunk: chunk, number, least and greatest id, key, windows, bytes."""
    texts: list[np.ndarray] = []

    def pack(place, chunk, number, least, most, key, windows) -> bytes:
        size = windows.astype(np.int64) + SPAN - 1
        text = _bytes_of(gathered, place, size)
        return _packed(_steps(chunk), _steps(number), _steps(least), most - least, key, windows, text)

    kinds, held, size = (np.int64, np.int64, np.int32, np.int64, np.int64, np.uint16, np.uint8), [], 0
    for batch in batches:
        for name, chunk, (marks,) in _chunks(batch):
            _marked(chunk, marks, key_groups)
            count = len(chunk.sample)
            owner = chunk.ids[chunk.doc]
            least, most = np.full(count, LAST), np.full(count, -LAST)
            np.minimum.at(least, chunk.member, owner)
            np.maximum.at(most, chunk.member, owner)
            windows, key = chunk.windows[chunk.sample], chunk.key[chunk.sample]
            bytes_each = windows + SPAN - 1
            place = np.cumsum(bytes_each) - bytes_each + size
            texts.append(_bytes_of(chunk.data, chunk.begin[chunk.sample], bytes_each))
            size += len(texts[-1])
            short = (key // np.uint64(groups) & np.uint64(0xFFFF)).astype(np.uint16)
            group = (key % np.uint64(groups)).astype(np.int64)
            held.append((group, place, np.full(count, name), np.arange(count, dtype=np.int32), least, most, short, windows.astype(np.uint8)))
            if size > SENT_BYTES:
                gathered = np.concatenate(texts)
                yield from _sent(held, kinds, pack)
                texts, held, size = [], [], 0
    if held:
        gathered = np.concatenate(texts)
        yield from _sent(held, kinds, pack)


def _suffix_order(symbols: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """All suffixes of a shard in order; `rest` is the number of symbols up to the end mark, which is 0 and included."""
    n = len(symbols)
    packed = _words(symbols)[:n].byteswap()
    cut = (np.maximum(8 - rest, 0) * 8).astype(np.uint64)
    key = (packed >> cut) << cut
    # Only suffixes that share their rank with others are looked at again, by twice as many symbols.
    tied, rank, depth = np.argsort(key, kind="stable"), np.zeros(n, np.int64), 8
    key = key[tied]
    while True:
        opens = np.ones(len(tied), bool)
        opens[1:] = key[1:] != key[:-1]
        whole = np.ones(len(tied), bool)
        whole[1:] = rank[tied[1:]] != rank[tied[:-1]]
        index = np.arange(len(tied))
        head, first = (np.maximum.accumulate(np.where(f, index, 0)) for f in (opens, whole))
        rank[tied] += head - first
        tied = tied[~(opens & np.append(opens[1:], True))]
        if depth >= SPAN + GRAMS or not len(tied):
            return np.argsort(rank, kind="stable")
        after = np.zeros(len(tied), np.int64)
        inside = rest[tied] > depth
        after[inside] = rank[tied[inside] + depth] + 1
        key = rank[tied] * (n + 1) + after
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        depth *= 2


class Merged:
    """The merged order of the suffixes of several shards by their first SPAN symbols, from the shards' own transforms.

    `place` is the symbol at which each suffix begins, in merged order, and `block` numbers the intervals whose first SPAN symbols agree.
    """

    def __init__(self, symbols: np.ndarray, offset: np.ndarray, rest: np.ndarray, shards: np.ndarray) -> None:
        """`offset` and `rest` place each symbol in its text; `shards` are the bounds of shards, at ends of texts."""
        bounds = list(zip(shards[:-1].tolist(), shards[1:].tolist(), strict=True))
        order = np.concatenate([low + _suffix_order(symbols[low:high], rest[low:high]) for low, high in bounds])
        where = np.empty(len(order), np.int32)
        where[order] = np.arange(len(order), dtype=np.int32)
        # Of each suffix in the order of its shard: the symbols before it, and the suffix that begins with them.
        wide = symbols.astype(np.uint16)
        source = np.flatnonzero(offset[order] >= STEP)
        usable = np.zeros(len(order), bool)
        usable[source] = True
        before, leads = np.zeros(len(order), np.uint16), np.zeros(len(order), np.int32)
        at = order[source]
        before[source] = wide[at - 2] << np.uint16(8) | wide[at - 1]
        leads[source] = where[at - 2]
        # The last suffixes of a text have no suffix STEP symbols on.
        short = np.flatnonzero(rest <= STEP)
        first = where[short]
        first_symbols = np.where(rest[short] > 1, wide[short] << np.uint16(8), 0).astype(np.uint16)

        follower = np.full(len(order), len(order), np.int32)
        follower[leads[source]] = source

        merged, block = np.arange(len(order), dtype=np.int32), np.zeros(len(order), np.int32)
        # A suffix that is alone in its block has found its place; the others move within theirs. A suffix
        # leads while the one it is followed to moves; `seat` and `leads_here` have a last element for no suffix.
        slots, moving, leading = np.arange(len(order)), np.ones(len(order), bool), np.append(usable, False)
        seat, leads_here, open_first = np.arange(len(order) + 1), leading.copy(), np.ones(len(first), bool)
        for _ in range(0, SPAN, STEP):
            used = np.flatnonzero(leads_here)
            taken = merged[used]
            pair = np.concatenate([first_symbols[open_first], before[taken]])
            dealt = np.argsort(pair, kind="stable")
            moved = np.concatenate([first[open_first], leads[taken]])[dealt]
            pair = pair[dealt]
            came = np.concatenate([np.full(len(pair) - len(taken), -1, np.int32), block[used]])[dealt]
            opens = np.ones(len(dealt), bool)
            opens[1:] = (pair[1:] != pair[:-1]) | (came[1:] != came[:-1])
            merged[slots], seat[moved] = moved, slots
            block[slots] = slots[np.maximum.accumulate(np.where(opens, np.arange(len(slots)), 0))]
            leads_here[slots] = leading[moved]
            alone = opens & np.append(opens[1:], True)
            moving[moved[alone]] = False
            leader = follower[moved[alone]]
            leading[leader] = leads_here[seat[leader]] = False
            open_first = moving[first]
            slots = slots[~alone]
            if not len(slots):
                break
        self.place, self.block = order[merged], np.cumsum(np.diff(block, prepend=0) != 0)


def owners(data: np.ndarray, begin: np.ndarray, windows: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The least id that has each window of some segment texts, one text after the other."""
    size = windows + SPAN - 1
    ends = np.cumsum(size + 1)
    heads = ends - size - 1
    symbols = np.zeros(int(ends[-1]), np.uint8)
    within = np.ones(len(symbols), bool)
    within[ends - 1] = False
    # Zero marks the end of a text; 255 is no byte of UTF-8.
    text = _bytes_of(data, begin, size)
    symbols[within] = np.where(text == 0, 255, text)
    number = np.repeat(np.arange(len(size)), size + 1)
    offset = np.arange(len(symbols)) - heads[number]
    rest = ends[number] - np.arange(len(symbols))
    cuts = np.flatnonzero(np.diff(ends // SHARD_BYTES)) + 1
    shards = np.concatenate([[0], ends[cuts - 1] if len(cuts) else [], [ends[-1]]]).astype(np.int64)
    merged = Merged(symbols, offset, rest, np.unique(shards))
    window = offset[merged.place] < windows[number[merged.place]]
    claim = np.where(window, least[number[merged.place]], LAST)
    head = np.flatnonzero(np.diff(merged.block, prepend=-1))
    best = np.minimum.reduceat(claim, head)[merged.block]
    found = np.empty(len(symbols), np.int64)
    found[merged.place] = best
    return found[offset < windows[number]]


def _common(data: np.ndarray, begin: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """Whether some window of a text may be in another: their least strings of LONG_GRAM bytes are compared by hash."""
    size = windows + SPAN - 1
    words = _words(_bytes_of(data, begin, size))
    least = _least(_hash_at(words, slice(0, len(words) - LONG_GRAM), LONG_GRAM), SPAN - LONG_GRAM + 1)
    text = np.repeat(np.arange(len(size)), windows)
    value = least[_stretches(np.cumsum(size) - size, windows)]
    order = np.argsort(value, kind="stable")
    value, text = value[order], text[order]
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    # the sort is stable, so the texts of one value ascend
    ends = np.append(head[1:], len(value)) - 1
    shared = np.repeat(text[head] != text[ends], ends - head + 1)
    common = np.zeros(len(size), bool)
    common[text[shared]] = True
    return common


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, blob): for segments of each chunk, stretches of windows with their owner, where it is not the only one."""
    kinds = (np.int64, np.int32, np.int64, np.int64, np.uint16, np.uint8, np.uint8)
    for _, blobs in _groups(batches):
        parts = [_unpacked(b, *kinds) for b in blobs]
        chunk, number, least = (np.concatenate([np.cumsum(p[i]) for p in parts]) for i in range(3))
        most = np.concatenate([p[3] for p in parts]) + least
        key, windows, data = (np.concatenate([p[i] for p in parts]) for i in (4, 5, 6))
        del parts
        windows = windows.astype(np.int64)
        begin = np.cumsum(windows + SPAN - 1) - windows - SPAN + 1
        sample, member = _distinct(_words(data), begin, windows)
        first = np.full(len(sample), LAST)
        np.minimum.at(first, member, least)
        total = np.cumsum(windows[sample])
        owner = np.repeat(first, windows[sample])
        # Whole keys at a time, so that equal windows are merged together. A text without a long string that another has
        # owns its windows.
        order = np.flatnonzero(_common(data, begin[sample], windows[sample]))
        order = order[np.argsort(key[sample][order], kind="stable")]
        ordered = key[sample][order]
        ends = np.cumsum(windows[sample][order] + SPAN)
        heads = np.flatnonzero(np.diff(ordered.astype(np.int64), prepend=-1))
        lot = ends[np.append(heads[1:], len(order))[: len(heads)] - 1] // MERGE_BYTES
        cuts = np.append(heads[np.flatnonzero(np.diff(lot, prepend=-1))], len(order))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            text = order[low:high]
            found = owners(data, begin[sample[text]], windows[sample[text]], first[text])
            owner[_stretches(total[text] - windows[sample[text]], windows[sample[text]])] = found
        # Stretches of one owner within a text.
        text = np.repeat(np.arange(len(sample)), windows[sample])
        place = np.arange(len(owner)) - (total - windows[sample])[text]
        opens = (place == 0) | (np.diff(owner, prepend=-LAST) != 0)
        head = np.flatnonzero(opens)
        span = np.diff(np.append(head, len(owner)))
        stretch_text, stretch_place, stretch_owner = text[head], place[head], owner[head]
        from_ = np.searchsorted(stretch_text, np.arange(len(sample) + 1))
        times = (from_[1:] - from_[:-1])[member]
        which = np.repeat(np.arange(len(member)), times)
        at = _stretches(from_[:-1][member], times)
        useful = stretch_owner[at] < most[which]
        which, at = which[useful], at[useful]
        by_chunk = np.argsort(chunk[which], kind="stable")
        which, at = which[by_chunk], at[by_chunk]
        head = np.append(np.flatnonzero(np.diff(chunk[which], prepend=-1)), len(which))
        numbers, replies = [], []
        for low, high in zip(head[:-1], head[1:], strict=True):
            rows, some = which[low:high], at[low:high]
            numbers.append(int(chunk[rows[0]]))
            replies.append(_packed(_steps(number[rows].astype(np.int64)), stretch_place[some].astype(np.uint8), span[some].astype(np.uint8), _steps(stretch_owner[some])))
        yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(replies, pa.binary())], ["chunk", "blob"])


def _stretches(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All indices of [begin, begin + size), one stretch after the other."""
    return np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _remove(batches: Iterator[pa.RecordBatch], key_groups: int) -> Iterator[pa.RecordBatch]:
    """One row per document: id, bytes, removed bytes, spans, what is kept."""
    for batch in batches:
        for _, chunk, (marks, replies) in _chunks(batch):
            change = np.zeros(len(chunk.data) + 1, np.int32)
            if replies:
                _marked(chunk, marks, key_groups)
                parts = [_unpacked(r, np.int64, np.uint8, np.uint8, np.int64) for r in replies]
                number = np.concatenate([np.cumsum(p[0]) for p in parts])
                place, span = (np.concatenate([p[i] for p in parts]).astype(np.int64) for i in (1, 2))
                owner = np.concatenate([np.cumsum(p[3]) for p in parts])
                order = np.argsort(number, kind="stable")
                bounds = np.searchsorted(number[order], np.arange(len(chunk.sample) + 1))
                times = (bounds[1:] - bounds[:-1])[chunk.member]
                which = np.repeat(np.arange(len(chunk.member)), times)
                at = order[_stretches(bounds[:-1][chunk.member], times)]
                late = owner[at] < chunk.ids[chunk.doc[which]]
                which, at = which[late], at[late]
                begin = chunk.begin[which] + place[at]
                np.add.at(change, begin, 1)
                np.add.at(change, begin + span[at] + SPAN - 1, -1)
            gone = np.cumsum(change[:-1], dtype=np.int32) > 0
            opens = gone.copy()
            opens[1:] &= ~gone[:-1]
            starts = chunk.starts[chunk.starts < len(gone)]
            opens[starts] = gone[starts]
            begin = np.flatnonzero(opens)
            removed = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
            kept = chunk.data[~gone]
            doc_bounds = np.concatenate([[0], chunk.ends])
            left = doc_bounds - removed[doc_bounds]
            low = np.searchsorted(begin, doc_bounds)
            span_doc = np.searchsorted(chunk.ends, begin, "right")
            sizes = np.diff(np.append(removed[begin], removed[-1]))
            spans = pa.ListArray.from_arrays(
                pa.array(low.astype(np.int32)), pa.StructArray.from_arrays([pa.array(begin - chunk.starts[span_doc]), pa.array(sizes)], ["start", "length"])
            )
            texts = pa.Array.from_buffers(pa.large_binary(), len(chunk.ends), [None, pa.py_buffer(left.astype(np.int64)), pa.py_buffer(kept)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.where(chunk.known, chunk.ids, 0), mask=~chunk.known), pa.array(np.diff(doc_bounds)),
                    pa.array(np.diff(removed[doc_bounds])), spans, texts,
                ],
                ["doc_id", "n_bytes", "n_removed", "spans", "kept"],
            )


_RESULT = "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, length: long>>, kept binary"


def remove_repeated(docs: DataFrame, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of each row of `docs`, which has doc_id (an integer) and text.

    `spans` are the maximal removed stretches (start, length) in bytes of the UTF-8 text, `kept` the remaining bytes. A null text has no
    bytes. Rows of one id don't remove one another's bytes; rows without an id stay whole and remove nothing. Documents shorter
    than SPAN bytes stay whole. An empty table gives an empty result. Other columns are ignored whatever their names.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    chunks = written(in_arrow(rows, _pack, _PACKED), "suffix-chunks")
    size = chunks.agg(F.sum(F.element_at("ends", -1))).first()[0] or 0
    key_groups, groups = 1 + size * 3 // 10 // GROUP_BYTES, 1 + size // GROUP_BYTES

    def grouped(sent: DataFrame, count: int) -> DataFrame:
        return sent.repartitionById(count, F.col("bucket").cast("int"))

    sent = in_arrow(chunks, partial(_send_keys, groups=key_groups), "bucket long, blob binary")
    marks = in_arrow(grouped(sent, key_groups), partial(_mark, hot=hot), "chunk long, bucket long, blob binary")
    marks = written(marks.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("bucket", "blob"))).alias("marks")), "suffix-marks")
    marked = chunks.join(marks, "chunk", "left")
    sent = in_arrow(marked, partial(_send_segments, key_groups=key_groups, groups=groups), "bucket long, blob binary")
    replies = in_arrow(grouped(sent, groups), _settle, "chunk long, blob binary")
    replies = written(replies.groupBy("chunk").agg(F.collect_list("blob").alias("replies")), "suffix-replies")
    mail = marks.join(replies, "chunk", "left")
    return in_arrow(chunks.join(mail, "chunk", "left"), partial(_remove, key_groups=key_groups), _RESULT)

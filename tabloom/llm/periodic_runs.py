"""Periodic runs of words, found in a grammar of each document.

A run is a maximal stretch of consecutive words with a smallest period q that is at least max(least, 2q) words long.

1. Re-Pair: the most frequent pair of neighbouring symbols becomes a nonterminal, until no pair occurs twice. Pairs
   that are more frequent than every pair they share a symbol with don't disturb one another, so
   all of them are replaced at once, in all documents of a batch; the grammar is that of one pair at a time. Every
   replacement is a derivation position of its nonterminal. What is left of a document is derived by a balanced tree.
2. Runs that cross the boundary between the two halves of a nonterminal are computed once, on one of
   its positions. A run of period q that crosses it agrees with itself, q words on, right before or right behind the boundary;
   these few (nonterminal, q) are extended to both sides within the nonterminal.
3. They are translated to all derivation positions. The node that derives a run and cuts it holds it
   whole; parts of it seen in smaller nodes are merged into it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabloom.llm.arrow import in_arrow, slices
from tabloom.llm.common import bind

LEAST = 12  # words of a run
PIECE_BYTES = 1 << 20  # texts are worked on in pieces of about this size
PAIRS_AT_A_TIME = 1 << 20
PROBES = 4  # agreements looked at to both sides before an extension is computed

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of some texts: their ids, the bytes of all words in a row, and where texts begin."""

    def __init__(self, texts: pa.Array) -> None:
        texts = pc.fill_null(texts, "").cast(pa.large_binary())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8)[bounds[0] : bounds[-1]] if held else np.empty(0, np.uint8)
        bounds = bounds - bounds[0]
        solid = ~_BLANK[data]
        opens = solid.copy()
        opens[1:] &= ~solid[:-1]
        starts = bounds[:-1][bounds[:-1] < len(data)]
        opens[starts] = solid[starts]
        self.bytes = data[solid]
        before = np.concatenate([[0], np.cumsum(solid, dtype=np.int64)])
        begins = np.flatnonzero(opens)
        self.offsets = np.append(before[begins], before[-1])
        self.firsts = np.searchsorted(begins, bounds)  # the first word of each text, and the end
        # The words in a row without gaps are a column of strings by their offsets.
        column = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(self.offsets), pa.py_buffer(self.bytes)])
        self.ids = column.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)

    def joined(self, kept: np.ndarray) -> pa.Array:
        """The kept words of each text, joined by one space."""
        lengths = np.diff(self.offsets) + 1
        spaced = np.full(len(self.bytes) + len(lengths), 0x20, np.uint8)
        ends = np.cumsum(lengths)
        inside = np.ones(len(spaced), bool)
        inside[ends - 1] = False
        spaced[inside] = self.bytes
        if not kept.all():
            spaced = spaced[np.repeat(kept, lengths)]
        sizes = np.concatenate([[0], np.cumsum(np.where(kept, lengths, 0))])[self.firsts]
        some = np.diff(sizes) > 0
        # The space behind the last word of each text goes.
        last = np.zeros(len(spaced), bool)
        last[sizes[1:][some] - 1] = True
        spaced = spaced[~last]
        bounds = (sizes - np.concatenate([[0], np.cumsum(some)])).astype(np.int64)
        return pa.Array.from_buffers(pa.large_string(), len(some), [None, pa.py_buffer(bounds), pa.py_buffer(spaced)])


class Grammar:
    """The nonterminals of a Re-Pair grammar of several sequences, as spans of `words`.

    `low`, `mid` and `high` are the span and the boundary of each nonterminal at one of its derivation positions;
    `position` and `owner` list the starts of all derivation positions. Only nonterminals of `least` words or more are listed.
    """

    def __init__(self, words: np.ndarray, firsts: np.ndarray, least: int) -> None:
        n = len(words)
        self._low, self._mid, self._high = [], [], []
        self._position, self._owner = [], []
        self._count, self._least = 0, least
        text = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))
        # Symbols of different texts differ, so no pair is counted across texts.
        _, symbol = np.unique(text * (words.max(initial=0) + 1) + words, return_inverse=True)
        following = np.arange(1, n + 1)
        following[firsts[1:][np.diff(firsts) > 0] - 1] = -1
        alive, length = self._replace_pairs(symbol.astype(np.int64), following)
        self._derive_rest(np.flatnonzero(alive), length, text)
        self.low, self.mid, self.high = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (self._low, self._mid, self._high))
        self.position, self.owner = (np.concatenate(x or [np.empty(0, np.int64)]) for x in (self._position, self._owner))

    def _add(self, low, mid, high, position=None, owner=None) -> None:
        """Nonterminals, and their derivation positions (owner: index into those given; by default one each)."""
        wide = high - low >= self._least
        number = np.cumsum(wide) - 1 + self._count
        if position is None:
            position, owner = low, np.arange(len(low))
        listed = wide[owner]
        self._low.append(low[wide])
        self._mid.append(mid[wide])
        self._high.append(high[wide])
        self._position.append(position[listed])
        self._owner.append(number[owner[listed]])
        self._count += int(wide.sum())

    def _replace_pairs(self, symbol: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(symbol)
        before = np.full(n, -1)
        linked = following >= 0
        before[following[linked]] = np.flatnonzero(linked)
        length, alive = np.ones(n, np.int64), np.ones(n, bool)
        symbols = int(symbol.max(initial=-1)) + 1
        active = np.flatnonzero(linked)
        while len(active):
            left, right = symbol[active], symbol[following[active]]
            pairs, pair = np.unique((left << 32) | right, return_inverse=True)
            # Of a stretch of equal symbols every other position counts.
            counted = np.ones(len(active), bool)
            twin = np.flatnonzero(left == right)
            if len(twin):
                at = active[twin]
                opens = np.ones(len(twin), bool)
                opens[1:] = at[1:] != following[at[:-1]]
                run = np.flatnonzero(opens)
                counted[twin] = (np.arange(len(twin)) - np.repeat(run, np.diff(np.append(run, len(twin))))) % 2 == 0
            count = np.bincount(pair[counted], minlength=len(pairs))
            often = count >= 2
            if not often.any():
                break
            a, b = pairs >> 32, pairs & 0xFFFFFFFF
            with np.errstate(over="ignore"):
                tie = (pairs.astype(np.uint64) * _MIX) >> np.uint64(32)
            rank = np.empty(len(pairs), np.int64)
            rank[np.lexsort((tie, count))] = np.arange(1, len(pairs) + 1)
            rank[~often] = 0
            best = np.zeros(symbols, np.int64)
            np.maximum.at(best, a, rank)
            np.maximum.at(best, b, rank)
            chosen = often & (rank == best[a]) & (rank == best[b])

            taken = counted & chosen[pair]
            first = active[taken]
            second = following[first]
            new = np.cumsum(chosen) - 1
            made = new[pair[taken]]
            # One position of each new nonterminal stands for all.
            _, sample = np.unique(made, return_index=True)
            low, mid = first[sample], second[sample]
            self._add(low, mid, mid + length[mid], first, made)

            symbol[first] = symbols + made
            symbols += int(chosen.sum())
            after = following[second]
            length[first] += length[second]
            alive[second] = False
            following[first] = after
            has = after >= 0
            before[after[has]] = first[has]
            still = active[often[pair] & ~taken]
            previous = before[first]
            active = np.unique(np.concatenate([still[alive[still]], previous[previous >= 0], first]))
            active = active[following[active] >= 0]
        return alive, length

    def _derive_rest(self, start: np.ndarray, length: np.ndarray, text: np.ndarray) -> None:
        """A balanced tree over the symbols that are left of each text."""
        end, text = start + length[start], text[start]
        while len(start):
            opens = np.ones(len(start), bool)
            opens[1:] = text[1:] != text[:-1]
            head = np.flatnonzero(opens)
            even = (np.arange(len(start)) - np.repeat(head, np.diff(np.append(head, len(start))))) % 2 == 0
            joined = np.flatnonzero(~even)
            if not len(joined):
                break
            self._add(start[joined - 1], start[joined], end[joined])
            end[joined - 1] = end[joined]
            start, end, text = start[even], end[even], text[even]


def _crossing(words: np.ndarray, low: np.ndarray, mid: np.ndarray, high: np.ndarray, least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, index, period) where words agree at a node's boundary and PROBES words around it could make a run."""
    most = (high - low) // 2
    for count, sign in ((np.minimum(mid - low, most), -1), (np.minimum(high - mid, most), 1)):
        total = np.cumsum(count)
        done = 0
        while done < len(count):
            # nodes of about PAIRS_AT_A_TIME pairs; a larger one stands alone
            stop = max(int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS_AT_A_TIME, "right")), done + 1)
            sizes = count[done:stop]
            node = np.repeat(np.arange(done, stop), sizes)
            period = np.arange(len(node)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
            index = mid[node] - period if sign < 0 else mid[node] - 1
            agrees = words[index] == words[index + period]
            node, index, period = node[agrees], index[agrees], period[agrees]
            need = np.maximum(least - period, period)
            found, ends = np.ones(len(node), np.int64), []
            for step in (1, -1):
                going = np.ones(len(node), bool)
                for i in range(1, PROBES + 1):
                    at = index + step * i
                    going &= (at >= low[node]) & (at + period < high[node])
                    where = np.flatnonzero(going)
                    going[where] = words[at[where]] == words[at[where] + period[where]]
                    found += going
                ends.append(going)
            likely = (found >= need) | ends[0] | ends[1]
            yield node[likely], index[likely], period[likely]
            done = stop


def _agreeing(words: np.ndarray, at: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The largest [x, y) around `at` within which words agree with those `period` on; both lie in [low, high)."""
    y, chunk = at + 1, 16
    while y < high - period:
        stop = min(y + chunk, high - period)
        differs = words[y:stop] != words[y + period : stop + period]
        if differs.any():
            y += int(differs.argmax())
            break
        y, chunk = stop, chunk * 4
    x, chunk = at, 16
    while x > low:
        stop = max(x - chunk, low)
        differs = words[stop:x] != words[stop + period : x + period]
        if differs.any():
            x -= int(differs[::-1].argmax())
            break
        x, chunk = stop, chunk * 4
    return x, y


def _node_runs(words: np.ndarray, grammar: Grammar, least: int) -> tuple[np.ndarray, ...]:
    """(node, start relative to the node, length, period) of the runs that cross a boundary, within their nodes."""
    parts = list(_crossing(words, grammar.low, grammar.mid, grammar.high, least))
    node, index, period = (np.concatenate([p[i] for p in parts] or [np.empty(0, np.int64)]) for i in range(3))
    order = np.lexsort((index, period, node))
    node, index, period = node[order], index[order], period[order]
    bounds = np.append(np.flatnonzero(np.diff(node, prepend=-1)), len(node))
    found: list[tuple[int, int, int, int]] = []
    for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
        owner = int(node[lo])
        low, high = int(grammar.low[owner]), int(grammar.high[owner])
        at, step = index[lo:hi], period[lo:hi]
        while len(at):
            q = int(step[0])
            x, y = _agreeing(words, int(at[0]), q, low, high)
            if y - x >= max(least - q, q):
                found.append((owner, x - low, y - x + q, q))
                # Multiples of its period have the same run.
                rest = ~((step % q == 0) & (at >= x) & (at + step < y + q))
            else:
                rest = ~((step == q) & (at >= x) & (at < y))
            rest[0] = False
            at, step = at[rest], step[rest]
    table = np.array(found, np.int64).reshape(-1, 4)
    return table[:, 0], table[:, 1], table[:, 2], table[:, 3]


def word_runs(words: np.ndarray, firsts: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, ...]:
    """(start, length, period) of all runs of several texts, by start, then period; starts count from the first word."""
    grammar = Grammar(words, firsts, least)
    node, shift, length, period = _node_runs(words, grammar, least)
    # All derivation positions of the nonterminals that have runs.
    order = np.argsort(grammar.owner, kind="stable")
    begin = np.searchsorted(grammar.owner[order], node)
    times = np.searchsorted(grammar.owner[order], node, "right") - begin
    which = np.repeat(np.arange(len(node)), times)
    place = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + begin[which]
    start = grammar.position[order][place] + shift[which]
    end, period = start + length[which], period[which]
    # Parts of one run overlap by its period at least; of other runs of that period by less.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    if len(start):
        same = np.zeros(len(start), bool)
        same[1:] = period[1:] == period[:-1]
        key = np.cumsum(~same)
        span = int(end.max()) + 1
        reach = np.maximum.accumulate(end + key * span) - key * span
        opens = ~same
        opens[1:] |= start[1:] > reach[:-1] - period[1:]
        head = np.flatnonzero(opens)
        start, end, period = start[head], np.maximum.reduceat(end, head), period[head]
        order = np.lexsort((period, end, start))
        start, end, period = start[order], end[order], period[order]
        smallest = np.ones(len(start), bool)
        smallest[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
        start, end, period = start[smallest], end[smallest], period[smallest]
        order = np.lexsort((period, start))
        start, end, period = start[order], end[order], period[order]
    return start, end - start, period


def _piece(ids: pa.Array, texts: pa.Array, least: int) -> pa.RecordBatch:
    words = Words(texts)
    start, length, period = word_runs(words.ids, words.firsts, least)
    text = np.searchsorted(words.firsts, start, "right") - 1
    change = np.zeros(len(words.ids) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, start + length, -1)
    kept = np.cumsum(change[:-1]) == 0
    bounds = pa.array(np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32))
    numbers = [pa.array(x) for x in (start - words.firsts[text], length, period)]
    runs = pa.ListArray.from_arrays(bounds, pa.StructArray.from_arrays(numbers, ["start", "length", "period"]))
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(np.diff(words.firsts)), runs, words.joined(kept)], ["doc_id", "n_words", "runs", "collapsed"]
    )


def find_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of each row of `docs`, which has doc_id and text.

    `runs` is an array of (start, length, period) in words, by start, then period. `collapsed` has the words joined by one space
    without those that some run contains after its first period. Rows with a null id, and repeated ones, are
    rows like others; a null or empty text has no words, no runs, and an empty collapsed text. An empty table gives an empty result.
    No row is shuffled: a document is the work of one task, in memory in proportion to the longest document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, 1, PIECE_BYTES):
                yield _piece(piece.column(0), piece.column(1), least)

    number = T.LongType()
    entry = T.StructType([T.StructField(n, number) for n in ("start", "length", "period")])
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_words", number), T.StructField("runs", T.ArrayType(entry)), T.StructField("collapsed", T.StringType())]
    )
    return in_arrow(docs.select("doc_id", "text"), run, schema)


def with_loops(docs: DataFrame) -> DataFrame:
    """(doc_id, text): a tenth of the documents end in a loop of words.

    With h the crc32 of the id, g = h / 10, and n words: if h ends in 0, each word i >= a = g mod n becomes word
    a + (i - a) mod (1 + (n - a) / (3 + g mod 8)). The words of such texts are joined by one space.
    """
    code = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(code / 10).cast("long")

    def looped(words: Column) -> Column:
        n = F.size(words).cast("long")
        return bind(F.struct(words.alias("w"), F.pmod(g, n).alias("a"), n.alias("n")), spread)

    def spread(v: Column) -> Column:
        period = F.floor((v["n"] - v["a"]) / (3 + g % 8)).cast("long") + 1
        loop = bind(period, lambda p: F.transform(
            F.sequence(F.lit(0).cast("long"), v["n"] - 1),
            lambda i: F.get(v["w"], F.when(i < v["a"], i).otherwise(v["a"] + F.pmod(i - v["a"], p)).cast("int")),
        ))
        return F.array_join(loop, " ")

    words = F.filter(F.split(F.col("text"), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    text = F.when((code % 10 == 0) & F.rlike("text", F.lit("[^\\x20\\x09-\\x0D]")), bind(words, looped)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def digest_runs(found: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of a result of `find_runs`.

    The four numbers are those of the longest run (of several the first, then that of the least period), null without runs.
    """
    lines = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    ordered = F.transform("runs", lambda r: F.struct((-r["length"]).alias("shortness"), r["start"].alias("start"), r["period"].alias("period")))
    longest = F.array_min(ordered)
    return found.select(
        "doc_id", "runs", longest.alias("longest"), F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", (-F.col("longest.shortness")).alias("length"),
        "longest.period", F.floor(F.col("longest.shortness") * -1000 / F.col("longest.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )

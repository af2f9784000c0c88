"""Structure repair of conversations: the cheapest edits that make roles alternate, in linear space.

The roles of a repaired conversation are `(s?(ua)+)?` by their initials. Walking through that pattern takes four
states: nothing yet, after the system turn, after a user turn, after an assistant turn. A row is kept, given
another role or deleted; empty turns may be inserted anywhere. In any state an inserted or re-roled turn can
have one role only, so the letters of the edits say all there is to know.

The cheapest edits are found by divide and conquer: a forward pass over the first half gives the cost of reaching
each of the four states and the order of their least edit strings, a backward pass over the second half the
cost from each state to the end. The crossing is the state with the least sum, of several the one whose
string comes first; both halves are then solved alone. Only vectors of four are held.

Conversations of any length are solved exactly without being gathered. Rows are sorted over
all tasks by conversation and turn; what a task holds of a conversation, at most SEGMENT_ROWS rows at a time, is a segment.
A conversation that a task holds whole is solved there. The segments of the others become matrices (cost and
order from each state to each state), which are multiplied level by level; on the way back the crossing between
any two of them is chosen in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tabloom.llm.arrow import in_arrow
from tabloom.llm.common import written

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
BLANKS = " \t\n\x0b\x0c\r"
LEGAL = frozenset(("su", "ua", "au"))
SEGMENT_ROWS, SEGMENT_CHARS = 4096, 1 << 22
RUN = 64  # matrices multiplied at a time
NEVER = 1 << 40

# The state an inserted or re-roled turn leads to.
_NEXT = (USER, USER, ASSISTANT, USER)
# Cost and edits that complete the pattern from each state.
_END = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


def _moves(symbol: str, state: int) -> Iterator[tuple[int, int, str]]:
    """(state after, cost, edits) of one row, with the turns inserted before it."""
    late = CUT_OFF if symbol.isupper() else 0
    initial = symbol.lower()
    for inserted in range(3):
        cost, edits = inserted * INSERT, "I" * inserted
        yield state, cost + DELETE, edits + "D"
        if initial not in "bd":
            yield _NEXT[state], cost + REROLE + late, edits + "R"
            if initial == "s" and state == START:
                yield SYSTEM, cost + KEEP + late, edits + "K"
            elif initial in "ua" and "_ua"[_NEXT[state] - 1] == initial:
                yield _NEXT[state], cost + KEEP + late, edits + "K"
        state = _NEXT[state]


def _table(symbol: str) -> list[list[tuple[int, str]]]:
    table = [[(NEVER, "")] * 4 for _ in range(4)]
    for before in range(4):
        for after, cost, edits in _moves(symbol, before):
            table[before][after] = min(table[before][after], (cost, edits))
    return table


# Symbols of rows: the initial of the role (x: any other), in capitals if the text is cut off; b blank; d duplicate.
_TABLES = {symbol: _table(symbol) for symbol in "suaxSUAXbd"}

Vector = tuple[list[int], list[int]]


def _from(state: int) -> Vector:
    return [0 if q == state else NEVER for q in range(4)], [0] * 4


def _ranked(best: list[tuple]) -> Vector:
    """Costs, and ranks by what follows the cost."""
    order = sorted(range(4), key=lambda q: best[q][1:])
    return [min(b[0], NEVER) for b in best], [order.index(q) for q in range(4)]


def _forward(symbols: str, lo: int, hi: int, state: int) -> Vector:
    """Cost of each state after rows lo..hi-1, and the order of their least edit strings."""
    costs, ranks = _from(state)
    for symbol in symbols[lo:hi]:
        table = _TABLES[symbol]
        best = [min((costs[q] + table[q][after][0], ranks[q], table[q][after][1]) for q in range(4)) for after in range(4)]
        costs, ranks = _ranked(best)
    return costs, ranks


def _backward(symbols: str, lo: int, hi: int, state: int) -> list[int]:
    """Cost from each state before row lo to `state` after row hi-1."""
    costs = _from(state)[0]
    for symbol in reversed(symbols[lo:hi]):
        table = _TABLES[symbol]
        costs = [min(table[before][q][0] + costs[q] for q in range(4)) for before in range(4)]
    return costs


def least_edits(symbols: str, before: int, after: int, lo: int = 0, hi: int | None = None) -> str:
    """The cheapest edits of rows lo..hi-1 from state `before` to state `after`; the least string of several."""
    hi = len(symbols) if hi is None else hi
    if hi - lo == 0:
        return ""
    if hi - lo == 1:
        return _TABLES[symbols[lo]][before][after][1]
    middle = (lo + hi) // 2
    costs, ranks = _forward(symbols, lo, middle, before)
    rest = _backward(symbols, middle, hi, after)
    crossing = min(range(4), key=lambda q: (costs[q] + rest[q], ranks[q]))
    return least_edits(symbols, before, crossing, lo, middle) + least_edits(symbols, crossing, after, middle, hi)


def _finish(costs: list[int], ranks: list[int]) -> int:
    """The last state of the cheapest, then least, edits."""
    return min(range(4), key=lambda q: (costs[q] + _END[q][0], ranks[q]))


def solve(symbols: str) -> tuple[int, str]:
    """Cost and edits of a whole conversation."""
    costs, ranks = _forward(symbols, 0, len(symbols), START)
    last = _finish(costs, ranks)
    return costs[last] + _END[last][0], least_edits(symbols, START, last) + _END[last][1]


def apply_edits(edits: str, state: int, roles: list[str], texts: list[str]) -> list[dict]:
    """The turns that remain, from `state` on."""
    turns, at = [], 0
    for edit in edits:
        if edit == "I":
            state = _NEXT[state]
            turns.append({"role": ROLES[state], "text": ""})
            continue
        if edit == "R":
            state = _NEXT[state]
            turns.append({"role": ROLES[state], "text": texts[at]})
        elif edit == "K":
            state = SYSTEM if roles[at][:1] == "s" else _NEXT[state]
            turns.append({"role": roles[at], "text": texts[at]})
        at += 1
    return turns


def _matrix(symbols: str) -> list[int]:
    """Costs and ranks from each state to each state: 16 and 16 numbers."""
    vectors = [_forward(symbols, 0, len(symbols), state) for state in range(4)]
    return [c for costs, _ in vectors for c in costs] + [r for _, ranks in vectors for r in ranks]


def _rows(matrix: list[int]) -> list[Vector]:
    return [(list(matrix[4 * a : 4 * a + 4]), list(matrix[16 + 4 * a : 20 + 4 * a])) for a in range(4)]


def _product(left: list[int], right: list[int]) -> list[int]:
    costs, ranks, second = [], [], _rows(right)
    for first_costs, first_ranks in _rows(left):
        best = [
            min((first_costs[q] + second[q][0][after], first_ranks[q], second[q][1][after]) for q in range(4))
            for after in range(4)
        ]
        vector = _ranked(best)
        costs += vector[0]
        ranks += vector[1]
    return costs + ranks


def _crossings(matrices: list[list[int]], before: int, after: int) -> list[int]:
    """The state after each of some neighbouring segments, by the same halving."""
    if len(matrices) == 1:
        return [after]
    middle = len(matrices) // 2
    halves = []
    for part in (matrices[:middle], matrices[middle:]):
        whole = part[0]
        for m in part[1:]:
            whole = _product(whole, m)
        halves.append(_rows(whole))
    costs, ranks = halves[0][before]
    crossing = min(range(4), key=lambda q: (costs[q] + halves[1][q][0][after], ranks[q]))
    return _crossings(matrices[:middle], before, crossing) + _crossings(matrices[middle:], crossing, after)


class _Segment:
    """Consecutive rows of one conversation."""

    def __init__(self) -> None:
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.turns: list[int | None] = []
        self.chars = 0

    def add(self, turn: int | None, role: str, text: str) -> None:
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.chars += len(text)

    def full(self) -> bool:
        return len(self.roles) >= SEGMENT_ROWS or self.chars >= SEGMENT_CHARS

    def row(self, conversation, part: int, number: int, whole: bool) -> dict:
        seen: set[bytes] = set()
        symbols, marks = [], []
        for role, text in zip(self.roles, self.texts, strict=True):
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            body = text.rstrip(BLANKS)
            mark = xxhash.xxh128_digest(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"))
            symbol = initial if body[-1:] in (".", "!", "?") else initial.upper()
            symbol = "b" if not body else "d" if mark in seen else symbol
            marks.append(None if mark in seen else mark)
            seen.add(mark)
            symbols.append(symbol)
        symbols = "".join(symbols)
        initials = [role[:1] for role in self.roles]
        known = [t for t in self.turns if t is not None]
        cost, edits = solve(symbols) if whole else (None, None)
        return {
            "conv_id": conversation, "part": part, "number": number, "whole": whole, "symbols": symbols,
            "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)),
            "first_initial": initials[0] if initials else None, "last_initial": initials[-1] if initials else None,
            "first_turn": known[0] if known else None, "last_turn": known[-1] if known else None,
            "turns": len(set(known)), "cost": cost, "edits": edits, "state": START if whole else None,
            "marks": None if whole else marks, "roles": None if whole else self.roles, "texts": None if whole else self.texts,
            "repaired": apply_edits(edits, START, self.roles, self.texts) if whole else None,
        }


_TURNS = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
_ARROW_TURNS = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _schema(id_type: T.DataType) -> T.StructType:
    strings = T.ArrayType(T.StringType())
    fields = [
        ("conv_id", id_type), ("part", T.LongType()), ("number", T.LongType()), ("whole", T.BooleanType()),
        ("symbols", T.StringType()), ("illegal", T.LongType()), ("first_initial", T.StringType()),
        ("last_initial", T.StringType()), ("first_turn", T.LongType()), ("last_turn", T.LongType()),
        ("turns", T.LongType()), ("cost", T.LongType()), ("edits", T.StringType()), ("state", T.IntegerType()),
        ("marks", T.ArrayType(T.BinaryType())), ("roles", strings), ("texts", strings), ("repaired", _TURNS),
    ]
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_ARROW = {
    "part": pa.int64(), "number": pa.int64(), "whole": pa.bool_(), "symbols": pa.string(), "illegal": pa.int64(),
    "first_initial": pa.string(), "last_initial": pa.string(), "first_turn": pa.int64(), "last_turn": pa.int64(),
    "turns": pa.int64(), "cost": pa.int64(), "edits": pa.string(), "state": pa.int32(),
    "marks": pa.list_(pa.binary()), "roles": pa.list_(pa.string()), "texts": pa.list_(pa.string()),
    "repaired": _ARROW_TURNS,
}


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of a sorted stream of (conv_id, present, turn, role, text).

    The first and the last conversation of the stream may go on in a neighbouring task, so they are not `whole`.
    """
    part = TaskContext.get().partitionId()
    held, size, id_type = [], 0, None
    current, segment, number, first = None, None, 0, True

    def packed() -> pa.RecordBatch:
        columns = [pa.array([r["conv_id"] for r in held], id_type)]
        columns += [pa.array([r[name] for r in held], kind) for name, kind in _ARROW.items()]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *_ARROW])

    for batch in batches:
        id_type = batch.column(0).type
        for conversation, present, turn, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            new = segment is None or conversation != current
            if new or segment.full():
                if segment is not None:
                    held.append(segment.row(current, part, number, whole=new and number == 0 and not first))
                    size += segment.chars
                    first = first and not new
                number = 0 if new else number + 1
                current, segment = conversation, _Segment()
                if len(held) >= 1024 or size >= SEGMENT_CHARS:
                    yield packed()
                    held, size = [], 0
            if present:
                segment.add(turn, " " if role is None else role, " " if text is None else text)
    if segment is not None:
        held.append(segment.row(current, part, number, whole=False))
        yield packed()


def _count(symbols: Column, letters: str) -> Column:
    return (F.length(symbols) - F.length(F.translate(symbols, letters, ""))).cast("long")


def _without_earlier(parts: DataFrame) -> DataFrame:
    """Segments of divided conversations with rows marked as duplicates of rows in earlier segments."""
    entries = written(
        parts.select("conv_id", "part", "number", F.posexplode("marks").alias("at", "mark")).where("mark IS NOT NULL"),
        "repair-marks",
    )
    first = entries.groupBy("conv_id", "mark").agg(F.min(F.struct("part", "number")).alias("first"), F.count("*").alias("n"))
    same = F.col("e.conv_id").eqNullSafe(F.col("f.conv_id")) & (F.col("e.mark") == F.col("f.mark"))
    late = (
        entries.alias("e").join(first.where("n > 1").alias("f"), same)
        .where(F.struct("e.part", "e.number") > F.col("f.first"))
        .groupBy("e.part", "e.number", "e.conv_id").agg(F.sort_array(F.collect_list("at")).alias("late"))
    )
    here = F.col("p.conv_id").eqNullSafe(F.col("l.conv_id")) & (F.col("p.part") == F.col("l.part")) & (F.col("p.number") == F.col("l.number"))
    joined = parts.alias("p").join(late.select("conv_id", "part", "number", "late").alias("l"), here, "left")
    letters = F.transform(
        F.split(F.col("p.symbols"), ""),
        lambda letter, at: F.when(
            F.array_contains(F.col("l.late"), at) & (letter != "b"), F.lit("d")
        ).otherwise(letter),
    )
    fixed = F.when(F.col("l.late").isNull() | (F.length("p.symbols") == 0), F.col("p.symbols")).otherwise(F.array_join(letters, ""))
    return joined.select(*(F.col(f"p.{c}") for c in parts.columns if c != "symbols"), fixed.alias("symbols"))


def _solve_divided(parts: DataFrame) -> DataFrame:
    """(conv_id, part, number, edits, state, cost): edits of each segment, the state before it, the cost of its conversation."""
    id_type = parts.schema["conv_id"].dataType.simpleString()
    order = Window.partitionBy("conv_id").orderBy("part", "number")
    numbered = written(
        parts.select("conv_id", "part", "number", "symbols", (F.row_number().over(order) - 1).cast("long").alias("place")),
        "repair-numbered",
    )

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_matrix(s) for s in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int64()))], ["conv_id", "place", "matrix"])

    shape = f"conv_id {id_type}, place long, matrix array<long>"
    levels = [written(in_arrow(numbered.select("conv_id", "place", "symbols"), matrices, shape), "repair-level")]

    def multiplied(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        whole = None
        for m in group.sort_values("place")["matrix"]:
            whole = list(m) if whole is None else _product(whole, list(m))
        return pd.DataFrame({"conv_id": group["conv_id"].iloc[:1], "place": [int(key[1])], "matrix": [whole]})

    while (levels[-1].agg(F.max("place")).first()[0] or 0) > 0:
        runs = levels[-1].withColumn("run", F.floor(F.col("place") / RUN))
        levels.append(written(runs.groupBy("conv_id", "run").applyInPandas(multiplied, shape), "repair-level"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_rows(m)[START] for m in batch.column(1).to_pylist()]
            last = [_finish(*vector) for vector in found]
            cost = [vector[0][q] + _END[q][0] for vector, q in zip(found, last, strict=True)]
            zeros = pa.array([0] * len(last), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), zeros, pa.array([START] * len(last), pa.int32()), pa.array(last, pa.int32()), pa.array(cost, pa.int64())],
                ["conv_id", "run", "before", "after", "cost"],
            )

    known_shape = f"conv_id {id_type}, run long, before int, after int, cost long"
    known = in_arrow(levels[-1].select("conv_id", "matrix"), ends, known_shape)

    def crossed(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        before, after = int(group["before"].iloc[0]), int(group["after"].iloc[0])
        states = _crossings([list(m) for m in group["matrix"]], before, after)
        return pd.DataFrame(
            {"conv_id": group["conv_id"].array, "run": group["place"].array, "before": [before, *states[:-1]], "after": states, "cost": group["cost"].array}
        )

    for level in reversed(levels[:-1]):
        same = F.col("r.conv_id").eqNullSafe(F.col("k.conv_id")) & (F.col("r.run") == F.col("k.run"))
        runs = (
            level.withColumn("run", F.floor(F.col("place") / RUN)).alias("r").join(known.alias("k"), same)
            .select("r.*", "k.before", "k.after", "k.cost")
        )
        known = written(runs.groupBy("conv_id", "run").applyInPandas(crossed, known_shape), "repair-ends")

    def solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(i).to_pylist() for i in (3, 4, 5, 6)), strict=True)
            edits = [least_edits(symbols, before, after) + (_END[after][1] if last else "") for symbols, before, after, last in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(edits), batch.column(4), batch.column(7)],
                ["conv_id", "part", "number", "edits", "state", "cost"],
            )

    final = Window.partitionBy("conv_id").orderBy(F.col("place").desc())
    same = F.col("n.conv_id").eqNullSafe(F.col("k.conv_id")) & (F.col("n.place") == F.col("k.run"))
    placed = (
        numbered.withColumn("last", F.row_number().over(final) == 1).alias("n").join(known.alias("k"), same)
        .select("n.conv_id", "n.part", "n.number", "n.symbols", "k.before", "k.after", "n.last", "k.cost")
    )
    return in_arrow(placed, solved, f"conv_id {id_type}, part long, number long, edits string, state int, cost long")


def _turns(segments: DataFrame) -> DataFrame:
    """Adds `repaired`, the turns that remain of each segment, in place of `roles` and `texts`."""
    names = segments.columns
    kept = [c for c in names if c not in ("roles", "texts")]

    def applied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            picked = [batch.column(names.index(c)).to_pylist() for c in ("edits", "state", "roles", "texts")]
            turns = [apply_edits(*row) for row in zip(*picked, strict=True)]
            columns = [batch.column(names.index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(turns, _ARROW_TURNS)], [*kept, "repaired"])

    fields = [segments.schema[c] for c in kept]
    return in_arrow(segments, applied, T.StructType([*fields, T.StructField("repaired", _TURNS)]))


def repair(conversations: DataFrame, present: Column | None = None) -> DataFrame:
    """Segments of repaired conversations, one row each.

    `conversations` has conv_id, turn, role and text; other columns are ignored whatever their names. A
    conversation is one segment unless it is long or lies on the border of two tasks; `part, number` puts its segments
    in order. Columns: conv_id, part, number, whole (the only segment), symbols (one letter a row: the initial of its role, x
    for others, in capitals if its text is cut off; b blank, d duplicate), illegal (neighbouring roles out of order
    within the segment), first_initial, last_initial, first_turn, last_turn, turns (distinct ones), cost (of the
    whole conversation), edits (K keep, R re-role, D delete, I insert), repaired (array of role and text).

    Rows are taken by turn (nulls first), then role, then MD5 of the text; equal rows are neighbours. Null role and
    text are one space; rows without a conversation are the conversation null. Rows for which `present` is false only name
    a conversation, which then has no rows of its own. An empty table gives an empty result.
    """
    rows = conversations.select(
        "conv_id", F.coalesce(present, F.lit(False)).alias("present") if present is not None else F.lit(True).alias("present"),
        F.col("turn").cast("long").alias("turn"), "role", "text",
    ).withColumns({"mark": F.md5(F.coalesce("text", F.lit(" "))), "row": F.monotonically_increasing_id()})
    order = ["conv_id", F.col("turn").asc_nulls_first(), "role", "mark", "row"]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "present", "turn", "role", "text")
    segments = written(in_arrow(dealt, _segments, _schema(rows.schema["conv_id"].dataType)), "repair-segments")

    whole = segments.where("whole").drop("marks", "roles", "texts")
    divided = segments.where("NOT whole").drop("repaired")
    if divided.isEmpty():
        return whole
    marked = written(_without_earlier(divided.drop("roles", "texts")).drop("marks"), "repair-divided")
    solved = written(_solve_divided(marked), "repair-solved")

    def same(left: str, right: str) -> Column:
        equal = F.col(f"{left}.conv_id").eqNullSafe(F.col(f"{right}.conv_id"))
        return equal & (F.col(f"{left}.part") == F.col(f"{right}.part")) & (F.col(f"{left}.number") == F.col(f"{right}.number"))

    source = {**dict.fromkeys(("cost", "edits", "state"), "s"), **dict.fromkeys(("roles", "texts"), "d")}
    joined = (
        marked.alias("m").join(solved.alias("s"), same("m", "s")).join(divided.alias("d"), same("m", "d"))
        .select(*(F.col(f"{source.get(c, 'm')}.{c}").alias(c) for c in divided.columns if c != "marks"))
    )
    return whole.unionByName(_turns(joined))


def summarize(segments: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of each conversation.

    `segments` is a result of `repair`. Conversations of one segment need no shuffle. The digest of a divided
    conversation is taken in order by one task, which holds one segment at a time.
    """
    gap = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns"), F.lit(0))
    body = F.array_join(F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    counts = {"blank": _count(F.col("symbols"), "b"), "duplicate": _count(F.col("symbols"), "d"), "truncated": _count(F.col("symbols"), "SUAX")}
    whole = segments.where("whole").select(
        "conv_id", gap.alias("gaps"), *(c.alias(n) for n, c in counts.items()), "illegal", "cost",
        F.col("edits").alias("audit"), F.sha2(body, 256).alias("repaired_sha256"),
    )
    parts = segments.where("NOT whole")
    rows = F.length("symbols") > 0
    # Segments without rows only name their conversation; they don't lie between two neighbours.
    order = Window.partitionBy("conv_id", rows).orderBy("part", "number")
    pair = F.concat(F.lag("last_initial").over(order), F.col("first_initial"))
    later = F.last("last_turn", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1))
    bordered = parts.drop("repaired").withColumns(
        {"crossing": (rows & pair.isNotNull() & ~pair.isin(*LEGAL)).cast("long"), "shared": (later.eqNullSafe(F.col("first_turn")) & F.col("first_turn").isNotNull()).cast("long")}
    )
    span = F.max("last_turn") - F.min("first_turn") + 1 - F.sum(F.col("turns") - F.col("shared"))
    pieces = F.sort_array(F.collect_list(F.struct("part", "number", "edits")))
    totals = bordered.groupBy("conv_id").agg(
        F.coalesce(span, F.lit(0)).alias("gaps"), *(F.sum(c).alias(n) for n, c in counts.items()),
        F.sum(F.col("illegal") + F.col("crossing")).alias("illegal"), F.first("cost").alias("cost"),
        F.array_join(F.transform(pieces, lambda p: p["edits"]), "").alias("audit"),
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found, current, state, id_type = [], [], None, None, None
        for batch in batches:
            id_type = batch.column(0).type
            for conversation, text, some in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if state is None or conversation != current:
                    if state is not None:
                        ids.append(current)
                        found.append(state.hexdigest())
                    current, state, begun = conversation, hashlib.sha256(), False
                if some:
                    state.update((("\n" if begun else "") + text).encode("utf-8", "surrogatepass"))
                    begun = True
        if state is not None:
            ids.append(current)
            found.append(state.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array(ids, id_type), pa.array(found)], ["conv_id", "repaired_sha256"])

    id_type = segments.schema["conv_id"].dataType.simpleString()
    streamed = parts.select("conv_id", "part", "number", body.alias("body"), (F.size("repaired") > 0).alias("some"))
    streamed = streamed.repartition("conv_id").sortWithinPartitions("conv_id", "part", "number").select("conv_id", "body", "some")
    hashed = in_arrow(streamed, digests, f"conv_id {id_type}, repaired_sha256 string")
    both = totals.alias("t").join(hashed.alias("h"), F.col("t.conv_id").eqNullSafe(F.col("h.conv_id"))).select("t.*", "h.repaired_sha256")
    return whole.unionByName(both)


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with planted faults, by crc32 of `conv_id:turn` (null: one space) modulo 20.

    0: the row goes (it stays with `present` false, to name its conversation), 1: empty text, 2: its text loses
    all `.`, `!` and `?`, 3: the row is repeated, 4: role user. Null role and text become one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    code = F.crc32(key) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    rows = conversations.select(
        "conv_id", "turn", F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (code != 0).alias("present"), F.when(code == 3, 2).otherwise(1).alias("copies"),
    )
    return rows.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).drop("copies", "copy")

"""Speaker roles of raw transcripts by a hidden Markov model, and their canonical rendering.

A transcript is a table of lines. Each line opens or continues a turn of one of three roles, which makes six
hidden states. What is seen of a line are its speaker marker (`Human:`, `[A]`, `**System**` ...) and a few features.
Start, transition and emission probabilities are counted from labelled transcripts; Viterbi finds
the likeliest states.

A transcript of any length is solved exactly without being gathered: it is cut into blocks, each
block is reduced to a matrix (best score from the state before it to the state at its end), runs of
matrices are multiplied level by level until one is left, and on the way back every block learns the states at its
ends.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tabloom.llm.arrow import in_arrow
from tabloom.llm.common import written

ROLES = ("system", "user", "assistant")
STATES = tuple((role, opens) for role in ROLES for opens in (True, False))
START = len(STATES)  # the state before the first line
RUN = 64  # matrices multiplied at a time
TURN_SPAN = 1 << 20  # positions per turn of a rendered table
BLOCK_SPAN = 64 * TURN_SPAN

# Names that speakers are marked with, by the kind of marker they make.
MARKERS = {
    **dict.fromkeys(("system", "instructions", "context", "sys", "setup"), "system"),
    **dict.fromkeys(("user", "human", "q", "question", "customer", "me", "student", "person"), "user"),
    **dict.fromkeys(("assistant", "ai", "a", "answer", "bot", "agent", "model", "helper"), "assistant"),
}
_MARKER = re.compile(r"^\s*(?:\[|<\|?|\*\*|#+\s+|>\s*)?([^\W\d_]{1,14})\s*(?:(?:\|?>|\]|\*\*)\s*:?|:|-\s)\s*")


def marker_of(line: str) -> tuple[str, int]:
    """Kind of the speaker marker a line begins with (`none` without one), and its length."""
    found = _MARKER.match(line)
    if not found:
        return "none", 0
    kind = MARKERS.get(found[1].lower(), "unknown")
    return kind, found.end() if kind != "unknown" else 0


def observe(line: str) -> tuple[str, str, str]:
    """What is seen of a line: marker kind, length class, ending."""
    kind, size = marker_of(line)
    rest = line[size:].strip()
    length = "blank" if not rest else "short" if len(rest) < 40 else "medium" if len(rest) < 200 else "long"
    ending = "question" if rest.endswith("?") else "colon" if rest.endswith(":") else "stop" if rest.endswith((".", "!")) else "open"
    return kind, length, ending


@dataclass
class Model:
    move: np.ndarray  # (states and START, states), logarithms
    see: list[dict[tuple[int, str], float]]  # for each feature: (state, value) -> logarithm
    unseen: list[np.ndarray]  # for each feature: what a new value costs in each state

    def emission(self, lines: list[str]) -> np.ndarray:
        """(lines, states): logarithm of the probability of each line in each state."""
        known: dict[tuple[str, ...], np.ndarray] = {}
        rows = []
        for line in lines:
            seen = observe(line)
            if seen not in known:
                known[seen] = sum(
                    np.array([table.get((s, value), new[s]) for s in range(START)])
                    for table, new, value in zip(self.see, self.unseen, seen, strict=True)
                )
            rows.append(known[seen])
        return np.array(rows).reshape(-1, START)

    def matrix(self, lines: list[str]) -> np.ndarray:
        """(START + 1, states): best score from the state before the lines to the state at their end."""
        seen = self.emission(lines)
        best = self.move + seen[0]
        for row in seen[1:]:
            best = (best[:, :, None] + self.move[:START]).max(axis=1) + row
        return best

    def states(self, lines: list[str], before: int, last: int) -> list[int]:
        """The likeliest states of the lines, given the state before them and that of the last one."""
        seen, back = self.emission(lines), []
        score = self.move[before] + seen[0]
        for row in seen[1:]:
            options = score[:, None] + self.move[:START]
            back.append(options.argmax(axis=0))
            score = options.max(axis=0) + row
        path = [last]
        for step in reversed(back):
            path.append(int(step[path[-1]]))
        return path[::-1]


def _state(role: Column, opens: Column) -> Column:
    number = F.coalesce(*(F.when(role == r, F.lit(2 * i)) for i, r in enumerate(ROLES)))
    return number + F.when(opens, 0).otherwise(1)


def _observed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        seen = [observe(line) for line in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(seen, pa.list_(pa.string()))], ["state", "seen"]
        )


def _order(lines: DataFrame) -> list[str]:
    """What lines of a block are sorted by: the column `order` where there is one."""
    return ["order"] if "order" in lines.columns else ["position", "line"]


def learn(lines: DataFrame) -> Model:
    """Probabilities counted over labelled lines (conv_id, block, position, line, role, opens), one added to each count.

    Counts are at most a few numbers for each state; moves are counted inside blocks.
    Without any labelled line all states are equally likely.
    """
    named = lines.withColumn("state", _state(F.col("role"), F.col("opens"))).where("state IS NOT NULL")
    order = Window.partitionBy("conv_id", "block").orderBy(*_order(lines))
    first = F.row_number().over(order) == 1
    before = F.when(first & (F.col("block") == 0), F.lit(START)).otherwise(F.lag("state").over(order))
    moves = named.select(before.alias("before"), "state").where("before IS NOT NULL").groupBy("before", "state").count().collect()
    move = np.ones((START + 1, START))
    for r in moves:
        move[r["before"], r["state"]] += r["count"]
    seen = (
        named.select("state", "line").transform(in_arrow, _observed, "state int, seen array<string>")
        .select("state", F.posexplode("seen").alias("feature", "value"))
        .groupBy("state", "feature", "value").count().collect()
    )
    see, unseen = [], []
    for feature in range(3):
        rows = [r for r in seen if r["feature"] == feature]
        values = len({r["value"] for r in rows}) + 1
        totals = np.full(START, float(values))
        for r in rows:
            totals[r["state"]] += r["count"]
        see.append({(r["state"], r["value"]): float(np.log((r["count"] + 1) / totals[r["state"]])) for r in rows})
        unseen.append(-np.log(totals))
    return Model(np.log(move / move.sum(axis=1, keepdims=True)), see, unseen)


def _by_key(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Runs of rows with the same first `keys` columns of a sorted stream, as lists of columns."""
    held_key, held = None, None
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            key = row[:keys]
            if key != held_key:
                if held_key is not None:
                    yield held_key, held
                held_key, held = key, [[] for _ in row]
            for column, value in zip(held, row, strict=True):
                column.append(value)
    if held_key is not None:
        yield held_key, held


def _per_group(rows: DataFrame, keys: list[str], order: list[str], schema: str, body: Callable) -> DataFrame:
    """Rows of body(key, columns) for each group; groups are bounded blocks, dealt by key and sorted."""
    names = [field.split()[0] for field in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = run.types
        out: list[tuple] = []
        for key, columns in _by_key(batches, len(keys)):
            out.extend(body(key, columns))
            if len(out) >= 4096:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<double>": pa.list_(pa.float64())}
    run.types = [kinds[field.split()[1]] for field in schema.split(", ")]
    dealt = rows.select(*keys, *(c for c in rows.columns if c not in keys)).repartition(*keys)
    return dealt.sortWithinPartitions(*keys, *order).drop("order").transform(in_arrow, run, schema)


def _product(matrices: list[list[float]]) -> np.ndarray:
    stacked = np.array(matrices).reshape(-1, START + 1, START)
    best = stacked[0]
    for m in stacked[1:]:
        best = (best[:, :, None] + m[:START]).max(axis=1)
    return best


def _ends(matrices: list[list[float]], before: int, last: int) -> list[int]:
    """The state at the end of each block of a run."""
    stacked = np.array(matrices).reshape(-1, START + 1, START)
    score, back = stacked[0][before], []
    for m in stacked[1:]:
        options = score[:, None] + m[:START]
        back.append(options.argmax(axis=0))
        score = options.max(axis=0)
    path = [last]
    for step in reversed(back):
        path.append(int(step[path[-1]]))
    return path[::-1]


def recover_turns(lines: DataFrame, model: Model) -> DataFrame:
    """(conv_id, first_line, last_line, role, opens, rendered): pieces of turns in canonical form.

    `lines` has conv_id, block, position, line: blocks are numbered from 0 without gaps of meaning and hold a
    bounded number of lines each. A turn that goes on in the next block continues in a piece with `opens` false;
    all other pieces open a turn and carry its header. `first_line` and `last_line` are positions. Markers
    are removed from opening lines. Null lines count as blank; rows without a conversation are left out. Lines of a
    block are in the order of a column `order`, if there is one; without it they go by position, and equal
    positions by their lines. An empty table gives an empty result.
    """
    order = _order(lines)
    usable = lines.where("conv_id IS NOT NULL").select(
        "conv_id", "block", F.coalesce("position", F.lit(0)).cast("long").alias("position"), F.coalesce("line", F.lit("")).alias("line"),
        *(c for c in order if c == "order"),
    )
    level = written(
        _per_group(
            usable, ["conv_id", "block"], order, "conv_id long, block long, matrix array<double>",
            lambda key, columns: [(*key, model.matrix(columns[3]).ravel())],
        ),
        "chat-level",
    )
    levels = [level]
    while (levels[-1].agg(F.max("block")).first()[0] or 0) > 0:
        runs = levels[-1].select("conv_id", F.floor(F.col("block") / RUN).alias("run"), "block", "matrix")
        levels.append(
            written(
                _per_group(
                    runs, ["conv_id", "run"], ["block"], "conv_id long, block long, matrix array<double>",
                    lambda key, columns: [(*key, _product(columns[3]).ravel())],
                ),
                "chat-level",
            )
        )

    from_start = F.slice("matrix", START * START + 1, START)
    ends = levels[-1].select(
        "conv_id", "block", F.lit(START).alias("before"),
        (F.array_position(from_start, F.array_max(from_start)) - 1).cast("int").alias("last"),
    )

    def spread(key: tuple, columns: list[list]) -> Iterator[tuple]:
        before = columns[4][0]
        for block, last in zip(columns[2], _ends(columns[3], before, columns[5][0]), strict=True):
            yield key[0], block, before, last
            before = last

    for level in reversed(levels[:-1]):
        above = ends.withColumnRenamed("block", "run")
        runs = level.select("conv_id", F.floor(F.col("block") / RUN).alias("run"), "block", "matrix").join(above, ["conv_id", "run"])
        ends = written(
            _per_group(runs, ["conv_id", "run"], ["block"], "conv_id long, block long, before int, last int", spread),
            "chat-ends",
        )

    def render(key: tuple, columns: list[list]) -> Iterator[tuple]:
        positions, texts = columns[2], columns[3]
        path = model.states(texts, columns[4][0], columns[5][0])
        role, opens, first, body = None, True, 0, []
        for i, state in enumerate(path):
            now, begins = STATES[state]
            if begins or now != role:
                if role is not None:
                    yield key[0], positions[first], positions[i - 1], role, opens, _canonical(role, opens, body)
                role, first, body = now, i, []
                # a piece at the head of a later block goes on if its first line does not begin a turn
                opens = begins or i > 0 or columns[4][0] == START or STATES[columns[4][0]][0] != now
            body.append(texts[i][marker_of(texts[i])[1] :] if begins else texts[i])
        yield key[0], positions[first], positions[-1], role, opens, _canonical(role, opens, body)

    placed = usable.join(ends, ["conv_id", "block"])
    return _per_group(
        placed, ["conv_id", "block"], order,
        "conv_id long, first_line long, last_line long, role string, opens boolean, rendered string", render,
    )


def _canonical(role: str, opens: bool, body: list[str]) -> str:
    text = "\n".join(body).strip("\n")
    return f"<|{role}|>\n{text}" if opens else text


# Ways in which transcripts name their speakers: system, user, assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Instructions: ", "Human: ", "AI: "),
    ("[system] ", "Q: ", "A: "),
    ("**Context** ", "**Customer** ", "**Agent** "),
)


def transcript_lines(conversations: DataFrame, unmarked: int = 15) -> DataFrame:
    """Raw transcripts of a conversation table: (conv_id, block, position, line, role, opens, order).

    Each conversation has one of STYLES, by the hash of its id; `unmarked` percent of the turns after the first
    carry no marker. `role` and `opens` say what a parser should find. Null texts are one blank line;
    rows without a conversation are left out; null turns come first. `order` is turn, hash of the row, number of the
    row, line: rows of one turn stay apart, and lines of a turn in their order, at any number. Positions
    name the lines; those of a null turn are as in turn 0, and those from TURN_SPAN - 1 on are one.
    """
    marks = F.array(*(F.array(*(F.lit(m) for m in style)) for style in STYLES))
    style = F.get(marks, F.pmod(F.xxhash64("conv_id", F.lit("style")), F.lit(len(STYLES))).cast("int"))
    number = F.coalesce(*(F.when(F.col("role") == r, F.lit(i)) for i, r in enumerate(ROLES)))
    turn = F.coalesce("turn", F.lit(0)).cast("long")
    bare = (turn > 0) & (F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(100)) < unmarked)
    mark = F.when(bare | number.isNull(), F.lit("")).otherwise(F.get(style, number))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), "role",
        F.coalesce(F.col("turn").cast("long"), F.lit(-1 << 62)).alias("rank"),
        # rows alike in all columns may swap their numbers when a task is run again, which changes nothing
        F.xxhash64("turn", "role", "text").alias("row"), F.monotonically_increasing_id().alias("copy"),
        F.posexplode(F.split(F.concat(mark, F.coalesce("text", F.lit(""))), "\n")).alias("at", "line"),
    )
    position = F.col("turn") * TURN_SPAN + F.least("at", F.lit(TURN_SPAN - 1))
    return rows.select(
        "conv_id", F.floor(position / BLOCK_SPAN).alias("block"), position.alias("position"), "line", "role",
        (F.col("at") == 0).alias("opens"), F.array("rank", "row", "copy", F.col("at").cast("long")).alias("order"),
    )

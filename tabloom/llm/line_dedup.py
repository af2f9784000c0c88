"""Repeated passages of lines, cut at content-defined boundaries.

A rolling hash over the hashes of two adjacent lines is taken at every line. A boundary lies where the hash is seen for
the first time anywhere, or where its first occurrence does not go on from that of the line before. Between
boundaries lie chunks of two lines or more that stand, whole, at an earlier place too. As only the lines themselves
decide, an inserted or deleted line moves the boundaries next to it and no others, and no repeated run of two lines or more is
missed or cut short. A chunk is removed after its lines were compared with those of the first occurrence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import bind, free_name, maybe_in, salted_join, written


def _rolling(text: Column) -> Column:
    """Array of the hashes of each line but the last with the one after it; null for a null text."""

    def rolled(hashes: Column) -> Column:
        count = F.size(hashes) - 1
        return F.zip_with(
            F.slice(hashes, 1, count), F.slice(hashes, 2, count), lambda line, following: F.md5(F.concat(line, following))
        )

    return F.when(text.isNotNull(), bind(F.transform(F.split(text, "\n"), lambda line: F.md5(line)), rolled))


def _runs(numbers: Column) -> Column:
    """Array of (no, size) of the runs of consecutive numbers in an array of distinct ones; size is one more, the lines."""

    def cut(ordered: Column) -> Column:
        def ends(later: bool) -> Column:
            beside = (lambda i: F.get(ordered, i + 1) - 1) if later else (lambda i: F.get(ordered, i - 1) + 1)
            return F.filter(ordered, lambda n, i: F.coalesce(beside(i) != n, F.lit(True)))

        return F.zip_with(ends(False), ends(True), lambda a, b: F.struct(a.alias("no"), (b - a + 2).alias("size")))

    return bind(F.array_sort(numbers), cut)


def find_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, _row, _gone): the lines to remove, by number, of each text that holds a chunk that stands before.

    `_row` hashes the text, so that rows that repeat an id are told apart. First is the smallest (id, row
    hash, line number).
    """
    usable = docs.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_row"), F.col(text_col).alias("_text")
    )
    text, place = ["doc_id", "_row"], ["doc_id", "_row", "_no"]
    marks = usable.select(*text, F.posexplode(_rolling(F.col("_text"))).alias("_no", "_hash"))
    marks = written(marks.select(*place, F.unhex("_hash").alias("_key")), "lines-marks")
    # Counts and first places are combined before the shuffle: a hot hash is one row per task.
    groups = written(
        marks.groupBy("_key").agg(F.count("*").alias("_n"), F.min(F.struct(*place)).alias("_first")).where("_n > 1"),
        "lines-groups",
    )
    later = salted_join(marks, groups, ["_key"], "_n", F.struct(*place)).where(F.struct(*place) != F.col("_first"))
    # Hashes whose first occurrences follow one another are the same number of lines away from them: a group
    # holds numbers of lines of one text, and rows that repeat a text meet in it.
    shifts = later.groupBy(
        *text, F.col("_first.doc_id").alias("_first_id"), F.col("_first._row").alias("_first_row"),
        (F.col("_first._no") - F.col("_no")).alias("_shift"),
    ).agg(F.collect_set("_no").alias("_nos"))
    chunks = written(
        shifts.withColumn("_chunk", F.explode(_runs(F.col("_nos")))).select(
            *text, F.col("_chunk.no").alias("_no"), F.col("_chunk.size").alias("_size"), "_first_id", "_first_row",
            (F.col("_chunk.no") + F.col("_shift")).alias("_first_no"),
        ),
        "lines-chunks",
    )
    first = ["_first_id", "_first_row", "_first_no", "_size"]
    firsts = written(chunks.groupBy(*first).agg(F.count("*").alias("_n")), "lines-firsts")
    # Only chunks and their first occurrences are read again; other texts are dropped at this join. A text is cut
    # once, whatever the number of its chunks; those add up to no more than the lines that go.
    needed = written(
        chunks.select(*place, "_size")
        .unionByName(
            firsts.select(
                F.col("_first_id").alias("doc_id"), F.col("_first_row").alias("_row"), F.col("_first_no").alias("_no"), "_size"
            )
        )
        .groupBy(*text)
        .agg(F.collect_set(F.struct("_no", "_size")).alias("_wanted")),
        "lines-needed",
    )
    wanted = maybe_in(usable, needed, text, "__maybe").where("__maybe").drop("__maybe").join(needed.hint("merge"), text)

    def bodies_of(lines: Column) -> Column:
        return F.transform(
            "_wanted",
            lambda w: F.struct(w["_no"].alias("_no"), w["_size"].alias("_size"), F.slice(lines, w["_no"] + 1, w["_size"]).alias("_lines")),
        )

    cut = wanted.select(*text, F.explode(bind(F.split("_text", "\n"), bodies_of)).alias("_body"))
    bodies = written(cut.select(*text, "_body.*").distinct(), "lines-bodies")
    stays = firsts.join(
        bodies.select(
            F.col("doc_id").alias("_first_id"), F.col("_row").alias("_first_row"), F.col("_no").alias("_first_no"), "_size",
            F.col("_lines").alias("_first_lines"),
        ),
        first,
    )
    held = bodies.join(chunks, [*place, "_size"])
    compared = salted_join(held, written(stays, "lines-stays"), first, "_n", F.struct(*place))

    def same(i: Column) -> Column:
        return F.coalesce(F.get("_lines", i) == F.get("_first_lines", i), F.lit(False))

    # Lines of a chunk could differ only if two hashes are equal by chance; those that have an equal neighbour still go.
    every = F.sequence(F.lit(0), F.col("_size") - 1)
    equal = F.when(F.col("_lines") == F.col("_first_lines"), every).otherwise(
        F.filter(every, lambda i: same(i) & (same(i - 1) | same(i + 1)))
    )
    gone = compared.select(*text, F.transform(equal, lambda i: i + F.col("_no")).alias("_part")).where(F.size("_part") > 0)
    return gone.groupBy(*text).agg(F.array_distinct(F.flatten(F.collect_list("_part"))).alias("_gone"))


def remove_repeats(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of `docs`, the text without repeated chunks, and n_lines, removed_lines (long).

    A line goes if it and a neighbour occur, in this order and one after the other, at an earlier place: in a
    row with a smaller (id, row hash), or further up in its own text. The first occurrence of a line has no
    earlier place, so each distinct line stays at least once.

    A null text stays null with no lines; an empty text has one line. A text made of repeated
    chunks only becomes empty. Rows without an id keep their text and count no lines. Rows that repeat an id and its text are
    cleaned alike. Columns of `docs` named n_lines or removed_lines are replaced; others keep their values, whatever their
    names. An empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "removed_lines")]
    row, out, maybe = (free_name(docs, name) for name in ("__row", "__gone", "__maybe"))
    gone = find_repeats(docs, id_col=id_col, text_col=text_col)
    gone = written(gone.select(F.col("doc_id").alias(id_col), F.col("_row").alias(row), F.col("_gone").alias(out)), "lines-gone")
    # Rows without a repeat are not shuffled.
    rows = maybe_in(docs.withColumn(row, F.xxhash64(text_col)), gone, [id_col, row], maybe)
    marked = rows.where(F.col(maybe)).join(gone.hint("merge"), [id_col, row], "left").unionByName(
        rows.where(~F.col(maybe)), allowMissingColumns=True
    )

    def kept(lines: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(out))
        return F.array_join(F.transform(numbers, lambda j: F.get(lines, j)), "\n")

    # texts are cut again only where a line goes
    rest = F.when(F.col(out).isNull(), F.col(text_col)).otherwise(bind(F.split(text_col, "\n"), kept))
    counted = F.col(id_col).isNotNull() & F.col(text_col).isNotNull()
    return marked.select(
        *(rest.alias(c) if c == text_col else F.col(f"`{c}`") for c in columns),
        F.when(counted, F.size(F.split(text_col, "\n"))).otherwise(0).cast("long").alias("n_lines"),
        F.coalesce(F.size(out), F.lit(0)).cast("long").alias("removed_lines"),
    )

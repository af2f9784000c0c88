"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash.

Each level looks only at rows that the level before could not tell apart. The first two
work on a small table of (id, length, prefix hash); whole contents are read again only for
what survives them (or for every row, where the caller wants each row's digest).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import free_name, lower_ascii, maybe_in, salted_join, written

PREFIX_CHARS = 64


def _text(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def _shared(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Groups of more than one row: the keys and `_n`."""
    return written(rows.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1"), name)


def find_copies(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest_all: bool = False
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, text_length), one row per row of `docs` with an id.

    Texts are equal when identical after lower-casing A-Z; null counts as empty. The largest
    id of a group stays. Rows without an id cannot be named and are left out. Rows that
    repeat an id and its text count in `group_size` and are kept or dropped alike;
    `drop_copies` leaves one of them. `text_sha256` is null for rows settled before the
    last level, unless `digest_all`. An empty table gives an empty result.
    """
    text = _text(text_col)
    named = docs.where(F.col(id_col).isNotNull())
    marks = written(
        named.select(
            F.col(id_col).alias("doc_id"),
            F.octet_length(text).alias("_length"),
            F.xxhash64(lower_ascii(F.substring(text, 1, PREFIX_CHARS))).alias("_prefix"),
        ),
        "copies-marks",
    )
    spread = F.col("doc_id")
    by_length = _shared(marks, ["_length"], "copies-length")
    alike = salted_join(marks, by_length.select("_length", "_n"), ["_length"], "_n", spread).drop("_n")
    by_prefix = _shared(alike, ["_length", "_prefix"], "copies-prefix")
    suspects = salted_join(alike, by_prefix, ["_length", "_prefix"], "_n", spread).drop("_n")

    in_doubt = suspects.select("doc_id", "_length").distinct()
    contents = named.select(F.col(id_col).alias("doc_id"), F.octet_length(text).alias("_length"), text.alias("_text"))
    if not digest_all:
        # texts are ruled out, and hashed, where they stand
        in_doubt = written(in_doubt, "copies-doubt")
        contents = maybe_in(contents, in_doubt, ["doc_id", "_length"]).where("_maybe")
    digest = F.sha2(lower_ascii(F.col("_text")), 256).alias("text_sha256")
    hashed = written(contents.select("doc_id", "_length", digest), "copies-digest")
    if not digest_all:
        hashed = hashed.join(in_doubt, ["doc_id", "_length"], "left_semi")
    groups = written(
        hashed.join(in_doubt, ["doc_id", "_length"], "left_semi")
        .groupBy("text_sha256")
        .agg(F.count("*").alias("group_size"), F.max("doc_id").alias("_largest"))
        .where("group_size > 1"),
        "copies-groups",
    )
    found = salted_join(hashed, groups, ["text_sha256"], "group_size", spread, "left")
    if not digest_all:
        settled = marks.join(in_doubt, ["doc_id", "_length"], "left_anti").select("doc_id", "_length")
        found = found.unionByName(settled, allowMissingColumns=True)
    keep = F.coalesce("_largest", "doc_id")
    return found.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("doc_id") == keep).alias("kept"),
        "text_sha256",
        F.col("_length").cast("long").alias("text_length"),
    )


def drop_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row per distinct text, the one with the largest id; same columns.

    Of rows that repeat the kept id and its text one stays. Rows without an id are kept.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    length, digest, kept, flag = (free_name(docs, n) for n in ("__length", "__digest", "__kept", "__maybe"))
    found = find_copies(docs, id_col=id_col, text_col=text_col)
    copies = written(
        found.where("group_size > 1").select(
            F.col("doc_id").alias(id_col), F.col("text_length").alias(length), F.col("text_sha256").alias(digest), F.col("kept").alias(kept)
        ),
        "copies-found",
    )
    # Only rows that share id and length with one of a group of copies are hashed and shuffled.
    sized = docs.withColumn(length, F.octet_length(_text(text_col)).cast("long"))
    marked = maybe_in(sized, copies, [id_col, length], flag)
    doubtful = marked.where(F.col(flag)).withColumn(digest, F.sha2(lower_ascii(_text(text_col)), 256))
    doubtful = doubtful.join(copies.drop(length).hint("merge"), [id_col, digest], "left")
    # rows that repeat an id and its text have one partner each in `copies`, and more than one in the join
    single = doubtful.where(F.col(kept).isNull()).select(*columns)
    stays = doubtful.where(F.col(kept)).dropDuplicates([id_col, digest]).select(*columns)
    return marked.where(~F.col(flag)).select(*columns).unionByName(single).unionByName(stays)

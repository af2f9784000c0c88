"""Column expressions, salted lookups and written tables the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.session import fresh_path
from tabloom.sources.tables import read_table

__all__ = ["bind", "fold", "free_name", "lower_ascii", "maybe_in", "read_table", "salted_join", "written"]

# Size of the filters that go to all tasks, in bits: 8 MB at most, whatever the input.
LEAST_BITS, MOST_BITS = 1 << 16, 1 << 26

# A key with more than 1/WAYS of all rows is split; so at most WAYS keys are, and the
# broadcast that names them has at most WAYS rows at any input size.
WAYS = 1000


def lower_ascii(text: Column) -> Column:
    """`text` with A-Z in lower case and nothing else changed."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, ascii_uppercase, ascii_lowercase))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    The optimizer would otherwise move the expression into each lambda function that uses it, and
    compute it again for every element.
    """
    return F.get(F.transform(F.array(value), body), 0)


def fold(key: Column, parts: int) -> Column:
    """crc32 of the key as text, modulo `parts`; null for a null key."""
    return F.crc32(key.cast("string")) % parts


# What a task holds of a table it writes, in each of the two forms Parquet needs.
ROW_GROUP_BYTES = 16 << 20


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, name)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def salted_join(
    rows: DataFrame, groups: DataFrame, keys: list[str], size: str, spread: Column, how: str = "inner", *, unique: bool = True
) -> DataFrame:
    """Join `rows` to `groups` without a hot key; `groups` has one row per key, or any number if not `unique`.

    `size` is a column of `groups`: how many of `rows` share the key. Keys above 1/WAYS of
    all rows are dealt over several salts by the hash of `spread`, and their row of
    `groups` is repeated once per salt. Both inputs appear once in the plan; `groups` should be a
    written table, as its sizes are summed first.
    """
    sizes = groups if unique else groups.select(*keys, size).distinct()
    total = sizes.agg(F.sum(size)).first()[0] or 0
    salts = F.greatest(F.ceil(F.col(size) * WAYS / F.lit(max(total, 1))), F.lit(1)).cast("int")
    hot = sizes.select(*keys, salts.alias("_salts")).where("_salts > 1")
    dealt = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn(
            "_salt",
            F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_salts"))).otherwise(0).cast("int"),
        )
        .drop("_salts")
    )
    copies = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.join(copies, [*keys, "_salt"], how).drop("_salt")



def free_name(df: DataFrame, name: str) -> str:
    """`name`, or a longer one if `df` has a column of that name in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def maybe_in(rows: DataFrame, members: DataFrame, keys: list[str], flag: str = "_maybe") -> DataFrame:
    """`rows` with a boolean column: false only if the row's key is not among those of `members`.

    A bitmap over the hashes of the keys, of eight bits a member up to MOST_BITS, is
    broadcast in pages of 4 kB. Rows it rules out need no shuffle to learn that they have no partner; beyond about
    MOST_BITS members it rules out less, and nothing else changes. `members` should be a written table.
    """
    bits = LEAST_BITS
    count = members.count()
    while bits < min(8 * count, MOST_BITS):
        bits *= 2
    slot = F.pmod(F.xxhash64(*keys), F.lit(bits))
    page, mask = free_name(rows, "__page"), free_name(rows, "__bits")
    pages = (
        members.select(slot.alias("_slot"))
        .groupBy(F.bitmap_bucket_number("_slot").alias(page))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias(mask))
    )
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(mask, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    held = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    looked_up = rows.withColumn(page, F.bitmap_bucket_number(slot)).join(F.broadcast(pages), page, "left")
    return looked_up.withColumn(flag, held).drop(page, mask)


def drop_ids(docs: DataFrame, gone: DataFrame, id_col: str) -> DataFrame:
    """`docs` without the ids in `gone`, a written table of one column `id_col`; rows without an id stay.

    Only rows that may be dropped are shuffled.
    """
    flag = free_name(docs, "__maybe")
    marked = maybe_in(docs, gone, [id_col], flag)
    doubtful = marked.where(F.col(flag)).join(gone.hint("merge"), id_col, "left_anti")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return marked.where(~F.col(flag)).select(*columns).unionByName(doubtful.select(*columns))

"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming search, exact check.

Words are runs of letters and digits in lower case. A document leaks an item if one of its windows, of
the item's number of words, has a weighted shingle similarity of at least `SIMILARITY` with it:
five-word shingles weighted by how often they occur,
sum of the smaller weights over sum of the larger ones.

1. Windows. Without a shared shingle the similarity is 0, so windows are laid only where a
   shingle of some item occurs, at the offset and size it has there. That drops no match.
2. Fingerprints. The 60-bit SimHash of a window's words is looked up among those of all items of the same
   size; items at most RADIUS bits away are its candidates.
3. Multi-index search. The fingerprint is cut into BLOCKS blocks; of two fingerprints at most
   RADIUS bits apart one block differs in at most RADIUS // BLOCKS bits, so looking up all
   block values that near finds every fingerprint within the radius.
4. Second source. An item that placed a window and is more than RADIUS bits away from it is a candidate too, so that no
   match is lost to the spread of the fingerprints. `far=False` leaves it out.
5. Exact check on the words themselves.

All joins are the same at any number of items: positions whose shingle no item has are ruled out by a bitmap of bounded
size, the others are joined by a shuffle with hot keys dealt over tasks, and words are fetched again only for windows.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from tabloom.llm.common import bind, drop_ids, maybe_in, salted_join, written

SHINGLE = 5
SIMILARITY = 0.75
BITS, BLOCKS = 60, 5
# One changed word of 15 moves 7 bits of 60 in the mean (angle 0.37 of pi), with a spread of 2.5.
RADIUS = 14


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits; an empty array for null."""
    cleaned = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    # a separator at either end leaves an empty string there
    return F.filter(cleaned, lambda w: w != "")


def _gram(words: str, start: Column, size: int) -> Column:
    return F.xxhash64(F.lit(size), *(F.get(F.col(words), start + i) for i in range(size)))


def simhash(words: Column) -> Column:
    """60-bit SimHash: bit b is set where more than half of the words have bit b in their hash."""

    def bit(hashes: Column, b: Column) -> Column:
        most = 2 * F.size(F.filter(hashes, lambda h: F.getbit(h, b) == 1)) > F.size(hashes)
        return F.when(most, F.call_function("shiftleft", F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long"))

    bits = bind(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda hashes: F.transform(F.sequence(F.lit(0), F.lit(BITS - 1)), lambda b: bit(hashes, b)),
    )
    return F.aggregate(bits, F.lit(0).cast("long"), lambda all_bits, bit: all_bits.bitwiseOR(bit))


def _block(fingerprint: Column, number: int) -> Column:
    width = BITS // BLOCKS
    return F.shiftright(fingerprint, number * width).bitwiseAND(F.lit((1 << width) - 1))


def _block_keys(fingerprint: Column) -> Column:
    return F.array(*(_block(fingerprint, i) + (i << BITS // BLOCKS) for i in range(BLOCKS)))


def _near_masks() -> list[int]:
    width, reach = BITS // BLOCKS, RADIUS // BLOCKS
    return [sum(1 << b for b in bits) for k in range(reach + 1) for bits in combinations(range(width), k)]


def _weighted_overlap(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted Jaccard similarity of `_window` and `_item_words` (arrays of words of one size) per row."""
    size = F.least(F.lit(SHINGLE), F.size("_item_words"))

    def shingles(words: str) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(words) - size + 1), lambda i: F.array_join(F.slice(F.col(words), i, size), " ")
        )

    def similarity(own: Column, other: Column) -> Column:
        common = F.aggregate(
            F.array_distinct(own),
            F.lit(0),
            lambda n, s: n
            + F.least(F.size(F.filter(own, lambda x: x == s)), F.size(F.filter(other, lambda x: x == s))),
        )
        return common / (F.size(own) + F.size(other) - common)

    value = bind(shingles("_window"), lambda own: bind(shingles("_item_words"), lambda other: similarity(own, other)))
    return pairs.select(*keys, value.alias("similarity"))


def _grams(rows: DataFrame, words: str, lengths: list[int], at: str) -> DataFrame:
    """A row per shingle of `words`, with its place and hash: of five words, or of all words of a shorter item."""
    every = None
    for length in lengths:
        fitting = rows.where(F.size(words) >= length)
        if "item_id" in rows.columns:
            fitting = fitting.where(F.least(F.lit(SHINGLE), F.size(words)) == length)
        placed = fitting.withColumn(at, F.explode(F.sequence(F.lit(0), F.size(words) - length)))
        found = placed.withColumn("_gram", _gram(words, F.col(at), length)).drop(words)
        every = found if every is None else every.unionByName(found)
    return every


def _near(prints: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_size, _own_print, _n, item_id): the items within RADIUS bits of each fingerprint of windows."""
    masks = F.array(*(F.lit(m).cast("long") for m in _near_masks()))
    distinct = benchmark.select("_size", "_print").distinct()
    index = (
        distinct.withColumn("_key", F.explode(_block_keys(F.col("_print"))))
        .withColumn("_mask", F.explode(masks))
        .select("_size", "_print", F.col("_key").bitwiseXOR(F.col("_mask")).alias("_key"))
    )
    pairs = (
        prints.withColumn("_key", F.explode(_block_keys(F.col("_own_print"))))
        .join(index, ["_size", "_key"])
        .where(F.bit_count(F.col("_own_print").bitwiseXOR(F.col("_print"))) <= RADIUS)
        .select("_size", "_own_print", "_n", "_print")
        .distinct()
    )
    return pairs.join(benchmark.select("_size", "_print", "item_id").distinct(), ["_size", "_print"]).drop("_print")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    *,
    far: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, item_id, similarity): the items each document leaks, with the best window's similarity.

    Items of fewer than five words count as one shingle and leak where that run of words occurs.
    Items and documents without words never match; documents shorter than an item are compared as
    they are if the missing words are at an end: windows are clipped to the document. Rows without an id are left out; rows that repeat an
    id are searched each, and their findings meet under it. An empty table gives an empty result.
    """
    benchmark = written(
        items.where(F.col(item_id_col).isNotNull())
        .select(F.col(item_id_col).alias("item_id"), words_of(F.col(item_text_col)).alias("_item_words"))
        .where(F.size("_item_words") > 0)
        .withColumn("_size", F.size("_item_words"))
        .withColumn("_print", simhash(F.col("_item_words"))),
        "leak-items",
    )
    lengths = sorted(r[0] for r in benchmark.select(F.least(F.lit(SHINGLE), "_size")).distinct().collect())
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("_row"), F.col(text_col).alias("_text")
    )
    if not lengths:
        return texts.select("doc_id", F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
                            F.lit(0.0).alias("similarity")).where("false")

    text, window = ["doc_id", "_row"], ["doc_id", "_row", "_lo", "_size"]
    known = written(_grams(benchmark, "_item_words", lengths, "_offset").distinct(), "leak-grams")
    members = written(known.select("_gram").distinct(), "leak-members")
    places = _grams(texts.select(*text, words_of(F.col("_text")).alias("_words")), "_words", lengths, "_at")
    places = written(maybe_in(places, members, ["_gram"]).where("_maybe").drop("_maybe"), "leak-places")
    # Grams that occur, with how often they do: a hot one is one row per task before the shuffle.
    counted = written(known.join(places.groupBy("_gram").agg(F.count("*").alias("_n")), "_gram"), "leak-counted")
    hits = salted_join(places, counted, ["_gram"], "_n", F.struct(*text, "_at"), unique=False)
    placed = written(
        hits.select(*text, (F.col("_at") - F.col("_offset")).alias("_lo"), "_size", "item_id", "_print").distinct(), "leak-placed"
    )

    # A text is cut into words again once, whatever the number of its windows.
    needed = written(placed.groupBy(*text).agg(F.collect_set(F.struct("_lo", "_size")).alias("_wanted")), "leak-needed")
    wanted = maybe_in(texts, needed, text).where("_maybe").drop("_maybe").join(needed.hint("merge"), text)

    def windows_of(words: Column) -> Column:
        def cut(w: Column) -> Column:
            first = F.greatest(w["_lo"], F.lit(0))
            last = F.least(w["_lo"] + w["_size"], F.size(words))
            return F.struct(w["_lo"].alias("_lo"), w["_size"].alias("_size"), F.slice(words, first + 1, last - first).alias("_window"))

        return F.transform("_wanted", cut)

    cut = wanted.select(*text, F.explode(bind(words_of(F.col("_text")), windows_of)).alias("_cut"))
    windows = written(
        cut.select(*text, "_cut.*").distinct().withColumn("_own_print", simhash(F.col("_window"))), "leak-windows"
    )
    # Copies of a passage are one fingerprint in the search.
    prints = windows.groupBy("_size", "_own_print").agg(F.count("*").alias("_n"))
    near = written(_near(prints, benchmark), "leak-near")
    found = salted_join(windows, near, ["_size", "_own_print"], "_n", F.struct(*window), unique=False).select(
        "doc_id", "_window", "item_id"
    )
    if far:
        beyond = placed.join(windows, window).where(F.bit_count(F.col("_own_print").bitwiseXOR(F.col("_print"))) > RADIUS)
        found = found.unionByName(beyond.select("doc_id", "_window", "item_id"))
    found = written(found, "leak-candidates")
    words = written(
        benchmark.select("item_id", "_item_words").distinct().join(
            found.groupBy("item_id").agg(F.count("*").alias("_n")), "item_id"
        ),
        "leak-words",
    )
    # rows that repeat an item id with other words are items each
    candidates = salted_join(found, words, ["item_id"], "_n", F.struct("doc_id", "_window"), unique=False)
    candidates = candidates.select("doc_id", "item_id", "_window", "_item_words")
    checked = _weighted_overlap(candidates, ["doc_id", "item_id"]).where(F.col("similarity") >= SIMILARITY)
    return checked.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity"))


def leaked_items(docs: DataFrame, items: DataFrame, **names: str) -> DataFrame:
    """(doc_id, leaked, n_items, item_ids): one row per row of `docs` with an id."""
    id_col = names.get("id_col", "doc_id")
    leaks = find_leaks(docs, items, **names).groupBy("doc_id").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"))
    every = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("doc_id"))
    empty = F.array().cast(leaks.schema["item_ids"].dataType)
    return every.join(leaks, "doc_id", "left").select(
        "doc_id",
        F.col("item_ids").isNotNull().alias("leaked"),
        F.coalesce(F.size(F.coalesce("item_ids", empty)), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", empty).alias("item_ids"),
    )


def drop_leaks(docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without those that leak an item; rows without an id are kept."""
    leaking = written(
        find_leaks(docs, items, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias(id_col)).distinct(),
        "leak-ids",
    )
    return drop_ids(docs, leaking, id_col)

"""Near-duplicate groups: banded MinHash candidates, Bayesian pruning, exact verification.

Two documents are linked when their sets of distinct five-word shingles have a Jaccard
similarity of at least 3/4. All documents with the same set form a class first; only the smallest id
of a class is compared.

1. A signature of 128 MinHash values in 32 bands of 4. A pair at similarity 0.75 shares no
   band with probability (1 - 0.75^4)^32 = 5e-6.
2. In each bucket (band and value) every member is paired with two others: one drawn by hash, another one in each band,
   and the one that shares most buckets with other documents, which is the original where
   copies were edited apart. A bucket of m members gives less than 2 m pairs. Signatures of a pair are
   compared 32 values at a time; it is dropped once the posterior probability of a
   similarity of 0.75 (uniform prior) is below MISS. Of what survives, each document's best
   FIRST pairs are verified on the full sets.
3. The links found so far join most documents of a bucket. All other pairs of a bucket that could join two
   components - no cap - are compared in blocks: pruned by their signatures, then verified on the full sets
   where they stand, unless the block has joined their components by then.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from tabloom.llm.arrow import in_arrow, slices
from tabloom.llm.common import drop_ids, maybe_in, salted_join, written
from tabloom.llm.components import components

SHINGLE = 5
SHARE, OF = 75, 100  # linked when OF * intersection >= SHARE * union
BANDS, ROWS = 32, 4
VALUES = BANDS * ROWS
STEP = 32  # signature values per comparison
MISS = 1e-5
FIRST = 3
BLOCK = 512
PIECE_BYTES = 1 << 21  # texts are hashed in pieces of about this size

_draw = np.random.default_rng(20240)
_WORD_FACTORS = _draw.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PERMUTATIONS = _draw.integers(0, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _draw.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts in order, and the number of words of each text."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)
    ends = np.concatenate([[0], np.cumsum(full.to_numpy(zero_copy_only=False))])
    bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    counts = np.diff(ends[bounds])
    coded = words.filter(full).dictionary_encode()
    known = np.fromiter(
        (xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary)
    )
    return known[coded.indices.to_numpy()], counts


def _shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of shingle hashes of each text."""
    words, counts = _word_hashes(texts)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(len(words) - SHINGLE + 1, 0), np.uint64)
        for i, factor in enumerate(_WORD_FACTORS):
            rolled += words[i : i + len(rolled)] * factor
        rolled = _mixed(rolled)
        at = 0
        for n in counts:
            if n >= SHINGLE:
                yield np.unique(rolled[at : at + n - SHINGLE + 1])
            elif n:
                short = (words[at : at + n] * _WORD_FACTORS[:n]).sum(dtype=np.uint64) + _SHORT_FACTOR * np.uint64(n)
                yield _mixed(np.array([short], np.uint64))
            else:
                yield np.empty(0, np.uint64)
            at += n


def _signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(VALUES, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for at in range(0, len(shingles), 2048):
            np.minimum(least, (shingles[at : at + 2048, None] * _PERMUTATIONS).min(axis=0), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _bands(signature: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        keys = (signature.reshape(BANDS, ROWS) * _BAND_FACTORS).sum(axis=1, dtype=np.uint64)
        return _mixed(keys + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, 1, PIECE_BYTES):
            sets = list(_shingle_sets(piece.column(1)))
            signatures = [_signature(s) if len(s) else None for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    pa.array([None if s is None else s.tobytes() for s in signatures], pa.binary()),
                ],
                ["doc_id", "n_shingles", "digest", "signature"],
            )


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = np.repeat(batch.column(0).to_numpy(), BANDS)
        keys = [_bands(np.frombuffer(s, np.uint32)) for s in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64)), pa.array(ids)], ["key", "id"]
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, 1, PIECE_BYTES):
            held = [s.tobytes() for s in _shingle_sets(piece.column(1))]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(held, pa.binary())], ["id", "shingles"])


def least_matches(step: int = STEP, values: int = VALUES, miss: float = MISS) -> list[int]:
    """For each number of compared values, the fewest matches that keep a pair.

    With a uniform prior and m of n values equal, the similarity is Beta(m + 1, n - m + 1)
    distributed, and it is at least t with probability P(Binomial(n + 1, t) <= m).
    """
    t = SHARE / OF
    kept = []
    for n in range(step, values + 1, step):
        total = 0.0
        for m in range(n + 1):
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                kept.append(m)
                break
    return kept


def _matches(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of equal values of each pair of signatures; -1 where the pair was pruned on the way."""
    alive = np.arange(len(left))
    found = np.full(len(left), -1)
    counts = np.zeros(len(left), int)
    for i, least in enumerate(least_matches()):
        part = slice(i * STEP, (i + 1) * STEP)
        counts = counts + (left[alive, part] == right[alive, part]).sum(axis=1)
        alive, counts = alive[counts >= least], counts[counts >= least]
    found[alive] = counts
    return found


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, VALUES)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, signatures of both, alone) -> surviving (a, b, matches, alone)."""
    for batch in batches:
        found = _matches(_stack(batch.column(2)), _stack(batch.column(3)))
        keep = found >= 0
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).filter(pa.array(keep)),
                batch.column(1).filter(pa.array(keep)),
                pa.array(found[keep]),
                batch.column(4).filter(pa.array(keep)),
            ],
            ["a", "b", "matches", "alone"],
        )


def _enough(left: np.ndarray, right: np.ndarray) -> bool:
    common = len(np.intersect1d(left, right, assume_unique=True))
    return OF * common >= SHARE * (len(left) + len(right) - common)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, sets of both) -> linked (a, b)."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            keep.append(_enough(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)))
        keep = pa.array(keep, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], ["a", "b"])


def _compare_blocks(table: pa.Table) -> pa.Table:
    """Links between two blocks that join components; fewer than the blocks have rows."""
    side = table.column("side").to_numpy()
    ids, labels = table.column("id").to_numpy(), table.column("label").to_numpy()
    signatures = _stack(table.column("signature"))
    sets = table.column("shingles")
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    component = {label: label for label in labels.tolist()}

    def root(label: int) -> int:
        while component[label] != label:
            component[label] = label = component[component[label]]
        return label

    held: dict[int, np.ndarray] = {}

    def shingles(row: int) -> np.ndarray:
        if row not in held:
            if len(held) > 2 * BLOCK:
                held.clear()
            held[row] = np.frombuffer(sets[row].as_py(), np.uint64)
        return held[row]

    a, b = [], []
    for i in left.tolist():
        others = right[labels[right] != labels[i]]
        near = others[_matches(np.broadcast_to(signatures[i], (len(others), VALUES)), signatures[others]) >= 0]
        for j in near.tolist():
            one, two = root(int(labels[i])), root(int(labels[j]))
            if one != two and _enough(shingles(i), shingles(j)):
                component[max(one, two)] = min(one, two)
                a.append(int(ids[i]))
                b.append(int(ids[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) of `pairs` that are linked, decided on the full sets."""
    one = sets.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    two = sets.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return written(both.transform(in_arrow, _verify, "a long, b long"), "minhash-links")


def _block_links(crowded: DataFrame, labels: DataFrame, compared: DataFrame) -> DataFrame:
    """Links within one bucket and between two components, found block by block.

    `crowded` has the members (key, id, n) of all buckets of n > 1 rows, `compared` signature and shingles of each
    id. Members of a large component of a bucket get blocks of their own, so that no two blocks of
    one component are compared.
    """
    placed = crowded.where("n > 2").join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"))
    mixed = written(mixed.where("x <> y").select("key", "n"), "minhash-mixed")
    inside = written(salted_join(placed, mixed, ["key"], "n", F.col("id")), "minhash-inside")
    large = written(
        inside.groupBy("key", "label").agg(F.count("*").alias("large")).where(F.col("large") >= BLOCK), "minhash-large"
    )
    owner = F.when(F.col("large").isNotNull(), F.col("label"))
    parts = F.ceil(F.coalesce("large", "n") / BLOCK)
    members = written(
        salted_join(inside, large, ["key", "label"], "large", F.col("id"), "left").select(
            "key", "id", "label", owner.alias("owner"), F.pmod(F.xxhash64("id"), parts).cast("int").alias("part")
        ),
        "minhash-members",
    )
    blocks = members.select("key", "owner", "part").distinct()
    one = blocks.select("key", F.col("owner").alias("o1"), F.col("part").alias("p1"))
    two = blocks.select("key", F.col("owner").alias("o2"), F.col("part").alias("p2"))
    apart = (
        # two blocks of small components, each pair once
        (F.col("o1").isNull() & F.col("o2").isNull() & (F.col("p1") <= F.col("p2")))
        | (F.col("o1").isNull() & F.col("o2").isNotNull())
        | (F.col("o1") < F.col("o2"))
    )
    meetings = one.join(two, "key").where(apart)
    described = members.join(compared, "id")

    def sided(number: int) -> DataFrame:
        meet = meetings.withColumnRenamed("key", "bucket")
        return described.join(
            meet,
            (F.col("key") == F.col("bucket"))
            & F.col("owner").eqNullSafe(F.col(f"o{number}"))
            & (F.col("part") == F.col(f"p{number}")),
        ).select("bucket", "o1", "p1", "o2", "p2", "id", "label", "signature", "shingles", F.lit(number - 1).alias("side"))

    both = sided(1).unionByName(sided(2))
    links = both.groupBy("bucket", "o1", "p1", "o2", "p2").applyInArrow(_compare_blocks, "a long, b long")
    return written(links.distinct(), "minhash-links")


def _repeated_ids(signed: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between the classes of the sets of one id."""
    sets = signed.where("n_shingles > 0").select(F.col("doc_id").alias("own"), "digest")
    several = sets.groupBy("own").agg(F.min("digest").alias("x"), F.max("digest").alias("y")).where("x <> y").select("own")
    placed = sets.join(several, "own", "left_semi").distinct().join(classes.select("digest", "id"), "digest")
    least = placed.groupBy("own").agg(F.min("id").alias("a"))
    return written(placed.join(least, "own").where("a <> id").select("a", F.col("id").alias("b")).distinct(), "minhash-repeated")


def near_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs` with an id.

    Words are runs of anything but ASCII white space, A-Z in lower case; fewer than five words are
    one shingle. Null texts and texts without words have no shingles and are linked with nothing.
    `component_id` is the smallest id reachable over links; `kept` marks that row. Rows that
    repeat an id are one document with several sets: what is linked to one of them is linked to it. An empty table gives an empty result.
    """
    texts = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")
    )
    signed = written(
        texts.transform(in_arrow, _sign, "doc_id long, n_shingles long, digest binary, signature binary"), "minhash-signed"
    )
    classes = written(
        signed.where("n_shingles > 0")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.count("*").alias("n")),
        "minhash-classes",
    )
    own = signed.where("n_shingles > 0").select(F.col("doc_id").alias("id"), "digest", "signature")
    # An id that is repeated with other texts has a row for each of its sets.
    signatures = written(
        own.join(classes.select("id", "digest"), ["id", "digest"], "left_semi").dropDuplicates(["id", "digest"]).select("id", "signature"),
        "minhash-signatures",
    )
    bands = written(signatures.transform(in_arrow, _band_rows, "key long, id long"), "minhash-bands")

    sizes = written(bands.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "minhash-buckets")
    crowded = written(salted_join(bands, sizes, ["key"], "n", F.col("id")), "minhash-crowded")
    mates = crowded.groupBy("id").agg(F.sum("n").alias("mates"))
    draw = F.struct(F.xxhash64("id", "key"), "id")
    hub = F.struct("mates", "id")
    partners = written(
        crowded.join(mates, "id").groupBy("key").agg(
            F.first("n").alias("n"), F.min(draw)["id"].alias("drawn"), F.max(hub)["id"].alias("hub")
        ),
        "minhash-partners",
    )
    stars = (
        salted_join(crowded.drop("n"), partners, ["key"], "n", F.col("id"))
        .select("id", "n", F.explode(F.array("drawn", "hub")).alias("partner"))
        .where("id <> partner")
        .groupBy("id", "partner")
        .agg((F.min("n") == 2).alias("alone"))
    )
    mine = signatures.select(F.col("id").alias("id"), F.col("signature").alias("x"))
    theirs = signatures.select(F.col("id").alias("partner"), F.col("signature").alias("y"))
    compared = (
        stars.join(mine, "id").join(theirs, "partner").select("id", "partner", "x", "y", "alone")
        .transform(in_arrow, _compare, "a long, b long, matches long, alone boolean")
    )
    # at most two partners per band in a window
    best = Window.partitionBy("a").orderBy(F.desc("matches"), "b")
    ranked = written(compared.withColumn("place", F.row_number().over(best)), "minhash-stars")

    ids = written(crowded.select("id").distinct(), "minhash-ids")
    wanted = maybe_in(texts, ids, ["id"], "__maybe").where("__maybe").drop("__maybe")
    wanted = wanted.join(ids.hint("merge"), "id", "left_semi").withColumn("_name", F.md5("text"))
    wanted = wanted.dropDuplicates(["id", "_name"]).drop("_name")
    sets = written(wanted.transform(in_arrow, _sets, "id long, shingles binary"), "minhash-sets")
    links = _linked(ranked.where(F.col("place") <= FIRST), sets).unionByName(_repeated_ids(signed, classes))

    def joined_by(found: DataFrame, name: str) -> DataFrame:
        labels = components(found).select(F.col("node").alias("id"), F.col("component").alias("label"))
        return written(labels, name)

    joined = joined_by(links, "minhash-joined")
    one = joined.select(F.col("id").alias("a"), F.col("label").alias("la"))
    two = joined.select(F.col("id").alias("b"), F.col("label").alias("lb"))
    # pairs that are a whole bucket are not seen by the blocks
    rest = ranked.where((F.col("place") > FIRST) & F.col("alone")).join(one, "a", "left").join(two, "b", "left")
    rest = rest.where(F.coalesce("la", "a") != F.coalesce("lb", "b"))
    more = _linked(rest, sets).unionByName(_block_links(crowded, joined, signatures.join(sets, "id")))
    if not more.isEmpty():
        joined = joined_by(links.unionByName(more), "minhash-joined")

    named = written(classes.join(joined, "id", "left").select("digest", "n", F.coalesce("label", "id").alias("label")), "minhash-named")
    grouped = salted_join(signed.drop("signature"), named, ["digest"], "n", F.col("doc_id"), "left")
    component = F.coalesce("label", "doc_id")
    return grouped.select(
        "doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept")
    )


def drop_near_copies(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group; rows without an id are kept."""
    gone = written(
        near_groups(docs, id_col=id_col, text_col=text_col).where("NOT kept").select(F.col("doc_id").alias(id_col)).distinct(),
        "minhash-gone",
    )
    return drop_ids(docs, gone, id_col)

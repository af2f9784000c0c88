"""Turning columns into one feature vector."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel, OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import SparseVector, VectorUDT
from pyspark.sql import Column, DataFrame, functions as F

from tabloom.functions.ranking import with_position
from tabloom.operators.profile import value_counts
from tabloom.session import fresh_path

INDEXED = "_ind"
ENCODED = "_indE"

# Labels brought to the driver, for all columns together, where the caller names no other
# number. Columns that do not fit are indexed by a join with their dictionary table instead,
# with the same result.
MAX_DRIVER_LABELS = 100_000
# A value with more than 1/SETTLED of a column's rows is looked up by broadcast; there are
# at most SETTLED of them in a column, and no other key of the join is hot.
SETTLED = 1000


@dataclass(frozen=True)
class StringDictionary:
    """Labels by column, most frequent first (ties: smallest first); index = place."""

    small: dict[str, list[str]] = field(default_factory=dict)
    large: dict[str, DataFrame] = field(default_factory=dict)  # (value, index)
    sizes: dict[str, int] = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add `<column>_ind`; null and unseen values get the index behind the last label."""
        for column, labels in self.small.items():
            df = StringIndexerModel.from_labels(
                labels, inputCol=column, outputCol=column + INDEXED, handleInvalid="keep"
            ).transform(df)
        return _index_by_join(df, self.large, self.sizes) if self.large else df


def fit_string_index(
    counts: DataFrame,
    columns: Sequence[str],
    max_labels: int = MAX_DRIVER_LABELS,
    sizes: Mapping[str, int] | None = None,
) -> StringDictionary:
    """Dictionaries from value counts, which the table has usually been scanned for already.

    `sizes`, the number of labels by column, saves a job where it is known.
    """
    counts = counts.filter(F.col("column").isin(list(columns)) & F.col("value").isNotNull())
    if sizes is None:
        per_column = counts.groupBy("column").agg(F.count("*").alias("labels"))
        sizes = {r["column"]: r["labels"] for r in per_column.collect()}
    sizes = {c: sizes.get(c, 0) for c in columns}
    fitting, total = set(), 0
    for column in sorted(columns, key=sizes.get):
        total += sizes[column]
        if total <= max_labels:
            fitting.add(column)
    # at most max_labels rows
    found = {c: [] for c in columns if c in fitting}
    for row in counts.filter(F.col("column").isin(list(found))).collect():
        found[row["column"]].append((-row["count"], row["value"]))
    labels = {c: [value for _, value in sorted(pairs)] for c, pairs in found.items()}
    large = {
        c: with_position(
            counts.filter(F.col("column") == c).select("value", "count"), F.desc("count"), F.col("value")
        ).select("value", (F.col("position") - 1).cast("double").alias("index"))
        for c in columns
        if c not in fitting
    }
    return StringDictionary(labels, large, sizes)


def string_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fit_string_index(value_counts(df, columns), columns).transform(df)


def _index_by_join(
    df: DataFrame, dictionaries: Mapping[str, DataFrame], sizes: Mapping[str, int]
) -> DataFrame:
    """Index columns whose dictionaries do not fit on the driver, all by one lookup.

    The rows are written once with a number each, so that two readings agree on it. All columns are turned into
    narrow (row, column, value) entries. Frequent values of the table itself, seen or unseen, are settled by broadcast,
    so no key of the rest is hot; the rest is joined once to the union of the dictionaries. The indexes of a row are
    gathered (one entry per column) and joined back by its number. The wide table is shuffled
    once, whatever the number of columns.
    """
    names = df.columns
    number = "_row"
    while number in names:
        number += "_"
    path = fresh_path(df.sparkSession, "numbered-rows")
    df.withColumn(number, F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    frequent = F.broadcast(_frequent_values(rows, dictionaries, sizes))

    values = F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("value")) for c in dictionaries))
    entries = rows.select(F.col(number).alias("row"), F.inline(values)).where("value IS NOT NULL")
    settled = entries.join(frequent, ["column", "value"])
    known = None
    for column, dictionary in dictionaries.items():
        labels = dictionary.select(F.lit(column).alias("column"), "value", "index")
        known = labels if known is None else known.unionByName(labels)
    path = fresh_path(df.sparkSession, "dictionaries")
    known.write.parquet(path)
    known = df.sparkSession.read.parquet(path)
    rest = entries.join(frequent, ["column", "value"], "left_anti").join(known, ["column", "value"])
    found = (
        settled.select("row", "column", "index").unionByName(rest.select("row", "column", "index"))
        .groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("column", "index"))).alias("_found"))
        .withColumnRenamed("row", number)
    )
    indexed = []
    for column in dictionaries:
        output = column + INDEXED
        nominal = {"ml_attr": {"type": "nominal", "num_vals": sizes[column] + 1, "name": output}}
        index = F.coalesce(F.try_element_at("_found", F.lit(column)), F.lit(float(sizes[column])))
        indexed.append(index.alias(output, metadata=nominal))
    return rows.join(found, number, "left").select(*(F.col(f"`{c}`") for c in names), *indexed)


def _frequent_values(
    df: DataFrame, dictionaries: Mapping[str, DataFrame], sizes: Mapping[str, int]
) -> DataFrame:
    """(column, value, index) of the values above 1/SETTLED of a column's rows, as a written table."""
    counts = value_counts(df, list(dictionaries)).filter(F.col("value").isNotNull())
    # one row per column
    totals = counts.groupBy("column").agg(F.sum("count").alias("_rows"))
    hot = counts.join(F.broadcast(totals), "column").filter(F.col("count") * SETTLED > F.col("_rows"))
    path = fresh_path(df.sparkSession, "frequent-values")
    hot.select("column", "value").write.parquet(path)
    hot = df.sparkSession.read.parquet(path)
    parts = [
        hot.filter(F.col("column") == column)
        .join(dictionary, "value", "left")
        .select("column", "value", F.coalesce("index", F.lit(float(sizes[column]))).alias("index"))
        for column, dictionary in dictionaries.items()
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    path = fresh_path(df.sparkSession, "frequent-indexes")
    union.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def one_hot_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add `<column>_indE` next to `<column>_ind`.

    Sizes come from the indexer's column metadata, so fitting reads no rows. The
    slot of unseen values is the last one, which the encoder leaves out: the
    vector is as wide as there are labels and an unseen value is all zeros.
    """
    encoder = OneHotEncoder(
        inputCols=[c + INDEXED for c in columns], outputCols=[c + ENCODED for c in columns]
    )
    return encoder.fit(df).transform(df)


def encode_categories(
    df: DataFrame, dictionary: StringDictionary, columns: Sequence[str], output: str
) -> DataFrame:
    """Index, one-hot encode and assemble in one step: one vector of all one-hot blocks.

    The labels of all columns, in order, are one vocabulary, and a row is its
    tokens: each token sets the slot that indexing and encoding would have set.
    That is one vector per row instead of one per column and row. Where a
    dictionary does not fit on the driver, the vector is made of the indexes, and
    its schema holds its width but no name for each slot: names would fill the driver.
    """
    if any(c in dictionary.large for c in columns):
        indexed = [c + INDEXED for c in columns]
        blocks = [(_hot_index(c, dictionary.sizes[d]), dictionary.sizes[d]) for c, d in zip(indexed, columns)]
        return _wide_vector(dictionary.transform(df), blocks, output).drop(*indexed)
    vocabulary = [f"{i}={label}" for i, c in enumerate(columns) for label in dictionary.small[c]]
    tokens = F.array(*(F.concat(F.lit(f"{i}="), F.col(c)) for i, c in enumerate(columns)))
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="_tokens", outputCol=output)
    return model.transform(df.withColumn("_tokens", F.array_compact(tokens))).drop("_tokens")


def assemble(df: DataFrame, columns: Sequence[str], output: str) -> DataFrame:
    """One vector of the numeric and vector columns, in the given order."""
    widths = {c: df.schema[c].metadata.get("ml_attr", {}).get("num_attrs") for c in columns}
    if sum(w or 1 for w in widths.values()) > MAX_DRIVER_LABELS:
        blocks = [(_stored_elements(c) if w else _only_element(c), w or 1) for c, w in widths.items()]
        return _wide_vector(df, blocks, output)
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def _hot_index(column: str, size: int) -> Column:
    """The (place, value) entries of a one-hot block; an index behind the last label sets no slot."""
    entry = F.struct(F.col(column).cast("int").alias("place"), F.lit(1.0).alias("value"))
    return F.filter(F.array(entry), lambda e: e["place"] < size)


def _only_element(column: str) -> Column:
    return F.array(F.struct(F.lit(0).alias("place"), F.col(f"`{column}`").cast("double").alias("value")))


def _stored_elements(vector: str) -> Column:
    stored = F.unwrap_udt(vector)
    places = F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1))
    return F.arrays_zip(places.alias("place"), stored["values"].alias("value"))


def _wide_vector(df: DataFrame, blocks: Sequence[tuple[Column, int]], output: str) -> DataFrame:
    """One sparse vector of blocks of (place, value) entries, each with its width.

    The schema says how wide the vector is. The assembler would name every slot in it, which the driver
    would hold and copy with each step of the plan.
    """
    def behind(entries: Column, shift: int) -> Column:
        return F.transform(entries, lambda e: F.struct((e["place"] + shift).alias("place"), e["value"].alias("value")))

    shifted, width = [], 0
    for entries, size in blocks:
        shifted.append(behind(entries, width))
        width += size

    @F.udf(VectorUDT())
    def vector(places: list[int], values: list[float]) -> SparseVector:
        if any(v is None or v != v for v in values):
            raise ValueError("a null or NaN cannot be part of a vector")
        return SparseVector(width, [p for p, v in zip(places, values) if v], [v for v in values if v])

    entries = F.concat(*shifted)
    made = vector(F.transform(entries, lambda e: e["place"]), F.transform(entries, lambda e: e["value"]))
    return df.withColumn(output, made).withMetadata(output, {"ml_attr": {"num_attrs": width}})


def vector_elements(vector: str, names: Iterable[str]) -> list[Column]:
    """The elements of a vector column as named double columns."""
    array = vector_to_array(vector)
    return [array[i].alias(name) for i, name in enumerate(names)]


def vector_size(vector: str) -> Column:
    """Number of elements, from the stored form of a vector; nothing is made dense."""
    stored = F.unwrap_udt(vector)
    return F.coalesce(stored["size"], F.size(stored["values"]))


def hot_positions(vector: str) -> Column:
    """Positions of the non-zero elements, in order, from the stored form of a vector."""
    stored = F.unwrap_udt(vector)
    # a dense vector has no list of positions
    places = F.coalesce(stored["indices"], F.sequence(F.lit(0), F.size(stored["values"]) - 1))
    pairs = F.arrays_zip(places.alias("place"), stored["values"].alias("value"))
    return F.transform(F.filter(pairs, lambda p: p["value"] != 0), lambda p: p["place"])


def vector_element(vector: str, position: Column) -> Column:
    """One element of a vector, from its stored form."""
    stored = F.unwrap_udt(vector)
    sparse = F.coalesce(F.get(stored["values"], F.nullif(F.array_position(stored["indices"], position), F.lit(0)).cast("int") - 1), F.lit(0.0))
    return F.when(stored["indices"].isNull(), F.get(stored["values"], position)).otherwise(sparse)

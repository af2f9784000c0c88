"""Operators on small tables, against brute force and edge cases."""

import hashlib
import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import Imputer, StringIndexer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tabloom.functions import hashing
from tabloom.functions.hashing import with_row_key
from tabloom.functions.ranking import with_position
from tabloom.operators import columns, filters, impute, linear, metrics, models, profile, sampling
from tabloom.operators import features as ft
from tabloom.operators.ordering import shuffle_rows, top_1
from tabloom.sources.csv import scan_csv_header, scan_csv_positional
from tabloom.sources.preview import describe_schema, preview_rows


@pytest.fixture(scope="module")
def letters(spark):
    """2000 rows, one value holding a third of them, nulls and sentinels mixed in."""
    draw = random.Random(7)
    rows = []
    for i in range(2000):
        value = "hot" if i % 3 == 0 else draw.choice([None, "?", *(f"v{k}" for k in range(40))])
        rows.append((str(i), value, draw.choice(["a", "b", None])))
    return spark.createDataFrame(rows, "id string, c string, d string").repartition(5)


# --- hashes ---


def test_rates_far_below_a_millionth(spark):
    assert hashing.threshold(1 / 4_000_000) == 2**60 // 4_000_000
    assert hashing.threshold(1.0) == 2**60
    drawn = spark.range(1_000_000).select(hashing.row_hash("s", F.col("id")).alias("h"))
    assert drawn.distinct().count() == 1_000_000
    assert drawn.filter(F.col("h") < hashing.threshold(1e-3)).count() == pytest.approx(1000, abs=150)


# --- positions and order ---


def test_positions_number_all_rows_with_ties(spark):
    values = [random.Random(1).randrange(20) for _ in range(500)]
    table = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int").repartition(7)
    rows = with_position(table, F.col("v"), F.col("i")).collect()
    expected = {i: p + 1 for p, (v, i) in enumerate(sorted((v, i) for i, v in enumerate(values)))}
    assert {r["i"]: r["position"] for r in rows} == expected


def test_digest_positions_take_one_shuffle_of_the_rows(letters):
    shuffled = shuffle_rows(letters, "id")
    plan = plan_of(shuffled)
    rows = [line for line in plan.split("\n") if "hashpartitioning(_range" in line]
    assert len(rows) == 2 and "rangepartitioning" not in plan  # the rows, and the counts of the ranges
    digests = sorted((hashlib.md5(f"shuffle:{r['id']}".encode()).hexdigest(), r["id"]) for r in letters.collect())
    assert {r["id"]: r["position"] for r in shuffled.collect()} == {i: p + 1 for p, (_, i) in enumerate(digests)}


def test_shuffle_does_not_depend_on_layout(letters):
    orders = [
        {r["id"]: r["position"] for r in shuffle_rows(letters.repartition(n), "id").collect()} for n in (1, 3, 8)
    ]
    assert orders[0] == orders[1] == orders[2]
    assert sorted(orders[0].values()) == list(range(1, 2001))


# --- missing values ---


def test_mode_ignores_missing_and_breaks_ties_by_value(spark):
    rows = [("?", "b"), ("?", "a"), ("?", "a"), (None, "b"), ("x", "?"), (None, None)]
    table = spark.createDataFrame(rows, "c string, d string")
    assert impute.mode_values(profile.value_counts(table, ["c", "d"])) == {"c": "x", "d": "a"}
    filled = impute.impute_mode(table, ["c", "d"]).collect()
    assert [r["c"] for r in filled] == ["x"] * 6
    assert {r["d"] for r in filled} == {"a", "b"}


def test_column_without_values_has_no_mode(spark):
    table = spark.createDataFrame([(None, "a"), ("?", "a")], "c string, d string")
    summary = {r["column"]: r for r in profile.category_summary(profile.value_counts(table, ["c", "d"])).collect()}
    assert summary["c"]["mode"] is None and summary["c"]["missing"] == 2 and summary["c"]["labels"] == 0
    assert summary["d"]["mode"] == "a" and summary["d"]["mode_count"] == 2


def test_rates_count_each_row_once(spark):
    table = spark.createDataFrame([("1",), ("?",), (None,), ("NaN",), ("n/a",), ("2",)], "v string")
    row = profile.continuous_profile(table, ["v"]).first()
    assert (row["nulls"], row["sentinels"], row["nans"]) == (3, 1, 1)
    assert row["mean"] == 1.5
    assert row["missing_pct"] == pytest.approx(4 / 6 * 100)
    again = profile.missing_rate_from_counts(profile.value_counts(table, ["v"])).first()
    assert again["missing_pct"] == pytest.approx(2 / 6 * 100)


def test_empty_table_has_null_rates(spark):
    table = spark.createDataFrame([], "v string")
    assert profile.missing_rate_categorical(table, ["v"]).first()["missing_pct"] is None


def test_mean_imputation_equals_the_library_imputer(spark):
    table = spark.createDataFrame([(1.0,), (None,), (math.nan,), (4.0,)], "v double")
    ours = [r["v_imp"] for r in impute.impute_mean(table, ["v"]).collect()]
    library = Imputer(strategy="mean", inputCols=["v"], outputCols=["v_imp"]).fit(table).transform(table)
    assert ours == [r["v_imp"] for r in library.collect()] == [1.0, 2.5, 2.5, 4.0]
    with pytest.raises(ValueError, match="every value is missing"):
        impute.impute_mean(table.filter("false"), ["v"])


def test_label_and_casts(spark):
    table = spark.createDataFrame([("0.5",), ("0",), ("-1",), ("n/a",), (None,), ("NaN",), ("12",)], "a string")
    labelled = columns.derive_binary_label(table, "a", "y").collect()
    assert [r["y"] for r in labelled] == [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0]
    assert filters.drop_any_missing(columns.cast_double(table)).count() == 4
    assert columns.drop_columns(table, ["nothing"]).columns == ["a"]


# --- sampling ---


def test_split_is_complete_and_layout_free(letters):
    parts = []
    for n in (1, 3, 8):
        train, test = sampling.split_train_test(letters.repartition(n), "id")
        a, b = {r["id"] for r in train.collect()}, {r["id"] for r in test.collect()}
        assert not a & b and len(a | b) == 2000
        parts.append(a)
    assert parts[0] == parts[1] == parts[2]
    assert 0.65 < len(parts[0]) / 2000 < 0.75


def test_rows_without_a_key_are_kept(spark):
    table = spark.createDataFrame([(None, 1), ("a", 2)], "id string, v int")
    train, test = sampling.split_train_test(table, "id")
    assert train.count() + test.count() == 2


def test_undersampling(spark):
    table = spark.range(1000).select(
        F.col("id").cast("string").alias("id"), F.when(F.col("id") < 100, 1.0).otherwise(0.0).alias("y")
    )
    kept = sampling.undersample_majority(table, "id", "y")
    assert kept.filter("y = 1").count() == 100
    assert 60 < kept.filter("y = 0").count() < 140
    more_ones = table.withColumn("y", 1 - F.col("y"))
    assert sampling.undersample_majority(more_ones, "id", "y").count() == 1000
    with pytest.raises(ValueError, match="nothing to balance"):
        sampling.undersample_majority(table.withColumn("y", F.lit(0.0)), "id", "y")


def test_union_keeps_duplicates(letters):
    assert sampling.union_all(letters, letters).count() == 4000


def test_row_key_separates_null_from_empty(spark):
    table = spark.createDataFrame([("a", None), ("a", ""), ("a", None)], "x string, y string")
    assert with_row_key(table).select("row_id").distinct().count() == 2


# --- encoding ---


def test_index_equals_the_library_indexer(letters):
    ours = ft.string_index(letters, ["c", "d"])
    library = StringIndexer(
        inputCols=["c", "d"], outputCols=["c_lib", "d_lib"], handleInvalid="keep"
    ).fit(letters).transform(ours)
    assert library.filter("c_ind <> c_lib OR d_ind <> d_lib").count() == 0


@pytest.mark.parametrize("settled", [1, 3, 20, 1000])
def test_index_by_join_equals_index_by_dictionary(letters, settled, monkeypatch):
    monkeypatch.setattr(ft, "SETTLED", settled)
    counts = profile.value_counts(letters, ["c", "d"])
    small = ft.fit_string_index(counts, ["c", "d"])
    large = ft.fit_string_index(counts, ["c", "d"], max_labels=5)
    assert list(small.small) == ["c", "d"] and list(large.small) == ["d"] and list(large.large) == ["c"]
    unseen = letters.withColumn("c", F.when(F.col("id") == "5", "new").otherwise(F.col("c")))
    a = {r["id"]: (r["c_ind"], r["d_ind"]) for r in small.transform(unseen).collect()}
    b = {r["id"]: (r["c_ind"], r["d_ind"]) for r in large.transform(unseen).collect()}
    assert a == b and len(a) == 2000
    assert a["5"][0] == small.sizes["c"]


def test_unseen_value_on_a_third_of_the_rows_is_settled_by_broadcast(letters):
    counts = profile.value_counts(letters, ["c"])
    large = ft.fit_string_index(counts, ["c"], max_labels=0)
    unseen = letters.withColumn("c", F.when(F.col("c") == "hot", "new").otherwise(F.col("c")))
    frequent = ft._frequent_values(unseen, large.large, large.sizes)
    assert frequent.filter("value = 'new'").first()["index"] == large.sizes["c"]
    rows = large.transform(unseen).filter("c = 'new'")
    assert rows.count() == 667 and rows.filter(F.col("c_ind") != large.sizes["c"]).isEmpty()


def plan_of(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize("columns", [1, 4, 9])
def test_index_by_join_shuffles_the_table_once(letters, columns):
    names = [f"e{i}" for i in range(columns)]
    table = letters.withColumns({n: F.concat(F.lit(n), "c") for n in names})
    large = ft.fit_string_index(profile.value_counts(table, names), names, max_labels=0)
    plan = plan_of(large.transform(table))
    exchanges = [line for line in plan.split("\n") if ") Exchange" in line]
    wide = [line for line in plan.split("\n") if line.startswith("Input") and all(f"{n}#" in line for n in [*names, "id"])]
    assert len(exchanges) <= 4  # entries, dictionaries, folded entries, rows
    assert "NestedLoop" not in plan and wide


def test_index_by_join_keeps_columns_of_any_name(letters):
    table = letters.withColumnRenamed("d", "_row").withColumn("a.b", F.lit(1))
    large = ft.fit_string_index(profile.value_counts(table, ["c"]), ["c"], max_labels=0)
    found = large.transform(table)
    assert found.columns == [*table.columns, "c_ind"]
    assert found.drop("c_ind").exceptAll(table).isEmpty() and found.count() == 2000


def test_stored_vectors_are_read_as_they_are(spark):
    from pyspark.ml.linalg import Vectors

    vectors = [Vectors.sparse(5, [1, 4], [2.0, 3.0]), Vectors.dense([0.0, 2.0, 0.0, 0.0, 3.0]), Vectors.sparse(3, [], [])]
    table = spark.createDataFrame([(v,) for v in vectors], ["v"])
    rows = table.select(
        ft.vector_size("v"), ft.hot_positions("v"), ft.vector_element("v", F.lit(1)), ft.vector_element("v", F.lit(2))
    ).collect()
    assert [tuple(r) for r in rows] == [(5, [1, 4], 2.0, 0.0), (5, [1, 4], 2.0, 0.0), (3, [], 0.0, 0.0)]


def test_one_step_encoding_equals_three_steps(letters):
    counts = profile.value_counts(letters, ["c", "d"])
    small = ft.fit_string_index(counts, ["c", "d"])
    large = ft.fit_string_index(counts, ["c", "d"], max_labels=5)
    unseen = letters.withColumn("c", F.when(F.col("id") == "5", "new").otherwise(F.col("c")))

    def rows(df):
        return {r["id"]: list(r["v"]) for r in df.select("id", vector_to_array("v").alias("v")).collect()}

    three = ft.assemble(ft.one_hot_encode(small.transform(unseen), ["c", "d"]), ["c_indE", "d_indE"], "v")
    one = ft.encode_categories(unseen, small, ["c", "d"], "v")
    joined = ft.encode_categories(unseen, large, ["c", "d"], "v")
    assert rows(one) == rows(three) == rows(joined)
    assert sum(rows(one)["5"][: small.sizes["c"]]) == 0


# --- metrics ---


def _scored(spark, pairs):
    return spark.createDataFrame(pairs, "label double, score double")


def _brute_auc(pairs):
    ones, zeros = [s for y, s in pairs if y == 1], [s for y, s in pairs if y == 0]
    won = sum((p > q) + (p == q) / 2 for p in ones for q in zeros)
    return won / (len(ones) * len(zeros))


@pytest.mark.parametrize("levels", [1, 2, 5, 1000])
def test_auc_with_ties(spark, levels):
    draw = random.Random(levels)
    pairs = [(float(draw.random() < 0.3), float(draw.randrange(levels)) / 7) for _ in range(400)]
    scored = _scored(spark, pairs)
    assert metrics.auc_roc(scored).first()["auc"] == pytest.approx(_brute_auc(pairs), abs=1e-12)
    library = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert metrics.auc_roc(scored).first()["auc"] == pytest.approx(library.evaluate(scored), abs=1e-9)


def test_auc_with_one_hot_score_and_far_values(spark):
    pairs = [(float(i % 2), 0.5) for i in range(200)] + [(1.0, 1e300), (0.0, -1e300), (0.0, float("-inf"))]
    assert metrics.auc_roc(_scored(spark, pairs)).first()["auc"] == pytest.approx(_brute_auc(pairs))


def test_auc_buckets_hold_equal_shares_of_distinct_scores(spark):
    """Also where 99 of 100 rows have one score."""
    rows = spark.range(200_000).selectExpr("CAST(id % 2 AS DOUBLE) AS label", "if(id % 100 = 0, id / 7, 0.5) AS score")
    sizes = [r["count"] for r in metrics.by_score(rows, 100).groupBy("bucket").count().collect()]
    assert sum(sizes) == 2001 and max(sizes) <= 300


def test_auc_of_many_scores_in_small_buckets(spark, monkeypatch):
    """A million distinct scores; buckets stay small and are added up on two levels."""
    monkeypatch.setattr(metrics, "BUCKETS_TOGETHER", 8)
    rows = spark.range(1_000_000).selectExpr("CAST(id % 3 = 0 AS DOUBLE) AS label", "id * 7919 % 1000003 / 13.0D AS score")
    counts = metrics.by_score(rows, 25_000)
    assert max(r["count"] for r in counts.groupBy("bucket").count().collect()) <= 60_000
    fine = metrics.auc_roc(rows, bucket_scores=25_000).first()["auc"]
    assert fine == pytest.approx(metrics.auc_roc(rows).first()["auc"], abs=1e-12)


def test_auc_of_one_class_is_null(spark):
    assert metrics.auc_roc(_scored(spark, [(1.0, 0.2), (1.0, 0.4)])).first()["auc"] is None


def test_two_stage_report(spark):
    rows = [(1.0, 1.0, 5.0, 7.0), (0.0, 0.0, 0.0, 9.0), (0.0, 1.0, 0.0, 1.0), (1.0, 0.0, 3.0, 3.0)]
    table = spark.createDataFrame(rows, "label double, prediction double, y double, combo_prediction double")
    assert tuple(metrics.two_stage_report(table, "label", "y").first()) == (0.5, 2.5, 1.5, 2)


def test_regression_report(spark):
    table = spark.createDataFrame([(1.0, 2.0), (3.0, 0.0)], "y double, prediction double")
    row = metrics.regression_report(table, "y").first()
    assert (row["mse"], row["mae"], row["scored_rows"]) == (5.0, 2.0, 2)


def test_label_check(spark):
    table = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,)], "label double")
    with pytest.raises(ValueError, match="2 rows"):
        models.check_binary(table, "label")
    models.check_binary(table.limit(2), "label")


# --- sources ---


def test_csv_round_trips(spark, tmp_path):
    table = spark.createDataFrame([("a b", None, "?"), ("x,y", "NaN", '"q"')], "`m-1 x` string, b string, c string")
    table.write.csv(str(tmp_path / "plain"))
    names = ["m-1 x", "b", "c"]
    assert sorted(scan_csv_positional(spark, str(tmp_path / "plain"), names).collect(), key=str) == sorted(
        table.collect(), key=str
    )
    table.write.csv(str(tmp_path / "headed"), header=True)
    for read in (scan_csv_header(spark, str(tmp_path / "headed"), names),
                 scan_csv_header(spark, str(tmp_path / "headed"), None)):
        assert read.columns == names
        assert sorted(read.collect(), key=str) == sorted(table.collect(), key=str)
    with pytest.raises(Exception, match="header"):
        scan_csv_header(spark, str(tmp_path / "headed"), ["m-1 x", "b", "z"]).collect()


def test_preview_and_schema(letters):
    assert [r["id"] for r in preview_rows(letters, 3, key="id").collect()] == ["0", "1", "10"]
    described = describe_schema(letters).collect()
    assert [(r["pos"], r["name"], r["type"]) for r in described] == [
        (0, "id", "string"), (1, "c", "string"), (2, "d", "string")
    ]
    assert described[0]["present"] == 2000


def test_top_1(letters):
    assert top_1(profile.value_counts(letters, ["c"])).first()["value"] == "hot"


def test_vector_elements(spark):
    table = spark.createDataFrame([([1.0, 2.0],)], "a array<double>").select(array_to_vector("a").alias("v"))
    assert table.select(*ft.vector_elements("v", ["x", "y"])).first().asDict() == {"x": 1.0, "y": 2.0}


def test_wide_vectors_equal_assembled_ones_and_name_no_slot(spark, monkeypatch):
    rows = spark.createDataFrame(
        [(1, "a", "x", 0.0, 2.5), (2, "b", "y", 3.0, 0.0), (3, "c", "x", -1.0, 7.0), (4, "b", "z", 5.0, 1.0)],
        "id int, p string, q string, u double, v double",
    )

    def vectors(max_labels):
        dictionary = ft.fit_string_index(profile.value_counts(rows, ["p", "q"]), ["p", "q"], max_labels)
        encoded = ft.encode_categories(rows, dictionary, ["p", "q"], "categories")
        return ft.assemble(encoded, ["u", "categories", "v"], "vector")

    narrow = {r["id"]: r["vector"].toArray().tolist() for r in vectors(100).collect()}
    monkeypatch.setattr(ft, "MAX_DRIVER_LABELS", 3)
    wide = vectors(0)
    assert {r["id"]: r["vector"].toArray().tolist() for r in wide.collect()} == narrow
    assert wide.schema["vector"].metadata == {"ml_attr": {"num_attrs": 8}}


def test_ridge_holds_only_elements_that_occur(spark):
    rows = spark.createDataFrame(
        [(Vectors.sparse(10**7, [5, 9_000_000 + i % 3], [float(i), 1.0]), float(2 * i + i % 3)) for i in range(30)]
    ).toDF("features", "y")
    model = linear.fit_ridge(rows, "features", "y", 1e-6)
    assert model.coefficients.size == 10**7 and len(model.coefficients.indices) == 4
    error = model.transform(rows).agg(F.max(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert error < 1e-2

"""Whole workflows: invariants of learned models, layout independence, edge cases, plans."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabloom import jobs, session
from tabloom.config import CLAIMS, CLAIMS_COLUMNS, SIGNAL_COLUMNS, SIGNAL_FEATURES, ClaimsRoles
from tabloom.operators import boosting, linear, models, profile, sampling, trees, tuning
from tabloom.operators.features import assemble
from tabloom.plans import claims as claims_plan
from tabloom.plans import signal as signal_plan
from tabloom.plans.queries import KEPT_NOMINAL, QUERIES, _labelled
from tabloom.sources import derived


@pytest.fixture(scope="module")
def prepared(spark, folder):
    return signal_plan.prepare_signal(derived.signal(spark, folder)).persist()


@pytest.fixture(scope="module")
def raw_claims(spark, folder):
    return derived.claims(spark, folder)


@pytest.fixture(scope="module")
def balanced(raw_claims):
    return claims_plan.balance_and_split(raw_claims)


# --- classification ---


def test_forest_invariants(prepared):
    fitted = signal_plan.fit_classifier(prepared, models.forest())
    bad = fitted.scored.filter(
        ~F.col("prediction").isin(0.0, 1.0)
        | (F.abs(F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x) - 1) > 1e-9)
    )
    assert bad.count() == 0
    importances = {r["feature"]: r["importance"] for r in fitted.importances().collect()}
    assert list(importances) == list(SIGNAL_FEATURES)
    assert min(importances.values()) >= 0 and sum(importances.values()) == pytest.approx(1)
    report = fitted.report().first()
    assert report["auc"] > 0.9
    assert report["auc"] == pytest.approx(tuning.exact_auc().evaluate(fitted.scored), abs=1e-9)


def test_boosted_report(prepared):
    report = signal_plan.fit_classifier(prepared, models.boosted(maxIter=5)).report().first()
    assert report["auc"] > 0.9


def test_search_returns_a_grid_member(spark, prepared):
    grid = {"maxDepth": (1, 3), "maxBins": (16,), "featureSubsetStrategy": ("all", "log2")}
    tuned, fitted = signal_plan.tune_classifier(prepared, models.forest(), grid)
    table = tuned.metrics_table(spark).collect()
    assert len(table) == 4
    best = tuned.best_params(spark).first()
    assert best["avg_auc"] == max(r["avg_auc"] for r in table)
    assert int(best["maxDepth"]) == fitted.model.getMaxDepth()
    assert best["featureSubsetStrategy"] == fitted.model.getFeatureSubsetStrategy()
    assert fitted.model.getNumTrees == 3


def test_search_does_not_depend_on_layout(prepared):
    train, _ = sampling.split_train_test(prepared, "row_id")
    tables = []
    for n in (1, 3, 8):
        tuned = tuning.cross_validate(models.forest(numTrees=3), train.repartition(n), {"maxDepth": (2, 4)}, key="row_id")
        tables.append(tuned.fold_metrics)
    assert tables[0] == tables[1] == tables[2]


def test_fit_fails_on_other_labels_and_counts_no_classes(spark, prepared):
    train, _ = sampling.split_train_test(prepared, "row_id")
    assert train.schema["label"].metadata["ml_attr"]["num_vals"] == 2
    odd = train.withColumn("label", F.lit(2.0).alias("label", metadata=train.schema["label"].metadata))
    with pytest.raises(Exception, match="(?i)label"):
        models.fit(models.forest(numTrees=1), odd)


def test_ridge_by_conjugate_gradients_equals_the_library(balanced):
    train = balanced.train.filter(F.col(CLAIMS.label) == 1)
    library = models.fit(models.gaussian_glm("finalvector", CLAIMS.target), train)
    ours = linear.fit_ridge(train, "finalvector", CLAIMS.target, 0.01, "ours", tolerance=1e-10)
    assert np.array(ours.coefficients) == pytest.approx(np.array(library.coefficients), rel=1e-5, abs=1e-5)
    assert ours.intercept == pytest.approx(library.intercept, rel=1e-6)
    both = ours.transform(library.transform(train)).select("ours", "combo_prediction").collect()
    assert [r["ours"] for r in both] == pytest.approx([r["combo_prediction"] for r in both], rel=1e-6)


def test_wide_linear_models_are_solved_without_normal_equations(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.sparse(5000, [i % 7, 100 + i], [1.0, 2.0]), float(i % 7 + i / 50)) for i in range(200)]
    wide = spark.createDataFrame(rows, ["v", "y"])
    wide = wide.withColumn("v", F.col("v").alias("v", metadata={"ml_attr": {"num_attrs": 5000}}))
    model = models.fit(models.gaussian_glm("v", "y"), wide)
    scored = model.transform(wide)
    assert isinstance(model, linear.RidgeModel) and model.steps > 0
    met = linear.check_optimum(scored, "v", "y", "combo_prediction", model.coefficients, 0.01, 0.0, 1e-4)
    assert met.count() == 5000 and met.where("NOT met").isEmpty()
    with pytest.raises(ValueError, match="least squares"):
        models.fit(models.gaussian_glm("v", "y", family="poisson", link="log"), wide)


def test_ridge_edge_cases(spark):
    from pyspark.ml.linalg import Vectors, VectorUDT

    flat = spark.createDataFrame([(Vectors.dense([1.0, 2.0]), 3.0), (Vectors.dense([2.0, 2.0]), 3.0), (None, 9.0)], ["v", "y"])
    model = linear.fit_ridge(flat, "v", "y", 0.1)
    assert model.intercept == 3.0 and not np.array(model.coefficients).any()
    empty = linear.fit_ridge(flat.where("y < 0"), "v", "y", 0.1)
    assert (empty.intercept, empty.coefficients.size) == (0.0, 0)


def test_ridge_by_elimination_equals_the_library(balanced, monkeypatch):
    """Every position is frequent here, so the table of the others is empty."""
    train = balanced.train.filter(F.col(CLAIMS.label) == 1)
    library = models.fit(models.gaussian_glm("finalvector", CLAIMS.target), train)
    monkeypatch.setattr(linear, "HELD_POSITIONS", 0)
    ours = linear.fit_ridge(train, "finalvector", CLAIMS.target, 0.01, "ours")
    found = ours.coefficients.frequent.toArray()
    for row in ours.coefficients.others.collect():
        found[row["position"]] = row["coefficient"]
    assert found == pytest.approx(np.array(library.coefficients), rel=1e-5, abs=1e-5)
    assert ours.intercept == pytest.approx(library.intercept, rel=1e-6)


@pytest.mark.parametrize("partitions", (1, 5))
def test_wide_ridge_holds_no_vector_of_all_positions(spark, monkeypatch, partitions):
    """Groups across batches and partitions, rows without another element, two rare elements, a stored zero, a constant column."""
    from pyspark.ml.linalg import Vectors

    monkeypatch.setattr(linear, "HELD_POSITIONS", 100)
    monkeypatch.setattr(linear, "DENSE_ROWS", 7)
    monkeypatch.setattr(linear, "FREQUENT", 20)
    monkeypatch.setattr(linear, "_products", lambda *a: pytest.fail("a step of conjugate gradients"))
    rng, rows = np.random.default_rng(1), []
    for i in range(600):
        places = {i % 7: 1.0, 8: 3.0, 9: float(rng.normal(5, 2)), 10: 0.0}
        if i % 9:
            places[100 + int(rng.integers(250))] = 1.0 + i % 2
        if i % 100 == 50:
            places[20] = 2.0
        y = float(places[9] * 2 + i % 7 + rng.normal())
        rows.append((Vectors.sparse(5000, places), y))
    table = spark.createDataFrame(rows, ["v", "y"]).repartition(partitions)
    model = linear.fit_ridge(table, "v", "y", 0.01, "p")
    x, y = np.array([v.toArray() for v, _ in rows]), np.array([y for _, y in rows])
    used = x.std(0) > 1e-9
    mean, spread = x[:, used].mean(0), x[:, used].std(0)
    z = (x[:, used] - mean) / spread
    beta = np.linalg.solve(z.T @ z / len(y) + 0.01 / y.std() * np.eye(used.sum()), z.T @ (y - y.mean()) / len(y))
    scored = model.transform(table)
    expected = dict(zip(y, y.mean() + z @ beta))
    for row in scored.collect():
        assert row["p"] == pytest.approx(expected[row["y"]], abs=1e-6)
    assert scored.columns == ["v", "y", "p"] and isinstance(model.coefficients, linear.TableCoefficients)
    met = linear.check_optimum(scored, "v", "y", "p", model.coefficients, 0.01, 0.0, 1e-9)
    assert met.count() == 5000 and met.where("NOT met").isEmpty()
    assert 20 in model.coefficients.frequent.indices and len(model.coefficients.frequent.indices) < 20
    worse = linear.TableCoefficients(model.coefficients.frequent, model.coefficients.others.withColumn("coefficient", F.col("coefficient") + 1))
    wrong = linear.RidgeModel(worse, model.intercept, 1, "v", "p").transform(table)
    assert not linear.check_optimum(wrong, "v", "y", "p", worse, 0.01, 0.0, 1e-9).where("NOT met").isEmpty()


def test_ridge_with_nothing_frequent_and_with_many_meetings(spark, monkeypatch):
    """Elimination without a frequent position; conjugate gradients where no few positions keep the others apart."""
    from pyspark.ml.linalg import Vectors

    monkeypatch.setattr(linear, "FREQUENT", 2)
    monkeypatch.setattr(linear, "MOST_FREQUENT", 3)
    monkeypatch.setattr(linear, "HELD_POSITIONS", 0)
    for other, kind in ((lambda i: [], linear.TableCoefficients), (lambda i: [50 + i * 7 % 30], linear.SparseVector)):
        rows = [(Vectors.sparse(100, [i % 40, *other(i)], [1.0] * (1 + len(other(i)))), float(i % 11)) for i in range(120)]
        table = spark.createDataFrame(rows, ["v", "y"])
        model = linear.fit_ridge(table, "v", "y", 0.1, "p")
        assert isinstance(model.coefficients, kind)
        met = linear.check_optimum(model.transform(table), "v", "y", "p", model.coefficients, 0.1, 0.0, 1e-4)
        assert met.count() == 100 and met.where("NOT met").isEmpty()


def test_certificate_finds_a_wrong_model(balanced):
    model = models.fit(models.elastic_net("finalvector", CLAIMS.target, maxIter=1), balanced.train)
    scored = model.transform(balanced.train)
    met = linear.check_optimum(scored, "finalvector", CLAIMS.target, "prediction", model.coefficients, 0.1, 0.5, 5e-4)
    assert not met.where("NOT met").isEmpty()


def test_forests_are_fitted_on_a_bounded_number_of_partitions(prepared, monkeypatch):
    estimator, seen = models.forest(numTrees=1, maxDepth=2), []
    monkeypatch.setattr(type(estimator), "fit", lambda self, rows, *a: seen.append((rows.rdd.getNumPartitions(), rows.count())))
    monkeypatch.setattr(models, "FOREST_PARTITIONS", 4)
    monkeypatch.setattr(models, "FOREST_PARTITIONS_A_CORE", 0)
    for n in (3, 9):
        models.fit(estimator, prepared.repartition(n))
    assert seen == [(3, prepared.count()), (4, prepared.count())]


# --- boosting over packed blocks ---


def test_many_rows_are_boosted_without_the_librarys_trainer(prepared, monkeypatch):
    """The same first tree, and the same model but for cuts of equal gain; the library sees no training row."""
    train, test = sampling.split_train_test(prepared, "row_id")
    estimator = models.boosted(maxIter=3, maxDepth=4)
    library = models.fit(estimator, train)
    seen = []
    fit = type(estimator).fit
    monkeypatch.setattr(type(estimator), "fit", lambda self, rows, *a: seen.append(rows.count()) or fit(self, rows, *a))
    monkeypatch.setattr(boosting, "LIBRARY_ROWS", 100)
    ours = models.fit(estimator, train)
    assert seen == [2]
    assert ours.trees[0].toDebugString.split("\n")[1:] == library.trees[0].toDebugString.split("\n")[1:]
    assert ours.treeWeights == library.treeWeights and ours.numFeatures == library.numFeatures
    assert {p.name: v for p, v in ours.extractParamMap().items()} == {p.name: v for p, v in library.extractParamMap().items()}
    assert np.abs(ours.featureImportances.toArray() - library.featureImportances.toArray()).max() < 0.01
    auc = [tuning.exact_auc().evaluate(m.transform(test)) for m in (ours, library)]
    assert auc[0] == pytest.approx(auc[1], abs=0.005)


def test_packed_boosting_does_not_depend_on_layout(prepared, monkeypatch):
    monkeypatch.setattr(boosting, "LIBRARY_ROWS", 100)
    train, _ = sampling.split_train_test(prepared, "row_id")
    fits = [models.fit(models.boosted(maxIter=2, maxDepth=3), train.repartition(n)).toDebugString for n in (1, 5)]
    cuts = [[line for line in text.splitlines()[1:] if "Predict" not in line] for text in fits]
    assert cuts[0] == cuts[1] and len(cuts[0]) > 20


def test_packed_boosting_edge_cases(spark, monkeypatch):
    monkeypatch.setattr(boosting, "LIBRARY_ROWS", 1)
    classes = {"ml_attr": {"type": "nominal", "num_vals": 2}}

    def rows(values):
        table = assemble(spark.createDataFrame(values, "a double, b double, label double"), ["a", "b"], "features")
        return table.withColumn("label", F.col("label").alias("label", metadata=classes))

    flat = models.fit(models.boosted(maxIter=2), rows([(1.0, 2.0, 1.0)] * 3 + [(1.0, 2.0, 0.0)] * 2))
    assert [t.numNodes for t in flat.trees] == [1, 1]
    pure = models.fit(models.boosted(maxIter=2), rows([(float(i), 2.0, 1.0) for i in range(5)]))
    assert [t.numNodes for t in pure.trees] == [1, 1]
    with pytest.raises(Exception, match="neither 0 nor 1"):
        models.fit(models.boosted(maxIter=1), rows([(float(i), 2.0, 2.0) for i in range(5)]))


def test_a_search_boosts_many_rows_without_the_librarys_trainer(prepared, monkeypatch):
    train, _ = sampling.split_train_test(prepared, "row_id")
    estimator, grid = models.boosted(maxDepth=2), {"maxIter": (1, 2)}
    library = tuning.cross_validate(estimator, train, grid, key="row_id", folds=2)
    counts = []
    ours = boosting.fit_boosted
    monkeypatch.setattr(boosting, "fit_boosted", lambda e, rows, n: counts.append(n) or ours(e, rows, n))
    monkeypatch.setattr(boosting, "LIBRARY_ROWS", 100)
    packed = tuning.cross_validate(estimator, train, grid, key="row_id", folds=2)
    assert len(counts) == 3 and sum(counts[:2]) == counts[2] == train.count()
    for a, b in zip(library.fold_metrics, packed.fold_metrics, strict=True):
        assert a == pytest.approx(b, abs=1e-3)


def test_the_plan_of_a_boosting_round_does_not_double(spark, prepared, monkeypatch):
    """Over shuffled rows, whose plan is adaptive, as in a search."""
    train = prepared.repartition(3, "row_id").persist()
    lengths, grow = [], boosting._grow

    def measured(blocks, *args, **options):
        lengths.append(len(blocks._jdf.queryExecution().executedPlan().toString()))
        return grow(blocks, *args, **options)

    monkeypatch.setattr(boosting, "_grow", measured)
    boosting.fit_boosted(models.boosted(maxDepth=1, maxIter=8), train, train.count())
    train.unpersist()
    assert len(lengths) == 8 and lengths[-1] < 16 * lengths[0]
    assert not list(Path(session.shared_folder(spark)).glob("boosted-blocks-*"))


def test_a_search_does_not_write_the_whole_table(spark, folder, monkeypatch):
    """Input that is not dealt out is read twice for its keys, and other columns are derived for the subsample alone."""
    from tabloom.plans import queries

    expected = queries._tune(spark, folder, models.forest(numTrees=1), {"maxDepth": (1, 2)})[0].fold_metrics
    monkeypatch.setattr(derived, "is_small", lambda *a: False)
    monkeypatch.setattr(derived, "_once", lambda *a: pytest.fail("the table was written"))
    assert queries._tune(spark, folder, models.forest(numTrees=1), {"maxDepth": (1, 2)})[0].fold_metrics == expected


# --- trees as tables ---


def test_split_check_repeats_no_row_for_each_feature(spark):
    """Values on both sides of a nominal split, more than one tree, bins that only one task meets."""
    rows = [(float(i % 3), float(i % 50 // 10), float(i % 3 == 1)) for i in range(300)]
    table = assemble(spark.createDataFrame(rows, "a double, b double, label double"), ["a", "b"], "features")
    nodes = spark.createDataFrame(
        [(0, 0, 1, 2, 0, None, [1.0]), (0, 1, None, None, None, None, None), (0, 2, None, None, None, None, None),
         (1, 0, 1, 2, 1, 2.0, None), (1, 1, None, None, None, None, None), (1, 2, None, None, None, None, None)],
        "tree int, node int, low int, high int, feature int, threshold double, left array<double>",
    )
    assert "Generate" not in explain(trees._leaf_bins(table, "features", F.col("label"), nodes))
    found = trees._leaf_bins(table.repartition(7), "features", F.col("label"), nodes)
    found = found.groupBy("tree", "node", "feature", "bin").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    routed = trees.route(table, "features", nodes, 1)
    bins = F.posexplode(vector_to_array("features")).alias("feature", "bin")
    expected = routed.select("tree", "node", "label", bins).groupBy("tree", "node", "feature", "bin").agg(
        F.count("*").alias("n"), F.sum("label").alias("total")
    )
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_routed_rows_end_in_the_leaves_of_the_library(prepared):
    train, _ = sampling.split_train_test(prepared, "row_id")
    model = models.fit(models.forest(numTrees=3, maxDepth=4).setLeafCol("leaves"), train)
    nodes = trees.node_table(train.sparkSession, model)
    routed = trees.route(model.transform(train).select("row_id", "features", "leaves"), "features", nodes, 4)
    pairs = routed.select("tree", "node", F.get(vector_to_array("leaves"), F.col("tree")).alias("leaf")).distinct().collect()
    assert routed.count() == 3 * train.count()
    assert len(pairs) == len({(r["tree"], r["node"]) for r in pairs}) == len({(r["tree"], r["leaf"]) for r in pairs})


def test_split_certificate_finds_a_worse_split(spark):
    """A tree that was not allowed to use its best feature."""
    rows = [(float(i % 2), float(i % 4 // 2), float(i % 2 if i % 10 else 1 - i % 2)) for i in range(400)]
    table = spark.createDataFrame(rows, "a double, b double, label double")
    both = assemble(table, ["a", "b"], "features").withColumn("label", F.col("label").alias("label", metadata={"ml_attr": {"type": "nominal", "num_vals": 2}}))
    good = models.fit(models.forest(numTrees=1, maxDepth=1, bootstrap=False), both)
    right = trees.check_splits(both, "features", F.col("label"), trees.node_table(spark, good), 1).first()
    assert tuple(right) == (1, 0, 0)
    swapped = assemble(table, ["b", "a"], "features")
    wrong = trees.check_splits(swapped, "features", F.col("label"), trees.node_table(spark, good), 1).first()
    assert wrong["violations"] == 1


def test_leaf_check_finds_other_rows(prepared):
    train, test = sampling.split_train_test(prepared, "row_id")
    model = models.fit(models.forest(numTrees=1, maxDepth=3, bootstrap=False), train)
    nodes = trees.node_table(train.sparkSession, model)
    assert trees.check_leaves(train, "features", "label", nodes, 3).first()["differing"] == 0
    assert trees.check_leaves(test, "features", "label", nodes, 3).first()["differing"] > 0


def test_two_stage_report_scores_once(balanced):
    result = claims_plan.regress_claims_two_stage(balanced)
    plan = explain(result.report())
    assert plan.count("InMemoryTableScan (") == 1 or plan.count(") InMemoryTableScan") == 1
    assert result.report().first()["scored_rows"] > 0


def test_full_grids_have_27_points():
    for estimator, grid in ((models.forest(), tuning_grid("FOREST_GRID")), (models.boosted(), tuning_grid("BOOSTED_GRID"))):
        assert len(tuning.param_grid(estimator, grid)) == 27


def tuning_grid(name):
    from tabloom import config

    return getattr(config, name)


def test_shared_boosted_fits_equal_separate_ones(prepared):
    train, _ = sampling.split_train_test(prepared, "row_id")
    train = train.coalesce(1).persist()
    estimator = models.boosted(maxDepth=2, maxBins=16)
    together = tuning.cross_validate(estimator, train, {"maxIter": (1, 3)}, key="row_id", folds=2)
    for rounds, scores in zip((1, 3), together.fold_metrics):
        alone = tuning.cross_validate(estimator, train, {"maxIter": (rounds,)}, key="row_id", folds=2)
        assert scores == pytest.approx(alone.fold_metrics[0], abs=1e-12)
    assert [len(g) for g in tuning.shared_fits(estimator, together.maps)] == [2]


# --- claims ---


def test_preparation_does_not_depend_on_layout(raw_claims):
    results = []
    for n in (1, 3, 8):
        preparation = claims_plan.fit_claims_preparation(raw_claims.repartition(n))
        rows = preparation.transform(raw_claims.repartition(n)).select(
            CLAIMS.row_id, CLAIMS.label, F.round(vector_to_array("finalvector")[0], 6), vector_to_array("finalvector")[20]
        )
        results.append((preparation.modes, preparation.dictionary.small, sorted(map(tuple, rows.collect()))))
    assert results[0] == results[1] == results[2]


def test_preparation_shape(raw_claims):
    preparation = claims_plan.fit_claims_preparation(raw_claims)
    assert tuple(preparation.nominal) == KEPT_NOMINAL
    frame = preparation.transform(raw_claims)
    assert frame.columns == [CLAIMS.row_id, CLAIMS.target, CLAIMS.label, "finalvector"]
    labels = sum(len(v) for v in preparation.dictionary.small.values())
    assert len(frame.first()["finalvector"]) == 12 + labels + 1


def test_further_columns_pass_through(raw_claims):
    frame = claims_plan.prepare_claims(raw_claims.withColumn("extra", F.lit("x")))
    assert "extra" in frame.columns


def test_pruned_ordinal_and_sentinel_majority(raw_claims):
    roles = ClaimsRoles()
    odd = raw_claims.withColumns(
        {"OrdCat": F.lit(None).cast("string"), "Cat1": F.when(F.col("Cat1") == "N", "?").otherwise(F.col("Cat1"))}
    )
    preparation = claims_plan.fit_claims_preparation(odd, roles, limit=99.0)
    assert preparation.ordinal == [] and "OrdCat" not in preparation.vector_inputs
    assert preparation.modes["Cat1"] in ("A", "R")
    assert preparation.transform(odd).count() > 0


def test_all_missing_number_is_left_out(raw_claims):
    with pytest.warns(UserWarning, match="Var4"):
        preparation = claims_plan.fit_claims_preparation(raw_claims.withColumn("Var4", F.lit("n/a")))
    assert "Var4" not in preparation.means
    assert preparation.transform(raw_claims).count() > 0


def test_optional_pruning_of_numbers(raw_claims):
    kept = claims_plan.fit_claims_preparation(raw_claims).means
    pruned = claims_plan.fit_claims_preparation(raw_claims, prune_continuous=True).means
    assert set(kept) - set(pruned) == {"Var2"}


def test_unseen_category_at_scoring(raw_claims):
    preparation = claims_plan.fit_claims_preparation(raw_claims)
    new = raw_claims.limit(50).withColumn("Cat3", F.lit("never seen"))
    width = len(preparation.dictionary.small["Cat1"])
    vectors = preparation.transform(new).select(vector_to_array("finalvector").alias("v")).collect()
    assert all(sum(r["v"][12 + width : 14 + width]) == 0 for r in vectors)


def test_no_claims_is_an_error(raw_claims):
    with pytest.raises(ValueError, match="nothing to balance"):
        claims_plan.balance_and_split(raw_claims.withColumn("Claim_Amount", F.lit("0")))


def test_linear_and_two_stage(balanced):
    test_rows = balanced.test.count()
    linear = claims_plan.regress_claims(balanced).report().first()
    assert linear["scored_rows"] == test_rows and linear["mse"] > 0
    result = claims_plan.regress_claims_two_stage(balanced)
    report = result.report().first()
    predicted = result.classified().filter("prediction = 1").count()
    assert report["scored_rows"] == predicted <= test_rows
    assert 0.5 < report["accuracy"] <= 1


def test_train_only_keeps_the_test_rows_whole(raw_claims):
    rows = claims_plan.balance_and_split(raw_claims, train_only=True)
    _, test = sampling.split_train_test(raw_claims, CLAIMS.row_id)
    assert rows.test.count() == rows.preparation.clean(test).count()
    counts = profile.class_counts(rows.train, CLAIMS.label).first()
    assert counts["zeros"] < 2 * counts["ones"]
    rows.release()


# --- jobs ---


@pytest.fixture(scope="module")
def csv_files(spark, folder, tmp_path_factory):
    base = tmp_path_factory.mktemp("csv")
    derived.signal_text(spark, folder).select(*(f"`{c}`" for c in SIGNAL_COLUMNS)).write.csv(str(base / "signal"))
    derived.claims(spark, folder).select(*CLAIMS_COLUMNS).write.csv(str(base / "claims"), header=True)
    return base


def test_fit_job(spark, csv_files):
    tables = jobs.fit_job(spark, str(csv_files / "signal"), "forest")
    assert tables["report"].first()["auc"] > 0.9 and tables["importances"].count() == 28


def test_claims_jobs(spark, csv_files, capsys, tmp_path):
    tables = jobs.claims_job(spark, str(csv_files / "claims"), two_stage=False, train_only=True)
    assert tables["report"].first()["mae"] > 0 and tables["missing rates"].count() == 26
    out = tmp_path / "out"
    jobs.main(["claims-two-stage", "--input", str(csv_files / "claims"), "--output", str(out)])
    assert "accuracy" in capsys.readouterr().out
    counts = spark.read.parquet(str(out / "rows")).first()
    assert counts["dropped_rows"] == counts["rows"] - counts["complete_rows"] > 0
    values = spark.read.parquet(str(out / "values"))
    assert values.count() > 100 and values.agg(F.sum("count")).first()[0] == 14 * counts["rows"]


# --- plans ---


def explain(frame):
    return frame._jdf.queryExecution().explainString(
        frame.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.mark.parametrize(
    "name", ["missing_rate_categorical", "missing_rate_continuous", "value_counts", "most_common_value", "class_balance"]
)
def test_profiles_scan_once(spark, folder, name):
    plan = explain(QUERIES[name](spark, folder))
    assert plan.count(") Scan parquet") == 1


def test_scan_reads_only_what_is_needed(spark, folder):
    plan = explain(QUERIES["split_train_test"](spark, folder))
    assert "ReadSchema: struct<row_id:string,label:double>" in plan
    plan = explain(QUERIES["filter_sentinel"](spark, folder))
    assert "EqualTo(Cat1,?)" in plan and "ReadSchema: struct<Row_ID:string,Cat1:string>" in plan


@pytest.mark.parametrize("name", ["subsample_small", "sample_fraction", "cast_all_double", "union_all"])
def test_maps_do_not_shuffle(spark, folder, name):
    assert "Exchange" not in explain(QUERIES[name](spark, folder))


@pytest.mark.parametrize("name", ["auc_roc", "shuffle_rows", "sort_by_count", "param_grid", "prepare_claims"])
def test_no_cross_joins(spark, folder, name):
    plan = explain(QUERIES[name](spark, folder))
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# --- linear models on the full vector, against numpy ---


def _matrix(frame):
    rows = frame.select(vector_to_array("finalvector").alias("x"), CLAIMS.target).collect()
    return np.array([r["x"] for r in rows]), np.array([r[CLAIMS.target] for r in rows])


def _standardised(x, y):
    sx, sy = x.std(axis=0), y.std()
    used = sx > 0
    z = (x[:, used] - x[:, used].mean(axis=0)) / sx[used]
    return z, (y - y.mean()) / sy, sx[used], sy, used


def test_glm_equals_ridge_by_normal_equations(balanced):
    train = balanced.train.filter(F.col(CLAIMS.label) == 1)
    model = models.fit(models.gaussian_glm("finalvector", CLAIMS.target), train)
    x, y = _matrix(train)
    z, t, sx, sy, used = _standardised(x, y)
    gram = z.T @ z / len(t) + 0.01 / sy * np.eye(z.shape[1])
    expected = np.linalg.solve(gram, z.T @ t / len(t)) * sy / sx
    found = np.array(model.coefficients)
    assert found[used] == pytest.approx(expected, rel=1e-4, abs=1e-4)
    assert not found[~used].any()


def test_elastic_net_meets_the_optimality_conditions(balanced):
    model = models.fit(models.elastic_net("finalvector", CLAIMS.target), balanced.train)
    x, y = _matrix(balanced.train)
    z, t, sx, sy, used = _standardised(x, y)
    beta = np.array(model.coefficients)[used] * sx / sy
    penalty, share = 0.1 / sy, 0.5
    gradient = z.T @ (t - z @ beta) / len(t) - penalty * (1 - share) * beta
    active = np.abs(beta) > 1e-9
    assert active.any()
    assert gradient[active] == pytest.approx(penalty * share * np.sign(beta[active]), abs=2e-4)
    assert (np.abs(gradient[~active]) <= penalty * share + 2e-4).all()


def test_scratch_tables_can_be_cleared(spark):
    """Only what was written since."""
    import os

    before = session.scratch_paths(spark)
    path = session.fresh_path(spark, "some-table")
    spark.range(3).write.parquet(path)
    assert session.clear_scratch(spark, before) == 1 and session.clear_scratch(spark, before) == 0
    assert not os.path.exists(path.removeprefix("file:")) and session.scratch_paths(spark) == before


def test_large_inputs_are_derived_without_a_shuffle(spark, folder, monkeypatch):
    dealt = {t: getattr(derived, t)(spark, folder) for t in ("signal", "signal_text", "claims")}
    monkeypatch.setattr(derived, "DEALT_BYTES", 0)
    for name, rows in dealt.items():
        mapped = getattr(derived, name)(spark, folder)
        assert "Exchange" not in mapped._jdf.queryExecution().executedPlan().toString()
        assert mapped.exceptAll(rows).isEmpty() and rows.exceptAll(mapped).isEmpty()


def test_filtered_claims_hash_each_row_once(spark, folder, monkeypatch):
    """A filter moved below the hashes would compute them wherever its condition mentions them."""
    dealt = _labelled(spark, folder)
    monkeypatch.setattr(derived, "DEALT_BYTES", 0)
    mapped = _labelled(spark, folder)
    assert mapped._jdf.queryExecution().executedPlan().toString().count("md5(") == len(derived.VALUES)
    assert mapped.exceptAll(dealt).isEmpty() and dealt.exceptAll(mapped).isEmpty()


def test_text_is_cast_once_where_incomplete_rows_are_dropped(spark, folder, monkeypatch):
    """Large text is neither written first nor read as a number by the filter and the projection both."""
    for name in ("prepare_signal", "drop_any_missing"):
        dealt = QUERIES[name](spark, folder)
        monkeypatch.setattr(derived, "DEALT_BYTES", 0)
        mapped = QUERIES[name](spark, folder)
        plan = mapped._jdf.queryExecution().executedPlan().toString()
        assert plan.count("try_cast(") <= len(SIGNAL_FEATURES) + 1 and "lineitem.parquet" in plan
        assert mapped.exceptAll(dealt).isEmpty() and dealt.exceptAll(mapped).isEmpty()
        monkeypatch.undo()


def test_wide_stages_are_compiled_in_any_session(spark, folder):
    derived.claims(spark, folder)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_csv_files_are_compressed(spark, folder):
    assert all(f.endswith(".gz") for f in derived.signal_csv(spark, folder).inputFiles())

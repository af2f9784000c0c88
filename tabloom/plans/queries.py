"""The registered queries: name -> callable(spark, folder) returning a DataFrame.

Every query runs over whole tables. Fitted models are also run in reduced
settings whose result has a closed form or an exhaustive search in SQL.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.config import (
    BOOSTED_GRID,
    CLAIMS,
    ELASTIC_NET,
    FOLDS,
    FOREST_GRID,
    GAUSSIAN_GLM,
    MISSING_LIMIT_PCT,
    SIGNAL_COLUMNS,
    SIGNAL_FEATURES,
    ClaimsRoles,
)
from tabloom.functions.hashing import row_hash
from tabloom.operators import (
    binning,
    columns,
    features,
    filters,
    hurdle,
    impute,
    linear,
    metrics,
    models,
    ordering,
    profile,
    sampling,
    trees,
    tuning,
)
from tabloom.operators.features import ENCODED, INDEXED, assemble, vector_elements
from tabloom.plans import claims as claims_plan
from tabloom.plans import signal as signal_plan
from tabloom.session import fresh_path
from tabloom.sources import preview
from tabloom.sources.derived import (
    ROW_ID,
    claims,
    claims_csv,
    signal,
    signal_csv,
    signal_text,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Feature subsets used by the reduced model checks.
SEARCH_FEATURES = ("lepton pT", "lepton phi", "missing energy magnitude", "missing energy phi")
SEARCH_BINS = 64
PAIR = ("lepton pT", "lepton eta")


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


def _hot_positions(vector: str, first: int = 0, last: Column | None = None) -> Column:
    """Positions of the non-zero elements from `first` to before `last`, counted from `first`, as text."""
    last = features.vector_size(vector) if last is None else last
    hot = F.filter(features.hot_positions(vector), lambda i: (i >= first) & (i < last))
    return F.concat_ws(",", F.transform(hot, lambda i: (i - first).cast("string")))


# --- sources and previews ---


@query
def scan_csv_positional(spark, folder):
    return signal_csv(spark, folder)


@query
def scan_csv_header(spark, folder):
    return claims_csv(spark, folder)


@query
def preview_rows(spark, folder):
    rows = columns.select_columns(claims(spark, folder), [CLAIMS.row_id, *CLAIMS.continuous])
    return preview.preview_rows(rows, 20, key=CLAIMS.row_id)


@query
def preview_full_vectors(spark, folder):
    prepared = signal_plan.prepare_signal(signal(spark, folder))
    top = preview.preview_full_vectors(prepared, "features", 10, key=ROW_ID)
    return top.select(ROW_ID, F.posexplode("features").alias("pos", "value"))


@query
def describe_schema(spark, folder):
    return preview.describe_schema(columns.cast_double(signal_text(spark, folder), SIGNAL_COLUMNS))


# --- projections ---


@query
def rename_positional(spark, folder):
    unnamed = signal_text(spark, folder)
    unnamed = unnamed.toDF(*(f"_c{i}" for i in range(len(unnamed.columns))))
    return columns.rename_positional(unnamed, [ROW_ID, *SIGNAL_COLUMNS])


@query
def cast_all_double(spark, folder):
    return columns.cast_double(signal_text(spark, folder).drop(ROW_ID))


@query
def cast_subset_double(spark, folder):
    rows = columns.select_columns(claims(spark, folder), [CLAIMS.row_id, *CLAIMS.numeric])
    return columns.cast_double(rows, CLAIMS.numeric)


@query
def select_columns(spark, folder):
    return columns.select_columns(claims(spark, folder), [CLAIMS.row_id, *CLAIMS.continuous])


@query
def drop_columns(spark, folder):
    return columns.drop_columns(claims(spark, folder), [*CLAIMS.identifiers, "no such column"])


@query
def derive_binary_label(spark, folder):
    return columns.derive_binary_label(claims(spark, folder)).select(
        CLAIMS.row_id, CLAIMS.target, CLAIMS.label
    )


@query
def replace_sentinel(spark, folder):
    return columns.replace_sentinel(claims(spark, folder), {"Cat1": "N", "NVCat": "N0"}).select(
        CLAIMS.row_id, "Cat1", "NVCat"
    )


@query
def fill_null_literal(spark, folder):
    return columns.fill_null_literal(claims(spark, folder), {"Cat1": "N", "NVCat": "N0"}).select(
        CLAIMS.row_id, "Cat1", "NVCat"
    )


# --- filters ---


@query
def filter_label_equals(spark, folder):
    return filters.filter_equals(signal(spark, folder), "label", 1.0).select(ROW_ID, "label", *PAIR)


@query
def filter_is_null(spark, folder):
    return filters.filter_is_null(claims(spark, folder), "Cat1").select(CLAIMS.row_id, "Cat3")


@query
def filter_sentinel(spark, folder):
    return filters.filter_sentinel(claims(spark, folder), "Cat1").select(CLAIMS.row_id, "Cat1")


@query
def filter_is_nan(spark, folder):
    typed = columns.cast_double(claims(spark, folder), CLAIMS.numeric)
    return filters.filter_is_nan(typed, "Var3").select(CLAIMS.row_id)


@query
def missing_cells(spark, folder):
    """Nulls, sentinels, NaN and text that is no number, of all 26 columns at once."""
    return filters.missing_cells(claims(spark, folder), CLAIMS.row_id, CLAIMS.categorical, CLAIMS.continuous)


@query
def drop_any_missing(spark, folder):
    return filters.drop_any_missing(columns.cast_double_once(signal_text(spark, folder), SIGNAL_COLUMNS))


def _labelled(spark, folder) -> DataFrame:
    """Claims with a label and the two numbers the reduced checks use, complete rows only."""
    typed = columns.cast_double(
        columns.derive_binary_label(claims(spark, folder, filtered=True)).select(
            CLAIMS.row_id, CLAIMS.target, CLAIMS.label, "NVVar2", "Var5", "NVVar1"
        ),
        [CLAIMS.target, "NVVar2", "Var5", "NVVar1"],
    )
    return filters.drop_any_missing(typed)


@query
def filter_train_positive(spark, folder):
    train, _ = sampling.split_train_test(_labelled(spark, folder), CLAIMS.row_id)
    return filters.train_positive(train)


@query
def filter_predicted_positive(spark, folder):
    scored = _labelled(spark, folder).withColumn(
        "prediction", F.when(F.col("NVVar1") >= 84, 1.0).otherwise(0.0)
    )
    return filters.predicted_positive(scored)


# --- aggregations ---


@query
def row_count(spark, folder):
    return profile.row_count(claims(spark, folder))


@query
def class_balance(spark, folder):
    return _rounded(profile.class_balance(signal(spark, folder), "label"), "imbalance")


@query
def missing_rate_categorical(spark, folder):
    return _rounded(profile.missing_rate_categorical(claims(spark, folder), CLAIMS.categorical), "missing_pct")


@query
def missing_rate_continuous(spark, folder):
    return _rounded(profile.missing_rate_continuous(claims(spark, folder), CLAIMS.continuous), "missing_pct")


@query
def value_counts(spark, folder):
    return profile.value_counts(claims(spark, folder), CLAIMS.categorical)


@query
def value_counts_imputed(spark, folder):
    raw = claims(spark, folder, stored=True)
    modes = _kept_modes(raw)
    return profile.value_counts(impute.fill_mode(raw, modes), list(modes))


@query
def most_common_value(spark, folder):
    return profile.most_common_value(profile.value_counts(claims(spark, folder), CLAIMS.categorical))


@query
def prune_by_missing_rate(spark, folder):
    return _rounded(claims_plan.claim_rates(claims(spark, folder)), "missing_pct")


@query
def imbalance_factor(spark, folder):
    return profile.imbalance_factor(_labelled(spark, folder), CLAIMS.label)


# --- sorts ---


@query
def sort_by_count(spark, folder):
    return ordering.sort_by_count(profile.value_counts(claims(spark, folder), CLAIMS.categorical))


@query
def shuffle_rows(spark, folder):
    return ordering.shuffle_rows(signal(spark, folder).select(ROW_ID, "label"), ROW_ID)


@query
def shuffle_rows_rng(spark, folder):
    return ordering.shuffle_rows_rng(signal(spark, folder).select(ROW_ID, "label"), 42)


@query
def top_1(spark, folder):
    return ordering.top_1(profile.value_counts(claims(spark, folder), CLAIMS.categorical))


# --- sampling and union ---


def _parts(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query
def split_train_test(spark, folder):
    return _parts(*sampling.split_train_test(signal(spark, folder).select(ROW_ID, "label"), ROW_ID))


@query
def split_train_test_rng(spark, folder):
    return _parts(*sampling.split_train_test_rng(signal(spark, folder).select(ROW_ID, "label")))


@query
def subsample_small(spark, folder):
    small = sampling.subsample_small(signal(spark, folder).select(ROW_ID, "label"), ROW_ID)
    return _parts(*sampling.split_train_test(small, ROW_ID))


def _zeros_to_sample(spark, folder) -> tuple[DataFrame, float]:
    """The rows without a claim, and one over how many there are for each claim."""
    rows = _labelled(spark, folder).select(CLAIMS.row_id, CLAIMS.label)
    factor = profile.imbalance_factor(rows, CLAIMS.label).first()["factor"]
    return filters.filter_equals(rows, CLAIMS.label, 0.0), 1 / factor


@query
def sample_fraction(spark, folder):
    zeros, fraction = _zeros_to_sample(spark, folder)
    return sampling.sample_fraction(zeros, CLAIMS.row_id, fraction)


@query
def sample_fraction_rng(spark, folder):
    return sampling.sample_fraction_rng(*_zeros_to_sample(spark, folder))


@query
def undersample_majority(spark, folder):
    rows = _labelled(spark, folder).select(CLAIMS.row_id, CLAIMS.label)
    return sampling.undersample_majority(rows, CLAIMS.row_id, CLAIMS.label)


@query
def union_all(spark, folder):
    rows = signal(spark, folder).select(ROW_ID, "label")
    return sampling.union_all(
        sampling.subsample_small(rows, ROW_ID), filters.filter_equals(rows, "label", 1.0)
    )


# --- features ---

# The categories whose missing rate in the derived claims table is below the limit.
KEPT_NOMINAL = ("Cat1", "Cat3", "Cat4", "Cat6", "Cat8", "Cat9", "Cat10", "Cat11", "NVCat")
KEPT_CATEGORICAL = (*KEPT_NOMINAL, *CLAIMS.ordinal)


def _kept_modes(raw: DataFrame) -> dict[str, str]:
    """The most common value of each category whose missing rate is below the limit, from one count of all values."""
    summary = {r["column"]: r for r in profile.category_summary(profile.value_counts(raw, CLAIMS.categorical)).collect()}
    return {
        c: summary[c]["mode"]
        for c in CLAIMS.categorical
        if c in summary and 100 * summary[c]["missing"] / summary[c]["row_count"] < MISSING_LIMIT_PCT
    }


@query
def impute_mode(spark, folder):
    """All categories; those that pruning removes are null."""
    raw = claims(spark, folder, stored=True)
    modes = _kept_modes(raw)
    gone = {c: F.lit(None).cast("string") for c in CLAIMS.categorical if c not in modes}
    return impute.fill_mode(raw, modes).withColumns(gone).select(CLAIMS.row_id, *CLAIMS.categorical)


@query
def impute_mean(spark, folder):
    typed = columns.cast_double(claims(spark, folder, stored=True), CLAIMS.continuous)
    imputed = [c + impute.IMPUTED for c in CLAIMS.continuous]
    return _rounded(
        impute.impute_mean(typed, CLAIMS.continuous).select(CLAIMS.row_id, *imputed), *imputed
    )


def _prepared(spark, folder) -> tuple[claims_plan.ClaimsPreparation, DataFrame]:
    raw = claims(spark, folder, stored=True)
    preparation = claims_plan.fit_claims_preparation(raw)
    return preparation, preparation.clean(raw)


@query
def string_index(spark, folder):
    preparation, clean = _prepared(spark, folder)
    indexed = preparation.dictionary.transform(clean)
    return indexed.select(CLAIMS.row_id, *(c + INDEXED for c in preparation.nominal))


@query
def string_index_by_join(spark, folder):
    """The same with no label on the driver: every column is indexed by joins."""
    raw = claims(spark, folder, stored=True)
    preparation = claims_plan.fit_claims_preparation(raw, max_labels=0)
    indexed = preparation.dictionary.transform(preparation.clean(raw))
    return indexed.select(CLAIMS.row_id, *(c + INDEXED for c in preparation.nominal))


@query
def one_hot_encode(spark, folder):
    preparation, clean = _prepared(spark, folder)
    encoded = features.one_hot_encode(preparation.dictionary.transform(clean), preparation.nominal)
    return encoded.select(
        CLAIMS.row_id,
        *(
            F.concat_ws("/", _hot_positions(c + ENCODED), features.vector_size(c + ENCODED)).alias(
                f"{c}_hot"
            )
            for c in preparation.nominal
        ),
    )


@query
def assemble_numeric(spark, folder):
    rows = assemble(signal(spark, folder), SIGNAL_FEATURES, "features")
    return rows.select(
        ROW_ID, *vector_elements("features", [f"e{i}" for i in range(len(SIGNAL_FEATURES))])
    )


@query
def assemble_onehot(spark, folder):
    preparation, clean = _prepared(spark, folder)
    encoded = features.one_hot_encode(preparation.dictionary.transform(clean), preparation.nominal)
    blocks = [c + ENCODED for c in preparation.nominal]
    return assemble(encoded, blocks, claims_plan.CATEGORY_VECTOR).select(
        CLAIMS.row_id,
        features.vector_size(claims_plan.CATEGORY_VECTOR).cast("bigint").alias("width"),
        _hot_positions(claims_plan.CATEGORY_VECTOR).alias("hot"),
    )


def _final_elements(preparation) -> list[Column]:
    """The final vector as columns: imputed numbers, width, ordinal (its last element)."""
    vector = claims_plan.FINAL_VECTOR
    width = features.vector_size(vector)
    numbers = [
        F.round(features.vector_element(vector, F.lit(i)), 6).alias(c + impute.IMPUTED)
        for i, c in enumerate(preparation.means)
    ]
    return [
        *numbers,
        width.cast("bigint").alias("width"),
        features.vector_element(vector, width - 1).alias("ordinal"),
    ]


@query
def assemble_mixed(spark, folder):
    preparation, clean = _prepared(spark, folder)
    rows = assemble(preparation.encode(clean), preparation.vector_inputs, claims_plan.FINAL_VECTOR)
    return rows.select(CLAIMS.row_id, *_final_elements(preparation))


@query
def prepare_claims(spark, folder):
    raw = claims(spark, folder, stored=True)
    preparation = claims_plan.fit_claims_preparation(raw)
    numbers = len(preparation.means)
    vector = claims_plan.FINAL_VECTOR
    ordinal = features.vector_size(vector) - 1
    return preparation.transform(raw).select(
        CLAIMS.row_id,
        CLAIMS.label,
        CLAIMS.target,
        *_final_elements(preparation),
        _hot_positions(vector, numbers, ordinal).alias("hot"),
    )


@query
def prepare_signal(spark, folder):
    rows = signal_plan.prepare_signal(signal_text(spark, folder))
    return rows.select(
        ROW_ID, "label", *vector_elements("features", [f"e{i}" for i in range(len(SIGNAL_FEATURES))])
    )


# --- evaluation on a fixed score ---


def _fixed_scores(spark, folder) -> DataFrame:
    score = 2 * F.col("lepton pT") / 50 + F.col("lepton eta") / 50000
    return signal(spark, folder).select(
        ROW_ID,
        "label",
        F.round(score, 2).alias("score"),
        F.when(F.round(score, 2) > 1.8, 1.0).otherwise(0.0).alias("prediction"),
    )


@query
def auc_roc(spark, folder):
    return _rounded(metrics.auc_roc(_fixed_scores(spark, folder)), "auc", digits=9)


@query
def auc_roc_hot_score(spark, folder):
    """99 of 100 rows share one score."""
    draw = row_hash("under", ROW_ID) % 100
    rows = _fixed_scores(spark, folder).withColumn(
        "score", F.when(draw == 0, F.col("score")).otherwise(1.0)
    )
    return _rounded(metrics.auc_roc(rows), "auc", digits=9)


@query
def accuracy(spark, folder):
    return _rounded(metrics.accuracy(_fixed_scores(spark, folder)), "accuracy")


@query
def mse(spark, folder):
    return _rounded(metrics.mse(_fixed_scores(spark, folder), "label", "score"), "mse")


@query
def mae(spark, folder):
    return _rounded(metrics.mae(_fixed_scores(spark, folder), "label", "score"), "mae")


# --- models, full settings ---


def _signal_prepared(spark, folder) -> DataFrame:
    return signal_plan.prepare_signal(signal(spark, folder, stored=True))


def _scored_signal(fitted: signal_plan.Fitted) -> DataFrame:
    return fitted.scored.select(
        ROW_ID, "label", "prediction", vector_to_array("probability")[1].alias("probability")
    )


@query
def rf_classify(spark, folder):
    return _scored_signal(signal_plan.fit_classifier(_signal_prepared(spark, folder), models.forest()))


@query
def gbt_classify(spark, folder):
    return _scored_signal(signal_plan.fit_classifier(_signal_prepared(spark, folder), models.boosted()))


@query
def feature_importance(spark, folder):
    return signal_plan.fit_classifier(_signal_prepared(spark, folder), models.forest()).importances()


@query
def gbt_feature_importance(spark, folder):
    return signal_plan.fit_classifier(_signal_prepared(spark, folder), models.boosted()).importances()


@query
def forest_report(spark, folder):
    return signal_plan.fit_classifier(_signal_prepared(spark, folder), models.forest()).report()


@query
def boosted_report(spark, folder):
    return signal_plan.fit_classifier(_signal_prepared(spark, folder), models.boosted()).report()


def _on_balanced(spark, folder, run, roles: ClaimsRoles = CLAIMS):
    """The result of `run` over the persisted balanced rows, which are freed once it is written."""
    rows = claims_plan.balance_and_split(claims(spark, folder, stored=True), roles)
    path = fresh_path(spark, "balanced-result")
    try:
        run(rows).write.parquet(path)
    finally:
        rows.release()
    return spark.read.parquet(path)


@query
def rf_classify_deep(spark, folder):
    def fit(rows):
        model = models.fit(models.forest_deep(claims_plan.FINAL_VECTOR, CLAIMS.label), rows.train)
        return model.transform(rows.test).select(CLAIMS.row_id, CLAIMS.label, "prediction")

    return _on_balanced(spark, folder, fit)


@query
def linreg_elastic_net(spark, folder):
    def fit(rows):
        return claims_plan.regress_claims(rows).scored.select(CLAIMS.row_id, CLAIMS.target, "prediction")

    return _on_balanced(spark, folder, fit)


@query
def glm_gaussian(spark, folder):
    def fit(rows):
        estimator = models.gaussian_glm(claims_plan.FINAL_VECTOR, CLAIMS.target)
        model = models.fit(estimator, filters.train_positive(rows.train))
        return model.transform(filters.train_positive(rows.test)).select(
            CLAIMS.row_id, CLAIMS.target, "combo_prediction"
        )

    return _on_balanced(spark, folder, fit)


@query
def hurdle_regression(spark, folder):
    def fit(rows):
        return claims_plan.regress_claims_two_stage(rows).scored().select(
            CLAIMS.row_id, CLAIMS.target, CLAIMS.label, "prediction", "combo_prediction"
        )

    return _on_balanced(spark, folder, fit)


@query
def claims_linear_report(spark, folder):
    return _on_balanced(spark, folder, lambda rows: claims_plan.regress_claims(rows).report())


@query
def claims_two_stage_report(spark, folder):
    return _on_balanced(spark, folder, lambda rows: claims_plan.regress_claims_two_stage(rows).report())


# --- tuning ---


@query
def param_grid(spark, folder):
    """Every fit of the forest search: grid point, fold, rows to train on and to score."""
    estimator = models.forest()
    maps = tuning.param_grid(estimator, FOREST_GRID)
    train, _ = sampling.split_train_test(
        sampling.subsample_small(signal(spark, folder).select(ROW_ID), ROW_ID), ROW_ID
    )
    counts = sampling.with_fold(train, ROW_ID, FOLDS).groupBy("fold").agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    points = [
        F.struct(*(F.lit(str(v)).alias(n) for n, v in tuning.settings_of(maps, i).items()))
        for i in range(len(maps))
    ]
    return counts.select(
        "fold",
        (total - F.col("rows")).alias("train_rows"),
        F.col("rows").alias("held_out_rows"),
        F.inline(F.array(*points)),
    )


def _subsample(spark, folder) -> DataFrame:
    """The rows of a search: drawn by key before the other columns are derived, so the whole table is not written."""
    return sampling.subsample_small(signal(spark, folder), ROW_ID)


def _tune(spark, folder, estimator, grid):
    return signal_plan.tune_classifier(signal_plan.prepare_signal(_subsample(spark, folder)), estimator, grid)


@query
def cross_validate(spark, folder):
    return _tune(spark, folder, models.forest(), FOREST_GRID)[0].metrics_table(spark)


@query
def best_params(spark, folder):
    return _tune(spark, folder, models.forest(), FOREST_GRID)[0].best_params(spark)


@query
def score_best(spark, folder):
    return _tune(spark, folder, models.forest(), FOREST_GRID)[1].report()


@query
def gbt_cross_validate(spark, folder):
    return _tune(spark, folder, models.boosted(), BOOSTED_GRID)[0].metrics_table(spark)


# --- models, full settings: what is exact about their output ---


def _contract(fitted: signal_plan.Fitted) -> DataFrame:
    """Which rows are scored, and that every score is a class and a probability."""
    probability = vector_to_array("probability")[1]
    valid = F.col("prediction").isin(0.0, 1.0) & probability.between(0.0, 1.0)
    return fitted.scored.select(ROW_ID, "label", valid.alias("valid"))


@query
def rf_classify_rows(spark, folder):
    return _contract(signal_plan.fit_classifier(_signal_prepared(spark, folder), models.forest()))


@query
def gbt_classify_rows(spark, folder):
    return _contract(signal_plan.fit_classifier(_signal_prepared(spark, folder), models.boosted()))


def _importance_total(importances: DataFrame) -> DataFrame:
    """Every feature is named once, and the importances add up to one."""
    return importances.agg(
        F.count_distinct("feature").alias("features"),
        F.round(F.sum("importance"), 6).alias("total"),
        F.min("importance").between(0.0, 1.0).alias("valid"),
    )


@query
def feature_importance_total(spark, folder):
    return _importance_total(feature_importance(spark, folder))


@query
def gbt_feature_importance_total(spark, folder):
    return _importance_total(gbt_feature_importance(spark, folder))


def _means(scored: DataFrame, prediction: str) -> DataFrame:
    """With a free intercept the mean prediction over the training rows is their mean target."""
    return scored.agg(
        F.count("*").alias("rows"),
        F.round(F.avg(CLAIMS.target), 2).alias("mean_target"),
        F.round(F.avg(prediction), 2).alias("mean_prediction"),
    )


@query
def linreg_elastic_net_mean(spark, folder):
    def fit(rows):
        return _means(claims_plan.regress_claims(rows).model.transform(rows.train), "prediction")

    return _on_balanced(spark, folder, fit)


@query
def glm_gaussian_mean(spark, folder):
    def fit(rows):
        train = filters.train_positive(rows.train)
        model = models.fit(models.gaussian_glm(claims_plan.FINAL_VECTOR, CLAIMS.target), train)
        return _means(model.transform(train), "combo_prediction")

    return _on_balanced(spark, folder, fit)


@query
def split_train_test_rng_parts(spark, folder):
    """Every row is in one part."""
    train, test = sampling.split_train_test_rng(signal(spark, folder).select(ROW_ID, "label"))
    return _parts(train, test).groupBy(ROW_ID, "label").agg(F.count("*").alias("copies"))


# --- models, full settings: certificates of what was learned ---


@query
def rf_classify_deep_leaves(spark, folder):
    """One tree of the deep forest without a bootstrap: the training rows routed through it, counted by leaf and class."""

    def check(rows):
        estimator = models.forest_deep(claims_plan.FINAL_VECTOR, CLAIMS.label, numTrees=1, bootstrap=False)
        model = models.fit(estimator, rows.train)
        nodes = trees.node_table(spark, model)
        depth = estimator.getMaxDepth()
        return trees.check_leaves(rows.train, claims_plan.FINAL_VECTOR, CLAIMS.label, nodes, depth)

    return _on_balanced(spark, folder, check)


def _binned_train(spark, folder, bins: int) -> DataFrame:
    """Training rows of the signal table, their features as a vector of bin numbers, so that every cut is known."""
    train, _ = sampling.split_train_test(signal(spark, folder, stored=True), ROW_ID)
    classes = {"ml_attr": {"type": "nominal", "num_vals": 2, "name": "label"}}
    binned = binning.fit_bins(train, SIGNAL_FEATURES, bins).vector(train, "features")
    return binned.select(ROW_ID, "features", F.col("label").alias("label", metadata=classes))


def _split_check(spark, train: DataFrame, estimator, value: Column) -> DataFrame:
    nodes = trees.node_table(spark, models.fit(estimator, train))
    checked = trees.check_splits(train, "features", value, nodes, estimator.getMaxDepth())
    rows = train.agg(F.count("*").alias("rows"), F.sum("label").alias("positives")).first()
    return checked.select(F.lit(rows["rows"]).cast("bigint").alias("rows"), F.lit(rows["positives"]).alias("positives"), "*")


@query
def rf_classify_splits(spark, folder):
    """The forest at its full depth, without a bootstrap: no cut of a node gains more than the one it was split at."""
    estimator = models.forest(bootstrap=False)
    return _split_check(spark, _binned_train(spark, folder, estimator.getMaxBins()), estimator, F.col("label"))


@query
def gbt_classify_splits(spark, folder):
    """The same of the first round of boosting, which fits -1 and +1."""
    estimator = models.boosted(maxIter=1)
    return _split_check(spark, _binned_train(spark, folder, estimator.getMaxBins()), estimator, 2 * F.col("label") - 1)


# Within what the gradient of a standardised column must balance its penalty.
OPTIMUM_TOLERANCE = 5e-4


@query
def linreg_elastic_net_optimal(spark, folder):
    """The elastic net on the full vector: whether each position meets the condition of the optimum."""

    def check(rows):
        model = claims_plan.regress_claims(rows).model
        found = linear.check_optimum(
            model.transform(rows.train), claims_plan.FINAL_VECTOR, CLAIMS.target, "prediction", model.coefficients,
            ELASTIC_NET["regParam"], ELASTIC_NET["elasticNetParam"], OPTIMUM_TOLERANCE,
        )
        return found.select("position", "met")

    return _on_balanced(spark, folder, check)


def _glm_check(rows) -> DataFrame:
    train = filters.train_positive(rows.train)
    model = models.fit(models.gaussian_glm(claims_plan.FINAL_VECTOR, CLAIMS.target), train)
    found = linear.check_optimum(
        model.transform(train), claims_plan.FINAL_VECTOR, CLAIMS.target, "combo_prediction", model.coefficients,
        GAUSSIAN_GLM["regParam"], 0.0, OPTIMUM_TOLERANCE,
    )
    return found.select("position", "met")


@query
def glm_gaussian_optimal(spark, folder):
    """The generalized linear model on the full vector: whether each position meets the condition of the optimum."""
    return _on_balanced(spark, folder, _glm_check)


# A category of a label for almost every row.
WIDE = replace(
    CLAIMS,
    identifiers=tuple(c for c in CLAIMS.identifiers if c != "Blind_Submodel"),
    nominal=(*CLAIMS.nominal, "Blind_Submodel"),
)


@query
def glm_gaussian_wide(spark, folder):
    """The same on a vector with a slot for each submodel: wider than normal equations allow."""
    return _on_balanced(spark, folder, _glm_check, roles=WIDE)


# --- models, reduced settings with an exact answer ---


def _search_vectors(rows: DataFrame) -> DataFrame:
    return assemble(rows, SEARCH_FEATURES, "features").select(ROW_ID, "features", "label")


def _search_rows(spark, folder) -> DataFrame:
    return _search_vectors(signal(spark, folder, stored=True))


def _stump(**settings):
    return models.forest(
        **{"numTrees": 1, "maxDepth": 1, "maxBins": SEARCH_BINS, "bootstrap": False, **settings}
    )


def _rounded_scores(fitted: signal_plan.Fitted) -> DataFrame:
    return _rounded(_scored_signal(fitted), "probability")


@query
def rf_classify_stump(spark, folder):
    """One split found by exhaustive search over four features."""
    return _rounded_scores(signal_plan.fit_classifier(_search_rows(spark, folder), _stump()))


@query
def rf_classify_two_levels(spark, folder):
    """One split, then one more in each half."""
    return _rounded_scores(signal_plan.fit_classifier(_search_rows(spark, folder), _stump(maxDepth=2)))


@query
def feature_importance_stump(spark, folder):
    fitted = signal_plan.fit_classifier(_search_rows(spark, folder), _stump())
    return fitted.importances(SEARCH_FEATURES)


@query
def gbt_classify_two_rounds(spark, folder):
    """Two boosting rounds of one split each."""
    estimator = models.boosted(maxIter=2, maxDepth=1, maxBins=SEARCH_BINS)
    return _rounded_scores(signal_plan.fit_classifier(_search_rows(spark, folder), estimator))


@query
def score_best_stump(spark, folder):
    """Search over trees without and with a split; score the held-out rows with the best."""
    tuned, fitted = _tune_stump(spark, folder)
    return _rounded(fitted.report(), "auc", "accuracy")


def _tune_stump(spark, folder):
    return signal_plan.tune_classifier(
        _search_vectors(_subsample(spark, folder)), _stump(), {"maxDepth": (0, 1)}
    )


@query
def cross_validate_stump(spark, folder):
    return _rounded(_tune_stump(spark, folder)[0].metrics_table(spark), "avg_auc")


@query
def best_params_stump(spark, folder):
    return _rounded(_tune_stump(spark, folder)[0].best_params(spark), "avg_auc")


def _pair_rows(spark, folder) -> tuple[DataFrame, DataFrame]:
    rows = assemble(_labelled(spark, folder), ["NVVar1", "Var5"], claims_plan.FINAL_VECTOR)
    return sampling.split_train_test(rows, CLAIMS.row_id)


@query
def linreg_elastic_net_pair(spark, folder):
    """Elastic net on two features, run to its optimum: coefficients, and errors on the held-out rows."""
    train, test = _pair_rows(spark, folder)
    estimator = models.elastic_net(claims_plan.FINAL_VECTOR, CLAIMS.target, maxIter=200, tol=1e-12)
    model = models.fit(estimator, train)
    slopes = model.coefficients
    report = metrics.regression_report(model.transform(test), CLAIMS.target)
    fitted = {"b0": model.intercept, "b1": float(slopes[0]), "b2": float(slopes[1])}
    return _rounded(
        report.withColumns({n: F.lit(v) for n, v in fitted.items()}), *fitted, "mse", "mae", digits=4
    )


@query
def glm_gaussian_pair(spark, folder):
    """Ridge GLM on two features, positive rows only."""
    train, test = _pair_rows(spark, folder)
    estimator = models.gaussian_glm(claims_plan.FINAL_VECTOR, CLAIMS.target)
    model = models.fit(estimator, filters.train_positive(train))
    return _rounded(
        model.transform(test).select(CLAIMS.row_id, CLAIMS.target, "combo_prediction"),
        "combo_prediction",
        digits=4,
    )


@query
def hurdle_regression_pair(spark, folder):
    """Balanced rows, one-split classifier on a flag, two-feature GLM on the positives."""
    rows = _labelled(spark, folder).withColumn(
        "high", F.when(F.col("NVVar1") >= 84, 1.0).otherwise(0.0)
    )
    balanced = sampling.undersample_majority(rows, CLAIMS.row_id, CLAIMS.label)
    balanced = assemble(assemble(balanced, ["high"], "flag"), ["NVVar1", "Var5"], claims_plan.FINAL_VECTOR)
    train, test = sampling.split_train_test(balanced, CLAIMS.row_id)
    model = hurdle.hurdle_regression(
        train,
        _stump(features="flag", label=CLAIMS.label),
        models.gaussian_glm(claims_plan.FINAL_VECTOR, CLAIMS.target),
        CLAIMS.label,
    )
    report = metrics.two_stage_report(model.apply(test), CLAIMS.label, CLAIMS.target)
    return _rounded(_rounded(report, "accuracy"), "mse", "mae", digits=4)

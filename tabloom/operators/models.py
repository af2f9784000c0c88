"""Estimators with the studied settings, fitting and scoring."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.sql import DataFrame, functions as F

from tabloom.config import BOOSTED, ELASTIC_NET, FOREST, FOREST_DEEP, GAUSSIAN_GLM, SEED
from tabloom.operators import boosting
from tabloom.operators.linear import RidgeModel, fit_ridge
from tabloom.session import shared_folder

# A level of a forest shuffles the class counts of all its nodes once for each partition, so the partitions of a large
# table are joined to a few for each core, and to no fewer than this.
FOREST_PARTITIONS, FOREST_PARTITIONS_A_CORE = 32, 3

# The normal equations of the library's generalized linear model hold one cell for each pair of
# features on the driver; it refuses more features than this. Wider vectors are solved without them.
DIRECT_FEATURES = 4096


def forest(features: str = "features", label: str = "label", **settings) -> RandomForestClassifier:
    """Shallow forest of the classification study."""
    return RandomForestClassifier(
        **{"featuresCol": features, "labelCol": label, "seed": SEED, **FOREST, **settings}
    )


def forest_deep(features: str, label: str, **settings) -> RandomForestClassifier:
    """Forest of the claims study: library defaults but for the depth."""
    return RandomForestClassifier(
        **{"featuresCol": features, "labelCol": label, "seed": SEED, **FOREST_DEEP, **settings}
    )


def boosted(features: str = "features", label: str = "label", **settings) -> GBTClassifier:
    return GBTClassifier(
        **{"featuresCol": features, "labelCol": label, "seed": SEED, **BOOSTED, **settings}
    )


def elastic_net(features: str, target: str, **settings) -> LinearRegression:
    return LinearRegression(**{"featuresCol": features, "labelCol": target, **ELASTIC_NET, **settings})


def gaussian_glm(
    features: str, target: str, prediction: str = "combo_prediction", **settings
) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(
        **{"featuresCol": features, "labelCol": target, "predictionCol": prediction, **GAUSSIAN_GLM, **settings}
    )


def check_binary(df: DataFrame, label: str) -> None:
    """Fail when a label is not 0 or 1; one counting pass."""
    bad = df.agg(F.count_if(~F.coalesce(F.col(label).isin(0.0, 1.0), F.lit(False))).alias("bad")).first()["bad"]
    if bad:
        raise ValueError(f"{bad} rows have a {label} that is neither 0 nor 1")


def fit(estimator: Estimator, train: DataFrame) -> Model | RidgeModel:
    """Fit on rows laid out by the caller.

    Boosting cuts its lineage every few rounds, for which the shared folder must be set. More rows than
    boosting.LIBRARY_ROWS are boosted over packed blocks, by the same method, where the settings are plain.
    A generalized linear model of more than DIRECT_FEATURES features is fitted by conjugate gradients, to the same optimum.
    """
    shared_folder(train.sparkSession)
    if isinstance(estimator, GeneralizedLinearRegression):
        attributes = train.schema[estimator.getFeaturesCol()].metadata.get("ml_attr", {})
        if attributes.get("num_attrs", 0) > DIRECT_FEATURES:
            return _fit_wide(estimator, train)
    if isinstance(estimator, RandomForestClassifier):
        most = max(FOREST_PARTITIONS, FOREST_PARTITIONS_A_CORE * train.sparkSession.sparkContext.defaultParallelism)
        # Fewer partitions are left as they are: the bootstrap follows their order.
        return estimator.fit(train.coalesce(most) if train.rdd.getNumPartitions() > most else train)
    if isinstance(estimator, GBTClassifier) and boosting.is_plain(estimator, train):
        count = train.count()
        if count > boosting.LIBRARY_ROWS:
            return boosting.fit_boosted(estimator, train, count)
    return estimator.fit(train)


def _fit_wide(estimator: GeneralizedLinearRegression, train: DataFrame) -> RidgeModel:
    plain = estimator.getFamily() == "gaussian" and (not estimator.isDefined("link") or estimator.getLink() == "identity")
    if not plain or estimator.isDefined("weightCol") or estimator.isDefined("offsetCol") or not estimator.getFitIntercept():
        raise ValueError(f"more than {DIRECT_FEATURES} features: only least squares with an intercept and no weights is fitted")
    return fit_ridge(
        train, estimator.getFeaturesCol(), estimator.getLabelCol(), estimator.getRegParam(), estimator.getPredictionCol()
    )


def feature_importance(model: Model, names: Sequence[str], spark) -> DataFrame:
    """(feature, importance) for every feature, zeros included; one row per model input."""
    values = model.featureImportances.toArray()
    return spark.createDataFrame(
        [(name, float(value)) for name, value in zip(names, values, strict=True)],
        "feature string, importance double",
    )

"""Binary classification of the 28-feature table: prepare, fit or tune, report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType

from tabloom.config import SIGNAL_FEATURES, SIGNAL_LABEL
from tabloom.operators.columns import cast_double, cast_double_once
from tabloom.operators.features import assemble
from tabloom.operators.filters import drop_any_missing
from tabloom.operators.metrics import classification_report
from tabloom.operators.models import feature_importance, fit
from tabloom.operators.sampling import split_train_test, subsample_small
from tabloom.operators.tuning import Tuned, cross_validate

ROW_ID = "row_id"


def prepare_signal(
    raw: DataFrame, features: Sequence[str] = SIGNAL_FEATURES, label: str = SIGNAL_LABEL, key: str = ROW_ID
) -> DataFrame:
    """(key, features, label): cast to double, drop incomplete rows, assemble. A map over the scan."""
    rows = raw.select(key, label, *(f"`{c}`" for c in features))
    text = any(isinstance(rows.schema[c].dataType, StringType) for c in (label, *features))
    typed = (cast_double_once if text else cast_double)(rows, [label, *features])
    assembled = assemble(drop_any_missing(typed), features, "features")
    # With the two classes named, fitting needs no pass to count them, and fails on any other label.
    classes = {"ml_attr": {"type": "nominal", "num_vals": 2, "name": label}}
    return assembled.select(key, "features", F.col(label).alias(label, metadata=classes))


@dataclass(frozen=True)
class Fitted:
    model: Model
    scored: DataFrame

    def report(self) -> DataFrame:
        """(auc, accuracy, scored_rows) on the held-out rows."""
        return classification_report(self.scored)

    def importances(self, features: Sequence[str] = SIGNAL_FEATURES) -> DataFrame:
        return feature_importance(self.model, features, self.scored.sparkSession)


def fit_classifier(prepared: DataFrame, estimator: Estimator, key: str = ROW_ID) -> Fitted:
    """70/30 split, fit with fixed settings, score the held-out rows."""
    train, test = split_train_test(prepared, key)
    model = fit(estimator, train)
    return Fitted(model, model.transform(test))


def tune_classifier(
    prepared: DataFrame, estimator: Estimator, grid: Mapping[str, Sequence], key: str = ROW_ID, **options
) -> tuple[Tuned, Fitted]:
    """5% subsample, 70/30 split inside it, grid search, score the held-out rows with the best model."""
    train, test = split_train_test(subsample_small(prepared, key), key)
    tuned = cross_validate(estimator, train, grid, key=key, **options)
    return tuned, Fitted(tuned.best_model, tuned.best_model.transform(test))

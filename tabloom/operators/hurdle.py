"""Two-stage regression of a target that is mostly zero."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame

from tabloom.operators.filters import predicted_positive, train_positive
from tabloom.operators.models import fit


@dataclass(frozen=True)
class HurdleModel:
    """Classifier for "is there an amount", regression for "how much"."""

    classifier: Model
    regressor: Model

    def classify(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(df)

    def apply(self, df: DataFrame) -> DataFrame:
        """All rows with the class, and the amount the regression gives whatever the class is."""
        return self.regressor.transform(self.classify(df))

    def transform(self, df: DataFrame) -> DataFrame:
        """Rows the classifier marks 1, with the predicted amount; other rows are not scored."""
        return self.regressor.transform(predicted_positive(self.classify(df)))


def hurdle_regression(
    train: DataFrame, classifier: Estimator, regressor: Estimator, label: str
) -> HurdleModel:
    """Fit the classifier on all rows and the regressor on rows whose label is 1."""
    return HurdleModel(fit(classifier, train), fit(regressor, train_positive(train, label)))

"""Zero-inflated claim amounts: prepare, balance, regress in one stage or two."""

from __future__ import annotations

import warnings
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.sql import DataFrame

from tabloom.config import CLAIMS, MISSING_LIMIT_PCT, ClaimsRoles
from tabloom.functions.missing import is_missing_text
from tabloom.operators.columns import cast_double, derive_binary_label, drop_columns
from tabloom.operators.features import MAX_DRIVER_LABELS, StringDictionary, assemble, encode_categories, fit_string_index
from tabloom.operators.filters import drop_any_missing
from tabloom.operators.hurdle import HurdleModel, hurdle_regression
from tabloom.operators.impute import IMPUTED, fill_mean, fill_mode
from tabloom.operators.metrics import regression_report, two_stage_report
from tabloom.operators.models import elastic_net, fit, forest_deep, gaussian_glm
from tabloom.operators.profile import (
    category_summary,
    continuous_profile,
    missing_rate_from_counts,
    prune_by_missing_rate,
    value_counts,
)
from tabloom.operators.sampling import split_train_test, undersample_majority

CATEGORY_VECTOR = "catfeatures"
FINAL_VECTOR = "finalvector"


@dataclass(frozen=True)
class ClaimsPreparation:
    """What the preparation learned from a table; `transform` applies it to any table."""

    roles: ClaimsRoles
    categorical_rates: dict[str, tuple[float, bool]]  # column -> (missing_pct, keep)
    continuous_rates: dict[str, tuple[float, bool]]
    modes: dict[str, str]
    dictionary: StringDictionary
    means: dict[str, float]

    @property
    def nominal(self) -> list[str]:
        return [c for c in self.roles.nominal if c in self.modes]

    @property
    def ordinal(self) -> list[str]:
        return [c for c in self.roles.ordinal if c in self.modes]

    @property
    def vector_inputs(self) -> list[str]:
        categories = [CATEGORY_VECTOR] if self.nominal else []
        return [*(c + IMPUTED for c in self.means), *categories, *self.ordinal]

    def rates_table(self, spark) -> DataFrame:
        """(column, missing_pct, keep) of every profiled column."""
        rows = [(c, *r) for c, r in {**self.categorical_rates, **self.continuous_rates}.items()]
        return spark.createDataFrame(rows, "column string, missing_pct double, keep boolean")

    def clean(self, raw: DataFrame) -> DataFrame:
        """Label, drop, impute, cast, and keep complete rows: all before any vector is built."""
        roles = self.roles
        pruned = [c for c in roles.categorical if c not in self.modes]
        df = drop_columns(derive_binary_label(raw, roles.target, roles.label), [*roles.identifiers, *pruned])
        df = cast_double(fill_mode(df, self.modes), [roles.target, *self.ordinal, *self.means])
        df = drop_columns(fill_mean(df, self.means), roles.continuous)
        # Filled columns hold no gaps: testing the others alone keeps the same rows
        # and lets the test reach the scan. A filled ordinal may still be no number.
        filled = {*self.nominal, *(c + IMPUTED for c in self.means), roles.label}
        return drop_any_missing(df, [c for c in df.columns if c not in filled])

    def encode(self, clean: DataFrame) -> DataFrame:
        """Add the vector of the one-hot encoded categories."""
        if not self.nominal:
            return clean
        return encode_categories(clean, self.dictionary, self.nominal, CATEGORY_VECTOR)

    def vectorize(self, clean: DataFrame) -> DataFrame:
        """Row id, target, label, final vector, and columns that play no part."""
        vectors = assemble(self.encode(clean), self.vector_inputs, FINAL_VECTOR)
        used = {*self.nominal, *self.vector_inputs}
        return vectors.select(*(f"`{c}`" for c in clean.columns if c not in used), FINAL_VECTOR)

    def transform(self, raw: DataFrame) -> DataFrame:
        return self.vectorize(self.clean(raw))


def fit_claims_preparation(
    raw: DataFrame,
    roles: ClaimsRoles = CLAIMS,
    limit: float = MISSING_LIMIT_PCT,
    prune_continuous: bool = False,
    max_labels: int = MAX_DRIVER_LABELS,
) -> ClaimsPreparation:
    """Two scans: one counts the values of all categories, one profiles all numbers.

    Missing rates, modes and index labels all follow from the value counts: the
    mode leads the frequency order, so filling gaps with it leaves the order as
    it is. At most `max_labels` labels of all categories together are brought to the
    driver; columns beyond that are indexed by joins, with the same result. Pruning continuous columns by their missing rate is optional; their
    rates are reported either way.
    """
    counts = value_counts(raw, roles.categorical).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        summary = {r["column"]: r for r in category_summary(counts).collect()}
        categorical = {c: _decision(100 * summary[c]["missing"] / summary[c]["row_count"], limit) for c in summary}
        modes = {c: summary[c]["mode"] for c in roles.categorical if c in summary and categorical[c][1]}
        dictionary = fit_string_index(
            counts.filter(~is_missing_text("value")),
            [c for c in roles.nominal if c in modes],
            max_labels,
            sizes={c: r["labels"] for c, r in summary.items()},
        )
    finally:
        counts.unpersist()
    profile = {r["column"]: r for r in continuous_profile(raw, roles.continuous).collect()}
    continuous = {c: _decision(r["missing_pct"], limit) for c, r in profile.items()}
    means = {}
    for column, row in profile.items():
        if row["mean"] is None:
            warnings.warn(f"{column} holds no number and is left out", stacklevel=2)
        elif continuous[column][1] or not prune_continuous:
            means[column] = row["mean"]
    return ClaimsPreparation(roles, categorical, continuous, modes, dictionary, means)


def _decision(missing_pct: float | None, limit: float) -> tuple[float | None, bool]:
    return missing_pct, missing_pct is not None and missing_pct < limit


def prepare_claims(raw: DataFrame, roles: ClaimsRoles = CLAIMS, **options) -> DataFrame:
    return fit_claims_preparation(raw, roles, **options).transform(raw)


@dataclass(frozen=True)
class Balanced:
    """Training and test rows for the claim models."""

    preparation: ClaimsPreparation
    train: DataFrame
    test: DataFrame
    persisted: DataFrame

    def release(self) -> None:
        self.persisted.unpersist()


def balance_and_split(
    raw: DataFrame, roles: ClaimsRoles = CLAIMS, *, train_only: bool = False, **options
) -> Balanced:
    """Undersample the zero claims, then split 70/30.

    By default everything is learned and balanced on all rows before the split.
    `train_only` splits first and learns and balances on the training rows alone,
    so the test rows keep their natural class balance. Row order means nothing
    to the estimators, so no shuffle is planned here.

    The balanced rows, a small part of the table, are persisted for the fits;
    call `release` when done.
    """
    def balanced(rows: DataFrame) -> tuple[ClaimsPreparation, DataFrame]:
        # Count and undersample the cleaned scalars: only rows that stay get a vector.
        preparation = fit_claims_preparation(rows, roles, **options)
        kept = undersample_majority(preparation.clean(rows), roles.row_id, roles.label)
        return preparation, preparation.vectorize(kept).persist(StorageLevel.MEMORY_AND_DISK)

    if train_only:
        train_raw, test_raw = split_train_test(raw, roles.row_id)
        preparation, train = balanced(train_raw)
        return Balanced(preparation, train, preparation.transform(test_raw), train)
    preparation, rows = balanced(raw)
    return Balanced(preparation, *split_train_test(rows, roles.row_id), rows)


@dataclass(frozen=True)
class LinearResult:
    model: Model
    scored: DataFrame
    roles: ClaimsRoles = CLAIMS

    def report(self) -> DataFrame:
        """(mse, mae, scored_rows) over all test rows."""
        return regression_report(self.scored, self.roles.target)


def regress_claims(rows: Balanced, roles: ClaimsRoles = CLAIMS, **settings) -> LinearResult:
    """One elastic-net regression of the amount on all balanced rows."""
    model = fit(elastic_net(FINAL_VECTOR, roles.target, **settings), rows.train)
    return LinearResult(model, model.transform(rows.test), roles)


@dataclass(frozen=True)
class TwoStageResult:
    model: HurdleModel
    test: DataFrame
    roles: ClaimsRoles = CLAIMS

    def classified(self) -> DataFrame:
        return self.model.classify(self.test)

    def scored(self) -> DataFrame:
        return self.model.transform(self.test)

    def report(self) -> DataFrame:
        """(accuracy, mse, mae, scored_rows); the errors cover only rows predicted to be claims."""
        return two_stage_report(self.model.apply(self.test), self.roles.label, self.roles.target)


def regress_claims_two_stage(rows: Balanced, roles: ClaimsRoles = CLAIMS) -> TwoStageResult:
    """Forest for claim or no claim, GLM for the amount of a claim."""
    model = hurdle_regression(
        rows.train,
        forest_deep(FINAL_VECTOR, roles.label),
        gaussian_glm(FINAL_VECTOR, roles.target),
        roles.label,
    )
    return TwoStageResult(model, rows.test, roles)


def claim_rates(raw: DataFrame, roles: ClaimsRoles = CLAIMS) -> DataFrame:
    """(column, missing_pct, keep) of the categories and the numbers."""
    categorical = missing_rate_from_counts(value_counts(raw, roles.categorical))
    return prune_by_missing_rate(categorical).unionByName(
        prune_by_missing_rate(continuous_profile(raw, roles.continuous))
    )


"""Column roles, thresholds and model settings.

Fixed values: the column names of the two input tables and the model settings
below must equal those of the studied programs for results to be comparable.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- fixed values: binary-classification table (header-less CSV, by position) ---
SIGNAL_LABEL = "label"
SIGNAL_FEATURES = (
    "lepton pT", "lepton eta", "lepton phi",
    "missing energy magnitude", "missing energy phi",
    "jet 1 pt", "jet 1 eta", "jet 1 phi", "jet 1 b-tag",
    "jet 2 pt", "jet 2 eta", "jet 2 phi", "jet 2 b-tag",
    "jet 3 pt", "jet 3 eta", "jet 3 phi", "jet 3 b-tag",
    "jet 4 pt", "jet 4 eta", "jet 4 phi", "jet 4 b-tag",
    "m_jj", "m_jjj", "m_lv", "m_jlv", "m_bb", "m_wbb", "m_wwbb",
)
SIGNAL_COLUMNS = (SIGNAL_LABEL, *SIGNAL_FEATURES)

# --- fixed values: missing-value marker, pruning threshold, seed ---
SENTINEL = "?"
MISSING_LIMIT_PCT = 30.0
SEED = 42
TRAIN_FRACTION = 0.7
SUBSAMPLE_FRACTION = 0.05
FOLDS = 3
FIT_PARALLELISM = 9

# --- fixed values: model settings ---
FOREST = {"numTrees": 3, "maxBins": 20, "maxDepth": 7, "featureSubsetStrategy": "all"}
FOREST_DEEP = {"maxDepth": 10}
BOOSTED = {"maxBins": 16, "maxDepth": 7, "maxIter": 15}
ELASTIC_NET = {"regParam": 0.1, "elasticNetParam": 0.5}
GAUSSIAN_GLM = {"family": "gaussian", "regParam": 0.01}

# --- fixed values: tuning grids (the forest keeps 3 trees throughout) ---
FOREST_GRID = {
    "maxDepth": (3, 5, 7),
    "maxBins": (16, 20, 24),
    "featureSubsetStrategy": ("all", "onethird", "log2"),
}
BOOSTED_GRID = {"maxDepth": (3, 5, 7), "maxBins": (16, 20, 24), "maxIter": (5, 10, 15)}


@dataclass(frozen=True)
class ClaimsRoles:
    """Which column of a claims table plays which part."""

    row_id: str = "Row_ID"
    identifiers: tuple[str, ...] = (
        "Household_ID", "Vehicle", "Calendar_Year", "Model_Year",
        "Blind_Make", "Blind_Model", "Blind_Submodel",
    )
    nominal: tuple[str, ...] = (*(f"Cat{i}" for i in range(1, 13)), "NVCat")
    ordinal: tuple[str, ...] = ("OrdCat",)
    continuous: tuple[str, ...] = (
        *(f"Var{i}" for i in range(1, 9)),
        *(f"NVVar{i}" for i in range(1, 5)),
    )
    target: str = "Claim_Amount"
    label: str = "binaryclaim"

    @property
    def categorical(self) -> tuple[str, ...]:
        return (*self.nominal, *self.ordinal)

    @property
    def numeric(self) -> tuple[str, ...]:
        return (self.target, *self.ordinal, *self.continuous)


CLAIMS = ClaimsRoles()

# Column order of the claims CSV file.
CLAIMS_COLUMNS = (
    CLAIMS.row_id,
    *CLAIMS.identifiers,
    *(f"Cat{i}" for i in range(1, 13)), "OrdCat",
    *(f"Var{i}" for i in range(1, 9)),
    "NVCat",
    *(f"NVVar{i}" for i in range(1, 5)),
    CLAIMS.target,
)

"""The same results in plain SQL, for an independent check on another engine.

Each statement starts from `lineitem` and states its query without looking at
the Spark code; only the derivation of the input columns is shared.
"""

from __future__ import annotations

from tabloom.config import (
    CLAIMS,
    CLAIMS_COLUMNS,
    FOREST,
    FOREST_GRID,
    MISSING_LIMIT_PCT,
    SIGNAL_COLUMNS,
    SIGNAL_FEATURES,
)
from tabloom.plans.queries import KEPT_CATEGORICAL, KEPT_NOMINAL, PAIR, SEARCH_BINS, SEARCH_FEATURES
from tabloom.sources.derived import CLAIMS_SQL, HASHES, ROW_ID_SQL, SIGNAL_SQL, SIGNAL_TEXT_SQL, WORDS

ORACLE: dict[str, str] = {}


def _hex(salt: str, start: int, length: int) -> str:
    return f"CAST(concat('0x', substr(md5(concat('{salt}:', row_id)), {start}, {length})) AS BIGINT)"


def _list(parts) -> str:
    return ",\n  ".join(parts)


def _q(name: str) -> str:
    return f'"{name}"'


def _columns(exprs: dict[str, str]) -> str:
    return _list(f"{sql} AS {_q(name)}" for name, sql in exprs.items())


BASE = f"""WITH keyed AS (SELECT *, {ROW_ID_SQL} AS row_id FROM lineitem),
hashed AS (SELECT *,
  {_list(f"{_hex(salt, 1, 15)}{' % 1000000' * (name in ('m', 'n'))} AS {name}" for name, salt in HASHES.items())},
  {_list(f"{_hex(salt, start, 15)} AS {name}" for name, (salt, start) in WORDS.items())}
  FROM keyed)"""

SIGNAL = f"""{BASE},
signal AS (SELECT row_id, sp, fold_hash, small, under,
  {_columns(SIGNAL_SQL)} FROM hashed)"""

SIGNAL_TEXT = f"""{BASE},
signal_text AS (SELECT row_id,
  {_columns(SIGNAL_TEXT_SQL)} FROM hashed)"""

CLAIMS_CTE = f"""{BASE},
claims AS (SELECT sp, under, {_columns({c: CLAIMS_SQL[c] for c in CLAIMS_COLUMNS})} FROM hashed)"""


def _present(c: str) -> str:
    return f"({c} IS NOT NULL AND {c} <> '?')"


def _number(c: str) -> str:
    """The number in a text column, null for NaN and for anything else."""
    return f"CASE WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN NULL ELSE TRY_CAST({c} AS DOUBLE) END"


# --- sources and previews ---

_signal_names = ", ".join(_q(c) for c in SIGNAL_COLUMNS)
_continuous = ", ".join(CLAIMS.continuous)

ORACLE["scan_csv_positional"] = f"{SIGNAL_TEXT} SELECT {_signal_names} FROM signal_text"
ORACLE["scan_csv_header"] = f"{CLAIMS_CTE} SELECT {', '.join(CLAIMS_COLUMNS)} FROM claims"
ORACLE["preview_rows"] = f"{CLAIMS_CTE} SELECT Row_ID, {_continuous} FROM claims ORDER BY Row_ID LIMIT 20"
ORACLE["preview_full_vectors"] = f"""{SIGNAL},
top AS (SELECT * FROM signal ORDER BY row_id LIMIT 10)
""" + " UNION ALL ".join(
    f"SELECT row_id, CAST({i} AS INTEGER) AS pos, {_q(c)} AS value FROM top"
    for i, c in enumerate(SIGNAL_FEATURES)
)
ORACLE["describe_schema"] = f"{SIGNAL_TEXT} " + " UNION ALL ".join(
    f"SELECT CAST({i} AS BIGINT) AS pos, '{c}' AS name, '{t}' AS type,"
    f" count({'row_id' if c == 'row_id' else f'TRY_CAST({_q(c)} AS DOUBLE)'}) AS present FROM signal_text"
    for i, (c, t) in enumerate([("row_id", "string"), *((c, "double") for c in SIGNAL_COLUMNS)])
)

# --- projections ---

ORACLE["rename_positional"] = f"{SIGNAL_TEXT} SELECT row_id, {_signal_names} FROM signal_text"
_cast_signal = ", ".join(f"TRY_CAST({_q(c)} AS DOUBLE) AS {_q(c)}" for c in SIGNAL_COLUMNS)
ORACLE["cast_all_double"] = f"{SIGNAL_TEXT} SELECT {_cast_signal} FROM signal_text"
_cast_claims = ", ".join(f"TRY_CAST({c} AS DOUBLE) AS {c}" for c in CLAIMS.numeric)
ORACLE["cast_subset_double"] = f"{CLAIMS_CTE} SELECT Row_ID, {_cast_claims} FROM claims"
ORACLE["select_columns"] = f"{CLAIMS_CTE} SELECT Row_ID, {_continuous} FROM claims"
ORACLE["drop_columns"] = (
    f"{CLAIMS_CTE} SELECT {', '.join(c for c in CLAIMS_COLUMNS if c not in CLAIMS.identifiers)} FROM claims"
)

_amount = _number("Claim_Amount")
_label = f"CASE WHEN {_amount} > 0 THEN 1.0E0 ELSE 0.0E0 END"
ORACLE["derive_binary_label"] = (
    f"{CLAIMS_CTE} SELECT Row_ID, Claim_Amount, {_label} AS binaryclaim FROM claims"
)
ORACLE["replace_sentinel"] = f"""{CLAIMS_CTE} SELECT Row_ID,
  CASE WHEN Cat1 = '?' THEN 'N' ELSE Cat1 END AS Cat1,
  CASE WHEN NVCat = '?' THEN 'N0' ELSE NVCat END AS NVCat FROM claims"""
ORACLE["fill_null_literal"] = f"""{CLAIMS_CTE} SELECT Row_ID,
  coalesce(Cat1, 'N') AS Cat1, coalesce(NVCat, 'N0') AS NVCat FROM claims"""

# --- filters ---

_pair = ", ".join(_q(c) for c in PAIR)
ORACLE["filter_label_equals"] = f"{SIGNAL} SELECT row_id, label, {_pair} FROM signal WHERE label = 1"
ORACLE["filter_is_null"] = f"{CLAIMS_CTE} SELECT Row_ID, Cat3 FROM claims WHERE Cat1 IS NULL"
ORACLE["filter_sentinel"] = f"{CLAIMS_CTE} SELECT Row_ID, Cat1 FROM claims WHERE Cat1 = '?'"
ORACLE["filter_is_nan"] = f"{CLAIMS_CTE} SELECT Row_ID FROM claims WHERE isnan(TRY_CAST(Var3 AS DOUBLE))"
_kinds = {c: f"CASE WHEN {c} IS NULL THEN 'null' WHEN {c} = '?' THEN 'sentinel' END" for c in CLAIMS.categorical}
_kinds |= {
    c: f"""CASE WHEN {c} IS NULL THEN 'null' WHEN {c} = '?' THEN 'sentinel' WHEN TRY_CAST({c} AS DOUBLE) IS NULL THEN 'text'
  WHEN isnan(TRY_CAST({c} AS DOUBLE)) THEN 'nan' END"""
    for c in CLAIMS.continuous
}
ORACLE["missing_cells"] = f"{CLAIMS_CTE} " + " UNION ALL ".join(
    f"""SELECT Row_ID, '{c}' AS "column", {sql} AS kind FROM claims WHERE {sql} IS NOT NULL""" for c, sql in _kinds.items()
)
_complete_signal = " AND ".join(
    f"({_q(c)} IS NOT NULL AND NOT isnan({_q(c)}))" for c in SIGNAL_COLUMNS
)
_typed_signal = f"""{SIGNAL_TEXT},
typed AS (SELECT row_id, {_cast_signal} FROM signal_text),
complete AS (SELECT * FROM typed WHERE {_complete_signal})"""
ORACLE["drop_any_missing"] = f"{_typed_signal} SELECT * FROM complete"

LABELLED = f"""{CLAIMS_CTE},
numbers AS (SELECT Row_ID, sp, under, {_amount} AS Claim_Amount, {_label} AS binaryclaim,
  {', '.join(f"{_number(c)} AS {c}" for c in ("NVVar2", "Var5", "NVVar1"))} FROM claims),
labelled AS (SELECT * FROM numbers WHERE Claim_Amount IS NOT NULL AND NVVar2 IS NOT NULL
  AND Var5 IS NOT NULL AND NVVar1 IS NOT NULL)"""
_labelled = "Row_ID, Claim_Amount, binaryclaim, NVVar2, Var5, NVVar1"
ORACLE["filter_train_positive"] = (
    f"{LABELLED} SELECT {_labelled} FROM labelled WHERE sp < 807045053224792832 AND binaryclaim = 1"
)
ORACLE["filter_predicted_positive"] = (
    f"{LABELLED} SELECT {_labelled}, 1.0E0 AS prediction FROM labelled WHERE NVVar1 >= 84"
)

# --- aggregations ---

ORACLE["row_count"] = f"{CLAIMS_CTE} SELECT count(*) AS row_count FROM claims"
ORACLE["class_balance"] = f"""{SIGNAL}
SELECT count(*) FILTER (label = 0) AS zeros, count(*) FILTER (label = 1) AS ones,
  round(count(*) FILTER (label = 1) / CAST(count(*) FILTER (label = 0) AS DOUBLE), 6) AS imbalance
FROM signal"""
_pct = "CAST(count(*) FILTER ({0}) AS DOUBLE) / count(*) * 100"
ORACLE["missing_rate_categorical"] = f"{CLAIMS_CTE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS row_count, count(*) FILTER ({c} IS NULL) AS nulls,
  count(*) FILTER ({c} = '?') AS sentinels,
  round({_pct.format(f"NOT {_present(c)} OR {c} IS NULL")}, 6) AS missing_pct FROM claims"""
    for c in CLAIMS.categorical
)
ORACLE["missing_rate_continuous"] = f"{CLAIMS_CTE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS row_count,
  count(*) FILTER (TRY_CAST({c} AS DOUBLE) IS NULL) AS nulls, count(*) FILTER ({c} = '?') AS sentinels,
  count(*) FILTER (isnan(TRY_CAST({c} AS DOUBLE))) AS nans,
  round({_pct.format(f"({_number(c)}) IS NULL")}, 6) AS missing_pct FROM claims"""
    for c in CLAIMS.continuous
)


def _value_counts(table: str, columns) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, count(*) AS count FROM {table} GROUP BY {c}"""
        for c in columns
    )


ORACLE["value_counts"] = f"{CLAIMS_CTE} {_value_counts('claims', CLAIMS.categorical)}"

# Mode imputation: one scalar subquery per column.
MODES = f"{CLAIMS_CTE},\n" + _list(
    f"mode_{c} AS (SELECT {c} AS v FROM claims WHERE {_present(c)} GROUP BY {c}"
    f" ORDER BY count(*) DESC, {c} LIMIT 1)"
    for c in KEPT_CATEGORICAL
)
_filled = {
    c: f"CASE WHEN {c} IS NULL OR {c} = '?' THEN (SELECT v FROM mode_{c}) ELSE {c} END"
    for c in KEPT_CATEGORICAL
}
FILLED = f"""{MODES},
filled AS (SELECT Row_ID, sp, under, Claim_Amount, {_continuous}, {_columns(_filled)} FROM claims)"""
# Which columns are kept is decided here as well, by their rate of missing values.
_kept = {
    c: f"(SELECT {_pct.format(f"{c} IS NULL OR {c} = '?'")} FROM claims) < {MISSING_LIMIT_PCT:.1f}E0"
    for c in CLAIMS.categorical
}
_kept_filled = {
    c: f"""CASE WHEN {_kept[c]} THEN CASE WHEN {_present(c)} THEN {c} ELSE (SELECT {c} FROM claims
  WHERE {_present(c)} GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) END END"""
    for c in CLAIMS.categorical
}
ORACLE["impute_mode"] = f"{CLAIMS_CTE} SELECT Row_ID, {_columns(_kept_filled)} FROM claims"
ORACLE["value_counts_imputed"] = f"{CLAIMS_CTE} " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {sql} AS value, count(*) AS count FROM claims WHERE {_kept[c]} GROUP BY value"""
    for c, sql in _kept_filled.items()
)
ORACLE["most_common_value"] = f"{CLAIMS_CTE} " + " UNION ALL ".join(
    f"""(SELECT '{c}' AS "column", {c} AS value, count(*) AS count FROM claims WHERE {_present(c)}
  GROUP BY {c} ORDER BY count DESC, value LIMIT 1)"""
    for c in CLAIMS.categorical
)
_rates = " UNION ALL ".join(
    [
        f"""SELECT '{c}' AS "column", {_pct.format(f"{c} IS NULL OR {c} = '?'")} AS pct FROM claims"""
        for c in CLAIMS.categorical
    ]
    + [
        f"""SELECT '{c}' AS "column", {_pct.format(f"({_number(c)}) IS NULL")} AS pct FROM claims"""
        for c in CLAIMS.continuous
    ]
)
ORACLE["prune_by_missing_rate"] = f"""{CLAIMS_CTE},
rates AS ({_rates})
SELECT "column", round(pct, 6) AS missing_pct, pct < {MISSING_LIMIT_PCT:.1f}E0 AS keep FROM rates"""
FACTOR = f"""{LABELLED},
factor AS (SELECT count(*) FILTER (binaryclaim = 0) AS zeros, count(*) FILTER (binaryclaim = 1) AS ones,
  greatest(1, CAST(floor(count(*) FILTER (binaryclaim = 0) / CAST(count(*) FILTER (binaryclaim = 1) AS DOUBLE))
    AS BIGINT)) AS factor FROM labelled)"""
ORACLE["imbalance_factor"] = f"{FACTOR} SELECT zeros, ones, factor FROM factor"

# --- sorts ---

ORACLE["sort_by_count"] = f"""{CLAIMS_CTE},
counts AS ({_value_counts('claims', CLAIMS.categorical)})
SELECT "column", value, count,
  row_number() OVER (ORDER BY "column", count, value NULLS FIRST) AS position FROM counts"""
ORACLE["shuffle_rows"] = f"""{SIGNAL}
SELECT row_id, label, row_number() OVER (ORDER BY md5(concat('shuffle:', row_id)), row_id) AS position FROM signal"""
ORACLE["top_1"] = f"""{CLAIMS_CTE},
counts AS ({_value_counts('claims', CLAIMS.categorical)})
""" + " UNION ALL ".join(
    f"""(SELECT "column", value, count FROM counts WHERE "column" = '{c}'
  ORDER BY count DESC, value NULLS LAST LIMIT 1)"""
    for c in CLAIMS.categorical
)
ORACLE["shuffle_rows_rng"] = f"{SIGNAL} SELECT row_id, label FROM signal"

# --- sampling and union ---

_part = "CASE WHEN sp < 807045053224792832 THEN 'train' ELSE 'test' END AS part"
ORACLE["split_train_test"] = f"{SIGNAL} SELECT row_id, label, {_part} FROM signal"
ORACLE["subsample_small"] = f"{SIGNAL} SELECT row_id, label, {_part} FROM signal WHERE small < 57646075230342352"
BALANCED = f"""{FACTOR},
balanced AS (SELECT * FROM labelled WHERE binaryclaim = 1
  OR (binaryclaim = 0 AND under < floor(1152921504606846976.0E0 * (1.0E0 / (SELECT CAST(factor AS DOUBLE) FROM factor)))))"""
ORACLE["sample_fraction"] = f"""{FACTOR}
SELECT Row_ID, binaryclaim FROM labelled WHERE binaryclaim = 0
  AND under < floor(1152921504606846976.0E0 * (1.0E0 / (SELECT CAST(factor AS DOUBLE) FROM factor)))"""
ORACLE["undersample_majority"] = f"{BALANCED} SELECT Row_ID, binaryclaim FROM balanced"
ORACLE["split_train_test_rng_parts"] = f"""{SIGNAL}
SELECT row_id, label, count(*) AS copies FROM signal GROUP BY ALL"""
for _name in ("rf_classify_rows", "gbt_classify_rows"):
    ORACLE[_name] = f"{SIGNAL} SELECT row_id, label, TRUE AS valid FROM signal WHERE sp >= 807045053224792832"
for _name in ("feature_importance_total", "gbt_feature_importance_total"):
    ORACLE[_name] = f"""SELECT CAST({len(SIGNAL_FEATURES)} AS BIGINT) AS features, 1.0E0 AS total, TRUE AS valid
FROM lineitem LIMIT 1"""
ORACLE["union_all"] = f"""{SIGNAL}
SELECT row_id, label FROM signal WHERE small < 57646075230342352
UNION ALL SELECT row_id, label FROM signal WHERE label = 1"""

# --- features ---

_means = {c: f"(SELECT avg({_number(c)}) FROM claims)" for c in CLAIMS.continuous}
_imputed = {f"{c}_imp": f"coalesce({_number(c)}, {_means[c]})" for c in CLAIMS.continuous}
ORACLE["impute_mean"] = (
    f"{CLAIMS_CTE} SELECT Row_ID, "
    + _list(f"round({sql}, 6) AS {name}" for name, sql in _imputed.items())
    + " FROM claims"
)

# Index and slot offset of every label; the indexes are learned before incomplete rows go.
PREPARED = f"""{FILLED},
""" + _list(
    f"""index_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY count(*) DESC, {c}) - 1 AS i,
    count(*) OVER () AS width FROM filled GROUP BY {c})"""
    for c in KEPT_NOMINAL
) + f""",
scalars AS (SELECT Row_ID, sp, under, {_amount} AS Claim_Amount, {_label} AS binaryclaim,
  TRY_CAST(OrdCat AS DOUBLE) AS ordinal, {', '.join(KEPT_NOMINAL)},
  {_columns(_imputed)} FROM filled AS claims),
clean AS (SELECT * FROM scalars WHERE Claim_Amount IS NOT NULL AND ordinal IS NOT NULL),
prepared AS (SELECT clean.*, {_list(f"index_{c}.i AS i_{c}, index_{c}.width AS w_{c}" for c in KEPT_NOMINAL)}
  FROM clean {" ".join(f"JOIN index_{c} ON clean.{c} = index_{c}.v" for c in KEPT_NOMINAL)})"""
ORACLE["string_index"] = (
    f"{PREPARED} SELECT Row_ID, "
    + _list(f"CAST(i_{c} AS DOUBLE) AS {c}_ind" for c in KEPT_NOMINAL)
    + " FROM prepared"
)
ORACLE["string_index_by_join"] = ORACLE["string_index"]
MEANS = f"""{PREPARED},
clean_factor AS (SELECT greatest(1, CAST(floor(count(*) FILTER (binaryclaim = 0)
  / CAST(count(*) FILTER (binaryclaim = 1) AS DOUBLE)) AS BIGINT)) AS factor FROM clean),
train AS (SELECT * FROM clean WHERE sp < 807045053224792832 AND (binaryclaim = 1
  OR under < floor(1152921504606846976.0E0 * (1.0E0 / (SELECT CAST(factor AS DOUBLE) FROM clean_factor)))))"""
_mean = "count(*) AS rows, round(avg(Claim_Amount), 2) AS mean_target, round(avg(Claim_Amount), 2) AS mean_prediction"
ORACLE["linreg_elastic_net_mean"] = f"{MEANS} SELECT {_mean} FROM train"
ORACLE["glm_gaussian_mean"] = f"{MEANS} SELECT {_mean} FROM train WHERE binaryclaim = 1"
# Certificates: SQL states the rows they cover, and that nothing is off.
ORACLE["rf_classify_deep_leaves"] = f"""{MEANS} SELECT count(*) AS rows, sum(binaryclaim) AS positives,
  CAST(1 AS BIGINT) AS excess, CAST(0 AS BIGINT) AS differing FROM train"""
for _name, _trees in (("rf_classify_splits", FOREST["numTrees"]), ("gbt_classify_splits", 1)):
    ORACLE[_name] = f"""{SIGNAL} SELECT count(*) AS rows, sum(label) AS positives, CAST({_trees} AS BIGINT) AS excess,
  CAST(0 AS BIGINT) AS violations, CAST(0 AS BIGINT) AS miscounted FROM signal WHERE sp < 807045053224792832"""
_slot_count = " + ".join(["12", *(f"(SELECT count(*) FROM index_{c})" for c in KEPT_NOMINAL), "1"])
for _name in ("linreg_elastic_net_optimal", "glm_gaussian_optimal"):
    ORACLE[_name] = f"{PREPARED} SELECT unnest(generate_series(0, {_slot_count} - 1)) AS position, TRUE AS met"
ORACLE["glm_gaussian_wide"] = f"""{PREPARED}, submodels AS (SELECT count(DISTINCT Blind_Submodel) AS n FROM claims)
SELECT unnest(generate_series(0, {_slot_count} + (SELECT n FROM submodels) - 1)) AS position, TRUE AS met"""
ORACLE["one_hot_encode"] = (
    f"{PREPARED} SELECT Row_ID, "
    + _list(f"concat(i_{c}, '/', w_{c}) AS {c}_hot" for c in KEPT_NOMINAL)
    + " FROM prepared"
)
_elements = _list(f"{_q(c)} AS e{i}" for i, c in enumerate(SIGNAL_FEATURES))
ORACLE["assemble_numeric"] = f"{SIGNAL} SELECT row_id, {_elements} FROM signal"
_width = " + ".join(f"w_{c}" for c in KEPT_NOMINAL)
_slots = [
    " + ".join([*(f"w_{c}" for c in KEPT_NOMINAL[:k]), f"i_{KEPT_NOMINAL[k]}"])
    for k in range(len(KEPT_NOMINAL))
]
_hot = f"concat_ws(',', {', '.join(f'CAST({s} AS VARCHAR)' for s in _slots)})"
ORACLE["assemble_onehot"] = (
    f"{PREPARED} SELECT Row_ID, CAST({_width} AS BIGINT) AS width, {_hot} AS hot FROM prepared"
)
_final = f"""{_list(f"round({c}_imp, 6) AS {c}_imp" for c in CLAIMS.continuous)},
  CAST({len(CLAIMS.continuous)} + {_width} + 1 AS BIGINT) AS width, ordinal"""
ORACLE["assemble_mixed"] = f"{PREPARED} SELECT Row_ID, {_final} FROM prepared"
ORACLE["prepare_claims"] = (
    f"{PREPARED} SELECT Row_ID, binaryclaim, Claim_Amount, {_final}, {_hot} AS hot FROM prepared"
)
ORACLE["prepare_signal"] = f"{_typed_signal} SELECT row_id, label, {_elements} FROM complete"

# --- evaluation on a fixed score ---

_score = f"round(2 * {_q(PAIR[0])} / 50 + {_q(PAIR[1])} / 50000, 2)"
SCORED = f"""{SIGNAL},
scored AS (SELECT label, under, {_score} AS score, CASE WHEN {_score} > 1.8E0 THEN 1.0E0 ELSE 0.0E0 END AS prediction
  FROM signal)"""


def _auc(table: str, score: str, label: str = "label", where: str = "") -> str:
    """Rank-sum form: average ranks of the ones."""
    return f"""SELECT (sum(r) FILTER (label = 1) - p * (p + 1) / 2) / (p * q) AS auc FROM (
  SELECT {label} AS label, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0E0 AS r,
    CAST(count(*) FILTER ({label} = 1) OVER () AS DOUBLE) AS p,
    CAST(count(*) FILTER ({label} = 0) OVER () AS DOUBLE) AS q FROM {table} {where}) GROUP BY p, q"""


ORACLE["auc_roc"] = f"{SCORED}, area AS ({_auc('scored', 'score')}) SELECT round(auc, 9) AS auc FROM area"
ORACLE["auc_roc_hot_score"] = f"""{SCORED},
hot AS (SELECT label, CASE WHEN under % 100 = 0 THEN score ELSE 1.0E0 END AS score FROM scored),
area AS ({_auc('hot', 'score')}) SELECT round(auc, 9) AS auc FROM area"""
ORACLE["accuracy"] = f"""{SCORED}
SELECT round(avg(CASE WHEN label = prediction THEN 1.0E0 ELSE 0.0E0 END), 6) AS accuracy FROM scored"""
ORACLE["mse"] = f"{SCORED} SELECT round(avg((label - score) * (label - score)), 6) AS mse FROM scored"
ORACLE["mae"] = f"{SCORED} SELECT round(avg(abs(label - score)), 6) AS mae FROM scored"

# --- tuning ---

_grid = [(d, b, s) for d in FOREST_GRID["maxDepth"] for b in FOREST_GRID["maxBins"]
         for s in FOREST_GRID["featureSubsetStrategy"]]
ORACLE["param_grid"] = f"""{SIGNAL},
train AS (SELECT fold_hash % 3 AS fold FROM signal WHERE small < 57646075230342352 AND sp < 807045053224792832),
folds AS (SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n FROM train GROUP BY fold),
points AS (SELECT unnest([{', '.join(f"'{d}/{b}/{s}'" for d, b, s in _grid)}]) AS point, fold, n FROM folds)
SELECT fold, CAST((SELECT sum(n) FROM folds) - n AS BIGINT) AS train_rows, n AS held_out_rows,
  split_part(point, '/', 1) AS maxDepth, split_part(point, '/', 2) AS maxBins,
  split_part(point, '/', 3) AS featureSubsetStrategy FROM points"""

# --- models, reduced settings ---


def _best_split(name: str, table: str, value: str, where: str = "TRUE") -> str:
    """Exhaustive search: the feature and threshold that most reduce the variance of `value`."""
    long = " UNION ALL ".join(
        f"SELECT {i} AS feature, {_q(c)} AS x, {value} AS y FROM {table} WHERE {where}"
        for i, c in enumerate(SEARCH_FEATURES)
    )
    return f"""{name}_values AS (SELECT feature, x, count(*) AS n, sum(y) AS s FROM ({long}) GROUP BY feature, x),
{name}_left AS (SELECT feature, x, sum(n) OVER w AS ln, sum(s) OVER w AS ls,
    sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
  FROM {name}_values WINDOW w AS (PARTITION BY feature ORDER BY x)),
{name} AS (SELECT feature, x AS cut, ls / ln AS low, (s - ls) / (n - ln) AS high FROM {name}_left WHERE ln < n
  ORDER BY ls * ls / ln + (s - ls) * (s - ls) / (n - ln) DESC LIMIT 1)"""


def _value(split: str) -> str:
    """A row's value of the feature a one-row split table cuts."""
    cases = " ".join(f"WHEN {split}.feature = {i} THEN {_q(c)}" for i, c in enumerate(SEARCH_FEATURES))
    return f"CASE {cases} END"


def _leaf(split: str) -> str:
    """The value of the leaf a row falls into, for a one-row split table joined to it."""
    return f"CASE WHEN {_value(split)} <= {split}.cut THEN {split}.low ELSE {split}.high END"


STUMP = f"{SIGNAL},\n{_best_split('stump', 'signal', 'label', 'sp < 807045053224792832')}"
_p = _leaf("stump")
ORACLE["rf_classify_stump"] = f"""{STUMP},
leaf AS (SELECT row_id, label, {_p} AS p FROM signal, stump WHERE sp >= 807045053224792832)
SELECT row_id, label, CASE WHEN p > 0.5E0 THEN 1.0E0 ELSE 0.0E0 END AS prediction,
  round(p, 6) AS probability FROM leaf"""

# Two levels: leaves of one parent that vote alike become one leaf with the parent's mean.
ORACLE["rf_classify_two_levels"] = f"""{SIGNAL},
{_best_split('root', 'signal', 'label', 'sp < 807045053224792832')},
halves AS (SELECT signal.*, {_value('root')} > root.cut AS upper FROM signal, root),
{_best_split('c0', 'halves', 'label', 'sp < 807045053224792832 AND NOT upper')},
{_best_split('c1', 'halves', 'label', 'sp < 807045053224792832 AND upper')},
tree AS (SELECT (c0.low > 0.5E0) = (c0.high > 0.5E0) AS merged0, (c1.low > 0.5E0) = (c1.high > 0.5E0) AS merged1,
  (root.low > 0.5E0) = (root.high > 0.5E0) AS alike, root.low AS p0, root.high AS p1,
  (SELECT avg(label) FROM signal WHERE sp < 807045053224792832) AS p FROM root, c0, c1),
leaf AS (SELECT row_id, label, CASE WHEN merged0 AND merged1 AND alike THEN p
    WHEN upper THEN CASE WHEN merged1 THEN p1 ELSE {_leaf('c1')} END
    ELSE CASE WHEN merged0 THEN p0 ELSE {_leaf('c0')} END END AS p
  FROM halves, c0, c1, tree WHERE sp >= 807045053224792832)
SELECT row_id, label, CASE WHEN p > 0.5E0 THEN 1.0E0 ELSE 0.0E0 END AS prediction,
  round(p, 6) AS probability FROM leaf"""
ORACLE["feature_importance_stump"] = f"{STUMP} " + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CASE WHEN feature = {i} THEN 1.0E0 ELSE 0.0E0 END AS importance FROM stump"
    for i, c in enumerate(SEARCH_FEATURES)
)

# Round 1 fits -1/+1; round 2 fits the gradient of the log loss at the round-1 margin,
# and enters with the step size 0.1.
ORACLE["gbt_classify_two_rounds"] = f"""{SIGNAL},
signed AS (SELECT *, 2 * label - 1 AS y FROM signal),
{_best_split('first', 'signed', 'y', 'sp < 807045053224792832')},
margin AS (SELECT signed.*, {_leaf('first')} AS f1 FROM signed, first),
residual AS (SELECT *, 4 * y / (1 + exp(2 * y * f1)) AS g FROM margin),
{_best_split('second', 'residual', 'g', 'sp < 807045053224792832')},
boosted AS (SELECT row_id, label, f1 + 0.1E0 * ({_leaf('second')}) AS f FROM margin, second WHERE sp >= 807045053224792832)
SELECT row_id, label, CASE WHEN f > 0 THEN 1.0E0 ELSE 0.0E0 END AS prediction,
  round(1 / (1 + exp(-2 * f)), 6) AS probability FROM boosted"""

# The first point of the reduced search has no split: its scores are all equal.
TUNED = f"""{SIGNAL},
small AS (SELECT *, fold_hash % 3 AS fold FROM signal WHERE small < 57646075230342352),
train AS (SELECT * FROM small WHERE sp < 807045053224792832),
""" + _list(
    f"""{_best_split(f'fold{k}', 'train', 'label', f'fold <> {k}')},
scores{k} AS (SELECT label, {_leaf(f'fold{k}')} AS p FROM train, fold{k} WHERE fold = {k}),
area{k} AS ({_auc(f'scores{k}', 'p')})"""
    for k in range(3)
)
_avg = "round(((SELECT auc FROM area0) + (SELECT auc FROM area1) + (SELECT auc FROM area2)) / 3, 6) AS avg_auc"
ORACLE["cross_validate_stump"] = f"""{TUNED}
SELECT CAST(0 AS INTEGER) AS setting, '0' AS maxDepth, 0.5E0 AS avg_auc
UNION ALL SELECT CAST(1 AS INTEGER) AS setting, '1' AS maxDepth, {_avg}"""
ORACLE["best_params_stump"] = f"{TUNED} SELECT CAST(1 AS INTEGER) AS setting, '1' AS maxDepth, {_avg}"
ORACLE["score_best_stump"] = f"""{SIGNAL},
small AS (SELECT * FROM signal WHERE small < 57646075230342352),
{_best_split('stump', 'small', 'label', 'sp < 807045053224792832')},
scored AS (SELECT label, {_p} AS p FROM small, stump WHERE sp >= 807045053224792832),
area AS ({_auc('scored', 'p')})
SELECT round((SELECT auc FROM area), 6) AS auc,
  round(avg(CASE WHEN label = CASE WHEN p > 0.5E0 THEN 1.0E0 ELSE 0.0E0 END THEN 1.0E0 ELSE 0.0E0 END), 6) AS accuracy,
  count(*) AS scored_rows FROM scored"""


def _two_feature_fit(name: str, table: str, where: str, reg: float, alpha: float) -> str:
    """Penalised least squares on two standardised features, by the normal equations.

    With k = reg / sd(y): (1 + k(1-alpha)) b1 + r12 b2 = r1 - k alpha sign(b1), and
    likewise for b2, which holds while neither coefficient is shrunk to zero. The signs
    are those of the coefficients without a penalty, r1 - r12 r2 and r2 - r12 r1.
    """
    return f"""{name}_m AS (SELECT corr(NVVar1, Claim_Amount) AS r1, corr(Var5, Claim_Amount) AS r2,
    corr(NVVar1, Var5) AS r12, stddev_pop(NVVar1) AS s1, stddev_pop(Var5) AS s2,
    stddev_pop(Claim_Amount) AS sy, avg(NVVar1) AS m1, avg(Var5) AS m2, avg(Claim_Amount) AS my,
    {reg}E0 / stddev_pop(Claim_Amount) AS k FROM {table} WHERE {where}),
{name}_e AS (SELECT *, 1 + k * (1 - {alpha}E0) AS d, r1 - k * {alpha}E0 * sign(r1 - r12 * r2) AS c1,
    r2 - k * {alpha}E0 * sign(r2 - r12 * r1) AS c2 FROM {name}_m),
{name}_b AS (SELECT *, (d * c1 - r12 * c2) / (d * d - r12 * r12) * sy / s1 AS b1,
    (d * c2 - r12 * c1) / (d * d - r12 * r12) * sy / s2 AS b2 FROM {name}_e),
{name} AS (SELECT b1, b2, my - b1 * m1 - b2 * m2 AS b0 FROM {name}_b)"""


_line = "b0 + b1 * NVVar1 + b2 * Var5"
ORACLE["linreg_elastic_net_pair"] = f"""{LABELLED},
{_two_feature_fit('line', 'labelled', 'sp < 807045053224792832', 0.1, 0.5)},
errors AS (SELECT b0, b1, b2, Claim_Amount - ({_line}) AS e FROM labelled, line WHERE sp >= 807045053224792832)
SELECT round(avg(e * e), 4) AS mse, round(avg(abs(e)), 4) AS mae, count(*) AS scored_rows,
  round(b0, 4) AS b0, round(b1, 4) AS b1, round(b2, 4) AS b2 FROM errors GROUP BY b0, b1, b2"""
ORACLE["glm_gaussian_pair"] = f"""{LABELLED},
{_two_feature_fit('line', 'labelled', 'sp < 807045053224792832 AND binaryclaim = 1', 0.01, 0.0)}
SELECT Row_ID, Claim_Amount, round({_line}, 4) AS combo_prediction FROM labelled, line WHERE sp >= 807045053224792832"""
ORACLE["hurdle_regression_pair"] = f"""{BALANCED},
flags AS (SELECT *, NVVar1 >= 84 AS high FROM balanced),
votes AS (SELECT high, avg(binaryclaim) > 0.5E0 AS claim FROM flags WHERE sp < 807045053224792832 GROUP BY high),
{_two_feature_fit('line', 'flags', 'sp < 807045053224792832 AND binaryclaim = 1', 0.01, 0.0)},
errors AS (SELECT claim, claim = (binaryclaim = 1) AS hit, Claim_Amount - ({_line}) AS e
  FROM flags JOIN votes USING (high), line WHERE sp >= 807045053224792832)
SELECT round(avg(CASE WHEN hit THEN 1.0E0 ELSE 0.0E0 END), 6) AS accuracy,
  round(avg(e * e) FILTER (claim), 4) AS mse, round(avg(abs(e)) FILTER (claim), 4) AS mae,
  count(*) FILTER (claim) AS scored_rows FROM errors"""

"""Validation texts.

Fixed values: callers match on these texts, so they stay as they are.
"""

ID_NULLS = "Expected no missing values for id variable, got column with nulls instead"
TARGET_NULLS = "Expected no missing values for target variable, got column with nulls instead"
ID_NULLS_SOURCE = (
    "Expected no missing values for id variable in source, got column with nulls instead"
)
TARGET_NULLS_SOURCE = (
    "Expected no missing values for target variable in source, got column with nulls instead"
)
COLUMN_NULLS = "Expected no missing values for `{role}`, got column with nulls instead"
COLUMN_INVALID = "Expected a valid `{role}`, got {name} instead"
COLUMNS_INVALID = "Expected valid variable names for {roles}, got {names} instead"
COLUMNS_NULLS = "Expected no missing values for {roles}, got columns with nulls instead"
SORT_NULLS_SOURCE = (
    "Expected no missing values for `sort_by_variable` in source, got column with nulls instead"
)
SAME_KEYS = (
    "Expected `keep_record_order` to be `True` only if source and dest "
    "have same indices, got source and dest with different indices"
)
REFERENCES_INVALID = "Expected all reference variables in dataset columns, got {names} instead."
REFERENCES_NULLS = (
    "Expected no missing values for `references`, got column with missing values instead"
)
DROP_WITHOUT_RENAME = (
    "Expected drop_original_target to be False if a target_rename is None, got {value} instead"
)
REFERENCE_NOT_FOUND = "variable {name} cannot be found in the dataframe variables"
PERTURBATION_NOT_FOUND = "variables {names} cannot be found in the dataframe"
THRESHOLDS_INVALID = "Expected valid variables in variable_thresholds"
GENERIC_INCOMPLETE = "Expected both of (global_threshold, min_unique), got{value} instead."
THRESHOLDS_CHOICE = (
    "Expected variable_thresholds or (threshold, min_unique),got variable_thresholds {mapping} "
    "and (threshold, min_unique) {generic} instead."
)
TOO_MUCH_VARIABILITY = (
    "You have too much variability in your categorical data. "
    "You can increase your `row_limit`, reduce your categorical variability, or build "
    "your own batch pipeline."
)


def tick(*roles: str) -> str:
    """`` `a`, `b` and `c` ``."""
    quoted = [f"`{r}`" for r in roles]
    return ", ".join(quoted[:-1]) + " and " + quoted[-1] if len(quoted) > 1 else quoted[0]


def quote(*names: object) -> str:
    """``'a', 'b' and 'c'``."""
    quoted = [f"'{n}'" for n in names]
    return ", ".join(quoted[:-1]) + " and " + quoted[-1] if len(quoted) > 1 else quoted[0]

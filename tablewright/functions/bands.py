"""Threshold bands over dataset shapes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


# Fixed values: (upper bound, value) of each tier, and the value beyond the last.
IMBALANCE_TIERS, IMBALANCE_BEYOND = ((1.5, "balanced"), (3, "moderate"), (10, "high")), "very high"
FOLD_TIERS, FOLDS_BEYOND = ((20, 2), (50, 3), (100, 4), (1000, 5)), 3
BUDGET_TIERS, BUDGET_BEYOND = ((10_000, 60), (100_000, 120), (1_000_000, 180), (10_000_000, 300)), 600
# Labels of the treatments.
TREATMENTS = {"sparse": "Sparse (MaxAbsScaler)", "mixed": "Mixte (Numerical + Categorical)", "numbers": "Numerical standard"}


def _tier(x: Column, tiers: tuple, beyond, start: Column | None = None) -> Column:
    out = start
    for limit, value in tiers:
        out = F.when(x < limit, value) if out is None else out.when(x < limit, value)
    return out.otherwise(beyond)


def imbalance_level(ratio: Column, n_classes: Column) -> Column:
    return _tier(ratio, IMBALANCE_TIERS, IMBALANCE_BEYOND, F.when(n_classes <= 1, "N/A"))


def treatment_label(is_sparse: Column, n_categorical: Column) -> Column:
    return F.when(is_sparse, TREATMENTS["sparse"]).when(n_categorical > 0, TREATMENTS["mixed"]).otherwise(TREATMENTS["numbers"])


def fold_count(n: Column) -> Column:
    return _tier(n, FOLD_TIERS, FOLDS_BEYOND).cast("bigint")


def time_budget_seconds(n: Column, d: Column) -> Column:
    return _tier(n * d, BUDGET_TIERS, BUDGET_BEYOND).cast("bigint")


def percent_text(x: Column, digits: int) -> Column:
    """x is a fraction; '12.34%'. Halves go to the even digit."""
    return F.format_string(f"%.{digits}f%%", F.bround(x * 100, digits))

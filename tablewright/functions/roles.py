"""Feature roles from a type list."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, functions as F

NUMERICAL, CATEGORICAL, OTHER = "numerical", "categorical", "other"


def role_of(text: Column) -> Column:
    """Role of one type line as an expression; numerical wins when both match."""
    return (
        F.when(text.contains("Numerical") | F.lower(text).contains("numeric"), NUMERICAL)
        .when(F.lower(text).contains("categorical"), CATEGORICAL)
        .otherwise(OTHER)
    )


def role_name(text: str | None) -> str:
    if text and ("Numerical" in text or "numeric" in text.lower()):
        return NUMERICAL
    if text and "categorical" in text.lower():
        return CATEGORICAL
    return OTHER


@dataclass(frozen=True)
class Roles:
    """Column names by role, in output order: numerical, categorical, other."""

    numerical: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    other: tuple[str, ...] = ()

    @property
    def ordered(self) -> tuple[str, ...]:
        return self.numerical + self.categorical + self.other


def assign_roles(columns: Sequence[str], types: Sequence[str] | None) -> Roles:
    """Types count only when there is one per column; otherwise all are numerical.

    When no line names a known role, everything is imputed and scaled as well.
    """
    if not types or len(types) != len(columns):
        return Roles(tuple(columns))
    named = [(c, role_name(t)) for c, t in zip(columns, types)]
    num = tuple(c for c, r in named if r == NUMERICAL)
    cat = tuple(c for c, r in named if r == CATEGORICAL)
    rest = tuple(c for c, r in named if r == OTHER)
    if not num and not cat:
        return Roles(tuple(columns))
    return Roles(num, cat, rest)

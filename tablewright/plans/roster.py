"""Which models and parameter grids a dataset's shape calls for.

The rules are one table; each row names a model, the condition on the training
shape under which it is offered, and its grid. The same conditions exist as
DataFrame expressions, so a table of many dataset profiles gets its rosters in
one query.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from tablewright.functions.bands import BUDGET_BEYOND, BUDGET_TIERS, FOLD_TIERS, FOLDS_BEYOND, fold_count, time_budget_seconds

Grid = dict[str, list[Any]]
CLS, REG = "classification", "regression"


@dataclass(frozen=True)
class Shape:
    """Training shape. Every field may be a number or a Column."""

    n: Any
    d: Any
    sparse: Any = False

    def big(self):
        return (self.d > 1000) | (self.n > 5000)


@dataclass(frozen=True)
class Rule:
    task: str
    big: bool
    model: str
    when: Callable[[Shape], Any]
    grid: Callable[[Shape], Grid]


@dataclass
class Candidate:
    model: str
    grid: Grid = field(default_factory=dict)

    def points(self) -> list[dict[str, Any]]:
        """Every combination: keys sorted, the last key varying fastest."""
        keys = sorted(self.grid)
        return [dict(zip(keys, values)) for values in product(*(self.grid[k] for k in keys))]


def _always(s: Shape):
    return s.n >= 0


def _dense(s: Shape):
    return s.sparse == False  # noqa: E712  also builds a Column


def _sparse(s: Shape):
    return s.sparse == True  # noqa: E712


def _fixed(**grid: list[Any]) -> Callable[[Shape], Grid]:
    return lambda s: dict(grid)


# The parameter grids of every model, per size tier.
SGD_CLASSIFIER = dict(
    loss=["log_loss", "hinge", "modified_huber"],
    penalty=["l2", "l1", "elasticnet"],
    alpha=[0.0001, 0.001, 0.01],
    l1_ratio=[0, 0.15, 0.5, 0.85, 1],
    learning_rate=["optimal", "adaptive"],
)
SGD_REGRESSOR = dict(
    loss=["squared_error", "huber", "epsilon_insensitive"],
    penalty=["l2", "l1", "elasticnet"],
    alpha=[0.0001, 0.001, 0.01],
    l1_ratio=[0, 0.15, 0.5, 0.85, 1],
    learning_rate=["optimal", "invscaling", "adaptive"],
)
RIDGE_SOLVERS = ["auto", "svd", "cholesky", "lsqr", "sparse_cg"]


# The solvers of logistic regression on big data, each with its shapes and grid. The first that holds counts.
LOGISTIC_BIG = (
    (lambda s: _dense(s) & (s.d > s.n), dict(C=[0.1, 1, 10], penalty=["l2"], solver=["liblinear"])),
    (lambda s: _dense(s) & (s.n <= 10_000), dict(C=[0.1, 1, 10], solver=["lbfgs"])),
    (lambda s: s.d > 1000, dict(C=[0.1, 1, 10], penalty=["l2", "elasticnet"], l1_ratio=[0, 0.5, 1], solver=["saga"])),
    (_always, dict(C=[0.1, 1, 10], penalty=["l2", "elasticnet"], l1_ratio=[0.5], solver=["saga"])),
)


def _first_of(rows: tuple) -> Callable[[Shape], Grid]:
    return lambda s: dict(next(grid for holds, grid in rows if holds(s)))


def _forest_classes(s: Shape) -> Grid:
    return dict(
        n_estimators=[50, 100] if s.n > 500 else [50],
        max_depth=[5, 10, None] if s.d < 500 else [5, 10],
        min_samples_split=[2, 5, 10],
        max_features=["sqrt", "log2", None],
    )


def _forest_values(s: Shape) -> Grid:
    return dict(
        n_estimators=[50, 100, 200] if s.n > 1000 else [50, 100],
        max_depth=[5, 10, 20, None],
        min_samples_split=[2, 5, 10],
        max_features=["sqrt", "log2", None],
    )


# Offered models in roster order, with the shape limits of each.
RULES: tuple[Rule, ...] = (
    Rule(CLS, True, "LinearSVC", _always, _fixed(C=[0.1, 1, 10], penalty=["l2"], loss=["squared_hinge"])),
    Rule(CLS, True, "RidgeClassifier", _always, _fixed(alpha=[0.1, 1, 10, 100], solver=RIDGE_SOLVERS)),
    Rule(CLS, True, "SGDClassifier", lambda s: (s.n > 5000) | (s.d > 5000), _fixed(**SGD_CLASSIFIER)),
    Rule(CLS, True, "LogisticRegression", lambda s: s.d <= 5000, _first_of(LOGISTIC_BIG)),
    Rule(CLS, True, "LDA", lambda s: (s.d > 1000) & _dense(s) & (s.n < 100_000),
         _fixed(shrinkage=[None, "auto", 0.5, 0.9], solver=["lsqr", "eigen"])),
    Rule(CLS, True, "MultinomialNB", _sparse, _fixed(alpha=[0.1, 0.5, 1.0], fit_prior=[True, False])),
    Rule(CLS, True, "GaussianNB", lambda s: _dense(s) & (s.d < 1000), _fixed(var_smoothing=[1e-9, 1e-8, 1e-7])),
    Rule(CLS, True, "DecisionTree", lambda s: (s.d < 50_000) & (s.n < 50_000),
         _fixed(max_depth=[5, 10, 15], min_samples_split=[10, 20, 30], min_samples_leaf=[5, 10, 20])),
    Rule(CLS, False, "RandomForest", _always, _forest_classes),
    Rule(CLS, False, "LogisticRegression", _always,
         lambda s: dict(C=[0.01, 0.1, 1, 10], penalty=["l2"], solver=["saga" if s.sparse else "lbfgs"])),
    Rule(CLS, False, "KNN", lambda s: (s.d < 1000) & (s.n < 5000),
         _fixed(n_neighbors=[3, 5, 7, 9], weights=["uniform", "distance"],
                metric=["euclidean", "manhattan", "minkowski"])),
    Rule(CLS, False, "LinearSVC", _sparse, _fixed(C=[0.01, 0.1, 1, 10], penalty=["l2"], loss=["squared_hinge"])),
    Rule(CLS, False, "MultinomialNB", _sparse, _fixed(alpha=[0.1, 0.5, 1.0, 2.0])),
    Rule(CLS, False, "GaussianNB", lambda s: _dense(s) & (s.d < 1000),
         _fixed(var_smoothing=[1e-9, 1e-8, 1e-7, 1e-6])),
    Rule(CLS, False, "LDA", lambda s: _dense(s) & (s.d < 1000) & (s.n > s.d),
         _fixed(solver=["svd", "lsqr", "eigen"], shrinkage=[None, "auto"])),
    Rule(CLS, False, "DecisionTree", lambda s: s.n > 50,
         _fixed(max_depth=[3, 5, 10, 15, None], min_samples_split=[2, 5, 10, 20],
                min_samples_leaf=[1, 2, 5, 10], criterion=["gini", "entropy"])),
    Rule(CLS, False, "ExtraTrees", lambda s: s.n > 100,
         _fixed(n_estimators=[50, 100], max_depth=[5, 10, None], min_samples_split=[2, 5, 10])),
    Rule(CLS, False, "GradientBoosting", lambda s: (s.n > 100) & (s.d < 1000),
         _fixed(n_estimators=[50, 100], learning_rate=[0.01, 0.05, 0.1], max_depth=[3, 5, 7],
                subsample=[0.8, 1.0])),
    Rule(REG, True, "LinearSVR", _always,
         _fixed(C=[0.1, 1, 10], epsilon=[0.1, 0.2, 0.5],
                loss=["epsilon_insensitive", "squared_epsilon_insensitive"])),
    Rule(REG, True, "Ridge", _always, _fixed(alpha=[0.1, 1, 10, 100, 1000], solver=RIDGE_SOLVERS)),
    Rule(REG, True, "SGDRegressor", lambda s: (s.n > 5000) | (s.d > 5000), _fixed(**SGD_REGRESSOR)),
    Rule(REG, True, "Lasso", lambda s: (s.d > 1000) & (s.n > 100),
         _fixed(alpha=[0.001, 0.01, 0.1, 1], max_iter=[1000, 2000])),
    Rule(REG, True, "ElasticNet", lambda s: (s.d < 20_000) & (s.n < 50_000),
         _fixed(alpha=[0.001, 0.01, 0.1, 1], l1_ratio=[0.1, 0.3, 0.5, 0.7, 0.9])),
    Rule(REG, False, "RandomForest", _always, _forest_values),
    Rule(REG, False, "Ridge", _always,
         _fixed(alpha=[0.01, 0.1, 1, 10, 100], solver=["auto", "svd", "cholesky"])),
    Rule(REG, False, "KNN", lambda s: (s.d < 1000) & (s.n < 5000),
         _fixed(n_neighbors=[3, 5, 7, 9, 11], weights=["uniform", "distance"],
                metric=["euclidean", "manhattan", "minkowski"])),
    Rule(REG, False, "LinearSVR", _always, _fixed(C=[0.01, 0.1, 1, 10], epsilon=[0.1, 0.2, 0.5],
                                                  loss=["epsilon_insensitive"])),
    Rule(REG, False, "Lasso", _always, _fixed(alpha=[0.001, 0.01, 0.1, 1, 10], selection=["cyclic", "random"])),
    Rule(REG, False, "DecisionTree", lambda s: s.n > 50,
         _fixed(max_depth=[3, 5, 10, 15, 20, None], min_samples_split=[2, 5, 10, 20],
                min_samples_leaf=[1, 2, 5, 10],
                criterion=["squared_error", "friedman_mse", "absolute_error"])),
    Rule(REG, False, "ExtraTrees", lambda s: s.n > 100,
         _fixed(n_estimators=[50, 100, 200], max_depth=[5, 10, 20, None], min_samples_split=[2, 5, 10])),
    Rule(REG, False, "GradientBoosting", lambda s: (s.n > 100) & (s.d < 1000),
         _fixed(n_estimators=[50, 100, 200], learning_rate=[0.01, 0.05, 0.1], max_depth=[3, 5, 7],
                subsample=[0.8, 0.9, 1.0])),
    Rule(REG, False, "ElasticNet", lambda s: s.n > 200,
         _fixed(alpha=[0.001, 0.01, 0.1, 1, 10], l1_ratio=[0.1, 0.3, 0.5, 0.7, 0.9])),
)


def candidates(task: str, n: int, d: int, sparse: bool = False) -> list[Candidate]:
    """Models with their full grids for a training shape, in roster order."""
    s = Shape(n, d, sparse)
    return [Candidate(r.model, r.grid(s)) for r in RULES if r.task == task and r.big == bool(s.big()) and r.when(s)]


def roster_table(profiles: DataFrame) -> DataFrame:
    """``dataset, model, roster_order`` for profiles with task, n, d, is_sparse."""
    s = Shape(F.col("n"), F.col("d"), F.col("is_sparse"))

    def offer(i: int, r: Rule) -> Column:
        ok = (F.col("task") == r.task) & (s.big() == F.lit(r.big)) & r.when(s)
        return F.when(ok, F.struct(F.lit(r.model).alias("model"), F.lit(i).cast("bigint").alias("roster_order")))

    offers = F.array(*[offer(i, r) for i, r in enumerate(RULES)])
    return profiles.select("dataset", F.inline(F.filter(offers, lambda x: x.isNotNull())))


# Parameters that leave the optimum unchanged, per model.
SAME_OPTIMUM = {
    "RidgeClassifier": ("solver",),
    "Ridge": ("solver",),
    "Lasso": ("selection", "max_iter"),
    "SGDClassifier": ("learning_rate",),
    "SGDRegressor": ("learning_rate",),
}


def canonical(model: str, point: dict[str, Any]) -> dict[str, Any] | None:
    """The point without parameters that cannot change the result; None when it is invalid."""
    p = {k: v for k, v in point.items() if k not in SAME_OPTIMUM.get(model, ())}
    if model in ("SGDClassifier", "SGDRegressor"):
        ratio = {"l2": 0, "l1": 1}.get(p.pop("penalty"), p.get("l1_ratio"))
        p["l1_ratio"] = ratio
    if model == "LogisticRegression":
        if p.get("penalty", "l2") == "l2":
            p["l1_ratio"] = 0
        p["penalty"] = "l2" if p["l1_ratio"] == 0 else "elasticnet"
    if model == "KNN" and p["metric"] == "minkowski":
        p["metric"] = "euclidean"
    if model == "LDA":
        if p["solver"] == "svd" and p.get("shrinkage") is not None:
            return None
        if p["solver"] == "eigen":
            p["solver"] = "lsqr"
    if model == "DecisionTree" and p.get("criterion") == "friedman_mse":
        p["criterion"] = "squared_error"  # the same cut is best under both
    return p


def distinct_points(c: Candidate) -> list[dict[str, Any]]:
    """Grid points with different optima, in grid order."""
    seen, out = set(), []
    for point in c.points():
        p = canonical(c.model, point)
        key = None if p is None else tuple(sorted((k, str(v)) for k, v in p.items()))
        if key is not None and key not in seen:
            seen.add(key)
            out.append(p)
    return out


MAX_VALUES = 1000  # of a parameter


def expand_grid(tables: list[DataFrame]) -> DataFrame:
    """Cartesian product of parameter tables of one column; more values than a grid can hold are an error."""
    out = tables[0].sparkSession.range(1)
    for t in tables:
        values = [r[0] for r in t.distinct().limit(MAX_VALUES + 1).collect()]
        if len(values) > MAX_VALUES:
            raise ValueError(f"{t.columns[0]} has more than {MAX_VALUES} values")
        out = out.select("*", F.explode(F.array(*[F.lit(v) for v in sorted(values)])).alias(t.columns[0]))
    return out.drop("id")


def cv_folds(n: int) -> int:
    return next((k for limit, k in FOLD_TIERS if n < limit), FOLDS_BEYOND)


def scoring(task: str) -> str:
    known = {CLS: "accuracy", REG: "neg_mean_squared_error"}
    if task not in known:
        raise ValueError(f"unknown task {task}")
    return known[task]


def time_budget(n: int, d: int) -> int:
    return next((t for limit, t in BUDGET_TIERS if n * d < limit), BUDGET_BEYOND)


# Preferred models per task and shape, best first.
SHORTLISTS = {
    "sparse": ["LinearSVC", "SGDClassifier", "MultinomialNB", "RidgeClassifier"],
    "wide_classes": ["LinearSVC", "RidgeClassifier", "SGDClassifier", "LDA"],
    "long_classes": ["LinearSVC", "RidgeClassifier", "RandomForest", "SGDClassifier"],
    "classes": ["RandomForest", "LogisticRegression", "GradientBoosting", "ExtraTrees"],
    "wide_values": ["LinearSVR", "Ridge", "SGDRegressor", "Lasso"],
    "long_values": ["LinearSVR", "Ridge", "RandomForest", "SGDRegressor"],
    "values": ["RandomForest", "GradientBoosting", "Ridge", "ElasticNet"],
}


def _names(case: str, *more: str) -> Column:
    return F.array(*[F.lit(m) for m in (*SHORTLISTS[case], *more)])


def shortlist(task: Column, is_sparse: Column, n: Column, d: Column) -> Column:
    """ARRAY<STRING> of preferred models."""
    cls = task == CLS
    return (
        F.when(cls & is_sparse & (d < 10_000), _names("sparse", "LogisticRegression"))
        .when(cls & is_sparse, _names("sparse"))
        .when(cls & (d > 10_000), _names("wide_classes"))
        .when(cls & (n > 10_000), _names("long_classes"))
        .when(cls, _names("classes"))
        .when(d > 10_000, _names("wide_values"))
        .when(n > 10_000, _names("long_values"))
        .otherwise(_names("values"))
    )


def plan_table(profiles: DataFrame) -> DataFrame:
    """Folds, time budget and shortlist per dataset profile."""
    return profiles.select(
        "dataset",
        "task",
        fold_count(F.col("n")).alias("cv_folds"),
        time_budget_seconds(F.col("n"), F.col("d")).alias("budget_seconds"),
        shortlist(F.col("task"), F.col("is_sparse"), F.col("n"), F.col("d")).alias("shortlist"),
    )

"""Cross-validated search over candidate models.

Preparation is learned inside each fold, but never by another pass: the fold
moments give it for every training subset. Models are searched in families:

* closed-form models: all points and folds from the moments, scored in one pass;
* iterative linear models: all points, folds and classes share each pass;
* neighbours: one neighbour table per metric serves every k and weighting;
* trees: points that differ in stopping rules share their trees, and all grow in the same passes.
"""

from __future__ import annotations

import traceback
from contextvars import ContextVar
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from tablewright.errors import NoModelError
from tablewright.functions.roles import Roles
from tablewright.operators import closed, neighbors
from tablewright.operators.design import (
    MAX_GRAM,
    TEST,
    SparseEncoding,
    dense_encoding,
    dense_rows,
    learned_preparation,
    packed,
    sparse_rows,
    sparse_vectors,
)
from tablewright.operators.discriminant import fit_discriminants
from tablewright.operators.linear import fit_linear
from tablewright.operators.moments import Moments, feature_maps, fold_moments, fourth_moments
from tablewright.operators.scoring import KEYS, TIMES, evaluate_scorers, predict_rows
from tablewright.operators.trees import TREES, equal_rows, fit_points
from tablewright.plans.deadline import Deadline
from tablewright.plans.roster import CLS, Candidate, distinct_points
from tablewright.session import map_arrow, spread

CLOSED = ("RidgeClassifier", "LDA", "GaussianNB", "MultinomialNB", "Ridge", "Lasso", "ElasticNet")
QUADRATIC = ("RidgeClassifier", "Ridge", "Lasso", "ElasticNet")  # wide tables: the same optimum by passes
ITERATIVE = ("LinearSVC", "SGDClassifier", "LogisticRegression", "LinearSVR", "SGDRegressor")


@dataclass
class Point:
    model: str
    params: dict[str, Any]
    scores: dict[int, float] = field(default_factory=dict)
    error: str | None = None

    def mean(self, k: int) -> float:
        """Unweighted mean over folds; NaN when any fold is missing."""
        return float(np.mean([self.scores[f] for f in range(k)])) if len(self.scores) == k else float("nan")


@dataclass
class ModelResult:
    model: str
    order: int
    params: dict[str, Any]
    cv_score: float
    fitted: Any = None
    error: str | None = None

    @property
    def ok(self) -> bool:
        return self.error is None


class TrainingTable:
    """Encoded, cached rows with their folds; everything the model families share.

    ``df`` holds the key columns, the features, ``fold`` (-1: test) and a class
    index or number in ``y``. ``dealt``: every core has its share already.
    """

    def __init__(self, df: DataFrame, task: str, n_classes: int, k: int, roles: Roles | None = None,
                 n_features: int | None = None, keep: dict[str, str] | None = None, dealt: bool = False):
        self.df, self.task, self.k, self.keep = df, task, k, keep or {}
        self.n_classes = n_classes if task == CLS else 1
        self.sparse = roles is None
        if self.sparse:
            self.enc = SparseEncoding(n_features)
            rows = sparse_rows(df, "y", "fold", list(self.keep))
        else:
            self.enc = dense_encoding(df, roles)
            rows = dense_rows(df, self.enc, "y", "fold", list(self.keep))
        self.rows = (rows if dealt else spread(rows)).persist()
        self.moments: Moments | None = None
        self.maps: list = []
        self._groups: DataFrame | None = None
        self._blocks: DataFrame | None = None

    @property
    def blocks(self) -> DataFrame:
        """What passes over the training rows read: packed, where that is possible; made once."""
        if self._blocks is None:
            fast = packed(self.rows, self.enc)
            self._blocks = fast if fast is self.rows else fast.persist()
        return self._blocks

    def groups(self, drawn: bool = True) -> DataFrame:
        """Equal training rows as one, for trees of large tables, with their keys if trees draw rows; kept."""
        if self._groups is None or drawn != (KEYS in self._groups.columns):
            if self._groups is not None:
                self._groups.unpersist()
            self._groups = equal_rows(self.rows, list(self.keep), drawn).persist()
        return self._groups

    @property
    def judged(self) -> DataFrame:
        """Rows that scorers are measured on: the groups of equal rows, where trees needed them."""
        if self._groups is None:
            return self.blocks
        return self._groups.withColumn(TIMES, F.size(KEYS)).drop(KEYS) if KEYS in self._groups.columns else self._groups

    @property
    def wide(self) -> bool:
        """Too many columns for matrices of columns x columns on the driver: the fits run on passes instead."""
        return self.enc.width > MAX_GRAM

    def learn(self, gram: bool, class_gram: bool) -> None:
        self.moments = fold_moments(self.blocks, self.enc, self.k, self.n_classes, gram and not self.wide, class_gram and not self.wide)
        self.maps = feature_maps(self.enc, self.moments, self.rows)

    def vectors(self, t: int) -> DataFrame:
        """``keep, fold, y, features`` with the preparation of training subset ``t``."""
        keep = [*self.keep, "fold", "y"]
        if self.sparse:
            return sparse_vectors(self.df, self.enc.n_features, keep, self.maps[t].scale)
        # from the cached encoded rows: the files are not parsed again
        enc, matrix = self.enc, self.maps[t].matrix.T
        kinds = dict(self.rows.dtypes)

        def prepare(it):
            for rb in it:
                if rb.num_rows:
                    x = enc.batch(rb).times(matrix)
                    at = pa.array(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32))
                    yield pa.RecordBatch.from_arrays([*(rb.column(c) for c in keep), pa.ListArray.from_arrays(at, pa.array(x.ravel()))], [*keep, "x"])

        schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "x array<double>"])
        return map_arrow(self.rows, prepare, schema).select(*keep, array_to_vector("x").alias("features"))

    def trees(self, points: list[tuple[str, dict[str, Any], int]]) -> list:
        """Scorers of tree models given as (model, parameters, training subset)."""
        return fit_points(self.rows, self.enc, self.moments, points, self.task == CLS, self.n_classes, list(self.keep), groups=self.groups)

    def preparation(self, t: int):
        m = self.moments
        return learned_preparation(self.enc, m.train("sums", t).sum(axis=0), m.train("squares", t).sum(axis=0))

    def close(self) -> None:
        self.rows.unpersist()
        if self._blocks is not None:
            self._blocks.unpersist()
        if self._groups is not None:
            self._groups.unpersist()


def closed_scorer(table: TrainingTable, model: str, p: dict[str, Any], t: int, fourth) -> Any:
    m, maps = table.moments, table.maps
    if model == "Ridge":
        return closed.ridge(m, maps, t, p["alpha"])
    if model == "Lasso":
        return closed.elastic_net(m, maps, t, p["alpha"], 1.0)
    if model == "ElasticNet":
        return closed.elastic_net(m, maps, t, p["alpha"], p["l1_ratio"])
    if model == "RidgeClassifier":
        return closed.ridge_classifier(m, maps, t, p["alpha"])
    if model == "GaussianNB":
        return closed.gaussian_bayes(m, maps, t, p["var_smoothing"])
    if model == "MultinomialNB":
        return closed.multinomial_bayes(m, maps, t, p["alpha"], p.get("fit_prior", True))
    return closed.discriminant(m, maps, t, p["solver"], p.get("shrinkage"), None if fourth is None else fourth[t])


@dataclass
class NeighbourModel:
    """A lazy learner: the prepared training rows themselves."""

    train: DataFrame
    params: dict[str, Any]
    table: TrainingTable

    def predict_vectors(self, queries: DataFrame) -> DataFrame:
        """``queries``: __id, x. Gives __id, p."""
        found = neighbors.nearest(
            queries.withColumnRenamed("__id", "id"), self.train, self.params["n_neighbors"], label="y",
            metric=self.params["metric"],
        )
        rule = neighbors.classify if self.table.task == CLS else neighbors.regress
        return rule(found, self.params["n_neighbors"], self.params["weights"]).withColumnRenamed("qid", "__id")


def _neighbour_rows(table: TrainingTable, t: int, id_col: str) -> DataFrame:
    return table.vectors(t).select(
        F.col(id_col).cast("bigint").alias("id"), "fold", "y", vector_to_array("features").alias("x")
    )


def search_neighbours(table: TrainingTable, points: list[Point], id_col: str) -> None:
    rule = neighbors.classify if table.task == CLS else neighbors.regress
    most = max(p.params["n_neighbors"] for p in points)
    for metric in sorted({p.params["metric"] for p in points}):
        mine = [p for p in points if p.params["metric"] == metric]
        for f in range(table.k):
            rows = _neighbour_rows(table, f, id_col)
            held = rows.where(F.col("fold") == f)
            train = rows.where((F.col("fold") != f) & (F.col("fold") != TEST))
            found = neighbors.nearest(held, train, most, label="y", metric=metric).persist()
            truth = held.select(F.col("id").alias("qid"), "y")
            scored = []
            for i, p in enumerate(mine):
                pred = rule(found, p.params["n_neighbors"], p.params["weights"]).join(truth, "qid")
                gain = F.avg((F.col("p") == F.col("y")).cast("double")) if table.task == CLS else -F.avg(
                    (F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))
                )
                scored.append(pred.agg(F.lit(i).alias("i"), gain.alias("s")))
            union = scored[0]
            for s in scored[1:]:
                union = union.unionByName(s)
            for r in union.collect():
                mine[r["i"]].scores[f] = r["s"]
            found.unpersist()


_limit: ContextVar[Deadline | None] = ContextVar("limit", default=None)


def _attempt(points: list[Point], work) -> None:
    """Run ``work`` for a family; a failure marks its points instead of ending the search."""
    limit = _limit.get()
    try:
        try:
            if limit is not None:
                limit.check()
            work(points)
        except Exception:
            if limit is not None:
                limit.check()  # a job that was cancelled ended because of the budget
            raise
    except Exception as e:  # noqa: BLE001  any learner failure is a leaderboard row
        for p in points:
            p.error = p.error or f"{type(e).__name__}: {str(e).splitlines()[0][:300] if str(e) else ''}"
            p.scores = {}
        if not points:
            traceback.print_exc()


def by_passes(table: TrainingTable, model: str) -> bool:
    return model in ITERATIVE or (table.wide and model in (*QUADRATIC, "LDA"))


def fit_by_passes(table: TrainingTable, points: list[Point], subsets: list[int], max_passes: int, missed: set[tuple[int, int]]) -> dict[tuple[int, int], Any]:
    """{(point, subset): scorer}; discriminant analyses share their passes, all other models theirs."""
    made: dict[tuple[int, int], Any] = {}
    for fit, own in ((fit_discriminants, [i for i, p in enumerate(points) if p.model == "LDA"]),
                     (fit_linear, [i for i, p in enumerate(points) if p.model != "LDA"])):
        if own:
            lost: set[tuple[int, int]] = set()
            asked = [points[i].params if fit is fit_discriminants else (points[i].model, points[i].params) for i in own]
            more = {} if fit is fit_discriminants else {"blocks": table.blocks}
            found = fit(table.rows, table.enc, table.moments, table.maps, asked, subsets, max_passes, unconverged=lost, **more)
            made.update({(own[i], t): s for (i, t), s in found.items()})
            missed.update((own[i], t) for i, t in lost)
    return made


def _learn(table: TrainingTable, every: list[Point]):
    """The sums that the models need; what only 'auto' shrinkage needs can fail alone."""
    auto = [p for p in every if p.model == "LDA" and p.params.get("shrinkage") == "auto"]
    gram = any(p.model in CLOSED or p.model in ITERATIVE for p in every)
    if table.wide:
        auto = []  # by passes
    found = []

    def with_classes(points):
        table.learn(gram, True)
        found.append(fourth_moments(table.blocks, table.enc, table.moments, table.maps))

    if auto:
        _attempt(auto, with_classes)
    if not found:
        table.learn(gram, False)
    return found[0] if found else None


def search(table: TrainingTable, candidates: list[Candidate], max_points: int | None = None,
           id_col: str | None = None, max_passes: int = 1000, budget: float | None = None) -> list[ModelResult]:
    """Best point per candidate, refitted on all training rows, in roster order.

    ``max_points`` bounds the searched points per model (evenly spaced over the
    distinct points of its grid); None searches all of them. After ``budget``
    seconds running jobs are cancelled and models without scores are failed; those
    with scores are still refitted.
    """
    with Deadline(table.rows.sparkSession.sparkContext, budget) as limit:
        token = _limit.set(limit)
        try:
            plan, fourth = _scored(table, candidates, max_points, id_col, max_passes)
        finally:
            _limit.reset(token)
    return _refit(table, candidates, plan, fourth, id_col, max_passes)


def _scored(table: TrainingTable, candidates: list[Candidate], max_points: int | None, id_col: str | None, max_passes: int):
    """All points of all candidates with their scores or errors, and the sums that refits share."""
    plan: dict[str, list[Point]] = {}
    for c in candidates:
        pts = distinct_points(c)
        if max_points is not None and len(pts) > max_points:
            at = np.unique(np.linspace(0, len(pts) - 1, max_points).round().astype(int))
            pts = [pts[i] for i in at]
        plan[c.model] = [Point(c.model, p) for p in pts]
    every = [p for pts in plan.values() for p in pts]
    k = table.k
    fourth = None

    def learn(points):
        nonlocal fourth
        fourth = _learn(table, every)

    _attempt(every, learn)
    if table.moments is None:
        return plan, None

    scorers: dict[tuple[int, int], Any] = {}
    index = {id(p): i for i, p in enumerate(every)}
    for name in plan:
        if name in CLOSED and not by_passes(table, name):
            def closed_model(points):
                p = points[0]
                scorers.update({(index[id(p)], t): closed_scorer(table, p.model, p.params, t, fourth) for t in range(k)})
            for p in plan[name]:
                if p.error is None:
                    _attempt([p], closed_model)
    passes = [p for p in every if by_passes(table, p.model) and p.error is None]
    if passes:
        def linear_models(points):
            missed: set[tuple[int, int]] = set()
            made = fit_by_passes(table, points, list(range(k)), max_passes, missed)
            lost = {i for i, _ in missed}
            for i in lost:
                points[i].error = f"ConvergenceError: not at its tolerance after {max_passes} passes"
            scorers.update({(index[id(points[i])], t): s for (i, t), s in made.items() if i not in lost})
        _attempt(passes, linear_models)
        if all(p.error for p in passes) and len({p.model for p in passes}) > 1:
            # one model's points may have ended the shared passes: each model on its own
            for name in dict.fromkeys(p.model for p in passes):
                own = [p for p in passes if p.model == name and not p.error.startswith("ConvergenceError")]
                for p in own:
                    p.error = None
                _attempt(own, linear_models)
    grown = [p for p in every if p.model in TREES]
    if grown:
        def tree_models(points):
            asked = [(p, t) for p in points for t in range(k)]
            scorers.update({(index[id(p)], t): s for (p, t), s in zip(asked, table.trees([(p.model, p.params, t) for p, t in asked]))})
        _attempt(grown, tree_models)
        if all(p.error for p in grown):
            for name in dict.fromkeys(p.model for p in grown):
                own = [p for p in grown if p.model == name]
                for p in own:
                    p.error = None
                _attempt(own, tree_models)
    if scorers:
        def score(points):
            own = {key: s for key, s in scorers.items() if every[key[0]] in points}
            for (i, t), s in evaluate_scorers(table.judged, table.enc, own, table.task).items():
                every[i].scores[t] = s
        scored = [every[i] for i in sorted({i for i, _ in scorers})]
        _attempt(scored, score)
        if all(p.error for p in scored):
            for name in dict.fromkeys(p.model for p in scored):
                own = [p for p in scored if p.model == name]
                for p in own:
                    p.error = None
                _attempt(own, score)
    if "KNN" in plan:
        _attempt(plan["KNN"], lambda points: search_neighbours(table, points, id_col or list(table.keep)[0]))
    return plan, fourth


def _best_point(points: list[Point], k: int) -> Point | None:
    scored = [(p.mean(k), -i, p) for i, p in enumerate(points) if p.error is None]
    scored = [s for s in scored if not np.isnan(s[0])]
    return max(scored, key=lambda s: (s[0], s[1]))[2] if scored else None


def _refit(table, candidates, plan, fourth, id_col, max_passes) -> list[ModelResult]:
    k, out = table.k, []
    best = {c.model: _best_point(plan[c.model], k) for c in candidates}
    linear = [b for b in best.values() if b is not None and by_passes(table, b.model)]
    fitted: dict[str, Any] = {}

    def refit(points):
        made = fit_by_passes(table, points, [k], max_passes, set())
        fitted.update({points[i].model: s for (i, _), s in made.items()})

    if linear:
        _attempt(linear, refit)
    for order, c in enumerate(candidates):
        b = best[c.model]
        if b is None:
            errors = [p.error for p in plan[c.model] if p.error]
            out.append(ModelResult(c.model, order, {}, float("-inf"), None, errors[0] if errors else "no valid score"))
            continue
        result = ModelResult(c.model, order, b.params, b.mean(k), fitted.get(c.model))
        if by_passes(table, c.model):
            if result.fitted is None:
                result.error, result.cv_score = b.error or "ConvergenceError: the refit missed its tolerance", float("-inf")
            out.append(result)
            continue
        try:
            if c.model in CLOSED:
                result.fitted = closed_scorer(table, c.model, b.params, k, fourth)
            elif c.model in TREES:
                result.fitted = table.trees([(c.model, b.params, k)])[0]
            elif c.model == "KNN":
                rows = _neighbour_rows(table, k, id_col or list(table.keep)[0])
                result.fitted = NeighbourModel(rows.where(F.col("fold") != TEST), b.params, table)
        except Exception as e:  # noqa: BLE001
            result.error, result.cv_score = f"{type(e).__name__}: {e}", float("-inf")
        out.append(result)
    return out


def choose(results: list[ModelResult]) -> ModelResult:
    """Strictly best score; ties keep the earlier model, NaN never wins."""
    best = None
    for r in results:
        if r.ok and not np.isnan(r.cv_score) and (best is None or r.cv_score > best.cv_score):
            best = r
    if best is None:
        raise NoModelError("no model could be trained")
    return best


def predictions(table: TrainingTable, result: ModelResult, test_only: bool = True) -> DataFrame:
    """``keep, y, p`` on the hold-out rows."""
    k, keep = table.k, list(table.keep)
    rows = table.rows.where(F.col("fold") == TEST) if test_only else table.rows
    if isinstance(result.fitted, NeighbourModel):
        v = table.vectors(k)
        v = v.where(F.col("fold") == TEST) if test_only else v
        id_col = keep[0]
        q = v.select(F.col(id_col).cast("bigint").alias("__id"), vector_to_array("features").alias("x"))
        p = result.fitted.predict_vectors(q)
        return v.select(*keep, "y", F.col(id_col).cast("bigint").alias("__id")).join(p, "__id").select(*keep, "y", "p")
    return predict_rows(rows, table.enc, result.fitted, table.keep)

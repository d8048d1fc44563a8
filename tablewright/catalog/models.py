"""Neighbours and models. Scores are per held-out fold; folds come from the key hash."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tablewright.catalog.common import KEYS, LI, Registry, hash_sql, lineitem, table, with_gaps
from tablewright.catalog.profile import TERMS, term_rows
from tablewright.errors import ConvergenceError
from tablewright.functions.hashing import hash_order
from tablewright.functions.roles import Roles
from tablewright.operators import neighbors
from tablewright.operators.discriminant import fit_discriminants
from tablewright.operators.linear import fit_linear
from tablewright.operators.scoring import evaluate_scorers
from tablewright.plans.roster import SGD_CLASSIFIER, SGD_REGRESSOR, Candidate, distinct_points
from tablewright.plans.search import TrainingTable, closed_scorer
from tablewright.session import materialize, small_table

reg = Registry()
K = 3
CLS3_SQL = "case when l_quantity + 200 * l_discount < 25 then 0 when l_quantity + 200 * l_discount < 45 then 1 else 2 end"
CLS2_SQL = "case when l_quantity + 100 * l_discount > 30 then 1 else 0 end"
REG_SQL = "3 * l_quantity - 50 * l_discount + 0.001 * l_extendedprice"
ROLES = Roles(("l_quantity", "l_discount"))
WIDE = Roles(("l_quantity", "l_extendedprice", "x_discount", "l_tax"), ("x_status",))


def _rows(spark, sf, target: str) -> DataFrame:
    li = with_gaps(lineitem(spark, sf))  # the training table spreads the encoded rows
    return li.withColumn("fold", F.pmod(hash_order(KEYS), F.lit(K)).cast("int")).withColumn("y", F.expr(target).cast("double"))


def _dense(spark, sf, target: str, task: str, n_classes: int = 0, roles: Roles = ROLES) -> TrainingTable:
    df = _rows(spark, sf, target).select("fold", "y", *roles.numerical, *roles.categorical)
    return TrainingTable(df, task, n_classes, K, roles)


def _terms(spark, sf) -> TrainingTable:
    """Documents that have a language; the classes are the table's languages."""
    found = sorted(r["lang"] for r in table(spark, sf, "documents").where(F.col("lang").isNotNull()).select("lang").distinct().collect())
    langs = F.array(*[F.lit(v) for v in found])
    df = term_rows(spark, sf).where(F.col("lang").isNotNull()).select(
        F.pmod(hash_order(["doc_id"]), F.lit(K)).cast("int").alias("fold"),
        (F.array_position(langs, F.col("lang")) - 1).cast("double").alias("y"),
        "indices",
        "values",
    )
    return TrainingTable(df, "classification", max(2, len(found)), K, None, 26, dealt=True)


def _scores(spark, points: list[dict], scores: dict, params: list[str], digits: int = 6) -> DataFrame:
    """One row per (point, fold)."""
    cols = {p: [float(points[i][p]) if not isinstance(points[i][p], str) else points[i][p] for i, _ in scores] for p in params}
    types = {p: pa.string() if cols[p] and isinstance(cols[p][0], str) else pa.float64() for p in params}
    out = small_table(
        spark,
        {**cols, "fold": [f for _, f in scores], "score": list(scores.values())},
        {**types, "fold": pa.int64(), "score": pa.float64()},
    )
    return out.withColumn("score", F.round("score", digits))


def _closed(spark, t: TrainingTable, model: str, points: list[dict], params: list[str], digits: int = 6) -> DataFrame:
    t.learn(True, any(p.get("shrinkage") == "auto" for p in points))
    fourth = None
    if t.moments.class_gram is not None:
        from tablewright.operators.moments import fourth_moments

        fourth = fourth_moments(t.blocks, t.enc, t.moments, t.maps)
    scorers = {(i, f): closed_scorer(t, model, p, f, fourth) for i, p in enumerate(points) for f in range(K)}
    got = evaluate_scorers(t.judged, t.enc, scorers, t.task)
    t.close()
    shown = [{k: "none" if v is None else v for k, v in p.items()} for p in points]
    shown = [{k: str(v) if k in ("shrinkage", "solver", "fit_prior") else v for k, v in p.items()} for p in shown]
    return _scores(spark, shown, got, params, digits)


def _iterative(spark, t: TrainingTable, points: list[tuple[str, dict]], params: list[str]) -> DataFrame:
    t.learn(True, False)
    made = fit_linear(t.rows, t.enc, t.moments, t.maps, points, list(range(K)), blocks=t.blocks)
    got = evaluate_scorers(t.judged, t.enc, made, t.task)
    t.close()
    return _scores(spark, [p for _, p in points], got, params, 4)


# --- neighbours -----------------------------------------------------------------------------------

def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"), F.col("label").cast("double").alias("label")
    )


def _neighbours(spark, sf, k, metric="euclidean"):
    v = _vectors(spark, sf)
    return neighbors.nearest(v, v, k, label="label", group="id", metric=metric)


def _nn_sql(k: int, metric: str = "euclidean") -> str:
    dist = (
        "list_distance(a.embedding::double[], b.embedding::double[])"
        if metric == "euclidean"
        else "list_sum(list_transform(list_zip(a.embedding::double[], b.embedding::double[]), lambda z: abs(z[1] - z[2])))"
    )
    return f"""nn as (
  select a.vec_id as qid, b.vec_id as id, b.label::double as label, {dist} as dist,
    row_number() over (partition by a.vec_id order by {dist}, b.vec_id) as rn
  from embeddings a, embeddings b where a.vec_id <> b.vec_id qualify rn <= {k})"""


@reg("c03_nearest_neighbours", f"with {_nn_sql(5)} select qid, rn, id, round(dist, 6) as dist from nn")
def nearest(spark, sf):
    return neighbors.ranked_neighbours(_neighbours(spark, sf, 5)).select(
        "qid", F.col("rn").cast("bigint").alias("rn"), "id", F.round("dist", 6).alias("dist")
    )


@reg("c03_nearest_neighbours_manhattan", f"with {_nn_sql(3, 'manhattan')} select qid, rn, id, round(dist, 6) as dist from nn")
def nearest_manhattan(spark, sf):
    return neighbors.ranked_neighbours(_neighbours(spark, sf, 3, "manhattan")).select(
        "qid", F.col("rn").cast("bigint").alias("rn"), "id", F.round("dist", 6).alias("dist")
    )


@reg("g12_neighbour_classes", f"""with {_nn_sql(9)},
v as (select qid, 'uniform' as weights, label, count(*)::double as w from nn where rn <= 9 group by 1, 3
  union all select qid, 'distance', label, sum(1 / dist) from nn where rn <= 5 group by 1, 3)
select weights, qid, arg_min(label, (-round(w, 9), label)) as p from v group by 1, 2""")
def neighbour_classes(spark, sf):
    found = materialize(_neighbours(spark, sf, 9), "neighbours")  # both rules read it
    a = neighbors.classify(found, 9, "uniform").select(F.lit("uniform").alias("weights"), "qid", "p")
    b = neighbors.classify(found, 5, "distance").select(F.lit("distance").alias("weights"), "qid", "p")
    return a.unionByName(b)


@reg("g22_neighbour_values", f"""with {_nn_sql(11)}
select 'uniform' as weights, qid, round(avg(label), 6) as p from nn where rn <= 11 group by 2
union all select 'distance', qid, round(sum(label / dist) / sum(1 / dist), 6) from nn where rn <= 3 group by 2""")
def neighbour_values(spark, sf):
    found = materialize(_neighbours(spark, sf, 11), "neighbours")
    a = neighbors.regress(found, 11, "uniform").select(F.lit("uniform").alias("weights"), "qid", F.round("p", 6).alias("p"))
    b = neighbors.regress(found, 3, "distance").select(F.lit("distance").alias("weights"), "qid", F.round("p", 6).alias("p"))
    return a.unionByName(b)


# --- closed-form models, with the same algebra written in SQL for two features --------------------

TRAIN = f"""{LI},
d as (select h % 3 as fold, l_quantity as x1, l_discount as x2, {REG_SQL} as y, ({CLS2_SQL})::double as c2, {CLS3_SQL} as c3 from li),
t as (select * from (values (0), (1), (2)) v(t)),
s as (select t, count(*)::double as n, avg(x1) m1, stddev_pop(x1) s1, avg(x2) m2, stddev_pop(x2) s2, avg(y) my, avg(2 * c2 - 1) mc,
  covar_pop(x1, x2) c12, covar_pop(x1, y) c1y, covar_pop(x2, y) c2y, covar_pop(x1, 2 * c2 - 1) c1c, covar_pop(x2, 2 * c2 - 1) c2c
  from d join t on d.fold <> t.t group by t)"""


def _ridge_sql(alphas, cy, my, outcome: str) -> str:
    values = ", ".join(f"({float(a)}::double)" for a in alphas)
    return f"""with {TRAIN},
g as (select s.*, alpha, n + alpha as a, n * c12 / (s1 * s2) as b, n * c1{cy} / s1 as r1, n * c2{cy} / s2 as r2
  from s, (values {values}) v(alpha)),
w as (select t, alpha, m1, s1, m2, s2, {my} as my, (a * r1 - b * r2) / (a * a - b * b) as w1, (a * r2 - b * r1) / (a * a - b * b) as w2 from g),
p as (select alpha, fold, y, c2, my + w1 * (x1 - m1) / s1 + w2 * (x2 - m2) / s2 as p from d join w on d.fold = w.t)
select alpha, fold, round({outcome}, 6)::double as score from p group by 1, 2"""


RIDGE_ALPHAS, CLASS_ALPHAS = [0.1, 1, 10, 100, 1000], [0.1, 1, 10, 100]


@reg("g13_ridge", _ridge_sql(RIDGE_ALPHAS, "y", "my", "-avg((y - p) * (y - p))"))
def ridge(spark, sf):
    t = _dense(spark, sf, REG_SQL, "regression")
    return _closed(spark, t, "Ridge", [{"alpha": a} for a in RIDGE_ALPHAS], ["alpha"])


@reg("g02_ridge_classifier", _ridge_sql(CLASS_ALPHAS, "c", "mc", "avg(((p > 0)::int = c2)::int)"))
def ridge_classifier(spark, sf):
    t = _dense(spark, sf, CLS2_SQL, "classification", 2)
    return _closed(spark, t, "RidgeClassifier", [{"alpha": a} for a in CLASS_ALPHAS], ["alpha"])


def _net_sql(points, with_ratio: bool) -> str:
    values = ", ".join(f"({float(a)}::double, {float(r)}::double)" for a, r in points)
    ratio = "l1_ratio, " if with_ratio else ""
    groups = "1, 2, 3" if with_ratio else "1, 2"
    return f"""with {TRAIN},
w as (select t, alpha, l1_ratio, m1, s1, my,
  sign(c1y / s1) * greatest(abs(c1y / s1) - alpha * l1_ratio, 0) / (1 + alpha * (1 - l1_ratio)) as w1 from s, (values {values}) v(alpha, l1_ratio)),
p as (select alpha, l1_ratio, fold, y, my + w1 * (x1 - m1) / s1 as p from d join w on d.fold = w.t)
select alpha, {ratio}fold, round(-avg((y - p) * (y - p)), 5)::double as score from p group by {groups}"""


LASSO_ALPHAS = [0.001, 0.01, 0.1, 1, 10]
NET_POINTS = [(a, r) for a in (0.01, 0.1, 1) for r in (0.1, 0.5, 0.9)]
ONE = Roles(("l_quantity",))


@reg("g16_lasso", _net_sql([(a, 1.0) for a in LASSO_ALPHAS], False))
def lasso(spark, sf):
    t = _dense(spark, sf, REG_SQL, "regression", roles=ONE)
    return _closed(spark, t, "Lasso", [{"alpha": a} for a in LASSO_ALPHAS], ["alpha"], 5)


@reg("g17_elastic_net", _net_sql(NET_POINTS, True))
def net(spark, sf):
    t = _dense(spark, sf, REG_SQL, "regression", roles=ONE)
    return _closed(spark, t, "ElasticNet", [{"alpha": a, "l1_ratio": r} for a, r in NET_POINTS], ["alpha", "l1_ratio"], 5)


@reg("g17_elastic_net_all_features")
def net_wide(spark, sf):
    t = _dense(spark, sf, REG_SQL, "regression", roles=WIDE)
    return _closed(spark, t, "ElasticNet", [{"alpha": a, "l1_ratio": r} for a, r in NET_POINTS], ["alpha", "l1_ratio"], 4)


@reg("g05_discriminant", f"""with {TRAIN},
k as (select t, c2, count(*)::double nk, avg(x1) k1, avg(x2) k2, var_pop(x1) * count(*) v1, var_pop(x2) * count(*) v2,
  covar_pop(x1, x2) * count(*) v12 from d join t on d.fold <> t.t group by 1, 2),
c as (select t, sum(nk) n, sum(v1) v1, sum(v2) v2, sum(v12) v12, sum(k1) filter (c2 = 1) a1, sum(k2) filter (c2 = 1) a2,
  sum(k1) filter (c2 = 0) b1, sum(k2) filter (c2 = 0) b2, ln(sum(nk) filter (c2 = 1) / sum(nk) filter (c2 = 0)) lp from k group by t),
z as (select t, solver, a1, a2, b1, b2, lp, v1 / f v1, v2 / f v2, v12 / f v12
  from (select c.*, solver, case solver when 'svd' then n - 2 else n end f from c, (values ('lsqr'), ('svd')) u(solver))),
w as (select *, ((a1 - b1) * v2 - (a2 - b2) * v12) / (v1 * v2 - v12 * v12) w1, ((a2 - b2) * v1 - (a1 - b1) * v12) / (v1 * v2 - v12 * v12) w2 from z)
select solver, fold, round(avg(((w1 * (x1 - (a1 + b1) / 2) + w2 * (x2 - (a2 + b2) / 2) + lp > 0)::int = c2)::int), 6)::double as score
from d join w on d.fold = w.t group by 1, 2""")
def discriminant(spark, sf):
    t = _dense(spark, sf, CLS2_SQL, "classification", 2)
    points = [{"solver": s, "shrinkage": None} for s in ("svd", "lsqr")]
    return _closed(spark, t, "LDA", points, ["solver"])


@reg("g05_discriminant_shrinkage")
def discriminant_shrunk(spark, sf):
    t = _dense(spark, sf, CLS3_SQL, "classification", 3, WIDE)
    points = [{"solver": "lsqr", "shrinkage": s} for s in (None, "auto", 0.5, 0.9)]
    return _closed(spark, t, "LDA", points, ["shrinkage"])


@reg("g05_discriminant_by_passes", f"""with {TRAIN},
k as (select t.t, c2, count(*)::double nk, avg((x1 - m1) / s1) k1, avg((x2 - m2) / s2) k2, var_pop((x1 - m1) / s1) * count(*) v1,
  var_pop((x2 - m2) / s2) * count(*) v2, covar_pop((x1 - m1) / s1, (x2 - m2) / s2) * count(*) v12
  from d join t on d.fold <> t.t join s on s.t = t.t group by 1, 2),
c as (select t, sum(nk) n, sum(v1) v1, sum(v2) v2, sum(v12) v12, sum(k1) filter (c2 = 1) a1, sum(k2) filter (c2 = 1) a2,
  sum(k1) filter (c2 = 0) b1, sum(k2) filter (c2 = 0) b2, ln(sum(nk) filter (c2 = 1) / sum(nk) filter (c2 = 0)) lp from k group by t),
z as (select t, solver, shrinkage, a1, a2, b1, b2, lp, (1 - r) * v1 / f + r * (v1 + v2) / (2 * n) v1, (1 - r) * v2 / f + r * (v1 + v2) / (2 * n) v2,
  (1 - r) * v12 / f v12
  from (select c.*, solver, shrinkage, r, case solver when 'svd' then n - 2 else n end f
    from c, (values ('svd', 'none', 0.0::double), ('lsqr', 'none', 0.0), ('lsqr', '0.5', 0.5), ('lsqr', '0.9', 0.9)) u(solver, shrinkage, r))),
w as (select *, ((a1 - b1) * v2 - (a2 - b2) * v12) / (v1 * v2 - v12 * v12) w1, ((a2 - b2) * v1 - (a1 - b1) * v12) / (v1 * v2 - v12 * v12) w2 from z)
select solver, shrinkage, fold, round(avg(((w1 * ((x1 - m1) / s1 - (a1 + b1) / 2) + w2 * ((x2 - m2) / s2 - (a2 + b2) / 2) + lp > 0)::int = c2)::int), 6)::double as score
from d join w on d.fold = w.t join s on s.t = w.t group by 1, 2, 3""")
def discriminant_by_passes(spark, sf):
    """The form for wide tables, which only multiplies the scatter."""
    t = _dense(spark, sf, CLS2_SQL, "classification", 2)
    points = [{"solver": s, "shrinkage": r} for s, r in (("svd", None), ("lsqr", None), ("lsqr", 0.5), ("lsqr", 0.9))]
    t.learn(False, False)
    missed: set[tuple[int, int]] = set()
    made = fit_discriminants(t.rows, t.enc, t.moments, t.maps, points, list(range(K)), unconverged=missed)
    if missed:
        raise ConvergenceError(f"{len(missed)} discriminant analyses missed their tolerance")
    got = evaluate_scorers(t.rows, t.enc, made, t.task)
    t.close()
    return _scores(spark, [{"solver": p["solver"], "shrinkage": str(p["shrinkage"] or "none")} for p in points], got, ["solver", "shrinkage"])


SMOOTHINGS = [1e-9, 1e-8, 1e-7, 1e-6]


@reg("g07_gaussian_bayes", f"""with {TRAIN},
k as (select t.t, c3, count(*)::double / max(s.n) as prior, avg((x1 - m1) / s1) k1, var_pop((x1 - m1) / s1) v1, avg((x2 - m2) / s2) k2,
  var_pop((x2 - m2) / s2) v2 from d join t on d.fold <> t.t join s on s.t = t.t group by 1, 2),
e as (select k.*, sm as var_smoothing, v1 + sm as e1, v2 + sm as e2 from k, (values {", ".join(f"({v}::double)" for v in SMOOTHINGS)}) u(sm)),
l as (select var_smoothing, fold, d.c3 as truth, e.c3 as cls, d.x1, d.x2, d.y, ln(prior) - 0.5 * (ln(2 * pi() * e1) + ln(2 * pi() * e2)
  + ((x1 - m1) / s1 - k1) ** 2 / e1 + ((x2 - m2) / s2 - k2) ** 2 / e2) as ll, rid
  from (select *, row_number() over () rid from d) d join s on d.fold = s.t join e on e.t = s.t),
p as (select var_smoothing, fold, rid, any_value(truth) truth, arg_max(cls, ll) as p from l group by 1, 2, 3)
select var_smoothing, fold, round(avg((truth = p)::int), 6)::double as score from p group by 1, 2""")
def gaussian(spark, sf):
    t = _dense(spark, sf, CLS3_SQL, "classification", 3)
    return _closed(spark, t, "GaussianNB", [{"var_smoothing": v} for v in SMOOTHINGS], ["var_smoothing"])


NB_POINTS = [(a, p) for a in (0.1, 0.5, 1.0, 2.0) for p in (True, False)]


@reg("g06_multinomial_bayes", f"""with {TERMS},
docs as (select doc_id, lang, {hash_sql("doc_id")} % 3 as fold from documents), tt as (select * from (values (0), (1), (2)) v(t)),
tops as (select t, idx, max(val) as top from cells join docs using (doc_id) join tt on fold <> t group by 1, 2),
scaled as (select t, doc_id, docs.lang, fold, cells.idx, val / coalesce(top, 1) as val from cells join docs using (doc_id) cross join tt
  left join tops using (t, idx)),
cnt as (select t, lang, idx, sum(val) filter (fold <> t) as c from scaled group by 1, 2, 3),
grid as (select t, lang, idx, coalesce(c, 0) as c from tt cross join (select distinct lang from docs) cross join (select unnest(range(26)) as idx) left join cnt using (t, lang, idx)),
prior as (select t, lang, ln(count(*)::double / sum(count(*)) over (partition by t)) as pr, count(*) over (partition by t) as k from docs join tt on fold <> t group by 1, 2),
lp as (select t, lang, idx, alpha, ln((c + alpha) / sum(c + alpha) over (partition by t, lang, alpha)) as lp
  from grid, (values (0.1::double), (0.5::double), (1.0::double), (2.0::double)) a(alpha)),
sc as (select alpha, s.fold, s.doc_id, s.lang as truth, lp.lang, sum(val * lp) as ll from scaled s join lp on lp.t = s.t and lp.idx = s.idx where s.fold = s.t group by all),
zero as (select a.alpha, d.fold, d.doc_id, d.lang as truth, p.lang, 0.0 as ll from docs d join prior p on p.t = d.fold, (select distinct alpha from lp) a
  where d.doc_id not in (select doc_id from cells)),
every as (select * from sc union all select * from zero),
o as (select alpha, fit_prior, fold, doc_id, truth, every.lang, ll + case fit_prior when 'True' then pr else -ln(k) end as ll
  from every join prior on prior.t = every.fold and prior.lang = every.lang, (values ('True'), ('False')) f(fit_prior)),
p as (select alpha, fit_prior, fold, doc_id, any_value(truth) truth, arg_min(lang, (-ll, lang)) as p from o group by 1, 2, 3, 4)
select alpha, fit_prior, fold, round(avg((truth = p)::int), 6)::double as score from p group by 1, 2, 3""")
def multinomial(spark, sf):
    points = [{"alpha": a, "fit_prior": p} for a, p in NB_POINTS]
    return _closed(spark, _terms(spark, sf), "MultinomialNB", points, ["alpha", "fit_prior"])


# --- iterative models ------------------------------------------------------------------------------

@reg("g01_linear_svc")
def linear_svc(spark, sf):
    points = [("LinearSVC", {"C": c}) for c in (0.1, 1, 10)]
    return _iterative(spark, _dense(spark, sf, CLS3_SQL, "classification", 3, WIDE), points, ["C"])


@reg("g01_linear_svc_sparse")
def linear_svc_sparse(spark, sf):
    points = [("LinearSVC", {"C": c}) for c in (0.1, 1, 10)]
    return _iterative(spark, _terms(spark, sf), points, ["C"])


@reg("g03_sgd_classifier")
def sgd_classifier(spark, sf):
    points = [("SGDClassifier", p) for p in distinct_points(Candidate("SGDClassifier", SGD_CLASSIFIER))]
    return _iterative(spark, _dense(spark, sf, CLS2_SQL, "classification", 2, WIDE), points, ["loss", "alpha", "l1_ratio"])


@reg("g04_logistic_regression")
def logistic(spark, sf):
    points = [("LogisticRegression", {"C": c, "l1_ratio": r, "solver": "saga"}) for c in (0.1, 1, 10) for r in (0, 0.5)]
    return _iterative(spark, _dense(spark, sf, CLS3_SQL, "classification", 3, WIDE), points, ["C", "l1_ratio"])


@reg("g04_logistic_regression_liblinear")
def logistic_liblinear(spark, sf):
    points = [("LogisticRegression", {"C": c, "solver": "liblinear"}) for c in (0.1, 1, 10)]
    return _iterative(spark, _dense(spark, sf, CLS2_SQL, "classification", 2, WIDE), points, ["C"])


@reg("g14_linear_svr")
def linear_svr(spark, sf):
    points = [("LinearSVR", {"C": c, "epsilon": e, "loss": l}) for c in (0.1, 1, 10) for e in (0.1, 0.2, 0.5)
              for l in ("epsilon_insensitive", "squared_epsilon_insensitive")]
    return _iterative(spark, _dense(spark, sf, REG_SQL, "regression", roles=WIDE), points, ["C", "epsilon", "loss"])


@reg("g15_sgd_regressor")
def sgd_regressor(spark, sf):
    points = [("SGDRegressor", p) for p in distinct_points(Candidate("SGDRegressor", SGD_REGRESSOR))]
    return _iterative(spark, _dense(spark, sf, REG_SQL, "regression", roles=WIDE), points, ["loss", "alpha", "l1_ratio"])


# --- trees: a grid shares its trees and its passes; trained on two folds, measured on the third, for every fold -----

def _grid(model: str, **grid) -> list[tuple[str, dict]]:
    return [(model, p) for p in distinct_points(Candidate(model, grid))]


def _trees(spark, sf, points: list[tuple[str, dict]], target: str, task: str, n_classes: int = 0, roles: Roles = WIDE) -> DataFrame:
    """One row per (point, fold)."""
    df = _rows(spark, sf, target).withColumn("rid", F.xxhash64(*KEYS)).select("rid", "fold", "y", *roles.numerical, *roles.categorical)
    t = TrainingTable(df, task, n_classes, K, roles, None, {"rid": "bigint"})
    t.learn(False, False)
    asked = [(i, f) for i in range(len(points)) for f in range(K)]
    made = t.trees([(*points[i], f) for i, f in asked])
    got = evaluate_scorers(t.judged, t.enc, dict(zip(asked, made)), t.task)
    t.close()
    shown = [{k: str(v).lower() if v is None or k == "max_depth" else v for k, v in p.items()} for _, p in points]
    return _scores(spark, shown, got, sorted(shown[0]))


C, R = "classification", "regression"
TREE_CLASSES = _grid("DecisionTree", max_depth=[3, 5, 10, 15, None], min_samples_split=[2, 5, 10, 20], min_samples_leaf=[1, 2, 5, 10], criterion=["gini", "entropy"])
TREE_VALUES = _grid("DecisionTree", max_depth=[3, 5, 10, 15, 20, None], min_samples_split=[2, 5, 10, 20], min_samples_leaf=[1, 2, 5, 10], criterion=["squared_error"])
FOREST = dict(n_estimators=[25, 50], max_depth=[3, 5], min_samples_split=[2, 5, 10])
BOOST = dict(n_estimators=[25, 50], learning_rate=[0.1], max_depth=[3], subsample=[0.8, 1.0])
for _name, _args in {
    "g08_tree_classes": (TREE_CLASSES, CLS3_SQL, C, 3),
    "g09_forest_classes": (_grid("RandomForest", max_features=["sqrt"], **FOREST), CLS3_SQL, C, 3),
    "g10_extra_trees_classes": (_grid("ExtraTrees", **FOREST), CLS3_SQL, C, 3),
    "g11_boosted_classes": (_grid("GradientBoosting", **BOOST), CLS3_SQL, C, 3),
    "g18_forest_values": (_grid("RandomForest", max_features=[None], **FOREST), REG_SQL, R),
    "g19_tree_values": (TREE_VALUES, REG_SQL, R),
    "g20_extra_trees_values": (_grid("ExtraTrees", **FOREST), REG_SQL, R),
    "g21_boosted_values": (_grid("GradientBoosting", **BOOST), REG_SQL, R),
}.items():
    reg(_name)(lambda spark, sf, args=_args: _trees(spark, sf, *args))

#: All cuts of two features, with rows (and classes) on either side; the first feature, then the lowest cut, wins ties.
CUTS_SQL = """v as (select t, 0 as f, x1 as x, c3, y from d join t on d.fold <> t.t union all select t, 1, x2, c3, y from d join t on d.fold <> t.t),
u as (select f, x, lead(x) over (partition by f order by x) as above from (select distinct f, x from v)),
cut as (select f, (x + above) / 2 as cut from u where above is not null)"""

STUMP_SQL = f"""with {TRAIN},
{CUTS_SQL},
n as (select t, f, cut, c3, v.x <= cut as below, count(*)::double as n from v join cut using (f) group by all),
sides as (select t, f, cut, below, sum(n) as n, sum(n * n) / sum(n) as gini, sum(n * ln(n)) - sum(n) * ln(sum(n)) as entropy, arg_max(c3, (n, -c3)) as p from n group by all),
g as (select t, f, cut, criterion, sum(case criterion when 'gini' then gini else entropy end) as gain, max(p) filter (below) as p1, max(p) filter (not below) as p2
  from sides, (values ('gini'), ('entropy')) k(criterion) group by all having count(*) = 2),
best as (select *, row_number() over (partition by t, criterion order by round(gain, 4) desc, f, cut) as rn from g)
select criterion, '1' as max_depth, fold, round(avg((case when case f when 0 then x1 else x2 end <= cut then p1 else p2 end = d.c3)::int), 6)::double as score
from d join best on d.fold = best.t where rn = 1 group by 1, 3"""


@reg("g08_tree_stump", STUMP_SQL)
def tree_stump(spark, sf):
    return _trees(spark, sf, _grid("DecisionTree", max_depth=[1], criterion=["gini", "entropy"]), CLS3_SQL, C, 3, ROLES)


VALUE_SQL = f"""with {TRAIN},
{CUTS_SQL},
sides as (select t, f, cut, v.x <= cut as below, count(*)::double as n, sum(y) as s, avg(y) as p from v join cut using (f) group by all),
g as (select t, f, cut, sum(s * s / n) as gain, max(p) filter (below) as p1, max(p) filter (not below) as p2 from sides group by all having count(*) = 2 and min(n) >= 5),
best as (select *, row_number() over (partition by t order by gain desc) as rn from g)
select 'squared_error' as criterion, '1' as max_depth, 5.0::double as min_samples_leaf, fold,
  round(-avg((y - case when case f when 0 then x1 else x2 end <= cut then p1 else p2 end) ** 2), 6)::double as score
from d join best on d.fold = best.t where rn = 1 group by fold"""


@reg("g19_tree_stump", VALUE_SQL)
def value_stump(spark, sf):
    return _trees(spark, sf, _grid("DecisionTree", max_depth=[1], min_samples_leaf=[5], criterion=["squared_error"]), REG_SQL, R, 0, ROLES)


#: A target of few values: their counts give every median exactly.
STEPS_SQL = "floor(l_quantity / 7) * 3 + floor(200 * l_discount / 5)"
ABSOLUTE_SQL = f"""with {TRAIN.replace(REG_SQL, STEPS_SQL)},
{CUTS_SQL},
m as (select t, f, cut, v.x <= cut as below, median(y) as p, count(*) as n from v join cut using (f) group by all),
e as (select t, f, cut, below, any_value(m.p) as p, sum(abs(y - m.p)) as e from m join v using (t, f) where (v.x <= cut) = below group by all),
g as (select t, f, cut, sum(e) as e, max(p) filter (below) as p1, max(p) filter (not below) as p2 from e group by all having count(*) = 2),
best as (select *, row_number() over (partition by t order by e, f, cut) as rn from g)
select 'absolute_error' as criterion, '1' as max_depth, fold, round(-avg((y - case when case f when 0 then x1 else x2 end <= cut then p1 else p2 end) ** 2), 6)::double as score
from d join best on d.fold = best.t where rn = 1 group by fold"""


@reg("g19_tree_absolute_stump", ABSOLUTE_SQL)
def absolute_stump(spark, sf):
    return _trees(spark, sf, _grid("DecisionTree", max_depth=[1], criterion=["absolute_error"]), STEPS_SQL, R, 0, ROLES)


@reg("g19_tree_absolute")
def tree_absolute(spark, sf):
    return _trees(spark, sf, _grid("DecisionTree", max_depth=[2, 4], min_samples_split=[2, 20], min_samples_leaf=[5], criterion=["absolute_error"]), REG_SQL, R)


QUERIES, SQL = reg.queries, reg.sql

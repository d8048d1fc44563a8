"""Fold moments, closed-form and iterative models against plain numpy on the same rows."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tablewright.functions.roles import Roles
from tablewright.operators import closed, linear
from tablewright.operators.design import dense_encoding, dense_rows, sparse_rows, SparseEncoding
from tablewright.operators.linear import Objective, fit_linear, objective, slopes
from tablewright.operators.moments import feature_maps, fold_moments, fourth_moments
from tablewright.operators.scoring import evaluate_scorers, predict_rows

K = 3


def raw_frame(n=400, seed=3):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame(
        {
            "id": np.arange(n),
            "a": rng.normal(5, 2, n),
            "b": rng.normal(-100, 30, n),
            "c": rng.choice(["x", "y", "z"], n, p=[0.6, 0.3, 0.1]),
            "const": 4.0,
            "fold": np.arange(n) % 4 - 1,
        }
    )
    pdf.loc[pdf.id % 7 == 0, "a"] = np.nan
    pdf.loc[pdf.id % 11 == 0, "c"] = None
    base = pdf.a.fillna(5) - 0.05 * pdf.b + (pdf.c == "y") * 2 + rng.normal(0, 1, n)
    pdf["y"] = base
    pdf["cls3"] = np.digitize(base, np.quantile(base, [0.4, 0.75])).astype(float)
    pdf["cls2"] = (base > base.median()).astype(float)
    return pdf


def prepare(train, other):
    """Impute, scale and one-hot learned on ``train``, applied to both."""
    out = []
    mode = train.c.value_counts()
    mode = sorted(mode[mode == mode.max()].index)[0]
    cats = sorted(train.c.dropna().unique())
    stats = {}
    for col in ("a", "b", "const"):
        filled = train[col].fillna(train[col].mean())
        stats[col] = (train[col].mean(), filled.mean(), filled.std(ddof=0) or 1.0)
    for part in (train, other):
        cols = [(part[c].fillna(s[0]) - s[1]) / s[2] for c, s in stats.items()]
        cols += [(part.c.fillna(mode) == v).astype(float) for v in cats]
        out.append(np.column_stack(cols))
    return out


@pytest.fixture(scope="module")
def setup(spark):
    pdf = raw_frame()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, a double, b double, c string, const double, fold int, y double, cls3 double, cls2 double")
    enc = dense_encoding(df, Roles(("a", "b", "const"), ("c",)))
    made = {}
    for target, k in (("y", 1), ("cls3", 3), ("cls2", 2)):
        rows = dense_rows(df, enc, target, "fold", ["id"]).repartition(5).persist()
        m = fold_moments(rows, enc, K, k, class_gram=k > 1)
        made[target] = (rows, m, feature_maps(enc, m))
    return pdf, enc, made


def subset(pdf, t):
    return pdf[(pdf.fold >= 0) & (pdf.fold != t)]


def predictions(rows, enc, scorer):
    return predict_rows(rows, enc, scorer, {"id": "long"}).toPandas().sort_values("id").p.to_numpy()


@pytest.mark.parametrize("t", [0, 2, 3])
def test_prepared_features_match_a_plain_fit(setup, t):
    pdf, enc, made = setup
    rows, m, maps = made["y"]
    x, _ = prepare(subset(pdf, t), pdf)
    g = closed.prepared_gram(maps[t], m.train("gram", t))
    assert np.allclose(g[1:, 1:], x.T @ x, atol=1e-7)
    assert np.allclose(g[0, 1:], x.sum(axis=0), atol=1e-8)


@pytest.mark.parametrize("t,alpha", [(0, 1.0), (3, 10.0)])
def test_ridge(setup, t, alpha):
    pdf, enc, made = setup
    rows, m, maps = made["y"]
    tr = subset(pdf, t)
    x, every = prepare(tr, pdf)
    y = tr.y.to_numpy()
    xc = x - x.mean(0)
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ (y - y.mean()))
    want = (every - x.mean(0)) @ w + y.mean()
    assert np.allclose(predictions(rows, enc, closed.ridge(m, maps, t, alpha)), want, atol=1e-7)


@pytest.mark.parametrize("l1_ratio", [1.0, 0.5])
def test_elastic_net(setup, l1_ratio):
    pdf, enc, made = setup
    rows, m, maps = made["y"]
    tr = subset(pdf, 3)
    x, every = prepare(tr, pdf)
    y = tr.y.to_numpy()
    alpha, n = 0.1, len(y)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.zeros(x.shape[1])
    for _ in range(4000):  # plain proximal gradient
        lip = np.linalg.eigvalsh(xc.T @ xc / n).max() + alpha
        z = w - (xc.T @ (xc @ w - yc) / n + alpha * (1 - l1_ratio) * w) / lip
        w = np.sign(z) * np.maximum(np.abs(z) - alpha * l1_ratio / lip, 0)
    want = (every - x.mean(0)) @ w + y.mean()
    got = predictions(rows, enc, closed.elastic_net(m, maps, 3, alpha, l1_ratio))
    assert np.allclose(got, want, atol=1e-5)


@pytest.mark.parametrize("target", ["cls3", "cls2"])
def test_ridge_classifier(setup, target):
    pdf, enc, made = setup
    rows, m, maps = made[target]
    tr = subset(pdf, 1)
    x, every = prepare(tr, pdf)
    xc = x - x.mean(0)
    scores = []
    for c in range(m.n_classes):
        y = np.where(tr[target] == c, 1.0, -1.0)
        w = np.linalg.solve(xc.T @ xc + np.eye(x.shape[1]), xc.T @ (y - y.mean()))
        scores.append((every - x.mean(0)) @ w + y.mean())
    want = np.argmax(scores, axis=0)
    assert (predictions(rows, enc, closed.ridge_classifier(m, maps, 1, 1.0)) == want).all()


@pytest.mark.parametrize("target", ["cls3", "cls2"])
def test_gaussian_bayes(setup, target):
    pdf, enc, made = setup
    rows, m, maps = made[target]
    tr = subset(pdf, 2)
    x, every = prepare(tr, pdf)
    eps = 1e-3 * x.var(0).max()
    score = []
    for c in range(m.n_classes):
        own = x[tr[target] == c]
        mu, var = own.mean(0), own.var(0) + eps
        score.append(np.log(len(own) / len(x)) - 0.5 * (np.log(2 * np.pi * var) + (every - mu) ** 2 / var).sum(1))
    want = np.argmax(score, axis=0)
    assert (predictions(rows, enc, closed.gaussian_bayes(m, maps, 2, 1e-3)) == want).all()


@pytest.mark.parametrize("target", ["cls3", "cls2"])
@pytest.mark.parametrize("solver,shrinkage", [("svd", None), ("lsqr", None), ("lsqr", 0.5), ("lsqr", "auto")])
def test_discriminant(setup, target, solver, shrinkage):
    pdf, enc, made = setup
    rows, m, maps = made[target]
    t = 0
    tr = subset(pdf, t)
    x, every = prepare(tr, pdf)
    k, n, d = m.n_classes, len(x), x.shape[1]
    cov, mus, pri = np.zeros((d, d)), [], []
    for c in range(k):
        own = x[tr[target] == c]
        mus.append(own.mean(0)), pri.append(len(own) / n)
        z = own - own.mean(0)
        s = z.T @ z / len(own)
        if shrinkage == "auto":
            sc = own.std(0)
            sc[sc < 1e-12] = 1
            z = z / sc
            e = z.T @ z / len(own)
            mu_ = np.trace(e) / d
            beta = ((z**2).sum(1) ** 2).sum() / len(own)
            beta = (beta - (e**2).sum()) / (d * len(own))
            delta = ((e**2).sum() - d * mu_**2) / d
            b = min(beta, delta) / delta
            s = ((1 - b) * e + b * mu_ * np.eye(d)) * np.outer(sc, sc)
        elif shrinkage is not None:
            s = (1 - shrinkage) * s + shrinkage * np.trace(s) / d * np.eye(d)
        cov += pri[c] * s
    if solver == "svd":
        cov *= n / (n - k)
    w = np.linalg.pinv(cov, rcond=1e-10) @ np.array(mus).T
    b = np.log(pri) - 0.5 * np.einsum("cd,dc->c", np.array(mus), w)
    want = np.argmax(every @ w + b, axis=1)
    fourth = fourth_moments(rows, enc, m, maps)[t] if shrinkage == "auto" else None
    got = predictions(rows, enc, closed.discriminant(m, maps, t, solver, shrinkage, fourth))
    assert (got == want).all()


def loss_value(o: Objective, m, y, sign):
    z = sign * m
    if o.loss == "log":
        return np.logaddexp(0, -z)
    if o.loss == "squared_hinge":
        return np.maximum(1 - z, 0) ** 2
    if o.loss == "hinge":
        return np.maximum(1 - z, 0)
    if o.loss == "modified_huber":
        return np.where(z >= -1, np.maximum(1 - z, 0) ** 2, -4 * z)
    r = np.abs(m - y)
    if o.loss == "huber":
        return np.where(r <= o.epsilon, r**2 / 2, o.epsilon * r - o.epsilon**2 / 2)
    if o.loss == "epsilon":
        return np.maximum(r - o.epsilon, 0)
    if o.loss == "squared_epsilon":
        return np.maximum(r - o.epsilon, 0) ** 2
    return r**2 / 2


def value(o: Objective, x, y, sign, w):
    pen = w[1:] if not o.penalise_intercept else w
    f = loss_value(o, w[0] + x @ w[1:], y, sign).mean()
    return f + o.l1 * np.abs(w[1:]).sum() + o.l2 / 2 * (pen**2).sum()


def descend(o: Objective, x, y, sign, iters=60_000):
    """Slow, plain proximal (sub)gradient descent with a shrinking step."""
    u = np.column_stack([np.ones(len(x)), x])
    w, best, best_w = np.zeros(u.shape[1]), np.inf, None
    kink = o.loss in ("hinge", "epsilon")
    lip = np.linalg.eigvalsh(u.T @ u / len(u)).max() * 2 + o.l2
    for i in range(iters if kink else 8000):
        g = u.T @ slopes(o.loss, (u @ w)[:, None], y[:, None], sign[:, None], np.array([o.epsilon]), 1e-9)[:, 0] / len(u)
        p = o.l2 * w
        p[0] *= o.penalise_intercept
        step = 1 / lip if not kink else 1.0 / np.sqrt(i + 10)
        w = w - step * (g + p)
        w[1:] = np.sign(w[1:]) * np.maximum(np.abs(w[1:]) - step * o.l1, 0)
        if i % 20 == 0:
            f = value(o, x, y, sign, w)
            if f < best:
                best, best_w = f, w.copy()
    return best, best_w


CLS_POINTS = [
    ("LinearSVC", {"C": 1.0}),
    ("LogisticRegression", {"C": 0.1, "solver": "lbfgs"}),
    ("LogisticRegression", {"C": 0.1, "solver": "saga", "l1_ratio": 0.5}),
    ("LogisticRegression", {"C": 0.1, "solver": "liblinear"}),
    ("SGDClassifier", {"loss": "hinge", "alpha": 0.01, "l1_ratio": 0.15}),
    ("SGDClassifier", {"loss": "modified_huber", "alpha": 0.01, "l1_ratio": 0}),
    ("SGDClassifier", {"loss": "log_loss", "alpha": 0.01, "l1_ratio": 1}),
]
REG_POINTS = [
    ("LinearSVR", {"C": 1.0, "epsilon": 0.1, "loss": "epsilon_insensitive"}),
    ("LinearSVR", {"C": 1.0, "epsilon": 0.1, "loss": "squared_epsilon_insensitive"}),
    ("SGDRegressor", {"loss": "huber", "alpha": 0.01, "l1_ratio": 0.15}),
    ("SGDRegressor", {"loss": "epsilon_insensitive", "alpha": 0.01, "l1_ratio": 0}),
    ("SGDRegressor", {"loss": "squared_error", "alpha": 0.01, "l1_ratio": 0.5}),
]


@pytest.mark.parametrize("newton", [True, False])
@pytest.mark.parametrize("target,points", [("cls2", CLS_POINTS), ("y", REG_POINTS)])
def test_iterative_models_reach_the_optimum(setup, target, points, newton, monkeypatch):
    if not newton:
        monkeypatch.setattr(linear, "MAX_NEWTON", 0)
    pdf, enc, made = setup
    rows, m, maps = made[target]
    t = 1
    fitted = fit_linear(rows, enc, m, maps, points, subsets=[t], max_passes=150, tol=1e-5)
    tr = subset(pdf, t)
    x, _ = prepare(tr, pdf)
    y = tr[target].to_numpy()
    sign = np.where(y == 1, 1.0, -1.0)
    for i, (model, point) in enumerate(points):
        o = objective(model, point, len(x))
        best, _ = descend(o, x, y, sign)
        a = maps[t].with_one()
        w = np.linalg.lstsq(a.T, fitted[(i, t)].weights[:, 0], rcond=None)[0]
        got = value(o, x, y, sign, w)
        slack = 2e-3 if o.loss in ("hinge", "epsilon") else 1e-4
        assert got <= best + slack * max(1, abs(best)), (model, point, got, best)


def test_softmax_matches_newton_free_descent(setup):
    pdf, enc, made = setup
    rows, m, maps = made["cls3"]
    t = 0
    points = [("LogisticRegression", {"C": 0.1, "solver": "lbfgs"})]
    s = fit_linear(rows, enc, m, maps, points, subsets=[t], max_passes=200, tol=1e-7)[(0, t)]
    tr = subset(pdf, t)
    x, every = prepare(tr, pdf)
    u = np.column_stack([np.ones(len(x)), x])
    y = tr.cls3.astype(int).to_numpy()
    lam = 1 / (0.1 * len(x))
    w = np.zeros((u.shape[1], 3))
    lip = np.linalg.eigvalsh(u.T @ u / len(u)).max() + lam
    for _ in range(6000):
        p = np.exp(u @ w)
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(y)), y] -= 1
        reg = lam * w
        reg[0] = 0
        w -= (u.T @ p / len(u) + reg) / lip
    got = predictions(rows, enc, s)
    want = np.argmax(np.column_stack([np.ones(len(every)), every]) @ w, axis=1)
    assert (got == want).mean() > 0.997


def test_one_pass_scores_equal_predictions(setup):
    pdf, enc, made = setup
    rows, m, maps = made["y"]
    scorers = {(a, t): closed.ridge(m, maps, t, alpha) for t in range(K) for a, alpha in enumerate((0.1, 100.0))}
    got = evaluate_scorers(rows, enc, scorers, "regression")
    for (a, t), s in scorers.items():
        p = predictions(rows, enc, s)
        held = (pdf.fold == t).to_numpy()
        assert got[(a, t)] == pytest.approx(-((p[held] - pdf.y[held]) ** 2).mean())


def test_sparse_models(spark):
    rng = np.random.default_rng(1)
    n, d = 300, 12
    x = rng.poisson(0.4, (n, d)).astype(float)
    y = (x[:, 0] + x[:, 1] > x[:, 2] + x[:, 3]).astype(float)
    data = [(i, int(i % 3), float(y[i]), np.flatnonzero(x[i]).tolist(), x[i][x[i] != 0].tolist()) for i in range(n)]
    df = spark.createDataFrame(data, "id long, fold int, y double, indices array<int>, values array<double>")
    enc = SparseEncoding(d)
    rows = sparse_rows(df, "y", "fold", ["id"]).repartition(4).persist()
    m = fold_moments(rows, enc, 3, 2)
    maps = feature_maps(enc, m, rows)
    t = 1
    train = np.arange(n) % 3 != t
    top = np.abs(x[train]).max(0)
    z = x / np.where(top > 0, top, 1)
    logp, prior = [], []
    for c in (0, 1):
        s = z[train & (y == c)].sum(0) + 0.5
        logp.append(np.log(s / s.sum())), prior.append(np.log((train & (y == c)).sum() / train.sum()))
    want = np.argmax(z @ np.array(logp).T + prior, axis=1)
    assert (predictions(rows, enc, closed.multinomial_bayes(m, maps, t, 0.5)) == want).all()
    points = [("LinearSVC", {"C": 1.0})]
    s = fit_linear(rows, enc, m, maps, points, subsets=[t], max_passes=100)[(0, t)]
    o = objective("LinearSVC", {"C": 1.0}, train.sum())
    sign = np.where(y == 1, 1.0, -1.0)
    best, _ = descend(o, z[train], y[train], sign[train])
    w = s.weights[:, 0].copy()
    w[1:] *= np.where(top > 0, top, 1)
    assert value(o, z[train], y[train], sign[train], w) <= best + 1e-3


def wide_rows(spark, n=3000, d=5000, seed=4):
    rng = np.random.default_rng(seed)
    idx = [np.sort(rng.choice(d, 20, replace=False)) for _ in range(n)]
    w = rng.normal(size=d)
    data = []
    for i, ix in enumerate(idx):
        val = rng.integers(1, 4, 20).astype(float)
        data.append((i, i % 3, float(val @ w[ix] + rng.normal() > 0), ix.tolist(), val.tolist()))
    return spark.createDataFrame(data, "id long, fold int, y double, indices array<int>, values array<double>").repartition(4), d


def test_wide_sparse_fit_reaches_the_optimum(spark):
    from tablewright.plans.search import TrainingTable

    df, d = wide_rows(spark)
    t = TrainingTable(df, "classification", 2, 3, None, d, {"id": "bigint"})
    t.learn(True, False)
    assert t.wide and t.moments.gram is None
    points = [("LinearSVC", {"C": 1.0})]
    o = objective("LinearSVC", points[0][1], t.moments.n(1))
    values = []
    for tol in (1e-4, 1e-8):
        s = fit_linear(t.rows, t.enc, t.moments, t.maps, points, subsets=[1], tol=tol)[(0, 1)]
        total = 0.0
        w = s.weights[:, 0]
        for r in df.where("fold <> 1").collect():
            z = (1 if r.y else -1) * (w[0] + sum(w[1 + i] * v for i, v in zip(r.indices, r["values"])))
            total += max(1 - z, 0) ** 2
        scaled = np.append(w[:1], w[1:] / t.maps[1].scale)
        values.append(total / t.moments.n(1) + o.l2 / 2 * (scaled**2).sum())
    t.close()
    assert values[0] <= values[1] * (1 + 1e-4)


def test_too_few_passes_mark_the_point(spark):
    from tablewright.plans.roster import Candidate
    from tablewright.plans.search import TrainingTable, search

    df, d = wide_rows(spark, 300, 400)
    t = TrainingTable(df, "classification", 2, 3, None, d, {"id": "bigint"})
    got = {r.model: r for r in search(t, [Candidate("LinearSVC", {"C": [1.0]}), Candidate("MultinomialNB", {"alpha": [1.0]})], max_passes=2)}
    t.close()
    assert not got["LinearSVC"].ok and got["LinearSVC"].error.startswith("ConvergenceError") and got["MultinomialNB"].ok


def test_wide_models_equal_those_of_the_gram_matrix(spark, monkeypatch):
    from tablewright.plans import search as plan
    from tablewright.plans.roster import Candidate

    pdf = raw_frame()
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, a double, b double, c string, const double, fold int, y double, cls3 double, cls2 double")
    roles = Roles(("a", "b", "const"), ("c",))
    values = [Candidate("Ridge", {"alpha": [0.1, 10.0]}), Candidate("Lasso", {"alpha": [0.01]}), Candidate("ElasticNet", {"alpha": [0.1], "l1_ratio": [0.5]})]
    for rows, task, k, models in ((df.drop("cls2", "cls3"), "regression", 0, values),
                                  (df.drop("y", "cls2").withColumnRenamed("cls3", "y"), "classification", 3, [Candidate("RidgeClassifier", {"alpha": [1.0]}), Candidate("LDA", {"solver": ["lsqr"], "shrinkage": ["auto"]})])):
        scores = []
        for limit in (4096, 3):
            monkeypatch.setattr(plan, "MAX_GRAM", limit)
            t = plan.TrainingTable(rows, task, k, K, roles, None, {"id": "bigint"})
            scores.append({r.model: (r.cv_score, r.error) for r in plan.search(t, models)})
            t.close()
        for model, (score, error) in scores[0].items():
            assert error is None
            assert scores[1][model][0] == pytest.approx(score, rel=1e-9 if model == "LDA" else 2e-3), model


def test_coordinate_descent_that_misses_its_tolerance_fails():
    from tablewright.errors import ConvergenceError

    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6)) @ rng.normal(size=(6, 6))
    with pytest.raises(ConvergenceError):
        closed.coordinate_descent(x.T @ x, x.T @ (x @ rng.normal(size=6)), 0.0, 0.0, 50.0, max_iter=2)


LDA_POINTS = [{"solver": "svd", "shrinkage": None}, {"solver": "lsqr", "shrinkage": None}, {"solver": "lsqr", "shrinkage": 0.5},
              {"solver": "lsqr", "shrinkage": 0.9}, {"solver": "lsqr", "shrinkage": "auto"}]


def close_scores(got, want):
    """Scores on the encoded row that decide alike: equal up to a constant of the row."""
    a, b = got.weights, want.weights
    if got.rule == "argmax" or a.shape[1] > 1:
        a, b = a - a.mean(1, keepdims=True), b - b.mean(1, keepdims=True)
    return a, b


@pytest.mark.parametrize("target", ["cls3", "cls2"])
def test_discriminants_by_passes_equal_the_matrix_form(setup, target):
    from tablewright.operators.discriminant import fit_discriminants

    _, enc, made = setup
    rows, m, maps = made[target]
    missed = set()
    got = fit_discriminants(rows, enc, m, maps, LDA_POINTS, [0, K], unconverged=missed)
    assert not missed
    fourth = fourth_moments(rows, enc, m, maps)
    for (i, t), s in got.items():
        p = LDA_POINTS[i]
        want = closed.discriminant(m, maps, t, p["solver"], p["shrinkage"], fourth[t])
        assert (predictions(rows, enc, s) == predictions(rows, enc, want)).all(), p
    assert len(got) == 2 * len(LDA_POINTS)


def wide_dense(spark, n, d, seed=8):
    """Numbers of ``d`` columns with their own spreads, some of them in step, and three classes."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    x = rng.normal(size=(n, d)) * rng.uniform(0.5, 3, d) + rng.normal(size=(n, 8)) @ rng.normal(size=(8, d)) + (y[:, None] == np.arange(d) % 3) * 0.3
    x[:, 5] = x[:, 6] * 2  # no spread of its own
    data = [(i, int(i % 3), float(y[i]), np.arange(d).tolist(), x[i].tolist()) for i in range(n)]
    return spark.createDataFrame(data, "id long, fold int, y double, indices array<int>, values array<double>").repartition(4), x, y


def test_discriminant_by_passes_at_a_thousand_columns(spark):
    from tablewright.operators.discriminant import covariance_spreads, fit_discriminants

    d = 1000
    df, x, y = wide_dense(spark, 3000, d)
    enc = SparseEncoding(d)
    rows = sparse_rows(df, "y", "fold", ["id"]).persist()
    m = fold_moments(rows, enc, K, 3, True, True)
    maps = feature_maps(enc, m, rows)
    fourth = fourth_moments(rows, enc, m, maps)
    missed = set()
    got = fit_discriminants(rows, enc, m, maps, [p for p in LDA_POINTS if p["shrinkage"] != 0.9], [0], unconverged=missed)
    assert not missed and len(got) == 4
    z = np.hstack([np.ones((len(x), 1)), x])
    for (i, t), s in got.items():
        p = [p for p in LDA_POINTS if p["shrinkage"] != 0.9][i]
        want = closed.discriminant(m, maps, t, p["solver"], p["shrinkage"], fourth[t])
        a, b = close_scores(s, want)
        a, b = z @ a, z @ b
        assert np.abs(a - b).max() <= 1e-5 * np.abs(b).max(), p
    fm = maps[0]
    n, mu = closed.class_means(m, fm, 0)
    scales = closed.class_scales(m, fm, 0)
    spread = covariance_spreads(rows, enc, m, maps, [0], {0: scales}, block=300)[0]
    own = x[(y == 1) & (np.arange(len(y)) % 3 != 0)] * fm.scale
    sd = own.std(0)
    assert spread[1] == pytest.approx((np.cov(own / sd, rowvar=False, bias=True) ** 2).sum(), rel=1e-9)
    rows.unpersist()


def test_discriminant_above_the_matrix_limit(spark):
    """5,000 columns, more than rows: shrunk analyses in the search, equal to a solve over the rows."""
    from tablewright.plans.roster import Candidate
    from tablewright.plans.search import TrainingTable, search

    df, x, y = wide_dense(spark, 300, 5000)
    t = TrainingTable(df, "classification", 3, 3, None, 5000, {"id": "bigint"})
    got = search(t, [Candidate("LDA", {"solver": ["lsqr"], "shrinkage": [None, 0.5]})])[0]
    assert t.wide and got.ok and 0.5 < got.cv_score <= 1
    z = x / np.abs(x).max(0)
    mu = np.array([z[y == c].mean(0) for c in range(3)])
    own = z - mu[y]
    n = np.bincount(y)
    rate = got.params["shrinkage"]
    delta = mu - (n / n.sum()) @ mu
    s = own / np.sqrt(len(y))
    if rate:
        level = (n / n.sum()) @ np.array([z[y == c].var(0).mean() for c in range(3)])
        a, b = (1 - rate), rate * level
        w = (delta.T - s.T @ np.linalg.solve(np.eye(len(y)) * b / a + s @ s.T, s @ delta.T)) / b
    else:
        w = np.linalg.pinv(s, rcond=1e-5) @ np.linalg.pinv(s.T, rcond=1e-5) @ delta.T
    want = np.argmax(z @ w + np.log(n / n.sum()) - 0.5 * (delta.T * w).sum(0) - (n / n.sum()) @ mu @ w, axis=1)
    made = predict_rows(t.rows, t.enc, got.fitted, t.keep).orderBy("id").toPandas()
    t.close()
    assert (made["p"].to_numpy() == want).mean() == 1.0


@pytest.mark.parametrize("model, point", [("LogisticRegression", {"C": 1.0, "solver": "liblinear"}), ("SGDClassifier", {"loss": "log_loss", "alpha": 0.001, "l1_ratio": 0.15}),
                                          ("LogisticRegression", {"C": 1.0, "solver": "saga", "l1_ratio": 0.5})])
def test_large_tables_begin_near_the_optimum(setup, monkeypatch, model, point):
    """The optimum of all rows, in few passes over them."""
    from tablewright.operators import linear

    rows, m, maps = setup[2]["cls2"]
    enc, passes = setup[1], []
    plain = linear._newton_pass
    monkeypatch.setattr(linear, "_newton_pass", lambda r, *a: (passes.append(r is rows), plain(r, *a))[1])
    whole = linear.fit_linear(rows, enc, m, maps, [(model, point)], subsets=[0])[(0, 0)]
    before = sum(passes)
    passes.clear()
    near = linear.fit_linear(rows, enc, m, maps, [(model, point)], subsets=[0], start_rows=150)[(0, 0)]
    assert 0 < sum(passes) < before and len(passes) > sum(passes)
    both = [maps[0].with_one() @ s.weights[:, 0] for s in (whole, near)]
    assert np.abs(both[0] - both[1]).max() < 0.03 * max(1, np.abs(both[0]).max())


@pytest.mark.parametrize("target,points", [
    ("cls3", [("LinearSVC", {"C": 1}), ("LogisticRegression", {"C": 1, "solver": "lbfgs"})]),
    ("y", [("LinearSVR", {"C": 1, "epsilon": 0.1, "loss": "squared_epsilon_insensitive"})]),
])
def test_passes_over_packed_rows_give_the_same_fits(setup, target, points):
    from tablewright.operators.design import packed
    from tablewright.operators.scoring import evaluate_scorers

    pdf, enc, made = setup
    rows, m, maps = made[target]
    blocks = packed(rows, enc).persist()
    n = (pdf.fold >= 0).sum()
    assert blocks.count() < n / 10  # a pass gets blocks, not rows
    again = fold_moments(blocks, enc, K, m.n_classes, class_gram=m.class_gram is not None)
    assert np.allclose(again.sums, m.sums) and np.allclose(again.gram, m.gram) and again.n(K) == n
    task = "regression" if target == "y" else "classification"
    plain = fit_linear(rows, enc, m, maps, points, subsets=[0, 1])
    fast = fit_linear(rows, enc, m, maps, points, subsets=[0, 1], blocks=blocks)
    for key, s in plain.items():
        assert np.allclose(fast[key].weights, s.weights, atol=1e-5), points[key[0]]
    old, new = evaluate_scorers(rows, enc, plain, task), evaluate_scorers(blocks, enc, fast, task)
    assert old.keys() == new.keys() and all(abs(old[k] - new[k]) < 1e-4 * max(1, abs(old[k])) for k in old)
    blocks.unpersist()

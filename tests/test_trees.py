"""Trees against plain numpy recursion, whole tables against passes by level."""

import numpy as np
import pytest

from tablewright.functions.roles import Roles
from tablewright.operators import grower as g
from tablewright.operators.design import batches
from tablewright.operators.scoring import evaluate_scorers
from tablewright.operators.trees import REFRESH, Levels, fit_points, stem_of
from tablewright.plans.search import TrainingTable

N, K = 1000, 3


def frame():
    rng = np.random.default_rng(6)
    a = np.round(rng.normal(size=N), 1)
    b = np.where(rng.random(N) < 0.15, np.nan, rng.integers(0, 12, N))
    c = rng.choice(["u", "v", None], N)
    z = a + 0.3 * np.nan_to_num(b) + (c == "u") + rng.normal(scale=0.5, size=N)
    return {"id": np.arange(N), "a": a, "b": b, "c": c, "fold": np.arange(N) % K, "value": np.round(z * 4) / 4, "three": np.digitize(z, [1, 2.5]).astype(float), "two": (z > 1.6).astype(float)}


@pytest.fixture(scope="module")
def tables(spark):
    cols = frame()
    rows = [tuple(None if v is None or (isinstance(v, float) and np.isnan(v)) else v for v in r) for r in zip(*(c.tolist() for c in cols.values()))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c string, fold int, value double, three double, two double").repartition(6)
    made = {}
    for y, task, k in (("value", "regression", 0), ("three", "classification", 3), ("two", "classification", 2)):
        t = TrainingTable(df.select("id", "a", "b", "c", "fold", df[y].alias("y")), task, k, K, Roles(("a", "b"), ("c",)), None, {"id": "bigint"})
        t.learn(False, False)
        made[y] = t
    yield made
    for t in made.values():
        t.close()


def both(t, points, subset=0):
    """Scorers grown whole, and level by level with small nodes sent on."""
    asked = [(m, p, subset) for m, p in points]
    args = (t.rows, t.enc, t.moments, asked, t.task == "classification", t.n_classes, ["id"])
    return [fit_points(*args), fit_points(*args, local_cells=0, local_rows=60)]


def data(t, scorer):
    """All rows of a table in order of id: features of the scorer's subset, y, fold, and the batches themselves."""
    rows = t.rows.toArrow().combine_chunks().sort_by("id").to_batches()
    (b,) = batches(t.enc, rows)
    return g.matrix(t.enc, b, scorer.forest.fill), b.y, b.fold, b


def impurity(y, criterion):
    if criterion == "absolute_error":
        return np.abs(y - np.median(y)).sum()
    if criterion == "squared_error":
        return ((y - y.mean()) ** 2).sum()
    p = np.unique(y, return_counts=True)[1] / len(y)
    return len(y) * (1 - (p * p).sum() if criterion == "gini" else -(p * np.log(p)).sum())


def plain_tree(x, y, criterion, classes, cuts, depth, min_split, min_leaf, draw=None, key=None):
    """Predictor by plain recursion over all cuts (or those that ``draw`` gives for a node)."""
    if classes:
        value = np.bincount(y.astype(int), minlength=classes) / len(y)
    else:
        value = np.array([np.median(y) if criterion == "absolute_error" else y.mean()])
    best = None
    if depth > 0 and len(y) >= min_split and len(np.unique(y)) > 1:
        for f, c in draw(x, key) if draw else [(f, c) for f in range(x.shape[1]) for c in cuts[f]]:
            go = x[:, f] <= c
            if min(go.sum(), (~go).sum()) < max(1, min_leaf):
                continue
            cost = impurity(y[go], criterion) + impurity(y[~go], criterion)
            if best is None or cost < best[0] - 1e-7:
                best = cost, f, c
    if best is None:
        return lambda q: np.tile(value, (len(q), 1))
    _, f, c = best
    go = x[:, f] <= c
    sides = [plain_tree(x[m], y[m], criterion, classes, cuts, depth - 1, min_split, min_leaf, draw, key if key is None else int(g.mix(key, 2 + s))) for s, m in ((0, go), (1, ~go))]
    return lambda q: np.where((q[:, f] <= c)[:, None], sides[0](q), sides[1](q))


def all_cuts(x):
    out = []
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        out.append((v[1:] + v[:-1]) / 2)
    return out


@pytest.mark.parametrize("y, criterion", [("three", "gini"), ("two", "entropy"), ("value", "squared_error"), ("value", "absolute_error")])
def test_tree_grid_equals_plain_recursion(tables, y, criterion):
    t = tables[y]
    points = [("DecisionTree", {"max_depth": d, "min_samples_split": s, "min_samples_leaf": leaf, "criterion": criterion})
              for d, s, leaf in ((1, 2, 1), (4, 2, 1), (None, 40, 1), (5, 30, 10))]
    x, truth, fold, batch = data(t, both(t, points[:1])[0][0])
    train = fold != 0
    for scorers in both(t, points):
        for (_, p), scorer in zip(points, scorers):
            # cuts lie between values of all rows, also those held out
            plain = plain_tree(x[train], truth[train], criterion, t.n_classes if t.task == "classification" else 0, all_cuts(x), p["max_depth"] or 99, p["min_samples_split"], p["min_samples_leaf"])
            want = plain(x)
            got = scorer.predict(batch)
            if t.task == "classification":
                same = want.argmax(1) == got
                assert same.mean() > 0.99 if p["max_depth"] is None else same.all(), p  # equal gains of mirrored cuts may differ by rounding
            else:
                assert (np.abs(want[:, 0] - got) < 1e-9).mean() > 0.99, p


@pytest.mark.parametrize("y", ["three", "value"])
def test_extra_trees_equal_plain_recursion(tables, y):
    t = tables[y]
    point = {"n_estimators": 3, "max_depth": 6, "min_samples_split": 5}
    whole, levels = (s[0] for s in both(t, [("ExtraTrees", point)]))
    x, truth, fold, batch = data(t, whole)
    train, live = fold != 0, whole.forest.fill.live
    stem = stem_of("ExtraTrees", point, t.task == "classification", t.n_classes, 0, int(live.sum()))

    def draw(x, key):
        """Every node draws from its own range."""
        order = g.uniform(g.mix(np.uint64(key) ^ g.mix(np.arange(x.shape[1]), 5), stem.seed))
        able = [f for f in np.argsort(order) if live[f] and x[:, f].max() > x[:, f].min()][: stem.max_features or x.shape[1]]
        for f in sorted(able):
            lo, hi = x[:, f].min(), x[:, f].max()
            yield f, lo + g.uniform(g.mix(np.uint64(key) ^ g.mix(f, 9), stem.seed)) * (hi - lo)

    total = 0
    for number in range(3):
        total = total + plain_tree(x[train], truth[train], "gini" if t.n_classes > 1 else "squared_error", t.n_classes if t.n_classes > 1 else 0, None, 6, 5, 1, draw, int(g.mix(number, stem.seed)))(x)
    for scorer in (whole, levels):
        got = scorer.predict(batch)
        assert (total.argmax(1) == got).mean() > 0.995 if t.n_classes > 1 else (np.abs(total[:, 0] / 3 - got) < 1e-9).mean() > 0.995


@pytest.mark.parametrize("y", ["three", "value"])
def test_forests_grow_alike_whole_and_by_levels(tables, y):
    t = tables[y]
    points = [("RandomForest", {"n_estimators": n, "max_depth": d, "min_samples_split": s, "max_features": "sqrt"}) for n, d, s in ((6, None, 2), (4, 3, 10))]
    whole, levels = both(t, points)
    _, truth, fold, batch = data(t, whole[0])
    for a, b in zip(whole, levels):
        p, q = a.predict(batch), b.predict(batch)
        assert (np.abs(p - q) < 1e-9).mean() > 0.98
        assert len(a.forest.trees) == 6
    own = both(t, points[1:])[0][0]
    assert (np.abs(own.predict(batch) - whole[1].predict(batch)) < 1e-9).all()  # read from the larger forest
    p = whole[0].predict(batch)[fold == 0]
    assert (p == truth[fold == 0]).mean() > 0.6 if t.n_classes > 1 else ((p - truth[fold == 0]) ** 2).mean() < 0.6 * truth.var()


@pytest.mark.parametrize("y", ["three", "two", "value"])
def test_boosting(tables, y):
    t = tables[y]
    points = [("GradientBoosting", {"n_estimators": n, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8}) for n in (8, 4)]
    whole, levels = both(t, points)
    x, truth, fold, batch = data(t, whole[0])
    stem = whole[0].forest.stem
    for a, b in zip(whole, levels):
        assert (np.abs(a.predict(batch) - b.predict(batch)) < 1e-6).mean() > 0.98
    train = fold != 0
    losses = [g.loss(stem, g.add_scores(stem, whole[0].forest.trees[: n * stem.scores], x[train], np.tile(whole[0].forest.start, (int(train.sum()), 1))), truth[train]) for n in (0, 4, 8)]
    assert losses[0] > losses[1] > losses[2]
    assert len(whole[0].forest.trees) == 8 * stem.scores and stem.scores == (3 if y == "three" else 1)


def test_softmax_boosting_is_no_worse_than_one_against_the_rest(tables):
    t = tables["three"]
    p = {"n_estimators": 15, "learning_rate": 0.1, "max_depth": 3, "subsample": 1.0}
    (one,), _ = both(t, [("GradientBoosting", p)])
    x, truth, fold, _ = data(t, one)
    held = fold == 0
    stem = one.forest.stem
    joint = g.loss(stem, g.add_scores(stem, one.forest.trees, x[held], np.tile(one.forest.start, (int(held.sum()), 1))), truth[held])
    apart = []
    train = ~held
    bins = g.Bins(all_cuts(x), one.forest.fill.live)
    for c in range(3):
        alone = stem_of("GradientBoosting", p, True, 2, 0, x.shape[1])
        start, trees = g.boost(alone, bins, x[train], bins.codes(x[train]), (truth[train] == c).astype(float), g.mix(np.arange(int(train.sum())), 1))
        apart.append(g.probabilities(g.add_scores(alone, [s.arrays() for s in trees], x[held], np.tile(start, (int(held.sum()), 1))))[:, 1])
    share = np.stack(apart, 1)
    share /= share.sum(1, keepdims=True)
    assert joint <= -np.log(share[np.arange(len(share)), truth[held].astype(int)]).sum() * 1.02


def test_nodes_below_small_ones_reach_the_driver_as_arrays(tables, monkeypatch):
    t = tables["value"]
    added = []
    add = g.Tree.add
    monkeypatch.setattr(g.Tree, "add", lambda self, *a: added.append(1) or add(self, *a))
    point = ("DecisionTree", {"max_depth": None, "min_samples_split": 2, "min_samples_leaf": 1}, 0)
    (deep,) = fit_points(t.rows, t.enc, t.moments, [point], False, 1, ["id"], local_cells=0, local_rows=60)
    feature, _, left, depth, n, value = deep.forest.trees[0]
    assert len(added) < len(feature) / 2  # the driver made objects of the upper nodes only
    inner = np.flatnonzero(feature >= 0)
    assert sorted([*left[inner], *(left[inner] + 1)]) == list(range(1, len(feature)))
    assert (depth[left[inner]] == depth[inner] + 1).all() and np.allclose(n[left[inner]] + n[left[inner] + 1], n[inner])


@pytest.fixture(scope="module")
def repeated(spark, tables):
    """Every row of the table four times, under other keys and in other folds, and one row 5,000 times more."""
    from pyspark.sql import functions as F
    made = {}
    for y, task, k in (("value", "regression", 0), ("three", "classification", 3)):
        df = tables[y].df
        more = df.crossJoin(spark.range(4).withColumnRenamed("id", "copy")).unionByName(
            df.where("id = 7").crossJoin(spark.range(10, 5010).withColumnRenamed("id", "copy")))
        df = more.withColumn("id", F.col("id") + 1000 * F.col("copy")).withColumn("fold", ((F.col("fold") + F.when(F.col("copy") < 2, 0).otherwise(1)) % K).cast("int"))
        t = TrainingTable(df.drop("copy").repartition(6), task, k, K, Roles(("a", "b"), ("c",)), None, {"id": "bigint"})
        t.learn(False, False)
        made[y] = t
    yield made
    for t in made.values():
        t.close()


def test_equal_rows_are_one_row_of_a_pass(repeated):
    t = repeated["value"]
    sizes = np.array([len(r["__keys"]) for r in t.groups().collect()])
    assert sizes.sum() == t.rows.count() == 4 * N + 5000
    assert len(sizes) < 2 * N + 20 and sizes.max() < 2500  # the large group is dealt out


@pytest.mark.parametrize("y, model, p", [
    ("three", "DecisionTree", {"max_depth": 6, "min_samples_split": 20, "min_samples_leaf": 5, "criterion": "gini"}),
    ("value", "ExtraTrees", {"n_estimators": 3, "max_depth": 5, "min_samples_split": 5}),
    ("value", "RandomForest", {"n_estimators": 3, "max_depth": 5, "min_samples_split": 5, "max_features": None}),
    ("three", "GradientBoosting", {"n_estimators": 7, "learning_rate": 0.1, "max_depth": 3, "subsample": 0.8}),
])
def test_equal_rows_grow_the_trees_of_all_their_rows(repeated, y, model, p):
    t = repeated[y]
    args = (t.rows, t.enc, t.moments, [(model, p, 0)], t.task == "classification", t.n_classes, ["id"])
    (whole,), (levels,) = fit_points(*args), fit_points(*args, local_cells=0, local_rows=60, groups=t.groups)
    _, _, _, batch = data(t, whole)
    assert (np.abs(whole.predict(batch) - levels.predict(batch)) < 1e-6).mean() > 0.98
    assert abs(levels.forest.trees[0][4][0] / whole.forest.trees[0][4][0] - 1) < 1e-6  # rows of the root: all of them
    key = {(0, 0): levels}
    by_rows, by_groups = (evaluate_scorers(r, t.enc, key, t.task) for r in (t.rows, t.judged))
    assert t.judged is not t.rows and abs(by_rows[0, 0] - by_groups[0, 0]) < 1e-9


def test_boosting_reads_new_trees_only(tables, monkeypatch):
    t, most = tables["two"], []
    scoring = Levels._scoring
    monkeypatch.setattr(Levels, "_scoring", lambda self: most.append(max(map(len, scoring(self)[0]))) or scoring(self))
    p = {"n_estimators": 8, "learning_rate": 0.1, "max_depth": 2, "subsample": 1.0}
    (levels,) = fit_points(t.rows, t.enc, t.moments, [("GradientBoosting", p, 0)], True, 2, ["id"], local_cells=0)
    assert len(levels.forest.trees) == 8 and max(most) <= REFRESH


@pytest.mark.parametrize("y, model, p, column", [
    ("three", "DecisionTree", {"max_depth": 6, "min_samples_split": 20, "min_samples_leaf": 5, "criterion": "gini"}, "__times"),
    ("value", "RandomForest", {"n_estimators": 5, "max_depth": 5, "min_samples_split": 5, "max_features": None}, "__drawn"),
])
def test_passes_of_equal_rows_read_no_keys(repeated, monkeypatch, y, model, p, column):
    from tablewright.operators import trees as module

    t, seen = repeated[y], []
    own = Levels.__init__
    monkeypatch.setattr(Levels, "__init__", lambda self, rows, *more: seen.append(rows.columns) or own(self, rows, *more))
    args = (t.rows, t.enc, t.moments, [(model, p, 0)], t.task == "classification", t.n_classes, ["id"])
    more = dict(local_cells=0, local_rows=60, groups=t.groups)
    (short,) = fit_points(*args, **more)
    monkeypatch.setattr(module, "ONCE", 0)
    monkeypatch.setattr(module, "draws", lambda stems: True)
    (keyed,) = fit_points(*args, **more)
    assert column in seen[0] and "__keys" not in seen[0] and "__keys" in seen[1]
    _, _, _, batch = data(t, short)
    assert np.array_equal(short.forest.trees[0][4], keyed.forest.trees[0][4])
    assert np.allclose(short.predict(batch), keyed.predict(batch))


def test_poisson_draws_by_their_first_bits():
    bits = np.random.default_rng(5).integers(0, 1 << 64, 200_000, dtype=np.uint64, endpoint=False)
    bits = np.concatenate([bits, (g.POISSON[:12, None] * 2.0**53 + np.arange(-2, 3)).astype(np.uint64).ravel() << np.uint64(11)])
    assert np.array_equal(g.poisson(bits), np.searchsorted(g.POISSON, g.uniform(bits)))

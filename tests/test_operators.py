"""Inference, splits, metrics, preparation and rosters on small literal tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import KEYS
from tablewright.errors import EmptyDataError
from tablewright.functions.roles import Roles, assign_roles
from tablewright.operators.inference import infer_task
from tablewright.operators.metrics import class_report, classification_metrics, confusion_cells, confusion_matrix, regression_metrics, roc_auc
from tablewright.operators.prepare import category_counts, fit_preparation, max_abs_scale, modes
from tablewright.operators.profile import class_balance, dense_shape
from tablewright.operators.split import assign_folds, fold_allocation, holdout_quotas, holdout_split, largest_remainder, split_and_fold
from tablewright.plans.roster import Candidate, candidates, cv_folds, distinct_points, scoring, time_budget


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"y {kind}")


C, R = "classification", "regression"


@pytest.mark.parametrize(
    "values,kind,rule,want",
    [
        ([1.5, 2.5] * 3, "double", "main", C),
        ([float("nan")] * 4, "double", "main", R),
        ([i + 0.5 for i in range(8)] + [None], "double", "main", C),  # 8 values and one missing: 9 distinct
        ([i + 0.5 for i in range(9)] + [None], "double", "main", R),
        (list(range(10, 59)), "bigint", "main", C),
        ([2 * i for i in range(50)], "bigint", "main", R),
        (list(range(100)), "bigint", "main", C),
        (list(range(1, 101)), "bigint", "main", R),
        ([float(i) for i in range(19)], "double", "main", C),
        ([float(i) for i in range(20)], "double", "main", R),
        ([i / 2 for i in range(20)], "double", "simple", C),
        ([i / 2 for i in range(21)], "double", "simple", R),
        ([i / 2 for i in range(5)], "double", "strict", R),
        ([float(i) for i in range(20)], "double", "strict", C),
    ],
)
def test_task_rules(spark, values, kind, rule, want):
    assert infer_task(column(spark, values, kind), "y", rule) == want


def test_task_of_empty_and_array_targets(spark):
    with pytest.raises(EmptyDataError):
        infer_task(column(spark, []), "y")
    assert infer_task(column(spark, []), "y", "strict") == R
    assert infer_task(spark.sql("select array(1D, 0D) as y"), "y") == C


def test_quotas():
    assert largest_remainder([5, 3, 2], 2) == [1, 1, 0]
    assert holdout_quotas([("a", 50, 0), ("b", 49, 1), ("c", 1, 2)], 0.2)["c"] == 0
    assert sum(holdout_quotas([("a", 33, 0), ("b", 33, 1), ("c", 35, 2)], 0.2).values()) == 21


def test_fold_allocation_deals_like_cards():
    sizes = [("a", 40), ("b", 33), ("c", 28)]
    order = np.repeat([0, 1, 2], [s for _, s in sizes])
    want = [np.bincount(order[f::3], minlength=3) for f in range(3)]
    got = fold_allocation(sizes, 3)
    assert [[got[c][f] for c, _ in sizes] for f in range(3)] == [list(w) for w in want]


def test_split_invariants(spark, lineitem):
    df = lineitem.select(*KEYS, "l_returnflag")
    out = split_and_fold(df, KEYS, 3, "l_returnflag").persist()
    n = df.count()
    assert out.count() == n
    got = {(r["l_returnflag"], r["fold"]): r["count"] for r in out.groupBy("l_returnflag", "fold").count().collect()}
    assert sum(v for (_, f), v in got.items() if f == -1) == -(-n // 5)
    for c, total in df.groupBy("l_returnflag").count().collect():
        assert abs(got[(c, -1)] - 0.2 * total) <= 1
        sizes = [got[(c, f)] for f in range(3)]
        assert max(sizes) - min(sizes) <= 1
    again = split_and_fold(df.repartition(13), KEYS, 3, "l_returnflag")
    assert out.select(*KEYS, "fold").exceptAll(again.select(*KEYS, "fold")).isEmpty()


def test_small_splits(spark):
    df = spark.range(11).withColumn("c", F.when(F.col("id") == 4, "solo").otherwise("many"))
    out = holdout_split(df, ["id"], "c")
    assert {r["split"]: r["count"] for r in out.groupBy("split").count().collect()} == {"test": 3, "train": 8}
    assert out.where("c = 'solo'").first()["split"] == "train"
    folds = assign_folds(spark.range(11), ["id"], 4).groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in folds] == [3, 3, 3, 2]
    tiny = assign_folds(df, ["id"], 3, "c")
    assert tiny.groupBy("fold").count().count() == 3 and tiny.count() == 11


def test_one_hot_class_holds_a_third(spark):
    """A key repeated inside a class and one huge class still split exactly."""
    df = spark.range(3000).withColumn("c", F.when(F.col("id") < 1000, 0).otherwise(F.col("id") % 7))
    out = holdout_split(df, ["id"], "c")
    assert out.where("split = 'test'").count() == 600


def test_classification_metrics_with_unseen_prediction(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("b", "z")], "y string, p string")
    m = classification_metrics(df).first()
    assert m["accuracy"] == 0.5 and m["n_classes"] == 2 and m["recall"] == 0.5
    assert m["f1_macro"] == pytest.approx((2 / 3 + 0.5 + 0) / 3)
    cm = {(r["actual"], r["predicted"]): r["n"] for r in confusion_matrix(df).collect()}
    assert len(cm) == 9 and cm[("z", "a")] == 0 and cm[("b", "z")] == 1
    assert class_report(df).count() == 6
    assert classification_metrics(df, average="micro").first()["precision"] == 0.5


def test_report_needs_at_most_ten_classes(spark):
    assert class_report(spark.range(11).selectExpr("id as y", "id as p")).count() == 0
    assert class_report(spark.range(10).selectExpr("id as y", "id as p")).count() == 13


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.5), (0, 0.5), (0, 0.1)], "y int, s double")
    assert roc_auc(df, "y", "s").first()[0] == pytest.approx(0.875)
    assert roc_auc(df.where("y = 1"), "y", "s").first()[0] is None


def test_regression_edges(spark):
    exact = spark.createDataFrame([(2.0, 2.0), (2.0, 2.0)], "y double, p double")
    off = spark.createDataFrame([(2.0, 3.0), (2.0, 1.0)], "y double, p double")
    assert regression_metrics(exact).first()["r2"] == 1.0 and regression_metrics(off).first()["r2"] == 0.0
    zero = spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double")
    assert regression_metrics(zero).first()["mape"] is None
    m = regression_metrics(off).first()
    assert (m["mse"], m["max_error"], m["mape"]) == (1.0, 1.0, 50.0)


def test_preparation_details(spark):
    df = spark.createDataFrame(
        [(1.0, "b", 7.0, None, None), (2.0, "a", 7.0, None, None), (4.0, "b", 7.0, None, None), (None, None, 7.0, None, None)],
        "x double, c string, k double, gone double, lost string",
    )
    p = fit_preparation(df, Roles(("x", "k", "gone"), ("c", "lost")))
    assert p.dropped == ["gone", "lost"]
    assert p.modes == {"c": "b"} and p.categories == {"c": ["a", "b"]}
    x = [r[0] for r in df.select(p.scaled("x")).collect()]
    filled = np.array([1, 2, 4, 7 / 3])
    assert np.allclose(x, (filled - filled.mean()) / filled.std())
    assert [r[0] for r in df.select(p.scaled("k")).collect()] == [0.0] * 4
    unseen = spark.createDataFrame([(1.0, "q", 7.0, None, None)], df.schema)
    assert list(p.vectors(unseen).first()["features"].toArray()[2:]) == [0.0, 0.0]


def test_mode_tie_takes_the_smallest(spark):
    df = spark.createDataFrame([("3",), ("3",), ("1",), ("1",)], "v string")
    assert modes(category_counts(df, ["v"])).first()["mode"] == "1"


def test_max_abs_keeps_zero_columns(spark):
    cells = spark.createDataFrame([(0, 0, -4.0), (1, 0, 2.0), (0, 1, 0.0)], "row_id bigint, idx int, val double")
    assert sorted(tuple(r) for r in max_abs_scale(cells).collect()) == [(0, 0, -1.0), (0, 1, 0.0), (1, 0, 0.5)]


def test_roles():
    r = assign_roles(["a", "b", "c"], ["id", "Categorical", "numeric"])
    assert (r.numerical, r.categorical, r.other) == (("c",), ("b",), ("a",))
    assert assign_roles(["a", "b"], ["Categorical"]).numerical == ("a", "b")
    assert assign_roles(["a"], ["Numerical Categorical"]).numerical == ("a",)


def test_wide_profile_equals_narrow(spark, lineitem, monkeypatch):
    cols = ["l_quantity", "l_discount", "l_tax"]
    narrow = dense_shape(lineitem, cols).first()
    monkeypatch.setattr("tablewright.operators.profile.MELT_ABOVE", 1)
    assert tuple(dense_shape(lineitem, cols).first()) == tuple(narrow)


def test_balance_of_one_class(spark):
    b = class_balance(spark.range(3).selectExpr("1 as y"), "y").first()
    assert (b["imbalance_level"], b["imbalance"], b["imbalance_ratio"]) == ("N/A", 0.0, None)


def test_roster_of_the_sample_shape():
    got = {c.model: c for c in candidates(C, 27_352, 24)}
    assert list(got) == ["LinearSVC", "RidgeClassifier", "SGDClassifier", "LogisticRegression", "GaussianNB", "DecisionTree"]
    assert [len(c.points()) for c in got.values()] == [3, 20, 270, 6, 3, 27]
    assert [len(distinct_points(c)) for c in got.values()] == [3, 4, 45, 6, 3, 27]


def test_grid_order_and_rules():
    pts = Candidate("x", {"b": [1, 2], "a": ["p", "q"]}).points()
    assert pts == [{"a": "p", "b": 1}, {"a": "p", "b": 2}, {"a": "q", "b": 1}, {"a": "q", "b": 2}]
    assert [cv_folds(n) for n in (19, 20, 50, 100, 999, 1000)] == [2, 3, 4, 5, 5, 3]
    assert time_budget(100, 99) == 60 and time_budget(10_000, 1000) == 600
    assert scoring(C) == "accuracy"
    with pytest.raises(ValueError):
        scoring("other")
    assert [c.model for c in candidates(R, 6000, 10)] == ["LinearSVR", "Ridge", "SGDRegressor", "ElasticNet"]
    assert "MultinomialNB" in [c.model for c in candidates(C, 200, 50, True)]
    assert "KNN" in [c.model for c in candidates(R, 4999, 50)]


def test_confusion_of_many_labels_has_no_zeros(spark):
    df = spark.range(6000).select((F.col("id") % 1500).alias("y"), F.when(F.col("id") < 3000, F.col("id") % 1500).otherwise(7).alias("p"))
    cells = {(r["actual"], r["predicted"]): tuple(r)[2:] for r in confusion_cells(df).collect()}
    assert len(cells) == 1500 + 1499 and cells[3, 3] == (2, 4, 2) and cells[3, 7] == (2, 4, 3002) and cells[7, 7] == (4, 4, 3002)
    with pytest.raises(Exception, match="more than 1000 labels"):
        confusion_matrix(df).collect()


def test_confusion_cells_of_nulls_and_no_rows(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("a", "a")], "y string, p string")
    assert {tuple(r) for r in confusion_cells(df).collect()} == {("a", None, 1, 2, 2), (None, None, 1, 1, 2), ("a", "a", 1, 2, 1)}
    assert confusion_cells(df.limit(0)).count() == 0

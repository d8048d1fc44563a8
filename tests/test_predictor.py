"""Whole searches on derived targets, failure handling and streaming."""

import pytest
from pyspark.sql import functions as F

from samples import KEYS
from tablewright.errors import TargetError
from tablewright.plans.predictor import TablePredictor, evaluate, fit
from tablewright.plans.search import ModelResult, choose
from tablewright.streaming.scoring import score_stream

FEATURES = ["l_quantity", "l_discount", "l_tax", "l_linestatus"]


@pytest.fixture(scope="module")
def table(lineitem):
    return lineitem.where("l_orderkey % 8 = 0").select(
        *KEYS, *FEATURES,
        F.expr("case when l_quantity + 200 * l_discount < 25 then 'low' when l_quantity + 200 * l_discount < 45 then 'mid' else 'top' end").alias("c"),
        F.expr("3 * l_quantity - 50 * l_discount").alias("v"),
    ).persist()


def test_regression_finds_the_linear_rule(table):
    p = TablePredictor("v", max_points=1, models=["Ridge", "KNN", "Lasso", "LinearSVR", "DecisionTree"]).fit(
        table.drop("c"), "v", KEYS, features=FEATURES)
    assert p.task == "regression" and p.best.model in ("Lasso", "Ridge", "LinearSVR")
    board = p.leaderboard().collect()
    assert len(board) == 5 and all(r["status"] == "ok" for r in board)
    assert board[0]["is_best"] and board[0]["test_r2"] > 0.999
    again = p.predict(table, KEYS, "KNN")
    assert again.count() == table.count()


def test_classification_and_streaming(spark, table, tmp_path):
    p = TablePredictor("c", max_points=1, models=["LogisticRegression", "GaussianNB", "LDA", "RandomForest"]).fit(
        table.drop("v"), "c", KEYS, features=FEATURES)
    assert p.classes == ["low", "mid", "top"]
    got = {r["model"]: r["test_accuracy"] for r in p.leaderboard().collect()}
    assert got["LogisticRegression"] > 0.9 and min(got.values()) > 0.7
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    table.write.parquet(src)
    stream = spark.readStream.schema(table.schema).parquet(src)
    score_stream(p, stream, KEYS, out, str(tmp_path / "ck")).awaitTermination()
    batch = p.predict(table, KEYS)
    assert spark.read.parquet(out).exceptAll(batch).isEmpty()


def test_missing_targets(table):
    gaps = table.withColumn("v", F.when(F.col("cents") % 5 != 0, F.col("v")))
    with pytest.raises(TargetError):
        TablePredictor(models=["Ridge"]).fit(gaps, "v", KEYS, features=FEATURES)
    p = TablePredictor(models=["Ridge"], max_points=1, drop_missing_target=True).fit(gaps, "v", KEYS, features=FEATURES)
    assert p.best.model == "Ridge"


def test_ties_keep_the_earlier_model():
    rs = [ModelResult("a", 0, {}, 0.5), ModelResult("b", 1, {}, 0.5), ModelResult("n", 2, {}, float("nan"))]
    assert choose(rs).model == "a"


def test_a_bad_dataset_does_not_stop_the_others(spark, tmp_path):
    def put(name, ext, text):
        f = tmp_path / name / f"{name}.{ext}"
        f.parent.mkdir(exist_ok=True)
        f.write_text(text)

    put("good", "data", "".join(f"{i % 7} {i % 5} {'ab'[i % 2]}\n" for i in range(60)))
    put("good", "solution", "".join(f"{int(i % 7 > 3)}\n" for i in range(60)))
    put("good", "type", "Numerical\nNumerical\nCategorical\n")
    put("bad", "data", "1 2\n3 4\n")
    put("bad", "solution", "1\n")
    done = fit(spark, str(tmp_path), models=["GaussianNB", "LDA"], max_points=1)
    assert list(done.predictors) == ["good"] and "RowMismatchError" in done.errors["bad"]
    assert evaluate(done).count() == 2


def test_the_budget_cancels_running_jobs(spark):
    import time

    from pyspark.sql import functions as F

    from tablewright.functions.roles import Roles
    from tablewright.plans.roster import Candidate
    from tablewright.plans.search import TrainingTable, search

    slow = F.udf(lambda x: time.sleep(0.05) or float(x), "double")
    df = spark.range(4000).repartition(8).select(F.col("id"), (F.col("id") % 3).cast("int").alias("fold"), (F.col("id") % 2).cast("double").alias("y"), (F.col("id") % 7).cast("double").alias("a"))
    t = TrainingTable(df, "classification", 2, 3, Roles(("a",)), None, {"id": "bigint"})
    t.rows.unpersist()
    t.rows = t.rows.withColumn("y", slow("y"))  # every pass takes some 25 s
    began = time.monotonic()
    got = search(t, [Candidate("GaussianNB", {"var_smoothing": [1e-9]}), Candidate("DecisionTree", {"max_depth": [2]})], budget=1)
    assert time.monotonic() - began < 15
    assert all(not r.ok and r.error.startswith("DeadlineError") for r in got)
    time.sleep(0.5)
    assert not spark.sparkContext.statusTracker().getActiveJobsIds()


def test_too_many_labels_are_no_classes(spark):
    from tablewright.errors import TargetError
    from tablewright.plans.predictor import class_list

    with pytest.raises(TargetError):
        class_list(spark.range(20), "id", 10)
    assert class_list(spark.range(3), "id", 10) == [0, 1, 2]

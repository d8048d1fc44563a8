"""Classification and regression metrics as aggregates over (truth, prediction).

Everything about classes derives from one ``groupBy(truth, prediction)`` count;
that table has at most classes² rows and is the only thing ever shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablewright.session import materialize, pinned

MAX_REPORT_CLASSES = 10
MAX_SQUARE_CLASSES = 1000  # of a matrix with its zeros


def pair_counts(df: DataFrame, truth: str = "y", pred: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """``by`` columns keep several predictions apart, for example one per model."""
    return df.groupBy(*by, F.col(truth).alias("actual"), F.col(pred).alias("predicted")).agg(F.count("*").alias("n"))


def confusion_cells(df: DataFrame, truth: str = "y", pred: str = "p") -> DataFrame:
    """The confusion matrix without its zeros, for any number of labels: ``actual, predicted, n, n_actual, n_predicted``.

    The last two are the totals of the cell's row and column; they are summed per
    label from the counts, so no label's cells meet in one task.
    """
    counts = pair_counts(df, truth, pred)
    rows = counts.groupBy("actual").agg(F.sum("n").alias("n_actual"))
    columns = counts.groupBy("predicted").agg(F.sum("n").alias("n_predicted"))
    # null labels count as a label
    cells = counts.alias("c").join(rows.alias("r"), F.col("c.actual").eqNullSafe(F.col("r.actual"))).join(
        columns.alias("p"), F.col("c.predicted").eqNullSafe(F.col("p.predicted")))
    return cells.select("c.actual", "c.predicted", "n", "n_actual", "n_predicted")


def confusion_matrix(df: DataFrame, truth: str = "y", pred: str = "p") -> DataFrame:
    """``actual, predicted, n`` over every pair of the label union, zeros included.

    More than ``MAX_SQUARE_CLASSES`` labels are an error; ``confusion_cells`` takes any number.
    """
    counts = pair_counts(df, truth, pred)
    labels = counts.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct().limit(MAX_SQUARE_CLASSES + 1)
    # the label set as one array of bounded size; pairs come from exploding it twice, with no join
    found = F.array_sort(F.collect_set("label"))
    too_many = F.raise_error(F.lit(f"more than {MAX_SQUARE_CLASSES} labels: confusion_cells gives their counts without zeros"))
    square = (
        labels.agg(F.when(F.count(F.lit(1)) > MAX_SQUARE_CLASSES, too_many).otherwise(found).alias("ls"))
        .select(F.explode("ls").alias("actual"), "ls")
        .select("actual", F.explode("ls").alias("predicted"))
    )
    return square.join(counts, ["actual", "predicted"], "left").select(
        "actual", "predicted", F.coalesce("n", F.lit(0)).cast("bigint").alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def per_class(df: DataFrame, truth: str = "y", pred: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """``label, tp, support, predicted, precision, recall, f1`` over the label union."""
    counts = pair_counts(df, truth, pred, by)
    sides = counts.select(
        *by,
        F.explode(
            F.array(
                F.struct(
                    F.col("actual").alias("label"),
                    F.col("n").alias("as_truth"),
                    F.lit(0).cast("bigint").alias("as_pred"),
                    F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("hit"),
                ),
                F.struct(
                    F.col("predicted").alias("label"),
                    F.lit(0).cast("bigint").alias("as_truth"),
                    F.col("n").alias("as_pred"),
                    F.lit(0).cast("bigint").alias("hit"),
                ),
            )
        ).alias("s")
    ).select(*by, "s.*")
    c = sides.groupBy(*by, "label").agg(
        F.sum("hit").alias("tp"), F.sum("as_truth").alias("support"), F.sum("as_pred").alias("predicted")
    )
    return c.select(
        *by,
        "label",
        "tp",
        "support",
        "predicted",
        _ratio(F.col("tp"), F.col("predicted")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
        # 2PR/(P+R) written over counts, so no division by zero can occur
        _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")).alias("f1"),
    )


def _averaged(metric: str, average: str) -> Column:
    total = F.sum("support")
    if average == "weighted":
        return _ratio(F.sum(F.col(metric) * F.col("support")), total)
    if average == "macro":
        return F.avg(metric)
    if average == "micro":
        return _ratio(F.sum("tp"), total)
    raise ValueError(f"unknown average {average}")


def classification_metrics(df: DataFrame, truth: str = "y", pred: str = "p", proba: str | None = None,
                           average: str = "weighted", by: Sequence[str] = ()) -> DataFrame:
    """One row of metrics (per ``by`` group); ``roc_auc`` is added for a binary target with scores."""
    out = per_class(df, truth, pred, by).groupBy(*by).agg(
        F.sum("support").alias("n"),
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"),
        _averaged("precision", average).alias("precision"),
        _averaged("recall", average).alias("recall"),
        _averaged("f1", average).alias("f1_weighted"),
        F.avg("f1").alias("f1_macro"),
        F.count_if(F.col("support") > 0).alias("n_classes"),
    )
    if proba is None:
        return out
    auc = roc_auc(df, truth, proba)
    return out.withColumn("k", F.lit(1)).join(auc.withColumn("k", F.lit(1)), "k", "left").drop("k")


def class_report(df: DataFrame, truth: str = "y", pred: str = "p") -> DataFrame:
    """Per-class rows plus accuracy, macro and weighted rows; empty above ten true classes."""
    by_class = per_class(df, truth, pred)
    rows = by_class.select(
        F.col("label").cast("string").alias("row"), "precision", "recall", "f1", F.col("support").cast("bigint").alias("support"),
        F.count_if(F.col("support") > 0).over(W.partitionBy()).alias("n_true"),
    )
    acc = _ratio(F.sum("tp"), F.sum("support"))
    n_true = F.count_if(F.col("support") > 0).alias("n_true")
    total = F.sum("support").cast("bigint").alias("support")
    summary = by_class.agg(
        F.array(
            F.struct(F.lit("accuracy").alias("row"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1")),
            F.struct(F.lit("macro avg").alias("row"), *[_averaged(m, "macro").alias(m) for m in ("precision", "recall", "f1")]),
            F.struct(F.lit("weighted avg").alias("row"), *[_averaged(m, "weighted").alias(m) for m in ("precision", "recall", "f1")]),
        ).alias("s"),
        total,
        n_true,
    ).select(F.inline("s"), "support", "n_true")
    return (
        rows.unionByName(summary.select("row", "precision", "recall", "f1", "support", "n_true"))
        .where(F.col("n_true") <= MAX_REPORT_CLASSES)
        .drop("n_true")
    )


def score_groups(df: DataFrame, truth: str, score: str) -> DataFrame:
    """``score, pos, neg`` per distinct score."""
    return df.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(F.col(truth).cast("bigint")).alias("pos"),
        F.sum(1 - F.col(truth).cast("bigint")).alias("neg"),
    )


def score_ranges(groups: DataFrame, ranges: int = 4096) -> DataFrame:
    """Adds ``b``, the number of the score's range, growing with the score.

    The ranges hold about equally many distinct scores.
    """
    at = [i / ranges for i in range(1, ranges)]
    q = groups.agg(F.percentile_approx("score", at, 100_000).alias("q")).first()["q"] or []
    bounds = [float("-inf"), *sorted({float(v) for v in q if abs(float(v)) != float("inf")}), float("inf")]
    if len(bounds) < 3:
        return groups.withColumn("b", F.lit(0.0))
    return Bucketizer(splits=bounds, inputCol="score", outputCol="b", handleInvalid="keep").transform(groups)


def roc_auc(df: DataFrame, truth: str, score: str) -> DataFrame:
    """Exact area under the ROC curve (ties count one half).

    The prefix sum over scores runs in two levels: totals per score range first,
    then inside each range, so no task ever sorts all distinct scores.
    Only 0/1 truths with both classes present give a value.
    """
    groups = materialize(score_groups(df, truth, score), "scores")  # three uses
    located = score_ranges(groups)
    per_range = located.groupBy("b").agg(F.sum("neg").alias("bneg"))
    before = W.orderBy("b").rowsBetween(W.unboundedPreceding, -1)
    # one row per range, 4096 at most
    below = pinned(per_range.select("b", F.coalesce(F.sum("bneg").over(before), F.lit(0)).alias("neg_below")))
    inside = W.partitionBy("b").orderBy("score").rowsBetween(W.unboundedPreceding, -1)
    ranked = located.join(F.broadcast(below), "b").select(
        "pos",
        "neg",
        (F.col("neg_below") + F.coalesce(F.sum("neg").over(inside), F.lit(0))).alias("smaller"),
    )
    wins = F.sum(F.col("pos") * (F.col("smaller") + F.col("neg") / 2))
    return ranked.agg(F.try_divide(wins, F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def regression_metrics(df: DataFrame, truth: str = "y", pred: str = "p", by: Sequence[str] = ()) -> DataFrame:
    """One row (per ``by`` group); ``mape`` is null unless every truth and prediction is positive."""
    y, p = F.col(truth).cast("double"), F.col(pred).cast("double")
    r = y - p
    agg = df.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.avg(r * r).alias("mse"),
        F.avg(F.abs(r)).alias("mae"),
        F.when(
            (F.min(y) > 0) & (F.min(p) > 0), F.avg(F.abs(F.try_divide(r, y))) * 100
        ).alias("mape"),
        F.var_pop(y).alias("var_y"),
        F.var_pop(r).alias("var_r"),
        F.max(F.abs(r)).alias("max_error"),
        F.avg(y).alias("y_true_mean"),
        F.stddev_pop(y).alias("y_true_std"),
        F.avg(p).alias("y_pred_mean"),
        F.stddev_pop(p).alias("y_pred_std"),
        F.avg(r).alias("residual_mean"),
        F.stddev_pop(r).alias("residual_std"),
    )

    def explained(lost: Column) -> Column:
        """1 - lost/var(y); a constant truth scores 1 when nothing is lost, else 0."""
        return F.when(F.col("var_y") > 0, 1 - F.try_divide(lost, F.col("var_y"))).otherwise(
            F.when(lost == 0, 1.0).otherwise(0.0)
        )

    return agg.select(
        *by,
        "n",
        "mse",
        F.sqrt("mse").alias("rmse"),
        "mae",
        "mape",
        explained(F.col("mse")).alias("r2"),
        explained(F.col("var_r")).alias("explained_variance"),
        "max_error",
        "y_true_mean",
        "y_true_std",
        "y_pred_mean",
        "y_pred_std",
        "residual_mean",
        "residual_std",
    )

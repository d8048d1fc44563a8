"""Metrics over (truth, prediction) tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablewright.catalog.common import Registry, table
from tablewright.operators.metrics import (
    class_report,
    classification_metrics,
    confusion_cells,
    confusion_matrix,
    per_class,
    regression_metrics,
    roc_auc,
)
from tablewright.operators.profile import class_count_map, class_counts

reg = Registry()

PRED = "case when l_tax = 0.08 then 'X' when l_quantity < 17 then 'A' when l_quantity < 34 then 'N' else 'R' end"
BASE = f"""b as (select l_returnflag as y, {PRED} as p from lineitem),
labels as (select y as label from b union select p from b),
k as (select label, (select count(*) from b where y = label and p = label) tp, (select count(*) from b where y = label) support,
  (select count(*) from b where p = label) predicted from labels),
s as (select *, case when predicted = 0 then 0 else tp / predicted end as pr, case when support = 0 then 0 else tp / support end as rc,
  case when support + predicted = 0 then 0 else 2 * tp / (support + predicted) end as f1 from k)"""
VALUES = """v as (select l_extendedprice as y, l_quantity * 1500 + 100 * l_tax + 1 as p from lineitem),
e as (select *, y - p as r from v)"""


def _classes(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("y"), F.expr(PRED).alias("p"))


def _values(spark, sf):
    return table(spark, sf, "lineitem").select(F.col("l_extendedprice").alias("y"), F.expr("l_quantity * 1500 + 100 * l_tax + 1").alias("p"))


def _metric(name, column, expression):
    @reg(name, f"with {BASE} select round({expression}, 9)::double as {column} from s")
    def run(spark, sf):
        return classification_metrics(_classes(spark, sf)).select(F.round(column, 9).alias(column))


_metric("i01_accuracy", "accuracy", "sum(tp) / sum(support)")
_metric("i02_precision", "precision", "sum(pr * support) / sum(support)")
_metric("i03_recall", "recall", "sum(rc * support) / sum(support)")
_metric("i04_f1_weighted", "f1_weighted", "sum(f1 * support) / sum(support)")
_metric("i05_f1_macro", "f1_macro", "avg(f1)")


@reg("i02_precision_macro_micro", f"""with {BASE}
select 'macro' as average, round(avg(pr), 9) as precision, round(avg(rc), 9) as recall, round(avg(f1), 9) as f1 from s
union all select 'micro', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9) from s""")
def other_averages(spark, sf):
    parts = [
        classification_metrics(_classes(spark, sf), average=a).select(
            F.lit(a).alias("average"), F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"),
            F.round("f1_weighted", 9).alias("f1"),
        )
        for a in ("macro", "micro")
    ]
    return parts[0].unionByName(parts[1])


@reg("i06_class_count", "select count(distinct l_returnflag) as n_classes from lineitem")
def class_count(spark, sf):
    return classification_metrics(_classes(spark, sf)).select("n_classes")


@reg("i07_class_distribution", "select l_returnflag as label, count(*) as n from lineitem group by 1")
def class_distribution(spark, sf):
    m = class_count_map(_classes(spark, sf), "y")
    return m.select(F.explode("class_distribution").alias("label", "n"))


@reg("i08_roc_auc", """
with b as (select (l_quantity > 25)::int as y, round(l_quantity * (1 - l_discount * 8), 0) as s from lineitem),
g as (select s, sum(y) pos, sum(1 - y) neg from b group by s),
c as (select pos, neg, coalesce(sum(neg) over (order by s rows between unbounded preceding and 1 preceding), 0) below from g)
select round((sum(pos * (below + neg / 2)) / (sum(pos)::double * sum(neg)::double))::double, 9) as roc_auc from c""")
def auc(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.expr("cast(l_quantity > 25 as int)").alias("y"), F.expr("round(l_quantity * (1 - l_discount * 8), 0)").alias("s")
    )
    return roc_auc(df, "y", "s").select(F.round("roc_auc", 9).alias("roc_auc"))


@reg("i09_confusion_matrix", f"""with {BASE}
select a.label as actual, p.label as predicted, (select count(*) from b where b.y = a.label and b.p = p.label) as n
from labels a, labels p""")
def confusion(spark, sf):
    return confusion_matrix(_classes(spark, sf))


@reg("i09_confusion_cells", f"""with {BASE}
select y as actual, p as predicted, count(*) as n, (sum(count(*)) over (partition by y))::bigint as n_actual,
  (sum(count(*)) over (partition by p))::bigint as n_predicted from b group by y, p""")
def confusion_sparse(spark, sf):
    return confusion_cells(_classes(spark, sf))


@reg("i10_class_report", f"""with {BASE}
select label as "row", round(pr, 9) as precision, round(rc, 9) as recall, round(f1, 9) as f1, support from s
union all select 'accuracy', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9), sum(support)::bigint from s
union all select 'macro avg', round(avg(pr), 9), round(avg(rc), 9), round(avg(f1), 9), sum(support)::bigint from s
union all select 'weighted avg', round(sum(pr * support) / sum(support), 9), round(sum(rc * support) / sum(support), 9),
  round(sum(f1 * support) / sum(support), 9), sum(support)::bigint from s""")
def report(spark, sf):
    r = class_report(_classes(spark, sf))
    return r.select("row", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@reg("i10_class_counts_per_side", f"with {BASE} select label, tp, support, predicted from s")
def sides(spark, sf):
    return per_class(_classes(spark, sf)).select("label", "tp", "support", "predicted")


def _value(name, columns, digits=4):
    body = ", ".join(f"round({sql}, {digits})::double as {c}" for c, sql in columns.items())

    @reg(name, f"with {VALUES} select {body} from e")
    def run(spark, sf):
        return regression_metrics(_values(spark, sf)).select(*[F.round(c, digits).alias(c) for c in columns])


_value("i11_mse_rmse", {"mse": "avg(r * r)", "rmse": "sqrt(avg(r * r))"}, 2)
_value("i12_mae", {"mae": "avg(abs(r))"})
_value("i13_mape", {"mape": "case when min(y) > 0 and min(p) > 0 then 100 * avg(abs(r / y)) end"}, 6)
_value("i14_r2", {"r2": "1 - avg(r * r) / var_pop(y)"}, 8)
_value("i15_explained_variance", {"explained_variance": "1 - var_pop(r) / var_pop(y)"}, 8)
_value("i16_max_error", {"max_error": "max(abs(r))"})
_value("i17_target_statistics", {"y_true_mean": "avg(y)", "y_true_std": "stddev_pop(y)", "y_pred_mean": "avg(p)",
                                 "y_pred_std": "stddev_pop(p)"})
_value("i18_residual_statistics", {"residual_mean": "avg(r)", "residual_std": "stddev_pop(r)"})


@reg("i13_mape_not_positive", """
select o_orderstatus, case when min(y) > 0 and min(p) > 0 then round(100 * avg(abs((y - p) / nullif(y, 0))), 6) end as mape
from (select o_orderstatus, (o_custkey % case when o_orderstatus = 'P' then 3 else 9999999 end)::double as y,
  o_custkey + 1.0 as p from orders) group by 1""")
def mape_guard(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderstatus", F.expr("cast(o_custkey % case when o_orderstatus = 'P' then 3 else 9999999 end as double)").alias("y"),
        F.expr("o_custkey + 1.0D").alias("p"),
    )
    return regression_metrics(o, by=["o_orderstatus"]).select("o_orderstatus", F.round("mape", 6).alias("mape"))


@reg("i07_class_counts_of_documents", "select source as label, count(*) as n from documents group by 1")
def document_sources(spark, sf):
    return class_counts(table(spark, sf, "documents"), "source")


QUERIES, SQL = reg.queries, reg.sql

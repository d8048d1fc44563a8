"""Projections, predicates and target expressions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tablewright.catalog.common import LI, Registry, lineitem, table, with_gaps
from tablewright.functions.bands import percent_text, treatment_label
from tablewright.functions.labels import ambiguous_one_hot, first_argmax, sums_to_one, truncated_label
from tablewright.functions.roles import Roles, assign_roles, role_of
from tablewright.operators.design import TEST, dense_encoding, dense_rows
from tablewright.operators.prepare import fit_preparation
from tablewright.operators.profile import display_profile, valid_targets
from tablewright.operators.scoring import ARGMAX, LinearScorer, predict_rows
from tablewright.plans.predictor import no_rows, side_counts
from tablewright.sources.target import flat_target

reg = Registry()


@reg("b01_one_hot_label", """
select o_orderkey, case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end::bigint as label from orders""")
def one_hot_label(spark, sf):
    flags = F.array(*[(F.col("o_orderstatus") == s).cast("double") for s in ("F", "O", "P")])
    return table(spark, sf, "orders").select("o_orderkey", flags.alias("y")).where(sums_to_one(F.col("y"))).select(
        "o_orderkey", first_argmax(F.col("y")).alias("label")
    )


@reg("b02_multi_column_label", """
select case when a >= b and a >= c then 0 when b >= c then 1 else 2 end::bigint as label, count(*) as n,
  sum(case when (a = greatest(a, b, c))::int + (b = greatest(a, b, c))::int + (c = greatest(a, b, c))::int > 1 then 1 else 0 end)::bigint as n_ambiguous
from (select (l_quantity % 2)::double a, (l_linenumber % 2)::double b, (l_orderkey % 2)::double c from lineitem) group by 1""")
def multi_column_label(spark, sf):
    y = F.array((F.col("l_quantity") % 2), (F.col("l_linenumber") % 2).cast("double"), (F.col("l_orderkey") % 2).cast("double"))
    return table(spark, sf, "lineitem").select(y.alias("y")).groupBy(first_argmax(F.col("y")).alias("label")).agg(
        F.count("*").alias("n"), F.count_if(ambiguous_one_hot(F.col("y"))).alias("n_ambiguous")
    )


@reg("b03_flatten_target", "select o_orderkey, o_totalprice as y from orders")
def flatten_target(spark, sf):
    return flat_target(table(spark, sf, "orders").select("o_orderkey", F.array("o_totalprice").alias("y")))


@reg("b04_target_cast", """
select trunc(c_acctbal)::bigint as label, count(*) as n, round(sum(c_acctbal), 4) as total from customer group by 1""")
def target_cast(spark, sf):
    y = F.col("c_acctbal")
    return table(spark, sf, "customer").groupBy(truncated_label(y).alias("label")).agg(
        F.count("*").alias("n"), F.round(F.sum(y.cast("double")), 4).alias("total")
    )


@reg("b05_role_selection", """
select case when p_type like '%Numerical%' or lower(p_type) like '%numeric%' then 'numerical'
  when lower(p_type) like '%categorical%' then 'categorical' else 'other' end as role, count(*) as n
from (select case when p_partkey % 4 = 0 then 'Numerical' when p_partkey % 4 = 1 then 'numeric_' || p_brand
  when p_partkey % 4 = 2 then 'Categorical' else p_type end as p_type from part) group by 1""")
def role_selection(spark, sf):
    k = F.col("p_partkey") % 4
    t = F.when(k == 0, "Numerical").when(k == 1, F.concat(F.lit("numeric_"), "p_brand")).when(k == 2, "Categorical").otherwise(F.col("p_type"))
    return table(spark, sf, "part").select(t.alias("type")).groupBy(role_of(F.col("type")).alias("role")).agg(F.count("*").alias("n"))


@reg("b06_passthrough_order", """
with s as (select avg(l_quantity) m, stddev_pop(l_quantity) sd from lineitem)
select round(sum((l_quantity - m) / sd * l_linenumber), 4) as s_num, sum((l_linestatus = 'F')::int)::double as s_f,
  sum((l_linestatus = 'O')::int)::double as s_o, sum(l_linenumber)::double as s_rest, 4::bigint as width
from lineitem, s""")
def passthrough_order(spark, sf):
    li = table(spark, sf, "lineitem").select("l_linenumber", "l_linestatus", "l_quantity")
    roles = assign_roles(li.columns, ["something", "Categorical", "Numerical"])
    out = fit_preparation(li, roles).columns(li)
    num, f, o, rest = out.columns
    return out.agg(
        F.round(F.sum(F.col(num) * F.col(rest)), 4).alias("s_num"),
        F.sum(F.col(f"`{f}`")).alias("s_f"),
        F.sum(F.col(f"`{o}`")).alias("s_o"),
        F.sum(F.col(rest).cast("double")).alias("s_rest"),
        F.lit(len(out.columns)).cast("bigint").alias("width"),
    )


@reg("b07_valid_targets", f"""with {LI}
select l_returnflag, count(*) as n, round(sum(x_discount), 4) as total from li where x_discount is not null group by 1""")
def valid(spark, sf):
    li = with_gaps(lineitem(spark, sf)).withColumn("y", F.coalesce("x_discount", F.lit(float("nan"))))
    return valid_targets(li, "y").groupBy("l_returnflag").agg(F.count("*").alias("n"), F.round(F.sum("y"), 4).alias("total"))


@reg("b08_empty_input", """
select event_type, count(*) filter (value > 1e12) = 0 as empty_side, count(*) = 0 as empty_all from events group by 1""")
def empty_input(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        no_rows(F.col("value") > 1e12).alias("empty_side"), no_rows().alias("empty_all")
    )


@reg("b09_row_mismatch", """
select count(*) filter (l.doc_id is null) as only_features, count(*) filter (d.doc_id is null) as only_target,
  count(*) filter (l.doc_id is not null and d.doc_id is not null) as both_sides
from documents d full outer join labels l on d.doc_id = l.doc_id""")
def row_mismatch(spark, sf):
    return side_counts(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


@reg("b10_treatment_label", """
select case when p_size % 3 = 0 then 'Sparse (MaxAbsScaler)' when p_size % 5 > 0 then 'Mixte (Numerical + Categorical)'
  else 'Numerical standard' end as treatment, count(*) as n from part group by 1""")
def treatment(spark, sf):
    label = treatment_label(F.col("p_size") % 3 == 0, F.col("p_size") % 5)
    return table(spark, sf, "part").groupBy(label.alias("treatment")).agg(F.count("*").alias("n"))


@reg("b11_display_columns", """
select c_mktsegment as "Dataset", count(*) as n_samples, 2::bigint as n_features,
  printf('%.2f%%', sum((c_nationkey = 0)::int) / (2 * count(*)) * 100) as "Sparsité", '0.0%' as "Missing",
  count(distinct c_nationkey)::varchar as n_classes, 'high' as "Imbalance", 'Numerical standard' as "Pipeline Type"
from customer group by 1""")
def display_columns(spark, sf):
    p = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("dataset")).agg(
        F.lit("classification").alias("task"), F.count("*").alias("n_samples"), F.lit(2).cast("bigint").alias("n_features"),
        (F.count_if(F.col("c_nationkey") == 0) / (2 * F.count("*"))).alias("sparsity"), F.lit(0.0).alias("missing"),
        F.count_distinct("c_nationkey").alias("n_classes"), F.lit("high").alias("imbalance_level"),
        F.lit(False).alias("is_sparse"), F.lit(0).alias("n_categorical"),
    )
    return display_profile(p)


@reg("b12_percent_format", """
select p_brand, printf('%.1f%%', sum((p_size > 25)::int) / count(*) * 100) as share,
  round(100.0 * sum((p_size > 25)::int) / count(*), 2) as share_pct from part group by 1""")
def percent_format(spark, sf):
    share = F.count_if(F.col("p_size") > 25) / F.count("*")
    return table(spark, sf, "part").groupBy("p_brand").agg(share.alias("s")).select(
        "p_brand", percent_text(F.col("s"), 1).alias("share"), F.round(F.col("s") * 100, 2).alias("share_pct")
    )


@reg("c02_prediction_truth", f"""with {LI}
select l_returnflag as y, case when l_quantity < 17 then 'A' when l_quantity < 34 then 'N' else 'R' end as p, count(*) as n
from li group by 1, 2""")
def prediction_truth(spark, sf):
    """A linear model of known weights: N passes A above 16.5, R passes N above 33.5."""
    li = lineitem(spark, sf).withColumn("fold", F.lit(TEST)).withColumn("y", F.lit(0.0))
    enc = dense_encoding(li, Roles(("l_quantity",)))
    per_unit = np.array([0.0, 1.0, 2.0])
    scorer = LinearScorer(np.stack([np.array([0.0, -16.5, -50.0]) + per_unit * enc.shifts[0], per_unit * enc.scales[0]]), ARGMAX)
    p = predict_rows(dense_rows(li, enc, "y", "fold", ["l_returnflag"]), enc, scorer, {"l_returnflag": "string"})
    label = F.get(F.array(F.lit("A"), F.lit("N"), F.lit("R")), F.col("p").cast("int"))
    return p.groupBy(F.col("l_returnflag").alias("y"), label.alias("p")).agg(F.count("*").alias("n"))


QUERIES, SQL = reg.queries, reg.sql

"""Profiling aggregates and task inference."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tablewright.catalog.common import LI, Registry, lineitem, table, with_gaps
from tablewright.operators.inference import infer_task_tables
from tablewright.operators.profile import (
    class_balance,
    class_counts,
    dataset_profile,
    dense_shape,
    global_statistics,
    preparation_summary,
    sparse_shape,
    treatment_distribution,
)
from tablewright.session import spread

reg = Registry()
NUMBERS = ["l_quantity", "l_extendedprice", "x_discount", "l_tax"]


def _gaps(spark, sf):
    return with_gaps(lineitem(spark, sf))


CELLS = "array<struct<idx:int,val:double>>"
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def term_rows(spark, sf):
    """Documents as sparse rows: counts of words by first letter (26 columns)."""
    d = spread(table(spark, sf, "documents").select("doc_id", "lang", "text"))
    # first letters of the words, then how much shorter the string is without a letter; nothing is shuffled
    firsts = d.select("doc_id", "lang", F.regexp_replace(F.lower("text"), "[^a-z]*+([a-z]?+)[a-z]*+", "$1").alias("s"))
    n = [F.length("s") - F.length(F.replace("s", F.lit(c), F.lit(""))) for c in LETTERS]
    every = F.array(*[F.struct(F.lit(i).alias("idx"), x.cast("double").alias("val")) for i, x in enumerate(n)])
    cells = firsts.select("doc_id", "lang", F.filter(F.when(F.col("s").isNotNull(), every).otherwise(F.array().cast(CELLS)), lambda c: c["val"] > 0).alias("c"))
    return cells.select("doc_id", "lang", F.transform("c", lambda s: s["idx"]).alias("indices"), F.transform("c", lambda s: s["val"]).alias("values"))


TERMS = """
words as (select doc_id, lang, unnest(string_split_regex(lower(text), '[^a-z]+')) as w from documents),
cells as (select doc_id, lang, ascii(substr(w, 1, 1)) - 97 as idx, count(*)::double as val from words
  where w <> '' and ascii(substr(w, 1, 1)) between 97 and 122 group by 1, 2, 3)"""


@reg("d01_shape", "select count(*) as n_samples, 4::bigint as n_features from lineitem")
def shape(spark, sf):
    return dense_shape(_gaps(spark, sf), NUMBERS).select("n_samples", "n_features")


@reg("d02_sparsity", f"""with {LI}, {TERMS}
select 'dense' as kind, round((sum((l_quantity = 0)::int) + sum((l_extendedprice = 0)::int) + sum(coalesce(x_discount = 0, false)::int)
  + sum((l_tax = 0)::int))::double / (4 * count(*)), 9) as sparsity from li
union all
select 'sparse', round(1 - (select count(*) from cells)::double / ((select count(*) from documents) * 26), 9)""")
def sparsity(spark, sf):
    a = dense_shape(_gaps(spark, sf), NUMBERS).select(F.lit("dense").alias("kind"), F.round("sparsity", 9).alias("sparsity"))
    b = sparse_shape(term_rows(spark, sf), 26).select(F.lit("sparse").alias("kind"), F.round("sparsity", 9).alias("sparsity"))
    return a.unionByName(b)


@reg("d03_density", f"""with {TERMS}
select round((select count(*) from cells)::double / ((select count(*) from documents) * 26), 9) as density""")
def density(spark, sf):
    return sparse_shape(term_rows(spark, sf), 26).select(F.round("density", 9).alias("density"))


@reg("d04_missing_fraction", f"""with {LI}
select round(sum((x_discount is null)::int)::double / (4 * count(*)), 9) as missing from li""")
def missing(spark, sf):
    return dense_shape(_gaps(spark, sf), NUMBERS).select(F.round("missing", 9).alias("missing"))


@reg("d05_class_number", f"with {LI} select count(distinct x_status) as n_classes from li")
def class_number(spark, sf):
    return class_balance(_gaps(spark, sf), "x_status").select("n_classes")


@reg("d06_class_counts", "select lang as label, count(*) as n from documents group by lang")
def counts(spark, sf):
    return class_counts(table(spark, sf, "documents"), "lang")


def _level_sql(source: str, y: str, name: str) -> str:
    return f"""select '{name}' as source, count(*) as n_classes, round(max(n)::double / min(n), 6) as imbalance_ratio,
  case when max(n)::double / min(n) < 1.5 then 'balanced' when max(n)::double / min(n) < 3 then 'moderate'
  when max(n)::double / min(n) < 10 then 'high' else 'very high' end as imbalance_level
  from (select {y} as y, count(*) n from {source} group by 1)"""


SOURCES = (("documents", "lang"), ("labels", "quality"), ("labels", "toxic"), ("lineitem", "l_returnflag"),
           ("events", "event_type"))


@reg("d07_imbalance_level", " union all ".join(_level_sql(s, y, y) for s, y in SOURCES))
def imbalance(spark, sf):
    parts = [
        class_balance(table(spark, sf, s), y).select(
            F.lit(y).alias("source"), "n_classes", F.round("imbalance_ratio", 6).alias("imbalance_ratio"), "imbalance_level"
        )
        for s, y in SOURCES
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@reg("d08_normalised_imbalance", " union all ".join(
    f"select '{y}' as source, round(1 - min(n)::double / max(n), 9) as imbalance from (select {y} as y, count(*) n from {s} group by 1)"
    for s, y in SOURCES))
def normalised(spark, sf):
    parts = [
        class_balance(table(spark, sf, s), y).select(F.lit(y).alias("source"), F.round("imbalance", 9).alias("imbalance"))
        for s, y in SOURCES
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


TARGETS = (("l_linenumber", True), ("l_quantity", False), ("l_discount", False), ("l_tax", False),
           ("l_extendedprice", False), ("l_suppkey", True), ("x_discount", False))


def _task_sql(rule: str) -> str:
    parts = []
    for y, integer in TARGETS:
        if rule == "main":
            case = f"""case when n = miss then 'regression' when k + (miss > 0)::int < 10 then 'classification'
  when {str(integer).lower()} and miss = 0 and k + (miss > 0)::int < 50 then 'classification'
  when {str(integer).lower()} and miss = 0 and high - low + 1 = k and low >= 0 and high < 100 then 'classification'
  when whole and miss = 0 and k < 20 then 'classification' else 'regression' end"""
        elif rule == "simple":
            case = "case when n = miss then 'regression' when k <= 20 then 'classification' else 'regression' end"
        else:
            case = "case when n = miss then 'regression' when k <= 20 and whole then 'classification' else 'regression' end"
        parts.append(f"""select '{y}' as target, k as n_distinct, {case} as task from (
  select count(*) n, count(*) filter ({y} is null) miss, count(distinct {y}) k, bool_and({y} % 1 = 0) whole,
  min({y}) low, max({y}) high from li)""")
    return f"with {LI} " + " union all ".join(parts)


def _tasks(rule):
    def run(spark, sf):
        return infer_task_tables(_gaps(spark, sf), dict(TARGETS), rule).select("target", "n_distinct", "task")

    return run


for _id, _rule in (("d09_task_main_rule", "main"), ("d10_task_simple_rule", "simple"), ("d11_task_strict_rule", "strict")):
    reg(_id, _task_sql(_rule))(_tasks(_rule))


def _profiles(spark, sf):
    li = _gaps(spark, sf)
    parts = [
        dataset_profile(li, "lineitem", NUMBERS, "l_returnflag", "classification", 1),
        dataset_profile(table(spark, sf, "part"), "part", ["p_size", "p_retailprice"], "p_size", "regression"),
        dataset_profile(term_rows(spark, sf), "documents", [], "lang", "classification", 0, True, 26),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@reg("d12_global_statistics", """
select (select count(*) from lineitem) + (select count(*) from part) + (select count(*) from documents) as total_samples,
  round((4 + 2 + 26) / 3.0, 6)::double as avg_features, 2::bigint as n_classification, 1::bigint as n_regression""")
def global_stats(spark, sf):
    return global_statistics(_profiles(spark, sf)).withColumn("avg_features", F.round("avg_features", 6))


@reg("d13_treatment_distribution", """
select treatment, count(*) as n_datasets from (
  select 'Mixte (Numerical + Categorical)' as treatment where (select count(*) from lineitem) > 0
  union all select 'Numerical standard' where (select count(*) from part) > 0
  union all select 'Sparse (MaxAbsScaler)' where (select count(*) from documents) > 0) group by 1""")
def treatments(spark, sf):
    return treatment_distribution(_profiles(spark, sf))


@reg("d14_preparation_summary", """
with t as (select p_brand as dataset, case p_partkey % 3 when 0 then 'Numerical' when 1 then 'Categorical' else p_type end as type from part),
c as (select dataset, count(*) n, sum((type = 'Numerical')::int) nn, sum((type = 'Categorical')::int) nc from t group by 1),
s as (select *, substr(dataset, length(dataset), 1) = '3' as is_sparse,
  case when substr(dataset, length(dataset), 1) = '4' then n + 1 else n end as d from c)
select dataset, case when is_sparse then 'sparse' else 'dense' end as data_type,
  case when is_sparse then null when d = n then nn else d end::bigint as numerical_features,
  case when not is_sparse and d = n then nc end::bigint as categorical_features,
  case when not is_sparse and d = n then n - nn - nc end::bigint as unknown_features,
  case when is_sparse then 'MaxAbsScaler only' else 'Imputation (mean) + StandardScaler' end as numerical_preprocessing,
  case when not is_sparse and d = n then 'Imputation (most frequent) + OneHotEncoder' end as categorical_preprocessing
from s""")
def summary(spark, sf):
    k = F.col("p_partkey") % 3
    types = table(spark, sf, "part").select(
        F.col("p_brand").alias("dataset"), F.when(k == 0, "Numerical").when(k == 1, "Categorical").otherwise(F.col("p_type")).alias("type")
    )
    last = F.expr("substr(dataset, length(dataset), 1)")
    shapes = types.groupBy("dataset").agg(F.count("*").alias("n")).select(
        "dataset", F.when(last == "4", F.col("n") + 1).otherwise(F.col("n")).alias("n_features"), (last == "3").alias("is_sparse")
    )
    return preparation_summary(types, shapes)


QUERIES, SQL = reg.queries, reg.sql

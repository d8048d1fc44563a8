"""Feature preparation, feature selection, splits and folds."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, functions as F

from tablewright.catalog.common import KEY_SQL, KEYS, LI, Registry, hash_sql, lineitem, table, with_gaps
from tablewright.catalog.profile import TERMS, term_rows
from tablewright.functions.bands import fold_count
from tablewright.functions.roles import Roles, assign_roles
from tablewright.operators.prepare import (
    category_counts,
    fit_preparation,
    impute_mean,
    max_abs_scale,
    modes,
    scale_without_centering,
)
from tablewright.operators.select import anova_f, correlation_f, large_data_chain, sparse_anova_f, sparse_correlation_f, top_features
from tablewright.operators.split import assign_folds, holdout_split
from tablewright.session import ship, spread

reg = Registry()


def _gaps(spark, sf):
    return with_gaps(lineitem(spark, sf))


def _r(c, n=6):
    return F.round(c, n)


@reg("e01_mean_imputation", f"""with {LI}, m as (select avg(x_discount) m from li)
select l_returnflag, count(*) as n, round(sum(coalesce(x_discount, m)), 4) as total from li, m group by 1""")
def mean_imputation(spark, sf):
    out = impute_mean(_gaps(spark, sf), ["x_discount"], ["l_returnflag"])
    return out.groupBy("l_returnflag").agg(F.count("*").alias("n"), _r(F.sum("x_discount"), 4).alias("total"))


CATS = ["x_status", "l_returnflag", "l_linenumber"]


@reg("e02_mode_imputation", "with " + LI + ", c as (" + " union all ".join(
    f"select '{c}' as feature, {c}::varchar as v, count(*) n from li where {c} is not null group by 2" for c in CATS)
    + ") select feature, arg_min(v, (-n, v)) as mode from c group by 1")
def mode_imputation(spark, sf):
    m = modes(category_counts(_gaps(spark, sf), CATS))
    return m.select(F.get(F.array(*[F.lit(c) for c in CATS]), F.col("idx")).alias("feature"), "mode")


@reg("e03_standardisation", f"""with {LI},
s as (select avg(l_quantity) mq, stddev_pop(l_quantity) sq, avg(x_discount) md from li),
f as (select *, coalesce(x_discount, md) as filled from li, s), v as (select stddev_pop(filled) sd from f)
select l_returnflag, round(sum((l_quantity - mq) / sq), 4) as z_quantity, round(sum((filled - md) / sd * l_linenumber), 4) as z_discount,
  0.0::double as z_constant from f, v group by 1""")
def standardisation(spark, sf):
    li = _gaps(spark, sf).withColumn("one", F.lit(1.0))
    p = fit_preparation(li, Roles(("l_quantity", "x_discount", "one")))
    return li.groupBy("l_returnflag").agg(
        _r(F.sum(p.scaled("l_quantity")), 4).alias("z_quantity"),
        _r(F.sum(p.scaled("x_discount") * F.col("l_linenumber")), 4).alias("z_discount"),
        F.sum(p.scaled("one")).alias("z_constant"),
    )


@reg("e04_max_abs_scaling", f"""with {TERMS}
select doc_id as row_id, idx::int as idx, round(val / max(val) over (partition by idx), 9) as val from cells""")
def max_abs_scaling(spark, sf):
    cells = term_rows(spark, sf).select(F.col("doc_id").alias("row_id"), F.inline(F.arrays_zip("indices", "values")).alias("idx", "val"))
    return max_abs_scale(cells).select("row_id", "idx", _r(F.col("val"), 9).alias("val"))


@reg("e05_one_hot", f"""with {LI}
select l_returnflag, sum((l_returnflag = 'A')::int)::double as n_a, sum((l_returnflag = 'R')::int)::double as n_r,
  2::bigint as width from li group by 1""")
def one_hot(spark, sf):
    li = _gaps(spark, sf)
    p = fit_preparation(li.where("l_returnflag <> 'N'"), Roles((), ("l_returnflag",)))
    flags = p.one_hot("l_returnflag")
    return li.select("l_returnflag", *flags).groupBy("l_returnflag").agg(
        F.sum(F.col("`l_returnflag=A`")).alias("n_a"), F.sum(F.col("`l_returnflag=R`")).alias("n_r"),
        F.lit(len(flags)).cast("bigint").alias("width"),
    )


@reg("e06_composition", f"""with {LI},
s as (select avg(l_quantity) mq, stddev_pop(l_quantity) sq, avg(x_discount) md, mode(x_status) st from li),
f as (select *, coalesce(x_discount, md) as filled, coalesce(x_status, m.st2) as status from li, s,
  (select arg_min(x_status, (-n, x_status)) st2 from (select x_status, count(*) n from li where x_status is not null group by 1)) m),
v as (select stddev_pop(filled) sd from f)
select l_returnflag, round(sum((l_quantity - mq) / sq), 4) as c0, round(sum((filled - md) / sd), 4) as c1,
  sum((status = 'F')::int)::double as c2, sum((status = 'O')::int)::double as c3, sum(l_linenumber)::double as c4 from f, v group by 1""")
def composition(spark, sf):
    li = _gaps(spark, sf)
    roles = assign_roles(["l_quantity", "x_discount", "x_status", "l_linenumber"], ["Numerical", "Numerical", "Categorical", "id"])
    vec = fit_preparation(li, roles).vectors(li, ["l_returnflag"])
    s = vec.groupBy("l_returnflag").agg(vector_to_array(Summarizer.sum(F.col("features"))).alias("s"))
    return s.select("l_returnflag", *[_r(F.get("s", F.lit(i)), 4).alias(f"c{i}") for i in range(5)])


@reg("e07_default_branch", """
with s as (select avg(l_linenumber) m1, stddev_pop(l_linenumber) s1, avg(l_tax) m2, stddev_pop(l_tax) s2 from lineitem)
select l_returnflag, round(sum((l_linenumber - m1) / s1), 4) as z1, round(sum((l_tax - m2) / s2), 4) as z2 from lineitem, s group by 1""")
def default_branch(spark, sf):
    li = lineitem(spark, sf)
    p = fit_preparation(li, assign_roles(["l_linenumber", "l_tax"], ["a", "b"]))
    return li.groupBy("l_returnflag").agg(
        _r(F.sum(p.scaled("l_linenumber")), 4).alias("z1"), _r(F.sum(p.scaled("l_tax")), 4).alias("z2")
    )


NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


def _select_names(df):
    names = F.array(*[F.lit(c) for c in NUMS])
    return df.select(F.get(names, F.col("idx")).alias("feature"), _r(F.col("f"), 4).alias("f"))


CLS3 = "case when l_quantity + 200 * l_discount < 25 then 'low' when l_quantity + 200 * l_discount < 45 then 'mid' else 'top' end"


@reg("e08_top_features_anova", "with b as (" + " union all ".join(
    f"select '{c}' as feature, {CLS3} as y, count(*) n, avg({c}) m, var_pop({c}) v from lineitem group by 2" for c in NUMS) + """
), t as (select feature, sum(n) n, count(*) k, sum(n * m) / sum(n) g, sum(n * v) w from b group by 1)
select feature, round((sum(b.n * (b.m - t.g) * (b.m - t.g)) / (max(t.k) - 1)) / (max(t.w) / (max(t.n) - max(t.k))), 4)::double as f
from b join t using (feature) group by feature order by 2 desc limit 3""")
def top_anova(spark, sf):
    li = lineitem(spark, sf).withColumn("cls3", F.expr(CLS3))
    return _select_names(top_features(anova_f(li, NUMS, "cls3"), 3))


@reg("e09_top_features_correlation", "with b as (" + " union all ".join(
    f"select '{c}' as feature, count(*) n, corr({c}, 3 * l_quantity - 50 * l_discount + 0.001 * l_extendedprice) r from lineitem" for c in NUMS)
    + ") select feature, round(r * r / (1 - r * r) * (n - 2), 4)::double as f from b order by 2 desc limit 3")
def top_correlation(spark, sf):
    li = lineitem(spark, sf).withColumn("reg", F.expr("3 * l_quantity - 50 * l_discount + 0.001 * l_extendedprice"))
    return _select_names(top_features(correlation_f(li, NUMS, "reg"), 3))


WORDS_SQL = """
words as (select doc_id, lang, n_chars, unnest(string_split_regex(lower(text), '[^a-z]+')) as w from documents),
cells as (select doc_id, lang, n_chars, w, count(*)::double as val from words where w <> '' group by all)"""


def word_counts():
    """Words of lower-case texts in order, with their numbers of occurrences."""
    word = re.compile("[a-z]+")

    @F.arrow_udf("indices array<string>, values array<double>")
    def count(texts: pa.Array) -> pa.Array:
        found = [sorted(Counter(word.findall(t)).items()) if t else [] for t in texts.to_pylist()]
        ends = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
        words = pa.ListArray.from_arrays(ends, pa.array([w for f in found for w, _ in f], pa.string()))
        counts = pa.ListArray.from_arrays(ends, pa.array([n for f in found for _, n in f], pa.float64()))
        return pa.StructArray.from_arrays([words, counts], ["indices", "values"])

    return count


def _word_rows(spark, sf) -> DataFrame:
    """Documents as sparse rows: how often each whole word occurs."""
    d = spread(table(spark, sf, "documents").select("lang", "n_chars", "text"))
    ship(spark)
    c = d.select("lang", "n_chars", word_counts()(F.lower("text")).alias("c"))
    return c.select("lang", "n_chars", F.col("c.indices").alias("indices"), F.col("c.values").alias("values"))


@reg("e08_top_words_anova", f"""with {WORDS_SQL},
z as (select lang, count(*)::double as rows from documents group by 1),
b as (select w, lang, sum(val) as s, sum(val * val) as q from cells group by all),
t as (select w, sum(s) as s, sum(q) as q, sum(s * s / rows) as own from b join z using (lang) group by 1),
n as (select sum(rows) as n, count(*) as k from z)
select w as idx, round(((own - s * s / n) / (k - 1)) / ((q - own) / (n - k)), 4)::double as f from t, n order by 2 desc nulls last, 1 limit 10""")
def top_words_anova(spark, sf):
    return top_features(sparse_anova_f(_word_rows(spark, sf), "lang").withColumn("f", F.round("f", 4)), 10)


@reg("e09_top_words_correlation", f"""with {WORDS_SQL},
n as (select count(*) as n, avg(n_chars) as m, var_pop(n_chars) * count(*) as sq from documents),
t as (select w, sum(val) as s, sum(val * val) as q, sum(val * (n_chars - m)) as p from cells, n group by 1),
r as (select w, p * p / ((q - s * s / n) * sq) as r2, n from t, n)
select w as idx, round(r2 / (1 - r2) * (n - 2), 3)::double as f from r order by 2 desc nulls last, 1 limit 10""")
def top_words_correlation(spark, sf):
    return top_features(sparse_correlation_f(_word_rows(spark, sf), "n_chars").withColumn("f", F.round("f", 3)), 10)


@reg("e10_large_data_prep")
def large_data(spark, sf):
    li = lineitem(spark, sf).withColumn("label", F.expr("cast(l_quantity > 25 as double)"))
    x = VectorAssembler(inputCols=NUMS, outputCol="features").transform(li).select("label", "features")
    model = large_data_chain(LogisticRegression(maxIter=10, regParam=0.01), len(NUMS), "classification", max_features=2).fit(x)
    return model.transform(x).groupBy("label", "prediction").agg(F.count("*").alias("n"))


@reg("e11_scale_without_centering", """
with s as (select stddev_pop(l_quantity) a, stddev_pop(l_tax) b from lineitem)
select l_returnflag, round(sum(l_quantity / a), 4) as z1, round(sum(l_tax / b), 4) as z2 from lineitem, s group by 1""")
def uncentred(spark, sf):
    out = scale_without_centering(lineitem(spark, sf), ["l_quantity", "l_tax"], ["l_returnflag"])
    return out.groupBy("l_returnflag").agg(_r(F.sum("l_quantity"), 4).alias("z1"), _r(F.sum("l_tax"), 4).alias("z2"))


@reg("f01_holdout", f"""
with r as (select o_orderkey, row_number() over (order by {hash_sql('o_orderkey')}, o_orderkey) rn, count(*) over () n from orders)
select o_orderkey, case when rn <= ceil(n / 5.0 - 1e-9) then 'test' else 'train' end as split from r""")
def holdout(spark, sf):
    return holdout_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"]).select("o_orderkey", "split")


@reg("f02_stratified_holdout", f"""with {LI},
c as (select l_returnflag as c, count(*) n from li group by 1),
t as (select *, sum(n) over () as total, ceil(sum(n) over () / 5.0 - 1e-9) as wanted from c),
q as (select c, floor(wanted * n / total) as base, wanted * n - floor(wanted * n / total) * total as rest, wanted from t),
z as (select c, base + (row_number() over (order by rest desc, c) <= wanted - sum(base) over ())::int as quota from q),
r as (select *, row_number() over (partition by l_returnflag order by h, {KEY_SQL}) rn from li)
select {KEY_SQL}, case when rn <= quota then 'test' else 'train' end as split from r join z on r.l_returnflag = z.c""")
def stratified_holdout(spark, sf):
    li = lineitem(spark, sf).select(*KEYS, "l_returnflag")
    return holdout_split(li, KEYS, "l_returnflag").select(*KEYS, "split")


@reg("f03_folds", f"""
with r as (select o_orderkey, row_number() over (order by {hash_sql('o_orderkey')}, o_orderkey) - 1 as rn, count(*) over () n from orders),
s as (select f, n // 5 + (f < n % 5)::int as size from range(5) t(f), (select count(*) n from orders)),
e as (select f, sum(size) over (order by f) as up_to from s)
select o_orderkey, (select count(*) from e where up_to <= rn)::int as fold from r""")
def folds(spark, sf):
    return assign_folds(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 5).select("o_orderkey", "fold")


@reg("f04_stratified_folds", f"""with {LI},
c as (select l_returnflag as c, count(*) n, min(h) first from li group by 1),
p as (select c, n, coalesce(sum(n) over (order by first rows between unbounded preceding and 1 preceding), 0) as start from c),
a as (select c, f, floor((start + n - 1 - f)::double / 3) - floor((start - 1 - f)::double / 3) as size from p, range(3) t(f)),
e as (select c, f, sum(size) over (partition by c order by f) as up_to from a),
r as (select *, row_number() over (partition by l_returnflag order by h, {KEY_SQL}) - 1 as rn from li)
select {KEY_SQL}, (count(*) filter (up_to <= rn))::int as fold from r join e on r.l_returnflag = e.c group by {KEY_SQL}""")
def stratified_folds(spark, sf):
    li = lineitem(spark, sf).select(*KEYS, "l_returnflag")
    return assign_folds(li, KEYS, 3, "l_returnflag").select(*KEYS, "fold")


@reg("f05_fold_count", """
select p_brand, p_size, count(*) as n, case when count(*) < 20 then 2 when count(*) < 50 then 3 when count(*) < 100 then 4
  when count(*) < 1000 then 5 else 3 end::bigint as cv_folds from part group by 1, 2
union all
select p_brand, -1, count(*), case when count(*) < 20 then 2 when count(*) < 50 then 3 when count(*) < 100 then 4
  when count(*) < 1000 then 5 else 3 end::bigint from part group by 1
union all select 'all', -1, count(*), case when count(*) < 20 then 2 when count(*) < 50 then 3 when count(*) < 100 then 4
  when count(*) < 1000 then 5 else 3 end::bigint from part""")
def fold_counts(spark, sf):
    part = table(spark, sf, "part")
    n = F.count("*")
    out = part.groupBy("p_brand", "p_size").agg(n.alias("n"))
    out = out.unionByName(part.groupBy("p_brand").agg(F.lit(-1).alias("p_size"), n.alias("n")))
    out = out.unionByName(part.agg(F.lit("all").alias("p_brand"), F.lit(-1).alias("p_size"), n.alias("n")))
    return out.withColumn("cv_folds", fold_count(F.col("n")))


QUERIES, SQL = reg.queries, reg.sql

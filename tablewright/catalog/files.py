"""Readers and sinks. The files are written by Spark from the tables, into the shared scratch folder."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.catalog.common import Registry, lineitem, table
from tablewright.functions.missing import parse_number
from tablewright.operators.profile import dataset_profile, rounded_profile
from tablewright.plans.predictor import load_dataset
from tablewright.plans.profiler import profile_files
from tablewright.session import scratch_path
from tablewright.sources.delimited import last_column_target, read_delimited, read_libsvm, sniff_delimiter
from tablewright.sources.discovery import complete_datasets, discover
from tablewright.sources.matrix import load_data, read_dense, read_matrix, read_sparse
from tablewright.sources.sinks import dense_line, write_lines, write_profile_csv
from tablewright.sources.target import read_target, read_types

reg = Registry()


def _orders(spark, sf):
    return table(spark, sf, "orders")


def _dense_line():
    """Four fields: whole number, number or NA, text, number."""
    key = F.col("o_orderkey")
    return F.concat_ws(
        " ",
        (F.col("o_custkey") % 100).cast("string"),
        F.when(key % 5 == 0, "NA").when(key % 7 == 0, "nan").otherwise((key % 13).cast("string")),
        F.substring("o_orderpriority", 3, 1),
        F.concat((key % 9).cast("string"), F.lit(".5")),
    )


DENSE_SQL = """
d as (
  select row_number() over (order by o_orderkey) - 1 as row_id, (o_custkey % 100)::double as f0,
    case when o_orderkey % 5 = 0 or o_orderkey % 7 = 0 then null else (o_orderkey % 13)::double end as f1,
    substr(o_orderpriority, 3, 1) as f2, (o_orderkey % 9)::double + 0.5 as f3, o_orderstatus
  from orders)"""


def _sparse_line():
    """Blank (all zero), dense, or idx:val with duplicates and a token to drop."""
    key = F.col("o_orderkey")
    plain = F.concat_ws(" ", (F.col("o_custkey") % 4).cast("string"), (key % 3).cast("string"))
    pairs = F.concat(
        F.lit("1:"), (F.col("o_custkey") % 50).cast("string"), F.lit(" 4:"), (key % 9).cast("string"),
        F.when(key % 5 == 0, " 4:2.5").otherwise(""), F.when(key % 3 == 0, " 77").otherwise(""),
    )
    return F.when(key % 7 == 0, "").when(key % 11 == 0, plain).otherwise(pairs)


SPARSE_SQL = """
o as (select *, row_number() over (order by o_orderkey) - 1 as row_id from orders),
cells as (
  select row_id, 0 as idx, (o_custkey % 50)::double as val from o where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0
  union all
  select row_id, 3, (o_orderkey % 9)::double + case when o_orderkey % 5 = 0 then 2.5 else 0 end
  from o where o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0
  union all
  select row_id, 0, (o_custkey % 4)::double from o where o_orderkey % 7 <> 0 and o_orderkey % 11 = 0
  union all
  select row_id, 1, (o_orderkey % 3)::double from o where o_orderkey % 7 <> 0 and o_orderkey % 11 = 0)"""


def _write(df: DataFrame, line, name: str, order: str = "o_orderkey") -> str:
    path = scratch_path(df.sparkSession, "text") + f"/{name}"
    write_lines(df, line, [order], path)
    return path


def _one_hot_line():
    return F.concat_ws(" ", *[(F.col("o_orderstatus") == s).cast("int").cast("string") for s in ("F", "O", "P")])


def _folder(spark: SparkSession, sf: str) -> str:
    """Three dataset folders, one of them without a target."""
    root = scratch_path(spark, "datasets")
    o = _orders(spark, sf)
    types = spark.range(4)  # a line for each of the four columns
    for name, parts in (("full", "dst"), ("bare", "ds"), ("untargeted", "d")):
        base = f"{root}/{name}/{name}"
        write_lines(o, _dense_line(), ["o_orderkey"], f"{base}.data")
        if "s" in parts:
            write_lines(o, _one_hot_line(), ["o_orderkey"], f"{base}.solution")
        if "t" in parts:
            role = F.when(F.col("id") == 2, "Categorical").otherwise("Numerical")
            write_lines(types, role, ["id"], f"{base}.type")
    return root


@reg("a01_dataset_discovery", """
select * from (values ('bare', true, true, false), ('full', true, true, true), ('untargeted', true, false, false))
  t(dataset, has_data, has_solution, has_type) where exists (select 1 from orders)""")
def discovery(spark, sf):
    return discover(spark, _folder(spark, sf)).select("dataset", "has_data", "has_solution", "has_type")


@reg("a02_required_files", """
select * from (values ('bare', false), ('full', true)) t(dataset, has_type) where exists (select 1 from orders)""")
def required(spark, sf):
    return complete_datasets(spark, _folder(spark, sf)).select("dataset", "has_type")


@reg("a03_load_by_suffix", """
select 'data' as part, count(*) as n_rows, 4::bigint as n_columns from orders
union all select 'solution', count(*), 3 from orders union all select 'txt', count(*), 4 from orders""")
def by_suffix(spark, sf):
    o = _orders(spark, sf)
    x = load_data(spark, _write(o, _dense_line(), "orders.data"))
    y = load_data(spark, _write(o, _one_hot_line(), "orders.solution"))
    z = load_data(spark, _write(o, _dense_line(), "orders.txt"))
    count = lambda df, part, n: df.agg(F.lit(part).alias("part"), F.count("*").alias("n_rows"), F.lit(n).cast("bigint").alias("n_columns"))
    return count(x.df, "data", x.n_features).unionByName(count(y.df, "solution", y.n_columns)).unionByName(
        count(z.df, "txt", z.n_features)
    )


@reg("a04_sparse_text", f"with {SPARSE_SQL} select row_id, idx, val from cells")
def sparse_text(spark, sf):
    return read_sparse(spark, _write(_orders(spark, sf), _sparse_line(), "orders.data")).cells()


@reg("a05_dense_text", f"with {DENSE_SQL} select row_id, f0, f1, f2, f3 from d")
def dense_text(spark, sf):
    return read_dense(spark, _write(_orders(spark, sf), _dense_line(), "orders.data")).df


@reg("a06_mixed_text", f"""with {SPARSE_SQL}
select o.row_id, count(c.idx) as stored, coalesce(sum(c.val), 0.0)::double as total,
  case when o_orderkey % 7 <> 0 and o_orderkey % 11 <> 0 and o_orderkey % 3 = 0 then 1 else 0 end::bigint as dropped
from o left join cells c on o.row_id = c.row_id group by o.row_id, o_orderkey""")
def mixed_text(spark, sf):
    m = read_matrix(spark, _write(_orders(spark, sf), _sparse_line(), "orders.data"))
    return m.df.select(
        "row_id",
        F.size("values").cast("bigint").alias("stored"),
        F.aggregate("values", F.lit(0.0), lambda a, v: a + v).alias("total"),
        F.col("dropped_tokens").cast("bigint").alias("dropped"),
    )


@reg("a07_target_text", """
select row_number() over (order by o_orderkey) - 1 as row_id,
  case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end::double as y from orders""")
def target_text(spark, sf):
    return read_target(spark, _write(_orders(spark, sf), _one_hot_line(), "orders.solution")).df


@reg("a08_feature_types", """
select row_number() over (order by n_nationkey) - 1 as feature_idx,
  case when n_regionkey % 2 = 0 then 'Numerical' else 'Categorical' end as type from nation""")
def feature_types(spark, sf):
    role = F.when(F.col("n_regionkey") % 2 == 0, "Numerical").otherwise("Categorical")
    n = table(spark, sf, "nation")
    return read_types(spark, _write(n, role, "nation.type", "n_nationkey"))


@reg("a09_sniffed_delimiter", """
select ';' as delimiter, 3::bigint as n_columns, count(*) as n_rows, sum(o_custkey)::bigint as total from orders""")
def sniffed(spark, sf):
    line = F.concat_ws(";", "o_orderkey", "o_custkey", "o_orderstatus")
    path = _write(_orders(spark, sf), line, "orders.csv")
    df = read_delimited(spark, path)
    return df.agg(
        F.lit(sniff_delimiter(spark, path)).alias("delimiter"),
        F.lit(len(df.columns)).cast("bigint").alias("n_columns"),
        F.count("*").alias("n_rows"),
        F.sum(F.col("_c1").cast("bigint")).alias("total"),
    )


@reg("a10_labelled_sparse", """
select (o_custkey % 3)::double as label, count(*) as n, sum(o_orderkey % 7)::double as s0, sum(o_custkey % 5)::double as s2
from orders group by 1""")
def libsvm(spark, sf):
    key = F.col("o_orderkey")
    line = F.concat(
        (F.col("o_custkey") % 3).cast("string"), F.lit(" 1:"), (key % 7).cast("string"), F.lit(" 3:"),
        (F.col("o_custkey") % 5).cast("string"),
    )
    rows = read_libsvm(spark, _write(_orders(spark, sf), line, "orders.svm"), 3)
    x = vector_to_array("features")
    return rows.groupBy("label").agg(
        F.count("*").alias("n"), F.sum(x[0]).alias("s0"), F.sum(x[2]).alias("s2")
    )


@reg("a11_last_column_target", """
select y, count(*) as n, sum(x0)::double as s0, sum(x1)::double as s1
from (select o_orderkey % 17 as x0, o_custkey as x1, o_orderkey % 3 as y from orders) group by y""")
def last_column(spark, sf):
    o = _orders(spark, sf).select(
        (F.col("o_orderkey") % 17).alias("x0"), F.col("o_custkey").alias("x1"), (F.col("o_orderkey") % 3).alias("y")
    )
    return last_column_target(o).groupBy("y").agg(
        F.count("*").alias("n"), F.sum(F.get("x", F.lit(0))).alias("s0"), F.sum(F.get("x", F.lit(1))).alias("s1")
    )


@reg("a12_profile_csv", """
select 'lineitem' as dataset, count(*) as n_samples, 3::bigint as n_features,
  round(100.0 * (sum((l_quantity = 0)::int) + sum((l_discount = 0)::int) + sum((l_tax = 0)::int)) / (3 * count(*)), 2) as sparsity_pct
from lineitem""")
def profile_csv(spark, sf):
    li = lineitem(spark, sf)
    p = rounded_profile(dataset_profile(li, "lineitem", ["l_quantity", "l_discount", "l_tax"], "l_returnflag", "classification"))
    path = scratch_path(spark, "profile") + ".csv"
    write_profile_csv(p, path)
    schema = "dataset string, n_samples bigint, n_features bigint, sparsity_pct double, missing_pct double, n_classes bigint, imbalance double"
    return spark.read.schema(schema).option("header", True).csv(path).select("dataset", "n_samples", "n_features", "sparsity_pct")


@reg("a13_missing_tokens", """
select event_type, count(*) as n, count(*) filter (event_id % 5 in (0, 1)) as n_missing,
  coalesce(sum(event_id % 100) filter (event_id % 5 not in (0, 1)), 0)::double as total
from events group by event_type""")
def missing_tokens(spark, sf):
    e = table(spark, sf, "events")
    k = F.col("event_id") % 5
    token = F.when(k == 0, "N/A").when(k == 1, "NaN").otherwise((F.col("event_id") % 100).cast("string"))
    v = parse_number(token)
    return e.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.count_if(v.isNull()).alias("n_missing"),
        F.coalesce(F.sum(v), F.lit(0.0)).alias("total"),
    )


@reg("a14_plain_matrix", f"""with {DENSE_SQL}
select f2, count(*) as n, count(f1) as n_f1, sum(f0)::double as s0, sum(f3)::double as s3 from d group by f2""")
def plain_matrix(spark, sf):
    m = load_data(spark, _write(_orders(spark, sf), _dense_line(), "orders.txt"))
    return m.df.groupBy("f2").agg(
        F.count("*").alias("n"), F.count("f1").alias("n_f1"), F.sum("f0").alias("s0"), F.sum("f3").alias("s3")
    )


@reg("a15_file_profile", """
with o as (select o_orderkey % 4 as a, o_custkey % 6 as b, o_orderkey % 5 as q, o_custkey % 7 as r, o_orderkey % 2 as y, o_custkey % 3 as label from orders),
c as (select 'sparse' as dataset, label as y from o union all select 'comma', y from o union all select 'semicolon', label from o),
k as (select dataset, count(*) as n_classes, case when count(*) > 1 then 1 - min(n)::double / max(n) else 0 end as imbalance
  from (select dataset, y, count(*) as n from c group by 1, 2) group by 1),
s as (select 'sparse' as dataset, count(*) as n_samples, 3::bigint as n_features, 1 - (sum((q <> 0)::int) + sum((r <> 0)::int))::double / (3 * count(*)) as sp from o
  union all select 'comma', count(*), 2, (sum((a = 0)::int) + sum((b = 0)::int))::double / (2 * count(*)) from o
  union all select 'semicolon', count(*), 2, (sum((a = 0)::int) + sum((b = 0)::int))::double / (2 * count(*)) from o)
select dataset, n_samples, n_features, round(sp * 100, 2) as sparsity_pct, 0.0::double as missing_pct, n_classes, round(imbalance, 4)::double as imbalance
from s join k using (dataset)""")
def file_profile(spark, sf):
    o = table(spark, sf, "orders")
    root = scratch_path(spark, "profiled")
    v = lambda c, n: (F.col(c) % n).cast("string")
    pairs = F.concat(v("o_custkey", 3), F.lit(" 1:"), v("o_orderkey", 5), F.lit(" 3:"), v("o_custkey", 7))
    features = [v("o_orderkey", 4), v("o_custkey", 6)]
    for name, line in (("sparse.data", pairs), ("comma.data", F.concat_ws(",", *features, v("o_orderkey", 2))),
                       ("semicolon.data", F.concat_ws(";", *features)), ("semicolon.solution", v("o_custkey", 3))):
        write_lines(o, line, ["o_orderkey"], f"{root}/{name}")
    return profile_files(spark, {f"{root}/sparse.data": None, f"{root}/comma.data": None, f"{root}/semicolon.data": f"{root}/semicolon.solution"})


@reg("c01_positional_join", f"""with {DENSE_SQL}
select row_id, f0, f1, f2, f3, case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end::double as y from d""")
def positional_join(spark, sf):
    df, _, _, _ = load_dataset(spark, _folder(spark, sf), "full")
    return df.select("row_id", "f0", "f1", "f2", "f3", "y")


QUERIES, SQL = reg.queries, reg.sql

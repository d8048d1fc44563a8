"""Readers on small hand-made files."""

import pytest

from tablewright.errors import DataFormatError, RowMismatchError
from tablewright.plans.predictor import join_target, load_dataset
from tablewright.sources.delimited import read_delimited, sniff_delimiter
from tablewright.sources.discovery import complete_datasets, discover
from tablewright.sources.lines import indexed_lines
from tablewright.sources.matrix import load_data, read_dense, read_matrix, read_sparse
from tablewright.sources.target import load_types, read_target

# row patterns of a three-column 0/1 target, and how often each occurs
PATTERNS = {"111": 13777, "101": 8000, "110": 6336, "011": 2160, "001": 2076, "100": 1094, "010": 574, "000": 173}


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)
    return str(path)


def test_sparse_duplicates_mixed_and_dropped_tokens(spark, tmp_path):
    p = put(tmp_path / "m.data", "1:0.5 3:2 3:1\n7 2:1\n4 5\n")
    m = read_matrix(spark, p)
    assert m.kind == "sparse" and m.n_features == 3
    cells = sorted(tuple(r) for r in m.cells().collect())
    assert cells == [(0, 0, 0.5), (0, 2, 3.0), (1, 1, 1.0), (2, 0, 4.0), (2, 1, 5.0)]
    assert [r[0] for r in m.df.orderBy("row_id").select("dropped_tokens").collect()] == [0, 1, 0]


def test_blank_line_is_a_zero_row_of_a_sparse_file(spark, tmp_path):
    p = put(tmp_path / "m.data", "1:1\n\n2:1\n")
    assert read_sparse(spark, p).df.count() == 3
    assert read_sparse(spark, p, blank_rows="skip").df.count() == 2


def test_index_zero_is_rejected(spark, tmp_path):
    with pytest.raises(DataFormatError, match="row 1"):
        read_sparse(spark, put(tmp_path / "m.data", "1:2\n0:5\n"))


def test_dense_types_missing_and_width(spark, tmp_path):
    p = put(tmp_path / "m.data", "1  2.5 a\n\nNA nan b\n3 -1e2\n")
    m = read_dense(spark, p)
    rows = [tuple(r) for r in m.df.orderBy("row_id").collect()]
    assert rows == [(0, 1.0, 2.5, "a"), (1, None, None, "b"), (2, 3.0, -100.0, None)]
    with pytest.raises(DataFormatError):
        read_dense(spark, put(tmp_path / "w.data", "1 2\n1 2 3\n"))


def test_row_numbers_follow_file_order_across_splits(spark, tmp_path):
    text = "".join(f"{i}\n" for i in range(20_000))
    p = put(tmp_path / "long.txt", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        lines = indexed_lines(spark, p)
        assert lines.rdd.getNumPartitions() > 1
        assert lines.where("row_id = cast(value as bigint)").count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_row_numbers_follow_the_numbers_in_file_names(spark, tmp_path):
    for i in (100_000, 99_999, 7):
        put(tmp_path / "parts" / f"part-{i:05d}.txt", f"{i}a\n{i}b\n")
    put(tmp_path / "whole.txt", "7a\n7b\n99999a\n99999b\n100000a\n100000b\n")
    parts, whole = (indexed_lines(spark, str(tmp_path / p)) for p in ("parts", "whole.txt"))
    assert parts.join(whole, ["row_id", "value"]).count() == 6


def test_long_rows_with_repeated_indices(spark, tmp_path):
    p = put(tmp_path / "m.data", " ".join(f"{i % 9000 + 1}:1" for i in range(20_000)) + "\n")
    rows = read_sparse(spark, p).df.first()
    assert len(rows["indices"]) == 9000 and sum(rows["values"]) == 20_000 and rows["values"][0] == 3.0 and rows["values"][8999] == 2.0


def test_targets(spark, tmp_path):
    one = read_target(spark, put(tmp_path / "a.solution", "3\n1\n2\n"))
    assert one.integer and [r[0] for r in one.df.orderBy("row_id").select("y").collect()] == [3.0, 1.0, 2.0]
    hot = read_target(spark, put(tmp_path / "b.solution", ".3 .7\n.6 .4\n"))
    assert hot.one_hot and [r[0] for r in hot.df.orderBy("row_id").select("y").collect()] == [1.0, 0.0]
    raw = read_target(spark, put(tmp_path / "c.solution", "1 1\n0 1\n"))
    assert raw.multi_column and raw.df.first()["y"] is not None
    with pytest.raises(DataFormatError):
        read_target(spark, put(tmp_path / "d.solution", "yes\nno\n"))


def test_sample_target_facts(spark, tmp_path):
    from tablewright.functions.labels import first_argmax
    from tablewright.operators.profile import class_balance

    sample = put(tmp_path / "s.solution", "".join((" ".join(p) + " \n") * n for p, n in PATTERNS.items()))
    t = read_target(spark, sample)
    assert t.n_columns == 3 and t.multi_column
    lo, hi, n = t.df.selectExpr("min(row_id)", "max(row_id)", "count(*)").first()
    assert (lo, hi, n) == (0, 34189, 34190)
    labels = t.df.select(first_argmax(t.df.y).alias("label"))
    assert {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()} == {0: 29380, 1: 2734, 2: 2076}
    b = class_balance(labels, "label").first()
    assert round(b["imbalance_ratio"], 2) == 14.15 and b["imbalance_level"] == "very high"
    assert round(b["imbalance"], 4) == 0.9293


def test_sample_types(spark, tmp_path):
    sample = put(tmp_path / "s.type", "\n".join(["Categorical"] * 2 + ["Numerical"] * 11 + ["Categorical"] * 11) + "\n")
    types = load_types(spark, sample)
    assert len(types) == 24 and types.count("Numerical") == 11 and types[0] == "Categorical"
    assert load_types(spark, sample + ".missing") is None


def test_discovery_and_positional_join(spark, tmp_path):
    put(tmp_path / "one" / "one.data", "1 2\n3 4\n")
    put(tmp_path / "one" / "one.solution", "0\n1\n")
    put(tmp_path / "two" / "two.data", "1 2\n")
    put(tmp_path / "bad" / "bad.data", "1 2\n1 2\n")
    put(tmp_path / "bad" / "bad.solution", "0\n")
    root = str(tmp_path)
    assert [r["dataset"] for r in discover(spark, root).collect()] == ["bad", "one", "two"]
    assert [r["dataset"] for r in complete_datasets(spark, root).collect()] == ["bad", "one"]
    df, *_ = load_dataset(spark, root, "one")
    assert [tuple(r) for r in df.orderBy("row_id").collect()] == [(0, 1.0, 2.0, 0.0), (1, 3.0, 4.0, 1.0)]
    with pytest.raises(RowMismatchError):
        join_target(load_data(spark, f"{root}/bad/bad.data"), load_data(spark, f"{root}/bad/bad.solution"))


@pytest.mark.parametrize("line,sep", [("1,2", ","), ("1\t2", "\t"), ("1;2", ";"), ("1 2", " "), ("12", " "), ('"a,b";2', ";")])
def test_sniffed_delimiter(spark, tmp_path, line, sep):
    p = put(tmp_path / "x.csv", line + "\n")
    assert sniff_delimiter(spark, p) == sep
    assert len(read_delimited(spark, p).columns) == (2 if line != "12" else 1)


def test_files_of_one_sorted_table_stay_row_by_row(spark, tmp_path):
    from pyspark.sql import functions as F

    from tablewright.sources.sinks import write_lines

    # all keys are equal but for three values: nothing but the one sort says which line goes with which target
    df = spark.range(5000).repartition(7).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v")).orderBy("k").persist()
    for name in ("data", "solution"):
        write_lines(df, F.col("v"), [], str(tmp_path / name))
    df.unpersist()
    a, b = (indexed_lines(spark, str(tmp_path / name)).withColumnRenamed("value", name) for name in ("data", "solution"))
    both = a.join(b, "row_id")
    assert both.count() == 5000 and both.where("data <> solution").isEmpty()
    assert both.withColumn("k", F.col("data").cast("long") % 3).agg(F.corr("k", "row_id")).first()[0] > 0.9

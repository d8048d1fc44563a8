"""Feature files: dense whitespace rows or 1-based ``idx:val`` rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablewright.errors import DataFormatError, EmptyDataError
from tablewright.functions.missing import is_missing, is_number, parse_number
from tablewright.sources.lines import indexed_lines, text_lines, tokens

DENSE, SPARSE = "dense", "sparse"


@dataclass(frozen=True)
class Matrix:
    """A feature table. Dense: ``row_id, f0..``; sparse: ``row_id, indices, values``."""

    df: DataFrame
    kind: str
    n_features: int

    @property
    def columns(self) -> list[str]:
        return [c for c in self.df.columns if c.startswith("f") and c[1:].isdigit()]

    def cells(self) -> DataFrame:
        """Long form ``row_id, idx, val`` of a sparse matrix."""
        return self.df.select("row_id", F.arrays_zip("indices", "values").alias("z")).select(
            "row_id", F.inline("z").alias("idx", "val")
        )


def sparse_pairs(value: Column) -> Column:
    """ARRAY<STRUCT<idx,val>> of one line.

    A line with any colon keeps its ``idx:val`` tokens only; a line without one
    gives its values by position. Repeated indices of a line add up.
    """
    tok = tokens(value)
    pair = lambda t: F.split(t, ":", 2)
    marked = F.transform(
        F.filter(tok, lambda t: t.contains(":")),
        lambda t: F.struct((pair(t)[0].cast("int") - 1).alias("idx"), pair(t)[1].cast("double").alias("val")),
    )
    plain = F.transform(tok, lambda t, i: F.struct(i.cast("int").alias("idx"), t.cast("double").alias("val")))
    pairs = F.when(value == "", F.array().cast("array<struct<idx:int,val:double>>")).when(
        value.contains(":"), marked
    ).otherwise(plain)
    return pairs


def add_duplicates(pairs: Column) -> Column:
    """Sum the values of equal indices of pairs sorted by index: one walk over the runs. No pairs give none."""
    at = F.sequence(F.lit(1), F.size(pairs))
    new = F.filter(at, lambda i: (i == 1) | (F.element_at(pairs, i)["idx"] != F.get(pairs, i - 2)["idx"]))
    begins = F.when(F.size(pairs) > 0, new).otherwise(F.array().cast("array<int>"))
    ends = F.when(F.size(pairs) > 0, F.concat(F.slice(begins, 2, F.size(pairs) + 1), F.array(F.size(pairs) + 1))).otherwise(F.array().cast("array<int>"))
    return F.transform(
        F.arrays_zip(begins.alias("a"), ends.alias("b")),
        lambda r: F.struct(
            F.element_at(pairs, r["a"])["idx"].alias("idx"),
            F.aggregate(F.slice(pairs, r["a"], r["b"] - r["a"]), F.lit(0.0), lambda acc, p: acc + p["val"]).alias("val"),
        ),
    )


def parse_sparse(lines: DataFrame) -> DataFrame:
    """``row_id, indices ARRAY<INT>, values ARRAY<DOUBLE>, dropped_tokens`` from ``row_id, value``."""
    p = lines.select(
        "row_id",
        F.array_sort(sparse_pairs(F.col("value"))).alias("sorted"),
        F.when(
            F.col("value").contains(":"),
            F.size(F.filter(tokens(F.col("value")), lambda t: ~t.contains(":"))),
        )
        .otherwise(0)
        .alias("dropped_tokens"),
    )
    repeats = F.size(F.array_distinct(F.transform("sorted", lambda s: s["idx"]))) < F.size("sorted")
    p = p.withColumn("p", F.when(repeats, add_duplicates(F.col("sorted"))).otherwise(F.col("sorted")))
    return p.select(
        "row_id",
        F.transform("p", lambda s: s["idx"]).alias("indices"),
        F.transform("p", lambda s: s["val"]).alias("values"),
        "dropped_tokens",
    )


def is_sparse_text(lines: DataFrame) -> bool:
    return not lines.where(F.col("value").contains(":")).limit(1).isEmpty()


def read_sparse(spark: SparkSession, path: str, blank_rows: str = "zero") -> Matrix:
    """An all-zero row is a blank line; ``blank_rows='skip'`` drops it instead."""
    lines = indexed_lines(spark, path, skip_blank=blank_rows == "skip")
    rows = parse_sparse(lines)
    top, low = rows.agg(F.max(F.array_max("indices")), F.min(F.array_min("indices"))).first()
    if top is None:
        raise EmptyDataError(f"no values in {path}")
    if low < 0:
        bad = rows.where(F.array_min("indices") < 0).select("row_id").first()[0]
        raise DataFormatError(f"{path}: row {bad} has an index below 1")
    return Matrix(rows, SPARSE, top + 1)


def parse_dense(lines: DataFrame, width: int, text_columns: frozenset[int] = frozenset()) -> DataFrame:
    """``row_id, f0..f{width-1}``; text columns stay STRING, the others become DOUBLE."""
    tok = F.col("tok")

    def field(i: int) -> Column:
        t = F.get(tok, F.lit(i))
        return F.when(~is_missing(t), t) if i in text_columns else parse_number(t)

    fields = [field(i).alias(f"f{i}") for i in range(width)]
    return lines.select("row_id", tokens(F.col("value")).alias("tok")).select("row_id", *fields)


def read_dense(spark: SparkSession, path: str, text_columns: frozenset[int] | None = None) -> Matrix:
    """Width is that of the first line; a longer line is an error, a shorter one pads with null.

    With ``text_columns=None`` one pass finds the columns holding any non-number.
    """
    plain = text_lines(spark, path)
    first = plain.select("value").first()
    if first is None:
        raise EmptyDataError(f"no rows in {path}")
    width = len(first[0].split())
    tok = tokens(F.col("value"))
    checks = [F.max(F.size(tok)).alias("w")]
    if text_columns is None:
        checks += [F.bool_and(is_number(F.get(tok, F.lit(i)))).alias(f"n{i}") for i in range(width)]
    found = plain.agg(*checks).first()
    if found["w"] > width:
        raise DataFormatError(f"{path}: a row has {found['w']} fields, the first has {width}")
    if text_columns is None:
        text_columns = frozenset(i for i in range(width) if not found[f"n{i}"])
    return Matrix(parse_dense(indexed_lines(spark, path), width, text_columns), DENSE, width)


def read_matrix(spark: SparkSession, path: str, text_columns: frozenset[int] | None = None,
                blank_rows: str = "zero") -> Matrix:
    if is_sparse_text(text_lines(spark, path)):
        return read_sparse(spark, path, blank_rows)
    return read_dense(spark, path, text_columns)


def load_data(spark: SparkSession, path: str):
    """Pick the reader by suffix; problems raise instead of giving an empty result."""
    from tablewright.sources.target import read_target

    name = path.rstrip("/")
    if name.endswith(".data"):
        return read_matrix(spark, path)
    if name.endswith(".solution"):
        return read_target(spark, path)
    return read_dense(spark, path)

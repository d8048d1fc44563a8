"""URL rules by a sort-merge range join.

A canonical key is the host's labels in reverse, each ended by a dot, followed by
the path: ``m.example.net/en/x`` is ``net.example.m./en/x``. A rule is then the
interval of all keys that begin with its own key, and two rules' intervals are
nested or apart. Sorted by key, a sweep that passes a rule's start holds that rule
and the rules around it: the stack, which the rule carries as an array. A url
looks at the last rule before it; what has ended is no prefix of its key, and the
longest that is one wins.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tablewright.session import materialize, small_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
COPIES = 4096  # repeated rows that one array gives back
DEFAULT_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://`` or url."""
    text = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(text, URL, 1), UPPER, LOWER), F.regexp_extract(text, URL, 2)


def _labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\.", -1))


def _key(labels: Column, n: Column | int, path: Column) -> Column:
    return F.concat(F.array_join(F.slice(labels, 1, n), "."), F.lit("."), path)


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Rules given as (verdict, host, path)."""
    cols = list(zip(*rules)) or [[], [], []]
    return small_table(spark, dict(zip(("verdict", "host", "path"), cols)), {c: pa.string() for c in ("verdict", "host", "path")})


def _stacks(rules: DataFrame) -> DataFrame:
    """Every rule's key with ``stack``: the rules around it and itself, shortest first.

    A rule that surrounds another is a proper prefix of it: the prefixes of a
    key, no more than its length, meet the rules' keys by equality.
    """
    labels = _labels(F.translate("host", UPPER, LOWER))
    own = rules.where("host is not null and host <> ''").select(
        F.size(labels).alias("labels"), F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("rule"),
        F.lower("verdict").alias("verdict"), _key(labels, F.size(labels), F.coalesce("path", F.lit(""))).alias("key"))
    # one rule a key; of repeated ones that disagree the blocking one holds
    own = own.groupBy("key").agg(F.max("labels").alias("labels"), F.max("rule").alias("rule"), F.max("verdict").alias("verdict"))
    prefixes = own.select("key", F.explode(F.transform(F.sequence(F.lit(1), F.length("key")), lambda n: F.substring("key", 1, n))).alias("prefix"))
    around = own.select(F.col("key").alias("prefix"), F.struct(F.length("rule").alias("length"), "labels", "rule", "verdict", F.col("key").alias("prefix")).alias("entry"))
    return prefixes.join(around, "prefix").groupBy("key").agg(F.array_sort(F.collect_list("entry")).alias("stack"))


def judge(pages: DataFrame, rules: DataFrame, otherwise: str = "allow", id_col: str = "page_id", url_col: str = "url",
          parts: int | None = None) -> DataFrame:
    """Every page's id, host, path, the longest rule that fits it (or null) and its verdict.

    ``rules``: verdict (allow or block), host, path. A rule fits its host and all
    subdomains where the url's path starts with the rule's; of rules of one
    length the one with more labels wins, then the later in order. A rule without
    a host is left out. Where none fits the verdict is ``otherwise``. Repeated
    rows come out as often as they come in; null ids are ids like others, a null
    url has an empty host and path, and empty tables of pages or rules are fine.

    A url looks under each number of host labels that some rule has. Keys are
    dealt by ranges that include the id, so neither a common host nor one common
    url fills a task, and each range begins with the last rule of those before
    it. Only ids, hosts and paths are shuffled.
    """
    spark = pages.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    stacks = materialize(_stacks(rules), "rule-stacks")
    # label counts that occur: at most 127 in a name of the DNS
    depths = sorted(r["d"] for r in stacks.select(F.element_at("stack", -1)["labels"].alias("d")).distinct().collect())
    host, path = url_parts(pages[url_col])
    urls = pages.select(pages[id_col].alias("page_id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("labels", _labels(F.col("host")))
    wanted = F.array(*[F.lit(d) for d in depths]) if depths else F.array().cast("array<int>")
    looks = urls.withColumn("n", F.explode(F.filter(wanted, lambda d: d <= F.size("labels"))))
    keys = looks.select(_key(F.col("labels"), F.col("n"), F.col("path")).alias("key"), F.lit(1).alias("kind"), "page_id", "host", "path")
    events = keys.unionByName(stacks.select("key", F.lit(0).alias("kind"), "stack"), allowMissingColumns=True)
    dealt = materialize(events.repartitionByRange(n, "key", "kind", "page_id").withColumn("part", F.spark_partition_id()), "url-ranges")
    # what holds at the start of a range: one row a range
    last = dealt.where("kind = 0").groupBy("part").agg(F.max(F.struct("key", "stack")).alias("last"))
    ranges = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).join(last, "part", "left")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = ranges.select("part", F.last("last.stack", ignorenulls=True).over(earlier).alias("stack")).where("stack is not null")
    swept = dealt.unionByName(begins.withColumns({"key": F.lit(""), "kind": F.lit(0)}), allowMissingColumns=True)
    sweep = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    held = swept.withColumn("held", F.last("stack", ignorenulls=True).over(sweep)).where("kind = 1")
    fits = held.withColumn("fits", F.filter("held", lambda e: F.startswith(F.col("key"), e["prefix"])))
    hits = fits.select("page_id", "host", "path", F.lit(0).cast("long").alias("copies"), F.try_element_at("fits", F.lit(-1)).alias("best")).where("best is not null")
    rows = urls.select("page_id", "host", "path", F.lit(1).cast("long").alias("copies"))
    order = F.struct("best.length", "best.labels", "best.rule", "best.verdict")
    judged = rows.unionByName(hits, allowMissingColumns=True).groupBy("page_id", "host", "path").agg(F.sum("copies").alias("copies"), F.max(F.when(F.col("best").isNotNull(), order)).alias("best"))
    # repeated rows come back in two steps, so no array grows with their number
    again = judged.withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES}"))))
    again = again.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(COPIES).cast("long"), F.col("copies") - F.col("run") * COPIES))))
    return again.select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(otherwise)).alias("verdict"))


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rule_table(spark, DEFAULT_RULES))


QUERIES = {"op11_url_rules": op11_url_rules}
SQL = {
    "op11_url_rules": r"""
with rules(verdict, h, p) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
parts as (
  select page_id, row_number() over () as n, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) as path
  from pages),
best as (
  select n, max(struct_pack(l := length(h) + length(p), k := length(h), rule := h || p, verdict := verdict)) as b
  from parts join rules on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by n)
select page_id, host, path, b.rule as rule, coalesce(b.verdict, 'allow') as verdict from parts left join best using (n)"""
}

"""URL allow and block rules as a sort-merge range join over reversed-host keys.

A rule names a host and a path prefix; it fits the host and all its
subdomains.  The canonical key of a rule is its host with the labels reversed,
joined by dots, followed by the path, so everything the rule covers at its own
host level is one interval: the keys that start with it.  A page has one such
key per host level (``com``, ``example.com``, ...), no deeper than the deepest
rule.  Rules and page keys are range-partitioned together and swept in order.
Intervals of prefixes nest, so each rule carries the stack of the rules that
enclose it; the last rule seen before a key holds all rules that can still be
active, and those that are prefixes of the key are.

* Pages are reduced to distinct (host, path) before anything is shuffled, so a
  hot host or URL is judged once per partition.
* A range boundary may cut through one hot key: the partitions' last stacks (a
  row per partition) are carried forward, so no key needs to stay in one task.
* The partition ids are checkpointed, since a recomputed range partitioning may
  choose other boundaries.

The longest rule (host and path, in characters) wins, then the deeper host.
NULL urls and urls without ``://`` have an empty host and path and get the
default verdict.  Repeated rows repeat their result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

#: fixed values of the contract: host, path prefix, verdict
RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def host_and_path(url):
    """Host after the first ``://`` (A-Z lower-cased) and the path up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def _reversed(labels: str) -> str:
    return f"array_join(reverse({labels}), '.')"


def rule_table(spark: SparkSession, rules) -> DataFrame:
    """key, rule, verdict and ``stack``: the rules whose interval encloses this one's start, itself included."""
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    r = r.select(F.expr(f"concat({_reversed("split(host, '[.]')")}, path)").alias("key"),
                 F.concat("host", "path").alias("rule"), "verdict",
                 F.size(F.split("host", "[.]")).alias("depth")).distinct()
    # every prefix of a rule's key, matched to the rules that have it as their key
    inner = r.select(F.col("key").alias("of"), F.explode(F.expr(
        "transform(sequence(1, length(key)), n -> left(key, n))")).alias("key")).distinct()
    stacks = (inner.join(r, "key").groupBy("of").agg(F.collect_set(
        F.struct(F.length("rule").alias("len"), "depth", "key", "rule", "verdict")).alias("stack")))
    return stacks.select(F.col("of").alias("key"), "stack")


def sweep(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``keys`` (host, path, key) with the active rules of each key, from one ordered sweep."""
    spark = keys.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    both = (rules.select("key", F.lit(0).alias("page"), F.lit("").alias("host"), F.lit("").alias("path"), "stack")
            .unionByName(keys.select("key", F.lit(1).alias("page"), "host", "path"), allowMissingColumns=True))
    # host and path only break ties: a key shared by many pages may be split
    order = ["key", "page", "host", "path"]
    both = both.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()).checkpoint()
    in_order = Window.partitionBy("pid").orderBy(*order)
    swept = both.withColumn("seen", F.last("stack", True).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    # last rule of each earlier partition: one row per partition, n rows at most
    ends = (both.where("page = 0").groupBy("pid").agg(F.max_by("stack", "key").alias("end")))
    pids = spark.range(n).select(F.col("id").cast("int").alias("pid")).join(ends, "pid", "left")
    carry = pids.select("pid", F.last("end", True).over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    swept = swept.where("page = 1").join(F.broadcast(carry), "pid", "left")  # n rows: bounded by the partitions
    return swept.select("host", "path", F.expr(
        "filter(coalesce(seen, carried), s -> startswith(key, s.key))").alias("active"))


def judge(pages: DataFrame, rules=RULES, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every row of ``pages``."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col("url"))
    p = pages.select("page_id", host.alias("host"), path.alias("path"))
    deepest = max((len(h.split(".")) for h, _, _ in rules), default=0)
    if not deepest:
        return p.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    levels = (p.where("host <> ''").select("host", "path").distinct()
              .withColumn("labels", F.split("host", "[.]"))
              .select("host", "path", F.explode(F.expr(
                  f"transform(sequence(1, least(size(labels), {deepest})), n -> concat("
                  f"{_reversed('slice(labels, -n, n)')}, path))")).alias("key")))
    best = (sweep(levels, rule_table(spark, rules))
            .groupBy("host", "path").agg(F.max(F.array_max("active")).alias("best"))
            .where("best IS NOT NULL").select(F.col("host").alias("b_host"), F.col("path").alias("b_path"), "best"))
    out = p.join(best, (F.col("host") == F.col("b_host")) & (F.col("path") == F.col("b_path")), "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))


def op10_url_filters(spark, sf_dir: str) -> DataFrame:
    """Contract digest over all ``pages``."""
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))


SQL = """
WITH u AS (
    SELECT page_id, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
    FROM pages),
p AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM u),
r(h, pre, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                        ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (
    SELECT host, path, h || pre AS rule, v,
           row_number() OVER (PARTITION BY host, path ORDER BY length(h || pre) DESC, h) AS k
    FROM (SELECT DISTINCT host, path FROM p) q JOIN r
      ON (q.host = r.h OR ends_with(q.host, '.' || r.h)) AND starts_with(q.path, r.pre))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.v, 'allow') AS verdict
FROM p LEFT JOIN m ON m.host = p.host AND m.path = p.path AND m.k = 1
"""

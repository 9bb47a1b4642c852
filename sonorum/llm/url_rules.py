"""URL filters as a sort-merge range join.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with
the rule's path. The canonical key of a url or rule is its reversed host and then its path. As rules
bind a host and a path, a url stands once at each reversed parent of its host that a rule can name, and
inside such a level a rule is the interval from its own path to the last path with that prefix, so
the intervals of one level nest. One sorted sweep over the
openings, closings and urls of a level keeps the stack of active rules: the running sum of
openings and closings is the depth, and the top of the stack is the last opening at the depth
of the row. The longest rule over all levels decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sonorum.llm.common import LOWER, UPPER, materialize, read_table

URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Rules of the registered query: (host, path, verdict).
QUERY_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def url_host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def _levels(host: Column, deepest: int) -> Column:
    """Reversed names of the host and its parents, with at most `deepest` labels."""
    labels = F.reverse(F.split(host, r"\."))
    return F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))), lambda n: F.array_join(F.slice(labels, F.lit(1), n), "."))


def judge_urls(pages: DataFrame, rules: DataFrame, keep: tuple[str, ...] = ("page_id",), url_col: str = "url", default: str = "allow", rows_per_shard: int = 500_000) -> DataFrame:
    """One row for each page: `keep`, host, path, rule (or null), verdict.

    pages: any columns; a null url or one without ``://`` has an empty host and path and gets
    `default`, as does an empty table's lack of rules. Repeated pages stay repeated. Columns of
    pages outside `keep` and `url_col` are not read. rules: host, path, verdict; rows with a null
    are ignored, and of two equal rules ``block`` wins over ``allow`` (the greater string).
    Of fitting rules the longest host and path together wins, then the longer host.
    Urls may have any length. A level that very many urls share is dealt to shards of about
    `rows_per_shard` urls, each with a copy of that level's rules. Equal urls are judged once; where one has more pages than
    `rows_per_shard` its verdict is copied so often that no join task gets more of them.
    """
    urls = pages.select(*keep, url_host(F.col(url_col)).alias("__host"), url_path(F.col(url_col)).alias("__path"))
    rules = (
        rules.dropna(subset=["host", "path", "verdict"])
        .groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("level", _reversed(F.col("host")))
    )
    deepest = rules.agg(F.max(F.size(F.split("host", r"\.")))).first()[0] or 1
    distinct = materialize(urls.groupBy("__host", "__path").agg(F.count(F.lit(1)).alias("n")), "urls")
    salts = -(-(distinct.agg(F.max("n")).first()[0] or 1) // rows_per_shard)
    at = distinct.select("__host", "__path", F.explode(_levels(F.col("__host"), deepest)).alias("level"))
    named = rules.select("level").distinct()
    load = at.join(named, "level", "left_semi").groupBy("level").count().select("level", F.ceil(F.col("count") / rows_per_shard).cast("int").alias("shards"))

    points = at.join(load, "level").select(
        "level", F.pmod(F.xxhash64("__host", "__path"), F.col("shards")).cast("int").alias("shard"),
        F.encode("__path", "UTF-8").alias("key"), F.lit(1).alias("kind"), "__host", "__path", F.lit(None).cast("struct<host:string,path:string,verdict:string>").alias("rule"),
    )
    dealt = rules.join(load, "level").withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)))
    start = F.encode("path", "UTF-8")
    ends = F.array(F.struct(start.alias("key"), F.lit(0).alias("kind")), F.struct(F.concat(start, F.lit(b"\xff")).alias("key"), F.lit(2).alias("kind")))
    bounds = dealt.withColumn("end", F.explode(ends)).select(
        "level", "shard", F.col("end.key").alias("key"), F.col("end.kind").alias("kind"), F.lit(None).cast("string").alias("__host"), F.lit(None).cast("string").alias("__path"),
        F.when(F.col("end.kind") == 0, F.struct("host", "path", "verdict")).alias("rule"),
    )
    sweep = Window.partitionBy("level", "shard").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    stack = Window.partitionBy("level", "shard", "depth").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = (
        points.unionByName(bounds)
        .withColumn("depth", F.sum(1 - F.col("kind")).over(sweep))
        .withColumn("top", F.last("rule", ignorenulls=True).over(stack))
        .filter((F.col("kind") == 1) & F.col("top").isNotNull())
    )
    length = F.struct(F.length("top.host") + F.length("top.path"), F.length("top.host"))
    best = swept.groupBy("__host", "__path").agg(F.max_by("top", length).alias("top"))
    key = ["__host", "__path"]
    if salts > 1:
        key = [*key, "__salt"]
        urls = urls.withColumn("__salt", F.pmod(F.xxhash64(*keep), F.lit(salts)).cast("int"))
        best = best.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(int(salts) - 1))))
    return urls.join(best, key, "left").select(
        *keep, F.col("__host").alias("host"), F.col("__path").alias("path"),
        F.concat("top.host", "top.path").alias("rule"), F.coalesce("top.verdict", F.lit(default)).alias("verdict"),
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for h, p, v in QUERY_RULES]
    rules = spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return judge_urls(read_table(spark, sf_dir, "pages"), rules)


ORACLE_SQL = r"""
WITH u AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r
"""

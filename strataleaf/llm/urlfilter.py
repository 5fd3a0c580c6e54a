"""Operator 2 (native): URL filter by hashed host-suffix and path-prefix expressions.

A rule is (verdict, host, path), its path ending in a slash. Each distinct (host, path) of
the urls is expanded into every suffix of the host's labels with every prefix of the path that
ends in a slash (no more labels or segments than a rule has can match, so longer ones are
not made). Expressions meet the rules on the first bytes of their SHA-256, then the whole digest is
compared, and the longest rule wins (block before allow on a tie). Urls without a rule are allowed.

DataFrame functions only. Urls are judged once per distinct (host, path), so a hot host costs its
distinct paths, and the verdict goes back by one join on both. The rules' table is planned by
its size: Spark broadcasts it below its own limit and shuffles it above.

Nulls: a null url, or one without `://`, has an empty host and path, and no rule. A null page_id, and
repeated rows, are rows like any other; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ensure, materialize

RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Hex digits of the digest that the join is on.
SHORT = 8
#: A (host, path) with 1/HEAVY of all rows or more is joined by broadcast.
HEAVY = 1024


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(whole, pattern, 1)), F.regexp_extract(whole, pattern, 2)


def rule_table(pages: DataFrame, rules=RULES) -> DataFrame:
    for verdict, host, path in rules:
        if verdict not in ("block", "allow") or not host or not (path.startswith("/") and path.endswith("/")):
            raise ValueError(f"not a rule: {verdict} {host}{path}")
    table = pages.sparkSession.createDataFrame([(v, h + p) for v, h, p in rules], "verdict string, rule string")
    digest = F.sha2(F.col("rule").cast("binary"), 256)
    return table.select("rule", "verdict", digest.alias("rule_digest"), F.substring(digest, 1, SHORT).alias("short"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of pages."""
    host, path = host_and_path(F.col("url"))
    rows = ensure(pages, page_id="long", url="string").select("page_id", host.alias("host"), path.alias("path"))
    labels = max([h.count(".") + 1 for _, h, _ in rules], default=0)
    segments = max([p.count("/") for _, _, p in rules], default=0)
    parts = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(max(1, labels)))), lambda k: F.call_function("substring_index", F.col("host"), F.lit("."), -k))
    slashes = F.size(F.split("path", "/")) - 1
    paths = F.transform(
        F.filter(F.sequence(F.lit(1), F.greatest(F.least(slashes, F.lit(max(1, segments))), F.lit(1))), lambda k: k <= slashes),
        lambda k: F.concat(F.call_function("substring_index", F.col("path"), F.lit("/"), k), F.lit("/")),
    )
    seen = rows.where("host <> '' AND path <> ''").groupBy("host", "path").agg(F.count(F.lit(1)).alias("rows"))
    made = seen.withColumn("paths", paths).withColumn("suffix", F.explode(F.array_distinct(hosts))).withColumn("prefix", F.explode("paths"))
    made = made.select("host", "path", "rows", F.sha2(F.concat("suffix", "prefix").cast("binary"), 256).alias("digest")).withColumn("short", F.substring("digest", 1, SHORT))
    met = made.join(rule_table(pages, rules), "short").where(F.col("digest") == F.col("rule_digest"))
    best = F.max(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("block"), F.col("rule"), F.col("verdict"))).alias("best")
    found = met.groupBy("host", "path").agg(best, F.first("rows").alias("rows")).select("host", "path", "rows", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    # Pairs with at least 1/HEAVY of all rows number at most HEAVY and go to every task, judged or not; so no task gets all rows of one.
    common = seen.where(F.col("rows") * HEAVY >= F.lit(rows.count())).select("host", "path").join(found, ["host", "path"], "left")
    common = materialize(common.select("host", "path", "rule", "verdict"), "url-common")
    rare = found.join(F.broadcast(common.select("host", "path")), ["host", "path"], "left_anti").select("host", "path", "rule", "verdict")
    told = F.broadcast(common.select("host", "path", F.col("rule").alias("hot_rule"), F.col("verdict").alias("hot_verdict"), F.lit(True).alias("hot")))
    every = rows.join(told, ["host", "path"], "left")
    hot = every.where("hot").select("page_id", "host", "path", F.col("hot_rule").alias("rule"), F.col("hot_verdict").alias("verdict"))
    # Rows with no url to speak of meet no rule, and need no join.
    cold = every.where("hot IS NULL AND host <> '' AND path <> ''").select("page_id", "host", "path").join(rare, ["host", "path"], "left")
    none = every.where("hot IS NULL AND (host = '' OR path = '')").select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict"))
    out = hot.unionByName(cold).unionByName(none)
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict"))


#: The same in SQL, rule by rule.
SQL = """
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
  FROM pages),
rules(verdict, host, path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
fits AS (
  SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.page_id, p.host, p.path ORDER BY length(r.host || r.path) DESC NULLS LAST) AS k
  FROM parts p LEFT JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE k = 1
"""

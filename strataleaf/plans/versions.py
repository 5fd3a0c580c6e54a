"""Version-chain queries over orders and events."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import versions as V
from .common import query, table


def _observed(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type", "value")


def _windows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("day"), "o_orderstatus")
    o = o.withColumn("source", F.when(F.col("o_orderstatus") == "F", "edition").otherwise("observed"))
    expire = F.when(F.col("o_orderstatus") == "F", F.date_add("day", 30))
    return V.validity(o, "o_custkey", "day", "source", F.when(F.col("o_orderstatus") == "P", 1).otherwise(0), "o_orderkey", expire)


_WINDOWS = """WITH RECURSIVE o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, CASE WHEN o_orderstatus = 'F' THEN 'edition' ELSE 'observed' END AS source,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) + 30 END AS expire,
  row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END, CAST(o_orderdate AS DATE), o_orderkey) AS rn FROM orders),
f AS (SELECT *, day AS valid_from, false AS nudged, false AS clash FROM o WHERE rn = 1
  UNION ALL SELECT o.*, greatest(o.day, f.valid_from + 1), o.day < f.valid_from + 1, o.day <= f.valid_from AND o.source = 'edition' AND f.source = 'edition' AND NOT f.nudged
  FROM f JOIN o ON o.o_custkey = f.o_custkey AND o.rn = f.rn + 1),
w AS (SELECT o_orderkey, o_custkey, valid_from, CASE WHEN lead(valid_from) OVER c IS NOT NULL THEN lead(valid_from) OVER c - 1 WHEN expire IS NOT NULL THEN greatest(expire, valid_from) END AS valid_to,
  CASE WHEN nudged THEN 'observed_adjusted' ELSE source END AS valid_from_source, bool_or(clash) OVER (PARTITION BY o_custkey) AS conflict FROM f WINDOW c AS (PARTITION BY o_custkey ORDER BY rn))
"""


@query(_WINDOWS + "SELECT * FROM w")
def version_windows(spark, sf_dir):
    """Validity windows of every document's versions."""
    return _windows(spark, sf_dir).select("o_orderkey", "o_custkey", "valid_from", "valid_to", "valid_from_source", "conflict")


@query(_WINDOWS + "SELECT o_custkey, o_orderkey, valid_from, valid_to FROM w WHERE valid_from <= DATE '1996-06-30' AND (valid_to IS NULL OR DATE '1996-06-30' <= valid_to)")
def version_as_of(spark, sf_dir):
    """The version in force on a day (FLT1, J12)."""
    return V.as_of(_windows(spark, sf_dir), "1996-06-30").select("o_custkey", "o_orderkey", "valid_from", "valid_to")


@query("""SELECT a.o_custkey, a.o_orderkey FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS vf, CAST(o_orderdate AS DATE) + 60 AS vt FROM orders) a WHERE EXISTS (
 SELECT 1 FROM (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS vf, CAST(o_orderdate AS DATE) + 60 AS vt FROM orders) b
 WHERE b.o_custkey = a.o_custkey AND (b.vf < a.vf OR (b.vf = a.vf AND b.o_orderkey < a.o_orderkey)) AND a.vf <= b.vt)""")
def version_overlaps(spark, sf_dir):
    """Windows that begin before an earlier one has ended (J11): a running maximum, not a self-join."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("valid_from"))
    return V.overlaps(o.withColumn("valid_to", F.date_add("valid_from", 60)), "o_custkey", "o_orderkey").select("o_custkey", "o_orderkey")


@query("SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS version_number FROM events")
def version_numbers(spark, sf_dir):
    """Numbers by arrival."""
    return V.number_versions(_observed(spark, sf_dir), "user_id", ["ts", "event_id"]).select("event_id", "user_id", F.col("version_number").cast("long").alias("version_number"))


@query("SELECT event_id, user_id, event_type FROM (SELECT *, row_number() OVER w AS rn, lag(event_type) OVER w AS old FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) WHERE rn = 1 OR old IS DISTINCT FROM event_type")
def version_changes(spark, sf_dir):
    """A new version wherever the content differs from the current one (W3, FLT5)."""
    return V.changes(_observed(spark, sf_dir), "user_id", ["ts", "event_id"], "event_type").select("event_id", "user_id", "event_type")


@query("""SELECT event_id, user_id, CASE WHEN old IS NULL THEN 'new' WHEN event_type = 'purchase' AND old <> 'purchase' THEN 'expired' WHEN old = 'purchase' THEN 'effective' ELSE 'amended' END AS kind
 FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old FROM events) WHERE old IS NULL OR old <> event_type""")
def status_transitions(spark, sf_dir):
    """Update events from one status to the next."""
    old = F.lag("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    rows = _observed(spark, sf_dir).withColumn("old", old).where("old IS NULL OR old <> event_type")
    kind = F.when(F.col("old").isNull(), "new").when((F.col("event_type") == "purchase") & (F.col("old") != "purchase"), "expired").when(F.col("old") == "purchase", "effective").otherwise("amended")
    return rows.select("event_id", "user_id", kind.alias("kind"))


@query("""SELECT event_id, user_id, coalesce(ts < max(ts) OVER (PARTITION BY user_id ORDER BY event_id * 7919 % 10007, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS stale FROM events""")
def stale_observations(spark, sf_dir):
    """Observations older than one seen before are skipped (FLT11)."""
    rows = _observed(spark, sf_dir).withColumn("arrived", F.col("event_id") * 7919 % 10007)
    return V.stale(rows, "user_id", "ts", ["arrived", "event_id"]).select("event_id", "user_id", "stale")


@query("""SELECT event_id, user_id, last_value(CASE WHEN event_type <> 'view' THEN event_type END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS kept FROM events""")
def never_blank_merge(spark, sf_dir):
    """The last known value is never overwritten by a blank one."""
    rows = _observed(spark, sf_dir)
    return rows.select("event_id", "user_id", V.keep_last_known(rows, "user_id", ["ts", "event_id"], "event_type", F.col("event_type") == "view").alias("kept"))


@query("""WITH a AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS old FROM events), i AS (SELECT *, sum(CASE WHEN old IS DISTINCT FROM event_type THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS island FROM a)
SELECT user_id, CAST(island AS BIGINT) AS island, event_type, min(ts) AS first_seen, CAST(count(*) AS BIGINT) AS seen FROM i GROUP BY user_id, island, event_type""")
def expiry_tracking(spark, sf_dir):
    """First day of every run of a status."""
    runs = V.islands(_observed(spark, sf_dir), "user_id", ["ts", "event_id"], "event_type")
    return runs.groupBy("user_id", "island", "event_type").agg(F.min("ts").alias("first_seen"), F.count(F.lit(1)).alias("seen"))


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey")
def latest_per_key(spark, sf_dir):
    """The last good response of each task."""
    return V.latest(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select("o_custkey", "o_orderkey"), "o_custkey", [F.desc("o_orderkey")])


@query("SELECT event_id, user_id, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS changed FROM events")
def previous_snapshot(spark, sf_dir):
    """Change against the snapshot before."""
    old = F.lag("value").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    return _observed(spark, sf_dir).select("event_id", "user_id", old.alias("previous"), (F.col("value") - old).alias("changed"))


@query("SELECT count(*) AS n FROM (SELECT user_id FROM events GROUP BY user_id, ts HAVING count(*) > 1)")
def unique_violations(spark, sf_dir):
    """Keys that should be unique and are not (constraints of the data model)."""
    return table(spark, sf_dir, "events").groupBy("user_id", "ts").count().where("count > 1").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END, CASE WHEN o_orderpriority LIKE '1%' THEN CAST(o_orderdate AS DATE) + 1 END, DATE '1999-01-01') AS start, CASE WHEN o_orderstatus = 'F' THEN 'edition' WHEN o_orderpriority LIKE '1%' THEN 'published' ELSE 'observed' END AS start_source FROM orders")
def start_precedence(spark, sf_dir):
    """Start of validity by the best source there is."""
    day, edition, published = F.to_date("o_orderdate"), F.col("o_orderstatus") == "F", F.col("o_orderpriority").startswith("1")
    start = F.coalesce(F.when(edition, day), F.when(published, F.date_add(day, 1)), F.lit("1999-01-01").cast("date"))
    return table(spark, sf_dir, "orders").select("o_orderkey", start.alias("start"), F.when(edition, "edition").when(published, "published").otherwise("observed").alias("start_source"))

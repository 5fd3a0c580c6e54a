"""Queue, coverage, ingest and integrity queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import query, table


@query("SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderpriority, o_orderkey LIMIT 1")
def queue_next(spark, sf_dir):
    """Next pending task."""
    return table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select("o_orderkey", "o_orderpriority").orderBy("o_orderpriority", "o_orderkey").limit(1)


@query("SELECT o_custkey, min(o_orderpriority) AS priority, arg_min(o_orderstatus, o_orderkey) AS kind FROM orders GROUP BY o_custkey")
def queue_priority_merge(spark, sf_dir):
    """Enqueue: first kind stays, the best priority wins (SNK4)."""
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderpriority").alias("priority"), F.min_by("o_orderstatus", "o_orderkey").alias("kind"))


@query("""SELECT o_orderpriority AS kind, o_orderstatus AS status, CAST(count(*) AS BIGINT) AS n, CAST(sum(CASE WHEN o_totalprice > 100000 THEN 1 ELSE 0 END) AS BIGINT) AS large,
 bool_or(o_totalprice < 1000) AS any_small, bool_and(o_totalprice > 0) AS all_positive FROM orders GROUP BY ALL""")
def queue_report(spark, sf_dir):
    """Counts by kind and status with flags."""
    price = F.col("o_totalprice")
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("kind"), F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(price > 100000, 1).otherwise(0)).alias("large"), F.bool_or(price < 1000).alias("any_small"), F.bool_and(price > 0).alias("all_positive"))


@query("""SELECT l_orderkey, CASE WHEN bool_or(l_linestatus = 'O') THEN 'pending' WHEN bool_and(l_returnflag <> 'R') AND count(DISTINCT l_partkey) = count(*) THEN 'covered' WHEN bool_or(l_returnflag = 'A') THEN 'force_paging' ELSE 'failed' END AS state FROM lineitem GROUP BY l_orderkey""")
def queue_reconcile(spark, sf_dir):
    """State of a split query from its children."""
    ok = F.bool_and(F.col("l_returnflag") != "R") & (F.count_distinct("l_partkey") == F.count(F.lit(1)))
    state = F.when(F.bool_or(F.col("l_linestatus") == "O"), "pending").when(ok, "covered").when(F.bool_or(F.col("l_returnflag") == "A"), "force_paging").otherwise("failed")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(state.alias("state"))


@query("""WITH p AS (SELECT l_orderkey, l_returnflag, sha256(string_agg(CAST(l_suppkey % 3 AS VARCHAR), chr(10) ORDER BY l_suppkey % 3)) AS signature FROM lineitem GROUP BY ALL)
SELECT l_orderkey, l_returnflag, signature, count(*) OVER (PARTITION BY l_orderkey, signature) > 1 AS repeated FROM p""")
def page_repeat_detection(spark, sf_dir):
    """Pages whose id set another page of the task has too (SNK7)."""
    ids = F.sort_array(F.collect_list((F.col("l_suppkey") % 3).cast("string")))
    pages = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sha2(F.array_join(ids, "\n"), 256).alias("signature"))
    return pages.withColumn("repeated", F.count(F.lit(1)).over(Window.partitionBy("l_orderkey", "signature")) > 1)


@query("""SELECT o_custkey, lo, lo + CAST((hi - lo) // 2 AS INTEGER) AS mid, lo + CAST((hi - lo) // 2 AS INTEGER) + 1 AS next_lo, hi FROM (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders GROUP BY o_custkey) WHERE lo < hi""")
def date_bisect(spark, sf_dir):
    """Halves of a date range, disjoint and complete."""
    day = F.to_date("o_orderdate")
    r = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min(day).alias("lo"), F.max(day).alias("hi")).where("lo < hi")
    mid = F.date_add("lo", F.floor(F.datediff("hi", "lo") / 2).cast("int"))
    return r.select("o_custkey", "lo", mid.alias("mid"), F.date_add(mid, 1).alias("next_lo"), "hi")


@query("""SELECT CAST(count(*) AS BIGINT) AS documents, CAST(sum(CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END) AS BIGINT) AS ok, CAST(count(*) - sum(CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END) AS BIGINT) AS missing,
 least(100.0::DOUBLE, round_even(CAST(100.0 * sum(CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END) / count(*) AS DECIMAL(18, 6)), 1)::DOUBLE) AS coverage FROM documents""")
def coverage_overall(spark, sf_dir):
    """Coverage of a published total."""
    ok = F.sum(F.when(F.col("n_chars") >= 1000, 1).otherwise(0))
    d = table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("documents"), ok.alias("ok"))
    share = F.bround((100 * F.col("ok") / F.col("documents")).cast("decimal(18,6)"), 1).cast("double")
    return d.select("documents", "ok", (F.col("documents") - F.col("ok")).alias("missing"), F.least(F.lit(100.0), share).alias("coverage"))


@query("""SELECT lang, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (source = 'src0') AS BIGINT) AS first_source, CAST(count(*) - count(*) FILTER (source IN ('src0', 'src1')) AS BIGINT) AS residual FROM documents GROUP BY lang""")
def coverage_by_group(spark, sf_dir):
    """Counts by language with the residual that no group holds (A4, A5)."""
    src = F.col("source")
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.count_if(src == "src0").alias("first_source"), (F.count(F.lit(1)) - F.count_if(src.isin("src0", "src1"))).alias("residual"))


@query("""SELECT coalesce(r.r_name, 'unmapped') AS category, CAST(count(*) AS BIGINT) AS n FROM customer c LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey AND n.n_nationkey % 5 <> 0 LEFT JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY ALL""")
def coverage_by_category(spark, sf_dir):
    """Rollup to categories, with those that have none."""
    n = table(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0")
    c = table(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return c.groupBy(F.coalesce("r_name", F.lit("unmapped")).alias("category")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT l_returnflag, CAST(count(*) AS BIGINT) AS total, CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_rows, CAST(sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS final_rows,
 sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) + sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) = count(*) AS consistent FROM lineitem GROUP BY l_returnflag""")
def totals_self_check(spark, sf_dir):
    """Parts against their total."""
    part = lambda s: F.sum(F.when(F.col("l_linestatus") == s, 1).otherwise(0))
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("total"), part("O").alias("open_rows"), part("F").alias("final_rows"), (part("O") + part("F") == F.count(F.lit(1))).alias("consistent"))


@query("""WITH ranks AS (SELECT p_brand, p_size, min(p_partkey) AS rank FROM part WHERE p_size <= 10 GROUP BY ALL UNION ALL SELECT p_brand, 0, min(p_partkey) FROM part WHERE p_brand < 'Brand#3' GROUP BY p_brand)
SELECT p.p_partkey, coalesce(a.rank, b.rank) AS rank FROM part p LEFT JOIN ranks a ON a.p_brand = p.p_brand AND a.p_size = p.p_size LEFT JOIN ranks b ON b.p_brand = p.p_brand AND b.p_size = 0""")
def rank_lookup(spark, sf_dir):
    """First hit of several keys in order."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    exact = part.where("p_size <= 10").groupBy("p_brand", "p_size").agg(F.min("p_partkey").alias("r1"))
    broad = part.where("p_brand < 'Brand#3'").groupBy("p_brand").agg(F.min("p_partkey").alias("r2"))
    return part.join(exact, ["p_brand", "p_size"], "left").join(broad, "p_brand", "left").select("p_partkey", F.coalesce("r1", "r2").alias("rank"))


@query("""SELECT DISTINCT d.doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) OR EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 0) OR d.n_chars < 300""")
def rechunk_candidates(spark, sf_dir):
    """Versions without chunks, with stale ones, or of an old chunker."""
    flags = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max(F.col("quality") == 0).alias("bad"))
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").join(flags, "doc_id", "left").where("bad IS NULL OR bad OR n_chars < 300").select("doc_id").distinct()


@query("SELECT l_orderkey, l_linenumber FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus IS NOT DISTINCT FROM l.l_linestatus)")
def ownership_violations(spark, sf_dir):
    """Chunks whose document does not own their version."""
    li, o = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus"), table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return li.join(o, (li.l_orderkey == o.o_orderkey) & li.l_linestatus.eqNullSafe(o.o_orderstatus), "left_anti").select("l_orderkey", "l_linenumber")


@query("SELECT event_id FROM events WHERE nullif(user_id % 3, 0) IS NULL OR user_id % 3 = 2")
def tenant_filter(spark, sf_dir):
    """Shared rows and the tenant's own (FLT4, L13)."""
    org = F.nullif(F.col("user_id") % 3, F.lit(0))
    return table(spark, sf_dir, "events").where(org.isNull() | (org == 2)).select("event_id")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 5")
def json_predicate(spark, sf_dir):
    """Filter on a JSON path (FLT13)."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select("event_id", k.alias("k")).where("k >= 5")


@query("SELECT lang, string_agg(source, '; ' ORDER BY first, source) AS sources FROM (SELECT lang, source, min(doc_id) AS first FROM documents WHERE source <> '' GROUP BY lang, source) GROUP BY lang")
def distinct_join(spark, sf_dir):
    """Distinct values joined in the order of their first occurrence."""
    first = table(spark, sf_dir, "documents").where("source <> ''").groupBy("lang", "source").agg(F.min("doc_id").alias("first"))
    named = F.transform(F.sort_array(F.collect_list(F.struct("first", "source"))), lambda x: x["source"])
    return first.groupBy("lang").agg(F.array_join(named, "; ").alias("sources"))


@query("SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS chars, CASE WHEN sum(length(text)) / count(*) >= 200 THEN 'ok' ELSE 'needs_ocr' END AS text_status, bool_or(role = 'assistant' AND trim(text) <> '') AS has_body FROM conversations GROUP BY conv_id")
def text_status(spark, sf_dir):
    """Text status of a scanned or empty document (A13, F56, SRC11)."""
    n = F.sum(F.length("text"))
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(n.alias("chars"), F.when(n / F.count(F.lit(1)) >= 200, "ok").otherwise("needs_ocr").alias("text_status"), F.bool_or((F.col("role") == "assistant") & (F.trim("text") != "")).alias("has_body"))


@query("SELECT o_custkey, o_orderstatus, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1")
def card_upsert(spark, sf_dir):
    """The last card of each document and kind (SNK11, SNK13)."""
    last = F.max_by(F.struct("o_orderkey", "o_totalprice"), F.struct("o_orderdate", "o_orderkey")).alias("last")
    return table(spark, sf_dir, "orders").groupBy("o_custkey", "o_orderstatus").agg(last).select("o_custkey", "o_orderstatus", "last.o_orderkey", "last.o_totalprice")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM lineitem o WHERE o.l_partkey = lineitem.l_partkey AND o.l_suppkey = lineitem.l_suppkey AND o.l_returnflag = 'R') AND l_returnflag <> 'R'")
def relation_insert(spark, sf_dir):
    """New relations that are not there yet (SNK12, SNK14, U2)."""
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    return li.where("l_returnflag <> 'R'").select("l_partkey", "l_suppkey").dropDuplicates().join(li.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"], "left_anti")


@query("SELECT d.doc_id, sha256(d.text) AS sha256, s.doc_id IS NOT NULL AS reused FROM documents d LEFT JOIN (SELECT DISTINCT doc_id, sha256(text) AS h FROM documents WHERE doc_id % 3 = 0) s ON s.doc_id = d.doc_id AND s.h = sha256(d.text)")
def snapshot_upsert(spark, sf_dir):
    """Snapshots that exist are reused (SNK9, L5)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"))
    old = docs.where("doc_id % 3 = 0").distinct().withColumn("reused", F.lit(True))
    return docs.join(old, ["doc_id", "sha256"], "left").select("doc_id", "sha256", F.coalesce("reused", F.lit(False)).alias("reused"))


@query("SELECT doc_id, n_chars, source FROM documents WHERE (source LIKE '%1' OR source LIKE '%2') AND lang IN ('en', 'de') AND contains(lower(text), 'tion')")
def admin_search(spark, sf_dir):
    """Substring search with facets (FLT7-FLT9, SRC2)."""
    src = F.col("source")
    return table(spark, sf_dir, "documents").where((src.endswith("1") | src.endswith("2")) & F.col("lang").isin("en", "de") & F.lower("text").contains("tion")).select("doc_id", "n_chars", "source")


@query("SELECT o_custkey, o_orderkey FROM (SELECT * FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 20) WHERE o_orderstatus <> 'O' ORDER BY o_orderkey DESC LIMIT 1)")
def last_full_job(spark, sf_dir):
    """The last full run among the newest twenty."""
    newest = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus").orderBy(F.desc("o_orderkey")).limit(20)
    return newest.where("o_orderstatus <> 'O'").orderBy(F.desc("o_orderkey")).limit(1).select("o_custkey", "o_orderkey")

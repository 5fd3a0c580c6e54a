"""Archive, queue, ingest and search-surface queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import retrieval as R
from .common import query, table


def _tasks(spark, sf_dir):
    """Orders as archive tasks: a url, a kind and a status."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_totalprice", "o_orderdate")
    status = F.when(F.col("o_orderstatus") == "F", "done").when(F.col("o_orderstatus") == "P", "failed").otherwise("pending")
    return o.withColumn("status", status).withColumn("url", F.concat(F.lit("https://a.example.org/docs/-"), F.col("o_custkey").cast("string")))


_TASKS = "t AS (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'P' THEN 'failed' ELSE 'pending' END AS status, 'https://a.example.org/docs/-' || o_custkey AS url FROM orders)"


@query("SELECT l_orderkey AS source, string_agg(DISTINCT CAST(l_partkey AS VARCHAR), ',' ORDER BY CAST(l_partkey AS VARCHAR)) AS targets, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY l_orderkey")
def archive_edges(spark, sf_dir):
    """Edges of two relations, grouped by their source (SRC1, SRC6)."""
    li = table(spark, sf_dir, "lineitem").where(F.col("l_returnflag").isin("R", "A")).select(F.col("l_orderkey").alias("source"), F.col("l_partkey").cast("string").alias("target"))
    targets = F.array_sort(F.collect_set("target"))
    return li.groupBy("source").agg(F.array_join(targets, ",").alias("targets"), F.size(targets).cast("long").alias("n"))


@query("SELECT CAST(count(*) AS BIGINT) AS documents FROM documents")
def count_documents(spark, sf_dir):
    """Documents of the archive (SRC4)."""
    return table(spark, sf_dir, "documents").agg(F.count(F.lit(1)).alias("documents"))


@query(f"WITH {_TASKS}, u AS (SELECT DISTINCT url FROM t) SELECT u.url, min(t.o_orderkey) FILTER (t.status = 'done') AS resource, min(t.o_orderkey) FILTER (t.status IN ('done', 'failed')) AS with_failed FROM u LEFT JOIN t USING (url) GROUP BY u.url")
def resource_lookup(spark, sf_dir):
    """A url's resource among tasks that are done, or done and failed (SRC5)."""
    t = _tasks(spark, sf_dir)
    done, tried = F.col("status") == "done", F.col("status").isin("done", "failed")
    return t.groupBy("url").agg(F.min(F.when(done, F.col("o_orderkey"))).alias("resource"), F.min(F.when(tried, F.col("o_orderkey"))).alias("with_failed"))


@query("""WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'blobs\\' || page_id || '\\x.gz' WHEN 1 THEN 'blobs/../../x' WHEN 2 THEN '/etc/x' WHEN 3 THEN 'C:\\x' ELSE 'blobs/' || page_id END AS relative FROM pages)
SELECT page_id, CASE WHEN regexp_matches(replace(relative, '\\', '/'), '^/|^[A-Za-z]:|(^|/)\\.\\.(/|$)') THEN NULL ELSE replace(relative, '\\', '/') END AS path FROM p""")
def blob_path(spark, sf_dir):
    """A blob's path below the archive; one that would leave it is refused (SRC7)."""
    k, name = F.col("page_id") % 5, F.col("page_id").cast("string")
    relative = F.when(k == 0, F.concat(F.lit("blobs\\"), name, F.lit("\\x.gz"))).when(k == 1, "blobs/../../x").when(k == 2, "/etc/x").when(k == 3, "C:\\x").otherwise(F.concat(F.lit("blobs/"), name))
    path = F.translate(relative, "\\", "/")
    return table(spark, sf_dir, "pages").select("page_id", F.when(~path.rlike(r"^/|^[A-Za-z]:|(^|/)\.\.(/|$)"), path).alias("path"))


@query("SELECT doc_id, folder, regexp_extract(folder, '^(.*)_[^_]*$', 1) AS external_id, regexp_extract(folder, '_([^_]*)$', 1) AS task FROM (SELECT doc_id, '-' || doc_id || '_' || source || '_' || n_chars AS folder FROM documents)")
def folder_ids(spark, sf_dir):
    """External id and task of an archive folder: parted at the last underscore."""
    folder = F.concat(F.lit("-"), F.col("doc_id").cast("string"), F.lit("_"), F.col("source"), F.lit("_"), F.col("n_chars").cast("string"))
    rows = table(spark, sf_dir, "documents").select("doc_id", folder.alias("folder"))
    task = F.substring_index("folder", "_", -1)
    return rows.select("doc_id", "folder", F.expr("substring(folder, 1, length(folder) - length(substring_index(folder, '_', -1)) - 1)").alias("external_id"), task.alias("task"))


_EVENT_JSON = "CASE WHEN event_id % 7 = 0 THEN '{not json' WHEN event_id % 5 = 0 THEN '{\"source\":\"s' || user_id || '\",\"total\":3}' ELSE '{\"source\":\"s' || user_id || '\",\"captured_at\":' || event_id // 4 || ',\"total\":' || event_id || '}' END"


@query(f"""WITH r AS (SELECT event_id, {_EVENT_JSON} AS raw FROM events), v AS (SELECT event_id, json_extract_string(raw, '$.source') AS source, CAST(json_extract_string(raw, '$.captured_at') AS BIGINT) AS captured_at, CAST(json_extract_string(raw, '$.total') AS BIGINT) AS total FROM r WHERE json_valid(raw))
SELECT source, captured_at, arg_min(total, event_id) AS total FROM v WHERE source IS NOT NULL AND captured_at IS NOT NULL AND total IS NOT NULL GROUP BY source, captured_at""")
def statistics_import(spark, sf_dir):
    """Statistics snapshots: malformed files and missing keys are skipped, one row a source and time (SRC3, SNK14)."""
    n = F.col("event_id")
    source = F.concat(F.lit('{"source":"s'), F.col("user_id").cast("string"), F.lit('"'))
    whole = F.concat(source, F.lit(',"captured_at":'), F.floor(n / 4).cast("string"), F.lit(',"total":'), n.cast("string"), F.lit("}"))
    raw = F.when(n % 7 == 0, "{not json").when(n % 5 == 0, F.concat(source, F.lit(',"total":3}'))).otherwise(whole)
    v = table(spark, sf_dir, "events").select("event_id", F.from_json(raw, "source string, captured_at long, total long").alias("v")).select("event_id", "v.*")
    return v.dropna(subset=["source", "captured_at", "total"]).groupBy("source", "captured_at").agg(F.min_by("total", "event_id").alias("total"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE 'pending' END AS status, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_custkey % 5 AS BIGINT) ELSE 0 END AS attempts, CASE WHEN o_orderkey % 4 = 0 THEN 'owner' ELSE '' END AS refused FROM orders""")
def queue_update(spark, sf_dir):
    """A task's update: only allowed fields are set, others are named (SNK5)."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    given = lambda when, name, value: F.when(when, F.create_map(F.lit(name), value.cast("string"))).otherwise(F.create_map().cast("map<string,string>"))
    fields = F.map_concat(given(k % 3 == 0, "status", F.col("o_orderstatus")), given(k % 2 == 0, "attempts", F.col("o_custkey") % 5), given(k % 4 == 0, "owner", F.col("o_orderpriority")))
    allowed = F.map_filter("fields", lambda name, _: name.isin("status", "attempts", "state", "error"))
    rows = o.select("o_orderkey", fields.alias("fields")).withColumn("ok", allowed)
    refused = F.array_join(F.array_sort(F.array_except(F.map_keys("fields"), F.map_keys("ok"))), ",")
    return rows.select("o_orderkey", F.coalesce(F.col("ok")["status"], F.lit("pending")).alias("status"), F.coalesce(F.col("ok")["attempts"].cast("long"), F.lit(0).cast("long")).alias("attempts"), refused.alias("refused"))


@query("""SELECT page_id, 'content-type=text/html' || CASE WHEN page_id % 2 = 0 THEN ';etag=e' || page_id ELSE '' END || CASE WHEN page_id % 3 = 0 THEN ';last-modified=m' ELSE '' END AS headers FROM pages""")
def response_headers(spark, sf_dir):
    """The response log keeps some headers only (SNK6)."""
    n, name = F.col("page_id"), F.col("page_id").cast("string")
    pairs = [("Content-Type", F.lit("text/html")), ("Set-Cookie", name), ("ETag", F.when(n % 2 == 0, F.concat(F.lit("e"), name))), ("Last-Modified", F.when(n % 3 == 0, F.lit("m"))), ("X-Trace", name)]
    headers = F.create_map(*[x for key, value in pairs for x in (F.lower(F.lit(key)), value)])
    kept = F.map_filter(headers, lambda key, value: key.isin("content-type", "etag", "last-modified", "content-length", "retry-after") & value.isNotNull())
    entries = F.array_sort(F.transform(F.map_entries(kept), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(entries, ";").alias("headers"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')")
def queue_reset(spark, sf_dir):
    """A query that starts anew loses its pages and children (SNK8, L7)."""
    again = table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").join(again, "l_orderkey", "left_anti")


@query("""SELECT conv_id, turn, substr(number, 1, 32) AS number, CAST(text_status = 'ok' AS BOOLEAN) AS has_chunks FROM (SELECT conv_id, turn, repeat(role || turn, 6) AS number, CASE WHEN sum(length(text)) OVER (PARTITION BY conv_id) >= 400 THEN 'ok' ELSE 'needs_ocr' END AS text_status FROM conversations)""")
def section_insert(spark, sf_dir):
    """Sections take numbers of 32 characters; chunks only where there is text (SNK10)."""
    t = table(spark, sf_dir, "conversations")
    ok = F.sum(F.length("text")).over(Window.partitionBy("conv_id")) >= 400
    return t.select("conv_id", "turn", F.substring(F.repeat(F.concat("role", F.col("turn").cast("string")), F.lit(6)), 1, 32).alias("number"), ok.alias("has_chunks"))


_PAYLOAD = "CASE page_id % 5 WHEN 0 THEN '%PDF-1.7 x' WHEN 1 THEN 'plain' WHEN 2 THEN html WHEN 3 THEN chr(208) || chr(207) || 'x' ELSE '  <HTML>' END"


@query(f"""SELECT page_id, kind, CASE kind WHEN 'pdf' THEN CASE WHEN starts_with(body, '%PDF-') THEN 'saved' ELSE 'not_pdf' END WHEN 'asset' THEN CASE WHEN regexp_matches(lower(ltrim(body)), '^<(!doctype|html)') THEN 'html_instead' ELSE 'saved' END
 ELSE CASE WHEN starts_with(body, chr(208) || chr(207)) OR starts_with(body, 'PK') THEN 'saved' ELSE 'not_word' END END AS outcome FROM (SELECT page_id, list_extract(['pdf', 'asset', 'word'], CAST(page_id % 3 AS INT) + 1) AS kind, {_PAYLOAD} AS body FROM pages)""")
def payload_validation(spark, sf_dir):
    """What a resource must begin with to be saved (SNK15, L14)."""
    k = F.col("page_id") % 5
    ole = chr(208) + chr(207)
    body = F.when(k == 0, "%PDF-1.7 x").when(k == 1, "plain").when(k == 2, F.col("html")).when(k == 3, ole + "x").otherwise("  <HTML>")
    p = table(spark, sf_dir, "pages").select("page_id", F.element_at(F.array(F.lit("pdf"), F.lit("asset"), F.lit("word")), (F.col("page_id") % 3).cast("int") + 1).alias("kind"), body.alias("body"))
    b, kind = F.col("body"), F.col("kind")
    html = F.lower(F.ltrim(b)).rlike("^<(!doctype|html)")
    outcome = F.when(kind == "pdf", F.when(b.startswith("%PDF-"), "saved").otherwise("not_pdf")).when(kind == "asset", F.when(html, "html_instead").otherwise("saved")).otherwise(F.when(b.startswith(ole) | b.startswith("PK"), "saved").otherwise("not_word"))
    return p.select("page_id", "kind", outcome.alias("outcome"))


@query("""SELECT doc_id, CAST(i AS BIGINT) AS chunk_index FROM (SELECT doc_id, unnest(CASE WHEN n_chars >= 200 THEN generate_series(0, (n_chars + 999) // 1000 - 1) ELSE [] END) AS i FROM documents)""")
def rechunk_replace(spark, sf_dir):
    """All chunks of a version are replaced; none where there is no text to speak of (SNK16)."""
    last = F.ceil(F.col("n_chars") / 1000) - 1
    return table(spark, sf_dir, "documents").where("n_chars >= 200").select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))).alias("chunk_index"))


_SURFACE = """v AS (SELECT doc_id AS version_id, doc_id // 2 AS document_id, DATE '2020-01-01' + CAST(doc_id % 900 AS INT) AS valid_from, CASE WHEN doc_id % 3 <> 0 THEN DATE '2020-01-01' + CAST(doc_id % 900 + 300 AS INT) END AS valid_to FROM documents),
d AS (SELECT doc_id AS document_id, 'D-' || doc_id AS external_id, 'Document ' || doc_id AS title, doc_id || '-son' AS document_number, list_extract(['active', 'expired', 'unknown'], CAST(doc_id % 3 AS INT) + 1) AS status, CAST(doc_id % 9 AS BIGINT) AS legal_rank, doc_id % 13 = 0 AS deleted, lang FROM documents)"""


def _surface(spark, sf_dir):
    """Chunks, versions and documents, made of the documents: two versions a document, some windows closed, some documents deleted."""
    docs, k = table(spark, sf_dir, "documents"), F.col("doc_id")
    start = F.date_add(F.lit("2020-01-01").cast("date"), (k % 900).cast("int"))
    chunks = docs.select(k.alias("chunk_id"), k.alias("version_id"), "text")
    versions = docs.select(k.alias("version_id"), F.floor(k / 2).alias("document_id"), start.alias("valid_from"), F.when(k % 3 != 0, F.date_add(start, 300)).alias("valid_to"))
    name = k.cast("string")
    status = F.element_at(F.array(F.lit("active"), F.lit("expired"), F.lit("unknown")), (k % 3).cast("int") + 1)
    documents = docs.select(k.alias("document_id"), F.concat(F.lit("D-"), name).alias("external_id"), F.concat(F.lit("Document "), name).alias("title"), F.concat(name, F.lit("-son")).alias("document_number"), status.alias("status"), (k % 9).cast("long").alias("legal_rank"), (k % 13 == 0).alias("deleted"), "lang")
    return chunks, versions, documents


@query(f"""WITH {_SURFACE}, c AS (SELECT doc_id AS chunk_id, text, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS t FROM documents)
SELECT c.chunk_id, v.version_id, d.document_id, d.external_id, d.title, d.document_number, d.status, d.legal_rank, c.text, round(0.1::DOUBLE * len(list_filter(c.t, lambda x: x = 'the')), 6) AS rank
FROM c JOIN v ON v.version_id = c.chunk_id JOIN d ON d.document_id = v.document_id WHERE list_contains(c.t, 'the') AND v.valid_from <= DATE '2021-06-01' AND (v.valid_to IS NULL OR DATE '2021-06-01' <= v.valid_to) AND NOT d.deleted AND d.lang = 'en' ORDER BY rank DESC, c.chunk_id LIMIT 50""")
def fts_as_of_hits(spark, sf_dir):
    """The search a user calls: chunks in force on a day, of documents not deleted, in a language, with ten columns (J1, FLT1-FLT3, R1, R4, R7).

    Small predicates come first: only chunks of versions in force and documents that count are tokenised.
    """
    chunks, versions, documents = _surface(spark, sf_dir)
    day = F.lit("2021-06-01").cast("date")
    live = versions.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (day <= F.col("valid_to"))))
    rows = live.join(documents.where("NOT deleted AND lang = 'en'").drop("deleted", "lang"), "document_id").join(chunks.where(F.lower("text").contains("the")), "version_id")
    hits = R.search(rows, "chunk_id", "text", [["the"]])
    return hits.select("chunk_id", "version_id", "document_id", "external_id", "title", "document_number", "status", "legal_rank", "text", "rank")


@query(f"WITH {_SURFACE} SELECT v.version_id AS chunk_id, d.title, d.document_number, d.external_id, 'https://a.example.org/docs/' || d.external_id AS url, strftime(v.valid_from, '%Y-%m-%d') AS adopted_at, row_number() OVER (PARTITION BY v.document_id ORDER BY v.version_id) AS version_number FROM v JOIN d USING (document_id)")
def chunk_identity(spark, sf_dir):
    """What a chunk says about its document (PRJ1)."""
    _, versions, documents = _surface(spark, sf_dir)
    number = F.row_number().over(Window.partitionBy("document_id").orderBy("version_id")).cast("long")
    rows = versions.withColumn("version_number", number).join(documents, "document_id")
    return rows.select(F.col("version_id").alias("chunk_id"), "title", "document_number", "external_id", F.concat(F.lit("https://a.example.org/docs/"), "external_id").alias("url"), F.date_format("valid_from", "yyyy-MM-dd").alias("adopted_at"), "version_number")


@query("SELECT c_custkey, c_name FROM customer WHERE CASE WHEN c_acctbal < 0 THEN DATE '2024-01-01' END IS NULL")
def soft_delete_filter(spark, sf_dir):
    """Rows without a day of deletion (FLT2)."""
    gone = F.when(F.col("c_acctbal") < 0, F.lit("2024-01-01").cast("date"))
    return table(spark, sf_dir, "customer").withColumn("deleted_at", gone).where("deleted_at IS NULL").select("c_custkey", "c_name")


@query("""SELECT conv_id, string_agg('<' || tag || ' style="margin-left:' || least(depth, 6) * 18 || 'px">' || replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;') || '</' || tag || '>', '' ORDER BY turn) AS html
 FROM (SELECT conv_id, turn, text, CASE role WHEN 'system' THEN 'h2' WHEN 'user' THEN 'h3' ELSE 'p' END AS tag, turn AS depth FROM conversations) GROUP BY conv_id""")
def document_render(spark, sf_dir):
    """Sections as HTML: heading by type, indent by depth, text escaped, in order (PRJ3)."""
    escaped = F.col("text")
    for plain, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        escaped = F.replace(escaped, F.lit(plain), F.lit(safe))
    tag = F.when(F.col("role") == "system", "h2").when(F.col("role") == "user", "h3").otherwise("p")
    one = F.concat(F.lit("<"), tag, F.lit(' style="margin-left:'), (F.least("turn", F.lit(6)) * 18).cast("string"), F.lit('px">'), escaped, F.lit("</"), tag, F.lit(">"))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", one.alias("h")))).alias("s"))
    return rows.select("conv_id", F.array_join(F.transform("s", lambda x: x["h"]), "").alias("html"))


@query("SELECT c.c_custkey, CAST(count(o.o_orderkey) AS BIGINT) AS versions, CAST(rank() OVER (ORDER BY count(o.o_orderkey) DESC) AS BIGINT) AS place FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey")
def version_counts(spark, sf_dir):
    """Versions of each document and its place by them (A10, FLT8)."""
    n = table(spark, sf_dir, "customer").select("c_custkey").join(table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey"), "c_custkey", "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("versions"))
    # Places come from the few distinct counts, not from one window over all documents.
    counts = n.groupBy("versions").agg(F.count(F.lit(1)).alias("m"))
    above = F.coalesce(F.sum("m").over(Window.orderBy(F.desc("versions")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + 1
    return n.join(F.broadcast(counts.withColumn("place", above.cast("long")).drop("m")), "versions").select("c_custkey", "versions", "place")


@query("""SELECT l_orderkey, l_linenumber, last_value(head IGNORE NULLS) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice ROWS UNBOUNDED PRECEDING) AS category, l_quantity FROM (SELECT *, CASE WHEN l_linenumber % 3 = 1 THEN l_partkey END AS head FROM lineitem)""")
def table_grid(spark, sf_dir):
    """Cells that span rows are carried down."""
    head = F.when(F.col("l_linenumber") % 3 == 1, F.col("l_partkey"))
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").rowsBetween(Window.unboundedPreceding, 0)
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.last(head, ignorenulls=True).over(w).alias("category"), "l_quantity")


@query("""WITH k AS (SELECT page_id, list_sort(list_distinct(list_transform(list_filter(string_split(regexp_extract(url, '\\?([^#]*)', 1), '&'), lambda x: x <> ''), lambda x: lower(split_part(x, '=', 1))))) AS keys FROM pages)
SELECT page_id, array_to_string(list_filter(keys, lambda x: x IN ('ref', 'page')), ',') AS skipped, array_to_string(list_filter(keys, lambda x: x NOT IN ('ref', 'page', 'utm_source')), ',') AS unknown FROM k""")
def key_sets(spark, sf_dir):
    """Keys of a query that are to be skipped, and those nobody knows."""
    parts = F.filter(F.split(F.regexp_extract("url", r"\?([^#]*)", 1), "&"), lambda x: x != "")
    keys = F.array_sort(F.array_distinct(F.transform(parts, lambda x: F.lower(F.substring_index(x, "=", 1)))))
    known = F.array(F.lit("ref"), F.lit("page"), F.lit("utm_source"))
    return table(spark, sf_dir, "pages").select("page_id", F.array_join(F.array_intersect(keys, F.slice(known, 1, 2)), ",").alias("skipped"), F.array_join(F.array_except(keys, known), ",").alias("unknown"))


@query("""SELECT o_orderkey, 'https://a.example.org/docs/-' || o_custkey || CASE WHEN o_orderkey % 2 = 0 THEN '?ONDATE=' || strftime(o_orderdate, '%d.%m.%Y') ELSE '' END || CASE WHEN o_orderkey % 3 = 0 THEN '#' || o_orderkey ELSE '' END AS target_url, substr(repeat(o_orderpriority, 60), 1, 500) AS anchor_text,
 CASE WHEN o_orderkey % 2 = 0 THEN 'edition' ELSE 'cites' END AS relation FROM orders WHERE NOT (o_custkey = o_orderkey AND o_orderkey % 3 <> 0)""")
def relation_rows(spark, sf_dir):
    """Relations with a canonical url; a link to the document itself stays only with an anchor."""
    k = F.col("o_orderkey")
    url = F.concat(F.lit("https://a.example.org/docs/-"), F.col("o_custkey").cast("string"), F.when(k % 2 == 0, F.concat(F.lit("?ONDATE="), F.date_format("o_orderdate", "dd.MM.yyyy"))).otherwise(""), F.when(k % 3 == 0, F.concat(F.lit("#"), k.cast("string"))).otherwise(""))
    o = table(spark, sf_dir, "orders").where(~((F.col("o_custkey") == k) & (k % 3 != 0)))
    return o.select("o_orderkey", url.alias("target_url"), F.substring(F.repeat("o_orderpriority", F.lit(60)), 1, 500).alias("anchor_text"), F.when(k % 2 == 0, "edition").otherwise("cites").alias("relation"))


@query("""SELECT p_partkey, regexp_replace(lower(p_name), '[^\\p{L}\\p{N}_]+', '', 'g') AS label_key, trim(regexp_replace(regexp_replace(regexp_replace(lower(p_type), '([\\p{L}\\p{N}_])-([\\p{L}\\p{N}_])', '\\1 \\2', 'g'), '[''’]', '', 'g'), '\\s+', ' ', 'g')) AS category_key FROM part""")
def lookup_keys(spark, sf_dir):
    """Keys of card labels and of categories."""
    label = F.regexp_replace(F.lower("p_name"), r"[^\p{L}\p{N}_]+", "")
    return table(spark, sf_dir, "part").select("p_partkey", label.alias("label_key"), X.search_key(F.col("p_type"), F.lit("uz")).alias("category_key"))


_RETRY = "CASE event_id % 6 WHEN 0 THEN '' WHEN 1 THEN CAST(event_id % 90 AS VARCHAR) WHEN 2 THEN '-7' WHEN 3 THEN strftime(ts + INTERVAL 90 SECOND, '%a, %d %b %Y %H:%M:%S GMT') WHEN 4 THEN strftime(ts - INTERVAL 90 SECOND, '%a, %d %b %Y %H:%M:%S GMT') ELSE 'soon' END"


@query(f"""SELECT event_id, CASE WHEN TRY_CAST(header AS DOUBLE) IS NOT NULL THEN greatest(0::DOUBLE, CAST(header AS DOUBLE)) WHEN when_ IS NOT NULL THEN greatest(0::DOUBLE, CAST(date_diff('second', date_trunc('second', ts), when_) AS DOUBLE)) ELSE 5::DOUBLE END AS wait
 FROM (SELECT event_id, ts, header, try_strptime(header, '%a, %d %b %Y %H:%M:%S GMT') AS when_ FROM (SELECT event_id, ts, {_RETRY} AS header FROM events))""")
def retry_after(spark, sf_dir):
    """Seconds to wait by a header of seconds or of a date; five without one."""
    e, k = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts")), F.col("event_id") % 6
    stamp = lambda seconds: F.concat(F.date_format(F.col("ts") + F.expr(f"INTERVAL {seconds} SECOND"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    header = F.when(k == 0, "").when(k == 1, (F.col("event_id") % 90).cast("string")).when(k == 2, "-7").when(k == 3, stamp(90)).when(k == 4, stamp(-90)).otherwise("soon")
    rows = e.select("event_id", "ts", header.alias("header"))
    # The weekday says nothing that the day does not.
    day = F.nullif(F.regexp_extract("header", r"^[A-Za-z]+, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit(""))
    when = F.expr("try_to_timestamp(day, 'dd MMM yyyy HH:mm:ss')").cast("timestamp_ntz")
    left = F.timestamp_diff("SECOND", F.date_trunc("second", "ts").cast("timestamp_ntz"), F.col("moment"))
    number = F.expr("try_cast(nullif(header, '') AS double)")
    rows = rows.withColumn("day", day).withColumn("moment", when).withColumn("number", number)
    return rows.select("event_id", F.when(F.col("number").isNotNull(), F.greatest(F.lit(0.0), "number")).when(F.col("moment").isNotNull(), F.greatest(F.lit(0.0), left.cast("double"))).otherwise(5.0).alias("wait"))


@query("""SELECT l_orderkey, CASE WHEN count(*) = 0 THEN 'empty' WHEN count(DISTINCT l_suppkey) < count(*) THEN 'duplicate_ids' WHEN sum(l_quantity) > 0 AND count(*) FILTER (l_returnflag <> 'N') = 0 THEN 'no_ids_for_total' ELSE 'ok' END AS layout FROM lineitem GROUP BY l_orderkey""")
def layout_guards(spark, sf_dir):
    """Pages whose layout cannot be trusted."""
    twins = F.count_distinct("l_suppkey") < F.count(F.lit(1))
    none = (F.sum("l_quantity") > 0) & (F.count_if(F.col("l_returnflag") != "N") == 0)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.when(twins, "duplicate_ids").when(none, "no_ids_for_total").otherwise("ok").alias("layout"))


@query("SELECT event_id, CAST(ts + INTERVAL 5 HOUR AS DATE) AS local_day, make_timestamp(CAST(round(value * 1000) AS BIGINT) * 1000) AS moment FROM events")
def local_days(spark, sf_dir):
    """The users' day of a UTC time, and the time of epoch seconds."""
    utc = F.col("ts").cast("timestamp_ntz").cast("string").cast("timestamp")
    local = F.to_date(F.from_utc_timestamp(utc, "Asia/Tashkent"))
    moment = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.round(F.col("value") * 1000) / 1000).cast("decimal(18,6)"))
    return table(spark, sf_dir, "events").select("event_id", local.alias("local_day"), moment.alias("moment"))


@query("""WITH s AS (SELECT doc_id, unnest(string_split(text, '. ')) AS page, generate_subscripts(string_split(text, '. '), 1) AS i FROM documents)
SELECT doc_id, CAST(i AS BIGINT) AS page_no, 'f0_pg' || i AS label, sha256(page) AS text_hash FROM s WHERE trim(page) <> ''""")
def pdf_pages(spark, sf_dir):
    """Pages of a file as sections; blank ones are left out and keep their number."""
    pages = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", r"\. ")).alias("i", "page")).where(F.trim("page") != "")
    number = (F.col("i") + 1).cast("long")
    return pages.select("doc_id", number.alias("page_no"), F.concat(F.lit("f0_pg"), number.cast("string")).alias("label"), F.sha2("page", 256).alias("text_hash"))


@query("""SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS position, CASE WHEN l_returnflag = 'R' THEN 'primary' WHEN l_returnflag = 'A' THEN 'asset' ELSE 'attachment' END AS role, CAST(row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY l_linenumber) AS BIGINT) AS nth FROM lineitem WHERE l_linestatus = 'F'""")
def attachments(spark, sf_dir):
    """Files of a document by role, in order (X7, SNK13)."""
    role = F.when(F.col("l_returnflag") == "R", "primary").when(F.col("l_returnflag") == "A", "asset").otherwise("attachment")
    li = table(spark, sf_dir, "lineitem").where("l_linestatus = 'F'")
    nth = F.row_number().over(Window.partitionBy("l_orderkey", "l_returnflag").orderBy("l_linenumber")).cast("long")
    return li.select("l_orderkey", F.col("l_linenumber").cast("long").alias("position"), role.alias("role"), nth.alias("nth"))


@query("""WITH a AS (SELECT event_id, user_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) % 5 AS tries FROM events)
SELECT event_id, CASE WHEN event_type = 'error' AND tries >= 4 THEN 'failed' WHEN event_type = 'error' AND tries = 0 THEN 'rejected' ELSE 'done' END AS status, CASE WHEN event_type <> 'error' THEN 1 WHEN tries = 0 THEN 1 ELSE least(tries, 3) + 1 END AS attempts,
 CASE WHEN event_type <> 'error' OR tries = 0 THEN 0.0::DOUBLE ELSE list_extract([0.5, 1.5, 3.5], CAST(least(tries, 3) AS INT))::DOUBLE END AS waited FROM a""")
def ingest_retries(spark, sf_dir):
    """Each item by itself: passing errors are tried again after 0.5, 1 and 2 s, others are recorded at once (L1, L2)."""
    e = table(spark, sf_dir, "events").select("event_id", "event_type", (F.get_json_object("props", "$.k").cast("long") % 5).alias("tries"))
    error, tries = F.col("event_type") == "error", F.col("tries")
    again = error & (tries > 0)
    status = F.when(error & (tries >= 4), "failed").when(error & (tries == 0), "rejected").otherwise("done")
    waited = F.aggregate(F.slice(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0)), F.lit(1), F.least(tries, F.lit(3)).cast("int")), F.lit(0.0), lambda x, y: x + y)
    return e.select("event_id", status.alias("status"), F.when(again, F.least(tries, F.lit(3)) + 1).otherwise(1).cast("long").alias("attempts"), F.when(again, waited).otherwise(0.0).alias("waited"))


@query("""SELECT c_custkey, CASE WHEN failed = 0 THEN 'completed' WHEN failed = n THEN 'failed' ELSE 'completed_with_errors' END AS status, n, failed FROM (SELECT o_custkey AS c_custkey, CAST(count(*) AS BIGINT) AS n, CAST(count(*) FILTER (o_orderstatus = 'P') AS BIGINT) AS failed FROM orders GROUP BY o_custkey)""")
def job_status(spark, sf_dir):
    """How a run ended, by its items."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("failed"))
    return n.select("c_custkey", F.when(F.col("failed") == 0, "completed").when(F.col("failed") == F.col("n"), "failed").otherwise("completed_with_errors").alias("status"), "n", "failed")


@query("""SELECT doc_id, substr(text, 1, 4000) AS message, right(text, 6000) AS traceback, substr(coalesce(nullif(trim(lang), ''), 'folder-' || doc_id), 1, 1000) AS url FROM documents""")
def error_records(spark, sf_dir):
    """Error records: the head of a message, the tail of a trace, the folder where there is no url."""
    url = F.coalesce(F.nullif(F.trim("lang"), F.lit("")), F.concat(F.lit("folder-"), F.col("doc_id").cast("string")))
    return table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 4000).alias("message"), F.right("text", F.lit(6000)).alias("traceback"), F.substring(url, 1, 1000).alias("url"))


@query("SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '1998-01-01 12:00:00' - INTERVAL 12 HOUR THEN 'failed' WHEN o_orderstatus = 'O' THEN 'running' ELSE 'finished' END AS status FROM orders")
def reap_jobs(spark, sf_dir):
    """Runs that have lasted over twelve hours are given up (L3)."""
    old = F.col("o_orderdate").cast("timestamp_ntz") < F.expr("TIMESTAMP_NTZ '1998-01-01 12:00:00' - INTERVAL 12 HOUR")
    running = F.col("o_orderstatus") == "O"
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(running & old, "failed").when(running, "running").otherwise("finished").alias("status"))


_DECIDE = """o AS (SELECT event_id, user_id, ts, event_type AS content, CAST(floor(value) AS BIGINT) % 3 AS source, event_id % 11 = 0 AS late FROM events),
k AS (SELECT *, NOT late AS applied FROM o), a AS (SELECT *, lag(content) OVER w AS content_before, lag(source) OVER w AS source_before, row_number() OVER w AS n FROM k WHERE applied WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""


@query(f"""WITH {_DECIDE} SELECT event_id, CASE WHEN n = 1 THEN 'new' WHEN source IS NOT DISTINCT FROM source_before OR content IS NOT DISTINCT FROM content_before THEN 'unchanged' ELSE 'updated' END AS outcome FROM a UNION ALL SELECT event_id, 'skipped' FROM k WHERE NOT applied""")
def ingest_outcomes(spark, sf_dir):
    """Outcome of each observation: the same source bytes or the same text change nothing, late ones are skipped."""
    o = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.col("event_type").alias("content"), (F.floor("value") % 3).alias("source"))
    late = F.col("event_id") % 11 == 0
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    same = F.col("source").eqNullSafe(F.lag("source").over(w)) | F.col("content").eqNullSafe(F.lag("content").over(w))
    applied = o.where(~late).select("event_id", F.when(F.row_number().over(w) == 1, "new").when(same, "unchanged").otherwise("updated").alias("outcome"))
    return applied.unionByName(o.where(late).select("event_id", F.lit("skipped").alias("outcome")))


@query("""WITH v AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS seen, o_orderstatus = 'P' AS edition, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n, count(*) OVER (PARTITION BY o_custkey) AS m FROM orders)
SELECT o_orderkey, CASE WHEN edition THEN seen - 10 WHEN n = 1 AND o_orderkey % 2 = 0 THEN seen - 30 ELSE seen END AS valid_from, CASE WHEN edition THEN 'edition' WHEN n = 1 AND o_orderkey % 2 = 0 THEN 'published' ELSE 'observed' END AS source,
 NOT edition AND n = 1 AND m = 1 AND o_orderkey % 2 <> 0 AS may_be_upgraded FROM v""")
def version_starts(spark, sf_dir):
    """Start of a new version: its edition, for the first one what is known, else the day it was seen; a guess on an only version may be bettered."""
    own = Window.partitionBy("o_custkey")
    first, only = F.row_number().over(own.orderBy("o_orderkey")) == 1, F.count(F.lit(1)).over(own) == 1
    v = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("seen"), (F.col("o_orderstatus") == "P").alias("edition"), first.alias("first"), only.alias("only"), (F.col("o_orderkey") % 2 == 0).alias("published"))
    known = F.col("first") & F.col("published")
    start = F.when(F.col("edition"), F.date_sub("seen", 10)).when(known, F.date_sub("seen", 30)).otherwise(F.col("seen"))
    source = F.when(F.col("edition"), "edition").when(known, "published").otherwise("observed")
    return v.select("o_orderkey", start.alias("valid_from"), source.alias("source"), ((source == "observed") & F.col("first") & F.col("only")).alias("may_be_upgraded"))


@query("SELECT l_orderkey, arg_min(l_partkey, CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey) FILTER (l_returnflag = 'R') AS primary_part, bool_and(nullif(trim(l_linestatus), '') IS NULL) AS blank FROM lineitem GROUP BY l_orderkey")
def primary_snapshot(spark, sf_dir):
    """The first file of the primary role, and whether a value is blank."""
    first = F.min(F.when(F.col("l_returnflag") == "R", F.struct("l_linenumber", "l_partkey")))["l_partkey"]
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(first.alias("primary_part"), F.bool_and(F.nullif(F.trim("l_linestatus"), F.lit("")).isNull()).alias("blank"))


@query("""SELECT url, CAST(min(priority) AS BIGINT) AS priority FROM (SELECT DISTINCT regexp_extract(url, '^[^?#]*', 0) AS url, 40 AS priority FROM pages UNION ALL SELECT 'https://' || l, 20 FROM (SELECT unnest(regexp_extract_all(html, 'href="/([^"?#]*)"', 1)) AS l FROM pages)) GROUP BY url""")
def seed_queue(spark, sf_dir):
    """Seeds at priority 40 and links at 20: each url once, with its best."""
    pages = table(spark, sf_dir, "pages")
    seeds = pages.select(F.regexp_extract("url", "^[^?#]*", 0).alias("url"), F.lit(40).alias("priority"))
    links = pages.select(F.explode(F.regexp_extract_all("html", F.lit('href="/([^"?#]*)"'), F.lit(1))).alias("path"))
    links = links.select(F.concat(F.lit("https://"), "path").alias("url"), F.lit(20).alias("priority"))
    return seeds.unionByName(links).groupBy("url").agg(F.min("priority").cast("long").alias("priority"))


@query("""WITH r AS (SELECT o_custkey, CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(count(*) % 9 AS BIGINT) END AS site, CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE CAST(count(*) FILTER (o_orderstatus = 'F') AS BIGINT) END AS ours FROM orders GROUP BY o_custkey)
SELECT o_custkey, site, ours, site - ours AS missing, CASE WHEN site > 0 AND ours IS NOT NULL THEN least(100.0::DOUBLE, round_even(CAST(100.0 * ours / site AS DECIMAL(18, 6)), 1)::DOUBLE) END AS coverage, coalesce(ours > site, false) AS more_than_site,
 site - lag(site) OVER (ORDER BY o_custkey) AS site_change FROM r""")
def comparison_rows(spark, sf_dir):
    """Rows of a comparison with the site; unknown sides say nothing."""
    n = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("f"))
    r = n.select("o_custkey", F.when(F.col("o_custkey") % 7 != 0, F.col("n") % 9).alias("site"), F.when(F.col("o_custkey") % 5 != 0, F.col("f")).alias("ours"))
    share = F.bround((100 * F.col("ours") / F.nullif("site", F.lit(0))).cast("decimal(18,6)"), 1).cast("double")
    before = F.lag("site").over(Window.orderBy("o_custkey"))
    return r.select("o_custkey", "site", "ours", (F.col("site") - F.col("ours")).alias("missing"), F.when(F.col("ours").isNotNull() & (F.col("site") > 0), F.least(F.lit(100.0), share)).alias("coverage"), F.coalesce(F.col("ours") > F.col("site"), F.lit(False)).alias("more_than_site"), (F.col("site") - before).alias("site_change"))


@query("""SELECT event_id, CASE WHEN code IN (200, 203) THEN 'done' WHEN code = 304 THEN 'unchanged' WHEN code IN (301, 302, 303, 307, 308) THEN 'redirect' WHEN code = 429 THEN 'cool_down' WHEN code IN (404, 410) THEN 'gone' WHEN code IN (401, 403) THEN 'blocked' WHEN code >= 500 OR code = 408 THEN 'retry' ELSE 'failed' END AS outcome
 FROM (SELECT event_id, list_extract([200, 304, 302, 429, 404, 403, 503, 408, 418, 203, 410], CAST(event_id % 11 AS INT) + 1) AS code FROM events)""")
def response_outcome(spark, sf_dir):
    """What a response's status leads to (SRC12)."""
    codes = F.array(*[F.lit(c) for c in (200, 304, 302, 429, 404, 403, 503, 408, 418, 203, 410)])
    code = F.element_at(codes, (F.col("event_id") % 11).cast("int") + 1)
    out = F.when(code.isin(200, 203), "done").when(code == 304, "unchanged").when(code.isin(301, 302, 303, 307, 308), "redirect").when(code == 429, "cool_down").when(code.isin(404, 410), "gone").when(code.isin(401, 403), "blocked").when((code >= 500) | (code == 408), "retry").otherwise("failed")
    return table(spark, sf_dir, "events").select("event_id", out.alias("outcome"))

"""Text, url, html and hash queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import html, text, urls
from .common import query, table

_CLEAN = "replace(replace(nfc_normalize(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g')), chr(160), ' '), chr(8203), '')"
_KEY = """trim(regexp_replace(
  regexp_replace(regexp_replace(
    translate(lower(replace(replace(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g'), chr(160), ' '), chr(8203), '')), 'ʻʼ’‘`´′ʹ''‛', ''),
  '([\\p{L}\\p{N}_])-([\\p{L}\\p{N}_])', '\\1 \\2', 'g'), '([\\p{L}\\p{N}_])-([\\p{L}\\p{N}_])', '\\1 \\2', 'g'),
  '\\s+', ' ', 'g'))"""


@query(f"SELECT doc_id, sha256({_CLEAN}) AS clean_sha256, CAST(length({_CLEAN}) AS BIGINT) AS clean_chars FROM documents")
def text_clean(spark, sf_dir):
    """Control characters, composition and odd spaces."""
    c = table(spark, sf_dir, "documents").select("doc_id", text.clean(F.col("text")).alias("c"))
    return c.select("doc_id", F.sha2("c", 256).alias("clean_sha256"), F.length("c").cast("long").alias("clean_chars"))


@query(f"SELECT doc_id, sha256({_KEY}) AS key_sha256 FROM documents")
def text_search_key(spark, sf_dir):
    """Search key on the Latin path."""
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.search_key(F.col("text")), 256).alias("key_sha256"))


@query("SELECT c_custkey, trim(regexp_replace(lower(c_name), '[^a-z0-9]+', '-', 'g'), '-') AS number_key FROM customer")
def text_number_key(spark, sf_dir):
    """Exact number lookup key (F16, FLT10)."""
    return table(spark, sf_dir, "customer").select("c_custkey", text.number_key(F.col("c_name")).alias("number_key"))


@query("""SELECT doc_id, CASE WHEN length(text) = 0 THEN 0 ELSE CAST(greatest(ceil(length(text) / CASE WHEN
 length(regexp_replace(text, '[^Ѐ-ӿ]', '', 'g')) > 0.4::DOUBLE * length(text) THEN 2.2::DOUBLE ELSE 3.2::DOUBLE END), 1) AS BIGINT) END AS token_count FROM documents""")
def text_token_count(spark, sf_dir):
    """Estimated tokens."""
    return table(spark, sf_dir, "documents").select("doc_id", text.token_count(F.col("text")).alias("token_count"))


@query("""WITH c AS (SELECT doc_id, text, CAST(length(regexp_replace(text, '[^Ѐ-ӿ]', '', 'g')) AS BIGINT) AS cyr,
  CAST(length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS BIGINT) AS lat, regexp_extract_all(lower(text), '[a-z]+') AS words FROM documents),
e AS (SELECT *, len(list_filter(words, lambda w: w IN ('the','of','and','to','on','in','for','a','is','be','shall','by','with','as','measures','approval'))) / greatest(len(words), 1)::DOUBLE >= 0.12 AS english,
  regexp_matches(text, '(?i)(?:[og][ʻʼ’‘''`]|(?:^|[^0-9A-Za-z_])(?:va|uchun|bilan|toʻgʻrisida|to''g''risida|qaror|farmon|buyruq|son|yil)(?:$|[^0-9A-Za-z_]))') AS uzbek FROM c)
SELECT doc_id, cyr AS cyrillic, lat AS latin,
  CASE WHEN cyr + lat = 0 THEN '' WHEN cyr >= lat THEN (CASE WHEN cyr + lat < 60 THEN '' ELSE 'ru' END) WHEN uzbek THEN 'uz' WHEN english THEN 'en' ELSE 'uz' END AS language,
  CASE WHEN cyr + lat = 0 THEN '' WHEN cyr >= lat THEN 'cyrl' ELSE 'latn' END AS script,
  CASE WHEN cyr + lat = 0 THEN false WHEN cyr >= lat THEN cyr + lat >= 60 WHEN uzbek THEN true ELSE english AND len(words) >= 6 END AS confident FROM e""")
def text_language_counts(spark, sf_dir):
    """Language and script by markers."""
    t = F.col("text")
    guess = text.language_guess(t)
    return table(spark, sf_dir, "documents").select("doc_id", F.regexp_count(t, F.lit(text.CYRILLIC)).cast("long").alias("cyrillic"), F.regexp_count(t, F.lit("[A-Za-z]")).cast("long").alias("latin"), *[v.alias(k) for k, v in guess.items()])


@query("""SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, CAST(list_max(list_transform(s, lambda x: length(x))) AS BIGINT) AS longest FROM (
 SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?;:])\\s+', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS s FROM documents)""")
def text_sentence_split(spark, sf_dir):
    """Sentence units of an oversized text."""
    s = table(spark, sf_dir, "documents").select("doc_id", text.sentences(F.col("text")).alias("s"))
    return s.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.array_max(F.transform("s", lambda x: F.length(x))).cast("long").alias("longest"))


@query("""SELECT p_partkey, CASE WHEN length(p_name) <= 20 THEN p_name ELSE substr(p_name, 1, 17) || '...' END AS short_name,
 coalesce(nullif(trim(regexp_replace(p_brand, '[^A-Za-z0-9_]+', '_', 'g'), '_'), ''), 'x') AS label FROM part""")
def short_title(spark, sf_dir):
    """Short titles and path labels (PRJ2, F18)."""
    name = F.col("p_name")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(F.length(name) <= 20, name).otherwise(F.concat(F.substring(name, 1, 17), F.lit("..."))).alias("short_name"), text.path_label(F.col("p_brand")).alias("label"))


_URL = "'^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$'"


@query(f"""SELECT page_id, CASE WHEN lower(regexp_extract(url, {_URL}, 1)) IN ('http', 'https') THEN 'https://' || lower(regexp_extract(url, {_URL}, 2)) ||
 CASE WHEN p = '' THEN '/' ELSE p END || CASE WHEN q = '' THEN '' ELSE '?' || q END END AS url FROM (
 SELECT page_id, url, regexp_replace(regexp_extract(url, {_URL}, 3), '^/(?:en|de|fr|es)/', '/') AS p,
 array_to_string(list_sort(list_filter(string_split(regexp_extract(url, {_URL}, 4), '&'), lambda x: x <> '')), '&') AS q FROM pages)""")
def url_normalize(spark, sf_dir):
    """One form of a url (F1)."""
    return table(spark, sf_dir, "pages").select("page_id", urls.normalized(F.col("url")).alias("url"))


@query(f"""SELECT page_id, regexp_extract(url, {_URL}, 1) || '://' || regexp_extract(url, {_URL}, 2) || regexp_extract(url, {_URL}, 3) || '?' ||
 array_to_string(list_sort(list_append(list_filter(string_split(regexp_extract(url, {_URL}, 4), '&'), lambda x: x <> '' AND split_part(x, '=', 1) NOT IN ('page', 'ref')), 'page=7')), '&') AS url FROM pages""")
def url_with_query(spark, sf_dir):
    """Parameters set and removed."""
    return table(spark, sf_dir, "pages").select("page_id", urls.with_query(F.col("url"), page="7", ref=None).alias("url"))


@query(f"""SELECT page_id, regexp_extract(regexp_extract(url, {_URL}, 3), '^(?:/[a-z]{{2}})?/(-?\\d+)/?(?:\\.html)?$', 1) AS external_id,
 CASE WHEN regexp_extract(url, {_URL}, 1) = '' THEN 'invalid' WHEN regexp_matches(regexp_extract(url, {_URL}, 4), '(?:^|&)(?:utm_|ref=)') THEN 'tracked'
 WHEN ends_with(regexp_extract(url, {_URL}, 3), '.html') THEN 'document_html'
 WHEN regexp_extract(regexp_extract(url, {_URL}, 3), '^(?:/[a-z]{{2}})?/(-?\\d+)/?(?:\\.html)?$', 1) <> '' THEN 'document' ELSE 'other' END AS kind FROM pages""")
def url_route(spark, sf_dir):
    """A url's document and queue kind (F2, F3, F6, F8, FLT7)."""
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.identity(u).alias("external_id"), urls.route(u).alias("kind"))


@query("""SELECT page_id, link, CAST(count(*) AS BIGINT) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages) GROUP BY page_id, link""")
def page_links(spark, sf_dir):
    """Links of a page."""
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1))).alias("link"))
    return links.groupBy("page_id", "link").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, CAST(length(html) AS BIGINT) AS chars FROM pages""")
def page_title(spark, sf_dir):
    """Title of a page (F32)."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("html", "(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.length("html").cast("long").alias("chars"))


@query()
def html_to_text(spark, sf_dir):
    """Text as a browser shows it."""
    return table(spark, sf_dir, "pages").select("page_id", html.to_text("html").alias("text"))


@query()
def table_structure(spark, sf_dir):
    """Cells of a page's tables with their spans; a table of its id and url stands at its end."""
    made = F.concat("html", F.lit("<table><tr><th rowspan=2>Page</th><td>"), F.col("page_id").cast("string"), F.lit("</td></tr><tr><td colspan='2'>"), F.col("url"), F.lit("</td></tr></table>"))
    return table(spark, sf_dir, "pages").select("page_id", html.to_tables(made).alias("tables"))


@query("""SELECT sha256(text) AS digest, min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies, 'raw/' || substr(sha256(text), 1, 2) || '/' || sha256(text) AS key FROM documents GROUP BY text""")
def hash_dedupe(spark, sf_dir):
    """Content-addressed store (F20, SNK1, SNK3, A16)."""
    d = F.sha2("text", 256)
    kept = table(spark, sf_dir, "documents").groupBy(d.alias("digest")).agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    return kept.withColumn("key", F.concat(F.lit("raw/"), F.substring("digest", 1, 2), F.lit("/"), "digest"))


@query("""SELECT doc_id, CASE WHEN length(text) >= 100 THEN sha256(text) ELSE sha256('raw:' || source) END AS content_hash, md5(lang || chr(0) || source) AS fingerprint FROM documents""")
def content_hash_fallback(spark, sf_dir):
    """Content hash, of the source where there is no text to speak of; label fingerprints."""
    h = F.when(F.length("text") >= 100, F.sha2("text", 256)).otherwise(F.sha2(F.concat(F.lit("raw:"), "source"), 256))
    return table(spark, sf_dir, "documents").select("doc_id", h.alias("content_hash"), F.md5(F.concat("lang", F.lit("\0"), "source")).alias("fingerprint"))


@query("""WITH known AS (SELECT doc_id, md5(text || CASE WHEN doc_id % 3 = 0 THEN '!' ELSE '' END) AS fp FROM documents WHERE doc_id % 2 = 0)
SELECT d.doc_id, md5(d.text) AS fp FROM documents d LEFT JOIN known k ON k.doc_id = d.doc_id AND k.fp = md5(d.text) WHERE k.doc_id IS NULL""")
def fingerprint_skip(spark, sf_dir):
    """Only new or changed documents go on to be parsed (FLT12, F21)."""
    docs = table(spark, sf_dir, "documents")
    known = docs.where("doc_id % 2 = 0").select("doc_id", F.md5(F.concat("text", F.when(F.col("doc_id") % 3 == 0, "!").otherwise(""))).alias("fp"))
    return docs.select("doc_id", F.md5("text").alias("fp")).join(known, ["doc_id", "fp"], "left_anti")

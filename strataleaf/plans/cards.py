"""Card, passport, annotation and title queries over the given tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import cards as C
from ..functions import text as X
from .common import query, table

_LINE = "'[OKOZ: 1. 01.02.03.' || lpad(CAST(p_size AS VARCHAR), 2, '0') || ' ' || p_brand || ' / ' || p_type || '; 2. no description; 3. plain / ' || p_name || '] text [ТСЗ : 1. ' || p_type || ' / 09.00.00.' || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') || ' x] [odd: 1. ]'"


@query(rf"""WITH g AS (SELECT p_partkey, unnest(regexp_extract_all({_LINE}, '\[([^\]:\[]+):([^\]]*)\]', 1)) AS name, unnest(regexp_extract_all({_LINE}, '\[([^\]:\[]+):([^\]]*)\]', 2)) AS body FROM part),
e AS (SELECT p_partkey, lower(trim(name)) AS name, trim(regexp_replace(unnest(string_split(regexp_replace(trim(body), ';\s*(\d+\.\s)', chr(1) || '\1', 'g'), chr(1))), '^\s*\d+\.\s*', ''), ' ;') AS entry FROM g),
i AS (SELECT *, list_filter(list_transform(string_split(entry, ' / '), lambda x: trim(x)), lambda x: x <> '') AS items FROM e WHERE entry <> '' AND NOT regexp_matches(entry, '(?i)no description') AND NOT regexp_matches(entry, '^\d+\.$'))
SELECT p_partkey, CASE WHEN name IN ('okoz', 'окоз', 'lqbl') THEN 'okoz' WHEN name IN ('tsz', 'тсз', 'tdl') THEN 'tsz' ELSE name END AS system,
 coalesce(list_extract(list_filter(list_transform(items, lambda x: regexp_extract(x, '^(\d{{2}}(?:\.\d{{2}}){{3}})\s', 1)), lambda x: x <> ''), -1), '') AS code, array_to_string(items, ' / ') AS label FROM i""")
def classification_rows(spark, sf_dir):
    """Rows of classification lines: system, code of the last part that has one, label."""
    size, k = F.lpad(F.col("p_size").cast("string"), 2, "0"), F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0")
    raw = F.concat(F.lit("[OKOZ: 1. 01.02.03."), size, F.lit(" "), "p_brand", F.lit(" / "), "p_type", F.lit("; 2. no description; 3. plain / "), "p_name", F.lit("] text [ТСЗ : 1. "), "p_type", F.lit(" / 09.00.00."), k, F.lit(" x] [odd: 1. ]"))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.explode(C.classifications(raw)).alias("c"))
    return rows.select("p_partkey", "c.*").where(~F.col("label").rlike(r"^\d+\.$"))


@query(r"""WITH b AS (SELECT user_id, event_id, list_extract(['INDEXES_ON_REF', 'PUBLICATION_ORIGIN', 'COMMENT_FOR_WARNING', 'COMMENT', 'OTHER'], CAST(event_id % 5 AS INT) + 1) AS css, strftime(ts, '%d.%m.%Y') || ' 03/24/' || event_id || '/0 ' || event_type AS text FROM events)
SELECT user_id, arg_min(strptime(text[1:10], '%d.%m.%Y')::DATE, event_id) FILTER (css = 'PUBLICATION_ORIGIN') AS published_at, arg_min(regexp_extract(text, '(\d{2}/\d{2}/\d+/\d+)', 1), event_id) FILTER (css = 'PUBLICATION_ORIGIN') AS registry_number,
 CAST(count(*) FILTER (css = 'COMMENT_FOR_WARNING') AS BIGINT) AS warnings, CAST(count(*) FILTER (css = 'COMMENT') AS BIGINT) AS comments, CAST(count(*) FILTER (css = 'OTHER') AS BIGINT) AS other, CAST(count(DISTINCT text) FILTER (css = 'INDEXES_ON_REF') AS BIGINT) AS indexed FROM b GROUP BY user_id""")
def annotations_route(spark, sf_dir):
    """Annotation blocks by class: the first day and registry number win, others are gathered."""
    classes = ("INDEXES_ON_REF", "PUBLICATION_ORIGIN", "COMMENT_FOR_WARNING", "COMMENT", "OTHER")
    css = F.element_at(F.array(*[F.lit(c) for c in classes]), (F.col("event_id") % 5).cast("int") + 1)
    text = F.concat(F.date_format("ts", "dd.MM.yyyy"), F.lit(" 03/24/"), F.col("event_id").cast("string"), F.lit("/0 "), "event_type")
    b = table(spark, sf_dir, "events").select("user_id", "event_id", css.alias("css"), text.alias("text"))
    kind = F.when(F.col("css").contains("INDEXES_ON_REF"), "indexed").when(F.col("css").contains("PUBLICATION_ORIGIN"), "origin").when(F.col("css").contains("COMMENT_FOR_WARNING"), "warning").when(F.col("css").contains("COMMENT"), "comment").otherwise("other")
    b = b.withColumn("kind", kind).withColumn("day", X.to_date(F.col("text"))).withColumn("number", F.nullif(C.registry_number(F.col("text")), F.lit("")))
    first = lambda value: F.min(F.when((F.col("kind") == "origin") & F.col(value).isNotNull(), F.struct("event_id", value)))[value]
    some = lambda name: F.count_if(F.col("kind") == name)
    return b.groupBy("user_id").agg(first("day").alias("published_at"), first("number").alias("registry_number"), some("warning").alias("warnings"), some("comment").alias("comments"), some("other").alias("other"), F.count_distinct(F.when(F.col("kind") == "indexed", F.col("text"))).alias("indexed"))


_REQ = "CASE o_orderkey % 4 WHEN 0 THEN 'Agency ' || o_custkey || ' qarori, ' || strftime(o_orderdate, '%d.%m.%Y') || ' yildagi ' || o_orderkey || '-son' WHEN 1 THEN 'Вазирлик ' || o_custkey || ', ' || strftime(o_orderdate, '%d.%m.%Y') || ' йилдаги ПҚ-' || o_orderkey || '-сон' WHEN 2 THEN 'Закон, ' || strftime(o_orderdate, '%d.%m.%Y') || ' г. ' || o_orderkey ELSE 'no requisites ' || o_orderkey END"
_REQ_RE = r"'^(.+?),\s*(\d{2}\.\d{2}\.\d{4})\s*(?:йилдаги|yildagi|г\.?|от)?\s*(\S+?)(?:-(?:сон|son))?\s*$'"


@query(rf"""WITH r AS (SELECT o_orderkey, {_REQ} AS raw FROM orders), p AS (SELECT *, regexp_extract(raw, {_REQ_RE}, 1) AS who, regexp_extract(raw, {_REQ_RE}, 2) AS day FROM r)
SELECT o_orderkey, CASE WHEN ends_with(who, ' qarori') THEN regexp_extract(who, '^(.*) \S+$', 1) ELSE who END AS authority, CASE WHEN ends_with(who, ' qarori') THEN 'qarori' ELSE '' END AS document_form, CASE WHEN day <> '' THEN strptime(day, '%d.%m.%Y')::DATE END AS adopted_at, regexp_extract(raw, {_REQ_RE}, 3) AS document_number FROM p""")
def passport_requisites(spark, sf_dir):
    """Who adopted what and when, from one line."""
    key, who, day = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.date_format("o_orderdate", "dd.MM.yyyy")
    k = F.col("o_orderkey") % 4
    raw = F.when(k == 0, F.concat(F.lit("Agency "), who, F.lit(" qarori, "), day, F.lit(" yildagi "), key, F.lit("-son"))).when(k == 1, F.concat(F.lit("Вазирлик "), who, F.lit(", "), day, F.lit(" йилдаги ПҚ-"), key, F.lit("-сон")))
    raw = raw.when(k == 2, F.concat(F.lit("Закон, "), day, F.lit(" г. "), key)).otherwise(F.concat(F.lit("no requisites "), key))
    return table(spark, sf_dir, "orders").select("o_orderkey", *[v.alias(n) for n, v in C.passport(raw).items()])


_LABELLED = ("Ҳужжат тури", "Document form", "Статус документа", "unknown", "Дата вступления в силу", "Document type", "x")


@query(rf"""WITH p AS (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, count(*) OVER (PARTITION BY o_custkey) AS n, list_extract([{', '.join("'" + x + "'" for x in _LABELLED)}], CAST(o_orderkey % 7 AS INT) + 1) AS label FROM orders),
f AS (SELECT *, coalesce(CASE label WHEN 'Ҳужжат тури' THEN 'doc_type' WHEN 'Document form' THEN 'doc_form' WHEN 'Статус документа' THEN 'status' WHEN 'Дата вступления в силу' THEN 'effective_from' WHEN 'Document type' THEN 'doc_type' END, CASE WHEN n = {len(C.CELLS)} THEN list_extract([{', '.join("'" + c + "'" for c in C.CELLS)}], pos) END) AS field FROM p)
SELECT o_custkey, field, arg_min(CAST(o_orderkey AS VARCHAR), pos) AS value FROM f WHERE field IS NOT NULL GROUP BY o_custkey, field""")
def card_values(spark, sf_dir):
    """Fields of a card by label, by place only where all cells are there; the first wins."""
    label = F.element_at(F.array(*[F.lit(x) for x in _LABELLED]), (F.col("o_orderkey") % 7).cast("int") + 1)
    cells = F.sort_array(F.collect_list(F.struct(F.col("o_orderkey").alias("at"), label.alias("label"), F.col("o_orderkey").cast("string").alias("value"))))
    rows = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(cells.alias("pairs"))
    return rows.select("o_custkey", F.explode(C.card_fields(F.col("pairs"))).alias("field", "value"))


_TITLE = "CASE o_orderkey % 5 WHEN 0 THEN 'PQ-' || o_orderkey || '-son ' || strftime(o_orderdate, '%d.%m.%Y') || '. About ' || o_orderpriority WHEN 1 THEN strftime(o_orderdate, '%d.%m.%Y') || '. Treaty ' || o_custkey WHEN 2 THEN '31.02.2026. Nonsense ' || o_custkey WHEN 3 THEN 'ПҚ-' || o_orderkey || '-СОН ' || strftime(o_orderdate, '%d.%m.%Y') || '. Йўл' ELSE 'No number ' || o_orderkey END"


@query(rf"""WITH r AS (SELECT o_orderkey, {_TITLE} AS raw FROM orders), p AS (SELECT *, regexp_matches(raw, '(?i)-(сон|son) \d') AS full_, regexp_extract(raw, '^(\d{{2}}\.\d{{2}}\.\d{{4}})\. ', 1) AS day FROM r)
SELECT o_orderkey, CASE WHEN full_ THEN regexp_extract(raw, '(?i)^(.+?)-(?:сон|son) ', 1) ELSE '' END AS number, CASE WHEN full_ THEN strptime(regexp_extract(raw, '(\d{{2}}\.\d{{2}}\.\d{{4}})', 1), '%d.%m.%Y')::DATE ELSE try_strptime(day, '%d.%m.%Y')::DATE END AS dated,
 CASE WHEN full_ THEN regexp_extract(raw, '\d{{4}}\. (.*)$', 1) WHEN try_strptime(day, '%d.%m.%Y') IS NOT NULL THEN raw[13:] ELSE raw END AS title FROM p""")
def text_title_parse(spark, sf_dir):
    """Number, date and title of every kind of title."""
    key, day, k = F.col("o_orderkey").cast("string"), F.date_format("o_orderdate", "dd.MM.yyyy"), F.col("o_orderkey") % 5
    raw = F.when(k == 0, F.concat(F.lit("PQ-"), key, F.lit("-son "), day, F.lit(". About "), "o_orderpriority")).when(k == 1, F.concat(day, F.lit(". Treaty "), F.col("o_custkey").cast("string")))
    raw = raw.when(k == 2, F.concat(F.lit("31.02.2026. Nonsense "), F.col("o_custkey").cast("string"))).when(k == 3, F.concat(F.lit("ПҚ-"), key, F.lit("-СОН "), day, F.lit(". Йўл"))).otherwise(F.concat(F.lit("No number "), key))
    return table(spark, sf_dir, "orders").select("o_orderkey", *[v.alias(n) for n, v in X.title_parts(raw).items()])


_STATUSES = ("Действует", "Утратил силу", "Не  вступил в силу", "In force since", "Amalda", "бекор қилинган", " ", "something", "kuchga kirmagan", "not yet valid", "Repealed", "reactive")


@query(rf"""WITH r AS (SELECT o_orderkey, lower(trim(list_extract([{', '.join("'" + x + "'" for x in _STATUSES)}], CAST(o_orderkey % {len(_STATUSES)} AS INT) + 1) || CASE WHEN o_orderkey % 2 = 0 THEN ' ' || o_custkey ELSE '' END)) AS raw FROM orders)
SELECT o_orderkey, CASE WHEN raw = '' THEN 'unknown' WHEN regexp_matches(raw, 'не\s+вступил|kuchga\s+kirmagan|кучга\s+кирмаган|not\s+yet') THEN 'not_yet_effective' WHEN regexp_matches(raw, 'утрат|бекор|bekor|йўқот|yo.?qot|отмен|expired|repealed|lost|прекрат') THEN 'expired'
 WHEN regexp_matches(raw, '^(?:действ|амалда|amalda|in force|active|valid|кучда|kuchda)') THEN 'active' ELSE 'unknown' END AS status FROM r""")
def text_status_map(spark, sf_dir):
    """Status by a card's words: not yet before expired before active."""
    word = F.element_at(F.array(*[F.lit(x) for x in _STATUSES]), (F.col("o_orderkey") % len(_STATUSES)).cast("int") + 1)
    raw = F.concat(word, F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"))).otherwise(""))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.status_of(raw).alias("status"))


@query("""WITH r AS (SELECT o_orderkey, CASE o_orderkey % 5 WHEN 0 THEN o_custkey // 1000 || ' ' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') WHEN 1 THEN '---' WHEN 2 THEN CAST(o_custkey AS VARCHAR) WHEN 3 THEN '–' ELSE o_orderpriority END AS raw FROM orders)
SELECT o_orderkey, CASE WHEN regexp_matches(replace(raw, ' ', ''), '^[-–—]+$') THEN 0 ELSE TRY_CAST(replace(raw, ' ', '') AS BIGINT) END AS number FROM r""")
def text_plain_number(spark, sf_dir):
    """Numbers of a statistics page: with spaces, dashes for nothing, null for anything else."""
    c, k = F.col("o_custkey"), F.col("o_orderkey") % 5
    spaced = F.concat(F.floor(c / 1000).cast("string"), F.lit(" "), F.lpad((c % 1000).cast("string"), 3, "0"))
    raw = F.when(k == 0, spaced).when(k == 1, "---").when(k == 2, c.cast("string")).when(k == 3, "–").otherwise(F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select("o_orderkey", X.plain_number(raw).alias("number"))


@query("""WITH w AS (SELECT c_custkey, translate(lower(c_mktsegment), 'abcdefghijklmnoprstuvyz', 'абкдефгҳижклмнопрстувйз') AS word FROM customer),
e AS (SELECT c_custkey, word, regexp_replace(word, '(^|[^\\p{L}])е', '\\1ye', 'g') AS a FROM w), f AS (SELECT c_custkey, word, regexp_replace(regexp_replace(a, '([аеёиоуўэюяыъь])е', '\\1ye', 'g'), 'ye', '§', 'g') AS a FROM e)
SELECT c_custkey, word, replace(translate(translate(a, 'е', 'e'), 'абвгдийклмнопрстуфҳжзғ', 'abvgdiyklmnoprstufhjzg'), '§', 'ye') AS latin FROM f""")
def translit_cyrillic(spark, sf_dir):
    """Cyrillic to Latin: е by what stands before it."""
    word = F.translate(F.lower("c_mktsegment"), "abcdefghijklmnoprstuvyz", "абкдефгҳижклмнопрстувйз")
    return table(spark, sf_dir, "customer").select("c_custkey", word.alias("word")).withColumn("latin", X.cyrillic_to_latin(F.col("word")))


@query("""WITH q AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'Ўзбекистон ' || c_custkey WHEN 1 THEN lower(c_name) ELSE chr(1053) || 'igher ' || c_custkey END AS query FROM customer)
SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'ўзбекистон ' || c_custkey || '|ozbekiston ' || c_custkey WHEN 1 THEN regexp_replace(query, '([\\p{L}\\p{N}_])-([\\p{L}\\p{N}_])', '\\1 \\2', 'g') ELSE replace(query, chr(1053), 'h') END AS variants FROM q""")
def script_variants(spark, sf_dir):
    """One or two search keys of a query: as written and, from Cyrillic, in Latin."""
    key, k = F.col("c_custkey").cast("string"), F.col("c_custkey") % 3
    raw = F.when(k == 0, F.concat(F.lit("Ўзбекистон "), key)).when(k == 1, F.lower("c_name")).otherwise(F.concat(F.lit("Нigher "), key))
    rows = table(spark, sf_dir, "customer").select("c_custkey", X.search_key(raw).alias("base"))
    latin = F.when(X.has_cyrillic(F.col("base")), X.search_key(X.cyrillic_to_latin(F.col("base"))))
    return rows.select("c_custkey", F.array_join(F.array_distinct(F.filter(F.array("base", latin), lambda x: x.isNotNull())), "|").alias("variants"))


@query("""SELECT l_orderkey, CAST(count(*) AS BIGINT) AS total, count(*) FILTER (l_linenumber = 1) = 1 AS one_total_row, sum(CASE WHEN l_returnflag IN ('A', 'N', 'R') THEN 1 ELSE 0 END) = count(*) AS kinds_agree, sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) + sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) = count(*) AS statuses_agree,
 sum(CAST(l_quantity AS BIGINT)) = sum(CASE WHEN l_linenumber <= 3 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS forms_agree, max(l_linenumber) = count(*) AS header_agrees, min(l_quantity) >= 0 AS no_negative FROM lineitem GROUP BY l_orderkey""")
def statistics_self_check(spark, sf_dir):
    """Six checks of a statistics page against its own totals."""
    n = F.count(F.lit(1))
    part = lambda when, value=1: F.sum(F.when(when, value).otherwise(0))
    quantity, line = F.col("l_quantity").cast("long"), F.col("l_linenumber")
    status = F.col("l_linestatus")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        n.alias("total"), (F.count_if(line == 1) == 1).alias("one_total_row"), (part(F.col("l_returnflag").isin("A", "N", "R")) == n).alias("kinds_agree"), (part(status == "O") + part(status == "F") == n).alias("statuses_agree"),
        (F.sum(quantity) == part(line <= 3, quantity)).alias("forms_agree"), (F.max("l_linenumber") == n).alias("header_agrees"), (F.min("l_quantity") >= 0).alias("no_negative"),
    )


@query("""WITH r AS (SELECT doc_id, lang, source, n_chars FROM documents), m AS (SELECT source, CASE WHEN source < 'src2' THEN 'a' ELSE 'b' END AS category FROM (SELECT DISTINCT source FROM r WHERE source IN ('src0', 'src1', 'src2')))
SELECT CASE WHEN r.n_chars < 200 THEN 'unclassified' WHEN m.category IS NULL THEN 'unmapped: ' || r.source ELSE m.category END AS category, CAST(count(*) AS BIGINT) AS n, CAST(rank() OVER (ORDER BY CASE WHEN any_value(r.n_chars < 200) THEN 1 WHEN any_value(m.category) IS NULL THEN 2 ELSE 0 END, count(*) DESC) AS BIGINT) AS place FROM r LEFT JOIN m USING (source) GROUP BY 1""")
def category_residuals(spark, sf_dir):
    """Rollup with the unclassified and, by size, the kinds nobody mapped."""
    r = table(spark, sf_dir, "documents").select("source", "n_chars")
    category = F.when(F.col("source").isin("src0", "src1"), "a").when(F.col("source") == "src2", "b")
    group = F.when(F.col("n_chars") < 200, 1).when(category.isNull(), 2).otherwise(0)
    name = F.when(group == 1, "unclassified").when(group == 2, F.concat(F.lit("unmapped: "), "source")).otherwise(category)
    found = r.groupBy(name.alias("category"), group.alias("g")).agg(F.count(F.lit(1)).alias("n"))
    return found.select("category", "n", F.rank().over(Window.orderBy("g", F.desc("n"))).cast("long").alias("place"))

"""Full-text and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import retrieval as R
from .common import query, table

_TOKENS = "list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


def _hit(word: str, limit: int, where: str = "") -> str:
    return f"SELECT doc_id, lang, source, round(0.1::DOUBLE * len(list_filter(t, lambda x: x = '{word}')), 6) AS rank FROM (SELECT *, {_TOKENS} AS t FROM documents{where}) WHERE list_contains(t, '{word}') ORDER BY rank DESC, doc_id LIMIT {limit}"


@query(_hit("the", 50))
def fts_single_term(spark, sf_dir):
    """Ranked search for one word."""
    return R.search(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id", "text", [["the"]]).select("doc_id", "lang", "source", "rank")


@query("SELECT doc_id FROM (SELECT doc_id, " + _TOKENS + " AS t FROM documents) WHERE list_contains(t, 'the') AND list_contains(t, 'with') AND list_contains(t, 'from')")
def fts_all_terms_match(spark, sf_dir):
    """All words of a query (R2)."""
    return R.with_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").where(R.matches(F.col("__key"), [["the", "with", "from"]])).select("doc_id")


@query("SELECT doc_id FROM (SELECT doc_id, " + _TOKENS + " AS t FROM documents) WHERE (list_contains(t, 'the') AND list_contains(t, 'from')) OR (list_contains(t, 'der') AND list_contains(t, 'mit'))")
def fts_variants_or(spark, sf_dir):
    """Variants of a query, any of which may match; an empty one matches nothing."""
    return R.with_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").where(R.matches(F.col("__key"), [["the", "from"], ["der", "mit"], []])).select("doc_id")


@query(_hit("de", 20, " WHERE lang = 'es'"))
def fts_language_filter(spark, sf_dir):
    """Language given (FLT3)."""
    return R.search(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"), "doc_id", "text", [["de"]], limit=20, where=F.col("lang") == "es").select("doc_id", "lang", "source", "rank")


@query("WITH hits AS (SELECT doc_id, t FROM (SELECT doc_id, " + _TOKENS + " AS t FROM documents) WHERE list_contains(t, 'and') ORDER BY doc_id LIMIT 200) SELECT doc_id, round(0.1::DOUBLE * len(list_filter(t, lambda x: x = 'and')), 6) AS rank FROM hits ORDER BY rank DESC, doc_id LIMIT 10")
def fts_candidate_cap(spark, sf_dir):
    """Candidates are capped in a fixed order before ranking."""
    return R.search(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", [["and"]], limit=10, candidates=200).select("doc_id", "rank")


@query()
def fts_cover_density(spark, sf_dir):
    """Cover density of several words."""
    found = R.with_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "text").where(R.matches(F.col("__key"), [["the", "with"]]))
    return found.select("doc_id", R.cover_density([["the", "with"]])(F.col("__key")).alias("rank")).orderBy(F.desc("rank"), "doc_id").limit(50)


def _knn(spark, sf_dir, kind):
    vectors = table(spark, sf_dir, "embeddings")
    first = vectors.where("vec_id = 0").select("embedding").first()
    query_vector = first[0] if first else []
    return R.nearest(vectors, "vec_id", "embedding", query_vector, kind).select("vec_id", F.round("distance", 5).alias("distance"))


_Q = "(SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = 0)"


@query(f"SELECT vec_id, round(list_cosine_distance(CAST(embedding AS DOUBLE[]), {_Q}), 5) + 0.0 AS distance FROM embeddings ORDER BY round(list_cosine_distance(CAST(embedding AS DOUBLE[]), {_Q}), 9), vec_id LIMIT 20")
def knn_cosine(spark, sf_dir):
    """Nearest by cosine."""
    return _knn(spark, sf_dir, "cosine").withColumn("distance", F.col("distance") + 0.0)


@query(f"SELECT vec_id, round(list_distance(CAST(embedding AS DOUBLE[]), {_Q}), 5) AS distance FROM embeddings ORDER BY round(list_distance(CAST(embedding AS DOUBLE[]), {_Q}), 9), vec_id LIMIT 20")
def knn_l2(spark, sf_dir):
    return _knn(spark, sf_dir, "l2")


@query(f"SELECT vec_id, round(-list_inner_product(CAST(embedding AS DOUBLE[]), {_Q}), 5) AS distance FROM embeddings ORDER BY round(-list_inner_product(CAST(embedding AS DOUBLE[]), {_Q}), 9), vec_id LIMIT 20")
def knn_inner_product(spark, sf_dir):
    return _knn(spark, sf_dir, "inner")

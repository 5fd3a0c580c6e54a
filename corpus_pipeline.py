"""A training corpus from documents in five stages, each written and read again as the next one's input.

Each stage works on all that its predecessor kept. All but the last return the columns of documents.

Decisions are by row, not by doc_id: a row's key is a 64-bit hash of all its columns, so rows with a null or a
repeated doc_id are told apart, and rows that are equal in every column are one. Null and empty texts: the
language stage drops them (no letter), the n-gram and benchmark stages keep each, the mix takes none (they have
no words), the token file gives them the end id. Empty tables stay empty; other columns are passed on.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataleaf.llm import decontaminate, language, mixing, ngrams, tokenbin
from strataleaf.llm.common import drop, materialize, near, settle

TOKENIZER = "word_bpe_49k.json"


def settled(stage: Callable) -> Callable:
    """A stage that begins with what the ones before it left in memory given back."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        settle(spark)
        return stage(spark, docs, sf_dir)

    return run


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """docs with a key of the whole row, and the key's name, which no column of docs has."""
    name = "__row"
    while name in docs.columns:
        name += "_"
    # Maps have no hash of their own.
    columns = [F.to_json(F.struct(F.col(f"`{c}`"))) if "map<" in kind or kind == "variant" else F.col(f"`{c}`") for c, kind in docs.dtypes]
    return docs.withColumn(name, F.xxhash64(*columns)), name


def as_docs(rows: DataFrame, key: str, *columns: str) -> DataFrame:
    """What an operator reads, with the key for doc_id."""
    return rows.select(F.col(key).alias("doc_id"), *columns)


def without(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """Rows whose key is not among keys (doc_id); these are written first, so the join knows their size."""
    gone = materialize(keys.select(F.col("doc_id").alias(key)).distinct(), "dropped")
    return rows.join(near(gone), key, "left_anti")


@settled
def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents whose language compression cannot tell go."""
    rows, key = keyed(docs)
    told = language.classify(as_docs(rows, key, "text"), language.fit(docs))
    return without(rows, key, told.where("rejected")).select(docs.columns)


@settled
def keep_one_of_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near copies one row of the smallest doc_id stays, a null one last."""
    rows, key = keyed(docs)
    found = ngrams.components(as_docs(rows, key, "text")).groupBy("doc_id", "component_id").agg(F.count(F.lit(1)).alias("equal"))
    found = found.join(rows.select(F.col(key).alias("doc_id"), F.col("doc_id").alias("own")).distinct(), "doc_id")
    first = F.min(F.struct(F.col("own").isNull(), "own", "doc_id"))
    found = materialize(found.join(found.groupBy("component_id").agg(first["doc_id"].alias("stays")), "component_id"), "copies")
    kept = without(rows, key, found.where("doc_id <> stays"))
    return one_each(kept, key, found.where("doc_id = stays AND equal > 1")).select(docs.columns)


def one_each(rows: DataFrame, key: str, repeated: DataFrame) -> DataFrame:
    """rows, with one of each group of equal rows, whose keys are given (as doc_id)."""
    if repeated.isEmpty():
        return rows
    keys = materialize(repeated.select(F.col("doc_id").alias(key)).distinct(), "repeated")
    return rows.join(near(keys), key, "left_anti").unionByName(rows.join(near(keys), key, "left_semi").dropDuplicates([key]))


@settled
def keep_clear_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: documents that hold a benchmark item go."""
    rows, key = keyed(docs)
    return without(rows, key, decontaminate.find(as_docs(rows, key, "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))).select(docs.columns)


@settled
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: each row as often as its source's target takes it."""
    rows, key = keyed(docs)
    taken = mixing.mix(as_docs(rows, key, "text", "source")).groupBy("doc_id").agg(F.sum("copies").alias("__copies"), F.count(F.lit(1)).alias("__equal"))
    taken = materialize(taken.where("__copies > 0"), "mix-copies")
    counted = rows.join(near(taken.select(F.col("doc_id").alias(key), "__copies")), key)
    counted = one_each(counted, key, taken.where("__equal > 1"))
    return counted.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(docs.columns)


@settled
def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: the mix as a token file, read back."""
    import public_tokenizers

    return tokenbin.encode(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language ID", keep_known_language),
    ("n-gram Jaccard join", keep_one_of_copies),
    ("benchmark decontamination", keep_clear_of_benchmark),
    ("mixing sources", mix_sources),
    ("token file", write_tokens),
]

#: Compression, SVD and chance cannot be put in SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline")
        if old is not None:
            drop(old)
        old = docs
    return STAGES[-1][1](spark, docs, sf_dir)

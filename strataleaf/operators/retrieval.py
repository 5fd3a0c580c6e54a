"""Full-text search with ranked hits, cover density, and exact vector neighbours."""

from __future__ import annotations

import collections
import functools
import itertools
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import word_key

#: Weight of a lexeme without a label.
WEIGHT = 0.1
#: A character of a word. The letter beyond 16 bits makes Java step by whole characters when it looks behind.
LETTER = r"[\p{L}\p{N}𝐀]"


def with_key(df: DataFrame, text: str) -> DataFrame:
    return df.withColumn("__key", word_key(F.col(text)))


def is_word(word: str) -> bool:
    """Whether a word can be one of a text's: letters and digits, at least one."""
    return bool(word) and all(unicodedata.category(c)[0] in "LN" for c in word)


def _pattern(*words: str) -> str:
    """Any of the words, whole; it begins with letters, which are sought faster than what must not stand before them."""
    return "|".join(rf"{word}(?<!{LETTER}{word})(?!{LETTER})" for word in words)


def has_word(key: Column, word: str) -> Column:
    return key.contains(word) & F.regexp_like(key, F.lit(_pattern(word))) if is_word(word) else F.lit(False)


def matches(key: Column, variants: list[list[str]]) -> Column:
    """Every word of at least one variant occurs; a variant without words matches nothing.

    The key, of which a text has but one, is bound to a name: as a plain expression it would be made anew for each word.
    """

    def any_variant(k: Column) -> Column:
        out = F.lit(False)
        for words in variants:
            if words:
                out = out | functools.reduce(Column.__and__, [has_word(k, w) for w in dict.fromkeys(words)])
        return out

    return F.exists(F.array(key), any_variant)


def frequency(key: Column, word: str) -> Column:
    return F.regexp_count(key, F.lit(_pattern(word))) if is_word(word) else F.lit(0)


def rank_single(key: Column, word: str) -> Column:
    """Cover density of one word: its frequency by the weight."""
    return F.round(F.lit(WEIGHT) * frequency(key, word), 6)


def search(df: DataFrame, key: str, text: str, variants: list[list[str]], limit: int = 50, candidates: int | None = None, where: Column | None = None) -> DataFrame:
    """Best hits by rank, then key. Filters come before the candidate cap, which takes the smallest keys."""
    found = df if where is None else df.where(where)
    found = with_key(found, text).where(matches(F.col("__key"), variants))
    if candidates is not None:
        found = found.orderBy(key).limit(candidates)
    told = [words for words in variants if words]
    if not told:
        return found.withColumn("rank", F.lit(0.0)).drop("__key").limit(0)
    rank = rank_single(F.col("__key"), told[0][0]) if len(told) == 1 and len(set(told[0])) == 1 else cover_density(told)(F.col("__key"))
    return found.withColumn("rank", F.round(rank, 6)).drop("__key").orderBy(F.desc("rank"), key).limit(limit)


def covers(row, variants: list[set]) -> float:
    """Sum over the shortest stretches that hold every word of a variant: weight over one and the words between.

    Stretches are found from left to right; the next one begins after the place where the last one did.
    """
    need = set().union(*variants)
    return density([(place, word) for place, word in enumerate(row) if word in need], variants)


def density(hits: list[tuple[int, str]], variants: list[set]) -> float:
    """covers() of the places and words that count."""
    total, left, counts = 0.0, 0, collections.Counter()
    for right, (place, word) in enumerate(hits):
        counts[word] += 1
        while any(all(counts[w] for w in words) for words in variants):
            first, gone = hits[left]
            counts[gone] -= 1
            if not any(all(counts[w] for w in words) for words in variants):
                between = place - first - (right - left)
                total += WEIGHT / (1 + between)
            left += 1
    return round(total, 6)


def cover_density(variants: list[list[str]]):
    """Cover density rank of keys for variants, each a list of words that all must be there.

    Python gets the words that count and how many others stand before each, never a text's words.
    """

    @F.pandas_udf("double")
    def rank(found):
        import pandas as pd

        sets = [set(words) for words in variants if words]
        places = ((k + n for k, n in enumerate(itertools.accumulate(others))) for others in found["others"])
        return pd.Series([density(list(zip(at, words, strict=False)), sets) for at, words in zip(places, found["words"], strict=True)], dtype="float64")

    def of(key):
        some = sorted({w for words in variants for w in words if is_word(w)})
        if not some:
            return F.lit(0.0)
        hit = _pattern(*some)
        others = lambda k: F.transform(F.split(k, hit), lambda x: F.regexp_count(x, F.lit(r"[\p{L}\p{N}]+")))
        found = F.transform(F.array(key), lambda k: F.struct(F.regexp_extract_all(k, F.lit(hit), F.lit(0)).alias("words"), others(k).alias("others")))[0]
        return rank(found)

    return of


def _sum(x: Column) -> Column:
    return F.aggregate(x, F.lit(0.0), lambda a, b: a + b)


def distances(vector: Column, query: list[float]) -> dict[str, Column]:
    """Cosine and Euclidean distance and negative inner product, in double precision inside the JVM."""
    q = F.array(*[F.lit(float(x)) for x in query])
    v = F.transform(vector, lambda x: x.cast("double"))
    dot = _sum(F.zip_with(v, q, lambda a, b: a * b))
    norm = F.sqrt(_sum(F.transform(v, lambda a: a * a)))
    own = sum(float(x) ** 2 for x in query) ** 0.5
    return {
        "cosine": F.lit(1.0) - F.try_divide(dot, norm * F.lit(own)),
        "l2": F.sqrt(_sum(F.zip_with(v, q, lambda a, b: (a - b) * (a - b)))),
        "inner": -dot,
    }


def nearest(df: DataFrame, key: str, vector: str, query: list[float], kind: str = "cosine", limit: int = 20) -> DataFrame:
    """The nearest vectors of the query's length; ties by key. A zero vector has no direction: its cosine distance is null and comes last."""
    fit = df.where(F.size(vector) == len(query))
    return fit.select(key, F.round(distances(F.col(vector), query)[kind], 9).alias("distance")).orderBy(F.asc_nulls_last("distance"), key).limit(limit)

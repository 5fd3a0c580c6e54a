"""Version chains: numbers, validity windows, change and status events, as-of lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def number_versions(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    return df.withColumn("version_number", F.row_number().over(Window.partitionBy(key).orderBy(*order)))


def changes(df: DataFrame, key: str, order: list[str], content: str) -> DataFrame:
    """Rows whose content differs from the version before (A, B, A are three versions)."""
    w = Window.partitionBy(key).orderBy(*order)
    first = F.row_number().over(w) == 1
    return df.withColumn("changed", first | ~F.lag(content).over(w).eqNullSafe(F.col(content))).where("changed").drop("changed")


def validity(df: DataFrame, key: str, start: str, source: str, group: Column, number: str, expire: Column) -> DataFrame:
    """Gap-free windows of the versions of each document.

    In the order of (group, start, number) starts are made strictly increasing, by a day where
    needed; each window ends the day before the next. The last is open, or ends on `expire`, not before its
    start. A moved start is `observed_adjusted`. Two `edition` starts on one day, the first not
    moved, are a conflict that marks the whole document.
    """
    w = Window.partitionBy(key).orderBy("__group", start, number)
    # Strictly increasing days in closed form: greatest of (day - rank) so far, plus the rank.
    ranked = df.withColumn("__group", group).withColumn("__rank", F.row_number().over(w))
    day = F.datediff(start, F.lit("1970-01-01").cast("date"))
    moved = F.max(day - F.col("__rank")).over(w.rowsBetween(Window.unboundedPreceding, 0)) + F.col("__rank")
    out = ranked.withColumn("valid_from", F.date_add(F.lit("1970-01-01").cast("date"), moved)).withColumn("__nudged", F.col("valid_from") != F.col(start))
    before = F.lag("valid_from").over(w)
    clash = (F.col(start) <= before) & (F.col(source) == "edition") & (F.lag(source).over(w) == "edition") & ~F.lag("__nudged").over(w)
    out = out.withColumn("__next", F.lead("valid_from").over(w)).withColumn("__clash", F.coalesce(clash, F.lit(False)))
    end = F.when(F.col("__next").isNotNull(), F.date_sub("__next", 1)).otherwise(F.when(expire.isNotNull(), F.greatest(expire, F.col("valid_from"))))
    out = out.withColumn("valid_to", end).withColumn("conflict", F.max("__clash").over(Window.partitionBy(key)))
    out = out.withColumn("valid_from_source", F.when(F.col("__nudged"), "observed_adjusted").otherwise(F.col(source)))
    return out.drop("__group", "__rank", "__nudged", "__next", "__clash")


def as_of(df: DataFrame, day) -> DataFrame:
    """Versions in force on a day; both ends count, an open end is null."""
    day = F.lit(day).cast("date")
    return df.where((F.col("valid_from") <= day) & (F.col("valid_to").isNull() | (day <= F.col("valid_to"))))


def overlaps(df: DataFrame, key: str, number: str) -> DataFrame:
    """Documents with a window that begins before an earlier one has ended; empty when all is well."""
    w = Window.partitionBy(key).orderBy("valid_from", number).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.coalesce("valid_to", F.lit("9999-12-31").cast("date"))).over(w)
    return df.withColumn("__until", last).where(F.col("valid_from") <= F.col("__until")).drop("__until")


def stale(df: DataFrame, key: str, seen: str, arrival: list[str]) -> DataFrame:
    """Marks observations that are older than one which arrived before."""
    w = Window.partitionBy(key).orderBy(*arrival).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("stale", F.coalesce(F.col(seen) < F.max(seen).over(w), F.lit(False)))


def keep_last_known(df: DataFrame, key: str, order: list[str], column: str, blank: Column | None = None) -> Column:
    """The last value that is not blank, up to each row."""
    value = F.when(~(blank if blank is not None else F.coalesce(F.col(column), F.lit("")) == ""), F.col(column))
    return F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def islands(df: DataFrame, key: str, order: list[str], value: str) -> DataFrame:
    """Numbers the runs of equal values."""
    w = Window.partitionBy(key).orderBy(*order)
    new = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    return df.withColumn("__new", new).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def latest(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    return df.withColumn("__k", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("__k = 1").drop("__k")

"""Shared helpers: tables in the cluster's shared folder, components, global order."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A word of the contracts: a run of anything but space, tab, LF, VT, FF and CR.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """Folder that the driver and all executors share: spark.checkpoint.dir.

    A local session may do without; a cluster may not, for no other machine would see a folder made up here.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file:///tmp/strataleaf-" + spark.sparkContext.applicationId
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Cut the lineage: write df as Parquet to the shared folder and read it again."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a table that materialize() wrote and that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    base = shared_dir(spark)
    for file in df.inputFiles()[:1]:
        folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if base.split("://")[-1].rstrip("/") in folder.toString():
            folder.getFileSystem(conf).delete(folder, True)


def settle(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of plans that written tables have replaced, and executors give heap back.

    It does so once the driver's garbage is collected, which on its own may come long after a disk is full.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
    if not spark.sparkContext._jsc.sc().isLocal():  # there the driver is the executor
        collect_on_executors(spark)


def collect_on_executors(spark: SparkSession) -> None:
    """Have executors collect their garbage whole; until then each keeps the largest heap that any stage made it take.

    A task for each core, so that every executor that has nothing else to do gets some.
    """
    tasks = spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).select(F.reflect(F.lit("java.lang.System"), F.lit("gc"))).write.format("noop").mode("overwrite").save()


def ensure(docs: DataFrame, **kinds: str) -> DataFrame:
    """Only the named columns, cast; columns of other names never clash with an operator's own."""
    return docs.select(*[F.col(f"`{name}`").cast(kind).alias(name) for name, kind in kinds.items()])


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def grouped(rows: Iterator, keys: list[str]) -> Iterator:
    """Whole groups (pandas frames) from batches whose rows come sorted by keys."""
    import pandas as pd

    held: list = []
    for batch in rows:
        if not len(batch):
            continue
        change = (batch[keys] != batch[keys].shift()).any(axis=1).to_numpy()
        change[0] = not held or bool((held[-1][keys].iloc[-1].to_numpy() != batch[keys].iloc[0].to_numpy()).any())
        starts = change.nonzero()[0].tolist()
        if not starts:
            held.append(batch)
            continue
        if starts[0] > 0:
            held.append(batch.iloc[: starts[0]])
        for at, until in zip(starts, [*starts[1:], len(batch)], strict=True):
            if held:
                yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)
            held = [batch.iloc[at:until]]
    if held:
        yield held[0] if len(held) == 1 else pd.concat(held, ignore_index=True)


def connected_components(links: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(node, component) of every node with a link; component: the smallest node reachable.

    Alternating large and small stars: each round hangs the neighbours of a node below the
    smallest of them, until nothing changes. Each round is aggregations that combine before
    the shuffle and one join; its result is written to the shared folder. Nulls and loops are
    ignored. Nothing is collected but one checksum a round.
    """
    a, b = F.col(src), F.col(dst)
    edges = links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = materialize(edges.distinct(), "cc")
    seen, old = None, None
    while True:
        # Large star: each neighbour above a node moves to the least of the node and its neighbours.
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # Small star: the neighbours below a node, and the node, move to the least of them.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.col("v"), F.col("u"))).alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        new = materialize(small, "cc")
        now = new.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if old is not None:
            drop(old)
        if (now.n, now.s) == seen:
            break
        seen, old, edges = (now.n, now.s), edges, new
    pairs = new.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = new.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.unionByName(roots)


def global_index(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df with a gapless long `name` in the given order, without one task that holds all rows.

    Sorts by range, numbers each partition on its own, and adds the rows before it; only one
    count a partition meets in one place.
    """
    ordered = materialize(df.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "order")
    part = F.shiftright(F.col("__at"), 33)
    sizes = ordered.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.sparkSession.createDataFrame(_prefix(sizes.collect()), "__part long, __before long")
    return ordered.withColumn("__part", part).join(before, "__part").withColumn(name, F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))).drop("__part", "__before", "__at")


def _prefix(rows: list) -> list[tuple[int, int]]:
    out, total = [], 0
    for part, n in sorted((r[0], r[1]) for r in rows):
        out.append((part, total))
        total += n
    return out


def arrow_map(df: DataFrame, run: Callable, schema: str | T.StructType) -> DataFrame:
    return df.mapInArrow(run, schema)


def whole_groups(batches: Iterator, keys: list[str], least: int = 16384) -> Iterator:
    """Arrow tables of whole groups, from batches whose rows come sorted by keys."""
    import numpy as np
    import pyarrow as pa

    held, n = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        n += batch.num_rows
        if n < least:
            continue
        table = pa.Table.from_batches(held)
        last = bounds(table, keys)[-2]
        if last:
            yield table.slice(0, last)
            held = table.slice(last).combine_chunks().to_batches()
            n -= int(last)
        least = max(least, 2 * n)
    if n:
        yield pa.Table.from_batches(held)


def bounds(table, keys: list[str]):
    """Where each group of a sorted Arrow table starts, and its end."""
    import numpy as np

    change = np.zeros(table.num_rows, bool)
    change[0] = True
    for key in keys:
        x = table.column(key).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    return np.append(np.flatnonzero(change), table.num_rows)


def near(df: DataFrame, least: int = 1_000_000, weight: Column | None = None) -> DataFrame:
    """df, marked to be sent to every executor where it has at most `least` (small) rows, or a sum of weights up to it.

    Beyond that the join shuffles both sides. df must be cheap to count, as a written table is.
    """
    if weight is not None:
        small = (df.agg(F.sum(weight).alias("n")).first().n or 0) <= least
    else:
        small = df.limit(least + 1).count() <= least
    return F.broadcast(df) if small else df


def slices_of(batches: Iterator, most: int = 1024) -> Iterator:
    """Batches in slices of at most so many rows, none empty."""
    for batch in batches:
        for lo in range(0, batch.num_rows, most):
            yield batch.slice(lo, most)


def texts_of(batches: Iterator) -> Iterator:
    for batch in slices_of(batches, 256):
        yield from batch.column("text").to_pylist()


def kept() -> dict:
    """What this process keeps from one task to the next."""
    import sys
    import types

    module = sys.modules.setdefault("_strataleaf_kept", types.ModuleType("_strataleaf_kept"))
    return module.__dict__.setdefault("things", {})


def lean(run: Callable, keeps: bool = False) -> Callable:
    """An Arrow function whose worker gives the memory of a task back at the task's end.

    What earlier tasks kept goes before it, unless it keeps things itself.
    """

    def held(batches):
        if not keeps and kept():
            kept().clear()
            release()
        try:
            yield from run(batches)
        finally:
            release()

    return held


def release() -> None:
    """Give freed memory back to the system; workers live on between tasks."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass

"""Operator 8: mixing sources to target weights by pivotal dependent rounding.

Sources in code-point order (null last) weigh 5, 2, 1, repeating. Each source's target is its
weight's share of all words, at most 3 times its own size; the excess is shared again by weight.
A document of a source is wanted target/size times: the whole part is taken outright, the rest is
a fractional copy probability. Two documents with fractional probabilities move mass between them
(as words, so the words expected stay equal) in the direction that chance decides, until one of
the two is integral; one document at most stays fractional in a chunk of a source. These
residuals meet in a reduction tree, chunk by chunk, until one is left of each source, which
a last chance settles. So a source's words miss its target by less than one document, and the
expected copies of every document equal its share.

Nulls: a null text has size 0 and takes 0 words; a null source is a source; a null doc_id is a
row like any other. Empty tables give an empty result; a source of size 0 has target 0. Repeated
rows are rows. Chances come from a hash of the seed and the chunk, so reruns agree. Columns other
than doc_id, text and source are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, ensure, global_index, grouped, materialize, near, word_count

WEIGHTS, MOST, SEED = (5, 2, 1), 3, 20240229
#: Rows that one task rounds at once, and residual chunks that meet at once.
CHUNK, FAN_IN = 4096, 64


def source_targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row a source.

    A source stops at `most` times its size. The level at which the others fill up is found by
    rounds of one aggregate each: all sources above their bound at the present level are fixed,
    and the level is raised by what they leave. Only sums reach the driver.
    """
    ranked = global_index(sizes, [F.col("source").isNull(), F.col("source")], "at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("at", F.lit(len(weights))) + 1).cast("int"))
    ranked = materialize(ranked.select("source", "source_size", weight.alias("weight")), "mix-sources")
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first().n
    level, bound = 0.0, most * F.col("source_size")
    while True:
        full = bound <= level * F.col("weight")
        x = ranked.agg(F.coalesce(F.sum(F.when(full, bound)), F.lit(0)).alias("fixed"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open")).first()
        up = (total - x.fixed) / x.open if x.open else level
        if up <= level:
            break
        level = up
    return ranked.select("source", "source_size", F.least(bound.cast("double"), level * F.col("weight")).alias("target"))


def pivot(sizes: list[int], shares: list[float], chances) -> tuple[list[int], int, float]:
    """Round shares of documents; returns (taken 0/1 by row, row left or -1, its share).

    sizes: words of each row, over 0. The residual meets one row after the other; with the large
    ones first, the one left in the end is small.
    """
    n = len(sizes)
    taken = [0] * n
    held, p = -1, 0.0
    for k in range(n):
        q = shares[k]
        if q <= 1e-12 or q >= 1 - 1e-12:
            taken[k] = int(q > 0.5)
            continue
        if held < 0:
            held, p = k, q
            continue
        a, b = sizes[held], sizes[k]
        # up: words that may move from k to held; down: the other way.
        up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)
        if chances[k] * (up + down) < down:
            p, q = p + up / a, q - up / b
        else:
            p, q = p - down / a, q + down / b
        if q <= 1e-9 or q >= 1 - 1e-9:
            taken[k] = int(q > 0.5)
            if p <= 1e-9 or p >= 1 - 1e-9:
                taken[held] = int(p > 0.5)
                held = -1
        else:
            taken[held] = int(p > 0.5)
            held, p = k, q
    return taken, held, p


def _rng(*parts):
    import numpy as np
    import xxhash

    return np.random.default_rng(xxhash.xxh64_intdigest(repr(parts).encode()))


def _first(seed: int):
    """Rows sorted by chunk to copies by row; a chunk's residual of a source keeps its share in `left`."""

    def run(batches):
        for chunk in grouped(batches, ["chunk"]):
            chunk = chunk.sort_values(["source_at", "size", "doc_id"], ascending=[True, False, True], kind="stable").reset_index(drop=True)
            copies, left = chunk["whole"].to_numpy().copy(), chunk["part"].to_numpy() * float("nan")
            for source, own in chunk[(chunk["size"] > 0) & (chunk["part"] > 0)].groupby("source_at", sort=True):
                rows, sizes = own.index.to_numpy(), own["size"].tolist()
                taken, held, p = pivot(sizes, own["part"].tolist(), _rng(seed, int(chunk["chunk"].iloc[0]), int(source)).random(len(rows)))
                copies[rows] += taken
                if held >= 0:
                    left[rows[held]] = p
            out = chunk[["chunk", "source_at", "doc_id", "size"]].copy()
            out["row"], out["copies"], out["left"] = range(len(chunk)), copies, left
            yield out

    return run


def _settle(seed: int, last: bool):
    """Residuals sorted by source and parent: those that become integral have `taken`, one stays."""

    def run(batches):
        for group in grouped(batches, ["source_at", "parent"]):
            group = group.sort_values(["size", "chunk", "row"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
            rng = _rng(seed, "tree", int(group["source_at"].iloc[0]), int(group["parent"].iloc[0]), len(group))
            taken, held, p = pivot(group["size"].tolist(), group["left"].tolist(), rng.random(len(group)))
            group["taken"] = taken
            group["left"] = float("nan")
            if held >= 0 and last:
                group.loc[held, "taken"] = int(rng.random() < p)
            elif held >= 0:
                group.loc[held, "left"] = p
            yield group[["source_at", "chunk", "row", "size", "taken", "left", "parent"]]

    return run


def mix(docs: DataFrame, weights=WEIGHTS, most: int = MOST, seed: int = SEED, chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies for every row of docs."""
    rows = ensure(docs, doc_id="long", text="string", source="string").select("doc_id", "source", word_count(F.col("text")).alias("size"), F.monotonically_increasing_id().alias("place"))
    rows = materialize(rows, "mix-rows")
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    targets = materialize(global_index(targets, [F.col("source").isNull(), F.col("source")], "source_at"), "mix-targets")
    n = rows.count()
    chunks = max(1, -(-n // chunk))
    ratio = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    # One small row a source; Spark broadcasts it below its own size limit and shuffles it above.
    known = targets.select(F.col("source").alias("__source"), "source_at", F.floor(ratio).cast("int").alias("whole"), (ratio - F.floor(ratio)).alias("part"))
    # A doc_id (or null) that fills a chunk many times over is dealt out by its rows' places; so few are these that they go to every task.
    often = rows.groupBy("doc_id", "size").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 4 * chunk)
    often = near(materialize(often.select(F.col("doc_id").alias("__id"), F.col("size").alias("__size"), F.lit(True).alias("__often")), "mix-often"))
    rows_at = rows.join(often, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("size") == F.col("__size")), "left")
    key = F.when(F.col("__often"), F.xxhash64("doc_id", "size", "place")).otherwise(F.xxhash64("doc_id", "size"))
    wanted = rows_at.join(known, F.col("source").eqNullSafe(F.col("__source"))).select(F.pmod(key, F.lit(chunks)).alias("chunk"), "source_at", "doc_id", "size", "whole", "part")
    first = materialize(
        wanted.repartition(min(chunks, 4096), "chunk").sortWithinPartitions("chunk").mapInPandas(_first(seed), "chunk long, source_at long, doc_id long, size long, row long, copies int, left double"),
        "mix-first",
    )
    drop(rows)
    still = lambda df: df.where("left IS NOT NULL AND NOT isnan(left)")
    open_, settled, width = still(first).select("source_at", "chunk", "row", "size", "left").withColumn("at", F.col("chunk")), None, chunks
    while True:
        width = -(-width // fan_in)
        step = open_.withColumn("parent", F.col("at") % F.lit(width)).drop("at")
        step = step.repartition(min(max(width, 12), 4096), "source_at", "parent").sortWithinPartitions("source_at", "parent")
        step = materialize(step.mapInPandas(_settle(seed, width == 1), "source_at long, chunk long, row long, size long, taken int, left double, parent long"), "mix-tree")
        done = step.where("left IS NULL OR isnan(left)").select("source_at", "chunk", "row", "taken")
        settled = done if settled is None else settled.unionByName(done)
        if width == 1:
            break
        open_ = still(step).select("source_at", "chunk", "row", "size", "left", F.col("parent").alias("at"))
    per_source = targets.select("source_at", "source_size", "target")
    return (
        first.join(settled, ["source_at", "chunk", "row"], "left")
        .withColumn("copies", F.col("copies") + F.coalesce("taken", F.lit(0)))
        .join(per_source, "source_at")
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies")
    )

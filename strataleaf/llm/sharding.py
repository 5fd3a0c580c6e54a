"""Operator 9: byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Rows with equal text form one group, which stays whole. Groups are dealt by hash into chunks of
bounded size; each chunk is differenced on its own into `shards` parts (a partial partition),
then partial partitions are combined in a tree with a bounded fan-in, each time the two of the
largest spread, oppositely ordered. The last level takes the parts that are left, and the few
groups too large for a chunk to even out, as single items, so a group larger than a fair share
gets a shard to itself. Which part went where is kept as a small table a level and joined back.

Nulls: a null text is 0 bytes and all null texts are one group; a null doc_id is a row like any
other. Empty tables give an empty result. Repeated rows are rows of one group. Ties are broken by
the group's digest, so reruns agree. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import drop, ensure, grouped, materialize, near

#: Groups that one task differences at once, and partial partitions combined at once.
CHUNK, FAN_IN = 2048, 32
#: A group of at least 1/HEAVY of all bytes or rows is one of at most HEAVY such groups.
HEAVY = 2048


def difference(items: list[tuple[list[int], list]], shards: int) -> list[tuple[int, list]]:
    """Karmarkar-Karp differencing of partial partitions.

    items: (sums, members) of each, where sums are the loads of its non-empty parts and members
    the contents of those parts (lists). Returns (load, contents) of each of the shards.
    """
    heap = []
    for at, (sums, members) in enumerate(items):
        parts = sorted(zip(sums, members, strict=True), key=lambda x: -x[0])[:shards]
        low = parts[-1][0] if len(parts) == shards else 0
        heap.append((-(parts[0][0] - low) if parts else 0, at, parts))
    heapq.heapify(heap)
    at = len(items)
    while len(heap) > 1:
        _, _, one = heapq.heappop(heap)
        _, _, two = heapq.heappop(heap)
        # The largest part of one meets the smallest of the other; missing parts are empty.
        merged = []
        spare = shards - len(one)
        for k, (load, inside) in enumerate(two):
            other = shards - 1 - k
            if other < len(one):
                merged.append((load + one[other][0], [one[other][1], inside]))
            else:
                merged.append((load, inside))
        kept = len(one) - max(0, len(two) - spare)
        merged.extend(one[:kept])
        merged.sort(key=lambda x: -x[0])
        low = merged[-1][0] if len(merged) == shards else 0
        heapq.heappush(heap, (-(merged[0][0] - low), at, merged))
        at += 1
    parts = heap[0][2] if heap else []
    return [*parts, *[(0, [])] * (shards - len(parts))]


def _flat(inside) -> Iterator:
    """The leaves of nested lists, without recursion."""
    stack = [inside]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            stack.extend(x)
        else:
            yield x


def _difference_groups(shards: int):
    """Chunks of groups, sorted by chunk, to (chunk, part, digest, load) rows."""

    def run(batches):
        import pandas as pd

        for chunk in grouped(batches, ["chunk"]):
            chunk = chunk.sort_values(["load", "digest"], ascending=[False, True])
            items = [([int(load)], [digest]) for load, digest in zip(chunk["load"], chunk["digest"], strict=True)]
            rows = [(part, digest, load) for part, (load, inside) in enumerate(difference(items, shards)) for digest in _flat(inside)]
            yield pd.DataFrame({"chunk": int(chunk["chunk"].iloc[0]), "part": [r[0] for r in rows], "digest": [r[1] for r in rows], "load": [r[2] for r in rows]})

    return run


def _difference_parts(shards: int):
    """Partial partitions, sorted by parent, to (chunk, part, parent, up, load): where each part went."""

    def run(batches):
        import pandas as pd

        for group in grouped(batches, ["parent"]):
            items = []
            for chunk, own in group.sort_values(["chunk", "part"]).groupby("chunk", sort=True):
                items.append(([int(x) for x in own["load"]], [(int(chunk), int(p)) for p in own["part"]]))
            rows = [(c, p, up, load) for up, (load, inside) in enumerate(difference(items, shards)) for c, p in _flat(inside)]
            yield pd.DataFrame({"chunk": [r[0] for r in rows], "part": [r[1] for r in rows], "parent": int(group["parent"].iloc[0]), "up": [r[2] for r in rows], "load": [r[3] for r in rows]})

    return run


def assign_shards(docs: DataFrame, shards: int = 40, chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs."""
    spark = docs.sparkSession
    rows = ensure(docs, doc_id="long", text="string").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.lit("00"))).alias("digest"),
    )
    rows = materialize(rows, "shard-rows")
    groups = materialize(rows.groupBy("digest").agg(F.sum("size").alias("load"), F.count(F.lit(1)).alias("n")), "shard-groups")
    total = groups.agg(F.count(F.lit(1)).alias("groups"), F.coalesce(F.sum("load"), F.lit(0)).alias("load"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    heavy_load = F.col("load") * HEAVY >= F.lit(total.load)

    chunks = max(1, -(-total.groups // chunk))
    light = groups.where(~heavy_load).withColumn("chunk", F.pmod(F.xxhash64("digest"), F.lit(chunks)))
    tasks = min(chunks, 4096)
    placed = materialize(
        light.select("chunk", "digest", "load").repartition(tasks, "chunk").sortWithinPartitions("chunk").mapInPandas(_difference_groups(shards), "chunk long, part int, digest binary, load long"),
        "shard-parts",
    )
    top = placed.select("chunk", "part", "load").distinct()
    path = placed.select("chunk", "part").distinct().select("chunk", "part", F.col("chunk").alias("at"), F.col("part").alias("now"))
    count = chunks
    while count > fan_in:
        count = -(-count // fan_in)
        moved = top.withColumn("parent", F.pmod(F.col("chunk"), F.lit(count)))
        moved = materialize(
            moved.repartition(min(count, 4096), "parent").sortWithinPartitions("parent").mapInPandas(_difference_parts(shards), "chunk long, part int, parent long, up int, load long"),
            "shard-level",
        )
        step = moved.select(F.col("chunk").alias("at"), F.col("part").alias("now"), "parent", "up")
        path = materialize(path.join(step, ["at", "now"]).select("chunk", "part", F.col("parent").alias("at"), F.col("up").alias("now")), "shard-path")
        top = moved.select(F.col("parent").alias("chunk"), F.col("up").alias("part"), "load").distinct()

    # At the top: at most fan_in * shards parts, and at most HEAVY groups.
    parts = [([int(r.load)], [("part", r.chunk, r.part)]) for r in sorted(top.collect())]
    giants = [([int(r.load)], [("group", bytes(r.digest), 0)]) for r in sorted(groups.where(heavy_load).select("load", "digest").collect(), key=lambda r: (-r.load, bytes(r.digest)))]
    final = [(x, shard) for shard, (_, inside) in enumerate(difference(giants + parts, shards)) for x in _flat(inside)]
    of_part = spark.createDataFrame([(c, p, s) for (kind, c, p), s in final if kind == "part"], "at long, now int, shard int")
    of_group = spark.createDataFrame([(bytearray(d), s) for (kind, d, _), s in final if kind == "group"], "digest binary, shard int")
    home = placed.select("chunk", "part", "digest").join(path, ["chunk", "part"]).join(F.broadcast(of_part), ["at", "now"]).select("digest", "shard")
    home = home.unionByName(of_group).join(groups.select("digest", "n"), "digest")
    home = materialize(home, "shard-home")

    # Groups of at least 1/HEAVY of all rows number at most HEAVY: those go to every task, so
    # that no task gets the rows of one of them; the others meet their rows in a shuffle.
    often = F.col("n") * HEAVY >= F.lit(total.n)
    hot = F.broadcast(home.where(often).select("digest", F.col("shard").alias("hot")))
    rows_hot = rows.join(hot, "digest", "left")
    cold = rows_hot.where("hot IS NULL").join(home.where(~often).select("digest", "shard"), "digest").select("doc_id", "size", "text_crc32", "digest", "shard")
    sharded = rows_hot.where("hot IS NOT NULL").select("doc_id", "size", "text_crc32", "digest", F.col("hot").alias("shard")).unionByName(cold)

    # Slots: each shard's rows are numbered in bins of bounded size, on top of the rows before.
    bins = max(1, -(-int(total.n) // (shards * 1024)))
    # Equal rows that would fill a bin many times over are dealt out by their places.
    often = rows.groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("__n")).where("__n > 4096")
    often = near(materialize(often.select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.lit(True).alias("__often")), "shard-often"))
    sharded = sharded.join(often, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("digest") == F.col("__digest")), "left").withColumn("place", F.monotonically_increasing_id())
    key = F.when(F.col("__often"), F.xxhash64("doc_id", "digest", "place")).otherwise(F.xxhash64("doc_id", "digest"))
    sharded = materialize(sharded.withColumn("bin", F.pmod(key, F.lit(bins)).cast("int")).select("doc_id", "size", "text_crc32", "shard", "bin"), "shard-rows")
    drop(rows)
    sizes = sharded.groupBy("shard", "bin").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("shard", "bin", (F.sum("n").over(Window.partitionBy("shard").orderBy("bin")) - F.col("n")).alias("before"))
    number = F.row_number().over(Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size"))
    return (
        sharded.withColumn("at", number)
        .join(before, ["shard", "bin"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("at") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )

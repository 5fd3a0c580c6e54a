"""Operator 5: near-duplicate vectors by a pivot-permutation index.

Pivots are vectors of the table, taken in the order of a hash (4 times the root of the row count, at most
MOST, and none close to another). Every vector is described by its nearest pivots in order: PREFIX of up to FEW
pivots, and one more each time their number doubles, or the six nearest of many pivots would agree less and less. Inverted lists are kept for
pairs of pivots: two vectors meet in a list when they share at least two pivots, and the pair is
taken up only in the list of the first two they share, so it is verified once. Lists are dealt
out in blocks, block against block, so no task gets a whole long list. Verification is the cosine in
double precision.

Equal vectors are one class: their mutual links are counted, not expanded. Between classes, each list
writes counts of links and pairs that hold its components together, not all of its pairs.

Nulls: vectors that are null, empty, zero or hold a null or non-finite component link with nothing,
nor do vectors of different lengths; a row with a null vec_id has no links, a null component and is
kept. Rows that share a vec_id share its links, and a repeated row counts once. Empty tables give
an empty result; ties between pivots go to the first; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounds, connected_components, ensure, lean, materialize, slices_of, whole_groups

LEAST = 0.9
PER_ROOT, MOST, PREFIX, FEW, BLOCK = 4, 1 << 14, 6, 256, 256


def prefix_of(count: int) -> int:
    """How many nearest pivots describe a vector, of so many pivots."""
    return PREFIX + max(0, math.ceil(math.log2(max(1, count) / FEW)))


def _matrix(column, kind: str, width: int):
    """Packed vectors of one number type as a double matrix, padded with zeros to a common width; and their lengths."""
    import numpy as np

    raw = column.to_pylist()
    lengths = np.array([len(x) for x in raw]) // np.dtype(kind).itemsize
    if len(raw) and (lengths == width).all():
        return np.frombuffer(b"".join(raw), kind).reshape(len(raw), width).astype(np.float64), lengths
    out = np.zeros((len(raw), width))
    for k, x in enumerate(raw):
        out[k, : lengths[k]] = np.frombuffer(x, kind)
    return out, lengths


def _apart(drawn, count: int, least: float = 0.7):
    """The first vectors of those drawn that are no near copies of one another.

    A large group of near copies would else own many pivots, and its members would share few.
    """
    import numpy as np

    unit = drawn / np.abs(drawn).max(axis=1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    kept, n = np.empty((count, unit.shape[1])), 0
    for x in unit:
        if n < count and (not n or (kept[:n] @ x).max() < least):
            kept[n] = x
            n += 1
    return kept[:n]


def described(rows: DataFrame, pivots, prefix: int, kind: str) -> DataFrame:
    """cls, members, vec (packed), first (nearest pivots in order) of each class of equal vectors."""
    import numpy as np

    width = pivots.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast(pivots / np.linalg.norm(pivots, axis=1, keepdims=True))

    def run(batches):
        import pyarrow as pa

        unit = sent.value
        for batch in slices_of(batches):
            packed = [np.array(v, kind).tobytes() for v in batch.column("vec").to_pylist()]
            x, _ = _matrix(pa.array(packed, pa.binary()), kind, width)
            close = x @ unit.T
            m = min(prefix, unit.shape[0])
            top = np.argpartition(-close, m - 1, axis=1)[:, :m]
            order = np.take_along_axis(close, top, 1)
            top = np.take_along_axis(top, np.lexsort((top, -order), axis=1), 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("members"), pa.array(packed, pa.binary()), pa.array(top.astype(np.int32).tolist(), pa.list_(pa.int32()))],
                names=["cls", "members", "vec", "first"],
            )

    return rows.select("cls", "members", "vec").mapInArrow(lean(run), "cls long, members long, vec binary, first array<int>")


def spanning(n: int, a, b):
    """Pairs that hold together what the pairs (a, b) of n rows do: each row with the least row of its component."""
    import numpy as np

    least = np.arange(n)
    while True:
        low = np.minimum(least[a], least[b])
        new = least.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == least).all():
            break
        least = new
    there = np.flatnonzero(least != np.arange(n))
    return least[there], there


def link(vectors: DataFrame, least: float = LEAST, prefix: int | None = None, per_root: int = PER_ROOT, block: int = BLOCK) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, classes, links): vec_id, digest; digest, cls, members; a, b, linked.

    A link row either joins two classes of one component (a, b), or tells how many vectors of other classes one
    list found linked with a class (a, linked). A pair of classes is taken up in one list alone, so these counts
    add up, and no list writes more than two rows a member, however many pairs it holds.
    """
    import numpy as np

    narrow = dict(vectors.dtypes).get("embedding") == "array<float>"
    kind = "<f4" if narrow else "<f8"
    rows = ensure(vectors, vec_id="long", embedding="array<double>")
    good = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    other = F.exists("embedding", lambda x: x != 0)
    digest = F.when(good & finite & other, F.unhex(F.sha2(F.to_json(F.struct("embedding")).cast("binary"), 256)))
    rows = rows.withColumn("digest", digest)
    ids = materialize(rows.select("vec_id", "digest"), "vec-rows")
    classes = rows.where("digest IS NOT NULL").groupBy("digest").agg(F.min("vec_id").alias("cls"), F.count_distinct("vec_id").alias("members"), F.first("embedding").alias("vec"))
    classes = materialize(classes, "vec-classes")
    n = classes.count()
    count = min(MOST, max(16, per_root * math.isqrt(n)))
    drawn = [r.vec for r in classes.orderBy(F.xxhash64("digest"), "digest").select("vec").limit(2 * count).collect()]
    if not drawn:
        return ids, classes, rows.sparkSession.createDataFrame([], "a long, b long, linked long")
    width = classes.agg(F.max(F.size("vec")).alias("n")).first().n
    pivots = np.zeros((len(drawn), width))
    for k, v in enumerate(drawn):
        pivots[k, : len(v)] = v
    pivots = _apart(pivots, count)
    prefix = prefix or prefix_of(len(pivots))
    index = materialize(described(classes, pivots, prefix, kind), "vec-index")

    firsts = F.array_sort("first")
    combos = F.array(*[F.struct(firsts[i].alias("i"), firsts[j].alias("j")) for i in range(min(prefix, len(pivots))) for j in range(i + 1, min(prefix, len(pivots)))]) if len(pivots) > 1 else F.array(F.struct(firsts[0].alias("i"), firsts[0].alias("j")))
    posted = index.select("cls", F.explode(combos).alias("k")).select("cls", (F.col("k.i").cast("long") * MOST + F.col("k.j")).alias("key"))
    lists = posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    met = posted.join(lists, "key").withColumn("own", own)
    # A row goes to each pair of blocks that holds its own.
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, F.col("own")).alias("x"), F.greatest(x, F.col("own")).alias("y")))
    dealt = met.select("key", "cls", "own", F.explode(both).alias("p")).select("key", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "own", "cls")
    dealt = dealt.join(index, "cls")

    def verify(batches):
        import pyarrow as pa

        keys = ["key", "x", "y"]
        for table in whole_groups(batches, keys):
            at = bounds(table, keys)
            key, x, y = (table.column(k).to_numpy() for k in keys)
            own, cls = table.column("own").to_numpy(), table.column("cls").to_numpy()
            firsts = np.sort(np.array(table.column("first").to_pylist(), np.int64), axis=1)
            members = table.column("members").to_numpy()
            m, sizes = _matrix(table.column("vec"), kind, width)
            # Scaled by the largest component first, so that no square overflows or vanishes.
            m /= np.abs(m).max(axis=1, keepdims=True)
            m /= np.linalg.norm(m, axis=1, keepdims=True)
            out_a, out_b, out_n = [], [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if hi - lo < 2:
                    continue
                part = m[lo:hi]
                a, b = np.nonzero(np.triu(part @ part.T >= least, 1))
                if len(a) and x[lo] != y[lo]:
                    keep = own[lo + a] != own[lo + b]
                    a, b = a[keep], b[keep]
                keep = sizes[lo + a] == sizes[lo + b]
                a, b = a[keep], b[keep]
                linked, edge_a, edge_b = np.zeros(hi - lo, np.int64), [], []
                for k in range(0, len(a), 1 << 16):
                    i, j = a[k : k + (1 << 16)], b[k : k + (1 << 16)]
                    shared = (firsts[lo + i][:, :, None] == firsts[lo + j][:, None, :]).any(axis=2)
                    each = np.arange(len(i))
                    one = shared.argmax(axis=1)
                    shared[each, one] = shared.shape[1] == 1
                    two = shared.argmax(axis=1)
                    here = firsts[lo + i, one] * MOST + firsts[lo + i, two] == key[lo]
                    i, j = i[here], j[here]
                    np.add.at(linked, i, members[lo + j])
                    np.add.at(linked, j, members[lo + i])
                    edge_a.append(i), edge_b.append(j)
                if not linked.any():
                    continue
                i, j = spanning(hi - lo, np.concatenate(edge_a), np.concatenate(edge_b))
                some = np.flatnonzero(linked)
                out_a += [cls[lo + i], cls[lo + some]]
                out_b += [cls[lo + j], cls[lo + some]]
                out_n += [np.zeros(len(i), np.int64), linked[some]]
            if out_a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(z), pa.int64()) for z in (out_a, out_b, out_n)], names=["a", "b", "linked"])

    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    links = dealt.repartition(tasks, "key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(lean(verify), "a long, b long, linked long")
    # The same pair of classes may hold several lists together; counts of a class are added up.
    return ids, classes, materialize(links.groupBy("a", "b").agg(F.sum("linked").alias("linked")), "vec-links")


def near_vectors(vectors: DataFrame, least: float = LEAST, **how) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of vectors."""
    ids, classes, links = link(vectors, least, **how)
    sizes = classes.select("digest", "cls", "members")
    linked = links.where("a = b").select(F.col("a").alias("cls"), "linked")
    parts = connected_components(links.where("a <> b")).withColumnRenamed("node", "cls")
    per = sizes.join(linked, "cls", "left").join(parts, "cls", "left")
    per = materialize(per.select("digest", (F.col("members") - 1 + F.coalesce("linked", F.lit(0))).cast("long").alias("n_links"), F.coalesce("component", "cls").alias("component_id")), "vec-out")
    out = ids.join(per, "digest", "left").withColumn("component_id", F.coalesce("component_id", "vec_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"))

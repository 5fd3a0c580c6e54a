"""Operator 6: n-gram Jaccard join with a count-vector R-tree.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Two documents link when
100 * intersection >= 75 * union; the result gives each document its component.

1. Copies (equal sets) are one class, told by a hash of the set.
2. Candidates: with all hashes in one fixed order, two linked sets share a hash among the first
   n - ceil(0.75 n) + 1 of each. Only hashes that two classes of suitable sizes share there
   go on, each with its place in the order: two sets that link share o >= 3/7 (n_a + n_b) hashes, so
   the first that they share stands at a place of at most n - o in each. Hashes that a sample finds frequent come last in the order, which keeps common passages
   out of the lists; the order decides the cost, never the result.
3. Stars: in each list, members are paired with three representatives (the least, the greatest, and
   the one most of whose hashes are shared), which settles most lists and large groups of copies in
   linear time. Verified links give provisional components.
   Candidate pairs are held to the bound of 4 before their sets are.
4. R-tree: a list whose members are still in several components is searched for the rest. The hashes
   of a set of n fall into at least n / 2 groups (a power of two, so that points fold onto one another), four times
   as many for the tree, and the class is the point of its counts by group. Points are packed by size and by their most telling
   coordinates into nodes of FAN, these into nodes of the next level, up to a root; a node keeps the
   greatest count of each group. The tree is searched with itself from the root down: the summed minima of two nodes
   or points bound the overlap, and pairs that cannot link are not opened, as are those already in one component.
   Long lists are dealt block against block.
5. Every surviving pair is verified on its whole sets.

Nulls: a null or wordless text has an empty set, n_shingles 0 and its own component; a null doc_id
is a row with a null component. Repeated rows and rows that share a doc_id are classes like any
other, and a component is named by its smallest doc_id. Empty tables give an empty result; other
columns are ignored. Unequal sets share a 64-bit class with probability n*n/2**65.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounds, connected_components, drop, ensure, lean, materialize, near, settle, slices_of, texts_of, whole_groups

WORDS, NUMERATOR, DENOMINATOR = 5, 75, 100
GROUPS, FAN, BLOCK = 64, 8, 1024
#: The tree's points have FINE times as many groups, as far as to WIDEST, which bounds the memory of a block of long sets.
FINE, WIDEST = 4, 4096
FULL = 255
#: Hashes that a sample of 1/SAMPLE of the rows finds often, at most HINTS: they come last in the order.
SAMPLE, HINTS, SALTS = 8, 1 << 18, 64
ENTRIES = 1_000_000
#: The hashes of all prefixes are gathered in so many parts, one after another, so that one part is on disk at a time.
PARTS = 2
#: Counts that are compared at once.
CELLS = 1 << 21
#: Words whose hashes a task remembers.
REMEMBER = 1 << 17


class Hashes(dict):
    """Word to 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBER:
            self.clear()
        x = self[word] = xxhash.xxh3_64_intdigest(word)
        return x


def shingles(text: str | None, known: Hashes, words: int = WORDS):
    """Sorted distinct hashes of a text's shingles; of the whole sequence if it has fewer words."""
    import numpy as np

    parts = (text or "").encode("utf-8", "replace").lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    x = np.fromiter(map(known.__getitem__, parts), np.uint64, len(parts))
    if len(x) < words:
        x = np.concatenate([x, np.full(words - len(x), len(x), np.uint64)])
    n = len(x) - words + 1
    h = np.zeros(n, np.uint64)
    for k in range(words):
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + x[k : k + n]
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(h ^ (h >> np.uint64(29)))


def needed(n: int) -> int:
    """Least overlap that a set of n needs with any other."""
    return -(-NUMERATOR * n // DENOMINATOR)


def first_of(n):
    """Greatest place (from 0) at which a set of n has its first hash in common with a set that is no smaller."""
    return n - -(-2 * NUMERATOR * n // (NUMERATOR + DENOMINATOR))


def meets(n_a, pos_a, n_b, pos_b):
    """A hash at these places may be the first that two linked sets share."""
    least = NUMERATOR * (n_a + n_b)
    return ((NUMERATOR + DENOMINATOR) * (n_a - pos_a) >= least) & ((NUMERATOR + DENOMINATOR) * (n_b - pos_b) >= least)


def groups_of(n: int) -> int:
    """Groups of a set of n hashes: a power of two, one for every two hashes or more."""
    return max(GROUPS, 1 << max(0, n // 2 - 1).bit_length())


def fine_of(n: int) -> int:
    """Groups of a set of n hashes in the tree."""
    return max(groups_of(n), min(FINE * groups_of(n), WIDEST))


def counts_of(hashes):
    import numpy as np

    groups = fine_of(len(hashes))
    return np.minimum(np.bincount((hashes & np.uint64(groups - 1)).astype(np.int64), minlength=groups), FULL).astype(np.uint8)


def packed(points: list) -> list[bytes]:
    """Points as they are written and shuffled: small counts need few bits."""
    import zstandard

    coder = zstandard.ZstdCompressor(level=1, write_checksum=False)
    return [coder.compress(x.tobytes()) for x in points]


def unpacked(points: list) -> list[bytes]:
    import zstandard

    coder = zstandard.ZstdDecompressor()
    return [coder.decompress(x) for x in points]


def stacked(rows, width: int):
    """Points of like length as a matrix, folded to a smaller width; a full count stays full."""
    import numpy as np

    x = np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1, width)
    if x.shape[1] == 1:
        return x[:, 0]
    total = np.minimum(x.sum(axis=1, dtype=np.int64), FULL)
    total[(x == FULL).any(axis=1)] = FULL
    return total.astype(np.uint8)


def coarse_and_fine(classes: DataFrame) -> DataFrame:
    """cls, doc_id, n, counts and fine: the points of the tree, and folded ones for the pairs of the stars."""

    def run(batches):
        import pyarrow as pa

        for batch in slices_of(batches):
            pairs = zip(unpacked(batch.column("counts").to_pylist()), batch.column("n").to_pylist(), strict=True)
            folded = packed([stacked([x], groups_of(n))[0] for x, n in pairs])
            columns = [batch.column("cls"), batch.column("doc_id"), batch.column("n"), pa.array(folded, pa.binary()), batch.column("counts")]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "doc_id", "n", "counts", "fine"])

    return classes.select("cls", "doc_id", "n", "counts").mapInArrow(lean(run), "cls long, doc_id long, n long, counts binary, fine binary")


def bound(a, b):
    """Greatest overlap of two points (or boxes of them) by summed minima; a full count says nothing."""
    import numpy as np

    least = np.minimum(a, b)
    total = least.sum(axis=-1, dtype=np.int64)
    return np.where((least == FULL).any(axis=-1), np.int64(1 << 60), total)


def may_link(over, n_a, n_b):
    """100 * over >= 75 * union, for an overlap of at most `over`."""
    return DENOMINATOR * over >= NUMERATOR * (n_a + n_b - over)


def hints(docs: DataFrame) -> list[int]:
    """Frequent hashes of a sample, most frequent first; only an order hint."""
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)) == 0).select("text")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        known, h, n, held, size = Hashes(), np.empty(0, np.uint64), np.empty(0, np.int64), [], 0

        def added():
            every, at = np.unique(np.concatenate([h, *held]), return_inverse=True)
            return every, np.bincount(at, np.concatenate([n, np.ones(size, np.int64)]), len(every)).astype(np.int64)

        for text in texts_of(batches):
            held.append(shingles(text, known))
            size += len(held[-1])
            if size > 1 << 21:
                h, n = added()
                held, size = [], 0
        h, n = added()
        h, n = h[n > 1], n[n > 1]
        yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], names=["h", "n"])

    found = some.mapInArrow(lean(run), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).where("n > 3")
    return [r.h for r in found.orderBy(F.desc("n"), "h").limit(HINTS).collect()]


def described(docs: DataFrame, last: list[int]) -> DataFrame:
    """doc_id, n, cls, prefix (and late, the frequent hashes of it), counts of every row."""
    import numpy as np

    sent = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(last, np.int64).view(np.uint64)))

    def run(batches):
        import pyarrow as pa
        import xxhash

        known, frequent = Hashes(), sent.value
        names = ["doc_id", "n", "cls", "prefix", "late", "counts"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
        for batch in slices_of(batches):
            n, cls, prefix, late, counts = [], [], [], [], []
            for text in batch.column("text").to_pylist():
                h = shingles(text, known)
                size = len(h)
                n.append(size), cls.append(xxhash.xxh3_64_intdigest(h.tobytes()) - (1 << 63)), counts.append(counts_of(h))
                keep = size - needed(size) + 1 if size else 0
                often = np.empty(0, np.uint64)
                if keep and len(frequent):
                    there = frequent[np.minimum(np.searchsorted(frequent, h), len(frequent) - 1)] == h
                    if there.any():
                        h, often = h[~there], h[there]
                prefix.append(h[:keep].view(np.int64).copy()), late.append(often[: max(0, keep - len(h))].view(np.int64))
            rows = (batch.column("doc_id"), n, cls, prefix, late, packed(counts))
            yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], names=names)

    return docs.mapInArrow(lean(run), "doc_id long, n long, cls long, prefix array<long>, late array<long>, counts binary")


def shared_entries(sets: DataFrame, tasks: int, part: int = 0, parts: int = 1) -> DataFrame:
    """(key, cls, n, pos, w) of the entries whose key another class of a suitable size has too, at a place that suits.

    pos is the key's place in the class's order, w the log of the list's length, about. Of several parts,
    each has its own keys.

    Frequent hashes are dealt out by class as well and all go on: their lists are not gathered here.
    """

    def run(batches):
        import numpy as np
        import pyarrow as pa

        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held)
        key, cls, n, pos, salt = (table.column(c).to_numpy() for c in ("key", "cls", "n", "pos", "salt"))
        del held, table
        early = pos <= first_of(n)
        order = np.lexsort((cls, ~early, n, key))
        key, cls, n, pos, salt, early = key[order], cls[order], n[order], pos[order], salt[order], early[order]
        first = np.ones(len(key), bool)
        first[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]) | (n[1:] != n[:-1])
        key, cls, n, pos, salt, early = key[first], cls[first], n[first], pos[first], salt[first], early[first]
        # By size, the last early member before one is the nearest in size of those that it may link with.
        before = np.full(len(key), -1)
        before[1:] = np.maximum.accumulate(np.where(early, np.arange(len(key)), -1))[:-1]
        suits = (before >= 0) & (key[before] == key) & (DENOMINATOR * n[before] >= NUMERATOR * n)
        keep = (salt >= 0) | suits
        keep[before[suits]] = True
        starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        w = np.repeat(np.log(np.diff(np.append(starts, len(key)))), np.diff(np.append(starts, len(key))))
        w = (w + np.where(salt >= 0, np.log(SALTS), 0)).astype(np.float32)
        key, cls, n, pos, w = key[keep], cls[keep], n[keep], pos[keep], w[keep]
        for k in range(0, len(key), 1 << 16):
            yield pa.RecordBatch.from_arrays([pa.array(x[k : k + (1 << 16)]) for x in (key, cls, n, pos, w)], names=["key", "cls", "n", "pos", "w"])

    plain = sets.select(F.posexplode("prefix").alias("pos", "key"), "cls", "n").withColumn("salt", F.lit(-1))
    often = sets.select(F.posexplode("late").alias("pos", "key"), "cls", "n", "prefix").withColumn("pos", F.col("pos") + F.size("prefix"))
    often = often.drop("prefix").withColumn("salt", F.pmod("cls", F.lit(SALTS)).cast("int"))
    every = plain.unionByName(often).where(F.pmod("key", F.lit(parts)) == part)
    return every.repartition(tasks, "key", "salt").mapInArrow(lean(run), "key long, cls long, n long, pos int, w float")


def _apart(pairs: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    one = comps.select(F.col("node").alias("a"), F.col("component").alias("c_a"))
    two = comps.select(F.col("node").alias("b"), F.col("component").alias("c_b"))
    both = pairs.join(one, "a", "left").join(two, "b", "left")
    return both.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def prune(pairs: DataFrame, points: DataFrame, *more: str) -> DataFrame:
    """Pairs (a, b) of classes that the bound by counts lets pass."""
    one = points.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("counts").alias("c_a"))
    two = points.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("counts").alias("c_b"))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in slices_of(batches, 2048):
            c_a, c_b = unpacked(batch.column("c_a").to_pylist()), unpacked(batch.column("c_b").to_pylist())
            n_a, n_b = batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy()
            keep = np.zeros(batch.num_rows, bool)
            sizes: dict[tuple[int, int], list[int]] = {}
            for k, (x, y) in enumerate(zip(c_a, c_b, strict=True)):
                sizes.setdefault((len(x), len(y)), []).append(k)
            for (x, y), every in sizes.items():
                width = min(x, y)
                for lo in range(0, len(every), max(1, CELLS // max(x, y))):
                    rows = every[lo : lo + max(1, CELLS // max(x, y))]
                    over = bound(stacked([c_a[k] for k in rows], width), stacked([c_b[k] for k in rows], width))
                    keep[rows] = may_link(over, n_a[rows], n_b[rows])
            yield batch.select(["a", "b", *more]).filter(pa.array(keep))

    joined = pairs.join(one, "a").join(two, "b").where((DENOMINATOR * F.least("n_a", "n_b")) >= NUMERATOR * F.greatest("n_a", "n_b"))
    return joined.select("a", "b", *more, "n_a", "n_b", "c_a", "c_b").mapInArrow(lean(run), ", ".join(f"{x} long" for x in ("a", "b", *more)))


def verify(docs: DataFrame, pairs: DataFrame, points: DataFrame, tasks: int, most: int = 256) -> DataFrame:
    """Pairs (a, b) whose whole sets link.

    Representatives' texts are read again, and each set goes once to the place of every b it is held
    against. A b with many partners has several places, each with its own copy of b's set.
    """
    pairs = materialize(pairs.select("a", "b").distinct(), "ngram-check")
    # The end with more partners stays, so that even a star of many goes to few places.
    degree = pairs.select(F.explode(F.array("a", "b")).alias("x")).groupBy("x").agg(F.count(F.lit(1)).alias("d"))
    both = pairs.join(degree.select(F.col("x").alias("a"), F.col("d").alias("d_a")), "a").join(degree.select(F.col("x").alias("b"), F.col("d").alias("d_b")), "b")
    swap = F.col("d_a") > F.col("d_b")
    led = materialize(both.select(F.when(swap, F.col("b")).otherwise(F.col("a")).alias("a"), F.when(swap, F.col("a")).otherwise(F.col("b")).alias("b")), "ngram-led")
    places = materialize(led.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("places")), "ngram-places")
    goes = led.join(places, "b").select(F.col("a").alias("cls"), F.col("b").alias("to"), F.pmod(F.xxhash64("a"), F.col("places")).cast("int").alias("place"))
    stays = places.select(F.col("b").alias("cls"), F.col("b").alias("to"), F.explode(F.sequence(F.lit(0), F.col("places") - 1)).alias("place"))
    routes = goes.unionByName(stays).groupBy("cls").agg(F.collect_list(F.struct("to", "place")).alias("routes"))
    routes = materialize(routes.join(points.select("cls", "doc_id"), "cls"), "ngram-routes")
    rows = docs.join(near(routes, weight=F.size("routes")), "doc_id").select("cls", "routes", "text")

    def send(batches):
        import pyarrow as pa
        import xxhash

        known = Hashes()
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.binary()]
        for batch in slices_of(batches, 64):
            for r in batch.to_pylist():
                bag = shingles(r["text"], known).tobytes()
                if xxhash.xxh3_64_intdigest(bag) - (1 << 63) != r["cls"]:  # a doc_id may stand for several texts
                    continue
                for lo in range(0, len(r["routes"]), 64):
                    columns = zip(*[(x["to"], x["place"], int(x["to"] != r["cls"]), r["cls"], bag) for x in r["routes"][lo : lo + 64]], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["to", "place", "other", "cls", "bag"])

    def meet(batches):
        import numpy as np
        import pyarrow as pa

        for table in whole_groups(batches, ["to", "place"], 256):
            at = bounds(table, ["to", "place"])
            other, cls, bags = table.column("other").to_pylist(), table.column("cls").to_pylist(), table.column("bag")
            a, b = [], []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                if other[lo]:
                    continue
                own = np.frombuffer(bags[lo].as_py(), "<u8")
                for k in range(lo + 1, hi):
                    if not other[k]:
                        continue
                    bag = np.frombuffer(bags[k].as_py(), "<u8")
                    both = len(np.intersect1d(own, bag, assume_unique=True))
                    if DENOMINATOR * both >= NUMERATOR * (len(own) + len(bag) - both):
                        a.append(cls[k]), b.append(cls[lo])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    sent = rows.mapInArrow(lean(send), "to long, place int, other int, cls long, bag binary")
    met = sent.repartition(tasks, "to", "place").sortWithinPartitions("to", "place", "other").mapInArrow(lean(meet), "a long, b long")
    out = materialize(met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "ngram-links")
    for table in (pairs, led, places, routes):
        drop(table)
    settle(docs.sparkSession)
    return out


class Tree:
    """A packed R-tree of points: levels of nodes with the greatest counts and the ranges of what lies below."""

    def __init__(self, counts, n, comp, own, coarse, fan: int = FAN):
        import numpy as np

        self.levels, self.fan = [(counts, n, n, comp, comp, own, own, coarse)], fan
        while len(self.levels[-1][0]) > fan * fan:  # the root holds what is left
            high, n_low, n_high, c_low, c_high, o_low, o_high, some = self.levels[-1]
            starts = np.arange(0, len(high), fan)
            ways = ((np.maximum, high), (np.minimum, n_low), (np.maximum, n_high), (np.minimum, c_low), (np.maximum, c_high), (np.minimum, o_low), (np.maximum, o_high), (np.maximum, some))
            self.levels.append(tuple(way.reduceat(x, starts, axis=0) for way, x in ways))

    def passing(self, level: int, i, j, cross: bool):
        """Which pairs of nodes of a level may hold a pair of rows that link and are apart."""
        import numpy as np

        high, n_low, n_high, c_low, c_high, o_low, o_high, some = self.levels[level]
        least, most = np.minimum(n_low[i], n_low[j]), np.maximum(n_low[i], n_low[j])
        ok = DENOMINATOR * np.minimum(n_high[i], n_high[j]) >= NUMERATOR * most
        ok &= (c_low[i] != c_high[i]) | (c_low[j] != c_high[i]) | (c_high[j] != c_high[i])
        ok &= some[i] | some[j]
        if cross:
            ok &= (o_low[i] != o_high[i]) | (o_low[j] != o_high[i]) | (o_high[j] != o_high[i])
        at, step = np.flatnonzero(ok), max(1, CELLS // high.shape[1])
        for k in range(0, len(at), step):
            own = at[k : k + step]
            ok[own] = may_link(bound(high[i[own]], high[j[own]]), least[own], most[own])
        return ok

    def search(self, cross: bool):
        """Rows (i, j) that may link and are apart, by opening pairs of nodes from the root down."""
        import numpy as np

        out, top = [], len(self.levels) - 1
        todo = [(top, *np.triu_indices(len(self.levels[top][0])))]
        child = np.arange(self.fan)
        while todo:
            level, i, j = todo.pop()
            if level == 0:
                i, j = i[i < j], j[i < j]
            ok = self.passing(level, i, j, cross)
            i, j = i[ok], j[ok]
            if level == 0:
                out.append((i, j))
                continue
            below = len(self.levels[level - 1][0])
            for k in range(0, len(i), 1024):  # depth first, so few pairs are open at a time
                x = (i[k : k + 1024, None, None] * self.fan + child[:, None]) + 0 * child
                y = (j[k : k + 1024, None, None] * self.fan + child) + 0 * child[:, None]
                inside = (x < below) & (y < below) & (x <= y)
                todo.append((level - 1, x[inside], y[inside]))
        return np.concatenate([x for x, _ in out] or [np.empty(0, np.int64)]), np.concatenate([y for _, y in out] or [np.empty(0, np.int64)])


def tree_pairs(comp, n, counts: list, own, cross: bool):
    """Pairs of rows that may link and are in different components, by R-trees searched with themselves.

    Points that link have like numbers of groups, or one twice the other's: there is a tree for each number,
    with the points of twice as many groups folded onto it, for pairs that are not both folded.
    """
    import numpy as np

    widths = np.array([len(c) for c in counts])
    out_a, out_b = [], []
    for width in np.unique(widths).tolist():
        own_width = np.flatnonzero(widths == width)
        folded = np.flatnonzero(widths == 2 * width)
        rows = np.concatenate([own_width, folded])
        if len(rows) < 2 or comp[rows].min() == comp[rows].max():
            continue
        points = np.concatenate([stacked([counts[k] for k in some], width) for some in (own_width, folded) if len(some)])
        if len(rows) > FAN * FAN:
            # Packed by size, and within like sizes by the coordinates that differ most.
            band = (np.log(n[rows]) * 8).astype(np.int64)
            telling = np.argsort(-points[:: len(points) // (FAN * FAN)].var(axis=0))[:8]
            place = ((points[:, telling] > np.median(points[:, telling], axis=0)) << np.arange(len(telling))).sum(axis=1)
            order = np.lexsort((comp[rows], place, band))
            rows, points = rows[order], points[order]
        i, j = Tree(points, n[rows], comp[rows], own[rows], widths[rows] == width).search(cross)
        out_a.append(rows[i]), out_b.append(rows[j])
    if not out_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(out_a), np.concatenate(out_b)


def rest_pairs(entries: DataFrame, comps: DataFrame, points: DataFrame, tasks: int, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Pairs that the stars leave: members of one list, in different components, that may link; and the written table behind."""
    placed = entries.select("key", "cls").join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    lists = placed.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("cls").alias("least"), F.max("cls").alias("most"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.bit_xor(F.xxhash64("cls")).alias("s"), F.bit_xor("cls").alias("x"))
    # Up to three members are all paired by the stars; lists with the same members are searched once.
    lists = lists.where("m > 3 AND lo <> hi").groupBy("m", "s", "x").agg(F.min(F.struct("key", "least", "most")).alias("l")).select("l.*", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    lists = materialize(lists, "ngram-lists")
    # All pairs of a list's least and greatest class are stars.
    members = placed.join(lists, "key").where("cls <> least AND cls <> most").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    both = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda v: F.struct(F.least(v, F.col("own")).alias("x"), F.greatest(v, F.col("own")).alias("y")))
    dealt = members.select("key", "cls", "comp", "own", F.explode(both).alias("p")).select("key", F.col("p.x").alias("x"), F.col("p.y").alias("y"), "cls", "comp", "own")
    dealt = dealt.join(points.select("cls", "n", F.col("fine").alias("counts")), "cls")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        keys = ["key", "x", "y"]
        for table in whole_groups(batches, keys, 4096):
            at = bounds(table, keys)
            cls, comp, own, n, x, y = (table.column(c).to_numpy() for c in ("cls", "comp", "own", "n", "x", "y"))
            points = table.column("counts")
            out = []
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                counts = unpacked(points.slice(lo, hi - lo).to_pylist())
                a, b = tree_pairs(comp[lo:hi], n[lo:hi], counts, own[lo:hi], bool(x[lo] != y[lo]))
                if len(a):
                    one, two = cls[lo:hi][a], cls[lo:hi][b]
                    out.append((np.minimum(one, two), np.maximum(one, two)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[0] for o in out])), pa.array(np.concatenate([o[1] for o in out]))], names=["a", "b"])

    return dealt.repartition(tasks, "key", "x", "y").sortWithinPartitions("key", "x", "y").mapInArrow(lean(run), "a long, b long").distinct(), lists


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs."""
    spark = docs.sparkSession
    docs = ensure(docs, doc_id="long", text="string")
    last = hints(docs)
    sets = materialize(described(docs, last), "ngram-sets", compression="zstd")
    conf = int(spark.conf.get("spark.sql.shuffle.partitions"))
    total = sets.agg(F.coalesce(F.sum(F.size("prefix") + F.size("late")), F.lit(0)).alias("n")).first().n
    tasks = max(conf, -(-total // (PARTS * ENTRIES)))
    gathered = []
    for part in range(PARTS):
        gathered.append(materialize(shared_entries(sets, tasks, part, PARTS), "ngram-entries"))
        settle(spark)
    entries = functools.reduce(DataFrame.unionByName, gathered)
    classes = sets.select("cls", "doc_id", "n", "counts").join(entries.select("cls").distinct(), "cls", "left_semi")
    points = classes.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("counts").alias("counts"))
    points = materialize(coarse_and_fine(points), "ngram-points")
    # The prefixes and the counts of the others are large and not read again.
    whole = materialize(sets.select("doc_id", "n", "cls"), "ngram-ids")
    drop(sets)
    settle(spark)

    # Stars. A class most of whose hashes are shared, and widely, stands in the middle of its copies.
    member = F.struct("cls", "n", "pos")
    prefix = F.col("n") - F.ceil(NUMERATOR * F.col("n") / DENOMINATOR) + 1
    scored = entries.withColumn("score", F.sum("w").over(Window.partitionBy("cls")) / prefix)
    lists = scored.groupBy("key").agg(F.min(member).alias("lo"), F.max(member).alias("hi"), F.max_by(member, F.struct("score", "cls")).alias("mid"))
    stars = entries.select("key", "cls", "n", "pos").join(lists, "key")
    pairs = stars.select("cls", "n", "pos", F.explode(F.array_distinct(F.array("lo", "hi", "mid"))).alias("star"))
    # Sizes that cannot link go before the pairs are counted, and so do places that the first common hash of a link cannot have.
    suits = DENOMINATOR * F.least("n", F.col("star.n")) >= NUMERATOR * F.greatest("n", F.col("star.n"))
    pairs = pairs.where(suits & meets(F.col("n"), F.col("pos"), F.col("star.n"), F.col("star.pos"))).select(F.col("cls").alias("a"), F.col("star.cls").alias("b")).where("a <> b")
    pairs = pairs.groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.count(F.lit(1)).alias("shared"))
    pairs = materialize(prune(pairs, points, "shared"), "ngram-stars")
    settle(spark)
    # First the partner with whom a class shares most, then the pairs that are still apart.
    ends = pairs.select(F.col("a").alias("cls"), F.col("b").alias("other"), "shared").unionByName(pairs.select(F.col("b").alias("cls"), F.col("a").alias("other"), "shared"))
    best = ends.groupBy("cls").agg(F.max_by("other", F.struct("shared", "other")).alias("other"))
    best = best.select(F.least("cls", "other").alias("a"), F.greatest("cls", "other").alias("b")).distinct()
    links = verify(docs, best, points, conf)
    links = links.unionByName(verify(docs, _apart(pairs, connected_components(links)), points, conf))
    comps = connected_components(links)
    more, lists = rest_pairs(entries, comps.select(F.col("node").alias("cls"), F.col("component").alias("comp")), points, conf)
    more = materialize(more.join(pairs, ["a", "b"], "left_anti"), "ngram-rest")
    for table in (*gathered, pairs, lists):
        drop(table)
    settle(spark)
    comps = connected_components(links.unionByName(verify(docs, more, points, conf)))
    drop(more)
    drop(points)

    # Components are named by class hashes so far; each gets its smallest doc_id.
    classes = whole.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id")).join(comps.select(F.col("node").alias("cls"), F.col("component").alias("comp")), "cls", "left")
    named = classes.where("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("name"))
    names = materialize(classes.join(named, "comp", "left").select("cls", F.coalesce("name", "doc_id").alias("name")), "ngram-names")
    out = whole.select("doc_id", "n", F.when(F.col("n") > 0, F.col("cls")).alias("cls")).join(names, "cls", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("name", "doc_id")).alias("component_id"))

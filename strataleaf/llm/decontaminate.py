"""Operator 10: benchmark decontamination by latent semantic retrieval.

1. Benchmark items and documents become words (letters and digits, lower-cased), coded by the items' vocabulary.
   Every document's whole text is cut into blocks of STEP words; a passage is a run of blocks.
2. Document frequencies of the vocabulary are counted over the blocks of all documents, and give
   each word its inverse frequency; words in more than STOP of all blocks weigh nothing in the search.
   Items that keep less than KEPT of their words so (common words, or a large group of copies that
   hold the item) are searched a second time, with no weight below FLOOR of a new word's.
3. A randomised SVD of the TF-IDF passages gives RANK latent directions: a random range finder with
   POWER iterations, whose products with the matrix are summed over the tasks that hold its rows. The
   directions are taken from the starts and products of all iterations, so the last needs no product of its own;
   both kinds of weights are fitted in the same reads.
   The rows are the items, which weigh as much as all others together, and every passage of WIDTH blocks
   of every document; nothing is sampled.
4. Every passage of every document, at the scale of each item's length, is compared with every item
   by cosine in the latent space, a block of documents against a block of items. The passage's
   length counts all its words, and cosines are scaled so that an item's own text has 1.
5. Candidates whose passage has too few of the item's words for any verdict are left out (exactly,
   by a count). The others are verified on the words: the longest common subsequence of item and passage must
   hold LCS of the item's words, or LOOSE of them with the item's answer in order too (paraphrases). The
   answer is the column `answer`, or else the item's last ANSWER words.

The benchmark is the stated query set, searched in blocks of ITEMS items; nothing of the documents but
counts of the vocabulary and the sums of step 3 reach the driver.

Items shorter than LEAST words have too little for a likeness: they are found where their words stand in one
run, word for word, and items under RUN words only where they are the whole document.

Nulls: null or empty texts hold no passage; items that are null or without a word are not
searched for; a null doc_id is reported like any other. Equal items are each reported. Empty tables
give an empty result. Repeated rows are reported each; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ensure, lean, materialize, slices_of

STEP, WIDTH, RANK, OVER, POWER, ITEMS = 16, 4, 64, 16, 2, 4096
STOP, FLOOR, KEPT = 0.01, 0.3, 0.6
COSINE, LCS, LOOSE, ANSWER, LEAST, RUN = 0.28, 0.75, 0.55, 5, 8, 3
_SPACE = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SCHEMA = "doc_id long, item_id long, position long, cosine double, lcs double, answer boolean"


def words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "replace").translate(_SPACE).split()


def lcs_length(masks: dict[int, int], sequence) -> int:
    """Longest common subsequence, bit-parallel: masks has the places of each word in the item."""
    row = ~0
    for word in sequence:
        place = masks.get(word)
        if place:
            u = row & place
            row = (row + u) | (row - u)
    return (~row).bit_count() if row < 0 else 0


def masks_of(ids) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, word in enumerate(ids):
        out[int(word)] = out.get(int(word), 0) | 1 << k
    return out


def lcs_lengths(table: tuple, bits, which, ids, first, last, least=None):
    """lcs_length() of many items (of up to 64 words, in table) with the regions from first to last, a word of each at a time.

    Regions with fewer than `least` words of their item, which bounds the length, have 0.
    """
    import numpy as np

    keys, masks, size = table
    out = np.zeros(len(which), np.int64)
    for rows, words, there in marked(bits, which, ids, first, last):
        many = there.sum(axis=1)
        some = np.arange(len(many)) if least is None else np.flatnonzero(many >= least[rows])
        item, many = which[rows][some], many[some]
        row, column = np.nonzero(there[some])
        places = masks[np.searchsorted(keys, item[row] * np.int64(size) + words[some[row], column])]
        order = np.argsort(-many, kind="stable")
        start = (np.cumsum(many) - many)[order]
        state = np.full(len(item), ~np.uint64(0))
        for t, m in enumerate(np.cumsum(np.bincount(many)[::-1])[-2::-1].tolist()):  # so many have a word t
            old = state[:m]
            new = old & places[start[:m] + t]
            state[:m] = (old + new) | (old - new)
        out[rows][some[order]] = np.bitwise_count(~state)
    return out


def table_of(items: list, size: int) -> tuple:
    """What lcs_lengths() looks up: item and word as one number, in order, and the word's places in the item."""
    import numpy as np

    found = sorted((k * size + word, place) for k, ids in enumerate(items) if len(ids) <= 64 for word, place in masks_of(ids).items())
    return np.array([x for x, _ in found], np.int64), np.array([x for _, x in found], np.uint64), size


def coded(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, ids: the vocabulary's places of a text's words as int32, -1 for others."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        import itertools

        import numpy as np
        import pyarrow as pa

        known = sent.value
        for batch in slices_of(batches):
            out = []
            for text in batch.column("text").to_pylist():
                parts = words(text)
                out.append(np.fromiter(map(known.get, parts, itertools.repeat(-1)), np.int32, len(parts)).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())], names=["doc_id", "ids"])

    return docs.mapInArrow(lean(run), "doc_id long, ids binary")


def joined(batch, step: int):
    """Ids of a batch's documents, each filled up to whole blocks; first block of each and the end."""
    import numpy as np

    parts, at = [], [0]
    for raw in batch.column("ids").to_pylist():
        ids = np.frombuffer(raw, np.int32)
        blocks = -(-len(ids) // step)
        parts.append(ids)
        parts.append(np.full(blocks * step - len(ids), -1, np.int32))
        at.append(at[-1] + blocks)
    return np.concatenate(parts) if parts else np.empty(0, np.int32), np.array(at)


def slices(batches, most: int = 1 << 18):
    """Batches of few enough words for bounded memory; a longer document comes alone."""
    for batch in batches:
        sizes = [len(x) // 4 for x in batch.column("ids").to_pylist()]
        lo = total = 0
        for k, n in enumerate(sizes):
            if total and total + n > most:
                yield batch.slice(lo, k - lo)
                lo, total = k, 0
            total += n
        if lo < len(sizes):
            yield batch.slice(lo)


def frequencies(coded_: DataFrame, size: int, step: int = STEP):
    """Blocks that hold each word of the vocabulary, over all documents, and the number of blocks."""
    import numpy as np

    def run(batches):
        import pyarrow as pa

        total, n = np.zeros(size, np.int64), 0
        for batch in slices(batches):
            ids, at = joined(batch, step)
            n += int(at[-1])
            rows = np.sort(ids.reshape(-1, step), axis=1)
            first = rows >= 0
            first[:, 1:] &= rows[:, 1:] != rows[:, :-1]
            total += np.bincount(rows[first], minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(there, -1).astype(np.int64)), pa.array(np.append(total[there], n))], names=["id", "n"])

    found = coded_.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    out, blocks = np.zeros(size), 0
    for r in found:
        if r.id < 0:
            blocks = r.n
        else:
            out[r.id] = r.n
    return out, blocks


def weights_of(seen, blocks: int, floor: bool = False):
    """Weight of each word from the number of blocks that hold it; with floor, none is without weight."""
    import numpy as np

    idf = np.log((blocks + 1) / (seen + 1)) + 1e-3
    if floor:
        return np.maximum(idf, FLOOR * np.log(blocks + 1))
    return np.where(seen <= max(STOP * blocks, 3), idf, 0.0)


def sparse(lists, idf):
    """TF-IDF rows (row, column, value, in that order) of length 1, of lists of ids."""
    import numpy as np

    size = len(idf)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    ids = np.concatenate(lists) if lists else np.empty(0, np.int32)
    row, ids = row[ids >= 0], ids[ids >= 0]
    cell, tf = np.unique(row * np.int64(size) + ids, return_counts=True)
    keep = idf[cell % size] > 0
    cell, tf = cell[keep], tf[keep]
    row, col = cell // size, cell % size
    value = tf * idf[col]
    norm = np.sqrt(np.bincount(row, value**2, minlength=len(lists)))
    return row, col, value / norm[row]


def gram_times(row, col, value, q):
    """A'(A q) for a sparse A in row order."""
    import numpy as np

    if not len(row):
        return np.zeros_like(q)
    starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    y = np.add.reduceat(q[col] * value[:, None], starts, axis=0)
    at = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(row))))
    order = np.argsort(col, kind="stable")
    first = np.flatnonzero(np.append(True, col[order][1:] != col[order][:-1]))
    out = np.zeros_like(q)
    out[col[order][first]] = np.add.reduceat(y[at[order]] * value[order][:, None], first, axis=0)
    return out


def run_sums(table, at, first, most: int = 16):
    """Sums of table[at] by runs that begin at first; reduceat takes several times as long for short runs."""
    import numpy as np

    size = np.diff(np.append(first, len(at)))
    pieces = -(-size // most)
    if pieces.max(initial=0) > 1:
        begin = np.cumsum(pieces) - pieces
        inner = np.repeat(first, pieces) + (np.arange(pieces.sum()) - np.repeat(begin, pieces)) * most
        return run_sums(run_sums(table, at, inner, most), np.arange(len(inner)), begin, most)
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    total = table[at[first]]
    for k in range(1, int(size.max(initial=0))):
        m = int(np.searchsorted(-size, -k))
        total[:m] += table[at[first[:m] + k]]
    out = np.empty_like(total)
    out[order] = total
    return out


def windows(x, width: int):
    """Sums of every `width` rows that follow one another, by doubling."""
    out, have, total, done = x, 1, None, 0
    n = len(x) - width + 1
    while True:
        if width & have:
            part = out[done : done + n]
            total = part if total is None else total + part
            done += have
        if 2 * have > width:
            return total
        out = out[:-have] + out[have:]
        have *= 2


def passages_times(ids, at, idf, q, step: int = STEP, width: int = WIDTH, most: int = 1 << 12):
    """gram_times() of all passages of `width` blocks of a batch's documents (ids and at of joined), one begun at every block.

    A passage is the sum of its blocks, so each word is met once forth and once back, not once a passage. Starts
    are taken `most` at a time, with the blocks that they reach; each document is followed by empty blocks.
    """
    import numpy as np

    far, weight, out = width - 1, np.append(idf, 0.0), np.zeros(q.shape)
    weighted = (q * idf[:, None]).astype(np.float32)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    for lo in range(0, len(doc), most):
        hi = min(lo + most + far, len(doc))
        part = ids[lo * step : hi * step]
        where = np.flatnonzero(weight[part] > 0)
        if not len(where):
            continue
        place = np.arange(hi - lo) + far * (1 + doc[lo:hi] - doc[lo])
        n = int(place[-1]) + 1 + far
        words, blocks = part[where], place[where // step]
        key = np.sort(words * np.int64(n) + blocks)
        # Squared lengths: a word's cells in one passage count by themselves and in pairs, from the last's first passage to the first's last.
        new = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        cell, tf = key[new], np.diff(np.append(new, len(key)))
        col, block = cell // n, cell % n
        mass = (tf * idf[col]) ** 2
        change = np.bincount(block - far, mass, n + 1) - np.bincount(block + 1, mass, n + 1)
        for k in range(1, width):
            i = np.flatnonzero(cell[k:] - cell[:-k] < width)
            mass = 2.0 * tf[i] * tf[i + k] * idf[col[i]] ** 2
            change += np.bincount(block[i + k] - far, mass, n + 1) - np.bincount(block[i] + 1, mass, n + 1)
        square = np.cumsum(change)[:n]
        start = place[:most]
        start = start[square[start] > 1e-9]
        share = np.zeros((n, 1), np.float32)
        share[start, 0] = 1 / square[start]
        sums, y = np.zeros((n + far, q.shape[1]), np.float32), np.zeros((n + far, q.shape[1]), np.float32)
        first = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1]))
        sums[blocks[first]] = run_sums(weighted, words, first)
        np.multiply(windows(sums, width), share, out=y[far:])
        back = windows(y, width)
        first = np.flatnonzero(np.append(True, key[1:] // n != key[:-1] // n))
        out[key[first] // n] += run_sums(back, key % n, first)
    return out * idf[:, None]


def latent(coded_: DataFrame, items: list, idf, blocks: int, beside: list | None = None, rank: int = RANK, over: int = OVER, power: int = POWER, seed: int = 7):
    """The leading right singular vectors (vocabulary x rank) of the TF-IDF rows of all passages and the items.

    With beside, more pairs of items and weights that are fitted in the same reads, a list of all of them.
    """
    import numpy as np

    spark, size = coded_.sparkSession, len(idf)
    wide = min(size, rank + over)
    views = []
    for some, weights in [(items, idf), *(beside or [])]:
        row, column, value = sparse(some, weights)
        views.append((weights, (row, column, value * np.sqrt(blocks / max(1, len(some))))))

    def times(qs):
        sent = spark.sparkContext.broadcast([(weights, q) for (weights, _), q in zip(views, qs, strict=True)])

        def run(batches):
            import pyarrow as pa

            known = sent.value
            total = np.zeros((len(known), size, wide))
            for batch in slices(batches):
                ids, at = joined(batch, STEP)
                for k, (weights, q) in enumerate(known):
                    total[k] += passages_times(ids, at, weights, q)
            total = total.reshape(-1, wide)
            there = np.flatnonzero(total.any(axis=1))
            ends = pa.array(np.arange(len(there) + 1, dtype=np.int32) * wide)
            yield pa.RecordBatch.from_arrays([pa.array(there), pa.ListArray.from_arrays(ends, pa.array(total[there].ravel()))], names=["id", "x"])

        # Each task sends one vocabulary of sums a view; they meet by word, then the driver has the total.
        parts = coded_.mapInArrow(run, "id long, x array<double>")
        sums = parts.groupBy("id").agg(*[F.sum(F.col("x")[k]).alias(f"s{k}") for k in range(wide)])
        out = np.stack([gram_times(*own, q) for (_, own), q in zip(views, qs, strict=True)])
        for r in sums.collect():
            out[divmod(r[0], size)] += np.array(r[1:])
        sent.unpersist()
        return out

    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, wide)))[0]
    starts, products = [np.stack([q] * len(views))], []
    for _ in range(power):
        products.append(times(starts[-1]))
        starts.append(np.linalg.qr(products[-1])[0])
    out = [leading(np.hstack([x[k] for x in starts[:-1]]), np.hstack([x[k] for x in products]), rank) for k in range(len(views))]
    return out if beside is not None else out[0]


def leading(starts, products, rank: int):
    """The leading directions of a Gram matrix by its products with all starts (block Krylov), by Nystrom's formula."""
    import numpy as np

    basis, length, turned = np.linalg.svd(starts, full_matrices=False)
    keep = length > 0.01  # starts may lie in one another's span
    products = products @ (turned[keep].T / length[keep])
    core = basis[:, keep].T @ products
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    keep = values > values.max(initial=0) * 1e-6
    return np.linalg.svd(products @ (vectors[:, keep] / np.sqrt(values[keep])), full_matrices=False)[0][:, :rank]


def holders(items: list, size: int):
    """Bits of the words that each item has, one row an item; place -1, the last bits, is in none."""
    import numpy as np

    out = np.zeros((len(items), size // 8 + 2), np.uint8)
    for k, ids in enumerate(items):
        ids = np.unique(ids)
        np.bitwise_or.at(out[k], ids >> 3, (1 << (ids & 7)).astype(np.uint8))
    return out


def marked(bits, which, ids, first, last, most: int = 4096):
    """For `most` regions from first to last at a time: where they stand in the list, their words, and which of these their item has."""
    import numpy as np

    width = np.arange(int((last - first).max(initial=0)))
    for k in range(0, len(which), most):
        rows = slice(k, k + most)
        at = first[rows, None] + width
        words = ids[np.minimum(at, len(ids) - 1)]
        bit = bits[which[rows, None], words >> 3] >> (words & 7).astype(np.uint8)
        yield rows, words, (bit & (at < last[rows, None]) & 1).view(bool)


def held(bits, which, ids, first, last):
    """Words of the region from first to last that its item has, which bounds their common subsequence."""
    import numpy as np

    out = np.zeros(len(which), np.int64)
    for rows, _, there in marked(bits, which, ids, first, last):
        out[rows] = there.sum(axis=1)
    return out


def search(coded_: DataFrame, items: list, item_ids: list[int], answers: list, views: list, unseen: float, step: int = STEP, cosine: float = COSINE, strict: float = LCS, loose: float = LOOSE) -> DataFrame:
    """One row for each document and item whose passage survives the checks, its best passage."""
    import numpy as np

    seen_as = []
    for idf, directions, which in views:
        weighted = (directions * idf[:, None]).astype(np.float32)
        scales: dict[int, list[int]] = {}
        for k in which:  # blocks that hold the item wherever a block begins, but for half a block
            scales.setdefault(-(-(len(items[k]) + step // 2) // step), []).append(k)
        own = np.stack([weighted[ids].sum(axis=0) for ids in items]).astype(np.float64)
        whole = np.sqrt(np.array([(idf[ids] ** 2).sum() for ids in items]))
        own *= (whole / np.maximum((own**2).sum(axis=1), 1e-12))[:, None]
        squares = np.append(idf**2, unseen**2)  # place -1: a word outside the vocabulary
        seen_as.append((weighted, squares, own.astype(np.float32), scales))
    size = len(views[0][0])
    bits = holders(items, size)
    sent = coded_.sparkSession.sparkContext.broadcast((seen_as, bits, table_of(items, size), [masks_of(x) for x in items], [masks_of(x) for x in answers], [len(x) for x in items], [len(x) for x in answers], item_ids))

    def run(batches):
        import pyarrow as pa

        seen_as, bits, table, masks, answers, lengths, answer_lengths, item_ids = sent.value
        sizes = np.array(lengths)
        for batch in slices(batches):
            ids, at = joined(batch, step)
            n = int(at[-1])
            if not n:
                continue
            doc = np.repeat(np.arange(batch.num_rows), np.diff(at))
            ends = at[doc + 1]
            left = ends - np.arange(n)
            best: dict[tuple[int, int], tuple] = {}
            for weighted, squares, own, scales in seen_as:
                telling = squares > 0
                telling[-1] = False
                where = np.flatnonzero(telling[ids])
                passage = np.zeros((n, weighted.shape[1]), np.float32)
                if len(where):
                    held_by = where // step
                    first = np.flatnonzero(np.append(True, held_by[1:] != held_by[:-1]))
                    passage[held_by[first]] = run_sums(weighted, ids[where], first)
                sums, have = passage.copy(), 1
                mass = np.append(0, np.cumsum(squares[ids].reshape(n, step) @ np.ones(step)))
                for blocks in sorted(scales):
                    which = np.array(scales[blocks])
                    for d in range(have, min(blocks, n)):  # one block more, but where the document has no more
                        over = np.flatnonzero(left[: n - d] <= d)
                        kept = passage[over]
                        passage[: n - d] += sums[d:]
                        passage[over] = kept
                    have = max(have, blocks)
                    end = np.minimum(np.arange(n) + blocks, ends)
                    length = np.sqrt(np.maximum(mass[end] - mass[:n], 1e-9)).astype(np.float32)
                    bar, side = (np.float32(cosine) * length)[:, None], own[which]
                    found = []
                    for lo in range(0, n, 1024):
                        close = passage[lo : lo + 1024] @ side.T
                        at_ = np.flatnonzero(close >= bar[lo : lo + 1024])
                        found.append((lo + at_ // len(which), which[at_ % len(which)], close.ravel()[at_]))
                    block, chosen, close = (np.concatenate(x) for x in zip(*found, strict=True))
                    close = close / length[block]
                    first, last = np.maximum(block - 1, at[doc[block]]) * step, np.minimum(end[block] + 1, ends[block]) * step
                    common, small = np.zeros(len(block), np.int64), sizes[chosen] <= 64
                    common[small] = lcs_lengths(table, bits, chosen[small], ids, first[small], last[small], loose * sizes[chosen[small]])
                    large = np.flatnonzero(~small)
                    for k in large[held(bits, chosen[large], ids, first[large], last[large]) >= loose * sizes[chosen[large]]].tolist():
                        common[k] = lcs_length(masks[chosen[k]], ids[first[k] : last[k]].tolist())
                    some = common / sizes[chosen] >= loose
                    rows = zip(*(x[some].tolist() for x in (doc[block], chosen, close, common, first, last, at[doc[block]])), strict=True)
                    for d, item, cosine_, common, first, last, begin in rows:
                        share, told = common / lengths[item], lcs_length(answers[item], ids[first:last].tolist()) >= 0.8 * answer_lengths[item]
                        if share >= strict or told:
                            row = (share, cosine_, told, first - begin * step)
                            if (d, item) not in best or row[:2] > best[d, item][:2]:
                                best[d, item] = row
            if best:
                docs = batch.column("doc_id").to_pylist()
                rows = [(docs[d], item_ids[k], position, close, share, told) for (d, k), (share, close, told, position) in best.items()]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["doc_id", "item_id", "position", "cosine", "lcs", "answer"])

    return coded_.mapInArrow(lean(run), SCHEMA)


def whole(coded_: DataFrame, items: list, item_ids: list[int]) -> DataFrame:
    """One row for each document and item whose words stand in the document in one run, or are all of it (items under RUN)."""
    import numpy as np

    lengths: dict[int, list[int]] = {}
    for k, ids in enumerate(items):
        lengths.setdefault(len(ids), []).append(k)
    sent = coded_.sparkSession.sparkContext.broadcast((items, lengths, item_ids))

    def codes(ids, n: int):
        out = np.zeros(max(0, len(ids) - n + 1), np.uint64)
        for k in range(n):
            out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k : len(ids) - n + 1 + k].astype(np.uint64)
        return out

    def run(batches):
        import pyarrow as pa

        items, lengths, item_ids = sent.value
        known = {n: np.array([codes(items[k], n)[0] for k in which]) for n, which in lengths.items()}
        for batch in slices(batches):
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                ids = np.frombuffer(raw, np.int32)
                for n, which in lengths.items():
                    if len(ids) < n or n < RUN and len(ids) != n:
                        continue
                    own = codes(ids, n)
                    for at in np.flatnonzero(np.isin(own, known[n])).tolist():
                        rows += [(doc_id, item_ids[k], at, 1.0, 1.0, True) for k in which if (items[k] == ids[at : at + n]).all()]
            first = {row[:2]: row for row in reversed(rows)}
            columns = list(zip(*first.values(), strict=True)) if first else [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["doc_id", "item_id", "position", "cosine", "lcs", "answer"])

    return coded_.mapInArrow(lean(run), SCHEMA)


def find(docs: DataFrame, benchmark: DataFrame, **limits: float) -> DataFrame:
    """doc_id, item_id, position, cosine, lcs, answer: each document that holds a benchmark item."""
    import itertools

    docs = ensure(docs, doc_id="long", text="string")
    answer = F.col("answer").cast("string") if "answer" in benchmark.columns else F.lit(None).cast("string")
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"), answer.alias("answer"))
    # The query set, block by block; each block is one search of all documents, and the driver holds one block.
    listed = ((r.item_id, words(r.text), words(r.answer)) for r in rows.orderBy(F.col("item_id").asc_nulls_last(), "text").toLocalIterator())
    listed = (x for x in listed if x[1])
    out = None
    while some := list(itertools.islice(listed, ITEMS)):
        hits = find_block(docs, some, **limits)
        out = hits if out is None else out.unionByName(hits)
    return out if out is not None else docs.sparkSession.createDataFrame([], SCHEMA)


def find_block(docs: DataFrame, some: list, **limits: float) -> DataFrame:
    """find() for a block of items (id, words, answer's words)."""
    import numpy as np

    vocabulary = {w: k for k, w in enumerate(sorted({w for _, text, told in some for w in [*text, *told]}))}
    table = materialize(coded(docs, vocabulary), "clean-coded", compression="snappy")

    def ids_of(text):
        return np.array([vocabulary[w] for w in text], np.int32)

    short = [x for x in some if len(x[1]) < LEAST]
    some = [x for x in some if len(x[1]) >= LEAST]
    brief = whole(table, [ids_of(x[1]) for x in short], [x[0] for x in short]) if short else None
    if not some:
        return brief
    seen, blocks = frequencies(table, len(vocabulary))
    ids = [ids_of(text) for _, text, _ in some]
    told = [ids_of(answer or text[-ANSWER:]) for _, text, answer in some]
    plain = weights_of(seen, blocks)
    weak = [(plain[x] > 0).mean() < KEPT for x in ids]
    views = [(weights_of(seen, blocks, floor), which) for floor, which in ((False, list(range(len(ids)))), (True, [k for k, x in enumerate(weak) if x])) if which]
    fits = [([ids[k] for k in which], idf) for idf, which in views]
    views = [(idf, directions, which) for (idf, which), directions in zip(views, latent(table, *fits[0], blocks, fits[1:]), strict=True)]
    hits = search(table, ids, [x[0] for x in some], told, views, float(np.log(blocks + 1)), **limits)
    return hits if brief is None else hits.unionByName(brief)

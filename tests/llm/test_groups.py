"""Operators 5, 6, 8 and 9: vectors, n-grams, mixing, shards."""

import collections
import random
import re
import zlib

import numpy as np

from strataleaf.llm import mixing, ngrams, pivots, sharding

from .helpers import WORD, awkward, docs


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    sets, parent = {}, {}
    for i, t, *_ in rows:
        sets[i], parent[i] = sets_of(t), i

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                p, q = find(a), find(b)
                parent[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_copies(seed, n=160):
    rng = random.Random(seed)
    base = [[rng.choice(WORD) + str(rng.randrange(40)) for _ in range(rng.choice([4, 12, 40, 90]))] for _ in range(12)]
    passage = [rng.choice(WORD) + str(k) for k in range(30)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base[:3] if i % 2 else base))
        for _ in range(rng.randrange(4)):
            words[rng.randrange(len(words))] = rng.choice(WORD) + "x"
        if i % 5 == 0:
            words += passage
        rows.append((i, " ".join(words), "en", "s"))
    return rows


def test_components_are_the_brute_force(spark):
    for seed in (1,):
        rows = near_copies(seed) + [(500, None, None, None), (501, "", "en", "s"), (502, "One two three", "en", "s"), (503, "ONE two\tthree", "en", "s")]
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngrams.components(docs(spark, rows)).collect()}
        assert got == brute_components(rows)


def test_tree_finds_what_stars_leave():
    rng = np.random.default_rng(3)
    n = 90
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    bags = []
    for _ in range(n):
        bag = base.copy()
        bag[: rng.integers(4, 14)] = rng.integers(0, 2**63, 14, dtype=np.uint64)[: 1]
        bags.append(np.unique(bag))
    counts = np.stack([ngrams.counts_of(b) for b in bags])
    sizes = np.array([len(b) for b in bags])
    a, b = ngrams.tree_pairs(np.arange(n), sizes, counts, np.zeros(n, int), False)
    found = {(min(x, y), max(x, y)) for x, y in zip(a.tolist(), b.tolist(), strict=True)}
    for x in range(n):
        for y in range(x + 1, n):
            both = len(np.intersect1d(bags[x], bags[y]))
            if 100 * both >= 75 * (len(bags[x]) + len(bags[y]) - both):
                assert (x, y) in found


def test_components_bear_awkward_rows(spark):
    got = ngrams.components(docs(spark, awkward())).collect()
    assert len(got) == len(awkward())
    assert {r.component_id for r in got if r.doc_id in (1, 5)} == {1}
    assert next(r for r in got if r.doc_id is None).component_id is None
    assert ngrams.components(docs(spark)).collect() == []


def test_vectors_are_the_brute_force(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(20, 16))
    x = np.concatenate([centres[rng.integers(0, 20, 300)] + rng.normal(scale=0.12, size=(300, 16)), rng.normal(size=(200, 16))]).astype(np.float32)
    x[400:420] = x[0]
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [None] + [1.0] * 15), (905, [1.0, 2.0]), (906, [1.0, 2.0]), (None, x[0].tolist()), (7, x[7].tolist())]
    df = spark.createDataFrame([(*r, 0, 1, 2) for r in rows + odd], "vec_id long, embedding array<float>, label int, cls long, n_links long")
    got = pivots.near_vectors(df).collect()
    assert len(got) == len(rows) + len(odd)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = ((unit @ unit.T) >= 0.9).sum(axis=1) - 1
    by = {r.vec_id: r for r in got}
    found = sum(min(by[k].n_links, want[k]) for k in range(500))
    assert found >= 0.9 * want.sum() and all(by[k].n_links <= want[k] for k in range(500))
    assert all(by[k].n_links == 0 and by[k].kept for k in (900, 901, 902, 903, 904)) and by[None].component_id is None
    assert by[905].n_links == 1 and by[906].component_id == 905
    assert by[400].n_links >= 20 and by[419].component_id == by[0].component_id
    assert pivots.near_vectors(df.limit(0)).collect() == []


def test_prefix_keeps_recall_at_any_number_of_pivots():
    rng = np.random.default_rng(5)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    assert pivots.prefix_of(16) == pivots.prefix_of(256) == pivots.PREFIX
    for count in (176, 1000, 4096):
        of, p = unit(rng.standard_normal((count, 64))), pivots.prefix_of(count)
        a, b = unit(rng.standard_normal((1000, 64))), rng.standard_normal((1000, 64))
        b = unit(b - (b * a).sum(axis=1, keepdims=True) * a)
        near = [np.argsort(-(x @ of.T), axis=1)[:, :p] for x in (a, 0.9 * a + np.sqrt(1 - 0.81) * b)]
        assert ((near[0][:, :, None] == near[1][:, None, :]).sum(axis=(1, 2)) >= 2).mean() > 0.95


def test_mix_meets_targets(spark):
    rng = random.Random(6)
    rows = [(1000 + i, " ".join(["w"] * rng.randrange(0, 30)), "en", rng.choice(["a", "b", "c", "d", None])) for i in range(900)] + awkward()
    got = mixing.mix(docs(spark, rows), chunk=64, fan_in=4).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs(spark, rows), chunk=64, fan_in=4).collect()))
    sizes = collections.Counter()
    for i, t, _, s in rows:
        sizes[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, open_, total = {}, set(names), sum(sizes.values())
    while True:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 3 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 3.0 * sizes[s]
            open_.discard(s)
        if not open_:
            break
    by_size = {sizes[s]: target[s] for s in names}
    taken = collections.Counter()
    most = collections.Counter()
    for r in got:
        assert r.taken <= 3 * r.size and r.taken % max(r.size, 1) == 0 and abs(r.target - by_size[r.source_size]) < 1e-6
        taken[r.source_size] += r.taken
        most[r.source_size] = max(most[r.source_size], r.size)
    assert all(abs(taken[n] - by_size[n]) <= most[n] for n in by_size)
    assert mixing.mix(docs(spark)).collect() == []


def test_pivot_keeps_words_and_means():
    rng = np.random.default_rng(0)
    sizes, total = [3, 5, 8, 2, 9], np.zeros(5)
    for _ in range(4000):
        taken, held, p = mixing.pivot(sizes, [0.3] * 5, rng.random(5))
        x = np.array(taken, float)
        if held >= 0:
            x[held] = p
        assert abs((x * sizes).sum() - 0.3 * sum(sizes)) < 1e-6
        total += x
    assert np.abs(total / 4000 - 0.3).max() < 0.04


def test_shards_keep_groups_and_balance(spark):
    rng = random.Random(8)
    rows = [(10000 + i, "x" * rng.randrange(400) + str(i % 700), "en", "s") for i in range(1500)] + [(20000 + i, "hot" * 40, "en", "s") for i in range(300)] + awkward()
    got = sharding.assign_shards(docs(spark, rows), shards=8, chunk=64, fan_in=4).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"}
    homes, loads, slots = collections.defaultdict(set), collections.Counter(), collections.defaultdict(list)
    by_id = {i: t for i, t, *_ in rows}
    for r in got:
        text = by_id[r.doc_id]
        assert r.size == 16 + len((text or "").encode()) and r.text_crc32 == zlib.crc32((text or "").encode()) and r.grown_shard is None
        homes[text].add(r.shard)
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(len(x) == 1 for x in homes.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    groups = collections.Counter()
    for r in got:
        groups[by_id[r.doc_id]] += r.size
    fair = sum(loads.values()) / 8
    assert max(loads.values()) <= max(max(groups.values()), fair) * 1.02 + 20
    assert sharding.assign_shards(docs(spark)).collect() == []


def test_differencing_places_every_item():
    rng = random.Random(9)
    items = [([rng.randrange(1000)], [k]) for k in range(200)]
    parts = sharding.difference(items, 7)
    assert sorted(x for _, inside in parts for x in sharding._flat(inside)) == list(range(200))
    assert all(load == sum(items[x][0][0] for x in sharding._flat(inside)) for load, inside in parts)
    assert max(p[0] for p in parts) - min(p[0] for p in parts) <= 20


def test_first_common_hash_stands_at_a_place_that_meets():
    rng = np.random.default_rng(5)
    linked = 0
    for _ in range(3000):
        n = int(rng.integers(1, 120))
        a = set(rng.integers(0, 1 << 30, n).tolist())
        b = {x for x in a if rng.random() > rng.random() * 0.3} | set(rng.integers(0, 1 << 30, int(rng.integers(0, max(2, n // 6)))).tolist())
        both = a & b
        if not both or 100 * len(both) < 75 * len(a | b):
            continue
        linked += 1
        pos_a, pos_b = sorted(a).index(min(both)), sorted(b).index(min(both))
        assert ngrams.meets(len(a), pos_a, len(b), pos_b)
        low, pos = min((len(a), pos_a), (len(b), pos_b))
        assert pos <= ngrams.first_of(low)
    assert linked > 1000


def test_hashes_are_gathered_in_parts_that_are_the_whole(spark, monkeypatch):
    r, parts, materialize = random.Random(21), [], ngrams.materialize

    def spy(table, name, **options):
        out = materialize(table, name, **options)
        if name == "ngram-entries":
            parts.append({tuple(x) for x in out.select("key", "cls", "n", "pos").collect()})
        return out

    monkeypatch.setattr(ngrams, "materialize", spy)
    base = [" ".join(f"w{r.randrange(500)}" for _ in range(60)) for _ in range(30)]
    df = docs(spark, [(k, base[k % 30] + f" end{k}" * (k // 30), "en", "s") for k in range(90)])
    got = {x.doc_id: x.component_id for x in ngrams.components(df).collect()}
    assert got == {k: k % 30 for k in range(90)}
    sets = ngrams.described(df.select("doc_id", "text"), ngrams.hints(df.select("doc_id", "text")))
    whole = {tuple(x) for x in ngrams.shared_entries(sets, 4).select("key", "cls", "n", "pos").collect()}
    keys = [{x[0] for x in part} for part in parts]
    assert len(parts) > 1 and all(keys) and sum(map(len, keys)) == len(set().union(*keys))
    assert set().union(*parts) == whole

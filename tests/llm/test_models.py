"""Operators 3, 4 and 10 and the pipeline: tokens, languages, benchmark, stages."""

import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from strataleaf.llm import decontaminate, language, tokenbin

from .helpers import awkward, docs

SF = "/root/testdata/sf0.001"
FILE = public_tokenizers.path("word_bpe_49k.json")


def test_coder_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 5000, 70000):
        ids = (rng.zipf(1.3, n) % 5000).astype(np.uint32)
        counts = np.bincount(ids, minlength=5000)
        coder = tokenbin.Coder(tokenbin.shares(counts))
        block = coder.encode(ids, [n], lanes=32, step=16)
        assert (coder.decode(block)[0] == ids).all()
        if n == 70000:
            at = 16 * 32
            assert (coder.decode(block, checkpoint=1)[0] == ids[at:]).all()
            spoilt = bytearray(block)
            spoilt[-1] ^= 1
            try:
                coder.decode(bytes(spoilt))
                raise AssertionError("a spoilt block was read")
            except ValueError:
                pass


def test_shares_cover_every_id():
    counts = np.array([0, 1, 10**9, 3, 0, 1])
    f = tokenbin.shares(counts, 8)
    assert f.sum() == 256 and (f[counts > 0] > 0).all() and (f[counts == 0] == 0).all()


def test_file_holds_what_the_tokenizer_says(spark):
    made = ["don't <|endoftext|> stop<|STARTOFTEXT|>", "ÉTÉ e\u0301te\u0301 İ Σς", "a\u00a0b\u2003c\x1cd", "!!,.. x_y 12,5 'Re 're"]
    rows = awkward() + [(30 + k, t, "en", "z") for k, t in enumerate(made)]
    got = tokenbin.encode(docs(spark, rows), FILE).collect()
    tokenizer = Tokenizer.from_file(FILE)
    want, start = [], 0
    for i, t, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert tokenbin.encode(docs(spark), FILE).collect() == []


def test_marks_after_capitals_are_composed_before_lower_case(spark):
    made = ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a", "The J\u030c and THE Plain\nY\u030a End", "PLAIN Words"]
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in tokenbin.encode(docs(spark, [(k, x, "en", "z") for k, x in enumerate(made)]), FILE).collect()}
    for k, x in enumerate(made):
        ids = Tokenizer.from_file(FILE).encode(x, add_special_tokens=False).ids + [2]
        assert got[k] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_latin_words_go_to_the_model_and_outlive_a_full_memory(monkeypatch):
    import random

    class Counted:
        def __init__(self, whole):
            self.whole, self.sent = whole, []

        def encode_batch_fast(self, pieces, **more):
            self.sent += pieces
            return self.whole.encode_batch_fast(pieces, **more)

    r, plain = random.Random(9), Tokenizer.from_file(FILE)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if c not in (0xD7, 0xF7)]
    latin = ["".join(r.choices(letters, k=r.randrange(1, 12))) + r.choice(["", "", ",", "!!.", "<|", "&~"]) for _ in range(3000)]
    others = ["l\u2019été", "don't", "É's", "e\u0301t\u00c9", "İstanbul,", "\u00aa\u00b5\u00ba", "3ème", "a×b", "ÀÉ\u0301.", "привет,", "<|endoftext|>", "Été<|endoftext|>!", ""]
    words = tokenbin.Words(FILE, "<u2")
    words.tokenizer = counted = Counted(plain)
    words.learn([latin, others])
    for piece in latin + others:
        assert np.frombuffer(words[piece], "<u2").tolist() == plain.encode(piece, add_special_tokens=False).ids, piece
    assert not any(c.isalpha() for piece in counted.sent if piece not in others for c in piece)
    monkeypatch.setattr(tokenbin, "REMEMBER", 10)
    counted.sent.clear()
    words.learn([others])
    assert counted.sent == [] and len(words) < 100


def test_pieces_are_sought_on_demand_and_latin_texts_lower_cased_whole(monkeypatch):
    import random

    r, plain, words = random.Random(11), Tokenizer.from_file(FILE), tokenbin.Words(FILE, "<u2")
    every = [chr(c) for c in (*range(9, 14), *range(28, 256))] * 3 + ["\n", " ", " "] * 100
    texts = ["".join(r.choices(every, k=300)) for _ in range(200)]
    texts += [f"{x} \u2019{y}\u0301 \u0130 \u03a3\u03a3 {x.upper()}" for x, y in zip(texts, texts[1:], strict=False)]
    texts += ["É<|endoftext|>É <|x É", "", None, "ÀÉ ÀÉ, àé Àé.", *(x.text for x in pq.read_table(f"{SF}/documents.parquet").to_pandas().itertuples())]
    for most in (tokenbin.REMEMBER, 50):
        monkeypatch.setattr(tokenbin, "REMEMBER", most)
        for x in texts:
            assert np.frombuffer(words.encoded(x), "<u2").tolist() == plain.encode(x or "", add_special_tokens=False).ids, x
    words = tokenbin.Words(FILE, "<u2")
    words.encoded("ÀÉ ÀÉ Àé")
    assert set(words) == {"àé"}


def test_languages_on_held_out_rows(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    known = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    got = language.classify(df, language.fit(df)).collect()
    assert len(got) == len(known)
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.96 * len(held)
    assert sum(r.rejected for r in got) <= 0.03 * len(got)


def test_languages_bear_awkward_rows(spark):
    df = docs(spark, awkward())
    got = language.classify(df, language.fit(df)).collect()
    assert len(got) == len(awkward())
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert {2, 3, 7} <= und and 1 not in und
    assert language.classify(docs(spark), {}).collect() == []
    assert {r.lang_pred for r in language.classify(df, {}).collect()} == {"und"}


def brute_leaks(rows, items, share=0.5):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    grams = {}
    for i, t in items:
        w = words(t)
        if len(w) >= decontaminate.LEAST:
            for k in range(len(w) - 3):
                grams.setdefault(tuple(w[k : k + 4]), set()).add(i)
    sizes = {i: len(words(t)) - 3 for i, t in items}
    out = set()
    for d, t in rows:
        w, hits = words(t), {}
        for k in range(len(w) - 3):
            for i in grams.get(tuple(w[k : k + 4]), ()):
                hits[i] = hits.get(i, 0) + 1
        out |= {(d, i) for i, n in hits.items() if n >= share * sizes[i]}
    return out


def test_leaks_are_found_and_clean_documents_left(spark):
    df, bench = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(df, bench).collect()}
    want = brute_leaks([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert len(got & want) >= 0.97 * len(want) and len(got - want) <= 0.02 * len(got)


def test_paraphrases_and_awkward_rows(spark):
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    item = bench.where("item_id = 2").first().text
    words = item.split()
    changed = " ".join(w if k % 6 else "otherwise" for k, w in enumerate(words))
    filler = " ".join(r.text for r in spark.read.parquet(f"{SF}/documents.parquet").limit(3).collect())
    rows = awkward() + [(40, filler + " " + changed + " " + filler, "en", "z"), (41, filler, "en", "z"), (42, item.upper(), "en", "z")]
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs(spark, rows), bench).collect()}
    assert (40, 2) in got and (42, 2) in got and not any(d == 41 and i == 2 for d, i in got)
    assert decontaminate.find(docs(spark), bench).collect() == []
    assert decontaminate.find(docs(spark, rows), bench.limit(0)).collect() == []
    odd = spark.createDataFrame([(None, item), (5, None), (6, ""), (7, "too short")], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontaminate.find(docs(spark, rows), odd).collect()} == {(40, None), (42, None)}


def test_copies_and_common_words_do_not_hide_an_item(spark):
    df, bench = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text"), spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    before = {(r.doc_id, r.item_id) for r in decontaminate.find(df, bench).collect()}
    held = next(d for d, i in sorted(before) if i == 3)
    copies = df.where(f"doc_id = {held}").crossJoin(spark.range(500)).selectExpr("id + 1000000 AS doc_id", "text")
    text = next(r.text for r in bench.collect() if r.item_id == 11)
    around = " ".join(f"zq{k}" for k in range(10))
    short = spark.range(500).selectExpr("id + 2000000 AS doc_id", f"'{around} {text} {around}' AS text")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(df.unionByName(copies).unionByName(short), bench).collect()}
    assert before <= got
    assert {(1000000 + k, 3) for k in range(500)} <= got and {(2000000 + k, 11) for k in range(500)} <= got


def test_count_of_an_items_words_bounds_the_lcs():
    rng = np.random.default_rng(3)
    items = [rng.integers(0, 23, n).astype(np.int32) for n in (3, 9, 20)]
    ids = rng.integers(-1, 23, 200).astype(np.int32)
    which, first, last = np.array([0, 1, 2, 2]), np.array([0, 50, 120, 190]), np.array([40, 90, 200, 200])
    got = decontaminate.held(decontaminate.holders(items, 23), which, ids, first, last)
    assert got.tolist() == [int(np.isin(ids[a:b], items[k]).sum()) for k, a, b in zip(which, first, last, strict=True)]


def test_fit_sums_over_every_passage():
    rng = np.random.default_rng(5)
    sizes = [0, 1, 16, 17, 700, 0, 0, 16 * 9000 + 3, 2]
    texts = [rng.integers(-30, 30, n).clip(-1).astype(np.int32) for n in sizes]
    texts[4][:] = 5
    idf, q = rng.random(30) + 0.1, rng.standard_normal((30, 5))
    idf[3] = 0
    batch = pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in texts], pa.binary())], names=["ids"])
    passages = [x[k : k + 64] for x in texts for k in range(0, len(x), 16)]
    got = decontaminate.passages_times(*decontaminate.joined(batch, 16), idf, q)
    assert np.allclose(got, decontaminate.gram_times(*decontaminate.sparse(passages, idf), q), atol=1e-2)


def test_fit_follows_passages_beyond_any_sample(spark):
    rng = np.random.default_rng(6)
    texts = [rng.integers(0, 60, 16 * 400).astype(np.int32) for _ in range(100)]  # 40,000 passages
    table = spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(texts)], "doc_id long, ids binary").repartition(4)
    idf, items = rng.random(60) + 0.5, [rng.integers(0, 60, 20).astype(np.int32) for _ in range(3)]
    row, col, value = decontaminate.sparse([x[k : k + 64] for x in texts for k in range(0, len(x), 16)], idf)
    rows = np.zeros((40000, 60))
    rows[row, col] = value
    own = np.zeros((3, 60))
    row, col, value = decontaminate.sparse(items, idf)
    own[row, col] = value
    whole = rows.T @ rows + own.T @ own * (40000 / 3)
    got = decontaminate.latent(table, items, idf, 40000, rank=60, over=0)
    want = np.linalg.eigh(whole)
    assert np.allclose((got * (got * (whole @ got)).sum(axis=0)) @ got.T, want[1] @ np.diag(want[0]) @ want[1].T, atol=0.5)


def test_fit_reads_all_once_a_power_and_keeps_no_less(spark):
    class Counted:
        def __init__(self, table):
            self.table, self.sparkSession, self.reads = table, table.sparkSession, 0

        def mapInArrow(self, *more):
            self.reads += 1
            return self.table.mapInArrow(*more)

    rng = np.random.default_rng(12)
    chance = 1 / np.arange(3, 303)
    texts = [rng.choice(300, 640, p=chance / chance.sum()).astype(np.int32) for _ in range(60)]
    table = Counted(spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in enumerate(texts)], "doc_id long, ids binary").repartition(4))
    idf, items = rng.random(300) + 0.5, [rng.integers(0, 300, 20).astype(np.int32) for _ in range(9)]
    got = decontaminate.latent(table, items, idf, 2400, rank=10, over=6)
    assert table.reads == decontaminate.POWER and got.shape == (300, 10) and np.allclose(got.T @ got, np.eye(10))
    whole = np.zeros((300, 300))
    for lists, weight in (([x[k : k + 64] for x in texts for k in range(0, len(x), 16)], 1), (items, 2400 / 9)):
        rows = np.zeros((len(lists), 300))
        row, col, value = decontaminate.sparse(lists, idf)
        rows[row, col] = value
        whole += rows.T @ rows * weight
    q = np.linalg.qr(np.random.default_rng(7).standard_normal((300, 16)))[0]
    for _ in range(decontaminate.POWER):
        q = np.linalg.qr(whole @ q)[0]
    assert np.trace(got.T @ whole @ got) >= np.linalg.eigvalsh(q.T @ whole @ q)[-10:].sum()  # what one more read gave


def test_lcs_of_many_is_the_lcs_of_each():
    rng = np.random.default_rng(13)
    items = [rng.integers(0, 40, n).astype(np.int32) for n in (8, 20, 63, 64, 65, 200)]
    ids = rng.integers(-1, 40, 6000).astype(np.int32)
    which = rng.integers(0, 4, 5000)
    first = rng.integers(0, 5900, 5000)
    last = first + rng.integers(0, 100, 5000)
    got = decontaminate.lcs_lengths(decontaminate.table_of(items, 40), decontaminate.holders(items, 40), which, ids, first, last)
    assert got.tolist() == [decontaminate.lcs_length(decontaminate.masks_of(items[k]), ids[a:b].tolist()) for k, a, b in zip(which, first, last, strict=True)]
    assert got.max() > 20


def test_items_of_more_words_than_a_machine_word_are_found(spark):
    rng = np.random.default_rng(14)
    some = lambda n: " ".join(f"w{k}" for k in rng.integers(0, 3000, n))
    items = {1: some(64), 2: some(65), 3: some(150), 4: some(30)}
    rows = [(10 * k, f"{some(200)} {text} {some(90)}", "en", "s") for k, text in items.items()] + [(k, some(300), "en", "s") for k in range(100, 130)]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.lcs) for r in decontaminate.find(docs(spark, rows), bench).collect()}
    assert got == {(10 * k, k, 1.0) for k in items}


def test_lcs_is_the_table():
    rng = np.random.default_rng(2)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 20)).tolist(), rng.integers(0, 6, rng.integers(0, 30)).tolist()
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for k, y in enumerate(b):
                new.append(row[k] + 1 if x == y else max(row[k + 1], new[k]))
            row = new
        assert decontaminate.lcs_length(decontaminate.masks_of(a), b) == row[-1]


def test_pipeline_stages(spark):
    import corpus_pipeline as P

    docs_, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    columns = docs_.columns
    before = {r.doc_id for r in docs_.collect()}
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs_, SF)
        assert out.columns == columns
        docs_ = P.materialize(out, "test")
        now = {r.doc_id for r in docs_.select("doc_id").collect()}
        assert now <= before
        kept.append((name, len(before) - len(now)))
        before = now
    assert kept[0][1] <= 10 and kept[1][1] > 0
    final = P.STAGES[-1][1](spark, docs_, SF)
    assert final.count() == docs_.count()
    assert P.run(spark, SF).count() == docs_.count()


def test_common_and_short_items(spark):
    import random

    r = random.Random(4)
    some = lambda n: " ".join(f"w{r.randrange(3000)}" for _ in range(n))
    item = "the quick river crosses nineteen old stones before it turns south and meets the grey sea near port"
    short, tiny = "Who painted the blue harbour door?", "blue door"
    rows = [(k, f"{some(60)} {item} {some(40)}", "en", "s") for k in range(100)]
    rows += [(200, f"{some(9)} who painted THE blue harbour door {some(9)}", "en", "s"), (201, "who painted a blue harbour door", "en", "s"), (202, "Blue door.", "en", "s"), (203, "a blue door", "en", "s")]
    bench = spark.createDataFrame([(1, item), (2, some(25)), (3, short), (4, tiny)], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.find(docs(spark, rows), bench).collect()}
    assert got == {(k, 1) for k in range(100)} | {(200, 3), (202, 4)}

"""Operators on small cases whose results are known."""

import gzip
import hashlib
import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from strataleaf.functions import html, text, urls
from strataleaf.operators import chunking, graph, versions


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(column(F.col("x"))).first()[0]


def test_keys(spark):
    for x in ("o'zbek", "oʻzbek", "o’zbek"):
        assert one(spark, text.search_key, x) == "ozbek"
    assert one(spark, text.number_key, "ПҚ-330") == one(spark, text.number_key, "PQ-330") == "pq-330"
    assert one(spark, text.number_key, "КСҚ-8") == "ksq-8"
    assert one(spark, text.search_key, "a-b-c-d  x") == "a b c d x"


def test_dates_and_titles(spark):
    assert one(spark, text.to_date, "31.02.2026") is None
    assert one(spark, text.to_date, "01.07.1997 00") == date(1997, 7, 1)


def test_marks_fold(spark):
    assert one(spark, text.fold_mixed_scripts, "Нigher") == "Higher"
    assert one(spark, text.clean, "a\x00b​ c") == "ab c"


def test_html():
    assert html.render("<p>a<b>b</b></p><script>x</script><br>c")[0] == "ab\nc"
    assert html.render("<table><tr><td>1</td><td>2</td></tr><tr><td colspan=2>3</td></tr></table>")[0] == "1 | 2\n3"
    assert html.render("<table><tr><th rowspan=2>h</th></tr></table>")[1] == [[[("h", 2, 1, True)]]]
    assert html.render(None) == ("", [])


def test_urls(spark):
    assert one(spark, urls.normalized, "http://A.example.org/en/docs/-5?b=2&a=1#x") == "https://a.example.org/docs/-5?a=1&b=2"
    assert one(spark, urls.normalized, "ftp://a.example.org/") is None
    assert one(spark, urls.normalized, "http://u@a.example.org/") is None
    assert one(spark, urls.identity, "https://a.example.org/en/-5") == "-5"


def fold(rows):
    """Windows one after the other, as a plain loop."""
    out, last, adjusted = {}, None, False
    for group, start, number, source in sorted(rows):
        moved = start if last is None else max(start, last + timedelta(1))
        out[number] = [moved, None, "observed_adjusted" if moved != start else source, last is not None and start <= last and source == "edition" == before and not adjusted]
        if last is not None:
            out[previous][1] = moved - timedelta(1)
        last, adjusted, before, previous = moved, moved != start, source, number
    return out


def test_validity_is_the_fold(spark):
    rng = random.Random(5)
    rows = [(doc, number, date(2020, 1, 1) + timedelta(rng.randrange(6)), rng.choice(["edition", "observed"]), rng.randrange(3)) for doc in range(60) for number in range(rng.randrange(1, 8))]
    df = spark.createDataFrame(rows, "doc int, number int, day date, source string, grp int")
    got = versions.validity(df, "doc", "day", "source", F.col("grp"), "number", F.lit(None).cast("date")).collect()
    want = {doc: fold([(g, d, n, s) for x, n, d, s, g in rows if x == doc]) for doc in {r[0] for r in rows}}
    for r in got:
        assert [r.valid_from, r.valid_to, r.valid_from_source] == want[r.doc][r.number][:3]
        assert r.conflict == any(x[3] for x in want[r.doc].values())


def test_split_keeps_all_words():
    body = " ".join(f"Sentence number {k} has several words in it." for k in range(59))
    parts, forced = chunking.split(body, 40)
    assert " ".join(parts) == body and not forced and all(chunking.count(p) <= 40 for p in parts)
    rows = [f"{k} | value {k}" for k in range(80)]
    parts, _ = chunking.split("\n".join(["no | what", *rows]), 60)
    assert all(p.startswith("no | what\n") for p in parts) and [x for p in parts for x in p.split("\n")[1:]] == rows


def test_chunks_join_labels_to_their_body():
    sections = [
        {"order": 0, "parent": None, "type": "title", "number": "", "text": "An act"},
        {"order": 1, "parent": None, "type": "chapter", "number": "I", "text": "Chapter"},
        {"order": 2, "parent": 1, "type": "clause", "number": "1", "text": "word " * 400},
        {"order": 3, "parent": 1, "type": "clause", "number": "40", "text": "40."},
        {"order": 4, "parent": 1, "type": "clause", "number": "41", "text": "word " * 280},
        {"order": 5, "parent": None, "type": "signature", "number": "", "text": "signed"},
    ]
    chunks = chunking.chunk(sections)
    assert chunks[0]["kind"] == "header" and "signed" not in "".join(c["text"] for c in chunks)
    assert any(c["text"].startswith("40.\n") for c in chunks)
    assert {s["order"] for c in chunks for s in c["of"]} == {0, 1, 2, 3, 4}


def test_graph_is_cycle_safe(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6)], "a long, b long")
    assert {tuple(r) for r in graph.components(edges, "a", "b").collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
    roots = spark.createDataFrame([(1,)], "root long")
    assert {r.node for r in graph.reachable(edges, "a", "b", roots).collect()} == {1, 2, 3}


def test_blobs_and_content_store(spark, tmp_path):
    from strataleaf.sources import archive

    data = b"hello"
    name = hashlib.sha256(data).hexdigest()
    (tmp_path / "blobs").mkdir()
    (tmp_path / "blobs" / f"{name}.gz").write_bytes(gzip.compress(data))
    (tmp_path / "blobs" / "other").write_bytes(b"x")
    assert sorted(r.verified for r in archive.blobs(spark, str(tmp_path / "blobs")).collect()) == [False, True]
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "content string")
    archive.put_new(rows, str(tmp_path / "store"))
    archive.put_new(rows, str(tmp_path / "store"))
    assert spark.read.parquet(str(tmp_path / "store")).count() == 2


def test_archive_records(spark, tmp_path):
    from strataleaf.sources import archive

    (tmp_path / "-5_1").mkdir()
    (tmp_path / "-5_1" / "document.json").write_text('{"url": "u", "document_id": "-5", "blocks": [{"order": 0, "text": "t"}]}')
    (tmp_path / "6_2").mkdir()
    (tmp_path / "6_2" / "document.json").write_text("{broken")
    found = archive.records(spark, str(tmp_path))
    assert {r.document_id for r in found.collect()} == {"-5", None}
    assert [r.text for r in archive.blocks(found).collect()] == ["t"]


def test_stream_skips_late_observations(spark, tmp_path):
    from strataleaf.streaming import observations

    path = str(tmp_path / "in")
    spark.createDataFrame([("d", "2026-03-01", "A"), ("d", "2026-09-01", "B"), ("d", "2026-09-02", "B"), ("e", "2026-01-01", "X")], "document string, seen string, content string").withColumn("seen", F.to_timestamp("seen")).coalesce(1).write.parquet(path)
    schema = "document string, seen timestamp, content string"
    query = observations.ingest(spark.readStream.schema(schema).parquet(path)).writeStream.format("memory").queryName("outcomes").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").start()
    query.processAllAvailable()
    spark.createDataFrame([("d", "2026-03-01", "A")], "document string, seen string, content string").withColumn("seen", F.to_timestamp("seen")).coalesce(1).write.mode("append").parquet(path)
    query.processAllAvailable()
    query.stop()
    got = sorted((r.document, r.outcome, r.version) for r in spark.sql("SELECT * FROM outcomes").collect())
    assert got == [("d", "amended", 2), ("d", "new", 1), ("d", "skipped", 2), ("d", "unchanged", 2), ("e", "new", 1)]


def test_covers_are_the_shortest_stretches():
    from itertools import combinations

    from strataleaf.operators import retrieval

    def brute(row, words):
        found = {(i, j) for i, j in combinations(range(len(row) + 1), 2) if words <= set(row[i:j])}
        least = [(i, j) for i, j in found if (i + 1, j) not in found and (i, j - 1) not in found]
        return round(sum(0.1 / (1 + sum(w not in words for w in row[i:j])) for i, j in least), 6)

    assert retrieval.covers("a x b".split(), [{"a", "b"}]) == 0.05
    assert retrieval.covers("a x y b".split(), [{"a", "b"}]) == round(0.1 / 3, 6)
    assert retrieval.covers("a x a".split(), [{"a"}]) == 0.2
    rng = random.Random(5)
    for _ in range(300):
        row = [rng.choice("abcdx") for _ in range(rng.randrange(12))]
        words = set(rng.sample("abc", rng.randrange(1, 4)))
        assert abs(retrieval.covers(row, [words]) - brute(row, words)) < 2e-6


def test_twins_pass_the_labels_that_others_have(spark):
    from strataleaf.operators import structure

    rows = spark.createDataFrame([(1, 0, 0, "clause", "1"), (1, 0, 1, "clause", "1.2"), (1, 0, 2, "clause", "1"), (1, 0, 3, "item", "а"), (1, 0, 4, "paragraph", "")], "k long, up long, o long, t string, n string")
    got = {r.o: r.label for r in structure.labels(rows, "k", "up", "o", "t", "n").collect()}
    assert got == {0: "cl_1", 1: "cl_1_2", 2: "cl_1_3", 3: "it_a", 4: "p5"}


def test_paths_of_any_depth(spark):
    from strataleaf.operators import structure

    rows = spark.createDataFrame([(1, k, k - 1 if k else None, f"l{k}") for k in range(40)], "k long, o long, up long, label string")
    got = {r.o: (r.path, r.depth) for r in structure.paths(rows, "k", "o", "up", "label").collect()}
    assert got[39] == (".".join(f"l{k}" for k in range(40)), 40)


def test_zip_members_keep_to_their_bounds(spark, tmp_path):
    import zipfile

    from strataleaf.sources import archive

    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("x\\y/ok.pdf", b"%PDF-1" + b"a" * 20)
        z.writestr("long.pdf", b"%PDF-1" + b"a" * 500)
        z.writestr("other.txt", b"%PDF-1")
        z.writestr("last.PDF", b"%PDF-2")
    (tmp_path / "b.zip").write_bytes(b"no zip")
    got = archive.zip_members(spark, str(tmp_path), one=100).collect()
    assert sorted(r.name for r in got if r.name) == ["last.PDF", "ok.pdf"] and sum(r.error is not None for r in got) == 1


def test_nearest_bears_zero_vectors(spark):
    from strataleaf.operators import retrieval

    rows = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, None)], "vec_id long, embedding array<double>")
    got = retrieval.nearest(rows, "vec_id", "embedding", [1.0, 0.0]).collect()
    assert [(r.vec_id, r.distance) for r in got] == [(2, 0.0), (1, None)]


def test_versions_share_batches(spark):
    """Sections in any order, a version without text, more versions than are held at once; no group of its own for each."""
    rows = [(k, o, None if o == 0 else 0, t, n, x) for k in range(150) for o, t, n, x in [(1, "clause", "1", f"1. word {k} " * (k % 3 * 200)), (0, "article", "5", f"5-modda {k}"), (2, "paragraph", "", None)]]
    rows.append((900, 0, None, "paragraph", "", ""))
    got = chunking.chunk_versions(spark.createDataFrame(rows, "doc long, ord long, parent long, section_type string, number string, text string"), "doc")
    assert "FlatMapGroups" not in got._jdf.queryExecution().toString()
    want = []
    for k in range(150):
        mine = sorted(r[1:] for r in rows if r[0] == k)
        made = chunking.chunk([{"order": o, "parent": up, "type": t, "number": n, "text": x or ""} for o, up, t, n, x in mine])
        want += [(k, at, c["text"], c["tokens"], c["of"][0]["order"], c["of"][-1]["order"]) for at, c in enumerate(made)]
    assert sorted((r.doc, r.chunk_index, r.text, r.token_count, r.first_section, r.last_section) for r in got.collect()) == want


def test_no_level_is_deeper_than_told(spark):
    from strataleaf.operators import structure

    blocks = ["1.2.3.4. a", "1. a", "5-modda", "text", "", "1.2.3.4.5.6) b", "9.9"]
    rows = spark.createDataFrame([(b,) for b in blocks], "x string")
    found = rows.select(structure.classify(F.col("x"))["level"].alias("level"), structure.deepest(F.col("x")).alias("most")).collect()
    assert all(r.level in (structure.LEAF,) or r.level <= r.most for r in found) and max(r.most for r in found) == 11


def test_words_are_found_as_in_the_search_key(spark):
    """On odd texts as by token arrays, which are no longer made."""
    from strataleaf.operators import retrieval

    rng = random.Random(7)
    bits = ["the", "The", "with", "WITH", " ", "-", "'", "’", "ʻ", "​", "\xa0", "\x01", "_", "1", "х", "thе", "\U0001d400", "\U0001f600", "́", "é", "Σ", "x", "."]
    texts = ["", None, "\U0001d400the", "\U0001f600the with", "with \U0001d400 the", *("".join(rng.choices(bits, k=rng.randrange(12))) for _ in range(600))]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    tokens = {r.i: r.w or [] for r in df.select("i", text.tokens(text.search_key(F.col("t"))).alias("w")).collect()}
    for variants in ([["the"]], [["the", "with"], ["x"], []], [["the", ""]], [["a b"]], [["é"], ["1"]]):
        found = retrieval.with_key(df, "t").where(retrieval.matches(F.col("__key"), variants))
        assert "split(" not in found._jdf.queryExecution().toString()
        sets = [set(v) for v in variants if v]
        want = {i: retrieval.covers(w, sets) for i, w in tokens.items() if any(s <= set(w) for s in sets)}
        assert {r.i: r.rank for r in found.select("i", retrieval.cover_density(variants)(F.col("__key")).alias("rank")).collect()} == want
        counts = {r.i: r.n for r in found.select("i", retrieval.frequency(F.col("__key"), variants[0][0]).alias("n")).collect()}
        assert counts == {i: tokens[i].count(variants[0][0]) for i in want}


def test_only_texts_that_compose_go_to_python(spark):
    import re
    import unicodedata

    seen = re.compile(re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: rf"\U{int(m[1], 16):08x}", text.composing()))
    rng = random.Random(3)
    bits = [*"aeoué ’—хй", "́", "̣", "\u0308", "\u1100", "\u1161", "\u11a8", "\u212b", "\u0958", "\u09be", "\u09c7", "\U000110a5", "\U000110ba", "\U0001d15e", "\u2126", "\U0002f800"]
    texts = ["", None, "été — ’й", *("".join(rng.choices(bits, k=rng.randrange(6))) for _ in range(1500))]
    assert not seen.search("été — ’й") and all(seen.search(t) for t in texts if t and unicodedata.normalize("NFC", t) != t)
    assert all(seen.search(c) for c in map(chr, (*range(0xD800), *range(0xE000, 0x110000))) if unicodedata.normalize("NFC", c) != c or unicodedata.combining(c))
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = df.select("i", text.composed(F.col("t")).alias("t"))
    assert {r.i: r.t for r in got.collect()} == {i: t if t is None else unicodedata.normalize("NFC", t) for i, t in enumerate(texts)}
    assert "CASE WHEN RLIKE(" in got._jdf.queryExecution().optimizedPlan().toString()


def test_reached_counts_are_those_of_the_pairs(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (5, 6), (8, 8), (9, None), (None, 1)], "a long, b long")
    roots = spark.createDataFrame([(1,), (2,), (6,), (7,), (8,), (9,), (None,), (1,)], "root long")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    want = graph.reachable(both, "a", "b", roots).groupBy("root").agg(F.count_distinct("node").alias("reached"))
    got = graph.reached_counts(edges, "a", "b", roots)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()} == {(1, 3), (2, 3), (6, 2), (7, 1), (8, 1), (9, 1), (None, 0)}
    assert got.count() == 7 and dict(got.dtypes)["reached"] == "bigint"

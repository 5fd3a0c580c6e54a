"""Stages of the pipeline on awkward tables, against plain Python."""

import collections

import corpus_pipeline
from strataleaf.llm import common, tokenbin

from .helpers import docs

LONG = " ".join(f"word{k}" for k in range(60))


def rows():
    text = {"a": LONG, "b": LONG + " more", "c": " ".join(f"other{k}" for k in range(50)), "e": ""}
    return [(1, text["a"], "en", "s0"), (1, text["a"], "en", "s0"), (2, text["b"], "en", "s1"), (None, text["a"], "en", "s0"), (None, text["c"], "en", "s1"), (3, text["e"], "en", "s0"), (3, text["e"], "en", "s0"), (4, None, None, None), (1, text["c"] + " end", "de", "s2")]


def shown(df):
    return collections.Counter(tuple(r) for r in df.collect())


def test_one_row_of_each_group_stays(spark):
    df = docs(spark, rows())
    got = corpus_pipeline.keep_one_of_copies(spark, df, "")
    assert got.columns == df.columns
    kept = collections.Counter((r.doc_id, r.text) for r in got.collect())
    c = rows()[4][1]
    # The smallest doc_id of each group, once; rows without words are no copies, but equal rows are one.
    assert kept == {(1, LONG): 1, (1, c + " end"): 1, (3, ""): 1, (4, None): 1}
    assert corpus_pipeline.keep_one_of_copies(spark, docs(spark), "").collect() == []


def test_mix_counts_rows_without_and_with_repeated_ids(spark):
    df = docs(spark, rows())
    got = corpus_pipeline.mix_sources(spark, df, "")
    assert got.columns == df.columns
    whole, mixed = shown(df), shown(got)
    assert set(mixed) <= set(whole) and all(n <= 3 * whole[r] for r, n in mixed.items()) and any(r[0] is None for r in mixed)
    assert corpus_pipeline.mix_sources(spark, docs(spark), "").collect() == []


def test_benchmark_and_language_stages_decide_by_row(spark, tmp_path):
    bench = str(tmp_path)
    spark.createDataFrame([(1, rows()[4][1])], "item_id long, text string").write.parquet(f"{bench}/benchmark.parquet")
    df = docs(spark, rows())
    kept = shown(corpus_pipeline.keep_clear_of_benchmark(spark, df, bench))
    c = rows()[4][1]
    assert kept == collections.Counter({r: n for r, n in shown(df).items() if c not in (r[df.columns.index("text")] or "")})
    told = corpus_pipeline.keep_known_language(spark, df, bench)
    assert told.columns == df.columns and all(r.text for r in told.collect())


def test_benchmark_stage_fits_on_all_words(spark, tmp_path, monkeypatch):
    import random

    r, fitted, latent = random.Random(8), [], corpus_pipeline.decontaminate.latent

    def spy(table, *rest, **more):
        fitted.append(table.selectExpr("sum(octet_length(ids)) DIV 4 AS n").first().n)
        return latent(table, *rest, **more)

    monkeypatch.setattr(corpus_pipeline.decontaminate, "latent", spy)
    some = lambda n: " ".join(f"v{r.randrange(400)}" for _ in range(n))
    bench = str(tmp_path)
    spark.createDataFrame([(k, some(20)) for k in range(3)], "item_id long, text string").write.parquet(f"{bench}/benchmark.parquet")
    df = docs(spark, [(k, some(12000), "en", "s") for k in range(50)])  # 37,500 passages
    assert corpus_pipeline.keep_clear_of_benchmark(spark, df, bench).count() == 50
    assert set(fitted) == {50 * 12000}


def test_other_operators_drop_the_pieces_that_a_worker_keeps():
    import public_tokenizers

    file = public_tokenizers.path(corpus_pipeline.TOKENIZER)
    words = tokenbin.words_of(file)
    assert list(common.lean(iter, keeps=True)([1])) == [1] and tokenbin.words_of(file) is words
    assert list(common.lean(iter)([1])) == [1] and tokenbin.words_of(file) is not words


def test_stages_begin_with_memory_given_back(spark, tmp_path, monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "settle", calls.append)
    spark.createDataFrame([(1, LONG)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        stage(spark, docs(spark), str(tmp_path))
        assert calls == [spark] * k


def test_executors_collect_their_garbage(spark):
    def whole():
        beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
        return sum(x.getCollectionCount() for x in beans if "Old" in x.getName() or "MarkSweep" in x.getName())

    before = whole()
    common.collect_on_executors(spark)  # the session's executor is the driver
    assert whole() > before

"""Cases where an operator once did less than its whole job."""

from collections import defaultdict

import corpus_pipeline
import numpy as np

from tests.llm.test_text_operators import true_factors
from tierkit.llm import near_dedup


def test_large_buckets_lose_no_link(spark):
    """Texts that share most of their words, but for planted pairs too little to be near copies."""
    common = [f"c{i}" for i in range(130)]
    texts, want = [], set()
    for g in range(700):
        own = [f"g{g}x{i}" for i in range(20)]
        texts.append(" ".join(common + own))
        if g < 300:
            texts.append(" ".join(common + own[:6] + [f"h{g}x{i}" for i in range(14)]))
            want.add((len(texts) - 2, len(texts) - 1))
    idf = true_factors(texts)
    of = [near_dedup.weighted(near_dedup.Shingles(), idf, t) for t in texts[:4]]
    assert near_dedup.similarity(of[0], of[1]) > 0.82 and near_dedup.similarity(of[0], of[2]) < 0.77
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = defaultdict(list)
    for r in near_dedup.classes(df).collect():
        got[r.class_id].append(r.doc_id)
    assert {tuple(sorted(g)) for g in got.values() if len(g) > 1} == want


def test_samples_of_very_long_texts_agree_as_often_as_similarity():
    """Texts with several times as many shingles as the table of random numbers has places."""
    sampler, rng = near_dedup.Sampler(bands=100, rows=1), np.random.default_rng(4)
    u = np.unique(rng.integers(0, 1 << 64, 400_000, dtype=np.uint64))
    w = np.ones(len(u), np.float32)
    mine = rng.random(len(u))
    keys = lambda keep: sampler.band_keys(u[keep], w[keep])
    assert (keys(mine < 0.5) == keys(mine >= 0.5)).mean() < 0.05  # nothing in common
    assert abs((keys(mine < 0.9) == keys(mine >= 0.1)).mean() - 0.8) < 0.12


def test_no_part_of_a_key_stays_beside_an_earlier_span(spark):
    keys = ["q7Zp+f/xK2mVd9RtLs3wA7K2M9QX4T1W8ZB5j3Hn/8yGc+e6UvPa0bRk", "Zq+7Wm/xK2TvR9pLs3wYd8f3a1c5e7b9024d6Hn/8yGcQe6UvPa0RkJt"]
    df = spark.createDataFrame([(i, f"key {k} end") for i, k in enumerate(keys)], "doc_id long, text string")
    for r in corpus_pipeline.secrets_blanked(spark, df, "").collect():
        assert r.text == "key [SECRET] end"


def test_one_of_repeated_rows_stays(spark):
    text = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, text), (1, text), (2, text), (None, text), (3, text + " thirteen"), (5, "alone here"), (5, "alone here"), (6, None), (6, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.class_id, r.stays) for r in near_dedup.classes(df).collect()]
    assert [g for g in got if g[1] == 1 and g[2]] == [(1, 1, True)] and len(got) == len(rows)
    assert [g[2] for g in got if g[0] == 5].count(True) == 1
    assert sorted((r.doc_id or 0) for r in near_dedup.keep_one(df).collect()) == [1, 5, 6, 6]


def test_statistics_look_at_whole_words():
    from tierkit.llm import text_stats

    at = text_stats.STATS.index("n_bare")
    assert text_stats.stats_of("#" * 64 + "abc ## é " + "-" * 500)[at] == 2


def test_rules_compare_values_that_are_computed_once(spark):
    """The plan of a score names each statistic's ratio once, however many rules use it."""
    from tierkit.llm import rule_ensemble, text_stats

    rules = [((("symbols", "<=", i / 500), ("words", ">", float(i % 7))), 0.01 * (i % 5 - 2)) for i in range(300)]
    docs, stats = text_stats.with_stats(spark.createDataFrame([(1, "a # b"), (2, "some words here # #")], "doc_id long, text string"))
    out, score = rule_ensemble.scored(docs, stats, rule_ensemble.RuleModel(0.1, rules))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("n_symbols") <= 12
    for r in out.collect():
        s = r[stats]
        have = {"symbols": s.n_symbols / s.n_words, "words": np.log1p(s.n_words)}
        total = 0.1 + sum(w for rule, w in rules if all(have[n] <= at if op == "<=" else have[n] > at for n, op, at in rule))
        assert abs(r[score] - 1 / (1 + np.exp(-total))) < 1e-9


def test_very_long_texts_and_conversations_take_linear_time(spark):
    """100,000 characters of one run, 8,000 keys and 40,000 turns: by the square of the length each took over a minute."""
    import time

    from pyspark.sql import functions as F

    from tierkit.llm import chat_format, secret_scan

    rng = np.random.default_rng(3)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    run = "".join(letters[i] for i in rng.integers(0, 64, 100_000))
    keys = " ".join(f"{k:016x}" for k in rng.integers(1 << 60, 1 << 62, 8000).tolist())
    began = time.time()
    df = spark.createDataFrame([(1, f"data {run} end"), (2, keys)], "doc_id long, text string")
    for r in corpus_pipeline.secrets_blanked(spark, df, "").collect():
        # a few windows of random characters look regular: their middle may stay
        assert r.text == " ".join(["[SECRET]"] * 8000) if r.doc_id == 2 else len(r.text) < 200
    found = {r.doc_id: r.secret_spans for r in secret_scan.scan(df).collect()}
    assert sum(s.k == 2 for s in found[2]) == 8000 and any(s.end - s.start > 50_000 for s in found[1])
    chat = spark.range(40_000).select(F.lit(1).alias("conv_id"), F.col("id").alias("turn"), F.lit("assistant").alias("role"), F.lit("hi é").alias("text"))
    out = chat_format.format_chats(chat)
    got = out.select(F.size(chat_format.read_turns(F.col("formatted"))).alias("n"), F.array_join(
        chat_format.masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("t")).first()
    assert got.n == 40_000 and got.t == "hi é" * 40_000
    assert time.time() - began < 100

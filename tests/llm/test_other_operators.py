"""URL rules, vector search, chats, tokens, packing, the token index and the pipeline."""

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tierkit.llm import chat_format, chunk_bpe, packing, token_index, url_rules, vp_tree
from tierkit.llm.common import scratch_path
from tierkit.llm.tokens import WordEncoder, load_tokenizer, vocabulary_path

from .conftest import LONG

ODD = ["", "plain words here", "Ünïcödé ŒUVRE İstanbul ΟΔΟΣ ßtraße", "don't we'll I'm 12 3a4b ... !? .,", "x\x1cy \x1d z", "a\u00a0b\u2003c\u3000d",
       "<|startoftext|>Hi<|endoftext|> <|ENDOFTEXT|>", "e\u0301 a\u030a \u1100\u1161", "word., word,, (word). 'word'", "\U0001f600\U0001f600 日本語 テスト",
       "tab\tnew\nline\r\nend ", LONG[:3000], "ＦＵＬＬ wIdTh ǅ ŉ ﬁ"]


def test_word_cache_equals_the_tokenizer():
    path = vocabulary_path()
    enc, plain = WordEncoder(path), load_tokenizer(path)
    for _ in range(2):
        for t, raw in zip(ODD, enc.encode(ODD), strict=True):
            assert np.frombuffer(raw, enc.dtype).tolist() == plain.encode(t, add_special_tokens=False).ids, t


def test_word_cache_starts_anew(monkeypatch):
    monkeypatch.setattr("tierkit.llm.tokens.CACHE_WORDS", 40)
    path = vocabulary_path()
    enc, plain = WordEncoder(path), load_tokenizer(path)
    texts = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)} Common, text." for i in range(200)]
    got = enc.encode(texts, at_once=7)
    assert [np.frombuffer(r, enc.dtype).tolist() for r in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("mean", [16, 64, 1024])
def test_chunked_encoding_and_decoding_equal_the_tokenizer(mean):
    path = vocabulary_path()
    enc, plain = chunk_bpe.ChunkEncoder(path, mean), load_tokenizer(path)
    texts = [*ODD, *[t + " " + LONG[i : i + 900] for i, t in enumerate(ODD)], "w" * 5000]
    for t, raw in zip(texts, enc.encode(texts), strict=True):
        ids = plain.encode(t, add_special_tokens=False).ids
        a = np.frombuffer(raw, enc.words.dtype)
        assert a.tolist() == ids, t[:50]
        assert enc.decode(a).decode() == plain.decode(ids, skip_special_tokens=False)


def test_cuts_depend_on_nearby_bytes_alone():
    tail = np.random.default_rng(1).integers(97, 123, 5000, dtype=np.uint8).tobytes()
    a, b = chunk_bpe.cut_places(b"x" * 100 + tail, 64), chunk_bpe.cut_places(b"yy" * 77 + tail, 64)
    assert set(a[a > 130] - 100) == set(b[b > 184] - 154) and len(a) > 40


def test_encode_edge_rows(docs, nothing):
    plain = load_tokenizer(vocabulary_path())
    for r in chunk_bpe.encode(docs).collect():
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.n_tokens and r.decoded == plain.decode(ids, skip_special_tokens=False)
    got = chunk_bpe.encode(docs, digests=True).where("doc_id = 2").first()
    assert got.ids == hashlib.sha256(b"").hexdigest() and got.n_tokens == 0
    assert chunk_bpe.encode(nothing).count() == 0


def check_packing(rows, size):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= size
    return len(bins)


def test_packing_edge_rows(spark, docs, nothing):
    plain = load_tokenizer(vocabulary_path())
    rows = packing.pack(docs, size=64).collect()
    check_packing(rows, 64)
    texts = [(r.doc_id, r.text or "") for r in docs.collect()]
    want = []
    for d, t in texts:
        ids = np.array(plain.encode(t, add_special_tokens=False).ids + [0], "<u4")
        want += [(d, k, s, len(ids[s : s + 64]), zlib.crc32(ids[s : s + 64].tobytes())) for k, s in enumerate(range(0, len(ids), 64))]
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.piece, r.start, r.length, r.ids_crc32)) for r in rows)
    assert packing.pack(nothing).count() == 0


def test_packing_over_shards(spark, docs):
    rows = packing.pack(docs, size=64, shard_pieces=50).collect()
    check_packing(rows, 64)
    assert len({r.sequence_id >> 32 for r in rows}) > 1


def test_local_search_empties_bins():
    rng = np.random.default_rng(4)
    for lengths in (rng.integers(300, 1100, 600), rng.integers(1, 2048, 500), np.full(30, 700), np.array([1024] * 8 + [683] * 9 + [341] * 9)):
        bins = packing.Bins(2048)
        bins.best_fit(lengths)
        before = [f for f in bins.fill if f]
        bins.improve()
        after = [f for f in bins.fill if f]
        assert sum(f * f for f in after) >= sum(f * f for f in before) and len(after) <= len(before)
        assert sorted(p for h in bins.held for _, p in h) == list(range(len(lengths)))
        assert all(sum(n for n, _ in h) == f <= 2048 for h, f in zip(bins.held, bins.fill))


def test_local_search_beats_best_fit():
    # best fit leaves 6 + 4 and 5 + 3, 3 + 2: exchanging makes two full bins of three
    bins = packing.Bins(10)
    bins.fill, bins.held = [9, 8, 3], [[(5, 0), (4, 1)], [(6, 2), (2, 3)], [(3, 4)]]
    bins.improve()
    assert sorted(f for f in bins.fill if f) == [10, 10]


def test_perfect_hash_is_minimal():
    for n in (1, 2, 7, 1000):
        keys = np.random.default_rng(n).integers(-(1 << 62), 1 << 62, n)
        assert sorted(token_index.PerfectHash.build(keys).slots(keys).tolist()) == list(range(n))


def test_token_index_reads_back(spark, docs, nothing, monkeypatch):
    monkeypatch.setattr(token_index, "RANGE_DOCS", 3)
    plain = load_tokenizer(vocabulary_path())
    hot = docs.unionByName(docs.where("doc_id = 5").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(20)))).drop("n"))
    folder = scratch_path(spark, "index-test")
    token_index.write_ids(hot, folder)
    rows = sorted(token_index.read_ids(spark, folder).collect(), key=lambda r: r.start)
    keys = [r.key for r in rows]
    assert keys == [None] + sorted(r.doc_id for r in hot.collect() if r.doc_id is not None)
    at = 0
    texts = {(r.doc_id, tuple(plain.encode(r.text or "", add_special_tokens=False).ids)) for r in hot.collect()}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and len(ids) == r.n_tokens and ids[-1] == 1 and (r.key, tuple(ids[:-1])) in texts
        at += len(ids)
    some = spark.createDataFrame([(5,), (5,), (4,), (777,), (None,)], "key long")
    got = token_index.read_ids(spark, folder, some, digest=True).collect()
    assert sorted(str(r.key) for r in got) == sorted(["5"] * 21 + ["4", "None"])
    empty = scratch_path(spark, "index-empty")
    token_index.write_ids(nothing, empty)
    assert token_index.read_ids(spark, empty).count() == 0
    assert token_index.read_ids(spark, empty, [5, None]).count() == token_index.read_ids(spark, empty, some).count() == 0


def test_token_index_opens_one_file_of_each_table_for_a_key(spark, docs, monkeypatch):
    """All other files are spoilt, and the lookup still works."""
    from pathlib import Path

    monkeypatch.setattr(token_index, "RANGE_DOCS", 3)
    monkeypatch.setattr(token_index, "BUCKET_KEYS", 4)
    folder = scratch_path(spark, "index-lookup")
    many = docs.select("doc_id", "text").unionByName(spark.range(100, 140).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text")))
    many = many.unionByName(spark.range(30).select(F.lit(120).alias("doc_id"), F.concat(F.lit("more "), "id").alias("text")))
    token_index.write_ids(many, folder)
    want = {(r.key, r.start): r for r in token_index.read_ids(spark, folder).collect()}
    assert len(want) == many.count()
    as_table = spark.createDataFrame([(k,) for k in (None, 5, 120, 133, 777)], "key long")
    for got in (token_index.read_ids(spark, folder, [None, 5, 120, 120, 133, 777]), token_index.read_ids(spark, folder, as_table)):
        rows = got.collect()
        assert {(r.key, r.start): r for r in rows} == {k: r for k, r in want.items() if k[0] in (None, 5, 120, 133)} and sum(r.key == 120 for r in rows) == 31
    # absent keys, as many as there are in the index and more
    lots = spark.range(10_000, 10_300).select(F.col("id").alias("key"))
    assert token_index.read_ids(spark, folder, lots).count() == 0
    place = token_index._places(spark, folder, spark.createDataFrame([(133,)], "key long"), True).first()
    bucket = spark.createDataFrame([(133,)], "key long").select(token_index._bucket(spark.read.parquet(f"{folder}/about").first()[0])).first()[0]
    keep = {f"part={place.part}", f"bucket={bucket}"}
    spoilt = 0
    for name in ("shards", "index"):
        for f in Path(folder.removeprefix("file://").removeprefix("file:"), name).glob("*/*.parquet"):
            if f.parent.name not in keep:
                f.write_bytes(b"spoilt")
                spoilt += 1
    assert spoilt > 20
    rows = token_index.read_ids(spark, folder, [133]).collect()
    assert len(rows) == 1 and rows[0] == want[(133, rows[0].start)]


def test_search_is_exact_at_factor_one_and_close_beyond(spark):
    rng = np.random.default_rng(9)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[500:1500] = x[7]  # one common vector
    x[20] *= 3
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    ids = np.arange(0, 3000, 100)
    score = x[ids].astype(float) @ x.T.astype(float)
    want = {}
    for r, i in enumerate(ids):
        order = np.lexsort((np.arange(3000), -np.round(score[r], 9)))
        want[i] = [j for j in order if j != i][:10]
    for factor, least in ((1.0, 1.0), (vp_tree.FACTOR, 0.9)):
        out = vp_tree.nearest(df, df.where("vec_id % 100 = 0"), k=10, factor=factor, shard_rows=800, block_queries=20).collect()
        got = {i: [r.vec_id for r in sorted((r for r in out if r.query_id == i), key=lambda r: r["rank"])] for i in ids}
        assert all(len(got[i]) == 10 for i in ids)
        assert np.mean([len(set(got[i]) & set(want[i])) / 10 for i in ids]) >= least
        if factor == 1.0:
            assert got == want


def test_search_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]),
            (7, [None, 1.0]), (20, [0.5, 0.5]), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (60, None), (8, [-0.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("score", F.lit(1)).withColumn("rank", F.lit("x"))
    out = vp_tree.nearest(df, df.where("vec_id % 20 = 0"), k=3).collect()
    got = {q: [(r.vec_id, r.score) for r in sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])] for q in (0, 20, 40, 60)}
    assert got == {0: [(1, 1.0), (20, 0.5), (8, 0.0)], 20: [(0, 0.5), (1, 0.5), (8, 0.5)], 40: [], 60: []}
    assert vp_tree.nearest(df.where("false"), df.where("false")).count() == 0


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "[\\INST] [\\\\INST] <s", "[TURN][ROLE]x[MSG]", "", None, "a\nb", "[OUT", "]</s", "\\", "$1 \\$2"]
    rows = [(c, t, r, nasty[(c + t) % len(nasty)]) for c in range(12) for t, r in enumerate(
        ["system", "user", "user", "assistant", "assistant", "tool[MSG]", None, "user"])]
    rows += [(None, 1, "user", "n"), (99, None, "user", "first"), (99, 0, "assistant", "x"), (99, 0, "assistant", "x"), (98, 5, "user", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("formatted", F.lit(1)).repartition(3)
    out = chat_format.format_chats(df)
    read = out.select("conv_id", "formatted", chat_format.read_turns(F.col("formatted")).alias("t"),
                      chat_format.masked_texts(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    order = lambda x: (x is not None, x)
    for r in read.collect():
        own = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (order(x[1]), x[2] or "", x[3] or ""))
        assert [(t.role, t.text) for t in r.t] == [(x[2] or "", x[3] or "") for x in own]
        assert list(r.loss) == [x[3] or "" for x in own if x[2] == "assistant"]
    assert chat_format.format_chats(df.where("false")).count() == 0


def test_urls(spark):
    urls = {"http://Ex.COM/a": ("ex.com", "/a", "com/", "allow"), "no scheme": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "https://www.example.com/en/1.html?x=1#f": ("www.example.com", "/en/1.html", "www.example.com/en/", "allow"),
            "ftp://a.b.net/es/7": ("a.b.net", "/es/7", "net/es/", "block"), "http://com?x": ("com", "", None, "allow"),
            "https://example.com/en/9/": ("example.com", "/en/9/", "example.com/en/", "block"), "x://notcom/": ("notcom", "/", None, "allow"),
            "http://s.example.com/en/": ("s.example.com", "/en/", "example.com/en/", "block"), "http://a.net/fr": ("a.net", "/fr", None, "allow"),
            "a://b://c/d": ("b:", "//c/d", None, "allow"), "http://ÀB.net/fr/é": ("Àb.net", "/fr/é", "net/fr/", "block"), "": ("", "", None, "allow")}
    pages = spark.createDataFrame(list(enumerate(urls)) + [(0, "http://Ex.COM/a")], "page_id long, url string").withColumn("host", F.lit(1))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = url_rules.judge(pages, labels).collect()
    assert len(rows) == len(urls) + 1
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == list(urls.values())[r.page_id]
    assert url_rules.judge(pages.where("false"), labels).count() == 0


def test_mined_rules_equal_brute_force(spark):
    pages = [(i, f"http://{'spam' if i // 2 % 2 else 'news'}.org/{'buy' if i % 2 else 'read'}/{i}?ref={i}") for i in range(900)]
    bad = lambda i: i // 2 % 2 and i % 2 and i % 50 != 3
    labels = [(i, 0 if bad(i) else 1, None) for i in range(600)] + [(None, 0, 1)]
    out = url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    got = {r.page_id: r.verdict for r in out.collect()}
    assert got == {i: "block" if i // 2 % 2 and i % 2 else "allow" for i in range(900)}


def test_hosts_of_a_site_count_together(spark):
    """A site whose bad pages are spread over more hosts than any one of them has the support for."""
    host = lambda i: f"h{i % 300}.{'spam' if i % 3 == 0 else 'news'}.org"
    pages = [(i, f"http://{host(i)}/{i}") for i in range(1200)]
    labels = [(i, int(i % 3 > 0), None) for i in range(900)]
    out = url_rules.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    for r in out.collect():
        assert r.verdict == ("block" if r.page_id % 3 == 0 else "allow") and ("site:spam.org" in (r.mined_rule or "")) == (r.page_id % 3 == 0)
    long = spark.createDataFrame([("http://" + "a." * 50_000 + "org/x",)], "url string").select(url_rules.tokens_of(F.col("url")).alias("t")).first().t
    assert sum(t.startswith("site:") for t in long) == 3


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizers_for_each_vocabulary(name):
    path = vocabulary_path(name)
    plain = load_tokenizer(path)
    want = [plain.encode(t, add_special_tokens=False).ids for t in ODD]
    words, chunks = WordEncoder(path), chunk_bpe.ChunkEncoder(path, 64)
    assert words.by_words == (name == "word_bpe_49k.json")
    for texts in (ODD, pa.array(ODD, pa.string()), pa.array(ODD, pa.large_string())):
        assert [np.frombuffer(r, words.dtype).tolist() for r in words.encode(texts)] == want
    for t, raw, ids in zip(ODD, chunks.encode(ODD), want, strict=True):
        assert np.frombuffer(raw, chunks.words.dtype).tolist() == ids
        assert chunks.decode(np.array(ids, np.int64)).decode() == plain.decode(ids, skip_special_tokens=False), t


def test_a_join_that_never_agrees_is_encoded_whole(monkeypatch):
    path = vocabulary_path()
    enc, plain = chunk_bpe.ChunkEncoder(path, 16), load_tokenizer(path)

    def never(*a):
        raise chunk_bpe.JoinError

    monkeypatch.setattr(enc, "_join", never)
    text = LONG[:2000] + "w" * 300
    assert np.frombuffer(enc.encode([text])[0], enc.words.dtype).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing_ends_without_caps_and_fills_bins_of_short_pieces():
    rng = np.random.default_rng(2)
    for lengths, over in ((rng.integers(5, 60, 5000), 0), (rng.integers(300, 1200, 5000), 0.01), (np.full(999, 700), 1)):
        at, offset = packing.pack_lengths(lengths, 2048)
        fill = np.bincount(at, weights=lengths)
        assert fill.max() <= 2048 and fill.min() > 0
        assert len(fill) <= -(-int(lengths.sum()) // 2048) * (1 + over)
        for b in range(0, len(fill), 97):
            held = np.flatnonzero(at == b)
            order = held[np.argsort(offset[held])]
            assert offset[order].tolist() == np.concatenate([[0], np.cumsum(lengths[order])[:-1]]).tolist()


def test_repeated_rows_are_dealt_to_all_shards(spark):
    df = spark.range(400).select(F.lit(7).alias("doc_id"), F.lit("the same text again").alias("text"))
    rows = packing.pack(df, shard_pieces=50).collect()
    assert len(rows) == 400 and len({r.sequence_id >> 32 for r in rows}) == 8

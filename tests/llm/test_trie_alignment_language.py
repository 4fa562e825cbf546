"""The prefix trie, token alignment and language identification against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierkit.llm import language_id, prefix_trie, queries, token_alignment
from tierkit.llm.tokens import vocabulary_path

from .conftest import LONG

SF = "/root/testdata/sf0.001"


def plain_nodes(conversations: dict[int, list]) -> set[tuple]:
    """Rows of the trie, prefix by prefix."""
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = {p: [q for q in members if q[: len(p)] == p] for p in members}
    children = {p: [q for q in below[p] if len(q) == len(p) + 1] for p in members}
    out = set()
    for p, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(conversations[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1].encode()) for q in below[p] if q)
        out.add((min(ids), len(p), min(members[p[:-1]]) if p else None, len(ids), len(children[p]),
                 sum(not children[q] for q in below[p]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def frame(spark, conversations, parts=3):
    rows = [(c, i, role, text, "x") for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth string").repartition(parts)


def some_conversations(seed=3, n=120):
    rng = random.Random(seed)
    words = [("user", "hé"), ("assistant", "ok"), ("user", "ok"), ("user", "")]
    out = {c: [rng.choice(words) for _ in range(rng.randint(1, 7))] for c in range(-3, n)}
    for c in range(200, 240):  # a hot conversation, and long ones that leave it
        out[c] = [("user", "same"), ("assistant", "again"), ("user", "end")]
    for c in (300, 301, 302):
        out[c] = [("user", "same")] * 40 + [("assistant", str(c))] * (c - 299)
    return out


@given(st.integers(0, 5000), st.integers(1, 5000))
def test_two_fattest(low, more):
    got = prefix_trie.two_fattest(low, low + more)
    two = lambda x: x & -x
    assert low < got <= low + more and two(got) == max(map(two, range(low + 1, low + more + 1)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=12), min_size=1, max_size=30))
def test_exit_nodes(words):
    """The search ends where a walk from the root does, and each batch counts its prefixes right."""
    trie, paths = prefix_trie.ZFastTrie(), []
    for c, word in enumerate(words):
        path = [prefix_trie.ROOT]
        for w in word:
            path.append(hashlib.blake2b(path[-1] + bytes([w]), digest_size=prefix_trie.KEY).digest())
        shared = max((sum(x == y for x, y in zip(path, p, strict=False)) - 1 for p in paths), default=0)
        _, depth = trie.locate(b"".join(path))
        assert depth == shared
        trie.insert(c, b"".join(path), [len(path)] * len(path))
        paths.append(path)
    want = Counter(k for p in paths for k in p)
    got = {}
    for first, keys, sizes, n, _, _ in trie.edges():
        assert len(keys) == prefix_trie.KEY * (len(sizes) + 1)
        got.update({keys[prefix_trie.KEY * (i + 1) :][: prefix_trie.KEY]: n for i in range(len(sizes))})
    assert got == want


@pytest.mark.parametrize("batch_turns", [1, 50, 10_000])
def test_trie_equals_prefix_counts(spark, batch_turns):
    conversations = some_conversations()
    got = prefix_trie.nodes(prefix_trie.turns(frame(spark, conversations)), batch_turns).collect()
    assert {tuple(r) for r in got} == plain_nodes(conversations) and len(got) == len(set(got))


def test_trie_edge_rows(spark):
    schema = "conv_id long, turn long, role string, text string, n_convs string"
    rows = [(1, None, None, None, "a"), (1, 2, "user", "b", None), (1, 2, "user", "b", "c"), (None, 1, "user", "b", "x"),
            (2, 1, "", "", "a"), (2, 3, "user", "b", "a"), (3, 1, "user", LONG, "a"), (3, 1, "assistant", "t", "a")]
    got = {tuple(r) for r in prefix_trie.nodes(prefix_trie.turns(spark.createDataFrame(rows, schema))).collect()}
    assert got == plain_nodes({1: [("", ""), ("user", "b"), ("user", "b")], 2: [("", ""), ("user", "b")],
                               3: [("assistant", "t"), ("user", LONG)]})
    assert prefix_trie.nodes(prefix_trie.turns(spark.createDataFrame([], schema))).collect() == []


def test_turnless_and_very_long_conversations(spark):
    """20,000 turns beside a copy that ends earlier; a conversation without turns is a member of the root."""
    n = 20_000
    long = spark.range(2 * n).select((F.col("id") % 2).alias("conv_id"), F.floor(F.col("id") / 2).alias("turn"), F.lit("user").alias("role"),
                                     F.concat(F.lit("t"), F.floor(F.col("id") / 2)).alias("text")).where("conv_id = 0 or turn < 9999")
    both = prefix_trie.turns(long)
    empty = spark.createDataFrame([(7, [])], both.schema)
    got = {r.depth: r for r in prefix_trie.nodes(both.unionByName(empty)).collect()}
    assert len(got) == n + 1 and got[0].n_convs == 3 and got[9999].n_convs == 2 and got[10000].n_convs == 1
    assert got[0].ends_sha256 == hashlib.sha256(b"7").hexdigest() and got[0].n_leaves == 1
    assert got[0].saved_tokens == sum(len(f"t{i}") for i in range(9999))


def align_plainly(texts):
    """Every link of every text, one by one."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=vocabulary_path("piece_bpe_32k.model"))
    byte_of = token_alignment._shown_bytes()
    found, held = [], Counter()
    for t in texts:
        found.append(None)
        if not t:
            continue
        x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
        raw_x = [bytes(byte_of[c] for c in a.id_to_token(i)) for i in x]
        raw_y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if not b"".join(raw_x) == b"".join(raw_y) == (" " + t).encode():
            continue
        end_x, end_y = (np.cumsum([len(r) for r in z]).tolist() for z in (raw_x, raw_y))
        groups, i, j = [], 0, 0
        for end in sorted(set(end_x) & set(end_y)):
            n, m = end_x.index(end) + 1, end_y.index(end) + 1
            groups.append((x[i:n], y[j:m]))
            i, j = n, m
        pairs = [(p, q) for g in groups for p in g[0] for q in g[1]]
        held.update(set(pairs))
        found[-1] = (len(x), len(y), groups, pairs)
    top = defaultdict(int)
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    none = (0, 0, 0, 0, 0, 0, "")
    return [none if f is None else (f[0], f[1], len(f[2]), len(f[3]), sum(held[p] == top[p[0]] for p in f[3]), sum(held[p] for p in f[3]),
                                    hashlib.sha256(";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in f[2]).encode()).hexdigest())
            for f in found]


@given(st.sets(st.integers(0, 400)), st.sets(st.integers(0, 400), max_size=30), st.sampled_from([1, 3, 64]))
def test_common_ends(a, b, block):
    a, b = (np.array(sorted(x), np.int64) for x in (a, b))
    at_a, at_b = token_alignment.common_ends(a, b, block)
    assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_wide_groups_are_counted_alike(monkeypatch):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 5, 60), rng.integers(0, 5, 80)
    ends_a, ends_b = np.arange(1, 61) * 8, np.arange(1, 81) * 6

    def totals():
        *_, pair, times = token_alignment.links(a, b, ends_a, ends_b)
        total = Counter()
        for p, n in zip(pair.tolist(), times.tolist(), strict=True):
            total[p] += n
        return total

    listed = totals()
    monkeypatch.setattr(token_alignment, "LISTED", 1)
    assert totals() == listed and sum(listed.values()) == 20 * 3 * 4


ODD = ["", "plain words here", "  a  b   c ", " ▁x y", "a▁b", "Ünïcödé ŒUVRE İstanbul", "don't we'll 12 3a4b ... !?", "x\x1cy \x1d z",
       "a b c　d 　 e", "<|endoftext|> <s> </s> <unk> <0x41>", "日本語 テスト", "\U0001f600\U0001f600 x", "tab\tnew\nline\r\nend \n\n\n x",
       "a\x00b", "w" * 5000, "\n", " ", "x ", "é" * 300, "ab\x85 c \x85d", "plain words here", "k7Zp+f/xK2" * 300, LONG[:2000], None]


def test_alignment_equals_brute_force(spark):
    rows = [(i if i != 4 else None, t, "clash") for i, t in enumerate(ODD)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    got = Counter(tuple(r) for r in token_alignment.align(df).collect())
    assert got == Counter((r[0], *w) for r, w in zip(rows, align_plainly(ODD), strict=True))
    assert token_alignment.align(df.where("false")).collect() == []


def test_op12_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = Counter(tuple(r) for r in queries.op12_token_alignment(spark, SF).collect())
    assert got == Counter((d.doc_id, *w) for d, w in zip(docs, align_plainly([d.text for d in docs]), strict=True))


def test_a_worker_cache_that_starts_anew_changes_nothing(monkeypatch):
    paths = vocabulary_path("byte_bpe_50k.json"), vocabulary_path("piece_bpe_32k.model")
    texts = [t for t in ODD if t]
    want = token_alignment.Aligner(*paths).chunk(texts)
    monkeypatch.setattr(token_alignment, "CACHE_ENTRIES", 1)
    known = token_alignment.Aligner(*paths)
    for _ in range(2):
        got = known.chunk(texts)
        assert got[0] == want[0] and got[1].tolist() == want[1].tolist() and got[2].tolist() == want[2].tolist()


def test_language_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op13_language_id(spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id")
    out = [r for r in got.collect() if r.held_out]
    assert len(out) > 250 and sum(r.lang_pred == r.lang for r in out) >= 0.99 * len(out)
    assert all(0 < r.score <= 1 for r in out) and len({round(r.score, 3) for r in out}) > 20


def test_language_edge_rows(spark, docs, nothing):
    model = language_id.fit(docs)
    rows = {r.doc_id: r for r in language_id.predict(docs, model).collect()}
    assert len(language_id.predict(docs, model).collect()) == docs.count()
    for i in (2, 3, 6):
        assert rows[i].lang_pred == "und"
    assert rows[7].lang_pred == "en" and 0 <= rows[7].score <= 1
    # no other column counts
    text_only = docs.select("doc_id", "text")
    assert sorted(map(str, language_id.predict(text_only, model).collect())) == sorted(map(str, language_id.predict(docs, model).collect()))
    assert language_id.fit(nothing) is None and language_id.predict(nothing, None).collect() == []
    assert {r.lang_pred for r in language_id.predict(docs, None).collect()} == {"und"}


def test_nothing_is_learned_from_the_held_out_fold(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    other = docs.withColumn("lang", F.when(language_id.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    a, b = language_id.fit(docs), language_id.fit(other)
    assert a.languages == b.languages and (a.rows == b.rows).all() and a.heat == b.heat


def test_shares_of_languages():
    counts = {"en": 10_000, "de": 100, "fr": 2000}
    got = language_id.shares(counts, 3000)
    assert got["de"] == 1 and abs(sum(got[x] * n for x, n in counts.items()) - 3000) < 1e-6
    assert abs(got["en"] * 10_000 - got["fr"] * 2000) < 1e-6


def test_grams_are_those_of_folded_words():
    import pyarrow as pa

    one, two, none, long = language_id.grams(pa.array(["Das  Haus!", "das haus 12", "12 .,", "ab " * 400_000], pa.string()))
    assert Counter(one.tolist()) == Counter(two.tolist()) and len(none) == 0 and len(long) > 1_000_000

"""Alignment of two tokenizers' tokens over whole texts, and the id pairs that the corpus links most.

Tokens of ``byte_bpe_50k.json`` (A) and ``piece_bpe_32k.model`` (B) over blank + text are laid side by side: byte
offsets where tokens of both end cut the text into groups, and every A-B pair of occurrences within a group is a
link.  ``common_ends`` finds the offsets by galloping: the shorter list of ends drives an exponential and then a
binary search through the longer one.  The places of the common ends in both lists slice the groups, and
differences of those ranks are the numbers of tokens that overlap.

A blank between a character other than a blank and one that is no white space ends a token of both: A's
pattern starts a new word there, and no piece of B holds a blank behind another character (tested when it is
loaded).  So a text is cut there, a worker keeps what it knows about a stretch, and only new stretches are
encoded and aligned, many at once.

How many documents hold an id pair linked is counted over the whole corpus without moving occurrences: a task
numbers the distinct pairs of a chunk of documents (``CHUNK_BYTES``, ``CHUNK_ROWS``; one longer document is a chunk)
and writes them once with its documents' links by those numbers.  One row per chunk and pair is summed up by
pair, the answers go back to the chunk by a join, and a chunk's documents are finished beside its answers.
A pair that is in every document is one row per chunk; nothing is broadcast or collected.

Defined cases: a text that is null, empty, or that the joined bytes of A's or B's tokens don't give back (a text
that holds U+2581, say) has no tokens: zeros and ''.  Every row is a document, also one that repeats or has a null
``doc_id``; ties for an A id's highest count are all best; an empty table gives no rows; extra columns are ignored.
Links of a group are never listed one by one beyond ``LISTED`` of them: distinct ids are counted, and the counts
multiplied.
"""

from __future__ import annotations

import hashlib
import re
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.common import saved, ship_package, whole_text
from tierkit.llm.tokens import load_tokenizer, vocabulary_path

CHUNK_BYTES, CHUNK_ROWS = 8 << 20, 2048  # of text, of documents
CACHE_ENTRIES, CACHE_BYTES = 250_000, 96 << 20
BLOCK_CHARS = 1 << 14
LISTED = 4096  # pairs of occurrences that a group may list
_EARLY = "\u0250"  # letters below are settled
_CUT = re.compile(r"(?<! ) (?=\S)")
_ALIGNERS: dict[tuple[str, str], "Aligner"] = {}


def common_ends(a: np.ndarray, b: np.ndarray, block: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` (both strictly ascending) of the values that both hold.

    The shorter list drives: for each block of it, steps that double find where the longer list passes the
    block's last value, and a binary search within that stretch places all values of the block.
    """
    if len(a) > len(b):
        there, here = common_ends(b, a, block)
        return here, there
    at_a, at_b, low = [], [], 0
    for i in range(0, len(a), block):
        part = a[i : i + block]
        step, high = block, low
        while high < len(b) and b[high] < part[-1]:
            high += step
            step *= 2
        stretch = b[low : high + 1]
        found = np.searchsorted(stretch, part)
        hit = np.flatnonzero(found < len(stretch))
        hit = hit[stretch[found[hit]] == part[hit]]
        at_a.append(hit + i)
        at_b.append(found[hit] + low)
        low += int(found[-1])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *at_a]), np.concatenate([none, *at_b])


def _spread(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... counts[0]-1, 0, 1, ... counts[1]-1 and so on."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def links(a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """Links of two lists of tokens with their ends: ``(cut_a, cut_b, group, pair, times)``.

    ``cut_a`` and ``cut_b`` are the numbers of tokens up to the end of each group; ``pair`` is A's id << 32 | B's id,
    and ``times`` counts the occurrences of it that the entry stands for.
    """
    at_a, at_b = common_ends(ends_a, ends_b)
    cut_a, cut_b = at_a + 1, at_b + 1
    first_a, first_b = np.concatenate([[0], cut_a[:-1]]), np.concatenate([[0], cut_b[:-1]])
    n_a, n_b = cut_a - first_a, cut_b - first_b
    wide = n_a * n_b > LISTED
    few = np.where(wide, 0, n_a)
    # every A token of a narrow group beside all B tokens of it
    group_of = np.repeat(np.arange(len(few)), few)
    token = np.repeat(first_a, few) + _spread(few)
    beside = n_b[group_of]
    group = np.repeat(group_of, beside)
    mine = a[np.repeat(token, beside)]
    other = b[np.repeat(first_b[group_of], beside) + _spread(beside)]
    pair, times = mine.astype(np.int64) << 32 | other, np.ones(len(mine), np.int64)
    for g in np.flatnonzero(wide):
        u, nu = np.unique(a[first_a[g] : cut_a[g]], return_counts=True)
        v, nv = np.unique(b[first_b[g] : cut_b[g]], return_counts=True)
        pair = np.concatenate([pair, (u.astype(np.int64)[:, None] << 32 | v[None, :]).ravel()])
        times = np.concatenate([times, (nu[:, None] * nv[None, :]).ravel()])
        group = np.concatenate([group, np.full(len(u) * len(v), g)])
    return cut_a, cut_b, group, pair, times


class _Grown:
    """A numpy array that rows are added to."""

    def __init__(self, kind, *width: int):
        self.n, self.rows = 0, np.zeros((1024, *width), kind)

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.rows):
            more = np.zeros((2 * (self.n + len(rows)), *self.rows.shape[1:]), self.rows.dtype)
            more[: self.n] = self.rows[: self.n]
            self.rows = more
        self.rows[self.n : self.n + len(rows)] = rows
        self.n += len(rows)

    def all(self) -> np.ndarray:
        return self.rows[: self.n]


def _shown_bytes() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(other)}}


class Aligner:
    """What a worker knows about stretches of text: tokens of both, links and groups."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = load_tokenizer(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = _shown_bytes()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            self.bytes_a[i] = bytes(shown.get(c, 0) for c in piece)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("pieces that hold a blank behind another character can't be cut at blanks")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        self.long_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.long_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # ids written out with each mark that may stand behind them
        self.signs = [f"{i}{m}" for i in range(max(len(self.bytes_a), len(pieces))) for m in ",|;"]
        self.sign_chars = np.array([len(x) for x in self.signs], np.int64)
        self.fast_a = self._ranked(path_a)
        self._forget()

    def _ranked(self, path: str):
        """A's merges by the rank of what they make, where the file's ids are in the order of its merges (else None).

        Used for characters below U+0250 alone: on later ones the two libraries' tables of letters could differ.
        """
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made != sorted(made):
            return None
        special = set(self.a.get_added_tokens_decoder())
        ranks = {b: i for i, b in enumerate(self.bytes_a) if i not in special}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode_a(self, text: str) -> list[int]:
        if self.fast_a and max(text) < _EARLY:
            return self.fast_a.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def _forget(self) -> None:
        """Start anew: ``known`` numbers the stretches; the rest is by that number, links by ``starts`` and ``sizes``."""
        self.known: dict[str, int] = {}
        self.texts: list[bytes] = []  # the groups, written out
        self.kept = 0
        self.pairs, self.times = _Grown(np.int64), _Grown(np.int64)
        # the place and number of a stretch's links, then n_a, n_b, n_groups, n_links; n_groups is 0 where the tokens
        # don't give the stretch back
        self.facts = _Grown(np.int64, 6)

    @staticmethod
    def cut(text: str) -> list[str]:
        """Stretches of blank + text, each with the blank before it."""
        first, *rest = _CUT.split(" " + text)
        return [first] * bool(first) + [" " + s for s in rest]

    def learn(self, stretches: list[str]) -> None:
        """Encode and align new stretches.

        Stretches that begin and end as a cut asks for are encoded as one text of some ``BLOCK_CHARS`` characters,
        others one by one.
        """
        odd = [s for s in stretches if s[-1] == " " or s[1].isspace() or "▁" in s]
        away = set(odd)
        late = [s for s in stretches if not s.isascii() and max(s) >= _EARLY and s not in away]
        away.update(late)
        for kind in ([s for s in stretches if s not in away], late):
            ends = np.cumsum(np.fromiter(map(len, kind), np.int64, len(kind))) // BLOCK_CHARS
            first = 0
            for end in [*(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(kind)]:
                if end > first:
                    self._learn_block(kind[first:end])
                first = end
        self._learn_apart(odd)

    def _learn_block(self, names: list[str]) -> None:
        text = "".join(names)
        a = self._encode_a(text)
        b = self.b.encode(text[1:], num_threads=1)
        if b"".join(map(self.bytes_a.__getitem__, a)) != text.encode() or b"".join(map(self.bytes_b.__getitem__, b)) != text.encode():
            return self._learn_apart(names)
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        stops = np.cumsum(np.fromiter(map(len, map(str.encode, names)), np.int64, len(names)))
        n_a, n_b = (np.diff(np.searchsorted(np.cumsum(n[x]), stops) + 1, prepend=0) for n, x in ((self.long_a, a), (self.long_b, b)))
        self._keep(names, a, b, n_a, n_b)

    def _learn_apart(self, stretches: list[str]) -> None:
        right = []
        for s in stretches:
            x, y, raw = self.a.encode(s, add_special_tokens=False).ids, self.b.encode(s[1:]), s.encode()
            if b"".join([self.bytes_a[i] for i in x]) == raw == b"".join([self.bytes_b[i] for i in y]):
                right.append((s, x, y))
            else:
                self.known[s] = len(self.texts)
                self.texts.append(b"")
                self.facts.add(np.zeros((1, 6), np.int64))
        if right:
            names, all_a, all_b = zip(*right, strict=True)
            a, b = (np.array(list(chain.from_iterable(z)), np.int64) for z in (all_a, all_b))
            self._keep(names, a, b, *(np.array(list(map(len, z)), np.int64) for z in (all_a, all_b)))

    def _keep(self, names: list[str], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> None:
        """Align the tokens of stretches, ``n_a`` and ``n_b`` of each."""
        # one list of ends for all stretches: the last token of a stretch ends both
        cut_a, cut_b, group, pair, times = links(a, b, np.cumsum(self.long_a[a]), np.cumsum(self.long_b[b]))
        order = np.argsort(group, kind="stable")
        group, times = group[order], times[order]
        last = np.searchsorted(cut_a, np.cumsum(n_a))  # the last group of each stretch
        stops = np.searchsorted(group, last, side="right")
        starts = np.concatenate([[0], stops[:-1]])
        self.facts.add(np.stack([starts + self.pairs.n, stops - starts, n_a, n_b, np.diff(last, prepend=-1),
                                 np.add.reduceat(times, starts)], 1))
        self.pairs.add(pair[order])
        self.times.add(times)
        # all tokens written out by groups, A's before B's, each with the mark behind it
        group_a, group_b = (np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in (cut_a, cut_b))
        order = np.argsort(np.concatenate([group_a * 2, group_b * 2 + 1]), kind="stable")
        mark_a, mark_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        mark_a[cut_a - 1], mark_b[cut_b - 1] = 1, 2
        signs = np.concatenate([a * 3 + mark_a, b * 3 + mark_b])[order]
        ends = np.cumsum(self.sign_chars[signs])[np.cumsum(n_a + n_b) - 1]
        text = "".join(map(self.signs.__getitem__, signs.tolist())).encode()
        first = 0
        for s, end in zip(names, ends.tolist(), strict=True):
            self.known[s] = len(self.texts)
            self.texts.append(text[first : end - 1])
            first = end
        self.kept += len(text) + sum(map(len, names))

    def chunk(self, texts: list[str]) -> tuple[list[list], np.ndarray, np.ndarray]:
        """For documents: columns n_a, n_b, n_groups, n_links, digest, places, times, then the chunk's distinct pairs and
        how many documents hold each.  ``places`` are ascending numbers of pairs as differences, 32 bits each."""
        if len(self.known) > CACHE_ENTRIES or self.kept > CACHE_BYTES:
            self._forget()
        cut = [self.cut(t) if t else [] for t in texts]
        every = list(chain.from_iterable(cut))
        met = dict.fromkeys(every)
        self.learn([s for s in met if s not in self.known])
        which = np.fromiter(map(self.known.__getitem__, every), np.int64, len(every))
        ends = np.cumsum([len(s) for s in cut])
        facts = self.facts.all()
        # numbers of the chunk's pairs, from its distinct stretches alone
        own = np.unique(which)
        sizes = np.zeros(len(facts), np.int64)
        sizes[own] = facts[own, 1]
        starts = np.cumsum(sizes) - sizes
        at = np.repeat(facts[own, 0], sizes[own]) + _spread(sizes[own])
        times = self.times.all()[at]
        pairs, place = np.unique(self.pairs.all()[at], return_inverse=True)
        held, out = np.zeros(len(pairs), np.int64), []
        first = 0
        for end in ends.tolist():
            s = which[first:end]
            first = end
            n = facts[s]
            if not len(s) or not n[:, 4].all():
                out.append((0, 0, 0, 0, "", b"", b""))
                continue
            at = np.repeat(starts[s], n[:, 1]) + _spread(n[:, 1])
            number, inverse = np.unique(place[at], return_inverse=True)
            held[number] += 1
            digest = hashlib.sha256(b";".join(map(self.texts.__getitem__, s.tolist()))).hexdigest()
            out.append((*n[:, 2:].sum(0).tolist(), digest, np.diff(number, prepend=0).astype("<u4").tobytes(),
                        np.bincount(inverse, weights=times[at]).astype("<u8").tobytes()))
        return [list(c) for c in zip(*out, strict=True)], pairs, held


def aligner(path_a: str, path_b: str) -> Aligner:
    """The worker's aligner, kept between tasks."""
    if (path_a, path_b) not in _ALIGNERS:
        _ALIGNERS[path_a, path_b] = Aligner(path_a, path_b)
    return _ALIGNERS[path_a, path_b]


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_CHUNKS = "chunk long, doc_id long, " + "".join(f"{c} long, " for c in _COUNTS) + (
    "groups_sha256 string, places binary, times binary, pairs array<long>, held array<long>")


def align_chunks(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Documents with their links by a chunk's numbers, and one row per chunk with its pairs."""
    schema = pa.schema([("chunk", pa.int64()), ("doc_id", pa.int64()), *[(c, pa.int64()) for c in _COUNTS],
                        ("groups_sha256", pa.string()), ("places", pa.binary()), ("times", pa.binary()),
                        ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int64()))])

    def chunks(batches):
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            first = size = 0
            lengths = [len(t) if t else 0 for t in texts.to_pylist()]
            for i, n in enumerate([*lengths, None]):
                if i > first and (n is None or i - first == CHUNK_ROWS or size + n > CHUNK_BYTES):
                    yield ids[first:i], texts.slice(first, i - first).to_pylist()
                    first, size = i, 0
                size += n or 0

    def run(batches):
        known, task = aligner(path_a, path_b), TaskContext.get().partitionId()
        for k, (ids, texts) in enumerate(chunks(batches)):
            columns, pairs, held = known.chunk(texts)
            name = task << 32 | k
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(ids), pa.int64()), pa.array(ids, pa.int64()),
                 *[pa.array(c, schema.field(i).type) for i, c in enumerate(columns, 2)],
                 pa.nulls(len(ids), schema.field(9).type), pa.nulls(len(ids), schema.field(10).type)], schema=schema)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), *[pa.nulls(1, f.type) for f in list(schema)[1:9]],
                 pa.array([pairs], schema.field(9).type), pa.array([held], schema.field(10).type)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), whole_text().alias("text")).mapInArrow(run, _CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair``, the number of documents that hold it linked (``n``), whether that is its A id's highest (``best``)."""
    each = chunks.where("pairs is not null").select(F.explode(F.arrays_zip("pairs", "held")).alias("p"))
    counts = each.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.held").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))
    return counts.withColumn("best", F.col("n") == F.max("n").over(of_a))


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``n_best`` counts the links whose pair is the one of its A id that most documents hold; ``count_sum`` adds up
    over all links how many documents hold their pair; ``groups_sha256`` digests ``a1,a2|b1;a3|b2,b3`` and so on.
    """
    ship_package(docs.sparkSession)
    chunks = saved(align_chunks(docs, path_a or vocabulary_path("byte_bpe_50k.json"),
                                path_b or vocabulary_path("piece_bpe_32k.model")), "aligned")
    asked = chunks.where("pairs is not null").select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(pair_counts(chunks).hint("shuffle_merge"), "pair").select("chunk", "place", "n", "best")
    answers = answers.groupBy(F.col("chunk").alias("of_chunk")).agg(
        F.sort_array(F.collect_list(F.struct("place", "n", "best"))).alias("all")).select(
        "of_chunk", F.col("all.n").alias("n"), F.col("all.best").alias("best"))
    held = chunks.where("pairs is null").drop("pairs", "held")

    def finish(rows: pa.Table, answer: pa.Table) -> pa.Table:
        counts = np.array(answer["n"][0].values, np.int64) if answer.num_rows else np.zeros(0, np.int64)
        best = np.array(answer["best"][0].values.to_numpy(zero_copy_only=False), bool) if answer.num_rows else np.zeros(0, bool)
        n_best, sums = [], []
        for p, t in zip(rows["places"].to_pylist(), rows["times"].to_pylist(), strict=True):
            at, times = np.cumsum(np.frombuffer(p, "<u4"), dtype=np.int64), np.frombuffer(t, "<u8").astype(np.int64)
            n_best.append(int(times[best[at]].sum()))
            sums.append(int((times * counts[at]).sum()))
        return pa.table([rows["doc_id"], *[rows[c] for c in _COUNTS], pa.array(n_best, pa.int64()), pa.array(sums, pa.int64()),
                         rows["groups_sha256"]], names=["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"])

    return held.groupBy("chunk").cogroup(answers.groupBy("of_chunk")).applyInArrow(
        finish, "doc_id long, " + "".join(f"{c} long, " for c in [*_COUNTS, "n_best", "count_sum"]) + "groups_sha256 string")

"""Prefix trie of conversations: shared prefixes, who shares them, and what a prefix cache would save.

A turn is a digest of its role and text, a path is the chain of those digests (128 bits a depth), so equal digests
mean equal prefixes and texts never move.  Tasks insert their paths into z-fast tries, a batch of ``BATCH_TURNS`` turns
at a time (``ZFastTrie``): compacted nodes are hashed at their handle, the prefix whose length is the two-fattest
number of the node's edge, and fat binary search finds a path's exit node with about log2(length) look-ups.
A batch then gives away its edges with the counts of their nodes; edges are expanded to one row per depth, and equal
prefixes of all batches are added up by digest.  So a prefix that a third of all conversations share is one row
per batch before the shuffle.

Sums over subtrees need no walk down the trie.  A conversation owns the nodes whose smallest member it is: from
some depth on, all nodes of its path.  What a node's subtree saves is, over its members, the bytes from the node
to where the member's own nodes begin; its leaves are the members that own a childless last node.  Each conversation
adds those to the nodes of its path, in proportion to its length, added up before the shuffle.

Ids that end at one node are digested in order by definition; they are sorted by range, so that those of one
node may span tasks, written out there, and only those pieces pass one task, as a stream.

Defined cases: rows with a null ``conv_id`` take no part; a null role or text is empty; null turns come first; ties in
turn go by role, then the text's digest, and repeated rows all stay; an empty table has no nodes, not even a root;
extra columns are ignored.  A conversation is one row of 24 bytes a turn.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import saved, ship_package

BATCH_TURNS = 200_000
KEY = 16  # bytes of a prefix's digest
ROOT = hashlib.blake2b(b"", digest_size=KEY).digest()


def turns(chats: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id`` and ``turns``, its turns in order as structs (digest, size in bytes)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    each = chats.where("conv_id is not null").select(
        F.col("conv_id").cast("long"), F.struct(
            "turn", role.alias("role"), F.unhex(F.sha2(F.concat(F.length(role), F.lit(":"), role, text), 256)).alias("digest"),
            F.octet_length(text).cast("long").alias("size")).alias("t"))
    return each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def paths(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (digests of the prefixes of 0, 1, ... turns, one after another) and ``upto`` (bytes so far)."""
    def run(batches):
        for b in batches:
            keys, upto = [], []
            for conversation in b.column(1).to_pylist():
                key, path, sizes = ROOT, [ROOT], [0]
                for t in conversation:
                    key = hashlib.blake2b(key + t["digest"], digest_size=KEY).digest()
                    path.append(key)
                    sizes.append(t["size"])
                keys.append(b"".join(path))
                upto.append(list(accumulate(sizes)))
            yield pa.record_batch([b.column(0), pa.array(keys, pa.binary()), pa.array(upto, pa.list_(pa.int64()))],
                                  names=["conv_id", "path", "upto"])

    return conversations.select("conv_id", "turns").mapInArrow(run, "conv_id long, path binary, upto array<long>")


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that the highest power of two divides."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class ZFastTrie:
    """Compacted trie of paths; nodes are numbers, 0 the root.  A node's edge covers the depths ``name`` to ``extent``."""

    def __init__(self):
        self.handles: dict[bytes, int] = {}  # the prefix of handle length: its node
        self.names: dict[bytes, int] = {}  # the prefix one turn below a node: that child
        self.name, self.extent, self.parent = [0], [0], [-1]
        self.path, self.upto = [ROOT], [[0]]  # of one conversation below the node
        self.ends, self.least, self.deepest = [0], [None], [0]  # of conversations that end at the node

    @staticmethod
    def _at(path: bytes, depth: int) -> bytes:
        return path[KEY * depth : KEY * (depth + 1)]

    def locate(self, path: bytes) -> tuple[int, int]:
        """The exit node of a path, and the depth on that node's edge up to which they agree."""
        at, length = self._at, len(path) // KEY - 1
        low, high, node = 0, length, 0
        while low < high:  # fat binary search for the deepest handle on the path
            f = two_fattest(low, high)
            hit = self.handles.get(at(path, f))
            if hit is None:
                high = f - 1
            else:
                node, low = hit, self.extent[hit]
        e = self.extent[node]
        if e <= length and at(path, e) == at(self.path[node], e):
            child = self.names.get(at(path, e + 1)) if e < length else None
            if child is None:
                return node, e
            node = child
        low, high, mine = self.name[node], min(self.extent[node], length), self.path[node]
        while low < high:  # they agree at the name, and nowhere behind the first difference
            middle = (low + high + 1) // 2
            if at(path, middle) == at(mine, middle):
                low = middle
            else:
                high = middle - 1
        return node, low

    def _add(self, name: int, extent: int, parent: int, path: bytes, upto: list[int]) -> int:
        node = len(self.name)
        for column, value in ((self.name, name), (self.extent, extent), (self.parent, parent), (self.path, path),
                              (self.upto, upto), (self.ends, 0), (self.least, None), (self.deepest, 0)):
            column.append(value)
        self._hang(node)
        return node

    def _hang(self, node: int) -> None:
        name, path = self.name[node], self.path[node]
        self.names[self._at(path, name)] = node
        self.handles[self._at(path, two_fattest(name - 1, self.extent[node]))] = node

    def insert(self, conv_id: int, path: bytes, upto: list[int]) -> None:
        length = len(path) // KEY - 1
        node, depth = self.locate(path)
        if depth < self.extent[node]:  # a new node above, with the upper part of the edge
            below, node = node, self._add(self.name[node], depth, self.parent[node], self.path[node], self.upto[node])
            self.name[below], self.parent[below] = depth + 1, node
            self._hang(below)
        if depth < length:
            node = self._add(depth + 1, length, node, path, upto)
        self.ends[node] += 1
        self.least[node] = conv_id if self.least[node] is None else min(conv_id, self.least[node])

    def edges(self) -> list[tuple]:
        """Rows (first depth, digests of the edge's prefixes with its parent's in front, sizes, members, smallest member,
        turns of the longest member), one per node."""
        n, least, deepest = list(self.ends), list(self.least), [e if k else 0 for e, k in zip(self.extent, self.ends, strict=True)]
        rows = []
        for node in sorted(range(len(n)), key=self.extent.__getitem__, reverse=True):
            p = self.parent[node]
            if p >= 0:
                n[p] += n[node]
                least[p] = least[node] if least[p] is None else min(least[p], least[node])
                deepest[p] = max(deepest[p], deepest[node])
            first, last, upto = self.name[node], self.extent[node], self.upto[node]
            sizes = [0] if p < 0 else [upto[d] - upto[d - 1] for d in range(first, last + 1)]
            keys = self.path[node][: KEY] * 2 if p < 0 else self.path[node][KEY * (first - 1) : KEY * (last + 1)]
            rows.append((first, keys, sizes, n[node], least[node], deepest[node]))
        return rows


_EDGE = pa.schema([("first", pa.int64()), ("keys", pa.binary()), ("sizes", pa.list_(pa.int64())), ("n_convs", pa.int64()),
                   ("conv_id", pa.int64()), ("deepest", pa.int64())])


def batch_edges(every: DataFrame, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """The edges of a trie for each batch of paths."""
    def run(batches):
        trie, size = ZFastTrie(), 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*trie.edges(), strict=True), _EDGE, strict=True)],
                                              schema=_EDGE)

        for b in batches:
            for conv_id, path, upto in zip(*(c.to_pylist() for c in b.columns), strict=True):
                trie.insert(conv_id, path, upto)
                size += len(upto)
                if size >= batch_turns:
                    yield out()
                    trie, size = ZFastTrie(), 0
        if size:
            yield out()

    return every.select("conv_id", "path", "upto").mapInArrow(
        run, "first long, keys binary, sizes array<long>, n_convs long, conv_id long, deepest long")


def _key(path: Column, depth: Column) -> Column:
    return F.substr(path, (depth * KEY + 1).cast("int"), F.lit(KEY))


def expanded(edges: DataFrame) -> DataFrame:
    """All prefixes with their members, from the edges of all batches."""
    each = edges.select("n_convs", "conv_id", "deepest", F.explode(F.transform(
        F.sequence(F.lit(0), F.size("sizes") - 1), lambda i: F.struct(
            _key(F.col("keys"), i + 1).alias("key"), _key(F.col("keys"), i).alias("parent"),
            (F.col("first") + i).alias("depth"), F.element_at("sizes", i + 1).alias("size")))).alias("e"))
    return each.groupBy("e.key", "e.parent", "e.depth", "e.size").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("deepest").alias("deepest"))


def end_digests(every: DataFrame) -> DataFrame:
    """``key`` of each prefix that is a whole conversation, and the sha256 of their ids in order, comma-joined."""
    ends = every.select(F.substr("path", F.lit(-KEY), F.lit(KEY)).alias("key"), "conv_id")

    def pieces(batches):
        for b in batches:
            keys, ids = b.column(0).to_pylist(), b.column(1).to_pylist()
            starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
            yield pa.record_batch([pa.array([keys[i] for i in starts], pa.binary()), pa.array([ids[i] for i in starts], pa.int64()),
                                   pa.array([",".join(map(str, ids[i:j])) for i, j in zip(starts, [*starts[1:], len(keys)], strict=True)])],
                                  names=["key", "at", "text"])

    def digests(batches):
        key, sha = None, None
        for b in batches:
            done = []
            for k, text in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if k == key:
                    sha.update(b"," + text.encode())
                    continue
                if key is not None:
                    done.append((key, sha.hexdigest()))
                key, sha = k, hashlib.sha256(text.encode())
            yield table(done)
        if key is not None:
            yield table([(key, sha.hexdigest())])

    def table(rows):
        return pa.record_batch([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())],
                               names=["key", "ends_sha256"])

    ordered = ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    whole = ordered.mapInArrow(pieces, "key binary, at long, text string").repartition("key").sortWithinPartitions("key", "at")
    return whole.mapInArrow(digests, "key binary, ends_sha256 string")


def nodes(conversations: DataFrame, batch_turns: int = BATCH_TURNS) -> DataFrame:
    """One row per distinct prefix of the conversations (``conv_id``, ``turns``): conv_id (its smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ship_package(conversations.sparkSession)
    every = saved(paths(conversations), "paths")
    found = saved(expanded(batch_edges(every, batch_turns)), "prefixes")
    owners = found.groupBy("conv_id").agg(F.min("depth").alias("top"), F.max((F.col("deepest") == F.col("depth")).cast("int")).alias("leaf"))
    last = F.size("upto").cast("long") - 1
    owned = saved(every.join(owners, "conv_id", "left").select(
        "conv_id", "path", "upto", F.coalesce("top", last + 1).alias("top"), F.coalesce("leaf", F.lit(0)).alias("leaf")), "owned")

    upto = lambda d: F.element_at("upto", (d + 1).cast("int"))
    reach = F.when(F.col("leaf") == 1, last).otherwise(F.col("top") - 1)
    added = owned.where(reach >= 0).select(F.explode(F.transform(F.sequence(F.lit(0).cast("long"), reach), lambda d: F.struct(
        _key(F.col("path"), d).alias("key"), F.col("leaf").alias("leaf"),
        F.when(d < F.col("top"), upto(F.col("top") - 1) - upto(F.greatest(d, F.lit(1)) - 1)).otherwise(0).alias("saved")))).alias("a"))
    sums = added.groupBy("a.key").agg(F.sum("a.leaf").alias("n_leaves"), F.sum("a.saved").alias("saved_tokens"))
    children = found.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    # where a conversation's own nodes begin, the parent is another's; deeper ones are its own
    begins = owned.where((F.col("top") > 0) & (F.col("top") <= last)).select(
        _key(F.col("path"), F.col("top")).alias("key"), _key(F.col("path"), F.col("top") - 1).alias("above"))
    parents = begins.join(found.select(F.col("key").alias("above"), F.col("conv_id").alias("other")), "above").select("key", "other")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    out = found.select("key", "conv_id", "depth", "n_convs")
    for other in (sums, children, parents, end_digests(every)):
        out = out.join(other, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select("conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("other", "conv_id")).alias("parent_conv_id"),
                      "n_convs", zero("n_children"), zero("n_leaves"), zero("saved_tokens"),
                      F.coalesce("ends_sha256", none).alias("ends_sha256"))

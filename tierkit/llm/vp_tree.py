"""Approximate nearest neighbours by inner product: vantage-point trees per shard, pruning relaxed by a factor.

Vectors are dealt by a hash to shards of about ``SHARD_ROWS`` rows and queries to
blocks of about ``BLOCK_QUERIES``; each pair of a shard and a block is a task of
bounded size. A shard's vectors get one more component that makes all norms
equal, so that the nearest by Euclidean distance is the one with the largest
inner product, and a tree is built by splitting at the median distance to a
vantage point. The queries of a block go down to their nearest leaves first,
and then through the tree together. A subtree is left out for those queries for
which ``factor`` times the triangle inequality's lower bound of its distances
exceeds the distance of the k-th found: factor one is exact search, larger ones
trade recall for time. Within a leaf every vector is compared in double
precision.

Copies: of equal vectors only the k + 1 with the smallest ids can be among the k
nearest of any query (its own one doesn't count), so the others are left out
before the search, which changes no result.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do rows without an id; repeated rows count once;
a query meets only vectors of its length; ties go to the smaller id; with fewer
than k candidates all come back; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierkit.llm.common import saved, ship_package

SHARD_ROWS = 16_384
BLOCK_QUERIES = 8_192
LEAF = 256
FACTOR = 2.0
_SLACK = 1e-9  # of scores that rounding may part, in either order of summation


def usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Node:
    """The rows start to end of the tree's order; inside: distances to the vantage point up to the median."""

    start: int
    end: int
    vantage: int = -1
    low: tuple[float, float] = (0.0, 0.0)  # smallest and largest distance of the inner child
    high: tuple[float, float] = (0.0, 0.0)  # and of the outer
    inner: int = -1
    outer: int = -1


class Tree:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, seed: int = 1):
        squares = (vectors * vectors).sum(1)
        self.top = float(squares.max())
        points = np.column_stack([vectors, np.sqrt(np.maximum(self.top - squares, 0))])
        order, rng, self.nodes = np.arange(len(ids)), np.random.default_rng(seed), [Node(0, len(ids))]
        vantages, todo = [], [0]
        while todo:
            node = self.nodes[todo.pop()]
            n = node.end - node.start
            if n <= leaf:
                continue
            own = order[node.start : node.end]
            far = points[own[rng.integers(n)]]
            v = points[own[((points[own] - far) ** 2).sum(1).argmax()]]  # a point at the rim
            d = np.sqrt(((points[own] - v) ** 2).sum(1))
            half = n // 2
            part = np.argpartition(d, half)  # by place: equal distances are split too
            order[node.start : node.end], d = own[part], d[part]
            node.vantage = len(vantages)
            vantages.append(v)
            node.low, node.high = (d[:half].min(), d[:half].max()), (d[half:].min(), d[half:].max())
            node.inner, node.outer = len(self.nodes), len(self.nodes) + 1
            self.nodes += [Node(node.start, node.start + half), Node(node.start + half, node.end)]
            todo += [node.inner, node.outer]
        self.vantages = np.array(vantages).reshape(-1, points.shape[1])
        self.ids, self.vectors = ids[order], vectors[order]


class Search:
    """The k best of each query of a block, through one tree."""

    def __init__(self, tree: Tree, ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
        self.tree, self.ids, self.queries, self.k, self.factor = tree, ids, queries, k, factor
        n = len(ids)
        self.score, self.found = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        self.squares = (queries * queries).sum(1)
        # distances to all vantage points; the queries' added component is zero
        v = tree.vantages
        self.far = np.sqrt(np.maximum(self.squares[:, None] + (v * v).sum(1) - 2 * queries @ v[:, :-1].T, 0)) if len(v) else None

    def run(self) -> None:
        everyone = np.arange(len(self.ids))
        leaf_of = self._descend(everyone)
        done = leaf_of
        for leaf in np.unique(leaf_of).tolist():
            self._compare(leaf, everyone[leaf_of == leaf])
        todo = [(0, everyone)]
        while todo:
            at, active = todo.pop()
            node = self.tree.nodes[at]
            if node.vantage < 0:
                self._compare(at, active[done[active] != at])
                continue
            d, reach = self.far[active, node.vantage], self._reach(active)
            for child, (least, most) in ((node.outer, node.high), (node.inner, node.low)):
                bound = np.maximum(np.maximum(least - d, d - most), 0)
                stay = active[~(self.factor * bound > reach)]
                if len(stay):
                    todo.append((child, stay))

    def _reach(self, rows: np.ndarray) -> np.ndarray:
        """The distance within which a vector is among the k best, with a little slack."""
        kth = self.score[rows, -1]
        return np.sqrt(np.maximum(self.squares[rows] + self.tree.top - 2 * (kth - _SLACK), 0))

    def _descend(self, rows: np.ndarray) -> np.ndarray:
        at = np.zeros(len(rows), np.int64)
        todo = [0]
        while todo:
            k = todo.pop()
            node = self.tree.nodes[k]
            here = np.flatnonzero(at == k)
            if node.vantage < 0 or not len(here):
                continue
            inside = self.far[here, node.vantage] <= (node.low[1] + node.high[0]) / 2
            at[here] = np.where(inside, node.inner, node.outer)
            todo += [node.inner, node.outer]
        return at

    def _compare(self, leaf: int, rows: np.ndarray) -> None:
        node = self.tree.nodes[leaf]
        if not len(rows):
            return
        own = slice(node.start, node.end)
        near = self.queries[rows] @ self.tree.vectors[own].T >= (self.score[rows, -1] - _SLACK)[:, None]
        r, c = np.nonzero(near)
        r, c = rows[r], c + node.start
        other = self.tree.ids[c] != self.ids[r]
        r, c = r[other], c[other]
        if not len(r):
            return
        # summed from the first component to the last, whatever the leaf: equal vectors have equal scores
        score = np.cumsum(self.queries[r] * self.tree.vectors[c], axis=1)[:, -1]
        hit = np.unique(r)
        r = np.concatenate([r, np.repeat(hit, self.k)])
        score = np.concatenate([score, self.score[hit].ravel()])
        ids = np.concatenate([self.tree.ids[c], self.found[hit].ravel()])
        order = np.lexsort((ids, -score, r))
        r, score, ids = r[order], score[order], ids[order]
        first = np.r_[True, r[1:] != r[:-1]]
        place = np.arange(len(r)) - np.maximum.accumulate(np.where(first, np.arange(len(r)), 0))
        keep = place < self.k
        self.score[r[keep], place[keep]], self.found[r[keep], place[keep]] = score[keep], ids[keep]


def _matrix(t: pa.Table) -> np.ndarray:
    flat = t["vector"].combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(t.num_rows, -1)


def nearest(candidates: DataFrame, queries: DataFrame, k: int = 20, factor: float = FACTOR, id_col: str = "vec_id",
            vector_col: str = "embedding", shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """The ``k`` nearest of each query: query_id, rank (from 1), vec_id, score."""
    ship_package(candidates.sparkSession)

    def valid(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector")).where(
            F.col("id").isNotNull() & usable(F.col("vector"))).dropDuplicates()

    copies = Window.partitionBy("vector").orderBy("id")
    them = saved(valid(candidates).withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1).select(
        "id", "vector", F.size("vector").alias("dim")), "vectors")
    us = saved(valid(queries).withColumn("dim", F.size("vector")), "queries")
    shards = max(1, math.ceil(them.count() / shard_rows))
    blocks = max(1, math.ceil(us.count() / block_queries))
    part = lambda n, salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = us.select("id", "vector", "dim", part(blocks, 3).alias("block"), every(shards).alias("shard"))
    right = them.select("id", "vector", "dim", part(shards, 5).alias("shard"), every(blocks).alias("block"))

    def search(mine: pa.Table, theirs: pa.Table) -> pa.Table:
        empty = np.zeros(0, np.int64)
        got = (empty, empty, np.zeros(0))
        if mine.num_rows and theirs.num_rows:
            theirs = theirs.sort_by("id")  # a repeated task builds the same tree
            s = Search(Tree(theirs["id"].to_numpy(), _matrix(theirs)), mine["id"].to_numpy(), _matrix(mine), k, factor)
            s.run()
            r, c = np.nonzero(np.isfinite(s.score))
            got = (s.ids[r], s.found[r, c], s.score[r, c])
        return pa.table({"query_id": got[0], "vec_id": got[1], "score": got[2]})

    keys = ["dim", "shard", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Token-id files with minimal perfect hash indexes from document keys to places.

``write_ids`` stores the ids of all documents in ascending key order, in a folder
of four Parquet tables. ``shards/part=...`` (a part is what one task wrote, a range of keys) has a
row per shard: the raw little-endian ids of about a million ids' worth of documents one after another (16
bits each where the vocabulary allows), the ends of the documents, their keys, and
the shard's index: a minimal perfect hash function over its keys (hash and
displace: one seed for a few keys) and, in the slot of each key, a 32-bit
fingerprint, the number of its first document and how many follow under the same
key. ``index/bucket=...`` has one such function for each bucket of a hash of the keys; its slots hold
a fingerprint and the first and the last shard of the key. ``starts/block=...`` has the number of ids before each part,
``about`` the number of buckets.

So a lookup takes constant time, however many documents there are: it opens one file of the index and
one of shards for a key (more, if rows of an equal key run through several parts) by their paths, without listing folders,
and goes from seed to slot, fingerprint and slice in each.

Documents move once, in a range shuffle by key; Spark's committer writes the
tables, so a lost executor only repeats a task, and reading all documents back
moves no ids.

Defined cases: a null text is empty and holds the end id alone; a null key is the
smallest key; rows of equal key stand together, ordered by their texts' hashes (through
several shards if need be), and all come back; an empty table gives empty files; extra
columns are ignored. A fingerprint of a key that isn't there matches
with a probability of 2^-32.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tierkit.llm.common import saved, ship_package, whole_text
from tierkit.llm.tokens import crc32_of_ids, vocabulary_path, word_encoder
from tierkit.session import scratch_path

GROUP_KEYS = 4  # keys that share a seed
SHARD_IDS = 1 << 20  # ids of a shard, at least one document
RANGE_DOCS = 8_000  # documents of a task that writes
BUCKET_KEYS = 1 << 16  # keys of a bucket of the index over all shards
BLOCK_PARTS = 4096  # parts whose starts are in one file
NULL_KEY = -(1 << 63)
_SLOTS = np.dtype([("mark", "<u4"), ("first", "<u4"), ("rows", "<u4")])
_PLACES = np.dtype([("mark", "<u4"), ("part", "<u4"), ("shard", "<u4"), ("last_part", "<u4"), ("last", "<u4")])
# a shard's number in its part, the ids before it there, its ids
_SHARD = "shard int, before long, n long, keys array<long>, ends array<long>, seeds binary, slots binary, wide int, ids binary"
_INDEX = "seeds binary, slots binary"
_STARTS = "part int, start long"


def mix(keys: np.ndarray, seed) -> np.ndarray:
    """64-bit hashes of int64 keys (splitmix64 of the key and the seed)."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + (np.asarray(seed, np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


@dataclass
class PerfectHash:
    """A minimal perfect hash function over distinct keys: each group of keys has a seed of its own."""

    seeds: np.ndarray
    n: int

    @staticmethod
    def build(keys: np.ndarray) -> "PerfectHash":
        n = len(keys)
        groups = max(1, math.ceil(n / GROUP_KEYS))
        group = (mix(keys, 0) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        sizes = np.bincount(group, minlength=groups)
        ends = np.cumsum(sizes)
        taken, seeds = np.zeros(n, bool), np.zeros(groups, np.uint32)
        for g in np.argsort(-sizes, kind="stable").tolist():
            if not sizes[g]:
                break
            own, seed = keys[order[ends[g] - sizes[g] : ends[g]]], 1
            while True:  # many seeds at once: the last groups find the last free slots
                tried = np.arange(seed, seed + 64, dtype=np.uint64)
                slots = (mix(own[None, :], tried[:, None]) % np.uint64(n)).astype(np.int64)
                good = ~taken[slots].any(axis=1)
                if len(own) > 1:
                    good &= (np.diff(np.sort(slots, axis=1), axis=1) > 0).all(axis=1)
                if good.any():
                    k = int(good.argmax())
                    seeds[g], taken[slots[k]] = seed + k, True
                    break
                seed += 64
        return PerfectHash(seeds, n)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        if not self.n:
            return np.zeros(0, np.int64)
        seeds = self.seeds[(mix(keys, 0) % np.uint64(len(self.seeds))).astype(np.int64)]
        return (mix(keys, seeds) % np.uint64(self.n)).astype(np.int64)


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0xF1) >> np.uint64(32)).astype(np.uint32)


class Shard:
    """A shard's documents by key."""

    def __init__(self, ends, seeds: bytes, slots: bytes, wide: int, ids):
        self.ends, self.ids, self.wide = np.asarray(ends, np.int64), ids, wide
        self.slots = np.frombuffer(slots, _SLOTS)
        self.hashed = PerfectHash(np.frombuffer(seeds, "<u4"), len(self.slots))

    @staticmethod
    def index(keys: np.ndarray) -> tuple[bytes, bytes]:
        """Seeds and slots for the keys of documents in ascending order."""
        own, first, rows = np.unique(keys, return_index=True, return_counts=True)
        hashed = PerfectHash.build(own)
        slots, at = np.zeros(len(own), _SLOTS), hashed.slots(own)
        slots["mark"][at], slots["first"][at], slots["rows"][at] = fingerprints(own), first, rows
        return hashed.seeds.astype("<u4").tobytes(), slots.tobytes()

    def find(self, keys: np.ndarray) -> list[list[tuple[int, np.ndarray]]]:
        """For each key its documents: the number of ids before it in the shard, and its ids."""
        got = self.slots[self.hashed.slots(keys)]
        out = []
        for s, hit in zip(got, got["mark"] == fingerprints(keys), strict=True):
            docs = range(s["first"], s["first"] + s["rows"]) if hit else ()
            at = [(int(self.ends[d - 1]) if d else 0, int(self.ends[d])) for d in docs]
            out.append([(a, np.frombuffer(self.ids, f"<u{self.wide}", e - a, a * self.wide)) for a, e in at])
        return out


def _stored(spark: SparkSession, folder: str, name: str, schema: str, by: str, only=None) -> DataFrame:
    """A table of ``folder``, partitioned by ``by``; or what it has for the values ``only``, opened by their paths."""
    if only is not None and not only:
        return spark.createDataFrame([], f"{schema}, {by} int")
    paths = [f"{folder}/{name}"] if only is None else [f"{folder}/{name}/{by}={v}" for v in sorted(only)]
    return spark.read.schema(f"{schema}, {by} int").option("basePath", f"{folder}/{name}").parquet(*paths)


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def write_ids(docs: DataFrame, folder: str, key: str = "doc_id", text: str = "text",
              path: str | None = None, end_id: int = 1) -> None:
    """Write the shards of ``docs``, the index of their keys and the starts of parts to ``folder``."""
    spark = docs.sparkSession
    ship_package(spark)
    path = path or vocabulary_path()
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(NULL_KEY)).alias("key"), whole_text(text).alias("text"))
    count = rows.count()
    tasks = max(1, math.ceil(count / RANGE_DOCS))

    def encode(batches):
        enc = word_encoder(path)
        end, wide = np.array([end_id], dtype=enc.dtype).tobytes(), enc.dtype.itemsize
        keys, sizes, parts, held, number, before = [], [], [], 0, 0, 0

        def shard():
            seeds, slots = Shard.index(np.array(keys, np.int64))
            longs = pa.list_(pa.int64())
            return pa.record_batch([pa.array([v], t) for v, t in (
                (number, pa.int32()), (before, pa.int64()), (held, pa.int64()), (keys, longs), (np.cumsum(sizes, dtype=np.int64).tolist(), longs),
                (seeds, pa.binary()), (slots, pa.binary()), (wide, pa.int32()), (b"".join(parts), pa.binary()))],
                names=["shard", "before", "n", "keys", "ends", "seeds", "slots", "wide", "ids"])

        for b in batches:
            for k, ids in zip(b.column(0).to_pylist(), enc.encode(b.column(1)), strict=True):
                keys.append(k)
                sizes.append(len(ids) // wide + 1)
                parts += [ids, end]
                held += sizes[-1]
                if held >= SHARD_IDS:
                    yield shard()
                    number, before = number + 1, before + held
                    keys, sizes, parts, held = [], [], [], 0
        if keys or not number:  # a part without documents has an empty shard, so that its path is there
            yield shard()

    # a key that many rows share is cut by the texts' hashes; the ranges' samples hold no texts
    dealt = rows.withColumn("tie", F.xxhash64("text")).repartitionByRange(tasks, "key", "tie")
    shards = dealt.sortWithinPartitions("key", "tie", "text").select("key", "text").mapInArrow(encode, _SHARD)
    # parts grow along the keys: a task writes one range of them, shard after shard
    shards.select(F.spark_partition_id().alias("part"), "*").write.option(
        "compression", "zstd").partitionBy("part").parquet(f"{folder}/shards")
    stored = _stored(spark, folder, "shards", _SHARD, "part")
    buckets = max(1, math.ceil(count / BUCKET_KEYS))
    _places_of(stored, buckets).write.partitionBy("bucket").parquet(f"{folder}/index")
    _starts_of(stored).write.partitionBy("block").parquet(f"{folder}/starts")
    spark.createDataFrame([(buckets,)], "buckets int").write.parquet(f"{folder}/about")


def _places_of(stored: DataFrame, buckets: int) -> DataFrame:
    """The index: for each bucket the perfect hash of its keys, and their slots."""
    at = stored.select(F.explode(F.array_distinct("keys")).alias("key"), F.struct("part", "shard").alias("at"))
    # a key whose rows fill many shards is one row here
    keys = at.groupBy("key").agg(F.min("at").alias("low"), F.max("at").alias("high")).select(
        _bucket(buckets).alias("bucket"), "key", "low.part", "low.shard", F.col("high.part").alias("last_part"), F.col("high.shard").alias("last"))
    none = [F.lit(None).cast("int").alias(n) for n in ("part", "shard", "last_part", "last")]
    every = stored.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"), F.lit(None).cast("long").alias("key"), *none)

    def build(group: pa.Table) -> pa.Table:
        own = group.filter(group["key"].is_valid())
        key = own["key"].to_numpy()
        hashed = PerfectHash.build(key)
        slots, place = np.zeros(len(key), _PLACES), hashed.slots(key)
        slots["mark"][place] = fingerprints(key)
        for name in _PLACES.names[1:]:
            slots[name][place] = own[name].to_numpy()
        return pa.table([group["bucket"].slice(0, 1), pa.array([hashed.seeds.astype("<u4").tobytes()], pa.binary()),
                         pa.array([slots.tobytes()], pa.binary())], names=["bucket", "seeds", "slots"])

    return keys.unionByName(every).groupBy("bucket").applyInArrow(build, f"bucket int, {_INDEX}")


def _starts_of(stored: DataFrame) -> DataFrame:
    """The number of ids before each part: running sums within blocks of parts, and over the blocks' sums."""
    n = F.sum("n").alias("n")
    parts = stored.groupBy("part").agg(n).withColumn("block", F.floor(F.col("part") / BLOCK_PARTS).cast("int"))
    before = lambda w: F.sum("n").over(w) - F.col("n")
    blocks = parts.groupBy("block").agg(n).select("block", before(Window.orderBy("block")).alias("first"))
    own = parts.select("block", "part", before(Window.partitionBy("block").orderBy("part")).alias("own"))
    return own.join(blocks, "block").select("block", "part", (F.col("first") + F.col("own")).alias("start"))


def _places(spark: SparkSession, folder: str, asked: DataFrame, few: bool) -> DataFrame:
    """Where the index has the keys ``asked``: key, and its first and last part and shard."""
    buckets = spark.read.schema("buckets int").parquet(f"{folder}/about").first()[0]
    asked = asked.withColumn("bucket", _bucket(buckets))
    only = [r[0] for r in asked.select("bucket").distinct().collect()] if few else None
    # keys that are asked for may be many more than there are: a bucket's are dealt to several groups
    chunks = 1 if few else max(1, math.ceil(asked.count() / (buckets * BUCKET_KEYS)))
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("key", F.lit(1)), F.lit(chunks)).cast("int"))
    index = _stored(spark, folder, "index", _INDEX, "bucket", only).withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def find(wanted: pa.Table, held: pa.Table) -> pa.Table:
        key, got = wanted["key"].to_numpy(), np.zeros(0, _PLACES)
        if held.num_rows and held["slots"][0].as_py():
            slots = np.frombuffer(held["slots"][0].as_py(), _PLACES)
            got = slots[PerfectHash(np.frombuffer(held["seeds"][0].as_py(), "<u4"), len(slots)).slots(key)]
            hit = got["mark"] == fingerprints(key)
            key, got = key[hit], got[hit]
        names = _PLACES.names[1:]
        return pa.table([pa.array(key[: len(got)]), *[pa.array(got[n].astype(np.int32)) for n in names]], names=["key", *names])

    return asked.groupBy("bucket", "chunk").cogroup(index.groupBy("bucket", "chunk")).applyInArrow(
        find, "key long, part int, shard int, last_part int, last int")


def _found(rows: DataFrame, digest: bool) -> DataFrame:
    """Documents of the keys in ``asked`` (an array) of each shard row, through its index."""
    def cut(batches):
        for b in batches:
            c = {n: b.column(n) for n in b.schema.names}
            for i in range(b.num_rows):
                asked, before = np.asarray(c["asked"][i].values, np.int64), c["before"][i].as_py()
                if not len(asked):
                    continue
                shard = Shard(c["ends"][i].values, c["seeds"][i].as_py(), c["slots"][i].as_py(),
                              c["wide"][i].as_py(), c["ids"][i].as_buffer())
                out = [(None if k == NULL_KEY else k, c["part"][i].as_py(), before + at, len(ids),
                        crc32_of_ids(ids) if digest else ids.astype("<u4").tobytes())
                       for k, docs in zip(asked.tolist(), shard.find(asked), strict=True) for at, ids in docs]
                cols = list(zip(*out, strict=True)) or [()] * 5
                yield pa.record_batch([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), *[pa.array(x, pa.int64()) for x in cols[2:4]],
                                       pa.array(cols[4], pa.int64() if digest else pa.binary())],
                                      names=["key", "part", "at", "n_tokens", "ids"])

    return rows.select("part", "before", "ends", "seeds", "slots", "wide", "ids", "asked").mapInArrow(
        cut, f"key long, part int, at long, n_tokens long, ids {'long' if digest else 'binary'}")


def read_ids(spark: SparkSession, folder: str, keys: DataFrame | list | None = None, digest: bool = False) -> DataFrame:
    """Stored documents: key, start (ids of all documents before it), n_tokens, and ``ids``, the raw
    32-bit ids or, with ``digest``, their unsigned crc32.

    Without ``keys`` all keys that the shards list are looked up, each in its shard. With it
    only those; keys that aren't there give no row. A list (a driver's: bounded) opens just the files that the index
    names; a table with a column ``key`` of any size is joined with the index, then with the parts that hold its keys.
    """
    ship_package(spark)
    if keys is None:
        rows = _stored(spark, folder, "shards", _SHARD, "part").withColumn("asked", F.array_distinct("keys"))
        return _numbered(_found(rows, digest), _stored(spark, folder, "starts", _STARTS, "block"))
    few = isinstance(keys, list)
    asked = spark.createDataFrame([(k,) for k in keys], "key long") if few else keys
    asked = asked.select(F.coalesce(F.col("key").cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()
    places = saved(_places(spark, folder, asked, few), "token-places")
    only = {p for r in places.select("part", "last_part").distinct().collect() for p in range(r.part, r.last_part + 1)} if few else None
    first, last = F.col("part") == F.col("one"), F.col("last_part") == F.col("one")
    spans = places.where("part >= 0").select("*", F.explode(F.sequence("part", "last_part")).alias("one")).select(
        F.col("one").alias("part"), F.struct("key", F.when(first, F.col("shard")).otherwise(0).alias("low"),
                                             F.when(last, F.col("last")).otherwise(F.lit((1 << 31) - 1)).alias("high")).alias("span"))
    lists = spans.groupBy("part").agg(F.collect_list("span").alias("spans"))  # at most the keys of a part
    here = F.filter("spans", lambda s: (s["low"] <= F.col("shard")) & (F.col("shard") <= s["high"]))
    rows = _stored(spark, folder, "shards", _SHARD, "part", only).join(lists, "part").withColumn("asked", F.transform(here, lambda s: s["key"]))
    blocks = None if only is None else {p // BLOCK_PARTS for p in only}
    return _numbered(_found(rows, digest), _stored(spark, folder, "starts", _STARTS, "block", blocks))


def _numbered(found: DataFrame, starts: DataFrame) -> DataFrame:
    return found.join(starts, "part").select("key", (F.col("start") + F.col("at")).alias("start"), "n_tokens", "ids")


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "token-index")

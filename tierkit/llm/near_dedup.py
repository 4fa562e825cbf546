"""Near duplicates: improved consistent weighted sampling over TF-IDF shingles, banded and verified.

Shingles are five words in a row (lower case, split at ASCII white space; a
shorter text with words is one shingle). A shingle weighs ``(1 + ln tf) * (1 + IDF_SHARE
* idf)``, where idf runs from 1 (at most ``FREQUENT`` of the documents have it) to 0 (all
have it), by the logarithm of its document frequency, so boilerplate counts less while
near copies of a large group, which make their own shingles frequent, stay close to each
other. Document frequencies are true counts over all documents: a count-min sketch of
fixed size rules out what can't be frequent, and the shingles that are left are counted
exactly in a second pass. At most ``MAX_FREQUENT`` shingles can be frequent, whatever the
table's size: where texts are so long that more could, the least count of a frequent one rises.

Consistent weighted sampling draws for each of ``BANDS * ROWS`` samples one
(shingle, level) pair such that two documents agree on a sample with a
probability equal to their weighted Jaccard similarity. Weights are rounded to
steps of ten percent for sampling, and the random numbers of a (shingle, sample)
are looked up by a hash of both in a table, so a sample costs one lookup per
shingle; of shingles with the same numbers the smallest hash wins, and a sample names the
shingle itself, so texts with more shingles than the table has places agree no oftener. Documents that agree on all samples of a band share a bucket: at a
similarity of 0.8, 99.96 % of pairs share one.

Equal texts are collapsed first. In each bucket all members are compared with its
most central one (whose buckets hold most texts), on their whole texts, by
weighted Jaccard similarity, or by the plain similarity of the shingle sets where
that is larger: in a large group of near copies the common shingles are frequent and weigh
less, so by weights alone some of its documents would stay outside. Then buckets that still hold several classes: those of up to
``SHARE`` members are compared whole. Larger ones that still hold several classes are finished
exactly by a prefix filter: each text is listed under its rarest shingles, so many that
two texts without a common one there can't reach the threshold, and all pairs of texts
of different classes that meet under a shingle and can reach it by what is left of them
there are compared. So no pair of a bucket is left out, and copies of one text
or class cost none. Classes are the connected components of the verified links.

Defined cases: null and empty texts (no words) are never duplicates and form a
class each; texts that are equal are one class whatever their doc_id; repeated
rows are in the same class, one of them stays; a null doc_id is a value of its own;
an empty table gives an empty result; extra columns pass through ``keep_one``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import fresh, saved, ship_package, whole_text
from tierkit.llm.components import components

WIDTH = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 5
SHARE = 16  # members of a bucket up to which all are compared with each other
SKETCH_ROWS, SKETCH_BITS = 2, 17  # cells: two to this power in each row
FREQUENT = 0.01  # of the documents: a shingle in fewer weighs as a rare one
MAX_FREQUENT = 1 << 20
IDF_SHARE = 0.1
STEP = 0.1  # of ln(weight) in sampling
_LEVELS = 40  # the last one is never reached: tf would have to be e to the 44th
_CELLS = 1 << 16  # of the table of random numbers
_P = np.uint64(0x9E3779B97F4A7C15)


_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True


def _stirred(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


class Shingles:
    """Shingle hashes of texts, by array operations on their bytes."""

    def __init__(self, width: int = WIDTH):
        self.width, self.powers = width, np.ones(1, np.uint64)

    def word_hashes(self, text: str) -> np.ndarray:
        """A 64-bit hash of each word: a polynomial in its bytes, mixed."""
        raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
        space = _SPACE[raw]
        first = ~space
        first[1:] &= space[:-1]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.zeros(0, np.uint64)
        place = np.arange(len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw)))) if not starts[0] else (
            np.concatenate([np.zeros(starts[0], np.int64), np.arange(starts[0], len(raw)) - np.repeat(
                starts, np.diff(np.append(starts, len(raw))))]))
        with np.errstate(over="ignore"):
            if place.max() >= len(self.powers):
                self.powers = np.cumprod(np.full(2 * int(place.max()) + 2, _P), dtype=np.uint64)
            value = (raw.astype(np.uint64) + np.uint64(1)) * self.powers[place]
            value[space] = 0
            return _stirred(np.add.reduceat(value, starts))

    def hashes(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingle hashes in ascending order and how often each occurs."""
        h = self.word_hashes(text)
        if not len(h):
            return h, np.zeros(0, np.int64)
        k = min(self.width, len(h))
        with np.errstate(over="ignore"):
            s = h[: len(h) - k + 1].copy()
            for j in range(1, k):
                s = s * _P + h[j : len(h) - k + 1 + j]
            return np.unique(_stirred(s), return_counts=True)


def _slices(batches, rows: int = 512):
    """Batches of at most ``rows`` rows: their texts are Python objects a few at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def _cell(hashes: np.ndarray, row: int = 0) -> np.ndarray:
    """The cells of hashes in a row of the sketch: rows take different bits."""
    shift = np.uint64(64 - SKETCH_BITS * (row + 1))
    return ((hashes >> shift) & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)


def sketch(texts: DataFrame) -> tuple[np.ndarray, int]:
    """How many (document, shingle) pairs fall into each cell, by row; and the documents with words."""
    size = SKETCH_ROWS << SKETCH_BITS

    def tally(batches):
        shingles, total, docs = Shingles(), np.zeros((SKETCH_ROWS, 1 << SKETCH_BITS), np.int64), 0
        for b in _slices(batches):
            found = [shingles.hashes(t)[0] for t in b.column(0).to_pylist()]
            docs += sum(1 for f in found if len(f))
            if found:
                every = np.concatenate(found)
                for row in range(SKETCH_ROWS):
                    total[row] += np.bincount(_cell(every, row), minlength=1 << SKETCH_BITS)
        total = total.ravel()
        at = np.flatnonzero(total)
        yield pa.record_batch([pa.array(np.append(at, size)), pa.array(np.append(total[at], docs))], names=["cell", "n"])

    summed = texts.select("text").mapInArrow(tally, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size + 1, np.int64)
    out[summed["cell"].to_numpy()] = summed["n"].to_numpy()
    return out[:-1].reshape(SKETCH_ROWS, -1), int(out[-1])


class Factors:
    """What a shingle's idf multiplies its weight by: known shingles by their document frequency, others as rare ones."""

    def __init__(self, hashes: np.ndarray, df: np.ndarray, docs: int, least: float):
        at = np.argsort(hashes)
        self.hashes, self.rare = hashes[at], np.float32(1 + IDF_SHARE)
        span = np.log(max(docs, 1) / least)
        idf = np.log(docs / df[at]) / span if span > 0 else np.ones(len(df))
        self.factors = (1 + IDF_SHARE * idf).astype(np.float32)

    def of(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(hashes), self.rare)
        if len(self.hashes):
            at = np.searchsorted(self.hashes, hashes).clip(max=len(self.hashes) - 1)
            known = self.hashes[at] == hashes
            out[known] = self.factors[at[known]]
        return out


def least_frequent(docs: int, pairs: int) -> float:
    """The least document frequency of a frequent shingle, in a table of so many documents with words and
    (document, shingle) pairs: at most ``MAX_FREQUENT`` shingles can have it."""
    return max(FREQUENT * docs, pairs / MAX_FREQUENT, 1.0)


def idf_factors(texts: DataFrame) -> Factors:
    """The factors of a table's shingles, by the true document frequencies of the frequent ones."""
    spark = texts.sparkSession
    cells, docs = sketch(texts)
    least = least_frequent(docs, int(cells[0].sum()))
    maybe = spark.sparkContext.broadcast(cells >= least)

    def count(batches):
        shingles, held, size = Shingles(), [], 0

        def total():
            u, at = np.unique(np.concatenate([h for h, _ in held]), return_inverse=True)
            return u, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def rows(u, n):
            return pa.record_batch([pa.array(u.view(np.int64)), pa.array(n)], names=["shingle", "n"])

        for b in _slices(batches):
            found = [shingles.hashes(t)[0] for t in b.column(0).to_pylist()]
            every = np.concatenate([np.zeros(0, np.uint64), *found])
            for row in range(SKETCH_ROWS):
                every = every[maybe.value[row][_cell(every, row)]]
            held.append((every, np.ones(len(every))))
            size += len(every)
            if size > 1 << 20:
                u, n = total()
                if len(u) > 1 << 19:  # too many to hold: the shuffle adds up the rest
                    yield rows(u, n)
                    u, n = u[:0], n[:0]
                held, size = [(u, n)], len(u)
        if held:
            yield rows(*total())

    counted = texts.select("text").mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    known = counted.where(F.col("n") >= F.lit(least)).toArrow()
    maybe.destroy()
    return Factors(known["shingle"].to_numpy().view(np.uint64), known["n"].to_numpy(), docs, least)


class Sampler:
    """Consistent weighted samples from a table of random numbers."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = 1):
        rng = np.random.default_rng(seed)
        u = rng.random((5, _CELLS)).clip(1e-12)
        r, c, beta = -np.log(u[0] * u[1]), -np.log(u[2] * u[3]), u[4]
        ln_w = (np.arange(_LEVELS) * STEP)[:, None]
        t = np.floor(ln_w / r + beta)
        self.ln_a = (np.log(c) - r * (t - beta) - r).astype(np.float32).ravel()
        self.t = t.astype(np.int64).ravel()
        self.bands, self.rows = bands, rows
        self.odd = rng.integers(1, 1 << 32, bands * rows, dtype=np.uint32) | np.uint32(1)
        self.band_odd = (rng.integers(1, 1 << 62, (bands, rows + 1), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)

    def band_keys(self, hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit key per band."""
        level = np.clip(np.rint(np.log(weights) / STEP), 0, _LEVELS - 1).astype(np.int64) * _CELLS
        best = np.full(len(self.odd), np.inf, np.float32)
        which = np.zeros(len(self.odd), np.int64)
        who = np.zeros(len(self.odd), np.uint64)
        rows = np.arange(len(self.odd))
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        with np.errstate(over="ignore"):
            for i in range(0, len(hashes), 2048):
                at = ((short[None, i : i + 2048] * self.odd[:, None]) >> np.uint32(16)).astype(np.int64)
                at += level[None, i : i + 2048]
                a = self.ln_a[at]
                k = a.argmin(axis=1)
                low = a[rows, k]
                less = low < best  # hashes ascend: of equals the smallest stays
                best = np.where(less, low, best)
                which = np.where(less, at[rows, k], which)
                who = np.where(less, hashes[i + k], who)
            sample = (who + self.t[which].astype(np.uint64) * _P).reshape(self.bands, self.rows)
            key = self.band_odd[:, -1].copy()
            for j in range(self.rows):
                key = (key ^ (sample[:, j] + np.uint64(1))) * self.band_odd[:, j]
                key ^= key >> np.uint64(32)
        return key.astype(np.int64)


def weighted(shingles: Shingles, idf: Factors, text: str) -> tuple[np.ndarray, np.ndarray]:
    h, tf = shingles.hashes(text)
    return h, (1 + np.log(np.maximum(tf, 1))) * idf.of(h)


def weighted_jaccard(a, b) -> float:
    (ha, wa), (hb, wb) = a, b
    _, i, j = np.intersect1d(ha, hb, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    both = np.minimum(wa[i], wb[j]).sum()
    return float(both / (wa.sum() + wb.sum() - both))


def similarity(a, b) -> float:
    """The weighted Jaccard similarity, or the plain one of the shingle sets where that is larger: weights
    must not part documents that share four fifths of their shingles, common as these may be."""
    both = len(np.intersect1d(a[0], b[0], assume_unique=True))
    plain = both / (len(a[0]) + len(b[0]) - both) if both else 0.0
    return max(plain, weighted_jaccard(a, b))


def _content(text) -> F.Column:
    return F.unhex(F.md5(text.cast("binary")))


def _signatures(rows: DataFrame, idf) -> DataFrame:
    """``rows`` (doc_id, text, content) with the text replaced by its band keys (none without words)."""
    def sign(batches):
        shingles, sampler = Shingles(), Sampler()
        for b in _slices(batches):
            keys = []
            for t in b.column(1).to_pylist():
                h, w = weighted(shingles, idf.value, t)
                keys.append(sampler.band_keys(h, w) if len(h) else np.zeros(0, np.int64))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int64), *keys])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                names=["doc_id", "content", "keys"])

    return rows.mapInArrow(sign, "doc_id long, content binary, keys array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """The pairs (a, b) whose similarity is ``threshold`` or more."""
    def compare(batches):
        shingles, last = Shingles(), {}

        def of(i: int, text: str):  # a leader's pairs follow each other
            if i not in last:
                if len(last) > 64:
                    last.clear()
                last[i] = weighted(shingles, idf.value, text)
            return last[i]

        for b in _slices(batches):
            ia, ib, ta, tb = (b.column(n).to_pylist() for n in ("a", "b", "text_a", "text_b"))
            keep = [similarity(of(x, t), weighted(shingles, idf.value, u)) >= threshold
                    for x, t, u in zip(ia, ta, tb, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a").filter(pa.array(keep)), b.column("b").filter(pa.array(keep))],
                                             names=["a", "b"])

    second = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = second.join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(compare, "a long, b long")


def _central():
    """The member of a group that shares most buckets' members, of equals the smallest id."""
    return F.max_by("id", F.struct("score", -F.col("id")))


def _first_candidates(shared: DataFrame) -> DataFrame:
    """Pairs (a, b; a < b) of every member (key, id, score) with its bucket's most central one: of near
    copies of one text, that text or the copy closest to it."""
    led = shared.groupBy("key").agg(_central().alias("lead"))
    pairs = shared.join(led, "key").where("id <> lead")
    return pairs.select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct()


def _mixed(placed: DataFrame) -> DataFrame:
    """The members (key, id, root) of buckets that hold several classes."""
    several = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    return placed.join(several.select("key"), "key").select("key", "id", "root")


def _candidates(placed: DataFrame) -> DataFrame:
    """All pairs (a, b; a < b) of different classes in the same bucket, from its members (key, id, root)."""
    mixed = _mixed(placed)
    other = mixed.select("key", F.col("id").alias("b"), F.col("root").alias("root_b"))
    pairs = mixed.join(other, "key").where("id < b and root <> root_b")
    return pairs.select(F.col("id").alias("a"), "b").distinct()


def listed_under(h: np.ndarray, w: np.ndarray, rarity: np.ndarray, threshold: float):
    """The rarest shingles of a text, without one of which in common no text is ``threshold`` similar to it; and
    the count and the weight of its shingles from each of them on."""
    at = np.lexsort((h, rarity[_cell(h)]))
    left = np.arange(len(h), 0, -1)
    heavy = np.cumsum(w[at][::-1])[::-1]
    # a text with fewer common shingles than this, or less common weight, is not similar
    n = max(int((left >= threshold * len(h) - 1e-6).sum()), int((heavy >= threshold * heavy[0] * (1 - 1e-6)).sum()))
    return h[at[:n]], left[:n], heavy[:n]


def _exact_candidates(placed: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """Pairs (a, b; a < b) of different classes among the members (key, id, root) of buckets that hold several:
    all that may be similar."""
    wanted = _mixed(placed).select("id", "root").distinct()
    rows = saved(wanted.join(texts, "id").select("text", "id", "root"), "open-texts")
    rarity = rows.sparkSession.sparkContext.broadcast(sketch(rows)[0][0])  # an order for all; its use is to meet seldom

    def index(batches):
        shingles = Shingles()
        for b in _slices(batches, 128):
            found, sums = [], []
            for t in b.column(0).to_pylist():
                h, w = weighted(shingles, idf.value, t)
                found.append(listed_under(h, w, rarity.value, threshold))
                sums.append((len(h), w.sum()))
            many = [len(f[0]) for f in found]
            far = lambda x: pa.array(np.repeat(np.asarray(x), many))
            yield pa.record_batch(
                [pa.array(np.concatenate([f[0] for f in found]).view(np.int64)), far(b.column(1).to_numpy()), far(b.column(2).to_numpy()),
                 far([x[0] for x in sums]), pa.array(np.concatenate([f[1] for f in found])),
                 far([x[1] for x in sums]), pa.array(np.concatenate([f[2] for f in found]))],
                names=["shingle", "id", "root", "n", "left", "w", "heavy"])

    listed = saved(rows.mapInArrow(index, "shingle long, id long, root long, n long, left long, w double, heavy double"), "listed")
    rarity.destroy()
    t = threshold / (1 + threshold) * (1 - 1e-6)  # of the sum of two sizes: the least common part
    may = (F.least("left", "left_b") >= t * (F.col("n") + F.col("n_b"))) | (
        F.least("heavy", "heavy_b") >= t * (F.col("w") + F.col("w_b")))
    sums = ("n", "left", "w", "heavy")
    # classes meet before their members do, by their best figures: members of one class are never paired
    held = listed.groupBy("shingle", "root").agg(*[(F.min if c in ("n", "w") else F.max)(c).alias(c) for c in sums])
    several = held.groupBy("shingle").agg(F.count("*").alias("classes")).where("classes > 1").select("shingle")
    met = saved(held.join(several, "shingle"), "met-classes")
    roots = met.join(met.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("root", *sums)]), "shingle").where(
        (F.col("root") < F.col("root_b")) & may).select("shingle", "root", "root_b")
    one = listed.join(several, "shingle")
    other = one.select("shingle", *[F.col(c).alias(f"{c}_b") for c in ("id", "root", *sums)])
    pairs = roots.join(one, ["shingle", "root"]).join(other, ["shingle", "root_b"]).where(may)
    return pairs.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b")).distinct()


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, content (md5 of the text), class_id (smallest doc_id of the
    class), stays (one row of each class; of repeated rows one), wordless."""
    spark = docs.sparkSession
    ship_package(spark)
    text = whole_text()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), _content(text).alias("content"))
    idf = spark.sparkContext.broadcast(idf_factors(rows))
    signed = saved(_signatures(rows, idf).select(F.monotonically_increasing_id().alias("row"), "*"), "signatures")
    # one row per distinct text, numbered; the number of a written row doesn't change
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    nodes = saved(signed.groupBy("content").agg(first, F.first("keys").alias("keys")).select(
        F.monotonically_increasing_id().alias("id"), "content", "first.doc_id", F.col("first.row").alias("first_row"), "keys"), "texts")
    buckets = nodes.select("id", F.explode("keys").alias("key"))
    sizes = buckets.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = buckets.join(sizes, "key")
    shared = saved(met.join(met.groupBy("id").agg(F.sum("n").alias("score")), "id").select("key", "id", "n", "score"), "buckets")
    wanted = nodes.join(shared.select("id").distinct(), "id").select("id", "content")
    one = rows.groupBy("content").agg(F.first("text").alias("text"))
    texts = saved(wanted.join(one, "content").select("id", "text"), "candidate-texts")

    tested = saved(_first_candidates(shared), "pairs")
    links = saved(_verified(tested, texts, idf, threshold), "links")
    labels = components(links)  # of the ids that have a link
    placed = shared.join(labels, "id", "left").withColumn("root", F.coalesce("root", "id"))
    pairs = _candidates(placed.where(F.col("n") <= SHARE)).unionByName(
        _exact_candidates(placed.where(F.col("n") > SHARE), texts, idf, threshold)).distinct()
    found = _verified(saved(pairs.join(tested, ["a", "b"], "left_anti"), "pairs"), texts, idf, threshold)
    labels = components(links.unionByName(saved(found, "links")))
    idf.destroy()
    labels = nodes.select("id").join(labels, "id", "left").select("id", F.coalesce("root", "id").alias("root"))
    wordless = F.size("keys") == 0
    members = nodes.join(labels, "id").select("content", "id", "doc_id", "first_row", "root", wordless.alias("wordless"))
    tops = members.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("id"))).alias("top")).select(
        "root", F.col("top.doc_id").alias("class_id"), F.col("top.id").alias("top_id"))
    known = members.join(tops, "root").select(
        "content", "class_id", "first_row", (F.col("id") == F.col("top_id")).alias("top"), "wordless")
    out = signed.select("row", "doc_id", "content").join(known, "content")
    return out.select(
        "doc_id", "content", F.when(F.col("wordless"), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        (F.col("wordless") | (F.col("top") & (F.col("row") == F.col("first_row")))).alias("stays"), "wordless")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without those whose class another row stands for."""
    content, key, other, alone = (fresh(docs, c) for c in ("near_content", "near_doc", "near_other", "near_alone"))
    stays = classes(docs, threshold).where("stays").select(
        F.col("doc_id").alias(key), F.col("content").alias(other), F.col("wordless").alias(alone)).distinct()
    kept = docs.withColumn(content, _content(whole_text())).join(
        stays, (F.col(content) == F.col(other)) & docs["doc_id"].cast("long").eqNullSafe(F.col(key)))
    # repeated rows stay once; texts without words are no duplicates of each other
    kept = kept.withColumn(alone, F.when(F.col(alone), F.monotonically_increasing_id()))
    return kept.dropDuplicates([key, other, alone]).select(*docs.columns)

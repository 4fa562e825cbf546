"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

A text is folded to lower-case letters with one blank between words; its 1- to 3-grams that hold a letter are hashed
into ``BUCKETS`` places.  A feature is (1 + ln count) * idf, the vector has length one.  Weights are trained by
follow-the-regularised-leader (per-coordinate steps, L1 and L2 penalties, so most weights are exactly zero) on the
softmax of all languages, then one temperature is fitted on labelled rows that the weights have not seen.

Document frequencies are counted over all labelled rows outside the held-out fold, each task adding up its own
before the shuffle.  Weights are fitted on a sample of those rows, a documented bound: ``FIT_ROWS`` are expected, as many of
each language as there are, drawn by a seeded random number (the same for the same table and partitions); a tenth of them
fits the temperature.  They are learned in one task, one row after another as the method asks, from a sorted stream.  The
model is one array of ``BUCKETS`` idf values and the weights that aren't zero, at most ``BUCKETS`` times the number of
languages, and is sent to the tasks.  Whole texts are read, at training and at prediction.

Defined cases: a text that is null or holds no letter (Unicode category L) is ``und`` with score 1; without a
labelled text that holds a letter, every text is ``und`` with score 0; languages are learned by name as given, a row with a
null ``doc_id`` or ``lang`` teaches nothing; ties go to the first language by name; repeated rows each count and
each get a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import saved, ship_package, whole_text

BUCKETS = 1 << 17
FIT_ROWS = 16_000
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.3, 0.01  # step, its damping, elastic net
SLICE_CHARS = 1 << 20  # of text that are folded at once; a longer text is a slice of its own
UNKNOWN = "und"
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_FOLD: list[np.ndarray] = []


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _fold_table() -> np.ndarray:
    """For each code point its own number if it is a letter, else 0; lower-case texts are looked up."""
    if not _FOLD:
        codes = np.arange(sys.maxunicode + 1, dtype=np.uint32)
        letter = np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, len(codes))
        _FOLD.append(np.where(letter, codes, np.uint32(0)))
    return _FOLD[0]


def _slices(texts: pa.Array):
    """(first, end) of runs of texts of some ``SLICE_CHARS`` characters."""
    first = size = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        if i > first and size + n > SLICE_CHARS:
            yield first, i
            first, size = i, 0
        size += n
    if len(texts) > first:
        yield first, len(texts)


def grams(texts: pa.Array):
    """For each text the places of its n-grams, one per occurrence; empty without a letter."""
    fold = _fold_table()
    for first, end in _slices(texts):
        part = [" " + t for t in pc.utf8_lower(texts.slice(first, end - first)).to_pylist()]
        ends = np.cumsum([len(t) for t in part])
        codes = fold[np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)]
        # runs of what is no letter become one blank; each text begins with one
        keep = codes != 0
        keep[1:] |= codes[:-1] != 0
        keep[np.concatenate([[0], ends[:-1]])] = True
        stops = np.concatenate([[0], np.cumsum(keep)])[ends].tolist()
        codes = codes[keep]
        one = codes * _MIX[0]
        two = (one[:-1] ^ (codes[1:] + np.uint32(1))) * _MIX[1]
        three = (two[:-1] ^ (codes[2:] + np.uint32(1))) * _MIX[2]
        shift = np.uint32(32 - BUCKETS.bit_length() + 1)
        one, two, three = (((x ^ (x >> np.uint32(15))) * _MIX[1]) >> shift for x in (one, two, three))
        letter = codes != 0
        start = 0
        for stop in stops:
            own = letter[start:stop]
            yield np.concatenate([one[start:stop][own], two[start : max(start, stop - 1)], three[start : max(start, stop - 2)]]) \
                if own.any() else np.zeros(0, np.uint32)
            start = stop


def corpus_counts(taught: DataFrame, most: int) -> tuple[np.ndarray, dict[str, int]]:
    """In how many texts each place occurs, and how many texts with a letter each language has (of ``most`` languages
    at most, the most frequent ones); each task adds up its own texts first."""
    def run(batches):
        df, langs = np.zeros(BUCKETS, np.int64), Counter()
        for b in batches:
            for g, lang in zip(grams(b.column(0)), b.column(1).to_pylist(), strict=True):
                if len(g):
                    seen = np.zeros(BUCKETS, bool)
                    seen[g] = True
                    df += seen
                    langs[lang] += 1
        at = np.flatnonzero(df)
        yield pa.record_batch([pa.array(at, pa.int64()), pa.nulls(len(at), pa.string()), pa.array(df[at], pa.int64())], names=["place", "lang", "n"])
        yield pa.record_batch([pa.nulls(len(langs), pa.int64()), pa.array(list(langs), pa.string()), pa.array(list(langs.values()), pa.int64())],
                              names=["place", "lang", "n"])

    found = saved(taught.select("text", "lang").mapInArrow(run, "place long, lang string, n long").groupBy("place", "lang").agg(
        F.sum("n").alias("n")), "lang-counts")
    rows, df = found.where("place is not null").select("place", "n").toArrow(), np.zeros(BUCKETS, np.int64)  # BUCKETS rows at most
    df[rows["place"].to_numpy()] = rows["n"].to_numpy()
    langs = found.where("place is null").orderBy(F.desc("n"), "lang").limit(most).collect()
    return df, {r.lang: r.n for r in langs}


def shares(counts: dict[str, int], rows: int) -> dict[str, float]:
    """The share of each language's rows to take, so that ``rows`` are expected: as many of each as there are."""
    left, out = rows, {}
    for i, (lang, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        take = min(n, left / (len(counts) - i))
        out[lang], left = take / n, left - take
    return out


def vector(g: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a text's feature vector, of length one."""
    count = np.bincount(g, minlength=BUCKETS)
    at = np.flatnonzero(count)
    v = (1 + np.log(count[at])) * idf[at]
    return at, v / (np.sqrt((v * v).sum()) or 1.0)


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


class Leader:
    """Follow the regularised leader: weights come from the sums of gradients when they are asked for."""

    def __init__(self, languages: int):
        self.z = np.zeros((BUCKETS + 1, languages))  # the last place is the bias, without penalties
        self.n = np.zeros((BUCKETS + 1, languages))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        free = (at == BUCKETS)[:, None]
        l1, l2 = np.where(free, 0.0, L1), np.where(free, 0.0, L2)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + l2))

    def learn(self, at: np.ndarray, v: np.ndarray, label: int) -> None:
        at, v = np.append(at, BUCKETS), np.append(v, 1.0)
        w = self.weights(at)
        wrong = _softmax(v @ w)
        wrong[label] -= 1
        g = v[:, None] * wrong
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits that makes the labels likeliest, by ternary search over its logarithm.

    Labels count as right in (n + 1) of (n + 2) cases, the rest is shared by the other languages: rows
    that are all predicted right are no proof of certainty.
    """
    n, k = logits.shape
    if k == 1:
        return 1.0
    target = np.full((n, k), 1 / (n + 2) / (k - 1))
    target[np.arange(n), labels] = (n + 1) / (n + 2)

    def loss(t: float) -> float:
        x = logits / math.exp(t)
        x = x - x.max(1, keepdims=True)
        return -(target * (x - np.log(np.exp(x).sum(1, keepdims=True)))).sum(1).mean()

    low, high = math.log(0.02), math.log(20.0)
    for _ in range(60):
        a, b = low + (high - low) / 3, high - (high - low) / 3
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


class Model:
    """Languages by name, idf of the places, weights (float32, the bias last) and the temperature."""

    def __init__(self, languages: list[str], idf: np.ndarray, weights: np.ndarray, heat: float):
        self.languages, self.idf, self.heat = languages, idf, heat
        self.at = np.flatnonzero(weights.any(1))  # sparse: rows without weights are left out
        self.rows = weights[self.at].astype(np.float32)

    def dense(self) -> np.ndarray:
        w = np.zeros((BUCKETS + 1, len(self.languages)), np.float32)
        w[self.at] = self.rows
        return w


def fit(docs: DataFrame, fit_rows: int = FIT_ROWS) -> Model | None:
    """Learn from text and lang of the rows outside the held-out fold; None where there is nothing to learn."""
    spark = docs.sparkSession
    ship_package(spark)
    taught = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))).select(
        whole_text().alias("text"), "lang")
    df, langs = corpus_counts(taught, fit_rows)
    if not langs:
        return None
    idf = np.where(df > 0, np.log((1 + sum(langs.values())) / (1 + df)) + 1, 0.0)
    names, share = sorted(langs), shares(langs, fit_rows)
    # at most fit_rows rows of this table; a language of a few rows is not asked to give some for the temperature
    wanted = spark.createDataFrame([(x, share[x], 0.1 if share[x] * langs[x] >= 20 else 0.0) for x in names],
                                   "lang string, share double, kept double")
    sample = taught.withColumn("r", F.rand(13)).join(F.broadcast(wanted), "lang").where(F.col("r") < F.col("share")).select(
        "lang", "text", (F.col("r") / F.col("share")).alias("r"), (F.rand(14) < F.col("kept")).alias("kept"))
    shared = spark.sparkContext.broadcast(idf)

    def vectors(batches):
        for b in batches:
            for i in range(0, b.num_rows, 256):
                part = b.slice(i, 256)
                found = [vector(g, shared.value) for g in grams(part.column(1))]
                yield pa.record_batch([part.column(0), part.column(2), part.column(3), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                                       pa.array([f[1] for f in found], pa.list_(pa.float32()))], names=["lang", "r", "kept", "at", "v"])

    def train(batches):
        number = {x: i for i, x in enumerate(names)}
        leader, logits, labels, spare, w = Leader(len(names)), [], [], [], None
        for b in batches:
            for i in range(b.num_rows):
                turn, label = b.column(0)[i].as_py(), number[b.column(1)[i].as_py()]
                at, v = b.column(3)[i].values.to_numpy(), b.column(4)[i].values.to_numpy()
                if not len(at):
                    continue
                if turn < EPOCHS:
                    leader.learn(at, v, label)
                    if turn == 0 and len(spare) < 200:
                        spare.append((at, v, label))
                    continue
                w = leader.weights(np.arange(BUCKETS + 1)) if w is None else w
                logits.append(v @ w[at] + w[BUCKETS])
                labels.append(label)
        w = leader.weights(np.arange(BUCKETS + 1)) if w is None else w
        if not labels:  # too few rows to keep some apart
            logits, labels = [v @ w[at] + w[BUCKETS] for at, v, _ in spare], [x for _, _, x in spare]
        at = np.flatnonzero(w.any(1))
        yield pa.record_batch([pa.array([at.tolist()], pa.list_(pa.int64())), pa.array([w[at].astype(np.float32).tobytes()], pa.binary()),
                               pa.array([temperature(np.stack(logits), np.array(labels))])], names=["at", "w", "heat"])

    # the sample in a fixed order, once per epoch and then its rows for the temperature, as one stream
    rows = saved(sample.mapInArrow(vectors, "lang string, r double, kept boolean, at array<int>, v array<float>"), "lang-sample")
    turns = F.when(F.col("kept"), F.array(F.lit(EPOCHS))).otherwise(F.array(*[F.lit(e) for e in range(EPOCHS)]))
    stream = rows.select(F.explode(turns).alias("turn"), "lang", "r", "at", "v").repartition(1).sortWithinPartitions("turn", "r", "lang")
    got = stream.select("turn", "lang", "r", "at", "v").mapInArrow(train, "at array<long>, w binary, heat double").first()
    shared.destroy()
    w = np.zeros((BUCKETS + 1, len(names)), np.float32)
    w[np.array(got.at, np.int64)] = np.frombuffer(got.w, np.float32).reshape(-1, len(names))
    return Model(names, idf, w, got.heat)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (calibrated probability of that language)."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        m = shared.value
        w = m.dense() if m else None
        for b in batches:
            names, scores = [], []
            for g in grams(b.column(2)):
                if not len(g) or m is None:
                    names.append(UNKNOWN)
                    scores.append(0.0 if len(g) else 1.0)
                    continue
                at, v = vector(g, m.idf)
                p = _softmax((v @ w[at] + w[BUCKETS]) / m.heat)
                k = int(p.argmax())
                names.append(m.languages[k])
                scores.append(float(p[k]))
            yield pa.record_batch([b.column(0), b.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, lang_pred string, score double")

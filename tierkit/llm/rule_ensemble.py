"""Sparse rule ensemble: tree paths as conjunctive rules, lasso logistic weights, compiled to columns.

A random forest of shallow trees is grown on text statistics against the quality
labels; every path from a root to a node becomes a conjunction of comparisons.
A logistic regression with an L1 penalty weighs the rules (most become zero),
and the remaining weighted rules are compiled into one Spark column expression,
so scoring is a projection without a shuffle or Python.

The fit takes at most ``FIT_ROWS`` labelled rows, those with the smallest hash of
their doc_id: a documented bound, so that its cost doesn't grow. Everything
else covers all rows. Inputs of a score are statistics of the text alone.

Defined cases: null and empty texts have zero statistics and get the score that
the rules give those; labels that are null or of unknown documents are left out;
repeated rows are scored each; without labels of both classes every score is
the share of label 1 (0.5 without labels); other columns pass through.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import fresh, saved

FIT_ROWS = 40_000


def _ratio(a: str, b: str):
    return lambda s: F.when(s(b) > 0, s(a) / s(b)).otherwise(0.0)


FEATURES = {
    "symbols": _ratio("n_symbols", "n_words"),
    "upper": lambda s: F.when(s("n_upper") + s("n_lower") > 0, s("n_upper") / (s("n_upper") + s("n_lower"))).otherwise(0.0),
    "echo": _ratio("n_echo", "n_words"),
    "repeats": _ratio("n_repeat_words", "n_words"),
    "marked": _ratio("n_marked", "n_distinct"),
    "duplicate_lines": _ratio("n_dup_lines", "n_lines"),
    "word_length": _ratio("word_chars", "n_words"),
    "digits": _ratio("n_digits", "word_chars"),
    "distinct": _ratio("n_distinct", "n_words"),
    "line_words": _ratio("n_words", "n_lines"),
    "stops": _ratio("n_stops", "n_words"),
    "bare": _ratio("n_bare", "n_words"),
    "words": lambda s: F.log1p(s("n_words").cast("double")),
}


@dataclass
class RuleModel:
    """Rules as tuples of (feature, comparison, threshold) with their weights, and the intercept."""

    intercept: float
    rules: list[tuple[tuple[tuple[str, str, float], ...], float]] = field(default_factory=list)

    def score(self, values: str) -> Column:
        """The probability of label 1, from an array of the features' values."""
        total = F.lit(self.intercept)
        for rule, weight in self.rules:
            total = total + F.when(_holds(rule, values), F.lit(weight)).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


_PLACE = {name: i for i, name in enumerate(FEATURES)}


def feature_values(stats: str) -> Column:
    """All features of a row in one array, so that rules compare values and don't spell features out again."""
    return F.array(*[f(lambda s: F.col(stats)[s]).cast("double") for f in FEATURES.values()])


def _holds(rule, values: str) -> Column:
    out = F.lit(True)
    for name, op, at in rule:
        v = F.col(values)[_PLACE[name]]
        out = out & ((v <= at) if op == "<=" else (v > at))
    return out


def tree_paths(shown: str, names: list[str]) -> set[tuple[tuple[str, str, float], ...]]:
    """All paths from roots to nodes in a forest as Spark ML shows it."""
    paths, path = set(), []
    for line in shown.splitlines():
        m = re.match(r"^(\s*)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if m:
            depth = (len(m[1]) - 4) // 1
            path = [x for x in path if x[0] < depth] + [(depth, (names[int(m[2])], m[3], float(m[4])))]
            tight: dict[tuple[str, str], float] = {}
            for _, (name, op, at) in path:  # of two bounds on one side the tighter one remains
                old = tight.get((name, op))
                tight[name, op] = at if old is None else (min(old, at) if op == "<=" else max(old, at))
            paths.add(tuple(sorted((n, op, at) for (n, op), at in tight.items())))
    return paths


def training_rows(docs: DataFrame, stats: str, labels: DataFrame, rows: int) -> DataFrame:
    """Labelled statistics outside the held-out fold, ``rows`` at most: those of the smallest hash."""
    y = labels.select(F.col("doc_id").alias("label_doc"), F.col("quality").cast("double").alias("label")).where(
        F.col("label").isNotNull() & ~held_out(F.col("label_doc")))
    known = y.count()
    if known > rows:  # the hash is even: a little more than the share, then exactly the first rows
        share = min(1.0, 1.2 * rows / known + 0.001)
        y = y.where(F.pmod(F.xxhash64("label_doc", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)))
    joined = docs.select(F.col("doc_id").alias("doc"), F.col(stats).alias("stats")).join(y, F.col("doc") == F.col("label_doc"))
    return joined.orderBy(F.xxhash64("label_doc", F.lit(11)), "label").limit(rows).select(
        feature_values("stats").alias("values"), "label")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, stats: str, labels: DataFrame, rows: int = FIT_ROWS, trees: int = 24, depth: int = 3,
        lasso: float = 0.002, seed: int = 5) -> RuleModel:
    from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    names = list(FEATURES)
    train = saved(training_rows(docs, stats, labels, rows), "quality-fit").coalesce(8)
    n, ones = train.agg(F.count("*"), F.sum("label")).first()
    if not n or not 0 < ones < n:
        share = min(max((ones or 0) / n, 0.001), 0.999) if n else 0.5
        return RuleModel(math.log(share / (1 - share)))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(
        train.select("label", array_to_vector("values").alias("features")))
    rules = sorted(tree_paths(forest.toDebugString, names))
    if not rules:
        return RuleModel(math.log(ones / (n - ones)))
    fired = saved(train.select("label", F.array(*[_holds(r, "values").cast("double") for r in rules]).alias("fired")), "quality-rules")
    lr = LogisticRegression(elasticNetParam=1.0, regParam=lasso, maxIter=60).fit(
        fired.coalesce(8).select("label", array_to_vector("fired").alias("features")))
    kept = [(r, float(w)) for r, w in zip(rules, lr.coefficients.toArray().tolist(), strict=True) if abs(w) > 1e-6]
    return RuleModel(float(lr.intercept), kept)


def scored(df: DataFrame, stats: str, model: RuleModel) -> tuple[DataFrame, str]:
    """``df`` with the probability of label 1 in one more column, and its name."""
    name, values = fresh(df, "quality_score"), fresh(df, "quality_values")
    return df.withColumn(values, feature_values(stats)).withColumn(name, model.score(values)).drop(values), name

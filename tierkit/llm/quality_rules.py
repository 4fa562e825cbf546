"""Weak supervision of quality rules: rules vote or abstain, and their accuracies are estimated.

A rule votes +1 (good), -1 (bad), -2 (very bad, if it knows that vote) or 0 (abstains) on a text's
statistic; each statistic has one rule, so no evidence counts twice. The
votes of all documents are counted by pattern (one aggregation with map-side
sums; there are at most 4^rules patterns, whatever the input), and
expectation-maximisation over those counts estimates how often each rule votes what on
good and on bad documents, and the share of good documents. The estimates are drawn to a
prior by as many votes of the prior as there are of the data: half of what the data say counts, at every size. A document's posterior probability of being good
replaces the requirement that all rules pass.

Defined cases: null and empty texts have no words: all rules abstain that divide
by a count of words, and the posterior is the estimated share of good documents;
repeated rows count as often as they occur; an empty table has no votes and keeps
the starting accuracies; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierkit.llm.common import fresh


@dataclass(frozen=True)
class Rule:
    """Votes bad where ``value`` is over ``bad``, very bad over ``worst``, good where it is ``good`` or less, else abstains.

    ``value`` takes a function that gives a statistic's column; a null value abstains.
    """

    name: str
    value: object
    good: float
    bad: float
    worst: float | None = None


# of the votes +1, -1 and -2: their shares before any document is seen, on good and on bad documents
PRIOR_GOOD, PRIOR_BAD = (0.98, 0.019, 0.001), (0.7, 0.2, 0.1)
PRIOR_STRENGTH = 1.0  # votes of the prior for each vote of the data


def _share(a: str, b: str):
    return lambda s: F.when(s(b) > 0, s(a) / s(b))


RULES = (
    Rule("symbols", _share("n_symbols", "n_words"), 0.02, 0.10),
    Rule("upper", lambda s: F.when(s("n_upper") + s("n_lower") > 0, s("n_upper") / (s("n_upper") + s("n_lower"))), 0.10, 0.25),
    Rule("echo", _share("n_echo", "n_words"), 0.02, 0.10, 0.40),
    Rule("repeats", _share("n_repeat_words", "n_words"), 0.10, 0.30),
    Rule("marked", _share("n_marked", "n_distinct"), 0.02, 0.10),
    Rule("bare", _share("n_bare", "n_words"), 0.02, 0.10),
    Rule("duplicate_lines", _share("n_dup_lines", "n_lines"), 0.10, 0.50),
    Rule("word_length", lambda s: F.when(s("n_words") > 0, F.abs(s("word_chars") / s("n_words") - 5.5)), 2.5, 6.0),
    Rule("digits", _share("n_digits", "word_chars"), 0.10, 0.30),
    Rule("longest", lambda s: F.when(s("n_words") > 0, s("n_longest").cast("double")), 60, 400),
)


def votes(stats: str, rules=RULES) -> list[Column]:
    get = lambda name: F.col(stats)[name]
    out = []
    for r in rules:
        v = r.value(get)
        bad = F.when(v > r.bad, -1) if r.worst is None else F.when(v > r.worst, -2).when(v > r.bad, -1)
        out.append(bad.when(v <= r.good, 1).otherwise(0).cast("int"))
    return out


@dataclass
class LabelModel:
    """What each rule votes (columns: +1, -1, -2) on good and on bad documents when it votes, and the share of good ones."""

    on_good: np.ndarray
    on_bad: np.ndarray
    good: float

    def weights(self) -> tuple[float, np.ndarray, np.ndarray]:
        """What the prior, a good vote and a bad vote add to the log-odds of being good."""
        ratio = np.log(self.on_good / self.on_bad)
        return float(np.log(self.good / (1 - self.good))), ratio[:, 0], ratio[:, 1]

    def worst_weights(self) -> np.ndarray:
        """What a very bad vote adds."""
        return np.log(self.on_good / self.on_bad)[:, 2]

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        base, plus, minus = self.weights()
        total = base + (patterns == 1) @ plus + (patterns == -1) @ minus + (patterns == -2) @ self.worst_weights()
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 300) -> LabelModel:
    """Expectation-maximisation over vote patterns and how many documents have them.

    Abstentions say nothing about quality. A rule is written to spare good documents and to catch one kind of bad
    ones: that is its prior, which weighs as much as its votes (and two votes more, for rules that nobody votes by).
    A bad vote never speaks for a document: where a rule casts it oftener on good documents, it says nothing.
    """
    rules = patterns.shape[1]
    of = lambda prior: np.tile(np.array(prior) / np.sum(prior), (rules, 1))
    first_good, first_bad = of(PRIOR_GOOD), of(PRIOR_BAD)
    m = LabelModel(first_good, first_bad, 0.85)
    if not counts.sum():
        return m
    cast = [(patterns == v).astype(float) for v in (1, -1, -2)]

    def shares(rows: np.ndarray, prior: np.ndarray) -> np.ndarray:
        seen = np.stack([rows @ c for c in cast], axis=1)
        votes = seen.sum(axis=1, keepdims=True)
        more = PRIOR_STRENGTH * votes + 2
        return (seen + prior * more) / (votes + more)

    for _ in range(rounds):
        p = m.posterior(patterns)
        on_good, on_bad = shares(p * counts, first_good), shares((1 - p) * counts, first_bad)
        on_bad[:, 1:] = np.maximum(on_bad[:, 1:], on_good[:, 1:])
        good = float((p @ counts + 1.7) / (counts.sum() + 2))
        moved = max(np.abs(on_good - m.on_good).max(), np.abs(on_bad - m.on_bad).max(), abs(good - m.good))
        m = LabelModel(on_good, on_bad, good)
        if moved < 1e-9:
            break
    return m


def vote_counts(df: DataFrame, stats: str, rules=RULES) -> tuple[np.ndarray, np.ndarray]:
    """The vote patterns that occur (4^rules at most) and how many rows have them."""
    names = [f"v{i}" for i in range(len(rules))]
    got = df.select(*[v.alias(n) for v, n in zip(votes(stats, rules), names, strict=True)]).groupBy(*names).count().collect()
    table = np.array([tuple(r) for r in got], np.int64).reshape(-1, len(rules) + 1)
    return table[:, :-1], table[:, -1]


def judge(df: DataFrame, stats: str, model: LabelModel, rules=RULES) -> tuple[DataFrame, str]:
    """``df`` with the posterior probability of being good in one more column, and its name."""
    base, plus, minus = model.weights()
    total = F.lit(base)
    for v, up, down, worst in zip(votes(stats, rules), plus.tolist(), minus.tolist(), model.worst_weights().tolist(), strict=True):
        total = total + F.when(v == 1, F.lit(up)).when(v == -1, F.lit(down)).when(v == -2, F.lit(worst)).otherwise(0.0)
    name = fresh(df, "good_posterior")
    return df.withColumn(name, 1 / (1 + F.exp(-total))), name


def base_failed(stats: str) -> Column:
    """Fewer than ten words, or over a fifth of the words in repeated windows."""
    s = F.col(stats)
    return (s["n_words"] < 10) | (100 * s["n_repeat_words"] > 20 * s["n_words"])

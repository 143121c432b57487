"""Quality rules as weak supervision.

Each rule votes good (1), bad (2) or abstains (0). How often each rule votes what
for good and for bad texts, and the share of good texts, are estimated without
labels by expectation-maximisation over the vote patterns of all documents (at most
3 to the number of rules, whatever the corpus). A document is kept when its
posterior probability of being good is at least one half.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import ship

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
WINDOW = 8

MEASURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_lines long, n_distinct long, n_upper long, n_letters long, n_shouts long"
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def repeated_words(words: Sequence[bytes], window: int = WINDOW) -> tuple[int, int]:
    """(words inside windows that occur twice or more, distinct words)."""
    numbers: dict[bytes, int] = {}
    ids = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    count = len(ids) - window + 1
    if count < 2:
        return 0, len(numbers)
    h, span = (ids.astype(np.uint64) + np.uint64(1)) * _MIX, 1
    while span < window:
        h = (h[:-span] * _MIX) ^ ((h[span:] >> np.uint64(29)) + h[span:])
        span *= 2
    ordered = np.sort(h)
    if not (ordered[1:] == ordered[:-1]).any():
        return 0, len(numbers)  # equal windows have equal hashes, so there are none
    exact, span = ids, 1
    while span < window:  # number the runs of 2, 4, 8 words exactly
        exact = np.unique(exact[:-span] * (len(ids) + 1) + exact[span:], return_inverse=True)[1]
        span *= 2
    starts = np.flatnonzero(np.bincount(exact)[exact] > 1)
    edge = np.zeros(len(ids) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + window, -1)
    return int((np.cumsum(edge[:-1]) > 0).sum()), len(numbers)


def measure(text: str | None) -> tuple[int, ...]:
    """The measures of one text, as named in ``MEASURES``."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    seen: set[bytes] = set()
    n_lines = n_dup = 0
    for line in raw.split(b"\n"):
        if line and not line.isspace():
            n_lines += 1
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
    n_repeat, n_distinct = repeated_words(words)
    codes = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    upper = int(codes[65:91].sum())
    letters = upper + int(codes[97:123].sum())
    return (
        len(words), len(text) - int(codes[[ord(c) for c in SPACES]].sum()), int(codes[[ord(c) for c in SYMBOLS]].sum()), n_dup, n_repeat,
        n_lines, n_distinct, upper, letters, int(codes[ord("!")]),
    )


def measures(docs: DataFrame, text_col: str = "text") -> Column:
    """A struct of the measures of each text; a null text has none of anything."""
    ship(docs.sparkSession)
    names = [m.split()[0] for m in MEASURES.split(", ")]

    @F.pandas_udf(MEASURES)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([measure(t) for t in texts], columns=names)

    return run(F.col(text_col))


def rules(m: Column) -> dict[str, Column]:
    """The vote of each rule on a struct of measures: 1 good, 2 bad, 0 abstains."""

    def share(part: str, whole: str) -> Column:
        return F.when(m[whole] > 0, m[part] / m[whole]).otherwise(F.lit(0.0))

    def votes(bad: Column, good: Column) -> Column:
        return F.when(bad, 2).when(good, 1).otherwise(0)

    symbols, repeats = share("n_symbols", "n_words"), share("n_repeat_words", "n_words")
    lines, shouts = share("n_dup_lines", "n_lines"), share("n_shouts", "n_words")
    upper, distinct, length = share("n_upper", "n_letters"), share("n_distinct", "n_words"), share("word_chars", "n_words")
    # one rule per kind of fault, as the model takes rules to err independently
    return {
        "length": votes(m["n_words"] < 20, m["n_words"] >= 60),
        "symbols": votes(symbols > 0.1, symbols < 0.02),
        "repetition": votes(
            (repeats > 0.3) | (lines > 0.5) | ((m["n_words"] >= 20) & (distinct < F.when(m["n_words"] < 200, 0.3).otherwise(0.1))),
            (repeats < 0.1) & (lines < 0.1),
        ),
        "shouting": votes((shouts > 0.2) | (upper > 0.4), (shouts < 0.02) & (upper < 0.15)),
        "word length": votes((length > 12) | (length < 2), (length >= 3) & (length <= 9)),
    }


@dataclass(frozen=True)
class Votes:
    """A fitted model: the share of good texts and, per rule, the odds of its votes."""

    prior: float
    vote_given: np.ndarray  # [class good/bad, rule, vote]

    @property
    def n_rules(self) -> int:
        return self.vote_given.shape[1]

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of good for rows of votes."""
        log = np.log([[self.prior], [1 - self.prior]])
        at = np.arange(self.n_rules)
        log = log + np.stack([np.log(self.vote_given[c][at, patterns]).sum(axis=1) for c in (0, 1)])
        return 1 / (1 + np.exp(np.clip(log[1] - log[0], -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Per rule, how often a vote that is cast is right."""
        right = self.prior * self.vote_given[0, :, 1] + (1 - self.prior) * self.vote_given[1, :, 2]
        cast = self.prior * self.vote_given[0, :, 1:].sum(axis=1) + (1 - self.prior) * self.vote_given[1, :, 1:].sum(axis=1)
        return right / cast


def all_patterns(n_rules: int) -> np.ndarray:
    codes = np.arange(3**n_rules)
    return np.stack([codes // 3**k % 3 for k in range(n_rules)], axis=1)


def expectation_maximisation(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, tolerance: float = 1e-9, false_alarms: float = 0.005
) -> Votes:
    """Fit to vote patterns and how many documents have each; starts from 'a bad vote means bad'.

    Bad texts are of several kinds, and without a bound the fit would take the
    most regular kind for its second class and the others for good. So a rule is
    held to blame at most the share ``false_alarms`` of good texts, and texts that
    no rule blames anchor the class of good ones.
    """
    n_rules = patterns.shape[1]
    blamed = (patterns == 2).any(axis=1)
    good = np.where(blamed, 0.05, 0.95)
    model, before = Votes(0.9, np.full((2, n_rules, 3), 1 / 3)), -np.inf
    for _ in range(rounds):
        given = np.empty((2, n_rules, 3))
        for c, weight in enumerate((good * counts, (1 - good) * counts)):
            for vote in range(3):
                given[c, :, vote] = (weight[:, None] * (patterns == vote)).sum(axis=0) + 0.5
        given /= given.sum(axis=2, keepdims=True)
        excess = np.maximum(given[0, :, 2] - false_alarms, 0)
        given[0, :, 2] -= excess
        given[0, :, :2] *= 1 + (excess / given[0, :, :2].sum(axis=1))[:, None]
        prior = ((good * counts).sum() + 1) / (counts.sum() + 2)
        model = Votes(float(prior), given)
        good = model.posterior(patterns)
        good = np.where(blamed, good, np.maximum(good, 0.95))
        level = float((good * counts).sum())
        if abs(level - before) <= tolerance * max(counts.sum(), 1):
            break
        before = level
    return model


def vote_code(m: Column) -> Column:
    code = F.lit(0)
    for k, vote in enumerate(rules(m).values()):
        code = code + vote * (3**k)
    return code


def fit(docs: DataFrame, text_col: str = "text") -> Votes:
    """Estimate the rules' accuracies over every document; an empty table gives the starting odds."""
    n_rules = len(rules(F.lit(None).cast("struct<" + MEASURES.replace(" ", ":").replace(",:", ",") + ">")))
    measured = docs.select(measures(docs, text_col).alias("m"))
    counted = measured.groupBy(vote_code(F.col("m")).alias("code")).count().collect()  # at most 3 ** rules rows
    patterns = all_patterns(n_rules)
    codes = np.array([r["code"] for r in counted], int)
    return expectation_maximisation(patterns[codes], np.array([r["count"] for r in counted], float))


def judge(docs: DataFrame, model: Votes | None = None, text_col: str = "text", column: str = "verdict") -> DataFrame:
    """``docs`` with a struct ``column``: the measures, base_failed, good (posterior) and kept.

    base_failed: fewer than 20 words, or more than 30 % of them in repeated
    windows; such a document is not kept. A null or empty text has no words and
    fails. Rows that repeat are judged alike. An existing column of the name is replaced.
    """
    model = model or fit(docs, text_col)
    m = F.col(f"__{column}")
    chance = F.from_json(F.lit("[" + ",".join(map(repr, model.posterior(all_patterns(model.n_rules)).tolist())) + "]"), "array<double>")
    failed = (m["n_words"] < 20) | (100 * m["n_repeat_words"] > 30 * m["n_words"])
    good = F.get(chance, vote_code(m))
    parts = [m[n.split()[0]].alias(n.split()[0]) for n in MEASURES.split(", ")]
    verdict = F.struct(*parts, failed.alias("base_failed"), good.alias("good"), (~failed & (good >= 0.5)).alias("kept"))
    return docs.withColumn(f"__{column}", measures(docs, text_col)).withColumn(column, verdict).drop(f"__{column}")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its measures, base_failed, kept and the posterior; other columns are left aside."""
    judged = judge(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), column="v")
    return judged.select("doc_id", *(f"v.{n}" for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "good")))

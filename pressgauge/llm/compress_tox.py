"""Toxicity by compression distance.

Two zstandard dictionaries are made from labelled texts. Both end in the same part,
which zstandard's trainer makes from ordinary windows; the toxic one also holds the
words that toxic texts repeat and ordinary ones lack, chosen by count and contrast
and not by the trainer, so the two differ only in what is toxic.
A text is cut into windows of a few words, each is compressed with either
dictionary, and the difference of the lengths says how much better the toxic one
fits. How often each difference occurs in ordinary windows and in toxic ones gives
a likelihood ratio for the whole text, and a logistic curve, fitted on labelled
texts that the dictionaries have not seen, turns it into a probability.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import ship

#: At most so many labelled texts of each class are learned from, chosen by a hash of their ids.
TOXIC_SAMPLE, ORDINARY_SAMPLE = 1500, 3000
WINDOW = 8
ORDINARY_BYTES, TOXIC_BYTES = 8192, 4096
#: A segment is toxic if so many toxic texts have it, or this share of them if that is fewer, and both it and its beginning are so many times rarer in ordinary ones.
LEAST_TEXTS, SUPPORT, CONTRAST = 8, 0.02, 30.0
BEGINNING = 4  # bytes of a word that the shortest match takes in
SPREAD = 0.05  # share of toxic windows that the mixture assumes in a toxic text
#: Written between words. With matches of ``LEAST_MATCH`` bytes and more, only the beginnings of words, or whole ones, match.
EDGE, LEAST_MATCH = b"\x01 ", 6
CALM = 12.0  # evidence is counted to this limit
REACH = 16  # differences are counted from -REACH to REACH


def windows(text: str, size: int = WINDOW) -> list[bytes]:
    words = text.encode().lower().split()
    return [EDGE + EDGE.join(words[at : at + size]) + EDGE for at in range(0, len(words), size)]


class _Lengths:
    """Compressed lengths of windows under a raw-content dictionary, behind a shared lead-in."""

    def __init__(self, content: bytes, lead: bytes):
        import zstandard as z

        settings = z.ZstdCompressionParameters(
            window_log=17, hash_log=16, chain_log=16, search_log=6, min_match=LEAST_MATCH, target_length=32,
            strategy=z.STRATEGY_LAZY2, write_content_size=0, write_checksum=0, write_dict_id=0,
        )
        held = z.ZstdCompressionDict(content, dict_type=z.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=settings)
        self.compress, self.lead = z.ZstdCompressor(dict_data=held, compression_params=settings).compress, lead

    def __call__(self, cut: list[bytes]) -> np.ndarray:
        # with the lead-in, which both dictionaries hold, every window's block is a compressed one
        return np.fromiter(map(len, map(self.compress, [self.lead + w for w in cut])), np.int64, len(cut))


@dataclass(frozen=True)
class Model:
    toxic: bytes
    ordinary: bytes
    ratio: np.ndarray  # log likelihood ratio of a window by its difference
    slope: float
    offset: float

    def score(self, text: str | None, lengths: tuple | None = None) -> float:
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, self.slope * evidence(self, text or "", lengths) + self.offset))))

    def lengths(self) -> tuple[_Lengths, _Lengths]:
        lead = self.ordinary[-48:]
        return _Lengths(self.ordinary, lead), _Lengths(self.toxic, lead)


def differences(text: str, lengths: tuple[_Lengths, _Lengths]) -> np.ndarray:
    """How many bytes shorter each window is under the toxic dictionary, as places from 0 to 2 * REACH."""
    cut = windows(text)
    return np.clip(lengths[0](cut) - lengths[1](cut), -REACH, REACH) + REACH if cut else np.zeros(0, np.int64)


def evidence(model: Model, text: str, lengths: tuple[_Lengths, _Lengths] | None = None) -> float:
    return min(float(model.ratio[differences(text, lengths or model.lengths())].sum()), CALM)


def _train_dictionary(size: int, samples: list[bytes]) -> bytes:
    import zstandard as z

    try:
        return z.train_dictionary(size, samples, k=8, d=8).as_bytes()[-size:]
    except z.ZstdError:  # too few samples to train on: they serve as they are
        return b"".join(samples)[-size:]


def _segments(text: str) -> set[bytes]:
    return {w.strip(b".,;:!?\"'()") for w in text.encode().lower().split()}


def look_alikes(typical: list[bytes], ordinary: list[str]) -> bytes:
    """Ordinary words that begin as toxic ones do, the most frequent last; both dictionaries hold them."""
    begin = {w[:BEGINNING] for w in typical}
    seen = Counter(w for t in ordinary for w in _segments(t) if w[:BEGINNING] in begin and len(w) > BEGINNING)
    chosen, size = [], 0
    for word, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0])):
        size += len(word) + len(EDGE)
        if size > ORDINARY_BYTES:
            break
        chosen.append(word)
    return b"".join(EDGE + w for w in reversed(chosen))


def toxic_segments(toxic: list[str], ordinary: list[str]) -> list[bytes]:
    """Words typical of toxic texts, the most telling first."""
    here, there, here_begun, there_begun = Counter(), Counter(), Counter(), Counter()
    for texts, whole, begun in ((toxic, here, here_begun), (ordinary, there, there_begun)):
        for text in texts:
            words = _segments(text)
            whole.update(words)
            begun.update({w[:BEGINNING] for w in words})
    found, odds = [], (len(ordinary) + 1) / (len(toxic) + 1)
    least, contrast = max(2, min(LEAST_TEXTS, SUPPORT * len(toxic))), min(CONTRAST, len(ordinary) / 4)
    for word, n in here.items():
        begin = word[:BEGINNING]
        rate = odds * min((n + 0.5) / (there[word] + 0.5), (here_begun[begin] + 0.5) / (there_begun[begin] + 0.5))
        if len(word) >= 3 and n >= least and rate > contrast:
            found.append((-n * math.log(rate), word))
    return [word for _, word in sorted(found)]


def _curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, held back a little."""
    scale = max(float(np.abs(x).max(initial=0)), 1.0)
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    beta, hold = np.zeros(2), np.array([1e-4, 1e-6]) * weight.sum()
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -50, 50)))
        step = np.linalg.solve((design * (weight * p * (1 - p))[:, None]).T @ design + np.diag(hold), design.T @ (weight * (y - p)) - hold * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1])


def _threshold(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The evidence at which calling texts toxic errs least, in the middle of its gap; the highest of equals."""
    order = np.argsort(x, kind="stable")
    x, y, weight = x[order], y[order], weight[order]
    # errors if all from place i on are called toxic: toxic ones before it, ordinary ones from it on
    errors = np.append(0, np.cumsum(weight * y)) + np.append(np.cumsum((weight * (1 - y))[::-1])[::-1], 0)
    ends = np.append(x[0] - 2, np.append((x[:-1] + x[1:]) / 2, x[-1] + 2))
    errors[1:-1][x[1:] <= x[:-1]] = np.inf  # no cut between equals
    best = np.flatnonzero(errors <= errors.min() + 1e-12)[-1]
    return float(max(ends[best], 1e-3))


def learn(toxic: list[str], ordinary: list[str], share: float) -> Model:
    """Fit to sampled texts; ``share`` is the share of toxic labels among all. Either list may be empty."""
    parts = [(texts[: -(-len(texts) * 2 // 3)], texts[len(texts) * 2 // 3 :]) for texts in (toxic, ordinary)]
    (seen_toxic, new_toxic), (seen_ordinary, new_ordinary) = parts
    samples = [w for t in seen_ordinary for w in windows(t)]
    typical = toxic_segments(seen_toxic, seen_ordinary)
    trained = _train_dictionary(ORDINARY_BYTES, samples[:: max(1, len(samples) // 40_000)])
    base, extra = look_alikes(typical, seen_ordinary) + EDGE + trained, b""
    for word in typical:
        if len(extra) + len(word) + len(EDGE) > TOXIC_BYTES:
            break
        extra = EDGE + word + extra
    model = Model(extra + base, base, np.zeros(2 * REACH + 1), 0.0, 0.0)
    lengths = model.lengths()
    met = [[differences(t, lengths) for t in texts] for texts in (new_toxic, new_ordinary)]
    hist = [np.bincount(np.concatenate([*rows, np.zeros(0, np.int64)]), minlength=2 * REACH + 1).astype(float) for rows in met]
    plain = (hist[1] + 0.02) / (hist[1] + 0.02).sum()
    mixed = (hist[0] + 0.02) / (hist[0] + 0.02).sum()
    known = hist[1] >= 20
    common = float((mixed[known] / plain[known]).min()) if known.any() else 1.0
    only = np.maximum(mixed - min(common, 1.0) * plain, 0)
    if only.sum() <= 0 or not new_toxic or not new_ordinary:
        prior = min(max(share, 1e-6), 1 - 1e-6)
        return Model(model.toxic, base, model.ratio, 0.0, math.log(prior / (1 - prior)))
    ratio = np.log(1 - SPREAD + SPREAD * only / only.sum() / plain)
    x = np.array([min(float(ratio[d].sum()), CALM) for rows in met for d in rows])
    y = np.repeat([1.0, 0.0], [len(met[0]), len(met[1])])
    weight = np.where(y == 1, share / len(met[0]), (1 - share) / len(met[1])) * len(y)
    slope, _ = _curve(x, y, weight)
    return Model(model.toxic, base, ratio, slope, -slope * _threshold(x, y, weight))


def learned_from(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether a document's label may be learned: the checksum of its id, as text, does not leave ``fold``."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds != fold


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from a sample of the labelled documents; labels of other documents and null labels are left out.

    A document labelled more than once counts as toxic if any label says so.
    """
    known = (
        labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learned_from(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    texts = []
    for label, most in ((1, TOXIC_SAMPLE), (0, ORDINARY_SAMPLE)):
        chosen = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")
        rows = (
            docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
            .where(F.col("text").isNotNull()).select(F.xxhash64("doc_id").alias("h"), "doc_id", "text").collect()
        )
        texts.append([r["text"] for r in sorted(rows, key=lambda r: (r["h"], r["doc_id"], r["text"]))])
    return learn(texts[0], texts[1], sizes.get(1, 0) / max(1, sum(sizes.values())))


def toxicity(docs: DataFrame, model: Model, text_col: str = "text") -> Column:
    """Probability that each text is toxic; a null or empty text has no evidence and gets the curve's offset alone."""
    ship(docs.sparkSession)

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        lengths = model.lengths()
        return pd.Series([model.score(t, lengths) for t in texts], dtype="float64")

    return run(F.col(text_col))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score and predicted for every row; repeated rows score alike, other columns are left aside."""
    model = fit(docs, labels, id_col, text_col)
    scored = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn("score", toxicity(docs, model))
    return scored.select("doc_id", (~learned_from(F.col("doc_id"))).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))

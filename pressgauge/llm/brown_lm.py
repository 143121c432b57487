"""Brown class-based n-grams: exchange clustering, then class transitions and word emissions.

Words are counted over all training texts. The most frequent ``heads`` words are
units of their own; every other word belongs to the unit of its ending, so each
word, seen or not, has a unit, and the table of neighbouring units is bounded by
the number of units and not by the corpus. Exchange clustering moves units between
classes: each sweep gathers, over all training texts, how often every unit stands
before and after every class, then moves unit by unit to the class that most
raises the likelihood of the class bigrams.

P(word | previous) = P(class | previous class) * P(word | class). Transitions are
interpolated with the classes' shares. Within a class, unseen words together get
the share of words seen once, as one event.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressgauge.llm.common import map_batches, stored

HEADS, ENDINGS, CLASSES, SWEEPS = 4096, 256, 64, 6
#: Words whose counts each task holds; the counts of all others are joined.
FREQUENT = 1 << 17
TAIL = 3  # bytes of an ending
END_UNIT = 0  # a unit and a class of its own: the end of a text
_FLUSH = 400_000


def words_of(raw: bytes) -> list[bytes]:
    """Lower-case A-Z, split at spaces and control white space."""
    return raw.lower().split()


def _rest(columns: list[pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def count_words(texts: DataFrame) -> DataFrame:
    """word (binary), n over a table with one binary column ``raw``, for the whole table."""
    schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for raw in batch.column(0):
                held.update(words_of(raw.as_py()))
                if len(held) > _FLUSH:
                    yield _rest([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], schema)
                    held.clear()
        if held:
            yield _rest([pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], schema)

    return map_batches(texts, run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` words, from frequent to rare: all whose count reaches a cut that depends on counts alone."""
    grade = F.floor(F.log2("n") * 16)  # a few hundred grades, whatever the corpus
    sizes = sorted(((r["grade"], r["count"]) for r in counts.groupBy(grade.alias("grade")).count().collect()), reverse=True)
    total, cut = 0, None
    for at, size in sizes:
        total += size
        if total > most:
            break
        cut = at
    if cut is None:
        return []
    found = counts.where(grade >= cut).collect()
    return sorted(((bytes(r["word"]), r["n"]) for r in found), key=lambda x: (-x[1], x[0]))


def unit_of_ending(word: bytes, heads: int, endings: int) -> int:
    return 1 + heads + zlib.crc32(word[-TAIL:]) % endings


def count_pairs(texts: DataFrame, head: list[bytes], endings: int) -> DataFrame:
    """a, b, n: how often unit a stands right before unit b, texts beginning and ending with the end unit."""
    index = texts.sparkSession.sparkContext.broadcast({w: i + 1 for i, w in enumerate(head)})
    heads, schema = len(head), pa.schema([("a", pa.int32()), ("b", pa.int32()), ("n", pa.int64())])
    span = 1 + heads + endings

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, size = _units(index.value, endings), [], 0

        def flush() -> pa.RecordBatch:
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            return _rest([pa.array((codes // span).astype(np.int32)), pa.array((codes % span).astype(np.int32)), pa.array(n.astype(np.int64))], schema)

        for batch in batches:
            for raw in batch.column(0):
                ids = np.array([END_UNIT, *unit(words_of(raw.as_py())), END_UNIT], np.int64)
                held.append(ids[:-1] * span + ids[1:])
                size += len(ids)
                if size > 4_000_000:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    return map_batches(texts, run, "a int, b int, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))


def _units(head: dict[bytes, int], endings: int):
    """A function from words to units that remembers rare words it has met, up to a bound."""
    met: dict[bytes, int] = {}
    heads = len(head)

    def unit(words: list[bytes]) -> list[int]:
        found = []
        for w in words:
            u = head.get(w) or met.get(w)
            if u is None:
                if len(met) >= _FLUSH:
                    met.clear()
                u = met[w] = unit_of_ending(w, heads, endings)
            found.append(u)
        return found

    return unit


def _context(pairs: DataFrame, of: np.ndarray, n_classes: int) -> tuple[np.ndarray, np.ndarray]:
    """(after, before)[unit, class]: counts of the class right after, and right before, each unit."""
    classes = F.from_json(F.lit(str(of.tolist())), "array<int>")
    out = []
    for own, other in (("a", "b"), ("b", "a")):
        rows = pairs.groupBy(F.col(own).alias("u"), F.get(classes, F.col(other)).alias("c")).agg(F.sum("n").alias("n")).toPandas()
        table = np.zeros((len(of), n_classes))
        table[rows["u"], rows["c"]] = rows["n"]
        out.append(table)
    return out[0], out[1]


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def sweep(of: np.ndarray, after: np.ndarray, before: np.ndarray, n_classes: int) -> int:
    """Move each unit once to its best class, in place; returns how many moved.

    The likelihood of the class bigrams is sum N(c,d) log N(c,d) - sum N(c) log N(c)
    over left classes - the same over right ones. Class counts follow every move;
    the units' contexts are those at the start of the sweep. The end unit stays.
    """
    table = np.zeros((n_classes, n_classes))
    np.add.at(table, of, after)
    weights = after.sum(axis=1) + before.sum(axis=1)
    moved = 0
    for u in np.argsort(-weights, kind="stable"):
        a = of[u]
        if u == END_UNIT or not weights[u]:
            continue
        right, left = after[u], before[u]
        table[a] -= right
        table[:, a] -= left
        np.maximum(table, 0, out=table)
        rows, columns = table.sum(axis=1), table.sum(axis=0)
        gain = (_xlogx(table + right) - _xlogx(table)).sum(axis=1) + (_xlogx(table + left[:, None]) - _xlogx(table)).sum(axis=0)
        gain -= _xlogx(rows + right.sum()) - _xlogx(rows) + _xlogx(columns + left.sum()) - _xlogx(columns)
        gain[of[END_UNIT]] = -np.inf
        b = int(np.argmax(gain))
        b = b if gain[b] > gain[a] + 1e-9 else a
        table[b] += right
        table[:, b] += left
        of[u] = b
        moved += b != a
    return moved


def cluster(pairs: DataFrame, n_units: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each unit; class 0 is the end's alone. Starts with the most frequent units in classes of their own."""
    of = np.minimum(np.arange(n_units), classes - 1)
    for _ in range(sweeps):
        after, before = _context(pairs, of, classes)
        if sweep(of, after, before, classes) == 0:
            break
    return of


@dataclass(frozen=True)
class Model:
    """All that scoring needs but the counts of words outside ``frequent``."""

    frequent: dict[bytes, int]  # word -> place in ``counts``
    counts: np.ndarray
    heads: int
    endings: int
    class_of: np.ndarray  # unit -> class
    transition: np.ndarray  # log10, [class, next class]
    known: np.ndarray  # log10 weight of a known word's count, by class
    unseen: np.ndarray  # log10 of an unseen word, by class
    tokens: int
    types: int
    end_count: int

    @property
    def base_total(self) -> float:
        return self.tokens + 0.5 * (self.types + 1)


def train(texts: DataFrame, heads: int = HEADS, endings: int = ENDINGS, classes: int = CLASSES, sweeps: int = SWEEPS, frequent: int = FREQUENT):
    """(model, counts of all words) from a table with one binary column ``raw``; the table may be empty."""
    counts = stored(count_words(texts), "word-counts")
    n_docs = texts.count()
    most = frequent_words(counts, frequent)
    head = [w for w, _ in most[:heads]]
    pairs = stored(count_pairs(texts, head, endings), "unit-pairs")
    n_units = 1 + len(head) + endings
    of = cluster(pairs, n_units, classes, sweeps)

    place = texts.sparkSession.createDataFrame([(w, i + 1) for i, w in enumerate(head)], "word binary, unit int")
    ending = F.lit(1 + len(head)) + F.pmod(F.crc32(F.substring("word", -TAIL, TAIL)), F.lit(endings)).cast("int")
    by_unit = (
        counts.join(place, "word", "left").groupBy(F.coalesce("unit", ending).alias("unit"))
        .agg(F.sum("n").alias("n"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"), F.count("*").alias("types")).collect()
    )
    n, once = np.zeros(classes), np.zeros(classes)
    n[of[END_UNIT]] = n_docs
    for r in by_unit:
        n[of[r["unit"]]] += r["n"]
        once[of[r["unit"]]] += r["once"]
    unseen = (once + 0.5) / (n + 1.0)
    after, _ = _context(pairs, of, classes)
    table = np.zeros((classes, classes))
    np.add.at(table, of, after)
    share = (table.sum(axis=0) + 0.5) / (table.sum() + 0.5 * classes)
    kinds = (table > 0).sum(axis=1) + 1.0  # Witten-Bell: as many new successors as kinds seen
    transition = (table + kinds[:, None] * share) / (table.sum(axis=1) + kinds)[:, None]
    model = Model(
        {w: i for i, (w, _) in enumerate(most)}, np.array([c for _, c in most], float), len(head), endings, of,
        np.log10(transition), np.log10((1 - unseen) / np.maximum(n, 1)), np.log10(unseen),
        int(sum(r["n"] for r in by_unit)) + n_docs, sum(r["types"] for r in by_unit) + (n_docs > 0), n_docs,
    )
    return model, counts


PARTS = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, "
    "words array<binary>, times array<int>, classes array<int>"
)
_KINDS = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "array<binary>": pa.list_(pa.binary()), "array<int>": pa.list_(pa.int32())}


def _score_parts(docs: DataFrame, model: Model) -> DataFrame:
    """Per row all that is known without the rare words' counts, and its rare words with their class."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([(name, _KINDS[kind]) for name, kind in (x.split() for x in PARTS.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        get, n = m.frequent.get, len(m.counts)
        # places: the frequent words, the end, then one for each ending of a rare word
        unit = [i + 1 if i < m.heads else unit_of_ending(w, m.heads, m.endings) for w, i in m.frequent.items()]
        cls = m.class_of[np.array([*unit, END_UNIT, *range(1 + m.heads, 1 + m.heads + m.endings)])]
        log_base, emit = np.zeros(len(cls)), np.zeros(len(cls))
        log_base[: n + 1] = np.log10(np.append(m.counts, m.end_count) + 0.5) - math.log10(m.base_total)
        emit[:n] = np.log10(m.counts) + m.known[cls[:n]]
        rare_from, known_end = n + 1, m.end_count > 0
        for batch in batches:
            rows = []
            for row, doc_id, held_out, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rare: Counter[bytes] = Counter()
                places = []
                for w in words_of(raw):
                    p = get(w)
                    if p is None:
                        rare[w] += 1
                        p = rare_from + zlib.crc32(w[-TAIL:]) % m.endings
                    places.append(p)
                places.append(n)
                ids = np.array(places)
                c = cls[ids]
                score = m.transition[np.append(cls[n], c[:-1]), c].sum() + emit[ids].sum()
                rows.append((
                    row, doc_id, held_out, len(places), len(places) - 1 - sum(rare.values()) + known_end, float(log_base[ids].sum()), float(score),
                    list(rare), list(rare.values()), [int(cls[rare_from + zlib.crc32(w[-TAIL:]) % m.endings]) for w in rare],
                ))
            if rows:
                yield _rest([pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema)

    return map_batches(docs, run, PARTS)


def score(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """Score a table of row, doc_id, held_out and raw; one row for each."""
    parts = stored(_score_parts(docs, model), "score-parts")
    logs = lambda values: F.from_json(F.lit(str([float(v) for v in values])), "array<double>")
    times, at = F.col("w.times"), F.col("w.classes")
    seen = F.col("n").isNotNull()
    rare = (
        parts.select("row", F.explode(F.arrays_zip("words", "times", "classes")).alias("w")).join(counts, F.col("w.words") == F.col("word"), "left")
        .groupBy(F.col("row").alias("of"))
        .agg(
            F.sum(F.when(seen, times).otherwise(0)).alias("more"),
            F.sum(times * (F.log10(F.coalesce("n", F.lit(0)) + 0.5) - math.log10(model.base_total))).alias("rare_base"),
            F.sum(times * F.when(seen, F.log10("n") + F.get(logs(model.known), at)).otherwise(F.get(logs(model.unseen), at))).alias("rare_score"),
        )
    )
    zero = F.lit(0.0)
    return parts.drop("words", "times", "classes").join(rare, F.col("row") == F.col("of"), "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", zero)).alias("score"),
        F.pow(F.lit(10.0), -(F.col("score") + F.coalesce("rare_score", zero)) / F.col("n_tokens")).alias("perplexity"),
    )


def held_out(doc_id: Column, folds: int = 5, fold: int = 1) -> Column:
    """Whether the checksum of the id, as text, leaves ``fold``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Train on the texts that are not held out and score every text.

    A null text is empty and scores as its end alone; repeated rows count, and are
    scored, each for itself; an empty table gives no rows; other columns are left aside.
    """
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    model, counts = train(docs.where(~held_out(F.col(id_col))).select(raw.alias("raw")))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), raw.alias("raw")
    )
    return score(rows, model, counts)

"""Rings of citing domains, steps of credibility, and the cue index, against brute force."""

import random
import re

import pytest

from pressgauge.plans import citation, cues


def _edges(spark, pairs):
    return spark.createDataFrame(list(pairs), "source string, target string")


def _reach(pairs):
    nodes = {n for p in pairs for n in p}
    out = {n: {b for a, b in pairs if a == n} for n in nodes}
    for _ in nodes:
        for n in nodes:
            out[n] |= {c for b in list(out[n]) for c in out[b]}
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_rings_equal_mutual_reach(spark, seed):
    rng = random.Random(seed)
    pairs = {(f"d{rng.randrange(16):02d}", f"d{rng.randrange(16):02d}") for _ in range(24)} | {("x1", "x2"), ("x2", "x3"), ("x3", "x1"), ("x3", "y"), ("y", "z")}
    pairs = {(a, b) for a, b in pairs if a != b}
    reach = _reach(pairs)
    ring = {n: min(m for m in reach[n] if n in reach[m]) for n in reach if n in reach[n]}
    got = citation.citation_rings(_edges(spark, [*pairs, *pairs, ("d00", "d00")]))
    assert {(r.domain, r.ring, r.ring_size) for r in got.collect()} == {(n, min(r, n), sum(v == r for v in ring.values())) for n, r in ring.items()}
    assert ("x1", "x1", 3) in {tuple(r) for r in got.collect()}


def test_no_rings(spark):
    assert citation.citation_rings(_edges(spark, [("a", "b"), ("b", "c"), ("a", "c"), ("d", "d")])).count() == 0
    assert citation.citation_rings(_edges(spark, [])).count() == 0


def test_steps_along_citations(spark):
    edges = _edges(spark, [("top", "low"), ("low", "top"), ("mid", "low"), ("mid", "mid2"), ("none", "low"), ("top", "worst"), ("mid", "low")])
    tiers = {"top": "HIGH", "mid": "MIXED", "mid2": "MIXED", "low": "LOW", "worst": "DISPUTED", "none": None}
    dimension = spark.createDataFrame(list(tiers.items()), "domain string, mbfc_credibility string")
    rings = citation.citation_rings(edges)
    got = {(r.source, r.target, r.step, r.ring) for r in citation.credibility_steps(edges, dimension, rings).collect()}
    assert got == {("top", "low", 2, "low"), ("low", "top", -2, "low"), ("mid", "low", 1, None), ("top", "worst", 3, None)}


def test_cues_of_any_length(spark):
    patterns = [
        ("M1", 'Detection: "sources say", "It is widely  reported", and "“quoted” inside".'), ("M1", 'again "Sources say"'),
        ("M2", 'cue: "those who understand will never ask why" or “don’t ask”'), ("M3", "no cue"), ("M4", None), ("M5", '"..." "a"'),
    ]
    lexicon = cues.cue_lexicon(spark.createDataFrame(patterns, "pattern_id string, description string"))
    held = {(r.pattern_id, r.cue) for r in lexicon.collect()}
    assert {("M1", "sources say"), ("M1", "it is widely reported"), ("M2", "those who understand will never ask why"), ("M2", "don't ask"), ("M5", "a")} <= held
    assert not any(p in ("M3", "M4") for p, _ in held)
    texts = [
        (1, "Sources say SOURCES SAY, sources; say it is widely reported"), (2, "Those who understand will never ask why. Don't ask! those who understand will never ask"),
        (3, None), (4, ""), (5, "a A a"), (6, "say sources"), (7, "it is widely"), (8, "x " * 5000 + "sources say"),
    ]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    want = {}
    for key, text in texts:
        words = re.findall(r"[\w']+", (text or "").lower())
        for pattern, cue in held:
            c = cue.split(" ")
            n = sum(words[i : i + len(c)] == c for i in range(len(words)))
            if n:
                want[key, pattern] = want.get((key, pattern), 0) + n
        for pattern in {p for p, _ in held}:
            if (key, pattern) in want:
                want[key, pattern] = (want[key, pattern] if isinstance(want[key, pattern], int) else 0, len(words))
    got = {(r.doc_id, r.pattern_id): (r.hits, r.per_1000) for r in cues.cue_rates(docs, lexicon).collect()}
    assert got == {k: (n, round(n * 1000 / words, 6)) for k, (n, words) in want.items()}
    assert got[1, "M1"][0] == 4 and (6, "M1") not in got


def test_texts_are_cut_into_words_once(spark):
    """What is returned reads words that lie on disk: no branch of it cuts or ships whole texts again."""
    docs = spark.createDataFrame([(1, "to be or not to be, or so"), (2, None), (3, "be or not to"), (3, "so")], "doc_id long, text string")
    lexicon = spark.createDataFrame([("p", "or not to be"), ("p", "be"), ("q", "so")], "pattern_id string, cue string")
    rates = cues.cue_rates(docs, lexicon)
    assert "regexp_replace" not in rates._jdf.queryExecution().toString()
    got = sorted((r.doc_id, r.pattern_id, r.hits) for r in rates.collect())
    assert got == [(1, "p", 3), (1, "q", 1), (3, "p", 1), (3, "p", 1), (3, "q", 1), (3, "q", 1)]

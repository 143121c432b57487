"""Source divergence: against the definition, term by term, and the tree against the dense matrix."""

import re
from collections import Counter, defaultdict

import numpy as np

from pressgauge.llm import divergence
from pressgauge.llm.queries import REGISTRY

SF_DIR = "/root/testdata/sf0.001"


def share(count, n, v):
    return 1 + 1_000_000_000 * (count + 1) // (n + v)


def by_definition(rows, least=3, top=200):
    """rows: (lang, source, text)."""
    found, docs, counts, groups = [], defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: [share(counts[lang, s][t], total[s], len(kept)) for t in kept] for s in sources}
        q = [share(sum(counts[lang, s][t] for s in sources), sum(total.values()), len(kept)) for t in kept]
        for s in sources:
            pairs = [(-sum((a - b) ** 2 // b for a, b in zip(p[s], p[o])), o) for o in sources if o != s]
            terms = [(-((a - b) ** 2 // b), t) for a, b, t in zip(p[s], q, kept) if counts[lang, s][t] and a > b]
            found += [(lang, s, "pair", o, -v, r) for r, (v, o) in enumerate(sorted(pairs), 1)]
            found += [(lang, s, "term", t, -v, r) for r, (v, t) in enumerate(sorted(terms), 1) if r <= top]
    return sorted(found)


def rows_of(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def test_equals_the_definition(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    want = by_definition([(r.lang, r.source, r.text) for r in docs.collect()])
    assert rows_of(REGISTRY["op11_quadtree_divergence"](spark, SF_DIR)) == want


def test_awkward_rows(spark, nothing):
    long = " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(30_000))
    rows = [
        ("en", "a", "the cat THE dog 1 2"), ("en", "a", "the cat"), ("en", "b", "the dog été été"), ("en", "b", "cat dog été"), ("en", "b", "cat dog été"),
        (None, "a", "the the the"), (None, None, "the"), ("", "", "the a"), ("xx", "only", "alone alone"), ("en", "empty", None), ("en", "", ""),
        ("de", "l", long), ("de", "l", long), ("de", "m", long + " zz"), ("de", "n", "12 34 !?"),
    ]
    made = spark.createDataFrame([(*r, 5, "x") for r in rows], "lang string, source string, text string, value long, term string").repartition(3)
    assert rows_of(divergence.audit(made)) == by_definition(rows)
    assert rows_of(divergence.audit(made, least_docs=1, top_terms=2)) == by_definition(rows, 1, 2)
    assert divergence.audit(nothing).count() == 0


def test_hot_source_and_small_stripes(spark, monkeypatch):
    """A third of the rows in one source, and many stripes per language, change nothing."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").selectExpr("lang", "if(doc_id % 3 = 0, 'hot', source) as source", "text")
    want = by_definition([tuple(r) for r in docs.collect()])
    monkeypatch.setattr(divergence, "STRIPE_CELLS", 300)
    monkeypatch.setattr(divergence, "HELD_TERMS", 200)
    assert rows_of(divergence.audit(docs)) == want


def test_tree_corrections_equal_the_dense_matrix():
    rng = np.random.default_rng(3)
    for rows, cols, cells in ((1, 1, 1), (5, 3, 9), (20, 700, 3000), (90, 130, 2500)):
        at = rng.choice(rows * cols, min(cells, rows * cols), replace=False)
        row, col = at // cols, at % cols
        zero = rng.integers(1, 1000, rows)
        p = rng.integers(1, 100_000, len(at))
        dense = np.zeros((rows, cols), np.int64)
        dense[row, col] = p
        want = {}
        for a in range(rows):
            for b in range(rows):
                both = (dense[a] > 0) & (dense[b] > 0)
                if both.any():
                    x, y = dense[a][both], dense[b][both]
                    g = divergence.gap
                    want[a, b] = int((g(x, y) - g(x, zero[b]) - g(zero[a], y) + g(zero[a], zero[b])).sum())
        a, b, total = divergence.joint_corrections(row, col, p, zero)
        assert dict(zip(zip(a.tolist(), b.tolist()), total.tolist())) == want


def test_zero_quadrants_have_no_node():
    tree = divergence.QuadTree(np.array([0, 70]), np.array([0, 4000]), np.array([5, 6]))
    assert [len(codes) for codes in tree.levels] == [2] * (len(tree.levels) - 1) + [1]

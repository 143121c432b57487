"""Operators 1, 3, 4, 5, 6, 8 and 9: against libraries and brute force, on awkward rows."""

import hashlib
import math
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from pressgauge.llm import bag_minhash, bitplane, brown_lm, compress_tox, main_text, piece_codec, quality_votes

from llm_rows import HOSTILE

SF_DIR = "/root/testdata/sf0.001"
PIECES, BYTES = (public_tokenizers.path(n) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json"))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def spaced(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def test_language_model(spark, hostile, nothing):
    rows = brown_lm.score_documents(hostile).collect()
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    seen = Counter(w for i, t in HOSTILE if not out(i) for w in [*spaced(t), None])
    n, v = sum(seen.values()), len(seen)

    def base(text):
        return sum(math.log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in [*spaced(text), None])

    expect = Counter((i, out(i), len(spaced(t)) + 1, sum(seen[w] > 0 for w in [*spaced(t), None]), n, round(base(t), 4)) for i, t in HOSTILE)
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in rows) == expect
    assert all(r.score < 0 for r in rows if r.n_tokens > 1)
    assert brown_lm.score_documents(nothing).count() == 0


def test_class_model_is_a_distribution_and_beats_the_base(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    raw = docs.where(~brown_lm.held_out(docs.doc_id)).selectExpr("cast(text as binary) as raw")
    model, counts = brown_lm.train(raw, heads=256, endings=16, classes=12, sweeps=4, frequent=2000)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    mass = 10**model.unseen
    for row in counts.collect():
        word = bytes(row["word"])
        place = model.frequent.get(word)
        unit = place + 1 if place is not None and place < model.heads else brown_lm.unit_of_ending(word, model.heads, model.endings)
        mass[model.class_of[unit]] += row["n"] * 10 ** model.known[model.class_of[unit]]
    used = {c for c in model.class_of[1:]}
    assert all(abs(mass[c] - 1) < 1e-6 or mass[c] < 1 for c in used) and sum(abs(mass[c] - 1) < 1e-6 for c in used) > 1
    scored = brown_lm.score_documents(docs).where("held_out").collect()
    assert sum(r.score for r in scored) > sum(r.base_score for r in scored)


def test_sweep_raises_the_likelihood():
    rng = np.random.default_rng(0)
    pairs = rng.poisson(np.where((np.arange(20)[:, None] + np.arange(20)) % 2, 9.0, 0.5)).astype(float)
    of = np.minimum(np.arange(20), 4)

    def likelihood(of):
        table = np.zeros((5, 5))
        np.add.at(table, (of[:, None], of[None, :]), pairs)
        return brown_lm._xlogx(table).sum() - brown_lm._xlogx(table.sum(0)).sum() - brown_lm._xlogx(table.sum(1)).sum()

    def contexts(of):
        member = np.eye(5)[of]
        return pairs @ member, pairs.T @ member

    levels = [likelihood(of)]
    for _ in range(4):
        brown_lm.sweep(of, *contexts(of), 5)
        levels.append(likelihood(of))
    assert levels[-1] > levels[0]


def test_pieces_equal_the_library(spark, hostile, nothing):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    rows = piece_codec.digests(hostile, PIECES).collect()
    expect = Counter()
    for i, t in HOSTILE:
        ids = library.encode(t or "", add_eos=True)
        expect[i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))] += 1
    assert Counter(tuple(r) for r in rows) == expect
    assert piece_codec.digests(nothing, PIECES).count() == 0
    back = piece_codec.decoded(piece_codec.encoded(hostile, PIECES), PIECES).select("text", "decoded").collect()
    assert all(r.decoded == (r.text or "").replace("▁", " ") for r in back)


def test_pieces_on_random_texts():
    import random

    import sentencepiece

    library, own, rng = sentencepiece.SentencePieceProcessor(model_file=PIECES), piece_codec.codec(PIECES), random.Random(4)
    parts = [*" ▁\n\tabé日☃😀́.,'0", "  ", "    ", "the ", " in", "</s>", "<0x0A>", "straße", "unglichkeit"]
    for _ in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        ids = own.encode(text)
        assert ids == library.encode(text, add_eos=True) and own.decode(ids).decode() == library.decode(ids), text
        odd = [rng.randrange(400) for _ in range(8)]
        assert own.decode(odd).decode() == library.decode(odd), odd


PAGE = """<!doctype html><html><head><title>T</title><script>var a="</p>";</script></head><body class="has-sidebar"><header><p>Site name</p></header>
<nav><a href=1>Home</a></nav><!-- x --><div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>First <b>bold</b>
para, long enough to count as text.<br>After a break<p>Second&#160;para &lt;kept&gt;, with <a href=2>one link</a>.<ul><li>item one<li>item two</ul>
<form><input>search</form></article><aside>More to read</aside><div id="comments"><p>Reader says hello to everyone here.</p></div><footer>(c)</footer>"""


def test_main_text():
    got = main_text.main_text(PAGE)
    assert got.split("\n") == [
        "Head & line", "First bold para, long enough to count as text.", "After a break", "Second para <kept>, with one link.", "item one", "item two",
    ]
    assert [main_text.main_text(x) for x in (None, "", "<p>", "only text", "<<> & &amp;")] == ["", "", "", "only text", "<<> & &"]
    assert len(main_text.main_text("<div>" * 3000 + "<p>deep text</p>" + "<a href='" * 50)) == 9


def test_main_text_query(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (2, None, None, "x"), (None, "v", "", "x"), (2, None, None, "x")], "page_id long, url string, html string, text string")
    rows = main_text.extract(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in rows) == [(0, "v", 0), (1, "u", len(main_text.main_text(PAGE))), (2, "", 0), (2, "", 0)]
    assert main_text.extract(pages.limit(0)).count() == 0


def test_quality(spark, hostile, nothing):
    rows = quality_votes.report(hostile).collect()
    expect = Counter()
    for i, t in HOSTILE:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        at = defaultdict(list)
        for k in range(len(w) - 7):
            at[tuple(w[k : k + 8])].append(k)
        repeated = len({p for v in at.values() if len(v) > 1 for k in v for p in range(k, k + 8)})
        expect[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), repeated, len(w) < 20 or 100 * repeated > 30 * len(w)] += 1
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows)
    assert got == expect
    assert not any(r.kept and r.base_failed for r in rows)
    assert quality_votes.report(nothing).count() == 0


def test_votes_recover_planted_accuracies():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.85
    votes = np.zeros((20_000, 4), int)
    for k, hit in enumerate((0.8, 0.6, 0.7, 0.5)):
        blame = np.where(good, rng.random(20_000) < 0.002, rng.random(20_000) < hit)
        votes[:, k] = np.where(blame, 2, np.where(rng.random(20_000) < 0.8, 1, 0))
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    model = quality_votes.expectation_maximisation(patterns, counts.astype(float))
    assert ((model.posterior(votes) >= 0.5) == good).mean() > 0.97
    assert np.allclose(model.vote_given[1, :, 2], (0.8, 0.6, 0.7, 0.5), atol=0.1)


def test_id_files(spark, hostile, nothing):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(BYTES)
    rows = bitplane.round_trip(spark, hostile, BYTES).orderBy("start").collect()
    assert [r.doc_id for r in rows] == sorted((i for i, _ in HOSTILE), key=lambda i: (i is not None, i or 0))
    start, expect = 0, Counter()
    for r in rows:
        assert r.start == start
        start += r.n_tokens
    for i, t in HOSTILE:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        expect[i, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expect
    assert bitplane.round_trip(spark, nothing, BYTES).count() == 0


@pytest.mark.parametrize("bits", [True, False])
def test_planes_round_trip(bits):
    rng = np.random.default_rng(3)
    for n in (0, 1, 9, 70_000):
        for high in (1, 2, 300, 50_257, 2**32 - 1):
            ids = rng.integers(0, high, n, dtype=np.uint32)
            assert (bitplane.unpack_block(n, *bitplane.pack_block(ids, bits)) == ids).all()


def test_signatures_are_unbiased():
    rng, bags, truth = np.random.default_rng(2), [], []
    for _ in range(200):
        element = rng.integers(0, 2**63, 60, dtype=np.uint64)
        a = rng.integers(0, 9, 60)
        b = np.where(rng.random(60) < rng.random(), a, rng.integers(0, 9, 60))
        truth.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
        bags += [(element[a > 0], a[a > 0]), (element[b > 0], b[b > 0])]
    s = bag_minhash.signatures(bags)
    error = (s[::2] == s[1::2]).mean(axis=1) - truth
    assert abs(error.mean()) < 0.01 and error.std() < 0.05


def classes_by_brute_force(rows):
    """Least id of each component of texts whose five-word multisets reach 0.8, as {text: id}."""
    least, bags = {}, {}
    for i, t in rows:
        t = t or ""
        w = spaced(t)
        bags[t] = Counter(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else Counter()
        least[t] = min((x for x in (least.get(t), i) if x is not None), default=None)
    texts, group = list(bags), {t: {t} for t in bags}
    for k, a in enumerate(texts):
        for b in texts[:k]:
            if bags[a] and (bags[a] & bags[b]).total() >= 0.8 * (bags[a] | bags[b]).total() and group[a] is not group[b]:
                group[a] |= group[b]
                for t in group[b]:
                    group[t] = group[a]
    return {t: min((least[x] for x in group[t] if least[x] is not None), default=None) for t in texts}


def test_near_duplicates(spark, hostile, nothing):
    rows = list(HOSTILE)
    base = [f"v{k}" for k in range(200)]
    for n in range(40):  # a chain of edits: neighbours are alike, its ends are not
        base = [f"x{n}_{k}" if k == 5 * n else w for k, w in enumerate(base)]
        rows.append((100 + n, " ".join(base)))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, id int").repartition(4)
    expect = classes_by_brute_force(rows)
    got = bag_minhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, expect[t or ""]) for i, t in rows)
    kept = bag_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter({(expect[t]) for t in expect if expect[t] is not None} | ({None} & set(expect.values())))
    assert bag_minhash.near_duplicates(nothing).count() == bag_minhash.keep_one(nothing).count() == 0


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, k) for k in range(101, 130)] + [(200, 201), (7, 7)]
    found = {r.id: r.part for r in bag_minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(61)} | {k: 100 for k in range(100, 130)} | {200: 200, 201: 200}


def test_toxicity(spark, hostile, nothing):
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(["an", "er", "ti", "on", "the", "ou", "re"], rng.integers(1, 4))) for _ in range(400)]
    texts = []
    for i in range(1200):
        w = [plain[k] for k in rng.integers(0, 400, rng.integers(30, 150))]
        if i % 4 == 0:
            for _ in range(4):
                w[rng.integers(0, len(w))] = str(rng.choice(["vilewretch", "grubscum", "dolthead"]))
        texts.append((i, " ".join(w)))
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, int(i % 4 == 0)) for i, _ in texts] + [(None, 0, 1), (5000, 0, None)], "doc_id long, quality int, toxic int")
    rows = compress_tox.score_documents(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    new = [r for r in rows if r.held_out]
    assert sum((r.predicted == 1) == (r.doc_id % 4 == 0) for r in new) >= 0.95 * len(new)
    turned = labels.withColumn("toxic", (1 - labels.toxic)).where(~compress_tox.learned_from(labels.doc_id)).unionByName(labels.where(compress_tox.learned_from(labels.doc_id)))
    assert {r.doc_id: r.score for r in compress_tox.score_documents(docs, turned).collect()} == {r.doc_id: r.score for r in rows}
    assert compress_tox.score_documents(hostile, labels).count() == len(HOSTILE)
    assert compress_tox.score_documents(hostile, labels.limit(0)).where("score is null").count() == 0
    assert compress_tox.score_documents(nothing, labels).count() == 0


def test_toxic_words_of_a_small_share_are_learned():
    rare = [f"{'vilewretch' if i % 2 else 'grubscum'} said {i}" for i in range(20)]
    toxic = rare + [f"dolthead here and there {i}" for i in range(1000)]
    found = compress_tox.toxic_segments(toxic, [f"said here and there {i}" for i in range(2000)])
    assert {b"vilewretch", b"grubscum", b"dolthead"} == set(found)


def test_words_that_begin_as_ordinary_ones_are_not_toxic():
    found = compress_tox.toxic_segments(["vilewretch weatherling"] * 300, ["the weather and the weathervane"] * 600)
    assert found == [b"vilewretch"]


def test_main_text_keeps_all_blocks_of_the_article():
    para = "A paragraph of the story that goes on for a good while and then some more. " * 4
    wrapped = f"<body><nav><a href=1>x</a></nav><article><h1>{'Head ' * 12}</h1><div>{f'<p>{para}</p>' * 10}</div></article>"
    assert main_text.main_text(wrapped).split("\n") == [("Head " * 12).strip(), *[para.strip()] * 10]
    short = "A short section of two lines, sixty characters or near it."
    sections = f"<article><section>{f'<p>{para}</p>' * 8}</section><section>{f'<p>{short}</p>' * 2}</section></article>"
    assert main_text.main_text(f"<body>{sections}<div>{'<a href=2>More stories here</a> ' * 9}</div>").split("\n") == [*[para.strip()] * 8, short, short]


@pytest.mark.parametrize(
    "attributes",
    ["style='overflow:hidden'", "data-hidden='false'", "data-role=search", "title=\"a class='ad' hidden\"", "class='content no-sidebar'", "class=with-sidebar",
     "class='post-related-body'", "class='content widget'"],
)
def test_containers_that_are_no_noise_keep_their_text(attributes):
    para = "A paragraph of the story that goes on for a good while. " * 3
    page = f"<body><div {attributes}><p>{para}</p><p>{para}</p></div><div class='ad-slot'>Buy now</div><div class='main-nav'>Menu</div>"
    assert main_text.main_text(page).split("\n") == [para.strip()] * 2


@pytest.mark.parametrize("attributes", ["hidden", "x=1 hidden", "aria-hidden=true", "role='search'", "class='a sidebar'", "id=site-footer", "class=cookie_notice"])
def test_noise_is_set_aside(attributes):
    para = "A paragraph of the story that goes on for a good while. " * 3
    assert main_text.main_text(f"<body><article><p>{para}</p><div {attributes}>Not of the story</div></article>") == para.strip()


def test_adverts_may_outweigh_the_article():
    assert main_text.main_text("<body><div class=ad>An advert of more words than the story has.</div><article><h1>Head</h1><p>Short.</p></article>") == "Head\nShort."


def test_comments_may_outweigh_the_article():
    para = "A paragraph of the story that goes on for a good while. " * 3
    assert main_text.main_text(f"<body><div><p>{para}</p></div><div id=comments>{'<p>Readers say much. </p>' * 90}</div>") == para.strip()


def test_components_that_do_not_settle_raise(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
    assert {r.part for r in bag_minhash.components(path).collect()} == {0}
    with pytest.raises(RuntimeError):
        bag_minhash.components(path, rounds=1)


def test_altered_copies_in_one_crowded_bucket(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base, rows = [f"v{k}" for k in range(150)], []
    for n in range(160):  # copies altered at none to a quarter of their words, some in the same places
        words = list(base)
        for place in rng.choice(150 if n % 3 else 12, rng.integers(0, 10), replace=False):
            words[place] = f"x{place}" if n % 2 else f"x{place}_{n}"
        rows.append((n, " ".join(words)))
    rows += [(None, rows[3][1])] * 30 + [(5, rows[5][1])] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    expect = classes_by_brute_force(rows)
    seen, often = [], bag_minhash._Verifier.__call__

    def count(self, pairs):
        seen.append(pairs.count())
        return often(self, pairs)

    monkeypatch.setattr(bag_minhash._Verifier, "__call__", count)
    got = bag_minhash.near_duplicates(docs).collect()
    assert Counter((r.doc_id, r.class_id) for r in got) == Counter((i, expect[t]) for i, t in rows)
    assert len(set(expect.values())) > 10 and max(seen) < 160 * 159 / 8


def test_parity_bitmaps_bound_what_two_sets_do_not_share():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 4000, dtype=np.uint64)
    for size in (0, 1, 7, 300, 2000):
        a, b = (np.unique(rng.choice(pool, size)) for _ in range(2))
        x, y = (np.unpackbits(bag_minhash.parities(s).view(np.uint8)) for s in (a, b))
        assert (x != y).sum() <= len(np.setxor1d(a, b)) and len(x) == 64 * bag_minhash.PARITY


def test_main_text_of_pages_within_a_form():
    para = "The council voted on the budget after a long debate about roads, schools and parks in the town. " * 3
    fields = "<label>Your name</label><input name=n><select><option>One</option></select><button>Send</button>"
    page = f"<body><form id=aspnetForm action=/><nav>Home News</nav><article><p>{para}</p><p>{para}</p></article>{fields}</form></body>"
    assert main_text.main_text(page).split("\n") == [para.strip()] * 2
    inner = f"<body><article><p>{para}</p><form class=x>Write to us here {fields}</form><p>{para}</p></article></body>"
    assert main_text.main_text(inner).split("\n") == [para.strip()] * 2
    readers = f"<body><article><p>{para}</p></article><form class=comment-form>{'<p>Readers say much. </p>' * 90}</form></body>"
    assert main_text.main_text(readers) == para.strip()


def test_main_text_is_linear_in_the_depth_of_open_tags():
    import time

    def seconds(n: int, part: str) -> float:
        began = time.process_time()
        main_text.main_text("<div>" * n + "<span>" * n + part * n + "text")
        return time.process_time() - began

    for part in ("</b>", "<p>a", "<li>a</li>", "<td>a</td>"):
        assert seconds(40_000, part) < 12 * max(seconds(10_000, part), 0.05)


def test_texts_with_letters_beyond_ascii_are_cut_without_a_pattern():
    from pressgauge.llm.bitplane import _Encoder

    plain, by_pattern = object.__new__(_Encoder), _Encoder.CUT.split
    plain.CUT = None
    assert plain.cut("déjà vu à l'été") == ["déjà", "vu", "à", "l'été"]
    exact = object.__new__(_Encoder)
    for text in ("é\xa0 x y", "é  x", "\x85 é", "é　 b c", "ß\t c d "):  # white space before a space: no cut there
        assert exact.cut(text) == by_pattern(text) != text.split(" ")

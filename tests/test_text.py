import hashlib
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.text import (
    WHITESPACE_CHARS,
    content_hash,
    detect_language,
    html_to_text,
    is_truncated,
    slug,
    strip_markup,
    trim_space,
)


def test_markup_and_entities(one):
    assert one(
        html_to_text,
        "<p>a</p><SCRIPT>var x = '</p>';</SCRIPT ><b>b</b>",
        "<script>x</script>kept<style type='a'>y</style>",
        "&amp;lt;tag&amp;gt; &lt;b&gt; &nbsp; &copy;",
        "a ﻿b \tc\r\n",
        "<script>never closed <b>text</b>",
        "",
        None,
    ) == [
        "a var x = ' '; b",
        "kept",
        "<tag> <b> &copy;",
        "a b c",
        "never closed text",
        "",
        None,
    ]


def test_cut_and_truncation(one):
    texts = ["x" * 7999, "x" * 8000, "x" * 8001]
    assert [len(t) for t in one(html_to_text, *texts)] == [7999, 8000, 8000]
    assert one(lambda c: is_truncated(html_to_text(c)), *texts) == [False, True, True]
    assert [len(t) for t in one(strip_markup, *texts)] == [7999, 8000, 8001]


def _expected(page):
    for tag in ("script", "style"):
        page = re.sub(rf"<{tag}[^>]*>[\s\S]*?</{tag}>", "", page, flags=re.I | re.A)
    page = re.sub(r"<[^>]+>", " ", page)
    for entity, char in (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")):
        page = page.replace(entity, char)
    return re.sub(f"[{WHITESPACE_CHARS}]+", " ", page).strip(" ")


PIECES = st.sampled_from(
    ["<p>", "</p>", "<script>", "</script>", "<STYLE a='>'>", "</style>", "&amp;", "lt;", "&nbsp;", "<", ">",
     " ", "  ", " ", " ", "﻿", "\t\n", "é", "word", "!", "&", "​"]
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(PIECES, max_size=25).map("".join), min_size=20, max_size=60))
def test_strip_markup_equals_plain_rules(one, pages):
    assert one(strip_markup, *pages) == [_expected(p) for p in pages]


def test_trim_keeps_inner_space(one):
    assert one(trim_space, "  a  b﻿\n", "   ", "") == ["a  b", "", ""]


def test_hash_is_of_utf8(one):
    assert one(content_hash, "naïve – ü") == [hashlib.sha256("naïve – ü".encode()).hexdigest()]


def test_language_cues(one):
    lang = lambda c: detect_language(c)["lang"]
    assert one(
        lang,
        "Die man het dit vir my",
        "die wat",
        "indie wat dat nie",
        "قال من",
        "الى من إلى",
        "ce que les gens des villes",
        "a les b des c une d",
        "x" * 500 + " die het vir ",
        "plain words",
    ) == ["af", "en", "af", "ar", "ar", "fr", "fr", "en", "en"]
    assert one(lambda c: detect_language(c)["in_distribution"], "plain", "a les b des c une d") == [True, False]


def test_language_counts_distinct_cues(one):
    assert one(lambda c: detect_language(c)["lang"], "die die die die die ") == [C.DEFAULT_LANGUAGE]


def test_slug(one):
    assert one(slug, "Brand No. 1 & Co", "ÄÖ", "") == ["brandno1co", "", ""]


def test_text_functions_stay_native(spark):
    df = spark.range(1).select(F.lit("<p>a</p>").alias("h"), F.rand().cast("string").alias("r"))
    plan = df.select(html_to_text("r"), detect_language("r"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan

"""Text extraction, hashing and the language heuristic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressgauge import constants as C
from pressgauge.functions.values import col_of

# The white space that feeds and pages are collapsed with (wider
# than Java's ASCII-only \\s) and the markup patterns removed.
WHITESPACE_CHARS = (
    " \t\n\x0b\f\r\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)
WHITESPACE = f"[{WHITESPACE_CHARS}]"
# Runs worth replacing: the look-aheads pass over printable ASCII, and over
# single blanks before it, without trying the wide class on every character.
WHITESPACE_RUN = f"(?![!-~])(?! [!-~]){WHITESPACE}+"
HIDDEN_BLOCKS = (
    r"(?i)<script[^>]*>[\s\S]*?</script>",
    r"(?i)<style[^>]*>[\s\S]*?</style>",
)
TAG = r"<[^>]+>"
# Decoded in this order, so a doubly escaped "&amp;lt;" ends as "<".
ENTITIES = (("&nbsp;", " "), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"))


def collapse_space(text: Column | str) -> Column:
    """Runs of white space become one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(col_of(text), WHITESPACE_RUN, " "))


def trim_space(text: Column | str) -> Column:
    """Trim the wide white-space class from both ends only."""
    return F.btrim(col_of(text), F.lit(WHITESPACE_CHARS))


def strip_markup(html: Column | str) -> Column:
    """Visible text of a page, uncut."""
    visible = reduce(lambda c, p: F.regexp_replace(c, p, ""), HIDDEN_BLOCKS, col_of(html))
    spaced = F.regexp_replace(visible, TAG, " ")
    decoded = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ENTITIES, spaced)
    return collapse_space(decoded)


def html_to_text(html: Column | str, max_chars: int = C.CONTENT_MAX_CHARS) -> Column:
    """Visible text of a page, cut to the stored length."""
    return F.substring(strip_markup(html), 1, max_chars)


def content_hash(text: Column | str) -> Column:
    """SHA-256 of the UTF-8 text, in hex: the identity of a piece of content."""
    return F.sha2(col_of(text), 256)


def is_truncated(text: Column | str, max_chars: int = C.CONTENT_MAX_CHARS) -> Column:
    """True when the stored text fills the limit, which includes exact fits."""
    return F.length(col_of(text)) >= max_chars


def long_enough(text: Column | str, min_chars: int = C.CONTENT_MIN_CHARS) -> Column:
    return F.length(col_of(text)) >= min_chars


def detect_language(text: Column | str) -> Column:
    """Struct ``(lang, confidence, in_distribution)`` from distinct cues in the head of the text."""
    sample = F.lower(F.substring(col_of(text), 1, C.LANGUAGE_SAMPLE_CHARS))

    def hits(cues: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a + b, [F.contains(sample, F.lit(cue)).cast("int") for cue in cues])

    # Every cue is tested once, outside any branch, so the lower-cased sample is
    # shared; the language with the highest precedence wins, 0 being the default.
    ranked = tuple(reversed(C.LANGUAGE_CUES))
    winner = F.greatest(
        *[F.when(hits(cues) >= needed, F.lit(i + 1)).otherwise(0) for i, (_, cues, needed) in enumerate(ranked)]
    )
    languages = F.array(F.lit(C.DEFAULT_LANGUAGE), *[F.lit(code) for code, _, _ in ranked])
    return F.struct(
        F.get(languages, winner).alias("lang"),
        F.lit("heuristic").alias("confidence"),
        (winner == 0).alias("in_distribution"),
    )


def slug(name: Column | str) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(col_of(name)), "[^a-z0-9]", "")

"""Awkward documents: nulls, empties, ties, repeated rows and very long texts."""

HOSTILE = [
    # doc_id, text: nulls, empties, ties, repeated rows, one very long text
    (1, "Released under the MIT License.\nThe quick brown fox jumps over the lazy dog near the river bank today"),
    (1, "Released under the MIT License.\nThe quick brown fox jumps over the lazy dog near the river bank today"),
    (2, None), (None, "a text without an id, of a few words only"), (None, None), (3, ""), (4, " \n\t "), (5, "one"), (6, "ONE"),
    (7, "été ÉTÉ straße 日本語 😀 x\x00y ▁ under_score <s> </s>"), (8, "the general public license; the general public license"),
    (9, " ".join(f"w{i % 977}" for i in range(30_000))), (10, " ".join(f"w{i % 977}" for i in range(30_000)) + " end"),
    (11, "same text here for ties " * 4), (12, "same text here for ties " * 4), (13, "a b c d e f g h i j k l m n o p q r s t u v w x y z"),
    (14, "zz a b c d e f g h i j k l zz"), (15, "line one is here\nline one is here\n\nline one is here"),
]

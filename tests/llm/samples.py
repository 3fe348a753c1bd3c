"""Rows that the tests share."""

import os

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

#: Edge rows: nulls in each column, empty and blank texts, ties, repeated rows, one very long text.
LONG = "the of and " * 30_000
EDGE = [
    (1, "The of and to.\nThe of and to.", "en", "a", 30), (2, None, "en", "a", 0), (3, "", "de", None, 0),
    (4, " \t\n ", None, "b", 4), (5, LONG, "en", "b", len(LONG)), (6, "12 34 +-", "fr", "b", 8),
    (7, "the of and to.\nthe of and to.", None, None, 30), (7, "the of and to.\nthe of and to.", None, None, 30),
    (None, "der die das und", "de", "a", 15), (None, None, None, None, None), (8, "日本語 テキスト \U0001f600", "en", "c", 10),
    (9, "a  b   c\t d \n\n e", "en", "c", 16), (10, "der die das und ist der die das und ist", "de", "c", 39),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

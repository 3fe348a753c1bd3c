"""Question -> report router (B29) as a column expression.

Rules are tried in order and the first hit wins; each rule needs one word from both of its
groups, matched as whole words in the lower-cased text. Unmatched text routes to NULL.
Word boundaries follow Unicode letters/digits (a letter such as "e-acute" is part of a word),
written as look-arounds so the JVM regex engine needs no flags.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: routing rules (intent, first word group, second word group) ---
INTENT_RULES = [
    ("sales_by_region", ["region", "by region", "regions"], ["sales", "profit", "revenue"]),
    ("monthly_trend", ["month", "monthly", "trend", "history"], ["sales", "profit"]),
    ("top_customers", ["top", "best", "highest"], ["customers", "clients"]),
    ("top_products", ["top", "best", "highest"], ["product", "products"]),
]
# --- end of fixed values ---

WORD_CHAR = r"[\p{L}\p{N}_]"


def whole_words_pattern(words: list[str]) -> str:
    """Java-regex pattern: any of ``words`` not adjacent to a word character."""
    alternation = "|".join(words)
    return rf"(?<!{WORD_CHAR})(?:{alternation})(?!{WORD_CHAR})"


def detect_intent(text: Column) -> Column:
    """Route a column of questions to report names; NULL when no rule matches."""
    t = F.lower(text)
    expr = None
    for intent, first, second in INTENT_RULES:
        hit = t.rlike(whole_words_pattern(first)) & t.rlike(whole_words_pattern(second))
        expr = F.when(hit, F.lit(intent)) if expr is None else expr.when(hit, F.lit(intent))
    return expr.otherwise(F.lit(None).cast("string"))

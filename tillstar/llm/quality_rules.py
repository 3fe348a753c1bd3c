"""Operator 3: quality rules by distribution divergence.

Two rules on plain counts come first: fewer than ``min_words`` words, or more than half of the words
inside repeated three-word windows, fails a document. The rest is judged by how far its histograms
lie from language references, as the Jensen-Shannon distance (base 2, so 0 to 1) of

* character classes (lower, upper, other letters, digits, sentence punctuation, other symbols), and
* common words: the ``top_words`` most frequent words of the language, and all others as one class.

References are counted over all documents, per language; rows without a language, and languages of too few
documents or words (``LEAST_DOCUMENTS``, ``LEAST_WORDS``), give none, so that junk is not its own measure. A document is compared with every
language's reference and judged by the nearest, so its own language label is not trusted. Each
histogram has a minimum length (characters, words) below which it does not decide.

Words are runs of characters other than U+0020 and U+0009 to U+000D. Null texts have no words and
fail; empty texts likewise. Rows are judged one by one, so repeated rows get equal verdicts. Without references only the
counts decide; with no documents at all there are no rows.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import per_worker, release, ship, slices, stored

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"
CLASSES = ("lower", "upper", "other letter", "digit", "punctuation", "symbol")
MEMO_WORDS = 200_000
FLUSH_WORDS = 200_000
LEAST_DOCUMENTS, LEAST_WORDS = 20, 2_000  # of a language that gives a reference
DOCUMENTS = -1  # the kind of a row that counts documents
RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, char_distance double, word_distance double, kept boolean")


class Limits(NamedTuple):
    min_words: int = 50
    repeat_percent: int = 50
    char_distance: float = 0.27
    word_distance: float = 0.40
    min_chars: int = 200
    min_common_words: int = 100
    top_words: int = 64


class References(NamedTuple):
    """Distributions per language: rows of ``chars`` and ``words`` sum to 1."""

    langs: list[str]
    chars: np.ndarray  # language x class
    vocabulary: dict[str, int]  # common word of any language -> column of words
    words: np.ndarray  # language x (common words, the last one for all others)
    common: np.ndarray  # language x common words: whether it is one of the language's own


def _class_table() -> np.ndarray:
    """Class of each byte of UTF-8 text; 9 for blanks and continuation bytes. Bytes that open
    characters of more than one byte count as other letters."""
    table = np.full(256, 9, np.uint8)
    for b in range(128):
        c = chr(b)
        if c.islower():
            table[b] = 0
        elif c.isupper():
            table[b] = 1
        elif c.isdigit():
            table[b] = 3
        elif c in ".,;:!?'\"()-":
            table[b] = 4
        elif not c.isspace():
            table[b] = 5
    table[192:] = 2
    return table


CLASS_OF = _class_table()


def char_classes(raw: bytes) -> np.ndarray:
    return np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=10)[: len(CLASSES)]


def repeat_words(codes: np.ndarray) -> int:
    """Words that stand in some three-word window found twice or more; ``codes`` has a number per word."""
    n = len(codes)
    if n < 4:
        return 0
    # Codes are below the number of words, so a window is one exact 64-bit number up to 2**21 words.
    if n < 1 << 21:
        windows = (codes[:-2] << 42) | (codes[1:-1] << 21) | codes[2:]
        _, inverse, counts = np.unique(windows, return_inverse=True, return_counts=True)
    else:
        _, inverse, counts = np.unique(np.stack((codes[:-2], codes[1:-1], codes[2:]), 1), axis=0,
                                       return_inverse=True, return_counts=True)
    hit = counts[inverse.ravel()] > 1
    covered = np.zeros(n, bool)
    covered[:-2] |= hit
    covered[1:-1] |= hit
    covered[2:] |= hit
    return int(covered.sum())


def base_counts(text: str, words: list[bytes]) -> tuple[int, int, int, int]:
    """word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    word_chars = len(text) - sum(text.count(c) for c in BLANKS)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    repeated = repeat_words(codes) if len(number) < len(words) else 0
    return word_chars, symbols, len(lines) - len(set(lines)), repeated


def js_distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon distance of distribution ``p`` from each row of ``q``, in base 2."""
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(p > 0, p * np.log2(p / m), 0).sum(-1)
        b = np.where(q > 0, q * np.log2(q / m), 0).sum(-1)
    return np.sqrt(np.clip((a + b) / 2, 0, 1))


def normal_word(word: bytes) -> str:
    """A word for the histogram: lower case, without punctuation or symbols around it."""
    return word.decode("utf-8", "replace").lower().strip(".,;:!?'\"()-" + SYMBOLS)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial counts: (lang, word, n) rows, and (lang, null, n, character class) rows, with documents as a class of their own."""
    release()
    words: dict[str, Counter] = {}
    chars: dict[str, np.ndarray] = {}
    texts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        rows = []
        for lang, counter in words.items():
            normal: Counter = Counter()
            for w, n in counter.items():
                normal[normal_word(w)] += n
            rows += [(lang, w, n, None) for w, n in normal.items() if w]
        rows += [(lang, None, n, k) for lang, hist in chars.items() for k, n in enumerate(hist.tolist())]
        rows += [(lang, None, n, DOCUMENTS) for lang, n in texts.items()]
        lang, word, n, kind = zip(*rows)
        return pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.string()), "word": pa.array(word, pa.string()),
                                           "n": pa.array(n, pa.int64()), "kind": pa.array(kind, pa.int32())})

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1))):
            raw = text.encode()
            words.setdefault(lang, Counter()).update(raw.split())
            chars[lang] = chars.get(lang, 0) + char_classes(raw)
            texts[lang] += 1
            if len(words[lang]) > FLUSH_WORDS:
                yield flushed()
                words, chars, texts = {}, {}, Counter()
    if words:
        yield flushed()


def learn_references(df: DataFrame, text_col: str = "text", lang_col: str = "lang", top_words: int = 64) -> References:
    """Count character classes and words over all documents with text and language, per language. What reaches the
    driver is bounded by the languages of at least ``LEAST_DOCUMENTS``: ``top_words`` rows for each."""
    spark = ship(df.sparkSession)
    rows = df.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    partial = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).mapInArrow(_counted, "lang string, word string, n long, kind int")
    # A hot word meets as one partial sum from each task.
    counts = stored(partial.groupBy("lang", "word", "kind").agg(F.sum("n").alias("n")), "word-counts")
    enough = counts.where((F.col("kind") == DOCUMENTS) & (F.col("n") >= LEAST_DOCUMENTS)).select("lang")
    counts = counts.join(enough, "lang", "left_semi")
    hist = counts.where(F.col("kind") >= 0).collect()
    by_word = counts.where(F.col("kind").isNull())
    totals = {r["lang"]: r["n"] for r in by_word.groupBy("lang").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_WORDS).collect()}
    rank = Window.partitionBy("lang").orderBy(F.desc("n"), "word")  # a rank limit: cut before the shuffle
    top = by_word.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= top_words).collect()
    top = [r for r in top if r["lang"] in totals]
    langs = sorted(totals)
    vocabulary = {w: i for i, w in enumerate(sorted({r["word"] for r in top}))}
    chars = np.zeros((len(langs), len(CLASSES)))
    for r in hist:
        if r["lang"] in totals:
            chars[langs.index(r["lang"]), r["kind"]] = r["n"]
    words = np.zeros((len(langs), len(vocabulary) + 1))
    for r in top:
        words[langs.index(r["lang"]), vocabulary[r["word"]]] = r["n"]
    for i, lang in enumerate(langs):
        words[i, -1] = max(0, totals[lang] - words[i].sum())
    return References(langs, chars / np.maximum(chars.sum(1, keepdims=True), 1), vocabulary,
                      words / np.maximum(words.sum(1, keepdims=True), 1), words[:, :-1] > 0)


class Judge:
    def __init__(self, references: References, limits: Limits):
        self.ref, self.limits = references, limits
        self.column: dict[bytes, int] = {}

    def _columns(self, words: list[bytes]) -> np.ndarray:
        other, column, vocabulary = len(self.ref.vocabulary), self.column, self.ref.vocabulary
        if len(column) > MEMO_WORDS:
            column.clear()
        out = []
        for w in words:
            c = column.get(w)
            if c is None:
                c = column[w] = vocabulary.get(normal_word(w), other)
            out.append(c)
        return np.array(out, np.int64)

    def row(self, text: str | None) -> tuple:
        raw = (text or "").encode()
        words = raw.split()
        n = len(words)
        counts = base_counts(text, words) if n else (0, 0, 0, 0)
        lim = self.limits
        failed = n < lim.min_words or 100 * counts[3] > lim.repeat_percent * n
        char_d = word_d = 0.0
        if n and len(self.ref.langs):
            classes = char_classes(raw)
            if (total := classes.sum()) >= lim.min_chars:
                char_d = float(js_distance(classes / total, self.ref.chars).min())
            if n >= lim.min_common_words:
                seen = np.bincount(self._columns(words), minlength=len(self.ref.vocabulary) + 1) / n
                own = np.where(self.ref.common, seen[:-1], 0)  # other languages' words count as others
                shares = np.concatenate((own, 1 - own.sum(1, keepdims=True)), 1)
                word_d = float(js_distance(shares, self.ref.words).min())
        kept = not failed and char_d <= lim.char_distance and word_d <= lim.word_distance
        return (n, *counts, failed, char_d, word_d, kept)


def judge(df: DataFrame, references: References, limits: Limits = Limits(), text_col: str = "text") -> DataFrame:
    """Add ``rules``, a struct of the counts, both distances, base_failed and kept. A column of that name is replaced."""
    spark = ship(df.sparkSession)
    shared, key = spark.sparkContext.broadcast((references, limits)), uuid.uuid4().hex  # top words per language

    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = per_worker(f"rules-{key}", lambda: Judge(*shared.value))
        kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]
        names = [part.split(" ")[0] for part in RESULT.split(", ")]
        for texts in batches:
            columns = list(zip(*(one.row(t) for part in slices(texts) for t in part.to_pylist()))) or [()] * len(names)
            yield pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return df.withColumn("rules", F.arrow_udf(judged, f"struct<{RESULT}>").asNondeterministic()(F.col(text_col)))

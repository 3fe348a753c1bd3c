"""Operator 5: language of each text, and of its spans.

Every word gets a score for each learned language: its smoothed log frequency there if it is a known
word, else the log probability of its character trigrams. The Unicode ranges of the word's letters
narrow the candidates to languages that use this script. A Viterbi pass with a penalty for each
change of language then labels all words; runs of one label are the spans. Most texts have one
language, and for them the pass isn't walked: if no stretch of words gains more by another label than
the switches into and out of it cost, the constant path is the best one, which prefix sums show at once.

``lang_pred`` is the language that labels most words (ties: the first by name); ``score`` is its share of the
words times its posterior probability over the scores of those words. Null texts and texts without a letter
get ``und`` and 0; so does everything when nothing could be learned. Repeated rows get equal results. A
language name is whatever value the language column holds; rows without one are not learned from.

Learning reads a bounded sample, chosen by a hash of the id: about ``sample_docs`` documents in proportion to
the languages, but of each language about ``least_docs`` at least, and all where it has no more than these.
"""

from __future__ import annotations

import bisect
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import per_worker, release, ship, slices, stored

WORDS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
FLOOR = -8.0  # the least a word can say against a language
MEMO_WORDS = 150_000
FLUSH_WORDS = 200_000
LONG_WORD = 64  # trigrams of a word that is summed by itself
SPAN = "struct<start:int,end:int,lang:string>"

# First and last code point of the letters of each script.
SCRIPT_RANGES = [
    (0x0041, 0x024F, "Latin"), (0x0250, 0x02AF, "Latin"), (0x0370, 0x03FF, "Greek"), (0x0400, 0x052F, "Cyrillic"),
    (0x0530, 0x058F, "Armenian"), (0x0590, 0x05FF, "Hebrew"), (0x0600, 0x077F, "Arabic"),
    (0x0900, 0x097F, "Devanagari"), (0x0980, 0x09FF, "Bengali"), (0x0A00, 0x0A7F, "Gurmukhi"),
    (0x0A80, 0x0AFF, "Gujarati"), (0x0B80, 0x0BFF, "Tamil"), (0x0C00, 0x0C7F, "Telugu"), (0x0E00, 0x0E7F, "Thai"),
    (0x10A0, 0x10FF, "Georgian"), (0x1100, 0x11FF, "Hangul"), (0x1E00, 0x1EFF, "Latin"), (0x1F00, 0x1FFF, "Greek"),
    (0x3040, 0x309F, "Hiragana"), (0x30A0, 0x30FF, "Katakana"), (0x3400, 0x9FFF, "Han"), (0xAC00, 0xD7AF, "Hangul"),
]
_STARTS = [r[0] for r in SCRIPT_RANGES]


class Model(NamedTuple):
    langs: list[str]
    words: dict[str, tuple[float, ...]]  # known word -> log score per language
    trigrams: dict[str, tuple[float, ...]]
    unseen: tuple[float, ...]  # log score per language of a trigram never seen
    scripts: dict[str, tuple[bool, ...]]  # script -> whether each language uses it


def script(word: str) -> str:
    """Script of the word's first letter by its range; "Other" outside all ranges."""
    code = ord(next((c for c in word if c.isalpha()), " "))
    at = bisect.bisect_right(_STARTS, code) - 1
    return SCRIPT_RANGES[at][2] if at >= 0 and code <= SCRIPT_RANGES[at][1] else "Other"


def trigrams(word: str) -> list[str]:
    padded = f"^{word}$"
    return [padded[i:i + 3] for i in range(len(padded) - 2)]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    counts: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in counts], pa.string()),
                                           "word": pa.array([k[1] for k in counts], pa.string()),
                                           "n": pa.array(counts.values(), pa.int64())})

    for batch in batches:
        for part in slices(batch):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                counts.update((lang, w) for w in WORDS.findall(text.lower()))
            if len(counts) > FLUSH_WORDS:
                yield flushed()
                counts = Counter()
    if counts:
        yield flushed()


def _trigram_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts.update((lang, t) for t in trigrams(word))
        yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in counts], pa.string()),
                                          "gram": pa.array([k[1] for k in counts], pa.string()),
                                          "n": pa.array(counts.values(), pa.int64())})


def _script_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts: Counter = Counter()
        for lang, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            counts[lang, script(word)] += n
        yield pa.RecordBatch.from_pydict({"lang": pa.array([k[0] for k in counts], pa.string()),
                                          "script": pa.array([k[1] for k in counts], pa.string()),
                                          "n": pa.array(counts.values(), pa.int64())})


def sampled_by_language(rows: DataFrame, id_col: str, lang_col: str, docs: int, least: int) -> DataFrame:
    """About ``docs`` rows in proportion to the languages, but about ``least`` rows of each language (all, if
    there are fewer), chosen by a hash of the id: the same rows each time."""
    counts = {r[lang_col]: r["count"] for r in rows.groupBy(lang_col).count().collect()}
    every = sum(counts.values())
    if every <= docs:
        return rows
    limits = [(lang, int(docs / every * (1 << 20)) if n * docs >= least * every else min(1 << 20, -(-least * (1 << 20) // n)))
              for lang, n in counts.items()]
    limits = rows.sparkSession.createDataFrame(limits, rows.select(F.col(lang_col).alias("__lang"), F.lit(0).alias("__limit")).schema)
    bucket = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20))
    chosen = rows.join(F.broadcast(limits), (F.col(lang_col) == F.col("__lang")) & (bucket < F.col("__limit")))  # a row for each language
    return chosen.select(*rows.columns)


def learn(df: DataFrame, learn_from: Column | None = None, text_col: str = "text", lang_col: str = "lang",
          id_col: str = "doc_id", sample_docs: int = 20_000, min_count: int = 5, least_docs: int = 2_000) -> Model:
    """Learn from the rows where ``learn_from`` holds and text and language are not null. The model's size is bounded
    by the sample, the number of languages and ``min_count``, the least count of a known word."""
    spark = ship(df.sparkSession)
    rows = df.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = (rows if learn_from is None else rows.where(learn_from)).select(
        F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    rows = sampled_by_language(rows, "id", "lang", sample_docs, least_docs).select("lang", "text")
    words = stored(rows.mapInArrow(_counted, "lang string, word string, n long")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    grams = (words.select("lang", "word").mapInArrow(_trigram_rows, "lang string, gram string, n long")
             .groupBy("lang", "gram").agg(F.sum("n").alias("n")).collect())
    totals = {r["lang"]: r["n"] for r in words.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    langs = sorted(totals)
    common = words.groupBy("word").agg(F.sum("n").alias("all")).where(F.col("all") >= min_count)
    known = words.join(common, "word").select("lang", "word", "n", "all").collect()
    place = {lang: i for i, lang in enumerate(langs)}
    every = sum(totals.values())
    counts: dict[str, list[float]] = {}
    shared: dict[str, int] = {}
    used: dict[str, Counter] = {}
    for r in words.mapInArrow(_script_rows, "lang string, script string, n long").groupBy("lang", "script").agg(F.sum("n").alias("n")).collect():
        used.setdefault(r["script"], Counter())[r["lang"]] = r["n"]
    for r in known:
        counts.setdefault(r["word"], [0.0] * len(langs))[place[r["lang"]]] = r["n"]
        shared[r["word"]] = r["all"]
    # A word that a language lacks is backed by its frequency everywhere, discounted.
    table = {w: tuple(math.log((n + 0.01 * totals[lang] * shared[w] / every) / (1.01 * totals[lang]))
                      for n, lang in zip(c, langs)) for w, c in counts.items()}
    gram_counts: dict[str, list[float]] = {}
    gram_totals = [0.0] * len(langs)
    for r in grams:
        gram_counts.setdefault(r["gram"], [0.0] * len(langs))[place[r["lang"]]] = r["n"]
        gram_totals[place[r["lang"]]] += r["n"]
    size = 0.1 * (len(gram_counts) + 1)
    return Model(langs, table,
                 {g: tuple(math.log((n + 0.1) / (t + size)) for n, t in zip(c, gram_totals)) for g, c in gram_counts.items()},
                 tuple(math.log(0.1 / (t + size)) for t in gram_totals),
                 {s: tuple(c[lang] >= 0.01 * totals[lang] for lang in langs) for s, c in used.items()})


def viterbi(scores: np.ndarray, penalty: float) -> np.ndarray:
    """The best label of each row of ``scores`` (words x labels), ties to the smaller label."""
    total = scores.sum(0, dtype=np.float64)
    best = int(total.argmax())
    n, labels = scores.shape
    if labels == 1:
        return np.zeros(n, np.int64)
    gain = np.delete(scores, best, 1).max(1).astype(np.float64) - scores[:, best]
    sums = np.concatenate(([0.0], np.cumsum(gain)))
    if (sums.max() <= penalty and sums[-1] - sums.min() <= penalty
            and (sums - np.minimum.accumulate(sums)).max() <= 2 * penalty):
        return np.full(n, best, np.int64)
    value = scores[0].tolist()
    came = np.empty((n, labels), np.int32)
    for t, row in enumerate(scores[1:].tolist(), 1):
        top = max(range(labels), key=value.__getitem__)
        entry = value[top] - penalty
        back = came[t]
        for k in range(labels):
            if value[k] >= entry:
                back[k] = k
                value[k] += row[k]
            else:
                back[k] = top
                value[k] = entry + row[k]
    path = np.empty(n, np.int64)
    label = max(range(labels), key=value.__getitem__)
    for t in range(n - 1, -1, -1):
        path[t] = label
        if t:
            label = came[t, label]
    return path


class Labeller(dict):
    """Labels texts; as a dict it maps words to rows of ``table``, their scores."""

    def __init__(self, model: Model, penalty: float):
        super().__init__()
        self.model, self.penalty = model, penalty
        self.table = np.zeros((1024, max(1, len(model.langs))))
        self.letters = np.zeros(1024, bool)
        self.grams = {g: k for k, g in enumerate(model.trigrams)}
        # A row for each trigram, then one for those never seen, then one of zeros, which fills up short words.
        self.gram_rows = np.array([*model.trigrams.values(), model.unseen, [0.0] * len(model.langs)])
        self.masks: dict[str, tuple[bool, ...]] = {}  # first letter -> whether each language uses its script

    def mask(self, word: str) -> tuple[bool, ...]:
        first = word[:1]
        if not first.isalpha():
            return self.model.scripts.get(script(word)) or (False,) * len(self.model.langs)
        found = self.masks.get(first)
        if found is None:
            found = self.masks[first] = self.model.scripts.get(script(word)) or (False,) * len(self.model.langs)
        return found

    def add(self, words: list[str]) -> None:
        """Give each of these new words the next row of the table."""
        at = len(self)
        end = at + len(words)
        while end > len(self.table):
            self.table = np.concatenate((self.table, np.zeros_like(self.table)))
            self.letters = np.concatenate((self.letters, np.zeros_like(self.letters)))
        self.table[at:end] = self.scores(words)
        self.letters[at:end] = [w[0].isalpha() or any(c.isalpha() for c in w) for w in words]
        self.update(zip(words, range(at, end)))

    def scores(self, words: list[str]) -> np.ndarray:
        """A row for each word: known words by their own scores, others by the sums of their trigrams', first to last."""
        model, never = self.model, len(self.grams)
        known = [model.words.get(w) for w in words]
        s = np.zeros((len(words), len(model.langs)))
        at = [k for k, row in enumerate(known) if row is not None]
        if at:
            s[at] = [known[k] for k in at]
        at = [k for k, row in enumerate(known) if row is None]
        if at:
            grams = [[self.grams.get(g, never) for g in trigrams(words[k])] for k in at]
            width = min(LONG_WORD, max(map(len, grams)))
            sums = np.zeros((len(at), len(model.langs)))
            for column in np.array([g + [never + 1] * (width - len(g)) if len(g) <= width else [never + 1] * width for g in grams]).T:
                sums += self.gram_rows[column]
            for k, g in enumerate(grams):
                if len(g) > width:
                    sums[k] = self.gram_rows[g].sum(0)
            s[at] = sums
        candidates = np.array([self.mask(w) for w in words], bool).reshape(s.shape)
        s = np.where(candidates, s, -np.inf)
        some = candidates.any(1)
        best = np.where(some, s.max(1), 0.0)
        return np.where(some[:, None], np.maximum(s - best[:, None], FLOOR), 0.0)

    def label(self, text: str | None) -> tuple[str, float, list[tuple[int, int, str]]]:
        langs = self.model.langs
        words = WORDS.findall(text.lower()) if text else []
        if len(self) > MEMO_WORDS:
            self.clear()
        if not langs:
            return UNKNOWN, 0.0, []
        unseen = [w for w in dict.fromkeys(words) if w not in self]
        if unseen:
            self.add(unseen)
        rows = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        if not self.letters[rows].any():
            return UNKNOWN, 0.0, []
        scores = self.table[rows]
        path = viterbi(scores, self.penalty)
        counts = np.bincount(path, minlength=len(langs))
        pred = int(counts.argmax())
        total = scores[path == pred].sum(0)
        posterior = 1 / np.exp(np.clip(total - total[pred], None, 50)).sum()
        cuts = np.flatnonzero(np.diff(path)) + 1
        spans = [(int(a), int(b), langs[path[a]]) for a, b in zip([0, *cuts], [*cuts, len(path)])]
        return langs[pred], float(counts[pred] / len(path) * posterior), spans


def identify(df: DataFrame, model: Model, penalty: float = 12.0, text_col: str = "text") -> DataFrame:
    """Add ``language``: a struct of lang_pred, score and spans (first word, word after the last, language). A column of that
    name is replaced."""
    spark = ship(df.sparkSession)
    shared, key = spark.sparkContext.broadcast((model, penalty)), uuid.uuid4().hex  # bounded by the sample

    def labelled(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = per_worker(f"language-{key}", lambda: Labeller(*shared.value))
        span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])
        for texts in batches:
            rows = [labeller.label(t) for part in slices(texts) for t in part.to_pylist()]
            yield pa.StructArray.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.float64()),
                 pa.array([[dict(zip(("start", "end", "lang"), s)) for s in r[2]] for r in rows], pa.list_(span))],
                ["lang_pred", "score", "spans"])

    kind = f"struct<lang_pred:string,score:double,spans:array<{SPAN}>>"
    # So marked, a filter and a column that both read the struct share one evaluation.
    return df.withColumn("language", F.arrow_udf(labelled, kind).asNondeterministic()(F.col(text_col)))

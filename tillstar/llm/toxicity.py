"""Operator 1: toxicity by class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary documents, share their lowest order: the continuation
counts (in how many different contexts a word was seen) of both classes together. A class's word
distribution discounts its counts and gives the mass to the shared one, and a class's bigram distribution discounts
likewise and backs off to its word distribution, by weights that again come from both classes' counts. The discounts are the
modified Kneser-Ney ones, for counts of 1, 2 and 3 or more, estimated from counts of counts, of each class and order by
itself; so what a rare expression says is smoothed, not cut off. Words and bigrams of a single document give all their mass to
the back-off. Counts are of documents: a text that repeats a word weighs no more. A text's evidence is the
difference of its two log-likelihoods divided by its number of words, and likewise the excess: what the
words that speak clearly for the toxic class add to that difference beyond a threshold, and the level, the median
of the words' log ratios. The score is a logistic function of the difference, the level and the excess's logarithm,
fitted on labelled rows that the models were not learned from; the level takes off what a text's language and
subject add to the difference.

Words are runs of letters in lower case; words too rare to count are one class, ``<unk>``. Null texts
and texts without a word have no evidence and get the score of none. Rows without a label are not
learned from. If a class has no labelled row, every score is the share of class 1 (0.5 with none).
Repeated rows get equal scores.

Learning reads every labelled document: four fifths of them are counted, and the fifth that is not, told by a hash
of the id, fits the logistic function. The model holds the words and bigrams of two documents or more, so it grows with the
labelled rows as their vocabulary does, much slower than the rows. It lies in tables of the shared folder, which tasks write and
Python workers read; the driver holds their paths and a few sums only.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, write_parquet
from .common import per_worker, shared_path, ship, slices, stored
from .warc_packages import file_system

WORDS = re.compile(r"[^\W\d_]+")
CLEAR = 1.5  # a word's log ratio above this speaks clearly
UNKNOWN, START = 0, 1  # ids of rare words and of the start of a text


class Model(NamedTuple):
    """As a Python worker holds it."""

    words: dict[str, int]
    word: np.ndarray  # of each word: log ratio of its probabilities, without a counted bigram
    pairs: np.ndarray  # sorted keys of counted bigrams
    pair: np.ndarray  # log ratio to add for each
    weights: np.ndarray  # of the logistic function: constant, ratio, level, logarithm of the excess


class Ids(dict):
    def __missing__(self, word: str) -> int:
        return UNKNOWN


class Learned(NamedTuple):
    """Where a model lies: folders of words, of their counts and of bigrams, none if a class had no row."""

    words_at: str | None
    counts_at: str | None
    pairs_at: str | None
    weights: np.ndarray

    def load(self) -> Model:
        if self.words_at is None:
            return Model(Ids(), np.zeros(2), np.zeros(0, np.int64), np.zeros(0), self.weights)
        words = numbered(self.words_at)
        p = word_tables(self.counts_at, len(words) + 2)[0]
        return Model(words, np.log(p[1]) - np.log(p[0]), *columns(self.pairs_at, {"pair": np.int64, "value": float}).values(), self.weights)

    words = property(lambda self: dict(self.load().words))
    word = property(lambda self: self.load().word)
    pairs = property(lambda self: self.load().pairs)
    pair = property(lambda self: self.load().pair)


def files(folder: str):
    """The Parquet files of a folder, opened one by one in the order of their names, which is that of the tasks."""
    from pyarrow import fs, parquet

    system, inner = file_system(folder)
    for name in sorted(f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.path.endswith(".parquet")):
        with system.open_input_file(name) as file:
            yield parquet.ParquetFile(file)


def columns(folder: str, kinds: dict[str, type]) -> dict[str, np.ndarray]:
    """Columns of numbers, read row group by row group into arrays of the whole length."""
    out = {c: np.empty(sum(f.metadata.num_rows for f in files(folder)), kind) for c, kind in kinds.items()}
    at = 0
    for f in files(folder):
        for batch in f.iter_batches(columns=list(kinds), use_threads=False):
            for c, values in out.items():
                values[at:at + len(batch)] = batch.column(c).to_numpy(zero_copy_only=False)
            at += len(batch)
    return out


def numbered(folder: str) -> Ids:
    """A word's id is its place in the stored table: the same for every reader."""
    words = Ids()
    for f in files(folder):
        for batch in f.iter_batches(columns=["word"], use_threads=False):
            words.update(zip(batch.column(0).to_pylist(), range(len(words) + 2, len(words) + 2 + len(batch))))
    return words


def word_tables(folder: str, size: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """From the counts of words: their probabilities in both classes, and the total and back-off weight of each as a context."""
    kinds = {"w": np.int64, "c0": float, "c1": float, "contexts": float, "n": float, "cut": float}
    rows = columns(folder, kinds)

    def column(name: str) -> np.ndarray:
        out = np.zeros(size)
        out[rows["w"]] = rows[name]
        return out

    shared_p = column("contexts") + 1e-3
    shared_p /= shared_p.sum()
    word_p = []
    for c in (0, 1):
        n = column(f"c{c}")
        cut = discounts(Counter(n[(n > 0) & (n < 5)].astype(int).tolist()))[np.minimum(n, 3).astype(int)]
        word_p.append((n - cut + (cut.sum() + 1) * shared_p) / (n.sum() + 1))
    total = column("n")
    return word_p, total, (column("cut") + 1) / (total + 1)  # an unseen context backs off with all its mass


def word_ids(words: Ids, text: str | None) -> np.ndarray:
    found = WORDS.findall(text.lower()) if text else []
    return np.fromiter(map(words.__getitem__, found), np.int64, len(found))


def evidence(model: Model, ids: np.ndarray) -> tuple[float, float, float]:
    """Per word, of the log-likelihood ratios of toxic to ordinary: mean, median and mean excess over ``CLEAR``."""
    if not len(ids):
        return 0.0, 0.0, 0.0
    before = np.concatenate(([START], ids[:-1]))
    ratio = model.word[ids]
    if len(model.pairs):
        keys = before << 32 | ids
        at = np.minimum(np.searchsorted(model.pairs, keys), len(model.pairs) - 1)
        ratio = ratio + np.where(model.pairs[at] == keys, model.pair[at], 0)
    return float(ratio.mean()), float(np.median(ratio)), float(np.maximum(ratio - CLEAR, 0).mean())


def features(x: np.ndarray) -> np.ndarray:
    """What the logistic function reads of rows of ``evidence``: ratio, level, logarithm of the excess."""
    return np.stack((x[:, 0], x[:, 1], np.log(0.01 + x[:, 2])), 1)


def logistic(weights: np.ndarray, x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(weights[0] + features(x) @ weights[1:], -700, 700)))


def _fit_logistic(rows: DataFrame, counts: dict[int, int], ridge: float = 0.01) -> np.ndarray:
    """Newton's method on rows of ``label`` and ``evidence``; each class weighs as its ``counts``, with a small penalty on standardised
    coefficients. Tasks sum over the rows; the driver gets a row of sums from each."""
    names = ("ratio", "level", "excess")
    x = [F.col("ratio"), F.col("level"), F.log(F.lit(0.01) + F.col("excess"))]
    known = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0)), *(F.avg(c) for c in x), *(F.stddev_pop(c) for c in x)).first()
    n, ones, d = known[0], known[1], len(x)
    if not n:
        return np.zeros(d + 1)
    centre, scale = np.array(known[2:2 + d], float), np.maximum(np.array(known[2 + d:], float), 1e-9)
    weights = np.array([counts[0] / max(1.0, n - ones), counts[1] / max(1.0, ones)])
    weights /= max(1e-9, float(weights @ [n - ones, ones]) / n)

    def sums(w: np.ndarray) -> np.ndarray:
        """Of the second derivatives, and behind them the first."""
        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((d + 1, d + 2))
            for batch in batches:
                label = batch.column("label").to_numpy(zero_copy_only=False).astype(float)
                z = (features(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], 1)) - centre) / scale
                z = np.concatenate((np.ones((len(z), 1)), z), 1)
                weight, p = weights[label.astype(int)], 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
                out[:, :-1] += (z * (weight * p * (1 - p))[:, None]).T @ z
                out[:, -1] += z.T @ (weight * (label - p))
            yield pa.RecordBatch.from_pydict({"sums": pa.array([out.ravel().tolist()], pa.list_(pa.float64()))})

        parts = rows.select("label", *names).mapInArrow(add, "sums array<double>").collect()
        return np.sum([r["sums"] for r in parts], 0).reshape(d + 1, d + 2)

    w, penalty = np.zeros(d + 1), np.array([1e-6] + [ridge] * d)
    for _ in range(100):
        found = sums(w)
        step = np.linalg.solve(found[:, :-1] + np.diag(penalty), found[:, -1] - penalty * w)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.concatenate(([w[0] - (w[1:] * centre / scale).sum()], w[1:] / scale))


def discounts(seen: dict[int, int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from how many n-grams were counted 1, 2, 3 and 4 times.
    Where these leave one undefined or out of bounds (tiny or odd samples), half a count."""
    n = [0] + [seen.get(k, 0) for k in (1, 2, 3, 4)]
    share = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0
    out = [k - (k + 1) * share * n[k + 1] / n[k] if share and n[k] and n[k + 1] else 0.5 for k in (1, 2, 3)]
    return np.array([0.0] + [d if 0 < d < k else 0.5 for k, d in enumerate(out, 1)])


def learn(df: DataFrame, labels: DataFrame, text_col: str = "text", id_col: str = "doc_id", min_count: int = 2,
          min_pair_count: int = 2) -> Learned:
    """Learn from all the documents in ``labels`` (one row per id: ``id_col`` and ``label``, 0 or 1). Words of fewer documents than
    ``min_count`` are ``<unk>``; bigrams of fewer than ``min_pair_count`` give all their mass to the back-off."""
    spark = ship(df.sparkSession)
    counts = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if not counts.get(0) or not counts.get(1):
        share = 0.5 if not counts.get(0) and not counts.get(1) else float(bool(counts.get(1)))
        limit = np.clip(share, 1e-6, 1 - 1e-6)
        return Learned(None, None, None, np.array([np.log(limit / (1 - limit)), 0, 0, 0]))
    chosen = labels.where(F.col("label").isin(0, 1)).select(id_col, "label")
    part = F.pmod(F.xxhash64(F.lit("part"), F.col(id_col).cast("string")), F.lit(5)) == 0
    # The labels are the side that is hashed: no sort of the texts, and nothing that grows with the rows goes through the driver.
    labelled = stored(df.select(id_col, F.col(text_col).alias("text")).join(chosen.hint("shuffle_hash"), id_col)
                    .select("label", part.alias("apart"), "text"), "toxicity-labelled")
    fit_on = labelled.where(~F.col("apart")).select("label", "text")

    def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: Counter = Counter()
            for piece in slices(batch):
                for text in piece.column(1).to_pylist():
                    n.update(set(WORDS.findall(text.lower())) if text else ())
            yield pa.RecordBatch.from_pydict({"word": pa.array(n.keys(), pa.string()), "n": pa.array(n.values(), pa.int64())})

    words_at, counts_at, pairs_at = (shared_path(spark, f"toxicity-model-{part}") for part in ("words", "counts", "pairs"))
    write_parquet(fit_on.mapInArrow(count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
                  .where(F.col("n") >= min_count).select("word"), words_at)

    def count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = per_worker(words_at, lambda: numbered(words_at))
        for batch in batches:
            parts = {0: [np.zeros(0, np.int64)], 1: [np.zeros(0, np.int64)]}
            for piece in slices(batch):
                for label, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    w = word_ids(known, text)
                    if len(w):
                        parts[label].append(np.unique(np.concatenate(([START], w[:-1])) << 32 | w))
            for label, found in parts.items():
                pairs, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_pydict({"label": pa.array(np.full(len(pairs), label, np.int32)),
                                                  "pair": pa.array(pairs), "n": pa.array(n.astype(np.int64))})

    pairs = stored(fit_on.mapInArrow(count_pairs, "label int, pair long, n long")
                   .groupBy("pair").agg(*(F.sum(F.when(F.col("label") == c, F.col("n")).otherwise(0)).alias(f"n{c}") for c in (0, 1))),
                   "toxicity-pairs")
    sums = pairs.agg(F.sum("n0"), F.sum("n1")).first()
    seen = [pairs.where(F.col(f"n{c}").between(1, 4)).groupBy(F.col(f"n{c}").alias("n")).count().collect() for c in (0, 1)]
    pair_discounts = [discounts({r["n"]: r["count"] for r in rows}) for rows in seen]
    second = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("w")
    first = F.shiftright("pair", 32).alias("v")
    kept = F.col("n0") + F.col("n1") >= min_pair_count
    cuts = [F.when(~kept, F.col(f"n{c}").cast("double")).when(F.col(f"n{c}") == 0, 0.0).when(F.col(f"n{c}") == 1, float(d[1]))
            .when(F.col(f"n{c}") == 2, float(d[2])).otherwise(float(d[3])) for c, d in enumerate(pair_discounts)]
    by_word = pairs.groupBy(second).agg(F.sum("n0").alias("c0"), F.sum("n1").alias("c1"), F.count("*").alias("contexts"))
    by_first = pairs.groupBy(first).agg(F.sum(F.col("n0") + F.col("n1")).alias("n"), F.sum(cuts[0] + cuts[1]).alias("cut"))
    each = by_word.withColumnRenamed("w", "v").join(by_first, "v", "full")
    write_parquet(each.select(F.col("v").alias("w"), *(F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c)
                                                       for c in ("c0", "c1", "contexts", "n", "cut"))), counts_at)
    size = spark.read.schema("word string").parquet(words_at).count() + 2
    both = [sums[c] or 0 for c in (0, 1)]

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word_p, total, back = per_worker(counts_at, lambda: word_tables(counts_at, size))
        for batch in batches:
            keys = batch.column(0).to_numpy()
            v, w = keys >> 32, keys & 0xFFFFFFFF
            p = []
            for c in (0, 1):
                n = batch.column(1 + c).to_numpy()
                in_class = np.maximum(total[v], 1) * (both[c] or 1) / max(1, sum(both))
                p.append((n - pair_discounts[c][np.minimum(n, 3)]) / in_class + back[v] * word_p[c][w])
            value = np.log(p[1]) - np.log(p[0]) - (np.log(word_p[1][w]) - np.log(word_p[0][w]))
            yield pa.RecordBatch.from_pydict({"pair": batch.column(0), "value": pa.array(value)})

    # Bigrams of two documents or more, each once, in order: workers look them up by halving.
    write_parquet(pairs.where(kept).repartitionByRange("pair").sortWithinPartitions("pair").mapInArrow(rate, "pair long, value double"), pairs_at)
    model = Learned(words_at, counts_at, pairs_at, np.zeros(4))
    apart = stored(add_evidence(labelled.where("apart"), model).select("label", "evidence.*"), "toxicity-apart")  # four numbers a row
    discard(labelled, pairs)
    weights = _fit_logistic(apart, counts)
    discard(apart)
    return model._replace(weights=weights)


def add_evidence(df: DataFrame, model: Learned, text_col: str = "text") -> DataFrame:
    """Add ``evidence``: ratio, level and excess per word, and the score. A column of that name is replaced."""
    ship(df.sparkSession)
    key = f"toxicity-{uuid.uuid4().hex}"

    def measured(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        loaded = per_worker(key, model.load)
        for texts in batches:
            x = np.array([evidence(loaded, word_ids(loaded.words, t)) for piece in slices(texts) for t in piece.to_pylist()],
                         float).reshape(-1, 3)
            yield pa.StructArray.from_arrays([*(pa.array(x[:, k]) for k in range(3)), pa.array(logistic(loaded.weights, x))],
                                             ["ratio", "level", "excess", "score"])

    kind = "struct<ratio:double,level:double,excess:double,score:double>"
    return df.withColumn("evidence", F.arrow_udf(measured, kind)(F.col(text_col)))

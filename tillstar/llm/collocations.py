"""Operator 12: phrase collocation mining with Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words ``[^\\x20\\x09]+``. Everything is
counted for each language (null: ``und``); n is its words, f(phrase) the places, overlaps included, at which a phrase
stands inside a piece. The steps:

1. ``cut_chunks`` turns texts into chunks of one language and bounded bytes: the distinct words, and for each place the number of
   its word. They lie in files in the shared folder; what Spark moves are rows that say where.
2. Prefix polynomials over the words' 64-bit hashes give the fingerprint of every n-gram of a chunk as a difference, in numpy.
   A chunk sends each distinct fingerprint once, with its number of occurrences there; a shuffle by fingerprint
   sums them, and those of ``least`` occurrences or more go back to the chunks they came from, which are the pointers to
   their occurrences. First words, then pairs of frequent words, then level by level the n-grams whose first and last n - 1
   words are frequent. A phrase cannot be more frequent than a part of it, so nothing is lost.
3. Of the chunks that hold a frequent fingerprint the first writes out its phrase: only frequent phrases become text, each once.
4. Places that share a fingerprint must have the same words: a chunk compares its own places word by word, and every chunk sends
   another hash of language and words. Fingerprints with more than one hash are counted again by their text, in every chunk that holds
   one, so counts are exact when fingerprints collide.
5. ``score`` compares a candidate (2 to ``longest`` words, a = f(phrase) >= ``least``) with its cuts: after k words, l = f(first
   part) and r = f(rest) give floor(1000 * a * n / (l * r)), in 38-digit arithmetic. The lowest score counts, ties
   to the smallest k. A candidate is dropped if its words stand inside a longer candidate, dropped or not, that is as frequent.

What a shuffle sends for one fingerprint grows with the chunks, not with its occurrences. Null and empty texts and an empty table have no words.
Repeated rows count as often as they stand. Other columns are not read.

Recovery: a task writes its chunks to a file named after its attempt, and the rows that Spark commits name the files that count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import delete_folder, discard
from .common import release, shared_path, ship, slices, stored
from .warc_packages import file_system, open_for_reading

LEAST, LONGEST, TOP = 100, 5, 2000
CHUNK_BYTES = 16 << 20  # of one chunk, and three times that of all that a task has open
UNKNOWN = "und"
END = b"\xff"  # the end of a piece: a byte that no text holds
#: A-Z in lower case, the ends of pieces as END, tabs as spaces; other bytes as they are.
BYTES = bytes(b | 32 if 65 <= b <= 90 else 255 if 10 <= b <= 13 or b in b".,;:!?" else 32 if b == 9 else b for b in range(256))
CHUNKS = "chunk long, lang string, n long, file string, start long, words long, places long"
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
HASH_SEED = 42  # of the hash that tells phrases of one fingerprint apart


class Chunk:
    """Words of one language as they are gathered: numbers by first occurrence, 0 for the end of a piece."""

    def __init__(self):
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[END]
        self.parts: list[np.ndarray] = []
        self.bytes = 0

    def add(self, texts: list[str]) -> None:
        raw = END.join(t.encode().translate(BYTES) for t in texts)
        words = raw.replace(END, b" " + END + b" ").split()
        words.append(END)
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int32, len(words)))
        self.bytes += len(raw)

    def packed(self) -> tuple[int, bytes, bytes]:
        """The number of words, and, packed, the distinct words and the places' numbers."""
        places = np.concatenate(self.parts)
        words = b"\n".join(list(self.numbers)[1:])  # no word holds a line end
        return int(np.count_nonzero(places)), pack(words), pack(places.tobytes())


def pack(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unpack(raw: bytes) -> bytes:
    size = int.from_bytes(raw[:8], "little")
    return pa.decompress(raw[8:], size, "zstd", asbytes=True) if size else b""


def cut_chunks(df: DataFrame, text_col: str = "text", lang_col: str = "lang", chunk_bytes: int = CHUNK_BYTES,
               folder: str | None = None) -> DataFrame:
    """Chunks of words: chunk, lang, n (words), and where they lie, in files of ``folder`` (by default a new one): file, start,
    and the lengths of words and places."""
    folder = folder or shared_path(ship(df.sparkSession), "phrase-files")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        task, at, made, stream = TaskContext.get().partitionId(), 0, 0, None
        name = f"{folder}/chunks-{task:06d}-{uuid4().hex}"
        open_: dict[str, Chunk] = defaultdict(Chunk)

        def write(langs: list[str]) -> pa.RecordBatch:
            nonlocal at, made, stream
            if stream is None:
                system, inner = file_system(name)
                system.create_dir(inner.rpartition("/")[0], recursive=True)
                stream = system.open_output_stream(inner)
            rows = []
            for lang in langs:
                n, words, places = open_.pop(lang).packed()
                stream.write(words)
                stream.write(places)
                rows.append({"chunk": task << 32 | made, "lang": lang, "n": n, "file": name, "start": at, "words": len(words), "places": len(places)})
                at, made = at + len(words) + len(places), made + 1
            return pa.RecordBatch.from_pylist(rows)

        written = []  # rows leave when their file is closed; few, as chunks are large
        for batch in batches:
            for some in slices(batch):
                by_lang: dict[str, list[str]] = defaultdict(list)
                for text, lang in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                    by_lang[lang].append(text)
                for lang, texts in by_lang.items():
                    open_[lang].add(texts)
                    if open_[lang].bytes >= chunk_bytes:
                        written.append(write([lang]))
                if sum(c.bytes for c in open_.values()) >= 3 * chunk_bytes:
                    written.append(write(list(open_)))
        if open_:
            written.append(write(list(open_)))
        if stream is not None:
            stream.close()
        yield from written

    rows = df.where(F.length(text_col) > 0).select(F.col(text_col).cast("string"), F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)))
    return rows.mapInArrow(cut, CHUNKS)


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base, and of its inverse, modulo 2**64."""
    out = []
    for b in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(n, b, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(29))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Prints:
    """Fingerprints of a chunk's n-grams."""

    def __init__(self, lang: str, words: bytes, places: bytes):
        import xxhash

        self.places = np.frombuffer(unpack(places), np.int32)
        raw = unpack(words)
        self.words = [b"", *raw.split(b"\n")] if raw else [b""]
        self.seed = np.uint64(xxhash.xxh64_intdigest(lang.encode()))
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in self.words), np.uint64, len(self.words))
        n = 1 << max(10, (len(self.places) + 1).bit_length())  # a few sizes only, so that powers are computed once
        self.power, self.inverse = powers(n)
        with np.errstate(over="ignore"):
            self.sums = np.zeros(len(self.places) + 1, np.uint64)
            np.cumsum(self.hashes[self.places] * self.power[:len(self.places)], out=self.sums[1:])

    def at(self, starts: np.ndarray, n: int) -> np.ndarray:
        """Fingerprints of the n words from each start."""
        with np.errstate(over="ignore"):
            own = (self.sums[starts + n] - self.sums[starts]) * self.inverse[starts]
            return mixed(own + self.seed * np.uint64(2 * n + 1)).view(np.int64)

    def of_words(self) -> np.ndarray:
        """Fingerprints of the distinct words, that of number 0 included."""
        with np.errstate(over="ignore"):
            return mixed(self.hashes + self.seed * np.uint64(3)).view(np.int64)

    def frequent_words(self, known: np.ndarray) -> np.ndarray:
        """For each place, whether its word is frequent; never at the end of a piece."""
        own = member(self.of_words(), known)
        own[0] = False
        return own[self.places]

    def starts(self, known: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray]]:
        """For n from 2 up, the places at which n words stand whose first and last n - 1 are frequent."""
        one = self.frequent_words(known)
        run = np.flatnonzero(one[:-1] & one[1:])
        yield 2, run
        for n in range(3, longest + 1):
            run = run[member(self.at(run, n - 1), known)]
            frequent = np.zeros(len(one) + 1, bool)
            frequent[run] = True
            run = run[frequent[run + 1]]
            yield n, run


def member(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is among the sorted known ones."""
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


COUNTS = "print long, chunk long, k long"
KNOWN = "print long, chunk long, total long, first boolean"


def _counts(chunk: int, prints: np.ndarray, k: np.ndarray) -> pa.Table:
    return pa.table({"print": pa.array(prints, pa.int64()), "chunk": pa.array(np.full(len(prints), chunk), pa.int64()), "k": pa.array(k, pa.int64())})


def _read(row: dict) -> Prints:
    with open_for_reading(row["file"]) as file:
        raw = file.read_at(row["words"] + row["places"], row["start"])
    return Prints(row["lang"], raw[:row["words"]], raw[row["words"]:])


class Known(NamedTuple):
    """What a chunk is told of its frequent fingerprints, in their order."""

    prints: np.ndarray
    columns: dict[str, np.ndarray]

    @classmethod
    def of(cls, told: pa.Table) -> Known:
        columns = {c: told.column(c).to_numpy(zero_copy_only=False) for c in told.column_names}
        order = np.argsort(columns["print"], kind="stable")
        return cls(columns["print"][order].astype(np.int64), {c: v[order] for c, v in columns.items()})


def word_counts(chunks: DataFrame) -> DataFrame:
    """A row for each chunk and distinct word: print, chunk and k, its occurrences there."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for row in batch.to_pylist():
                prints = _read(row)
                k = np.bincount(prints.places, minlength=len(prints.words))[1:]
                yield from _counts(row["chunk"], prints.of_words()[1:], k).to_batches(max_chunksize=1 << 16)

    return spread(chunks).mapInArrow(count, COUNTS)


def spread(chunks: DataFrame) -> DataFrame:
    """Rows that only name chunks are too small for their number to decide on tasks."""
    return chunks.repartition(max(1, int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "chunk")


def gram_counts(chunks: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """Likewise for the n-grams that may be frequent, by what is known of the smaller ones."""

    def count(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        prints = _read(row)
        (starts,) = (s for size, s in prints.starts(Known.of(right).prints, n) if size == n)
        return _counts(row["chunk"], *np.unique(prints.at(starts, n), return_counts=True))

    return with_known(chunks, known, count, COUNTS)


def with_known(chunks: DataFrame, known: DataFrame, function, schema: str) -> DataFrame:
    """Each chunk's row together with what is known of its fingerprints; chunks without any are left out."""
    told = known.withColumnRenamed("chunk", "of")

    def call(left: pa.Table, right: pa.Table) -> pa.Table:
        return function(left, right) if left.num_rows and right.num_rows else empty

    empty = pa.table({c.split(" ")[0]: pa.array([], {"long": pa.int64(), "string": pa.string()}[c.split(" ")[1]]) for c in schema.split(", ")})
    return chunks.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(call, schema)


def frequent(counts: DataFrame, least: int) -> DataFrame:
    """The fingerprints with at least so many occurrences in all, by chunk: print, chunk, their total, and whether the chunk is
    the first that holds them."""
    same = Window.partitionBy("print")
    counts = counts.select("print", "chunk", F.sum("k").over(same).alias("total"), F.min("chunk").over(same).alias("least_chunk"))
    return counts.where(F.col("total") >= least).select("print", "chunk", "total", (F.col("chunk") == F.col("least_chunk")).alias("first"))


def phrases_at(prints: Prints, known: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """The chunk's phrases with known fingerprints: of some at a time, the fingerprints' places among the known ones, the phrases'
    occurrences, and their words. A fingerprint comes again for every other phrase that has it."""
    own = member(prints.of_words(), known)
    own[0] = False
    k = np.bincount(prints.places, minlength=len(prints.words))
    yield np.searchsorted(known, prints.of_words()[own]), k[own], [prints.words[i] for i in np.flatnonzero(own).tolist()]
    for n, starts in prints.starts(known, longest):
        at = prints.at(starts, n)
        there = member(at, known)
        for first, times in same_words(prints.places, starts[there], at[there], n):
            words = [b" ".join([prints.words[i] for i in w]) for w in prints.places[first[:, None] + np.arange(n)].tolist()]
            yield np.searchsorted(known, prints.at(first, n)), times, words


def written_out(chunks: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """For each chunk and phrase of a frequent fingerprint: print, and the phrase's ``hash``; the first chunk that holds the
    fingerprint adds lang, phrase and total."""

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        import xxhash

        row, told = left.to_pylist()[0], Known.of(right)
        seed = xxhash.xxh64_intdigest(row["lang"].encode(), HASH_SEED)
        first, total = told.columns["first"].astype(bool), told.columns["total"].astype(np.int64)
        out = []
        for at, _, words in phrases_at(_read(row), told.prints, longest):
            own = first[at]
            hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in words), np.uint64, len(words)).view(np.int64)
            out.append(pa.table({"print": pa.array(told.prints[at], pa.int64()), "hash": pa.array(hashes, pa.int64()),
                                 "lang": pa.array([row["lang"] if f else None for f in own.tolist()], pa.string()),
                                 "phrase": pa.array([w.decode() if f else None for f, w in zip(own.tolist(), words)], pa.string()),
                                 "total": pa.array(total[at], pa.int64(), mask=~own)}))
        return pa.concat_tables(out)

    return with_known(chunks, known, write, "print long, hash long, lang string, phrase string, total long")


def phrases_of(chunks: DataFrame, known: DataFrame, longest: int) -> DataFrame:
    """Every phrase of the known fingerprints, from every chunk: lang, phrase and k, its occurrences in the chunk."""

    def write(left: pa.Table, right: pa.Table) -> pa.Table:
        row, told = left.to_pylist()[0], Known.of(right)
        wanted = told.columns["wanted"].astype(bool)
        out = []
        for at, times, words in phrases_at(_read(row), told.prints, longest):
            out += [(row["lang"], words[i].decode(), times[i]) for i in np.flatnonzero(wanted[at]).tolist()]
        columns = list(zip(*out)) or [()] * 3
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("lang", "phrase", "k"), columns, (pa.string(), pa.string(), pa.int64()))})

    return with_known(chunks, known, write, "lang string, phrase string, k long")


def same_words(places: np.ndarray, starts: np.ndarray, prints: np.ndarray, n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A place of each distinct n-gram at these starts and its occurrences: grouped by fingerprint, then checked word by
    word; starts that differ from the first of their fingerprint are grouped again, among themselves."""
    while len(starts):
        _, first, inverse, times = np.unique(prints, return_index=True, return_inverse=True, return_counts=True)
        lead = starts[first][inverse]
        same = reduce(np.logical_and, (places[starts + j] == places[lead + j] for j in range(n)))
        if not same.all():
            times = np.bincount(inverse[same], minlength=len(first))
        yield starts[first], times
        starts, prints = starts[~same], prints[~same]


def settled(out: DataFrame, shared: DataFrame, chunks: DataFrame, known: DataFrame, least: int, longest: int) -> DataFrame:
    """The frequent phrases, lang, phrase and f: as written out, but those of ``shared`` fingerprints counted from the text."""
    phrases = out.where(F.col("phrase").isNotNull()).select("print", "lang", "phrase", F.col("total").alias("f"))
    if shared.isEmpty():
        return phrases.select("lang", "phrase", "f")
    marked = known.join(shared.withColumn("wanted", F.lit(True)), "print", "left")
    some = marked.where("wanted").select("chunk").distinct()
    # All that is frequent in these chunks leads to the places.
    told = marked.join(some, "chunk").select("print", "chunk", F.coalesce("wanted", F.lit(False)).alias("wanted"))
    apart = phrases_of(chunks.join(some, "chunk"), told, longest).groupBy("lang", "phrase").agg(F.sum("k").alias("f"))
    return phrases.join(shared, "print", "left_anti").select("lang", "phrase", "f").unionByName(apart.where(F.col("f") >= least))


def phrase_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST,
                  chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """Every phrase of 1 to ``longest`` words with ``least`` occurrences or more in a language (lang, phrase, f), and
    each language's words (lang, n). Both are stored."""
    files = shared_path(ship(df.sparkSession), "phrase-files")
    chunks = stored(cut_chunks(df, text_col, lang_col, chunk_bytes, files), "phrase-chunks")
    known = stored(frequent(word_counts(chunks), least), "frequent-words")
    done = [chunks, known]
    for n in range(2, longest + 1):
        more = stored(frequent(gram_counts(chunks, known, n), least), f"frequent-{n}-grams")
        known = known.unionByName(more)
        done.append(more)
    out = stored(written_out(chunks, known, longest), "phrases-written")
    done.append(out)
    shared = out.groupBy("print").agg(F.min("hash").alias("lo"), F.max("hash").alias("hi")).where("lo <> hi")
    shared = stored(shared.select("print"), "fingerprints-shared")
    done.append(shared)
    phrases = settled(out, shared, chunks, known, least, longest)
    found = stored(phrases, "phrases"), stored(chunks.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-words")
    discard(*done)
    delete_folder(df.sparkSession, files)
    return found


def score(phrases: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates with their lowest-scoring cut and without the dropped ones: lang, phrase, a, l, r, n, score."""
    candidates = phrases.withColumn("w", F.split("phrase", " ")).where(F.size("w") > 1)
    part = lambda start, length: F.array_join(F.slice("w", start, length), " ")
    cut = candidates.select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("cut"))
    cut = cut.select("lang", "phrase", "a", "cut", part(F.lit(1), F.col("cut")).alias("first"), part(F.col("cut") + 1, F.size("w")).alias("rest"))
    first = phrases.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rest = phrases.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cut.join(first, ["lang", "first"]).join(rest, ["lang", "rest"]).join(sizes, "lang")
    value = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct(value.alias("score"), "cut", "l", "r", "n")).alias("best"))
    # Parts of longer candidates, with the largest number of occurrences of one that holds them.
    inside = candidates.where(F.size("w") > 2).select("lang", "f", "w", F.explode(F.sequence(F.lit(2), F.size("w") - 1)).alias("length"))
    inside = inside.select("lang", "f", "w", "length", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("length") + 1)).alias("start"))
    inside = inside.select("lang", part(F.col("start"), F.col("length")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    kept = best.join(inside, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    return kept.select("lang", "phrase", "a", "best.l", "best.r", "best.n", "best.score")


def mine(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP,
         chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Each language's ``top`` collocations by score, then a, both descending, then phrase: lang, rank, phrase, a, l, r, n, score."""
    found = score(*phrase_counts(df, text_col, lang_col, least, longest, chunk_bytes))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")

"""Operator 11: alignment of two tokenizers' ids over the same bytes.

A text is encoded behind a space by a byte-level BPE vocabulary (A), and as it is by a SentencePiece model (B), which adds the space.
Token bytes are A's entry decoded from the byte-level alphabet; B's piece in UTF-8 with U+2581 as a space, and <0xHH> as
the byte HH. Where a token of A and one of B end at the same byte, both id lists are cut:

* the cumulative ends of each side go into a dictionary from end to index; the keys that both hold, sorted, are the
  cuts, and their indexes slice both id lists into groups;
* a link is a pair of token occurrences whose byte ranges end together: of each slice, the last of A and the last of B, since
  tokens are never empty and so no two tokens of a side end alike.

``align`` counts over the whole corpus how many links hold an (A id, B id) pair, and for each B id the highest of these
counts. Texts go in chunks of bounded bytes: a chunk sends each distinct pair once, with its number; a shuffle by pair
sums them, and the sums go back to the chunks that asked, so a pair that every text holds is a row per chunk, not per occurrence.

Special tokens' strings inside texts are plain text. Null and empty texts, and texts whose tokens' bytes of
either side do not spell them (a U+2581 in the text reads as a space), have no tokens: zeros, and an empty string of
groups. Repeated rows each get a row; an empty table gives none. Other columns are not read.

A's ids come from tiktoken, built from the JSON vocabulary itself: reading it checks that ids follow the order of merges and that
probe texts get the ids of the tokenizers library, which also encodes the few texts that tiktoken refuses.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import per_worker, ship, slices, stored

CHUNK_BYTES = 8 << 20
MARK = "▁"
PROBES = ("", " ", "a", " the  of\tand\n\n to", "'s I'll 12 345 6.7!?", "héllo wörld", "中文 x", "\U0001f600\U0001f601", "<|endoftext|> x",
          "\x00\x7f", "ab" * 40, " " * 37, "a\r\nb c")

# --- fixed values: how the byte-level vocabulary splits a text before merging ---
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG_PIECE = 5_000  # characters in a row, not cut by the pattern, that the library gets
# --- end of fixed values ---


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of byte-level entries stands for: printable ones for themselves, the others, in order,
    from U+0100 up."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteSide:
    """Ids and token bytes of a byte-level BPE vocabulary in the tokenizers library's JSON."""

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        model = json.loads(definition)["model"]
        letters = byte_alphabet()
        spelled = {bytes(letters[c] for c in entry): i for entry, i in model["vocab"].items() if all(c in letters for c in entry)}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ids = [model["vocab"][a + b] for a, b in merges]
        special = {t["id"] for t in json.loads(definition)["added_tokens"]}
        ranks = {b: i for b, i in spelled.items() if i not in special}
        if ids != sorted(ids) or len(ranks) != 256 + len(ids) or any(i >= 256 for b, i in ranks.items() if len(b) == 1):
            raise ValueError("ids do not follow the order of merges")
        self.library = Tokenizer.from_str(definition)
        self.library.encode_special_tokens = True
        self.fast = tiktoken.Encoding("byte-level", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spelled = [b""] * (max(ranks.values()) + 1)
        for b, i in ranks.items():
            self.spelled[i] = b
        for probe in PROBES:
            if self.fast.encode_ordinary(probe) != self._slow(probe):
                raise ValueError(f"the vocabulary encodes {probe!r} in another way")

    def _slow(self, text: str) -> list[int]:
        return self.library.encode(text, add_special_tokens=False).ids

    def encode(self, text: str) -> list[int]:
        # Merging takes tiktoken longer than linear in a piece, and its pattern can give up.
        if len(text) > LONG_PIECE and max(map(len, text.split()), default=0) > LONG_PIECE:
            return self._slow(text)
        try:
            return self.fast.encode_ordinary(text)
        except BaseException as e:  # the library raises an error class of its own, outside Exception
            if isinstance(e, (KeyboardInterrupt, SystemExit, GeneratorExit)):
                raise
            return self._slow(text)


class PieceSide:
    """Ids and token bytes of a SentencePiece model."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.spelled = []
        for i in range(self.processor.get_piece_size()):
            piece = self.processor.id_to_piece(i)
            if self.processor.is_byte(i):
                self.spelled.append(bytes([int(piece[3:5], 16)]))
            elif self.processor.is_control(i) or self.processor.is_unknown(i):
                self.spelled.append(b"")
            else:
                self.spelled.append(piece.replace(MARK, " ").encode())

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.processor.encode(texts, num_threads=1)


def common_ends(ends_a: list[int], ends_b: list[int]) -> tuple[list[int], list[int]]:
    """For each end that both lists hold, ascending, its index in each."""
    at_a, at_b = dict(zip(ends_a, range(len(ends_a)))), dict(zip(ends_b, range(len(ends_b))))
    both = sorted(at_a.keys() & at_b.keys())
    return list(map(at_a.__getitem__, both)), list(map(at_b.__getitem__, both))


class Alignment(NamedTuple):
    a: np.ndarray  # ids
    b: np.ndarray
    last_a: np.ndarray  # index of each group's last token
    last_b: np.ndarray

    def groups(self) -> list[tuple[list[int], list[int]]]:
        """Each group's ids of A and of B."""
        cuts_a, cuts_b = [0, *(self.last_a + 1).tolist()], [0, *(self.last_b + 1).tolist()]
        a, b = self.a.tolist(), self.b.tolist()
        return [(a[p:q], b[r:s]) for p, q, r, s in zip(cuts_a, cuts_a[1:], cuts_b, cuts_b[1:])]

    def links(self) -> np.ndarray:
        """The (A id, B id) pair of each link, as one number."""
        return self.a[self.last_a] << 32 | self.b[self.last_b]


class Aligner:
    def __init__(self, definition: str, model: bytes):
        self.a, self.b = ByteSide(definition), PieceSide(model)
        self.sizes_a = np.array([len(s) for s in self.a.spelled], np.int64)
        self.sizes_b = np.array([len(s) for s in self.b.spelled], np.int64)
        # Decimal ids as they end in the groups' text: within a group, and at the end of its side.
        self.decimals = [f"{i}{mark}".encode() for count, marks in ((len(self.sizes_a), ",|"), (len(self.sizes_b), ",;"))
                         for mark in marks for i in range(count)]

    def align(self, texts: list[str | None]) -> Iterator[Alignment | None]:
        """The alignment of each text; None for one without tokens."""
        some = [t for t in texts if t]
        of_b = iter(self.b.encode(some) if some else ())
        for text in texts:
            if not text:
                yield None
                continue
            a, b, raw = np.array(self.a.encode(" " + text), np.int64), next(of_b), b" " + text.encode()
            # A's tokens are cut from the text's own bytes, each of which is an entry, so their length tells whether all are there.
            ends_a = np.cumsum(self.sizes_a[a])
            if ends_a[-1] != len(raw) or b"".join(map(self.b.spelled.__getitem__, b)) != raw:
                yield None
                continue
            b = np.array(b, np.int64)
            last = common_ends(ends_a.tolist(), np.cumsum(self.sizes_b[b]).tolist())
            yield Alignment(a, b, *(np.array(x, np.int64) for x in last))

    def groups_text(self, found: Alignment) -> bytes:
        """``a1,a2|b1;a3|b2,b3``: the groups' decimal ids."""
        n_a, n_b = len(self.sizes_a), len(self.sizes_b)
        code_a, code_b = found.a.copy(), found.b + 2 * n_a
        code_a[found.last_a] += n_a
        code_b[found.last_b] += n_b
        # Before a token stand the other side's tokens of the groups before its own, and for B of its own.
        sizes_a, sizes_b = np.diff(found.last_a, prepend=-1), np.diff(found.last_b, prepend=-1)
        out = np.empty(len(code_a) + len(code_b), np.int64)
        of_b = np.zeros(len(out), bool)
        ends = np.cumsum(sizes_a + sizes_b)
        of_b[np.repeat(ends - sizes_b, sizes_b) + _within(sizes_b)] = True
        out[of_b], out[~of_b] = code_b, code_a
        return b"".join(map(self.decimals.__getitem__, out.tolist()))[:-1]


def _within(sizes: np.ndarray) -> np.ndarray:
    """0 up to each size, one run behind the other."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


DOCS = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()),
        ("groups_sha256", pa.string()), ("distinct", pa.int64())]
CHUNK_SCHEMA = pa.schema([("chunk", pa.int64()), *((name, pa.list_(kind)) for name, kind in DOCS), ("at", pa.list_(pa.int32())),
                          ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
CHUNKS = ("chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
          "groups_sha256 array<string>, distinct array<long>, at array<int>, times array<int>, pairs array<long>, counts array<long>")
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _chunk_batch(chunk: int, docs: list[tuple], pairs: list[np.ndarray], times: list[np.ndarray]) -> pa.RecordBatch:
    """A chunk's row: columns of its documents; the links' distinct pairs by document, as places in the chunk's own sorted pairs."""
    own, times_ = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (pairs, times))
    distinct, at = np.unique(own, return_inverse=True)
    counts = np.bincount(at, weights=times_, minlength=len(distinct)).astype(np.int64)
    columns = [pa.array([list(c)], pa.list_(kind)) for c, (_, kind) in zip(zip(*docs), DOCS)]
    wrap = lambda values, kind: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *columns, wrap(at.astype(np.int32), pa.int32()),
                                       wrap(times_.astype(np.int32), pa.int32()), wrap(distinct, pa.int64()), wrap(counts, pa.int64())],
                                      schema=CHUNK_SCHEMA)


def aligned_chunks(df: DataFrame, byte_bpe_path: str, piece_model_path: str, id_col: str, text_col: str, chunk_bytes: int) -> DataFrame:
    spark = ship(df.sparkSession)
    with open(byte_bpe_path, encoding="utf-8") as f, open(piece_model_path, "rb") as g:
        files = f.read(), g.read()
    Aligner(*files)  # fails here, on the driver, if the files are of another kind
    shared, key = spark.sparkContext.broadcast(files), f"align-{byte_bpe_path}-{piece_model_path}"  # two vocabularies, fixed by the files

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(key, lambda: Aligner(*shared.value))
        chunk = TaskContext.get().partitionId() << 32
        docs, pairs, times, held = [], [], [], 0
        for batch in batches:
            for some in slices(batch):
                texts = some.column(1).to_pylist()
                for doc_id, text, found in zip(some.column(0).to_pylist(), texts, aligner.align(texts)):
                    if found is None:
                        docs.append((doc_id, 0, 0, 0, 0, "", 0))
                    else:
                        own, k = np.unique(found.links(), return_counts=True)
                        docs.append((doc_id, len(found.a), len(found.b), len(found.last_a), len(found.last_a),
                                     hashlib.sha256(aligner.groups_text(found)).hexdigest(), len(own)))
                        pairs.append(own)
                        times.append(k)
                    held += 64 + len(text or "")
                    if held >= chunk_bytes:
                        yield _chunk_batch(chunk, docs, pairs, times)
                        chunk, docs, pairs, times, held = chunk + 1, [], [], [], 0
        if docs:
            yield _chunk_batch(chunk, docs, pairs, times)

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(aligned, CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """Links of each pair over the corpus, and whether that is the highest of its B id: pair, count, best."""
    zipped = F.arrays_zip(F.col("pairs").alias("pair"), F.col("counts").alias("n"))
    rows = chunks.select(F.inline(zipped).alias("pair", "n"))
    counts = rows.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    counts = stored(counts, "pair-counts")  # read twice
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align(df: DataFrame, byte_bpe_path: str, piece_model_path: str, id_col: str = "doc_id", text_col: str = "text",
          chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    chunks = stored(aligned_chunks(df, byte_bpe_path, piece_model_path, id_col, text_col, chunk_bytes), "aligned-chunks")
    asked = chunks.select(F.col("chunk").alias("to"), F.posexplode("pairs").alias("at", "pair"))
    told = asked.join(pair_counts(chunks), "pair").select("to", "at", "count", "best")
    names = [name for name, _ in DOCS]

    def summed(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = np.zeros(right.num_rows, np.int64), np.zeros(right.num_rows, np.int64)
        place = right.column("at").to_numpy()
        count[place], best[place] = right.column("count").to_numpy(), right.column("best").to_numpy(zero_copy_only=False)
        at, times = (left.column(c).combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("at", "times"))
        docs = {c: left.column(c).combine_chunks().flatten() for c in names}
        cuts = np.concatenate(([0], np.cumsum(docs["distinct"].to_numpy())))
        total = lambda x: np.diff(np.concatenate(([0], np.cumsum(x)))[cuts])
        return pa.table({"doc_id": docs["doc_id"], "n_a": docs["n_a"], "n_b": docs["n_b"], "n_groups": docs["n_groups"], "n_links": docs["n_links"],
                         "n_best": pa.array(total(best[at] * times)), "count_sum": pa.array(total(count[at] * times)),
                         "groups_sha256": docs["groups_sha256"]})

    own = chunks.select("chunk", *names, "at", "times")
    return own.groupBy("chunk").cogroup(told.groupBy("to")).applyInArrow(summed, RESULT)


def texts_aligned(spark: SparkSession, df: DataFrame, byte_bpe_path: str, piece_model_path: str, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """The groups themselves, per row: doc_id and groups, an array of structs of the A ids and the B ids (empty without tokens)."""
    ship(spark)
    with open(byte_bpe_path, encoding="utf-8") as f, open(piece_model_path, "rb") as g:
        shared = spark.sparkContext.broadcast((f.read(), g.read()))  # two vocabularies, fixed by the files
    key = f"align-{byte_bpe_path}-{piece_model_path}"
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = per_worker(key, lambda: Aligner(*shared.value))
        for batch in batches:
            for some in slices(batch):
                groups = [[{"a": a, "b": b} for a, b in found.groups()] if found else [] for found in aligner.align(some.column(1).to_pylist())]
                yield pa.RecordBatch.from_arrays([some.column(0), pa.array(groups, kind)], ["doc_id", "groups"])

    return df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        grouped, "doc_id long, groups array<struct<a:array<int>,b:array<int>>>")

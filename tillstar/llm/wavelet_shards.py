"""Operator 6: token ids as wavelet matrices, one succinct file record per shard.

Documents are range-partitioned and sorted by id, encoded with a byte-level BPE vocabulary, ended
with an end id each, and cut into shards of a bounded number of tokens (a single document may
exceed it: documents are never split). A shard's payload holds, after a header and the documents'
ids and lengths, one bit-plane per id bit with the number of zeros of the plane and a rank
directory (ones before every 512th bit). From the payload alone it answers access, counting
(rank) and occurrence lookup (select) without decoding, and can be decoded whole.

Payloads are rows of a Parquet folder, so Spark's commit protocol holds for them: a lost executor
leaves no half shard. ``part`` and ``seq`` give the order of shards.

Null and empty texts hold the end id only. Rows of equal doc_id stand side by side, ordered by
text; null ids come first. An empty table gives no shard.
"""

from __future__ import annotations

import json
import math
import os
import re
import string
import struct
import sys
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import per_worker, ship, slices, text_bytes

MAGIC = b"WMX1"
HEADER = struct.Struct("<4sBIQ")  # magic, planes, documents, tokens
BLOCK = 512  # bits for each entry of a rank directory
MEMO_PIECES = 500_000
CALL = 1024  # pieces that the library encodes as one text
OTHER_BLANKS = [c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace() and c not in " \n"]
STOPS = "".join(set(string.punctuation) - {"'"})  # neither letters nor digits; an apostrophe may open a contraction
SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
SHARD_SCHEMA = "part int, seq int, n_docs long, n_tokens long, payload binary"


class BitPlane:
    """Bits with constant-time rank and logarithmic select."""

    def __init__(self, packed: np.ndarray, n: int, directory: np.ndarray | None = None):
        self.n, self.packed = n, packed
        words = np.zeros(-(-n // 64) + BLOCK // 64 + 1, np.uint64)
        words.view(np.uint8)[: len(packed)] = packed
        self.words = words
        if directory is None:
            blocks = -(-n // BLOCK) + 1
            counts = np.bitwise_count(words[: (blocks - 1) * (BLOCK // 64)].reshape(blocks - 1, -1)).sum(1) if n else []
            directory = np.zeros(blocks, np.uint32)
            np.cumsum(counts, out=directory[1:])
        self.directory = directory

    def rank1(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        at = np.asarray(at, np.int64)
        block = at // BLOCK
        out = self.directory[block].astype(np.int64)
        word, last = block * (BLOCK // 64), at // 64
        for k in range(BLOCK // 64):
            whole = word + k < last
            out += np.where(whole, np.bitwise_count(self.words[word + k]), 0)
        part = (np.uint64(1) << (at % 64).astype(np.uint64)) - np.uint64(1)
        return out + np.bitwise_count(self.words[last] & part)

    def get(self, at: np.ndarray) -> np.ndarray:
        at = np.asarray(at, np.int64)
        return ((self.words[at // 64] >> (at % 64).astype(np.uint64)) & np.uint64(1)).astype(bool)

    def select(self, bit: int, k: int) -> int:
        """Position of the k-th (from 0) bit of that value."""
        low, high = 0, self.n
        while low < high:
            mid = (low + high) // 2
            ones = int(self.rank1(np.array([mid + 1]))[0])
            if (ones if bit else mid + 1 - ones) > k:
                high = mid
            else:
                low = mid + 1
        return low

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.packed, count=self.n, bitorder="little").view(bool)


class WaveletMatrix:
    def __init__(self, planes: list[BitPlane], n: int):
        self.planes, self.n = planes, n
        self.zeros = [n - int(p.directory[-1]) for p in planes]

    @classmethod
    def build(cls, ids: np.ndarray, levels: int) -> WaveletMatrix:
        planes, now = [], ids.astype(np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            bit = (now >> level & 1).astype(bool)
            planes.append(BitPlane(np.packbits(bit, bitorder="little"), len(now)))
            now = np.concatenate((now[~bit], now[bit]))
        return cls(planes, len(ids))

    def to_bytes(self) -> bytes:
        return b"".join(p.packed.tobytes() + p.directory.tobytes() for p in self.planes)

    @classmethod
    def from_buffer(cls, buffer: bytes, at: int, levels: int, n: int) -> WaveletMatrix:
        planes, size, blocks = [], -(-n // 8), -(-n // BLOCK) + 1
        for _ in range(levels):
            packed = np.frombuffer(buffer, np.uint8, size, at)
            planes.append(BitPlane(packed, n, np.frombuffer(buffer, np.uint32, blocks, at + size)))
            at += size + 4 * blocks
        return cls(planes, n)

    def access(self, at: np.ndarray) -> np.ndarray:
        """The ids at these positions."""
        at, value = np.asarray(at, np.int64), np.zeros(len(at), np.int64)
        for plane, zeros in zip(self.planes, self.zeros):
            bit, ones = plane.get(at), plane.rank1(at)
            value = value << 1 | bit
            at = np.where(bit, zeros + ones, at - ones)
        return value

    def _range(self, token: int, start: int, end: int) -> tuple[int, int]:
        for k, (plane, zeros) in enumerate(zip(self.planes, self.zeros)):
            ones = plane.rank1(np.array([start, end]))
            if token >> (len(self.planes) - 1 - k) & 1:
                start, end = zeros + int(ones[0]), zeros + int(ones[1])
            else:
                start, end = start - int(ones[0]), end - int(ones[1])
        return start, end

    def count(self, token: int, start: int = 0, end: int | None = None) -> int:
        """How often the token stands in positions start to end."""
        if token >> len(self.planes):
            return 0
        first, last = self._range(token, start, self.n if end is None else end)
        return last - first

    def occurrence(self, token: int, k: int) -> int:
        """Position of the token's k-th occurrence (from 0)."""
        first, _ = self._range(token, 0, self.n)
        at = first + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> (len(self.planes) - 1 - level) & 1
            at = self.planes[level].select(bit, at - self.zeros[level] if bit else at)
        return at

    def decode(self) -> np.ndarray:
        """All ids in order, by undoing the planes' stable partitions from the last to the first."""
        now = np.zeros(self.n, np.uint16 if len(self.planes) <= 16 else np.uint32)
        for level, (plane, zeros) in enumerate(zip(self.planes[::-1], self.zeros[::-1])):
            bit, out = plane.bits(), np.empty_like(now)
            out[np.flatnonzero(~bit)] = now[:zeros]
            out[np.flatnonzero(bit)] = now[zeros:] | now.dtype.type(1 << level)
            now = out
        return now.astype(np.uint32)


def pack_shard(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, levels: int) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    keys = np.array([d or 0 for d in doc_ids], np.int64)
    return b"".join((HEADER.pack(MAGIC, levels, len(doc_ids), len(ids)), known.tobytes(), keys.tobytes(),
                     np.array(lengths, np.uint64).tobytes(), WaveletMatrix.build(ids, levels).to_bytes()))


def unpack_shard(payload: bytes) -> tuple[list[int | None], np.ndarray, WaveletMatrix]:
    """Document ids, their lengths and the matrix of a payload."""
    magic, levels, docs, tokens = HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a wavelet shard")
    at = HEADER.size
    known = np.frombuffer(payload, np.uint8, docs, at)
    keys = np.frombuffer(payload, np.int64, docs, at + docs)
    lengths = np.frombuffer(payload, np.uint64, docs, at + 9 * docs)
    return ([int(k) if there else None for k, there in zip(keys, known)], lengths,
            WaveletMatrix.from_buffer(payload, at + 17 * docs, levels, tokens))


class ByteBpe:
    """Encoding with the tokenizers library, pieces memoised (bounded, two generations).

    A space between two non-space characters always starts a pre-token, and a single line break between
    them is one, so texts are cut there and a piece's ids do not depend on its neighbours. A piece of
    letters is one pre-token, and so are stops after it; these skip the pre-tokenizer's pattern, several
    pieces to a call, and are told apart by the tokens that open with a space, and runs of stops are encoded once. Any other
    piece goes through the whole tokenizer, and so do texts with a null character, the marker used here."""

    FIRST = "\0"  # marks a text's first piece, which has no space before it

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_str(definition)
        self.pieces = Tokenizer.from_str(definition)
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.CharDelimiterSplit("\n"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.whole.get_vocab(with_added_tokens=True)
        self.opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self.opens[[i for piece, i in vocabulary.items() if piece.startswith("Ġ")]] = True
        # Without stops where a token of its own could begin in the letters or end in the run.
        added = [t["content"] for t in json.loads(definition)["added_tokens"]]
        self.stop = "" if any(not t.strip(STOPS) or t.rstrip(STOPS).isalpha() for t in added) else STOPS
        self.stops: dict[str, bytes] = {}
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.whole.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, missing: set[str]) -> None:
        stems, stopped, odd = set(), [], []
        for p in missing:
            bare = p[1:] if p[0] == self.FIRST else p
            if bare.isalpha():
                stems.add(p)
            elif (stem := bare.rstrip(self.stop)).isalpha():
                stem = p[:len(p) - len(bare) + len(stem)]
                stopped.append((p, stem, p[len(stem):]))
                if stem not in self.memo:
                    stems.add(stem)
            else:
                odd.append(p)
        keys = list(stems)
        # A first piece is encoded behind a space on its own, whose token is cut off again.
        plain = [" \n" + p[1:] if p[0] == self.FIRST else " " + p for p in keys]
        joined = ["\n".join(plain[i:i + CALL]) for i in range(0, len(plain), CALL)]
        for k, encoded in enumerate(self.pieces.encode_batch_fast(joined, add_special_tokens=False)):
            ids = np.array(encoded.ids, np.uint32)
            starts = (4 * np.flatnonzero(self.opens[ids])).tolist()
            raw = ids.tobytes()
            group = keys[CALL * k:CALL * (k + 1)]
            if len(starts) != len(group):
                raise ValueError("a token other than a piece's first opens with a space")
            self.memo.update(zip(group, map(raw.__getitem__, map(slice, starts, [*starts[1:], len(raw)]))))
        for p in keys:
            if p[0] == self.FIRST:
                self.memo[p] = self.memo[p][4:]
        new = list({run for _, _, run in stopped}.difference(self.stops))
        if len(self.stops) + len(new) > MEMO_PIECES:
            self.stops.clear()
            new = list({run for _, _, run in stopped})
        self.stops.update(zip(new, self._whole(new)))
        for p, stem, run in stopped:
            self.memo[p] = self.memo[stem] + self.stops[run]
        self.memo.update(zip(odd, self._whole([
            p if p == "\n" else p[1:] if p[0] == self.FIRST else " " + p for p in odd])))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        cut, nulls = [], {}
        for k, text in enumerate(texts):
            if not text or self.FIRST in text:
                cut.append([])
                if text:
                    nulls[k] = self._whole([text])[0]
            elif (text[0] in " \n" or text[-1] in " \n" or "  " in text or "\n " in text or " \n" in text
                  or "\n\n" in text or any(map(text.__contains__, OTHER_BLANKS))):
                pieces = SAFE_SPACE.split(text)
                pieces[0] = self.FIRST + pieces[0]
                cut.append(pieces)
            else:
                cut.append((self.FIRST + text.replace("\n", " \n " + self.FIRST)).split(" "))
        if len(self.memo) > MEMO_PIECES:
            self.older, self.memo = self.memo, {}
        missing = set().union(*cut).difference(self.memo)
        for p in missing.intersection(self.older):
            self.memo[p] = self.older[p]
        self._learn(missing.difference(self.memo))
        get = self.memo.__getitem__
        out = [b"".join(map(get, pieces)) for pieces in cut]
        for k, ids in nulls.items():
            out[k] = ids
        return out


def write_shards(df: DataFrame, path: str, tokenizer_path: str, end_id: int, text_col: str = "text",
                 id_col: str = "doc_id", partition_bytes: int = 16 << 20, shard_tokens: int = 2_000_000) -> None:
    """Encode ``text_col`` in ascending ``id_col`` order and write the shards to ``path``."""
    spark = ship(df.sparkSession)
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    vocabulary = json.loads(definition)
    top = max([end_id, *vocabulary["model"]["vocab"].values(), *(t["id"] for t in vocabulary["added_tokens"])])
    levels = top.bit_length()
    shared, key = spark.sparkContext.broadcast(definition), uuid.uuid4().hex  # a vocabulary, fixed by the file
    end = np.array([end_id], np.uint32).tobytes()
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    parts = max(1, math.ceil(text_bytes(rows) / partition_bytes))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = per_worker(f"byte-{key}", lambda: ByteBpe(shared.value))
        part, seq = TaskContext.get().partitionId(), 0
        docs: list[int | None] = []
        lengths: list[int] = []
        parts_ids: list[bytes] = []
        tokens = 0

        def shard() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(parts_ids), np.uint32)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "seq": pa.array([seq], pa.int32()),
                 "n_docs": pa.array([len(docs)], pa.int64()), "n_tokens": pa.array([tokens], pa.int64()),
                 "payload": pa.array([pack_shard(docs, lengths, ids, levels)], pa.binary())})

        for batch in batches:
            for some in slices(batch, 512):
                for doc, ids in zip(some.column(0).to_pylist(), bpe.encode(some.column(1).to_pylist())):
                    ids += end
                    if docs and tokens + len(ids) // 4 > shard_tokens:
                        yield shard()
                        seq += 1
                        docs, lengths, parts_ids, tokens = [], [], [], 0
                    docs.append(doc)
                    lengths.append(len(ids) // 4)
                    parts_ids.append(ids)
                    tokens += len(ids) // 4
        if docs:
            yield shard()

    (rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(shards, SHARD_SCHEMA).write.parquet(path))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard: part, seq, n_docs, n_tokens and ``start``, the tokens of all shards before.

    Sums run inside each part and over the parts' totals, so the only single task sees a row per part.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "n_docs", "n_tokens")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = shards.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    bases = totals.select("part", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (shards.withColumn("inner", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(bases, "part").select("part", "seq", "n_docs", "n_tokens", (F.col("base") + F.col("inner")).alias("start")))


def read_documents(spark: SparkSession, path: str, crc_only: bool = False) -> DataFrame:
    """Decode the shards: one row per document with doc_id, start, n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers) and, unless ``crc_only``, the ids themselves."""
    ship(spark)
    schema = "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long" + (
        "" if crc_only else ", ids array<int>")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(k).to_pylist() for k in range(3))):
                docs, lengths, matrix = unpack_shard(payload)
                ids = matrix.decode()
                ends = np.cumsum(lengths.astype(np.int64))
                starts = ends - lengths.astype(np.int64)
                raw = memoryview(ids.tobytes())
                columns = {"part": pa.array([part] * len(docs), pa.int32()), "seq": pa.array([seq] * len(docs), pa.int32()),
                           "doc_id": pa.array(docs, pa.int64()), "local": pa.array(starts),
                           "n_tokens": pa.array(lengths.astype(np.int64)),
                           "ids_crc32": pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(starts, ends)], pa.int64())}
                if not crc_only:
                    columns["ids"] = pa.ListArray.from_arrays(
                        pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(ids.astype(np.int32)))
                yield pa.RecordBatch.from_pydict(columns)

    rows = spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "payload").mapInArrow(decoded, schema)
    return (rows.join(read_index(spark, path).select("part", "seq", F.col("start").alias("base")), ["part", "seq"])
            .select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32",
                    *([] if crc_only else ["ids"])))


def count_token(spark: SparkSession, path: str, token: int) -> DataFrame:
    """Occurrences of a token in each shard, by rank alone: part, seq, n."""
    ship(spark)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, seq, payloads = (batch.column(k).to_pylist() for k in range(3))
            yield pa.RecordBatch.from_pydict(
                {"part": pa.array(part, pa.int32()), "seq": pa.array(seq, pa.int32()),
                 "n": pa.array([unpack_shard(p)[2].count(token) for p in payloads], pa.int64())})

    return (spark.read.schema(SHARD_SCHEMA).parquet(path).select("part", "seq", "payload")
            .mapInArrow(counted, "part int, seq int, n long"))

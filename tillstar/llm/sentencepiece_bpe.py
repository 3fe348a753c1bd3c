"""Operator 4: exact merge-type SentencePiece encoding by backtracking, and decoding.

A text is encoded by taking, at each position, the longest vocabulary match (one Aho-Corasick
pass finds all matches) and accepting it only if it is compatible with the token before it:
re-merging the two pieces' characters by merge order must give these two tokens again. When no
match fits, the position is marked as failed in a bitfield and the previous token is replaced
by its next shorter match. The result equals the merge algorithm's.

Exactness of the details:

* The model must have identity normalisation, a dummy prefix and byte fallback (checked against
  probe texts when the vocabulary is read). No piece holds the space mark after another
  character, so merges never cross the start of a run of space marks, and each such chunk is
  encoded alone (and memoised, bounded).
* Pieces made of space marks alone share one score, an order that pairwise compatibility does
  not determine; chunks with two or more marks in a row are merged directly.
* Characters in no piece become UTF-8 byte tokens and separate what stands on either side.

Null and empty texts give an empty id list. Decoding joins pieces, turns space marks into
spaces, drops the dummy prefix's space, and reads runs of byte tokens as UTF-8 (U+FFFD for each
byte that is not valid); null ids decode to an empty text.
"""

from __future__ import annotations

import heapq
import re
import uuid
from array import array
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import TwoGenerations, per_worker, ship, slices

MARK = "▁"
MEMO_CHUNKS = 150_000
MEMO_CHARACTERS = 40  # longer chunks are not kept, so that the memo is bounded in bytes as well
MEMO_PAIRS = 400_000
CHUNKS = re.compile(f"{MARK}+[^{MARK}]*")
PROBES = ("", " ", "a", " a", "a  b", "a\nb", "\ta b ", f"{MARK}a", "héllo wörld", "中文 x",
          "\U0001f600\U0001f601", "<s> </s> <0x0A>", "the  quick   brown    fox", "\x00", "ab" * 40, " " * 37)


class Vocabulary(NamedTuple):
    """What encoding and decoding need of a model; its size is the vocabulary's."""

    pieces: list[str]  # text of each id; "" for control ids
    scores: dict[str, float]  # of mergeable pieces
    ids: dict[str, int]
    reachable: frozenset[str]  # pieces that their own text encodes to
    byte_ids: list[int]
    unknown_id: int


def merged(vocab: Vocabulary, text: str) -> list[str]:
    """The merge algorithm itself: join the adjacent pair of highest score, leftmost first."""
    symbols: list[str] = list(text)
    after = list(range(1, len(symbols) + 1))
    before = list(range(-1, len(symbols) - 1))
    scores, heap, end = vocab.scores, [], len(symbols)

    def offer(left: int, right: int) -> None:
        joined = symbols[left] + symbols[right]
        score = scores.get(joined)
        if score is not None:
            heapq.heappush(heap, (-score, left, right, joined))

    for i in range(end - 1):
        offer(i, i + 1)
    while heap:
        _, left, right, joined = heapq.heappop(heap)
        if not symbols[left] or not symbols[right] or after[left] != right or symbols[left] + symbols[right] != joined:
            continue
        symbols[left], symbols[right] = joined, ""
        after[left] = after[right]
        if after[right] < end:
            before[after[right]] = left
            offer(left, after[left])
        if before[left] >= 0:
            offer(before[left], left)
    return [s for s in symbols if s]


def read_vocabulary(model_path: str) -> Vocabulary:
    """Read a model's pieces on the driver, and check that it is of the kind encoded here."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    n = sp.get_piece_size()
    special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)}
    plain = [i for i in range(n) if i not in special]
    text = [sp.id_to_piece(i) for i in range(n)]
    if any(MARK in text[i].lstrip(MARK) for i in plain):
        raise ValueError("a piece holds a space mark after another character")
    if not {c for i in plain for c in text[i]} <= {text[i] for i in plain}:
        raise ValueError("a character inside a piece is no piece itself")
    vocab = Vocabulary(["" if i in special else text[i] for i in range(n)], {text[i]: sp.get_score(i) for i in plain},
                       {text[i]: i for i in plain}, frozenset(), [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)],
                       sp.unk_id())
    vocab = vocab._replace(reachable=frozenset(p for p in vocab.ids if merged(vocab, p) == [p]))
    encoder = Encoder(vocab)
    for probe in PROBES:
        if encoder.encode(probe) != sp.encode(probe):
            raise ValueError(f"the model encodes {probe!r} in another way: not a merge model with "
                             "identity normalisation, dummy prefix and byte fallback")
    return vocab


class Encoder:
    def __init__(self, vocab: Vocabulary):
        import ahocorasick

        self.vocab = vocab
        self.automaton = ahocorasick.Automaton()
        for piece in vocab.reachable:
            self.automaton.add_word(piece, vocab.ids[piece])
        self.automaton.make_automaton()
        self.sizes = [len(p) for p in vocab.pieces]
        # The next shorter match at a token's start: the longest piece that begins it.
        self.shorter = [-1] * len(vocab.pieces)
        for piece in vocab.reachable:
            begins = next((piece[:k] for k in range(len(piece) - 1, 0, -1) if piece[:k] in vocab.reachable), None)
            self.shorter[vocab.ids[piece]] = -1 if begins is None else vocab.ids[begins]
        self.alphabet = frozenset(p for p in vocab.ids if len(p) == 1)
        self.joints = frozenset(p[i:i + 2] for p in vocab.ids for i in range(len(p) - 1))
        self.pairs: dict[int, bool] = {}
        self.chunks = TwoGenerations(self._chunk_bytes, MEMO_CHUNKS)

    def compatible(self, left: int, right: int) -> bool:
        key = left << 32 | right
        found = self.pairs.get(key)
        if found is None:
            a, b = self.vocab.pieces[left], self.vocab.pieces[right]
            # Where no piece holds the two characters at the border side by side, no merge crosses it.
            found = a[-1] + b[0] not in self.joints or merged(self.vocab, a + b) == [a, b]
            if len(self.pairs) >= MEMO_PAIRS:
                self.pairs.clear()
            self.pairs[key] = found
        return found

    def backtrack(self, text: str) -> list[int]:
        """Ids of a text of known characters without two space marks in a row."""
        pairs, sizes, shorter = self.pairs, self.sizes, self.shorter
        n, at, longest, fits = len(text), 0, {}, True
        for _, token in self.automaton.iter_long(text):  # the longest match, and from its end again
            longest[at] = token
            at += sizes[token]
        path = list(longest.values())
        # Mostly these fit one behind the other.
        for left, right in zip(path, path[1:]):
            ok = pairs.get(left << 32 | right)
            if not (ok or ok is None and self.compatible(left, right)):
                fits = False
                break
        if fits and at == n:
            return path
        failed = bytearray((n >> 3) + 1)
        tokens: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            while token >= 0:
                end = at + sizes[token]
                if not failed[end >> 3] >> (end & 7) & 1:
                    if not tokens:
                        break
                    ok = pairs.get(tokens[-1] << 32 | token)
                    if ok or ok is None and self.compatible(tokens[-1], token):
                        break
                token = shorter[token]
            if token >= 0:
                tokens.append(token)
                at = end
                if at < n:
                    token = longest.get(at, -1)
                    if token < 0:
                        token = longest[at] = next(self.automaton.iter_long(text, at))[1]
            elif tokens:
                failed[at >> 3] |= 1 << (at & 7)
                token = tokens.pop()
                at -= sizes[token]
                token = shorter[token]
            else:
                raise ValueError(f"no tokens spell {text!r}")
        return tokens

    def encode_chunk(self, chunk: str) -> list[int]:
        known = self.alphabet.issuperset(chunk)
        if known and MARK + MARK not in chunk:
            return self.backtrack(chunk)
        out: list[int] = []
        for part in [chunk] if known else self._parts(chunk):
            if part not in self.alphabet and len(part) == 1:
                out += [self.vocab.byte_ids[b] for b in part.encode("utf-8", "surrogatepass")]
            elif MARK + MARK in part:
                out += [self.vocab.ids[p] for p in merged(self.vocab, part)]
            else:
                out += self.backtrack(part)
        return out

    def _parts(self, chunk: str) -> Iterator[str]:
        """The chunk's runs of known characters, and its unknown characters one by one."""
        start = 0
        for i, c in enumerate(chunk):
            if c not in self.alphabet:
                if start < i:
                    yield chunk[start:i]
                yield c
                start = i + 1
        if start < len(chunk):
            yield chunk[start:]

    def _chunk_bytes(self, rest: str) -> bytes:
        # Where no piece holds the last two characters side by side, the last one is a token of its own.
        end, known = len(rest), self.alphabet
        while end > 1 and rest[end - 2:end] not in self.joints and rest[end - 1] in known and rest[end - 2] in known:
            end -= 1
        if end < len(rest):
            own = self.chunks[rest[:end]] if end <= MEMO_CHARACTERS else self._chunk_bytes(rest[:end])
            return own + array("i", map(self.vocab.ids.__getitem__, rest[end:])).tobytes()
        return array("i", self.encode_chunk(MARK + rest)).tobytes()

    def encode_bytes(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers."""
        if not text:
            return b""
        if "  " in text or MARK in text or text[0] == " " or text[-1] == " ":
            chunks = [c[1:] for c in CHUNKS.findall(MARK + text.replace(" ", MARK))]
        else:
            chunks = text.split(" ")
        if len(text) > MEMO_CHARACTERS and max(map(len, chunks)) > MEMO_CHARACTERS:
            return b"".join([self.chunks[c] if len(c) <= MEMO_CHARACTERS else self._chunk_bytes(c) for c in chunks])
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str | None) -> list[int]:
        return np.frombuffer(self.encode_bytes(text), np.int32).tolist()


class Decoder:
    def __init__(self, vocab: Vocabulary):
        self.raw = [p.replace(MARK, " ").encode("utf-8", "surrogatepass") for p in vocab.pieces]
        # A control id ends a run of bytes: this byte, never valid, sends its text to the slower path.
        self.raw = [r or b"\xff" for r in self.raw]
        self.raw[vocab.unknown_id] = " ⁇ ".encode()
        self.marked = [p.startswith(MARK) for p in vocab.pieces]
        self.byte = {i: bytes([b]) for b, i in enumerate(vocab.byte_ids)}
        for i, b in self.byte.items():
            self.raw[i] = b

    def decode(self, ids: list[int]) -> str:
        joined = b"".join(map(self.raw.__getitem__, ids))
        try:
            text = joined.decode("utf-8")
        except UnicodeDecodeError:
            text = self._with_bad_bytes(ids)
        first = next((i for i in ids if self.raw[i] != b"\xff" or i in self.byte), None)
        return text[1:] if first is not None and self.marked[first] else text

    def _with_bad_bytes(self, ids: list[int]) -> str:
        out, run = [], b""
        for i in [*ids, None]:
            if i in self.byte:
                run += self.byte[i]
                continue
            while run:
                for size in (1, 2, 3, 4):
                    try:
                        out.append(run[:size].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        continue
                else:
                    size = 1
                    out.append("�")
                run = run[size:]
            if i is not None:
                out.append("" if self.raw[i] == b"\xff" else self.raw[i].decode("utf-8"))
        return "".join(out)


class SentencePieceBpe:
    """Spark columns for encoding and decoding with one model, whose path is a parameter."""

    def __init__(self, spark: SparkSession, model_path: str):
        self.vocab = read_vocabulary(model_path)
        self.shared = ship(spark).sparkContext.broadcast(self.vocab)  # a vocabulary, fixed by the model
        self.key = uuid.uuid4().hex

    def encode(self, df: DataFrame, text_col: str = "text", out: str = "ids") -> DataFrame:
        """Add ``out``: array<int> of the text's ids."""
        shared, key = self.shared, self.key

        def encode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = per_worker(f"encode-{key}", lambda: Encoder(shared.value))
            for texts in batches:
                ids = [encoder.encode_bytes(t) for part in slices(texts) for t in part.to_pylist()]
                offsets = np.zeros(len(ids) + 1, np.int64)
                np.cumsum([len(b) >> 2 for b in ids], out=offsets[1:])
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(ids))])
                yield pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)

        return df.withColumn(out, F.arrow_udf(encode_batches, "array<int>")(F.col(text_col)))

    def decode(self, df: DataFrame, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
        """Add ``out``: the text of the ids."""
        shared, key = self.shared, self.key

        def decode_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            decoder = per_worker(f"decode-{key}", lambda: Decoder(shared.value))
            for lists in batches:
                offsets = lists.offsets.to_numpy() if len(lists) else np.zeros(1, np.int32)
                flat = lists.values.to_numpy()
                yield pa.array([decoder.decode(flat[a:b].tolist()) for a, b in zip(offsets, offsets[1:])], pa.string())

        return df.withColumn(out, F.arrow_udf(decode_batches, "string")(F.col(ids_col)))

    def round_trip(self, df: DataFrame, text_col: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
        """Add both: the text's ids, and the text decoded from them, in one pass through Python. Columns of these names are
        replaced, and one named ``__both`` is lost."""
        shared, key = self.shared, self.key

        def there_and_back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder, decoder = per_worker(f"both-{key}", lambda: (Encoder(shared.value), Decoder(shared.value)))
            for texts in batches:
                raw = [encoder.encode_bytes(t) for part in slices(texts) for t in part.to_pylist()]
                offsets = np.zeros(len(raw) + 1, np.int64)
                np.cumsum([len(b) >> 2 for b in raw], out=offsets[1:])
                values = pa.Array.from_buffers(pa.int32(), int(offsets[-1]), [None, pa.py_buffer(b"".join(raw))])
                back = pa.array([decoder.decode(np.frombuffer(b, np.int32).tolist()) for b in raw], pa.string())
                yield pa.StructArray.from_arrays(
                    [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values), back], ["ids", "decoded"])

        both = df.withColumn("__both", F.arrow_udf(there_and_back, "struct<ids:array<int>,decoded:string>")(F.col(text_col)))
        return both.withColumns({ids: F.col("__both.ids"), decoded: F.col("__both.decoded")}).drop("__both")

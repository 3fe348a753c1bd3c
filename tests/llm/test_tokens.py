"""Operators 4 and 6 against the tokenizer libraries, and round trips."""

import random
import zlib

import numpy as np
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
tokenizers = pytest.importorskip("tokenizers")

from tillstar.llm import sentencepiece_bpe as S
from tillstar.llm import wavelet_shards as W
from tillstar.llm.common import shared_path, tokenizer_path

from samples import EDGE

PIECES = ["ab", "  ", "\n", " ", "\t", "é", "日", "😀", "'s", "the", "<|endoftext|>", "12", "...", "\xa0", "\x1c", "▁", " x", "thing", ",", "<s>", "\0"]


def texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(PIECES) for _ in range(rnd.randrange(0, 16))) for _ in range(n)]


@pytest.fixture(scope="module")
def vocab():
    return S.read_vocabulary(tokenizer_path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def test_encoding_and_decoding_equal_the_library(vocab, library):
    encoder, decoder = S.Encoder(vocab), S.Decoder(vocab)
    for t in texts(3000) + [r[1] or "" for r in EDGE]:
        ids = library.encode(t)
        assert encoder.encode(t) == ids
        assert decoder.decode(ids) == library.decode(ids)


def test_long_runs_without_a_space_equal_the_library(vocab, library):
    rnd, encoder = random.Random(11), S.Encoder(vocab)
    han = sorted(c for c in encoder.alphabet if "\u4e00" <= c <= "\u9fff")
    runs = ["".join(rnd.choice(pool) for _ in range(10_000)) for pool in ("0123456789", han, han + list("12ab\u00e9\U0001f600\u9fa5"))]
    for t in runs + [r + " the " + r[:700] + "the" for r in runs]:
        assert encoder.encode(t) == library.encode(t)
    assert len(encoder.chunks) < 30


def test_decoding_of_any_ids(vocab, library):
    rnd, decoder = random.Random(5), S.Decoder(vocab)
    pool = [0, 1, 2, 3 + 195, 3 + 169, 3 + 240, 3 + 159, 3 + 152, 3 + 128, 28705, 259, 264, 13, 500]
    for _ in range(3000):
        ids = [rnd.choice(pool) for _ in range(rnd.randrange(0, 7))]
        if 1 not in ids and 2 not in ids:
            assert decoder.decode(ids) == library.decode(ids)


def test_backtracking_equals_merging(vocab):
    rnd, encoder = random.Random(7), S.Encoder(vocab)
    letters = "etaoinshrdlu"
    for _ in range(2000):
        chunk = "▁" + "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 14)))
        assert encoder.backtrack(chunk) == [vocab.ids[p] for p in S.merged(vocab, chunk)]


def test_spark_columns(edge, nothing, library):
    bpe = S.SentencePieceBpe(edge.sparkSession, tokenizer_path("piece_bpe_32k.model"))
    rows = bpe.decode(bpe.encode(edge, out="tokens"), ids_col="tokens").select("text", "tokens", "decoded").collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        assert r["tokens"] == library.encode(r["text"] or "")
        assert r["decoded"] == (r["text"] or "")
    assert bpe.decode(bpe.encode(nothing)).collect() == []
    assert bpe.round_trip(edge, ids="tokens").select("text", "tokens", "decoded").collect() == rows
    assert bpe.round_trip(nothing).collect() == []


@pytest.mark.parametrize("n", [0, 1, 63, 64, 511, 512, 513, 5000])
def test_wavelet_matrix(n):
    rnd = random.Random(n)
    ids = np.array([rnd.choice([0, 1, 2, 3, 700, 50256, rnd.randrange(50257)]) for _ in range(n)], np.uint32)
    built = W.WaveletMatrix.build(ids, 16)
    m = W.WaveletMatrix.from_buffer(b"head" + built.to_bytes(), 4, 16, n)
    assert (m.decode() == ids).all() and (m.access(np.arange(n)) == ids).all()
    for token in (0, 2, 700, 50256, 49999, 70000):
        where = np.flatnonzero(ids == token)
        assert m.count(token) == len(where)
        assert m.count(token, n // 3, n // 2) == ((where >= n // 3) & (where < n // 2)).sum()
        for k in {0, len(where) // 2, len(where) - 1} if len(where) else ():
            assert m.occurrence(token, k) == where[k]


def test_byte_bpe_pieces_equal_the_whole_text():
    definition = open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read()
    whole, bpe = tokenizers.Tokenizer.from_str(definition), W.ByteBpe(definition)
    some = texts(3000) + [r[1] for r in EDGE]
    for at in range(0, len(some), 300):
        for t, ids in zip(some[at:at + 300], bpe.encode(some[at:at + 300])):
            assert np.frombuffer(ids, np.uint32).tolist() == whole.encode(t or "", add_special_tokens=False).ids


def test_byte_bpe_runs_of_stops_are_encoded_once():
    """Letters with stops behind them need not go through the whole tokenizer, unless a token of its own could stand there."""
    definition = open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8").read()
    some = ["alpha*** beta?!", "gamma*** can't x!! delta,### <|endoftext|>", "epsilon<|endoftext|> f$$$ g1.", "h'' i\u2026 j___\nk?!"]
    bpe, sent = W.ByteBpe(definition), []
    whole, bpe._whole = bpe._whole, lambda pieces: sent.extend(pieces) or whole(pieces)
    library = tokenizers.Tokenizer.from_str(definition)
    for k in (1, len(some)):
        assert bpe.encode(some[:k]) == [np.array(library.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in some[:k]]
        assert not {p.strip() for p in sent} & {"alpha***", "beta?!", "gamma***", "delta,###", "f$$$", "k?!"} and sent.count("***") == 1
    other = tokenizers.Tokenizer.from_str(definition)
    other.add_tokens(["ta?!", "$$"])
    bpe = W.ByteBpe(other.to_str())
    assert bpe.encode(some) == [np.array(other.encode(t, add_special_tokens=False).ids, np.uint32).tobytes() for t in some]


def test_shards_round_trip(spark, edge, nothing):
    path = shared_path(spark, "test-shards")
    W.write_shards(edge, path, tokenizer_path("byte_bpe_50k.json"), 2, partition_bytes=100_000, shard_tokens=50)
    rows = W.read_documents(spark, path).orderBy("start").collect()
    whole = tokenizers.Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    order = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert [r["doc_id"] for r in rows] == [r[0] for r in order]
    start = 0
    for r, e in zip(rows, order):
        ids = whole.encode(e[1] or "", add_special_tokens=False).ids + [2]
        assert (r["start"], r["n_tokens"], r["ids"]) == (start, len(ids), ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert W.count_token(spark, path, 2).groupBy().sum("n").first()[0] == sum(r["ids"].count(2) for r in rows)
    empty = shared_path(spark, "test-shards")
    W.write_shards(nothing, empty, tokenizer_path("byte_bpe_50k.json"), 2)
    assert W.read_documents(spark, empty).collect() == []

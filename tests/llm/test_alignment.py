"""Token alignment against a plain, token-by-token version over the libraries themselves."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillstar.llm import registry, token_alignment
from tillstar.llm.common import documents, tokenizer_path

from samples import SF_SMALL

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def plain(rows):
    """The contract read literally: tokens with byte ranges, links by equal ends, counts over all rows."""
    import sentencepiece
    from tokenizers import Tokenizer

    a_side, b_side = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_side.encode_special_tokens = True
    letters = token_alignment.byte_alphabet()
    all_links, out = [], []
    for doc_id, text in rows:
        tokens = []
        if text:
            a = a_side.encode(" " + text, add_special_tokens=False).ids
            b = b_side.encode(text)
            a_raw = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
            b_raw = [bytes([int(p[3:5], 16)]) if b_side.is_byte(i) else p.replace("▁", " ").encode()
                     for i in b for p in [b_side.id_to_piece(i)]]
            if b"".join(a_raw) == b"".join(b_raw) == (" " + text).encode():
                tokens = [a, a_raw, b, b_raw]
        links, groups, ga, gb = [], [], [], []
        if tokens:
            ends = [[sum(map(len, raw[:k + 1])) for k in range(len(raw))] if len(raw) < 300 else _ends(raw) for raw in (a_raw, b_raw)]
            where_b = {e: j for j, e in enumerate(ends[1])}
            j = 0
            for i, e in enumerate(ends[0]):
                ga.append(a[i])
                if e in where_b:
                    gb = b[j:where_b[e] + 1]
                    j = where_b[e] + 1
                    links.append((a[i], b[j - 1]))
                    groups.append((ga, gb))
                    ga = []
        all_links.append(links)
        text_ = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        out.append([doc_id, len(tokens[0]) if tokens else 0, len(tokens[2]) if tokens else 0, len(groups), len(links), 0, 0,
                    hashlib.sha256(text_.encode()).hexdigest() if tokens else ""])
    count = Counter(x for links in all_links for x in links)
    best = {}
    for (_, b), k in count.items():
        best[b] = max(best.get(b, 0), k)
    for row, links in zip(out, all_links):
        row[5] = sum(count[x] == best[x[1]] for x in links)
        row[6] = sum(count[x] for x in links)
    return sorted(map(tuple, out), key=str)


def _ends(raw):
    out, at = [], 0
    for r in raw:
        at += len(r)
        out.append(at)
    return out


ODD = [(20, "a▁b"), (21, " leading"), (22, "trailing  "), (23, "<|endoftext|> and </s> <0x41>"), (24, "x" * 6000), (25, "1" * 6000 + " é"),
       (26, "\x00\x01"), (27, " " * 7000), (28, "日本語テキスト" * 400), (29, "a\r\n\r\n b c d"), (30, "don't I'LL we've")]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_edges_and_odd_texts(spark, edge):
    more = spark.createDataFrame(ODD, "doc_id long, text string")
    df = edge.unionByName(more, allowMissingColumns=True)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    found = rows_of(token_alignment.align(df, A, B))
    assert found == plain(rows)
    assert [r for r in found if r[0] == 20] == [(20, 0, 0, 0, 0, 0, 0, "")]  # its mark reads as a space


def test_empty_table(nothing):
    assert token_alignment.align(nothing, A, B).collect() == []


@pytest.mark.parametrize("chunk_bytes", [2000, 8 << 20])
def test_documents_in_chunks_of_any_size(spark, chunk_bytes):
    docs = documents(spark, SF_SMALL).repartition(5)
    assert rows_of(token_alignment.align(docs, A, B, chunk_bytes=chunk_bytes)) == plain([tuple(r) for r in docs.collect()])


def test_groups_hold_all_tokens_and_meet_at_their_ends(spark):
    docs = documents(spark, SF_SMALL)
    groups = token_alignment.texts_aligned(spark, docs, A, B)
    per = groups.select("doc_id", F.size("groups").cast("long").alias("g"), F.aggregate("groups", F.lit(0), lambda n, x: n + F.size(x["a"])).alias("a"))
    want = registry.op11_token_alignment(spark, SF_SMALL)
    bad = per.join(want, "doc_id").where("g <> n_groups or a <> n_a")
    assert bad.count() == 0 and per.count() == want.count()


def test_another_kind_of_vocabulary_is_refused(spark):
    with pytest.raises((ValueError, KeyError)):
        token_alignment.ByteSide(open(tokenizer_path("word_bpe_49k.json"), encoding="utf-8").read())

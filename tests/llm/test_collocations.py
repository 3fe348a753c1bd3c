"""Collocations against a plain count of every phrase; the registered query is compared with SQL."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from oracle_check import compare, duck
from tillstar.llm import collocations, registry

from samples import SF_SMALL


def plain(rows, least, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    f[lang or "und", tuple(words[i:i + k])] += 1
    f = {p: c for p, c in f.items() if c >= least}
    out = []
    for (lang, words), a in f.items():
        if len(words) == 1:
            continue
        k, score = min(((k, 1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]])) for k in range(1, len(words))), key=lambda x: (x[1], x[0]))
        inside = any(lang == other and len(longer) > len(words) and c >= a and any(longer[i:i + len(words)] == words for i in range(len(longer)))
                     for (other, longer), c in f.items())
        if not inside:
            out.append((lang, -score, -a, " ".join(words), f[lang, words[:k]], f[lang, words[k:]], n[lang]))
    ranked, seen = [], Counter()
    for lang, score, a, phrase, left, right, size in sorted(out, key=lambda r: (*r[:3], r[3].encode())):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase, -a, left, right, size, -score))
    return sorted(ranked)


def found(df, **options):
    return sorted(tuple(r) for r in collocations.mine(df, **options).collect())


def texts(seed, n):
    some = random.Random(seed)
    words = ["The", "of", "a", "é", "日本", "x-y", " z", "Of", "and", "b\xff", "\x00"]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", ":"]
    return [("".join(some.choice(words) + some.choice(ends) for _ in range(some.randint(0, 60))), some.choice(["en", "de", None, "und"]))
            for _ in range(n)]


@pytest.mark.parametrize("chunk_bytes", [300, 16 << 20])
def test_random_texts(spark, chunk_bytes):
    rows = texts(7, 200) + [("a a a a a a a a " * 40, "fr"), ("so it goes. " * 30, "fr"), ("", "fr"), (None, "fr"), (". , \n", None)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(4)
    for least, longest, top in ((5, 5, 2000), (3, 4, 7), (30, 5, 3)):
        assert found(df, least=least, longest=longest, top=top, chunk_bytes=chunk_bytes) == plain(rows, least, longest, top)


def test_colliding_fingerprints_are_counted_apart():
    """Where all fingerprints are equal, places are still grouped by their words."""
    places = np.array([1, 2, 0, 1, 3, 0, 1, 2, 0, 3, 2], np.int32)
    starts = np.array([0, 3, 6, 9])
    groups = [(int(p), int(k)) for first, times in collocations.same_words(places, starts, np.zeros(4, np.int64), 2) for p, k in zip(first, times)]
    assert sorted(groups) == [(0, 2), (3, 1), (9, 1)]


def test_edge_rows_and_empty_table(edge, nothing):
    rows = [(r["text"], r["lang"]) for r in edge.collect()]
    assert found(edge) == plain(rows, 100, 5, 2000)
    assert found(nothing) == []


def test_large_numbers_stay_exact(spark):
    big = 3 * 10 ** 12
    phrases = spark.createDataFrame([("en", "a b", big), ("en", "a", big + 1), ("en", "b", big + 7)], "lang string, phrase string, f long")
    sizes = spark.createDataFrame([("en", 10 ** 14)], "lang string, n long")
    row = collocations.score(phrases, sizes).first()
    assert row["score"] == 1000 * big * 10 ** 14 // ((big + 1) * (big + 7))


def test_prefix_polynomials_are_the_polynomial():
    words = b"\n".join(b"w%d" % i for i in range(50))
    places = np.random.default_rng(1).integers(0, 51, 400).astype(np.int32)
    prints = collocations.Prints("en", collocations.pack(words), collocations.pack(places.tobytes()))
    for n in (2, 5):
        at = prints.at(np.array([0, 17, 390]), n)
        for start, value in zip((0, 17, 390), at):
            h = sum(int(prints.hashes[places[start + j]]) * pow(collocations.BASE, j, 1 << 64) for j in range(n)) % (1 << 64)
            h = (h + int(prints.seed) * (2 * n + 1)) % (1 << 64)
            h ^= h >> 29
            h = h * 0xBF58476D1CE4E5B9 % (1 << 64)
            assert np.uint64(h ^ h >> 32).view(np.int64) == value


def test_registered_query_with_fewer_occurrences(spark):
    """The SQL with another threshold, so that long phrases, drops and ties occur on the small table."""
    from tillstar.llm import oracle
    from tillstar.llm.common import documents

    r = compare(spark, duck(SF_SMALL), "op12", SF_SMALL, lambda s, d: collocations.mine(documents(s, d, "text", "lang"), least=10, top=500),
                oracle.collocations(least=10, top=500))
    assert r["ok"] and r["spark_rows"] > 100, r


def test_columns(spark):
    assert registry.op12_collocations(spark, SF_SMALL).dtypes == [
        ("lang", "string"), ("rank", "bigint"), ("phrase", "string"), ("a", "bigint"), ("l", "bigint"), ("r", "bigint"), ("n", "bigint"), ("score", "bigint")]


def test_a_collision_is_counted_by_its_text(spark):
    """A fingerprint that comes with two hashes: what was written out for it does not count, the text does."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("a b a b c", "en"), ("b d", "de")], "text string, lang string")
    chunks = collocations.stored(collocations.cut_chunks(df), "chunks-test")
    known = collocations.stored(collocations.frequent(collocations.word_counts(chunks), 1), "known-test")
    out = collocations.written_out(chunks, known, 5)
    true = [("de", "b", 1), ("de", "d", 1), ("en", "a", 2), ("en", "b", 2), ("en", "c", 1)]
    rows = out.collect()
    assert sorted((r["lang"], r["phrase"], r["total"]) for r in rows) == true
    assert len({r["hash"] for r in rows}) == 5  # the language is part of it
    wrong = out.withColumn("phrase", F.when((F.col("phrase") == "b"), "other").otherwise(F.col("phrase"))).withColumn("total", F.lit(9))
    shared = out.where("phrase = 'b'").select("print")
    left = collocations.settled(wrong, shared, chunks, known, 1, 5).collect()
    assert sorted(map(tuple, left)) == [("de", "b", 1), ("de", "d", 9), ("en", "a", 9), ("en", "b", 2), ("en", "c", 9)]
    assert collocations.settled(wrong, shared, chunks, known, 2, 5).where("phrase = 'b'").count() == 1

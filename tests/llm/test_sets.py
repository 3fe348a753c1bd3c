"""Operators 7 to 10 against plain Python, and edge rows."""

import hashlib
import math
import re
import textwrap
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillstar.llm import license_scan, mixing, multiset_hash, ngram_join, oracle, registry
from tillstar.llm.common import documents
from tillstar.llm.components import connected

from samples import EDGE, SF_SMALL

BLANK = re.compile(r"[^ \t-\r]+")


def plan_nodes(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Mixing

def words(text):
    return len(BLANK.findall(text or ""))


@pytest.fixture(scope="module")
def uneven(spark):
    source = F.when(F.col("doc_id") % 3 == 0, "hot").when(F.col("doc_id") % 20 == 1, None).otherwise(F.col("source"))
    return documents(spark, "/root/testdata/sf0.01", "doc_id", "text", "source").withColumn("source", source).cache()


def used(rows):
    """Tokens per source of the mixture, and of the documents."""
    return rows.groupBy("source").agg(F.sum(mixing.token_count(F.col("text"))).alias("t"))


@pytest.mark.parametrize("repeats", [1.0, 1.5, 3.0])
def test_repetition_limit(uneven, repeats):
    mixed = mixing.mix(uneven, mixing.Target(max_repeats=repeats), block_tokens=3000).cache()
    have = {r["source"]: r["t"] for r in used(uneven).collect()}
    got = {r["source"]: r["t"] for r in used(mixed).collect()}
    longest = max(words(r["text"]) for r in uneven.collect())
    assert mixed.select("doc_id").distinct().count() == uneven.count()  # the least budget uses every document
    for s, t in got.items():
        assert have[s] <= t <= repeats * have[s] * (1 + 1e-6) + longest
    if repeats > 1:
        top = max(t / have[s] for s, t in got.items())
        assert top > repeats * 0.95
    # Whole epochs hold every document once, the last one each at most once.
    assert mixed.groupBy("doc_id", "mix.epoch").count().where("count > 1").count() == 0


def test_weights_follow_the_exponent(uneven):
    sizes = {r["source"]: r["t"] for r in used(uneven).collect()}
    total = sum(sizes.values())
    target = 2.85
    low, high = 0.0, 1.0
    entropy = lambda a: -sum(w / z * math.log(w / z) for z in [sum((t / total) ** a for t in sizes.values())] for t in sizes.values() for w in [(t / total) ** a])
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if entropy(mid) <= target else (mid, high)
    rows = uneven.sparkSession.createDataFrame([(float(t),) for t in sizes.values()], "tokens double")
    assert abs(mixing.find_exponent(rows, total, mixing.Target(entropy=target)) - high) < 1e-5


def test_budget(uneven):
    mixed = mixing.mix(uneven, mixing.Target(max_repeats=2.0, budget=100_000), block_tokens=3000)
    n = mixed.agg(F.sum(mixing.token_count(F.col("text")))).first()[0]
    longest, sources = max(words(r["text"]) for r in uneven.collect()), used(uneven).count()
    assert 99_000 <= n <= 100_000 + longest * sources


def test_mixing_is_native_and_handles_edges(spark, edge, nothing):
    mixed = mixing.mix(edge)
    assert not re.search("Python|Pandas|Arrow", plan_nodes(mixed))
    assert mixed.columns == edge.columns + ["mix"]
    # A null id hashes like any other; every row is used at least once.
    assert mixed.where("mix.epoch = 0").count() == len(EDGE)
    assert mixing.mix(nothing).collect() == []


# Fingerprints

def fingerprint(text):
    uniform, ones, n = [0] * 4, [0] * 64, 0
    for p in re.split(multiset_hash.PARAGRAPH_END, text or ""):
        if p := p.strip(" "):
            h = hashlib.sha256(p.encode()).digest()
            w = [int.from_bytes(h[4 * k:4 * k + 4], "big") for k in range(6)]
            n += 1
            uniform = [(a + b) % 2**32 for a, b in zip(uniform, w)]
            for j in range(32):
                ones[j] += w[5] >> j & 1
                ones[32 + j] += w[4] >> j & 1
    return "".join(f"{u:08x}" for u in uniform) + "".join(f"{(2 * c - n) % 65536:04x}" for c in ones)


def test_fingerprint_query(spark):
    rows = registry.op8_multiset(spark, SF_SMALL)
    assert not re.search("Python|Pandas|Arrow", plan_nodes(rows))
    got = sorted(rows.collect(), key=lambda r: r["doc_id"])
    docs = sorted(documents(spark, SF_SMALL).collect(), key=lambda r: r["doc_id"])
    for k, (g, d) in enumerate(zip(got, docs)):
        after = docs[(k + 1) % len(docs)]["text"]
        cut = len(d["text"]) // 4
        edited = d["text"][:len(d["text"]) - cut] + after[:cut]
        assert (g["n_chars"], g["edited_sha256"]) == (len(d["text"]), hashlib.sha256(edited.encode()).hexdigest())
        assert (g["fingerprint"], g["edited_fingerprint"]) == (fingerprint(d["text"]), fingerprint(edited))
        assert 0 <= g["near_next"] <= 1 and 0 <= g["near_edited"] <= 1
    assert sum(g["near_edited"] for g in got) > 8 * sum(g["near_next"] for g in got)


def test_next_rows_over_many_buckets(edge, nothing, spark):
    docs = documents(spark, SF_SMALL)
    got = {r["key"]: (r["text"], r["next_key"], r["next_text"]) for r in multiset_hash.with_next(docs, bucket_bytes=20_000).collect()}
    rows = sorted(docs.collect(), key=lambda r: r["doc_id"])
    for a, b in zip(rows, rows[1:] + rows[:1]):
        assert got[a["doc_id"]] == (a["text"], b["doc_id"], b["text"])
    order = sorted(EDGE, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    for size in (50, 1 << 20):
        got = multiset_hash.with_next(edge.drop("key"), bucket_bytes=size).orderBy("place").collect()
        assert [(r["key"], r["text"]) for r in got] == [(r[0], r[1] or "") for r in order]
        assert [(r["next_key"], r["next_text"]) for r in got] == [(r[0], r[1] or "") for r in order[1:] + order[:1]]
        assert len({r["place"] for r in got}) == len(got)
        assert [r["next_place"] for r in got] == [r["place"] for r in got[1:] + got[:1]]
    assert multiset_hash.with_next(nothing).collect() == []


def test_homomorphic(spark):
    texts = [(1, "one.\ntwo.\nthree.", "a"), (2, "three.\none.\ntwo.", "a"), (3, "one.\ntwo.", "a"), (4, "three.", "a"), (5, "", "a"), (6, None, "a")]
    df = multiset_hash.add_fingerprints(spark.createDataFrame(texts, "id int, text string, x string"), ["id"])
    fp = {r["id"]: r["fingerprint"] for r in df.collect()}
    assert fp[1] == fp[2] != fp[3] and fp[5] == fp[6] == "0" * 288
    lanes = df.select("id", F.struct("uniform", "signs").alias("l"))
    both = lanes.where("id = 3").select(F.col("l").alias("a")).crossJoin(lanes.where("id = 4").select(F.col("l").alias("b")))
    joined = both.select(multiset_hash.combined(F.col("a"), F.col("b")).alias("c"), "a", "b")
    out = joined.select(multiset_hash.fingerprint_text(F.col("c.uniform"), F.col("c.signs")).alias("f"),
                        multiset_hash.combined(F.col("c"), F.col("b"), -1).alias("back"), "a").first()
    assert out["f"] == fp[1] and out["back"] == out["a"]


# Licences

def scan(text, templates=license_scan.TEMPLATES, threshold=0.8, coverage=0.75):
    best = defaultdict(dict)
    for p in re.split(license_scan.PASSAGE_END, text or ""):
        if b := license_scan.bigrams(p):
            for name, total, k, g in license_scan.template_passages(templates):
                d = 2 * len(b & g) / (len(b) + len(g))
                if d >= threshold:
                    best[name, total][k] = max(best[name, total].get(k, 0), d)
    return sorted((n, round(sum(v.values()) / t, 9)) for (n, t), v in best.items() if len(v) >= coverage * t)


def test_licenses_equal_brute_force(spark, edge, nothing):
    notes = [(10_100 + k, "Before. " + "\n".join(t) + "\nAfter.", None, None, 0) for k, t in enumerate(license_scan.TEMPLATES.values())]
    notes += [(10_200, "Licenced under the Apache License, version 2.0!", None, None, 0), (10_201, "all rights reserved", None, None, 0),
              (10_202, "ALL  RIGHTS\tRESERVED.", None, None, 0), (10_203, "Permission is hereby granted to nobody.", None, None, 0)]
    more = spark.createDataFrame(notes, "doc_id long, text string, lang string, source string, n_chars long")
    some = documents(spark, SF_SMALL).unionByName(more.select("doc_id", "text")).cache()
    rows = license_scan.scan(some, ["doc_id"])
    assert not re.search("Python|Pandas|Arrow", plan_nodes(rows))
    got = {r["doc_id"]: [(x["license"], round(x["score"], 9)) for x in r["licenses"]] for r in rows.collect()}
    expected = {r["doc_id"]: scan(r["text"]) for r in some.collect()}
    assert got == expected and all(expected[10_100 + k] for k in range(len(license_scan.TEMPLATES)))
    ids = sorted({r[0] for r in EDGE if r[0] is not None})
    found = license_scan.scan(edge, ["doc_id"]).collect()
    assert sorted(r["doc_id"] for r in found if r["doc_id"] is not None) == ids and all(r["licenses"] == [] for r in found)
    assert license_scan.scan(nothing, ["doc_id"]).collect() == []


def test_wrapped_licenses_are_found(spark):
    """Each notice in one line, and wrapped as in comments, below a line of its own kind and above other text."""
    shapes = [("", "\n"), ("# ", "\n"), (" * ", "\r\n"), ("// ", "\n"), ("dnl ", "\n"), ("REM ", "\r\n"), ("    ", "\n")]
    rows, names = [], []
    for name, texts in license_scan.TEMPLATES.items():
        notice = " ".join(texts)
        forms = [notice] + [end.join(prefix + line for line in textwrap.wrap(notice, width - len(prefix)))
                            for prefix, end in shapes for width in (60, 72, 80)]
        for form in forms:
            rows.append((len(names), form))
            rows.append((len(names) + 1, f"Some code.\n#\n{form}\n\nMore text follows here"))
            names += [name, name]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: {x["license"] for x in r["licenses"]} for r in license_scan.scan(df, ["doc_id"]).collect()}
    assert [(n, rows[k][1]) for k, n in enumerate(names) if n not in found[k]] == []


def test_rows_of_one_id_are_one_document_of_distinct_passages(spark):
    rows = [(1, "Released under the MIT License."), (1, "Released under the MIT License."), (2, "Released under the Foo License."),
            (2, "Released under the Foo License."), (3, "Released under the Foo License."), (None, "All rights reserved."), (None, "All rights reserved.")]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"), ["doc_id"])
    got = {r["doc_id"]: [(x["license"], x["score"]) for x in r["licenses"]] for r in found.collect()}
    assert got[1] == [("MIT", 1.0)] and got[2] == got[3] == [] and got[None] == [("all-rights-reserved", 1.0)]


def test_license_sql_cuts_like_the_query(spark):
    """The SQL over wrapped and commented notices, and over repeated ids."""
    import duckdb

    rows = []
    for name, texts in license_scan.TEMPLATES.items():
        notice = " ".join(texts)
        for prefix in ("", "# ", " * ", "dnl ", "REM "):
            for width in (60, 80):
                form = "\n".join(prefix + line for line in textwrap.wrap(notice, width - len(prefix)))
                rows.append((len(rows), f"Some code: here.\n#\n{form}\n\nMore text follows.\n  \n{prefix}end"))
    rows += [(0, "Released under the MIT License."), (5, rows[5][1]), (10_000, "Released under the Foo License."), (10_000, "Released under the Foo License.")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = {r[0]: (r[1], r[2], round(r[3], 6)) for r in con.execute(oracle.licenses()).fetchall()}
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), ["doc_id"]).collect()
    got = {r["doc_id"]: (len(r["licenses"]), ",".join(x["license"] for x in r["licenses"]), round(max((x["score"] for x in r["licenses"]), default=0), 6))
           for r in found}
    assert got == want and sum(n > 0 for n, _, _ in got.values()) > 100


# N-gram join

def shingle_set(text, n=5):
    w = BLANK.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def linked(a, b, percent=75):
    c = len(a & b)
    return bool(a) and bool(b) and 100 * c >= percent * (len(a) + len(b) - c)


def brute(rows):
    """Component of each (id, text), and the links between distinct sets by smallest id."""
    rows = [(i, shingle_set(t)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    rep = {}
    for i, s in sorted(rows, key=lambda r: r[0]):
        rep.setdefault(s, i)
    links = set()
    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if linked(a, b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
                if a != b:
                    links.add((min(rep[a], rep[b]), max(rep[a], rep[b])))
    return {i: find(i) for i, _ in rows}, links


def near_copies(n, length, seed):
    """Copies with some words changed at the ends and inside, around the threshold."""
    import random

    rnd = random.Random(seed)
    base = [f"w{rnd.randrange(400)}" for _ in range(length)]
    out = []
    for _ in range(n):
        t = list(base)
        for _ in range(rnd.randrange(0, 5)):
            t[rnd.randrange(length)] = f"x{rnd.randrange(1000)}"
        if rnd.random() < 0.3:
            t = t[rnd.randrange(0, length // 4):]
        out.append(" ".join(t))
    return out


def test_join_equals_brute_force(spark):
    texts = [t for k in range(6) for t in near_copies(25, 40 + 15 * k, k)]
    texts += [texts[0]] * 30 + ["a b", "A  B", "a b c", "", None] + near_copies(30, 12, 99)
    rows = list(enumerate(texts)) + [(i + 1000, r["text"]) for i, r in enumerate(documents(spark, SF_SMALL).collect())]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5, "doc_id")
    expected, links = brute(rows)
    got = ngram_join.components(df).collect()
    assert {r["id"]: r["component"] for r in got} == expected and len(got) == len(rows)
    assert {r["id"]: r["n"] for r in got} == {i: len(shingle_set(t)) for i, t in rows}
    found, member = ngram_join.pairs(df)
    assert {(r["a"], r["b"]) for r in found.collect()} == links
    sets = {r["id"]: r["rep"] for r in member.collect()}
    assert all((sets[i] is None) == (not shingle_set(t)) for i, t in rows)


def test_crowded_ngrams(spark):
    """An n-gram in all documents of a chunk, and equal sets across chunks."""
    shared = " ".join(f"s{k}" for k in range(30))
    rows = [(i, f"{shared} " + " ".join(f"u{i}_{k}" for k in range(i % 12))) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r["id"]: r["component"] for r in ngram_join.components(df).collect()} == brute(rows)[0]


def test_join_edges(spark, edge, nothing):
    got = ngram_join.components(edge.drop("n")).collect()
    assert len(got) == len(EDGE)
    comp = {r["id"]: r["component"] for r in got if r["id"] is not None}
    assert comp == {1: 1, 2: 2, 3: 3, 4: 4, 5: 5, 6: 6, 7: 1, 8: 8, 9: 9, 10: 10}
    assert [r["component"] for r in got if r["id"] is None] == [None, None]
    assert ngram_join.components(nothing).collect() == []
    links, member = ngram_join.pairs(nothing)
    assert links.collect() == [] and member.collect() == []
    # Rows of one id are one document: both texts' groups are one.
    torn = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "p q r s t u"), (3, "p q r s t u")], "doc_id long, text string")
    assert {r["component"] for r in ngram_join.components(torn).collect()} == {1}


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 140)] + [(1, k) for k in range(2, 30)] + [(50, 51), (51, 50), (60, 60)]
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 141)) and all(got[k] == 1 for k in range(1, 30)) and got[51] == 50 and 60 not in got


# Pipeline

def judge_plainly(docs):
    """Rows that the rules keep, judged one by one by plain counts and the references."""
    from tillstar.llm import quality_rules as q

    judge = q.Judge(q.learn_references(docs), q.Limits())
    out = []
    for r in docs.select("doc_id", "text").collect():
        words = BLANK.findall(r["text"] or "")
        windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
        repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in range(3)}
        n, *_, failed, char_d, word_d, kept = judge.row(r["text"])
        assert n == len(words) and failed == (n < 50 or 100 * len(repeated) > 50 * n)
        assert kept == (not failed and char_d <= 0.27 and word_d <= 0.40)
        if kept:
            out.append((r["doc_id"], r["text"]))
    return out


def test_pipeline_keeps_every_distinct_text(spark):
    import corpus_pipeline as p

    a, b, c = (" ".join(f"{w}{k}" for k in range(40)) for w in "abc")
    rows = [(1, a), (2, a), (2, b), (3, b + " end"), (3, c), (None, c), (4, None), (4, None), (5, "one two")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(((r["doc_id"], r["text"]) for r in p.drop_near_duplicates(spark, docs, "").collect()), key=str)
    assert got == sorted([(1, a), (2, b), (3, c), (4, None), (4, None), (5, "one two")], key=str)


def test_pipeline_runs_whole(spark):
    """``run`` gives the rows of its stages applied one behind the other, with the library's ids."""
    import corpus_pipeline as p
    import sentencepiece

    from tillstar.llm.common import stored, tokenizer_path

    docs = documents(spark, SF_SMALL, *p.COLUMNS)
    for name, stage in p.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_SMALL), "test-run")
    library = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    want = sorted((r["doc_id"], r["lang"], r["source"], tuple(library.encode(r["text"]))) for r in docs.collect())
    got = p.run(spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], r["lang"], r["source"], tuple(r["ids"])) for r in got) == want and len(want) > 100
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in got)


def test_pipeline_stages(spark, edge, nothing):
    import corpus_pipeline as p

    docs = documents(spark, "/root/testdata/sf0.01", *p.COLUMNS)
    from tillstar.llm.common import stored

    planted = spark.createDataFrame([(90001, "12 34 56", "en", "src0", 8), (90002, None, "en", "src0", 0)], docs.schema)
    docs = docs.unionByName(planted)
    before = docs
    for name, stage in p.STAGES[:-1]:
        after = stored(stage(spark, before, ""), "test-stage")
        assert after.dtypes == docs.dtypes
        ids = {r[0] for r in after.select("doc_id").collect()}
        assert ids <= {r[0] for r in before.select("doc_id").collect()}
        if name == "language_id":
            assert not ids & {90001, 90002} and len(ids) > 995
        if name == "quality_rules":
            judged = judge_plainly(before)
            assert sorted(map(tuple, after.select("doc_id", "text").collect()), key=str) == sorted(judged, key=str)
        if name == "ngram_jaccard_join":
            assert len(ids) == after.count()
            comp, _ = brute([(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()])
            assert ids == set(comp.values())
        if name == "mixing":
            assert ids == {r[0] for r in before.select("doc_id").collect()}
        before = after
    out = p.STAGES[-1][1](spark, before, "")
    assert out.where("not round_trip").count() == 0 and out.count() == before.count()
    for _, stage in p.STAGES:
        assert stage(spark, nothing, "").collect() == []

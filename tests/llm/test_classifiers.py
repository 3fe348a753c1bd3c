"""Operators 1, 2, 3 and 5: brute force where there is one, held-out accuracy, edge rows."""

import itertools
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.llm import language_id, quality_classifier, quality_rules, registry, toxicity
from tillstar.llm.common import documents, fold, labels

from samples import EDGE, SF_SMALL

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def accuracy(spark, rows, column, sf=SF):
    known = labels(spark, sf, column)
    r = rows.join(known, "doc_id").where("held_out").select((F.col("predicted") == F.col("label")).cast("int").alias("ok")).agg(F.avg("ok")).first()
    return r[0]


def test_toxicity_on_held_out_rows(spark):
    """On the largest local table: the smaller ones have some fifty toxic documents to learn from."""
    large = SF.replace("sf0.01", "sf0.1")
    rows = registry.op1_toxicity(spark, large)
    found = rows.collect()
    assert len(found) == 10_000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in found)
    assert accuracy(spark, rows, "toxic", large) > 0.9


def test_toxicity_learns_a_planted_word(spark):
    rows = [(i, f"alpha beta w{i % 7} gamma delta " * 3 + ("insult " if i % 4 == 0 else "") + "end", int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"))
    score = {r["doc_id"]: r["evidence"]["score"] for r in toxicity.add_evidence(df, model).collect()}
    assert min(score[i] for i, _, y in rows if y) > 0.5 > max(score[i] for i, _, y in rows if not y)


def test_toxicity_probabilities_are_the_formula(spark):
    """The word model against plain counts: discounted document counts plus shared continuation."""
    rows = [(i, "x a b a" if i % 2 else "x a c", i % 2) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"), min_count=1)
    assert set(model.words) == {"x", "a", "b", "c"}
    llr = {w: model.word[k] for w, k in model.words.items()}
    assert llr["b"] > 1 and llr["c"] < -1 and abs(llr["x"]) < abs(llr["b"])


def test_toxicity_discounts():
    """The modified Kneser-Ney estimates; half a count where they are undefined or out of bounds."""
    y = 100 / (100 + 2 * 40)
    assert np.allclose(toxicity.discounts({1: 100, 2: 40, 3: 20, 4: 12}), [0, 1 - 2 * y * 40 / 100, 2 - 3 * y * 20 / 40, 3 - 4 * y * 12 / 20])
    assert np.allclose(toxicity.discounts({}), [0, 0.5, 0.5, 0.5])
    assert np.allclose(toxicity.discounts({1: 10, 2: 40, 3: 400}), [0, 1 / 9, 0.5, 0.5])


def plain_model(rows):
    """Log ratios of words and of (word, bigram) by plain counting: class-conditional modified Kneser-Ney, shared back-off."""
    n2 = [Counter(), Counter()]
    seen = Counter(w for _, text, _ in rows for w in set(re.findall(r"[a-z]+", text)))
    for _, text, label in rows:
        w = [x if seen[x] > 1 else "<unk>" for x in re.findall(r"[a-z]+", text)]
        n2[label].update(set(zip(["<s>", *w], w)))
    both = set(n2[0]) | set(n2[1])
    kept = {b for b in both if n2[0][b] + n2[1][b] > 1}
    words = {x for x in seen if seen[x] > 1} | {"<unk>", "<s>"}
    shared = {x: 1e-3 + sum(b[1] == x for b in both) for x in words}
    total_shared = sum(shared.values())
    size = [sum(n2[c].values()) for c in (0, 1)]
    d2 = [toxicity.discounts(Counter(n2[c].values())) for c in (0, 1)]

    def cut(c, b):
        return n2[c][b] if b not in kept else d2[c][min(n2[c][b], 3)]

    p1 = []
    for c in (0, 1):
        n = {x: sum(k for b, k in n2[c].items() if b[1] == x) for x in words}
        d1 = toxicity.discounts(Counter(n.values()))
        mass = sum(d1[min(k, 3)] for k in n.values()) + 1
        p1.append({x: (n[x] - d1[min(n[x], 3)] + mass * shared[x] / total_shared) / (size[c] + 1) for x in words})
    first = {v: sum(n2[0][b] + n2[1][b] for b in both if b[0] == v) for v in words}
    back = {v: (sum(cut(0, b) + cut(1, b) for b in both if b[0] == v) + 1) / (first[v] + 1) for v in words}

    def p2(c, b):
        return (n2[c][b] - cut(c, b)) / (max(first[b[0]], 1) * size[c] / sum(size)) + back[b[0]] * p1[c][b[1]]

    return {x: math.log(p1[1][x] / p1[0][x]) for x in words}, {b: math.log(p2(1, b) / p2(0, b)) for b in kept}


def test_toxicity_model_equals_plain_counting(spark):
    rng = np.random.default_rng(5)
    letters, odds = list("abcdefghijklmnopqrst"), np.arange(1, 21) / 210
    rows = [(i, " ".join(rng.choice(letters, 12, p=odds if i % 3 else odds[::-1])) + (f" {'xyz'[i % 3]}uu" * (i % 50 == 0)), int(i % 3 == 0))
            for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"))
    apart = {r["doc_id"] for r in df.where(F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id").cast("string")), F.lit(5)) == 0).collect()}
    words, pairs = plain_model([r for r in rows if r[0] not in apart])
    name = {k: w for w, k in model.words.items()} | {toxicity.UNKNOWN: "<unk>", toxicity.START: "<s>"}
    assert {name[k] for k in range(len(model.word))} == set(words)
    assert np.allclose([words[name[k]] for k in range(len(model.word))], model.word, atol=1e-9)
    got = {(name[int(k) >> 32], name[int(k) & 0xFFFFFFFF]): x for k, x in zip(model.pairs, model.pair)}
    assert set(got) == set(pairs)
    assert all(abs(got[b] + words[b[1]] - pairs[b]) < 1e-9 for b in pairs)


def test_toxicity_rare_expressions_count(spark):
    """A bigram of ordinary words, and a word of its own, each in 0.5 % of the toxic documents."""
    rng, common = np.random.default_rng(2), [f"w{chr(97 + i)}{chr(97 + j)}" for i in range(10) for j in range(10)]
    rows = []
    for i in range(2400):
        text, label = " ".join(rng.choice(common, 30)), int(i % 2 == 0)
        if label:
            text += " insult" * (i % 5 == 0)
            text += (" waa zzq wbb" if i % 400 == 0 else "") + (" wcc wdd" * (i % 400 == 2))
        rows.append((i, text, label))
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"))
    plain = "waa wbb wcc waa wdd wbb waa"
    texts = [(1, plain), (2, plain.replace("wcc waa wdd", "waa wcc wdd")), (3, plain + " zzq")]
    e = {r["doc_id"]: r["evidence"] for r in toxicity.add_evidence(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert e[2]["ratio"] > e[1]["ratio"] + 0.1 and e[3]["ratio"] > e[1]["ratio"] + 0.1


def test_toxicity_score_reads_the_whole_difference(spark):
    """Words for the ordinary class lower the score of a text whose clear words stay the same."""
    rows = [(i, "alpha beta gamma " * 3 + ("insult " if i % 4 == 0 else "kind gentle ") + f"w{i % 5} end", int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"))
    texts = [(1, "insult alpha beta gamma alpha beta gamma"), (2, "insult kind gentle kind gentle kind gentle")]
    e = {r["doc_id"]: r["evidence"] for r in toxicity.add_evidence(spark.createDataFrame(texts, "doc_id long, text string"), model).collect()}
    assert e[2]["ratio"] < e[1]["ratio"] and e[2]["score"] < e[1]["score"]
    weights = np.array([0.0, 2.0, -1.0, 0.5])
    x = np.array([[0.3, 0.1, 0.2]])
    assert abs(toxicity.logistic(weights, x)[0] - 1 / (1 + math.exp(-(0.6 - 0.1 + 0.5 * math.log(0.21))))) < 1e-12


def test_toxicity_learns_from_every_labelled_row(spark):
    """More labelled rows of a class than were once read (8,000): each word is in two of them, and every one is counted."""
    n = 9_000
    name = lambda k: "q" + "".join(chr(97 + int(d)) for d in str(k // 2))
    rows = [(k, f"plain {name(k)}", 0) for k in range(n)] + [(n + k, "awful words", 1) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(8)
    part = F.pmod(F.xxhash64(F.lit("part"), F.col("doc_id").cast("string")), F.lit(5)) == 0
    apart = {r["doc_id"] for r in df.where(part).select("doc_id").collect()}
    counted = Counter(name(k) for k in range(n) if k not in apart)
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"))
    assert {w for w in model.words if w.startswith("q")} == {w for w, k in counted.items() if k == 2}


def test_toxicity_joins_labels_without_sorting_or_broadcasting(spark, monkeypatch):
    plans = []

    def kept(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        raise StopIteration

    monkeypatch.setattr(toxicity, "stored", kept)
    docs = spark.createDataFrame([(k, "a b") for k in range(4)], "doc_id long, text string")
    with pytest.raises(StopIteration):
        toxicity.learn(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("label")))
    assert "ShuffledHashJoin" in plans[0] and "BroadcastHashJoin" not in plans[0] and "SortMergeJoin" not in plans[0]


def test_toxicity_model_stays_off_the_driver(spark, monkeypatch):
    """Words, bigrams and evidence are neither collected nor broadcast: all grow with the labelled rows."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(list("abcdefghijkl"), 9)) + " vile" * (i % 4 == 0), int(i % 4 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label int")
    most, collect = [], type(df).collect

    def counted(frame):
        found = collect(frame)
        most.append(len(found))
        return found

    def never(*_, **__):
        raise AssertionError("goes through the driver")

    monkeypatch.setattr(type(df), "collect", counted)
    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(type(df), name, never)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", never)
    model = toxicity.learn(df.select("doc_id", "text"), df.select("doc_id", "label"))
    scored = toxicity.add_evidence(df, model).select("label", "evidence.score")
    assert scored.where((F.col("score") > 0.5) != (F.col("label") == 1)).count() == 0
    assert len(model.pairs) > 100 > max(most) and not any(isinstance(x, dict) or np.size(x) > 4 for x in model)
    assert (np.diff(model.pairs) > 0).all()


def plain_logistic(x, label, weight, ridge=0.01):
    x = (x - x.mean(0)) / x.std(0)
    x = np.concatenate((np.ones((len(x), 1)), x), 1)
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-x @ w))
        penalty = np.array([1e-6] + [ridge] * (len(w) - 1))
        w += np.clip(np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (weight * (label - p)) - penalty * w), -2, 2)
    return 1 / (1 + np.exp(-x @ w))


def test_toxicity_fit_over_tasks_equals_one_array(spark):
    rng = np.random.default_rng(8)
    label = (rng.random(500) < 0.2).astype(int)
    x = np.stack((rng.normal(label, 1), rng.normal(0, 2, 500), rng.random(500) * (1 + label)), 1)
    rows = spark.createDataFrame([(int(y), *map(float, r)) for y, r in zip(label, x)], "label int, ratio double, level double, excess double")
    counts = {0: 9000, 1: 700}
    weights = toxicity._fit_logistic(rows.repartition(7), counts)
    weight = np.where(label == 1, counts[1] / label.sum(), counts[0] / (500 - label.sum()))
    assert np.allclose(toxicity.logistic(weights, x), plain_logistic(toxicity.features(x), label, weight / weight.mean()), atol=1e-9)
    assert (toxicity._fit_logistic(rows.where("false"), counts) == 0).all()


def test_toxicity_edges(spark, edge, nothing):
    none = labels(spark, SF_SMALL, "toxic").where("false")
    model = toxicity.learn(nothing, none)
    assert {r["evidence"]["score"] for r in toxicity.add_evidence(edge.drop("evidence"), model).collect()} == {0.5}
    assert toxicity.add_evidence(nothing, model).collect() == []
    one = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    assert toxicity.add_evidence(edge.drop("evidence"), toxicity.learn(edge, one)).first()["evidence"]["score"] > 0.99


def test_quality_on_held_out_rows(spark):
    rows = registry.op2_quality(spark, SF)
    assert rows.count() == 1000 and accuracy(spark, rows, "quality") > 0.95


def test_discriminant_equals_direct_densities(spark):
    rng, d = np.random.default_rng(1), len(quality_classifier.STATISTICS)
    x = np.concatenate((rng.normal(0, 1, (200, d)), rng.normal(1, 2, (300, d))))
    y = [0] * 200 + [1] * 300
    df = spark.createDataFrame([(xi.tolist(), yi) for xi, yi in zip(x, y)], "stats array<double>, label int")
    model = quality_classifier.fit(df, pool=0.2, ridge=0.1)
    groups = [x[:200], x[200:]]
    pooled = sum(np.cov(g.T, bias=True) * len(g) for g in groups) / 500
    density = []
    for c, g in enumerate(groups):
        cov = 0.8 * np.cov(g.T, bias=True) + 0.2 * pooled
        cov = 0.9 * cov + 0.1 * np.trace(cov) / d * np.eye(d)
        z = x - g.mean(0)
        density.append(math.log((0.4, 0.6)[c]) - np.linalg.slogdet(cov)[1] / 2 - np.einsum("ij,jk,ik->i", z, np.linalg.inv(cov), z) / 2)
    expected = 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))
    got = [r["score"] for r in quality_classifier.score(df, model).collect()]
    assert np.allclose(got, expected, atol=1e-9)


def test_quality_edges(spark, edge, nothing):
    stats = quality_classifier.add_statistics(edge.drop("stats", "score"))
    model = quality_classifier.fit(stats.withColumn("label", F.lit(None).cast("int")))
    assert {r["score"] for r in quality_classifier.score(stats, model).collect()} == {0.5}
    only = quality_classifier.fit(stats.withColumn("label", F.lit(1)))
    assert {r["score"] for r in quality_classifier.score(stats, only).collect()} == {1.0}
    assert quality_classifier.score(quality_classifier.add_statistics(nothing), only).collect() == []


def base(text):
    """The plain definition of the rules' counts."""
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(line in lines[:k] for k, line in enumerate(lines)), len(hit), failed)


def test_rules_equal_plain_counts(spark, edge):
    for df in (documents(spark, SF_SMALL, "doc_id", "text", "lang"), edge.drop("rules")):
        refs = quality_rules.learn_references(df)
        for r in quality_rules.judge(df, refs).select("text", "rules.*").collect():
            got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))
            assert got == base(r["text"])
            assert not (r["kept"] and r["base_failed"])


def test_references_equal_plain_counts(spark):
    df = documents(spark, SF_SMALL, "doc_id", "text", "lang")
    refs = quality_rules.learn_references(df, top_words=20)
    rows = df.collect()
    for i, lang in enumerate(refs.langs):
        words = Counter(w for r in rows if r["lang"] == lang for t in r["text"].encode().split() if (w := quality_rules.normal_word(t)))
        top = sorted(words.items(), key=lambda x: (-x[1], x[0]))[:20]
        total = sum(words.values())
        assert {w for w, _ in top} == {w for w, k in refs.vocabulary.items() if refs.words[i, k] > 0}
        assert all(abs(refs.words[i, refs.vocabulary[w]] - n / total) < 1e-12 for w, n in top)


def test_js_distance():
    p, q = np.array([1.0, 0.0]), np.array([[1.0, 0.0], [0.0, 1.0], [0.5, 0.5]])
    d = quality_rules.js_distance(p, q)
    assert abs(d[0]) < 1e-12 and abs(d[1] - 1) < 1e-12 and abs(d[2] ** 2 - 0.311278) < 1e-5


def test_rules_keep_labelled_clean_documents(spark):
    rows = registry.op3_rules(spark, SF).join(labels(spark, SF, "quality"), "doc_id").where("not base_failed").groupBy("label").agg(F.avg(F.col("kept").cast("int"))).collect()
    kept = {r[0]: r[1] for r in rows}
    assert kept[1] > 0.99 and kept[0] < 0.25


def test_rules_of_nothing(nothing):
    refs = quality_rules.learn_references(nothing)
    assert refs.langs == [] and quality_rules.judge(nothing, refs).collect() == []


def test_viterbi_equals_all_paths():
    rng = np.random.default_rng(0)
    for _ in range(200):
        n = rng.integers(1, 7)
        s = -rng.random((n, 3)) * rng.choice([1, 4, 8])
        penalty = rng.choice([0.5, 1, 3])
        value = lambda path: sum(s[i, a] for i, a in enumerate(path)) - penalty * sum(a != b for a, b in zip(path, path[1:]))
        best = max(map(value, itertools.product(range(3), repeat=n)))
        assert abs(value(language_id.viterbi(s, penalty)) - best) < 1e-9


def test_new_words_are_scored_together_as_one_by_one():
    grams = {g: (-1.0 - k / 7, -2.0 + k / 9, -1.5) for k, g in enumerate(("^ab", "abc", "bc$", "^xx", "xxx", "xx$"))}
    model = language_id.Model(["de", "en", "fr"], {"abc": (-3.0, -9.0, -40.0)}, grams, (-5.0, -6.0, -7.0),
                              {"Latin": (True, True, False), "Greek": (False, False, False)})
    words = ["abc", "ab", "x" * 200, "καλη", "語", "xxabc", "²½", "x" * (language_id.LONG_WORD + 1)]

    def alone(word):
        fits = model.scripts.get(language_id.script(word))
        if not fits or not any(fits):
            return np.zeros(3)
        rows = [model.words[word]] if word in model.words else [grams.get(g, model.unseen) for g in language_id.trigrams(word)]
        s = np.where(fits, np.sum(rows, 0), -np.inf)
        return np.maximum(s - s.max(), language_id.FLOOR)

    labeller = language_id.Labeller(model, 12.0)
    assert np.array_equal(labeller.scores(words), [alone(w) for w in words])
    labeller.label(" ".join(words))
    assert [labeller[w] for w in words] == list(range(len(words)))
    assert np.array_equal(labeller.table[:len(words)], [alone(w) for w in words])
    assert labeller.letters[:len(words)].tolist() == [True] * 6 + [False, True]


def test_language_on_held_out_rows(spark):
    rows = registry.op5_language(spark, SF).join(documents(spark, SF, "doc_id", "lang"), "doc_id").where("held_out")
    assert rows.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.98


def test_mixed_text_has_two_spans_and_edges(spark, edge):
    model = language_id.learn(documents(spark, SF, "doc_id", "text", "lang"))
    two = spark.createDataFrame([(1, "the of and in is that with for on be " * 4 + "der die und ist nicht ein eine das mit auf " * 4)], "doc_id long, text string")
    spans = language_id.identify(two, model).first()["language"]["spans"]
    assert [(s["start"], s["end"], s["lang"]) for s in spans] == [(0, 40, "en"), (40, 80, "de")]
    rows = language_id.identify(edge.drop("language"), model).select("text", "language.*").collect()
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert len(rows) == len(EDGE)


def test_a_rare_language_is_learned(spark):
    """Ten Greek documents among 20,000, far more than the sample holds; and one of words seen once each."""
    greek = ["\u03ba\u03b1\u03b9 \u03c4\u03bf \u03c0\u03b1\u03b9\u03b4\u03af", "\u0431\u0443\u043a\u0438 \u0432\u0435\u0434\u0438 \u0433\u043b\u0430\u0433\u043e\u043b"]
    rows = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") == 7, greek[1]).when(F.col("id") % 2000 == 77, greek[0]).when(F.col("id") % 3 == 0, "der die das und").otherwise("the of and to").alias("text"),
        F.when(F.col("id") == 7, "cu").when(F.col("id") % 2000 == 77, "el").when(F.col("id") % 3 == 0, "de").otherwise("en").alias("lang"))
    model = language_id.learn(rows, sample_docs=200, least_docs=50)
    assert model.langs == ["cu", "de", "el", "en"]
    found = {r["lang"]: (r["p"], r["s"], r["n"]) for r in language_id.identify(rows, model).groupBy("lang").agg(
        F.min("language.lang_pred").alias("p"), F.min("language.score").alias("s"), F.count("*").alias("n")).collect()}
    assert all(p == lang and s > 0.9 for lang, (p, s, _) in found.items()) and found["el"][2] == 10


def test_language_sample_is_bounded(spark):
    rows = spark.range(40_000).select("id", F.when(F.col("id") % 4000 == 0, "c").when(F.col("id") % 20 == 1, "b").otherwise("a").alias("lang"))
    n = {r["lang"]: r["count"] for r in language_id.sampled_by_language(rows, "id", "lang", 4000, 400).groupBy("lang").count().collect()}
    assert n["c"] == 10 and 300 < n["b"] < 500 and 3500 < n["a"] < 4100


def test_nothing_learned(spark, edge, nothing):
    model = language_id.learn(nothing)
    assert {r["language"]["lang_pred"] for r in language_id.identify(edge.drop("language"), model).collect()} == {"und"}
    assert language_id.identify(nothing, model).collect() == []


def test_folds(spark):
    import zlib

    rows = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)

"""Operators that add columns: a caller's column of the same name is replaced, all others stay as they are."""

from pyspark.sql import functions as F

from tillstar.llm import language_id, quality_classifier, quality_rules, toxicity
from tillstar.llm.common import documents, labels, tokenizer_path
from tillstar.llm.sentencepiece_bpe import SentencePieceBpe

from samples import SF_SMALL


def check(operator, df, *added):
    """The same result with the clashing columns left in as without them; the rest of the columns untouched."""
    clashing = df.withColumns({c: F.lit("x") for c in added})
    plain = operator(df.drop(*added))
    found = operator(clashing)
    assert sorted(found.columns) == sorted(set(clashing.columns) | set(plain.columns))
    assert [f.dataType for f in found.select(*added).schema] == [f.dataType for f in plain.select(*added).schema]
    assert [str(r) for r in found.select(*added).collect()] == [str(r) for r in plain.select(*added).collect()]
    others = [c for c in df.columns if c not in added]
    assert found.select(*others).collect() == df.select(*others).collect()


def test_clashing_columns_are_replaced(spark, edge):
    docs = documents(spark, SF_SMALL)
    toxic = toxicity.learn(docs, labels(spark, SF_SMALL, "toxic"))
    check(lambda df: toxicity.add_evidence(df, toxic), edge, "evidence")
    check(quality_classifier.add_statistics, edge, "stats")
    stats = quality_classifier.add_statistics(edge)
    quality = quality_classifier.fit(quality_classifier.add_statistics(docs).join(labels(spark, SF_SMALL, "quality"), "doc_id"))
    check(lambda df: quality_classifier.score(df, quality), stats, "score")
    with_language = documents(spark, SF_SMALL, "doc_id", "text", "lang")
    references = quality_rules.learn_references(with_language)
    check(lambda df: quality_rules.judge(df, references), edge, "rules")
    bpe = SentencePieceBpe(spark, tokenizer_path("piece_bpe_32k.model"))
    check(bpe.round_trip, edge, "ids", "decoded")
    check(lambda df: bpe.round_trip(df.withColumn("__both", F.lit("x"))), edge, "ids", "decoded")
    model = language_id.learn(with_language)
    check(lambda df: language_id.identify(df, model), edge, "language")

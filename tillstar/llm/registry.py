"""Registered queries of the operators: thin wrappers that derive the fixed result columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import (collocations, language_id, license_scan, mixing, multiset_hash, ngram_join, oracle, quality_classifier, quality_rules, token_alignment,
               toxicity, warc_packages)
from ..sources.tables import read_table
from .common import documents, fold, labels, shared_path, stored, tokenizer_path
from .sentencepiece_bpe import SentencePieceBpe
from .wavelet_shards import read_documents, write_shards

Query = Callable[[SparkSession, str], DataFrame]


def sha256(column: str):
    return F.sha2(F.col(column).cast("binary"), 256)


def predicted():
    return (F.col("score") >= 0.3).cast("int").alias("predicted")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from three folds of four, score every text."""
    docs = documents(spark, sf_dir)
    model = toxicity.learn(docs, labels(spark, sf_dir, "toxic").where(fold("doc_id", 4) != 2))
    scored = toxicity.add_evidence(docs, model).select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "evidence.score")
    return scored.select("*", predicted())


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure every text once, learn from four folds of five, score every text."""
    stats = stored(quality_classifier.add_statistics(documents(spark, sf_dir)).select("doc_id", "stats"), "quality-statistics")
    learn_from = labels(spark, sf_dir, "quality").where(fold("doc_id", 5) != 0)
    model = quality_classifier.fit(stats.join(learn_from, "doc_id"))
    scored = quality_classifier.score(stats, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score")
    return scored.select("*", predicted())


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every text against references counted over all documents."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    judged = quality_rules.judge(docs.select("doc_id", "text"), quality_rules.learn_references(docs))
    return judged.select("doc_id", *(f"rules.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learn from four folds of five, predict every text."""
    model = language_id.learn(documents(spark, sf_dir, "doc_id", "text", "lang"), fold("doc_id", 5) != 0)
    found = language_id.identify(documents(spark, sf_dir), model)
    return found.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "language.lang_pred", "language.score")


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; the ids and the decoded text as digests."""
    bpe = SentencePieceBpe(spark, tokenizer_path("piece_bpe_32k.model"))
    both = bpe.round_trip(documents(spark, sf_dir))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"))


def op6_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every text's ids as wavelet shards in the shared folder, and read them back."""
    path = shared_path(spark, "wavelet")
    write_shards(documents(spark, sf_dir), path, tokenizer_path("byte_bpe_50k.json"), end_id=2)
    return read_documents(spark, path, crc_only=True)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mix all documents: each row of the mixture with its epoch and block."""
    mixed = mixing.mix(documents(spark, sf_dir, "doc_id", "text", "source"))
    return mixed.select("doc_id", "source", F.col("mix.epoch").cast("long").alias("epoch"), F.col("mix.block").cast("long").alias("block"))


def op8_multiset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every text and its edited text, and compare them and the next document's fingerprint."""
    rows = multiset_hash.with_next(documents(spark, sf_dir))
    n, moved = F.length("text").cast("long"), F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.left("text", F.length("text") - moved), F.left("next_text", moved))
    rows = rows.select("place", "next_place", F.col("key").alias("doc_id"), n.alias("n_chars"), "text", edited.alias("edited"))
    own = ["place", "next_place", "doc_id", "n_chars", "edited_sha256"]
    texts = rows.select(*own[:-1], sha256("edited").alias("edited_sha256"), F.posexplode(F.array("text", "edited")).alias("which", "t"))
    sums = multiset_hash.lane_sums(texts, [*own, "which"], "t")
    found = stored(sums.select(*own, "which", multiset_hash.lanes().alias("lanes")), "fingerprints")  # read three times
    side = lambda which, name: found.where(F.col("which") == which).select("place", F.col("lanes").alias(name))
    one = found.where("which = 0").select(*own, F.col("lanes").alias("own"))
    one = one.join(side(1, "edited"), "place").join(side(0, "next").withColumnRenamed("place", "next_place"), "next_place")
    text = lambda name: multiset_hash.fingerprint_text(F.col(f"{name}.uniform"), F.col(f"{name}.signs"))
    return one.select("doc_id", "n_chars", "edited_sha256", text("own").alias("fingerprint"), text("edited").alias("edited_fingerprint"),
                      multiset_hash.likeness(F.col("own"), F.col("edited")).alias("near_edited"),
                      multiset_hash.likeness(F.col("own"), F.col("next")).alias("near_next"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scan every text for licence notices: how many, which, and the best score."""
    found = license_scan.scan(documents(spark, sf_dir), ["doc_id"])
    scores = F.transform("licenses", lambda x: x["score"])
    return found.select("doc_id", F.size("licenses").cast("long").alias("n_licenses"),
                        F.array_join(F.transform("licenses", lambda x: x["license"]), ",").alias("licenses"),
                        F.round(F.coalesce(F.array_max(scores), F.lit(0.0)), 6).alias("best_score"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and near-duplicate component."""
    return ngram_join.components(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Align both vocabularies' ids of every text, with the links' counts over all texts."""
    return token_alignment.align(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language, over every text."""
    return collocations.mine(documents(spark, sf_dir, "text", "lang"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page into packages in the shared folder, and read their records back."""
    manifest = warc_packages.write_packages(read_table(spark, sf_dir, "pages", "page_id", "url", "html"), shared_path(spark, "warc"))
    return warc_packages.read_packages(spark, manifest).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity, "op2_quality": op2_quality, "op3_rules": op3_rules, "op4_sentencepiece": op4_sentencepiece,
        "op5_language": op5_language, "op6_wavelet": op6_wavelet, "op7_mixing": op7_mixing, "op8_multiset": op8_multiset,
        "op9_licenses": op9_licenses, "op10_ngram_join": op10_ngram_join,
        "op11_token_alignment": op11_token_alignment, "op12_collocations": op12_collocations, "op13_warc": op13_warc, "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op8_multiset": oracle.multiset(), "op9_licenses": oracle.licenses(), "op10_ngram_join": oracle.ngram_join(),
            "op12_collocations": oracle.collocations(), "op13_warc": oracle.warc()}

"""From raw documents to token ids: language, quality, near duplicates, mixture, encoding.

``STAGES`` lists the stages; each takes (spark, docs, sf_dir) and works on all rows it is given. All but the last
return the columns of ``documents``, in the same order and types. ``run`` applies them to the documents table
and writes each stage's rows as Parquet in the shared folder before the next one reads them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import language_id, mixing, ngram_join, quality_rules
from tillstar.llm.common import documents, stored, tokenizer_path
from tillstar.llm.sentencepiece_bpe import SentencePieceBpe

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_LANGUAGE_SCORE = 0.5
MAX_REPEATS = 1.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts whose language is recognised: not ``und``, and clear for at least half of the words. A missing
    language label is filled in."""
    model = language_id.learn(docs)
    found = language_id.identify(docs, model)
    kept = found.where((F.col("language.lang_pred") != language_id.UNKNOWN) & (F.col("language.score") >= LEAST_LANGUAGE_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", "language.lang_pred")).select(*docs.columns)


def apply_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts that pass the rules, against references counted over these documents."""
    judged = quality_rules.judge(docs, quality_rules.learn_references(docs))
    return judged.where("rules.kept").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that of the smallest id (a row without an id only if none has one, and
    of rows with the same id the first). Rows are told apart by a number, so rows of one id with different texts are compared
    like any others, and every distinct text keeps a row of its group."""
    rows = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "rows-to-compare")
    found = stored(ngram_join.components(rows, id_col="__row").select(F.col("id").alias("__row"), "component"), "near-duplicates")
    # Most groups are one row, which is its component; only the others meet the ids.
    several = found.groupBy("component").agg(F.count("*").alias("k")).where("k > 1").select("component")
    members = found.join(several, "component").join(rows.select("__row", "doc_id"), "__row")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__row")
    kept = members.groupBy("component").agg(F.min(order).alias("first")).select("first.__row")
    dropped = members.select("__row").join(kept, "__row", "left_anti")
    return rows.join(dropped, "__row", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to 1.5 times on average: a row for each use."""
    return mixing.mix(docs, mixing.Target(max_repeats=MAX_REPEATS)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every text, and whether they decode to it."""
    bpe = SentencePieceBpe(spark, tokenizer_path("piece_bpe_32k.model"))
    both = bpe.round_trip(docs)
    return both.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                       (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("round_trip"))


STAGES = [("language_id", identify_language), ("quality_rules", apply_rules), ("ngram_jaccard_join", drop_near_duplicates),
          ("mixing", mix_sources), ("sentencepiece", encode)]

#: Learned models, hashing of n-grams and the vocabulary's merges have no SQL form; tests hold stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, *COLUMNS)
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{name}")
    return docs

"""Training-corpus pipeline: toxicity, language, near-duplicates, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame, which ``run``
writes as Parquet and rereads as the next one's ``docs``. All but the last return the columns of ``documents``.

Null texts and texts without a letter are no language and go at the second stage. Other decisions: a document goes for
toxicity if its score is 0.3 or more, for language if no learned language has half of its words, and as a
near-duplicate if it isn't the one of least doc_id (then of least hash of its text) in its group. Ties and repeated
rows: rows of one doc_id and text are one document and one of them stays. A null doc_id comes after all others. Very
long texts count as a whole in every stage. An empty table gives an empty result. Columns of ``docs`` other than doc_id
and text pass unchanged, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from namesmith.llm import language, packing, toxicity
from namesmith.llm.ngram_join import jaccard_components
from namesmith.llm.runtime import durable, table

LEAST_SHARE = 0.5


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3."""
    return toxicity.keep(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which at least half is in one learned language."""
    return language.keep(docs, language.fit(docs), LEAST_SHARE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of least doc_id, also where a doc_id stands on several texts."""
    key, row, check, group = (_free(docs, name) for name in ("key", "row", "check", "group"))
    # A document without an id goes by its text, after all that have one.
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(1 << 62) + F.xxhash64("text").bitwiseAND(F.lit((1 << 61) - 1)))
    # Repeated rows of one doc_id and text are one document, by two hashes; different texts of one doc_id are several.
    parts = [key, F.col("text").isNull(), "text"]
    keyed = docs.withColumn(key, order).withColumn(row, F.xxhash64(*parts)).withColumn(check, F.xxhash64(F.lit(1), *parts))
    found = jaccard_components(keyed.select(F.col(row).alias("doc_id"), "text"))
    found = found.select(F.col("doc_id").alias(row), F.col("component_id").alias(group)).distinct()
    named = keyed.select(row, key).distinct().join(found, row)
    first = named.groupBy(group).agg(F.min(F.struct(key, row))[row].alias(row)).select(row)
    return keyed.join(first, row, "left_semi").dropDuplicates([row, check]).select(docs.columns)


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have (names differ by more than case)."""
    held = {c.lower() for c in docs.columns}
    while name in held:
        name += "_"
    return name


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", toxicity_stage), ("language", language_stage), ("near_duplicates", near_duplicate_stage), ("packing", packing_stage)]
#: The learned stages and the tokenizer can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

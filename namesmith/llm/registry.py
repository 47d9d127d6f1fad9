"""The queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import ann, byte_bpe, context_tree, language, licenses, mtree, packing, periodic, quality, repair, toxicity, warc
from .ngram_join import jaccard_components
from .runtime import table


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op2_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.predict(documents, language.fit(documents))


def op3_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"))


def op4_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.fit(documents, table(spark, sf_dir, "labels")))


def op5_topk_mtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.neighbours(table(spark, sf_dir, "embeddings"))


def op6_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op7_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))


def op8_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op11_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(table(spark, sf_dir, "documents"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.audit(table(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_language_crf, op3_ann_forest, op4_quality_compression, op5_topk_mtree,
        op6_warc_chunks, op7_toxicity_mil, op8_license_dice, op9_byte_bpe, op10_best_fit_packing, op11_context_tree,
        op12_conversation_repair, op13_periodic_runs,
    )
}

_SHARED = """with sized as (select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages),
groups as (select payload_digest, payload_bytes, max(page_id) as first from sized where payload_bytes >= 1000 group by all)
select page_id, payload_bytes, payload_digest, case when first is null or page_id = first then 'response' else 'revisit' end as record_type,
       case when page_id <> first then first end as refers_to
from sized left join groups using (payload_digest, payload_bytes)"""

#: DuckDB twins; where SQL is too slow on whole tables or can't express the operator there is none.
ORACLES: dict[str, str] = {
    "op5_topk_mtree": """with v as (select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as e from embeddings),
scored as (select q.vec_id as query_id, v.vec_id, list_dot_product(q.e, v.e)::bigint as score from v as q, v where q.vec_id % 50 = 0 and q.vec_id <> v.vec_id),
ranked as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5""",
    "op6_warc_chunks": _SHARED,
    "op8_license_dice": licenses.oracle(),
}

"""Registered queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trendlens.llm import chosen_path, decontamination, html_blocks, maxscore, mixing, periodic_runs, pseudonyms, quality, secret_scan, simhash_trie, spelling_variants, suffix_dedup, toxicity
from trendlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_quality_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return quality.score(docs, quality.co_train(docs, table(spark, folder, "labels")))


@query
def op2_maxscore_top5(spark: SparkSession, folder: str) -> DataFrame:
    return maxscore.search_every_nth(table(spark, folder, "embeddings"))


ORACLE["op2_maxscore_top5"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op3_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.verdicts(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op4_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_blocks.extract(table(spark, folder, "pages"))


@query
def op5_toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


@query
def op7_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan(table(spark, folder, "documents"))


@query
def op8_feistel_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.replace_personal_data(docs, pseudonyms.DEMO_KEY, with_counts=True)


@query
def op9_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).drop("source")


@query
def op10_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_trie.near_duplicate_components(table(spark, folder, "documents"))


@query
def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.deduplicate(table(spark, folder, "documents"))


@query
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    return periodic_runs.digests(periodic_runs.collapse_runs(table(spark, folder, "documents"), periodic_runs.planted))


@query
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.variant_groups(spelling_variants.word_counts(table(spark, folder, "documents"), spelling_variants.planted))


@query
def op13_chosen_path_components(spark: SparkSession, folder: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, folder, "documents"))

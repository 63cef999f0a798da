"""Incremental intake: renaming, seen-before filters, merges and cached results."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import word_count
from trendlens.relational import anti_join_null_safe, keep_one

ARTICLE_KEY = ("title", "publishedAt", "source")


def rename_feed(df: DataFrame) -> DataFrame:
    """Feed field names to article field names."""
    return df.select(
        "title", "description", F.col("source_name").alias("source"), F.col("pubDate").alias("publishedAt"),
        "content", F.col("link").alias("url"), *[c for c in ("pos",) if c in df.columns])


def new_by_url(batch: DataFrame, history: DataFrame, max_results: int | None = None, order: Sequence[str] = ("pos",)) -> DataFrame:
    """Articles of the batch whose url was not seen; with ``max_results`` the batch is cut to that first.

    NULL urls are never in the seen set, so they pass.
    """
    capped = batch if max_results is None else batch.orderBy(*order).limit(max_results)
    seen = history.select("url").where(F.col("url").isNotNull() & (F.col("url") != "")).distinct()
    return capped.join(seen, "url", "left_anti").select(*batch.columns)


def batch_report(batch: DataFrame, fresh: DataFrame) -> DataFrame:
    """One row: new articles and duplicates of a batch."""
    total = batch.agg(F.count(F.lit(1)).alias("fetched"))
    kept = fresh.agg(F.count(F.lit(1)).alias("new"))
    return total.join(F.broadcast(kept), F.lit(True)).select("new", (F.col("fetched") - F.col("new")).alias("duplicates"))


def first_by_url(df: DataFrame, order: Sequence[str] = ("file", "pos")) -> DataFrame:
    """First article per url in file and position order; rows without url go."""
    return keep_one(df.where(F.col("url").isNotNull() & (F.col("url") != "")), ["url"], [F.col(c) for c in order])


def not_yet_scraped(articles: DataFrame, corpus: DataFrame) -> DataFrame:
    return articles.join(corpus.select("url").distinct(), "url", "left_anti").select(*articles.columns)


def resolve_text(df: DataFrame, extracted: str = "extracted", min_words: int = 50) -> DataFrame:
    """Extracted text when it has more than ``min_words`` words, else the feed content.

    ``description`` stands in only where the feed has no content column at all.
    """
    good = F.coalesce(word_count(F.col(extracted)) > min_words, F.lit(False))
    fallback = F.col("content") if "content" in df.columns else (F.col("description") if "description" in df.columns else F.lit(""))
    return df.withColumn("text", F.when(good, F.col(extracted)).otherwise(fallback)).withColumn("extraction_ok", good)


def extraction_report(df: DataFrame) -> DataFrame:
    return df.agg(F.count_if("extraction_ok").alias("successful"), F.count_if(~F.col("extraction_ok")).alias("failed"))


def new_by_key(incoming: DataFrame, existing: DataFrame, keys: Sequence[str] = ARTICLE_KEY) -> DataFrame:
    """Incoming rows whose key tuple is not in ``existing``; NULL parts compare as equal."""
    return anti_join_null_safe(incoming, existing, keys)


def merge_append(existing: DataFrame, new: DataFrame, keys: Sequence[str] = ARTICLE_KEY, order: str = "article_id") -> DataFrame:
    """Union of both; of rows with the same key the last one stays (new after existing)."""
    both = existing.withColumn("__batch", F.lit(0)).unionByName(new.withColumn("__batch", F.lit(1)), allowMissingColumns=True)
    return keep_one(both, keys, [F.col("__batch"), F.col(order)], last=True).drop("__batch")


def score_only_new(articles: DataFrame, scored: DataFrame, scorer: Callable[[DataFrame], DataFrame],
                   keys: Sequence[str] = ("title", "publishedAt")) -> DataFrame:
    """Score articles whose key is not scored yet and append them to the scored ones."""
    return scored.unionByName(scorer(new_by_key(articles, scored, keys)), allowMissingColumns=True)


def reuse_cached(df: DataFrame, cache: DataFrame, col: str, keys: Sequence[str] = ARTICLE_KEY, order: str = "article_id") -> DataFrame:
    """Fill ``col`` from the last cached row of the same key; ``needs_work`` marks NULL or blank results."""
    last = keep_one(cache.select(*keys, col, order), keys, [F.col(order)], last=True)
    last = last.select(*[F.col(k).alias(f"__c_{k}") for k in keys], F.col(col).alias("__cached"))
    cond = None
    for k in keys:
        term = df[k].eqNullSafe(last[f"__c_{k}"])
        cond = term if cond is None else cond & term
    out = df.drop(col).join(last, cond, "left").drop(*[f"__c_{k}" for k in keys]).withColumnRenamed("__cached", col)
    return out.withColumn("needs_work", F.col(col).isNull() | (F.col(col) == ""))

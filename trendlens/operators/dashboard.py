"""Queries behind an article browser: filters, counts, pages and notes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions.labels import confidence_band, spread_note
from trendlens.functions.text import clean_title
from trendlens.operators.daily import timestamp_column
from trendlens.operators.summary import is_blank
from trendlens.relational import keep_one


def filter_articles(df: DataFrame, sentiment: str = "All", topic: str = "All") -> DataFrame:
    out = df
    if sentiment != "All" and "sentiment" in df.columns:
        out = out.where(F.col("sentiment") == sentiment)
    if topic != "All" and "topic_name" in df.columns:
        out = out.where(F.col("topic_name") == topic)
    return out


def unique_articles(df: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Originals when copies are marked, else the first article per title."""
    if "is_original" in df.columns:
        return df.where("is_original")
    return keep_one(df, ["title"], [F.col(id_col)])


def _order(df: DataFrame, newest_first: bool, id_col: str) -> list:
    ts = timestamp_column(df, "publishedAt")
    return [ts.desc_nulls_last() if newest_first else ts.asc_nulls_last(), F.col(id_col)]


def sort_by_date(df: DataFrame, newest_first: bool = True, id_col: str = "article_id") -> DataFrame:
    """Range-partitioned sort, undated rows last."""
    return df.orderBy(*_order(df, newest_first, id_col))


def headline_counts(df: DataFrame, id_col: str = "article_id") -> DataFrame:
    """One row: articles, originals, copies and the most frequent class among the originals."""
    if "is_original" in df.columns:
        return df.agg(F.count(F.lit(1)).alias("total"), F.count_if("is_original").alias("originals"),
                      F.mode(F.when(F.col("is_original"), F.col("sentiment")), True).alias("top_sentiment")).select(
            "total", "originals", (F.col("total") - F.col("originals")).alias("copies"), "top_sentiment")
    whole = df.agg(F.count(F.lit(1)).alias("total"))
    kept = unique_articles(df, id_col).agg(F.count(F.lit(1)).alias("originals"), F.mode("sentiment", True).alias("top_sentiment"))
    return whole.join(F.broadcast(kept), F.lit(True)).select(  # one row each
        "total", "originals", (F.col("total") - F.col("originals")).alias("copies"), "top_sentiment")


def count_by(df: DataFrame, col: str) -> DataFrame:
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), col)


def with_summary(df: DataFrame) -> DataFrame:
    return df.where(~is_blank(F.col("summary")) & (F.lower("summary") != "nan"))


def page_count(df: DataFrame, size: int = 10) -> DataFrame:
    _check_size(size)
    n = df.agg(F.count(F.lit(1)).alias("articles"))
    return n.select("articles", F.when(F.col("articles") == 0, 0).otherwise(F.floor((F.col("articles") - 1) / size) + 1).alias("pages"))


def _check_size(size: int) -> None:
    if not 5 <= size <= 50:
        raise ValueError("page size must be between 5 and 50")


def page(df: DataFrame, number: int = 1, size: int = 10, newest_first: bool = True, id_col: str = "article_id") -> DataFrame:
    """One page of the sorted list. Planned as a top-k: every task keeps ``number * size`` rows at most."""
    _check_size(size)
    if number < 1:
        raise ValueError("pages count from 1")
    rows = df.withColumn("clean_title", clean_title(F.col("title")))
    return rows.orderBy(*_order(df, newest_first, id_col)).offset((number - 1) * size).limit(size)


def filter_values(df: DataFrame, cols: Sequence[str] = ("sentiment", "topic", "source")) -> DataFrame:
    """Distinct values of each filter column as rows (filter, value)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).cast("string").alias("value")) for c in cols])
    return df.select(F.explode(pairs).alias("x")).select("x.*").where(F.col("value").isNotNull()).distinct()


def with_notes(df: DataFrame) -> DataFrame:
    """Add ``spread_note`` and, where there is a confidence, its band."""
    out = df.withColumn("spread_note", spread_note(F.col("is_original"), F.col("similarity_category"), F.col("original_source"),
                                                   F.col("similarity_score"), F.col("spread_count")))
    return out.withColumn("confidence_band", confidence_band(F.col("sentiment_confidence"))) if "sentiment_confidence" in df.columns else out

"""Daily roll-ups of an article table. Each is one hash aggregate with map-side partials."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trendlens.functions.labels import dominant_balanced, numeric_to_class, sentiment_numeric
from trendlens.relational import require_columns, share

BASE_COLUMNS = ("total_articles", "avg_sentiment", "std_sentiment", "min_sentiment", "max_sentiment", "dominant_sentiment")
MODEL_INPUTS = BASE_COLUMNS[:3]


def timestamp_column(df: DataFrame, name: str) -> Column:
    """Column as timestamp; text that is no timestamp becomes NULL."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.col(name).try_cast("timestamp_ntz")
    return F.col(name)


def with_date(df: DataFrame, date_col: str = "publishedAt") -> DataFrame:
    """Add ``date`` and drop the rows that have none."""
    return df.withColumn("date", F.to_date(timestamp_column(df, date_col))).where(F.col("date").isNotNull())


def originals_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("is_original")) if "is_original" in df.columns else df


def daily_base(df: DataFrame, by: Sequence[str] = (), date_col: str = "publishedAt") -> DataFrame:
    """Articles per day with mean, deviation, range and mode of the class."""
    require_columns(df, [date_col, "sentiment"])
    rows = with_date(df, date_col).withColumn("__s", sentiment_numeric(F.col("sentiment")))
    return rows.groupBy(*by, "date").agg(
        F.count("title").alias("total_articles"),
        F.avg("__s").alias("avg_sentiment"),
        F.coalesce(F.stddev_samp("__s"), F.lit(0.0)).alias("std_sentiment"),
        F.min("__s").alias("min_sentiment"),
        F.max("__s").alias("max_sentiment"),
        F.coalesce(F.mode("sentiment", True), F.lit("neutral")).alias("dominant_sentiment"),
    )


def dominant_sentiment(df: DataFrame, by: Sequence[str] = (), date_col: str = "publishedAt") -> DataFrame:
    """Most frequent class per day; ties go to the alphabetically first."""
    return with_date(df, date_col).groupBy(*by, "date").agg(
        F.coalesce(F.mode("sentiment", True), F.lit("neutral")).alias("dominant_sentiment"))


def topic_pivot(df: DataFrame, topics: Sequence[int], by: Sequence[str] = (), date_col: str = "publishedAt") -> DataFrame:
    """``topic_{k}_count`` per day for the given topics; conditional counts, so one shuffle."""
    counts = [F.count_if(F.col("topic") == k).alias(f"topic_{k}_count") for k in topics]
    return with_date(df, date_col).groupBy(*by, "date").agg(*counts)


def topic_ids(df: DataFrame, most: int = 2_000) -> list[int]:
    """Distinct topic ids, which become column names. More than ``most`` are an error: :func:`topic_counts` has them as rows."""
    found = df.select("topic").where(F.col("topic").isNotNull()).distinct().limit(most + 1).collect()  # bounded
    if len(found) > most:
        raise ValueError(f"more than {most} topics for one column each; use topic_counts")
    return sorted(r[0] for r in found)


def topic_counts(df: DataFrame, by: Sequence[str] = (), date_col: str = "publishedAt") -> DataFrame:
    """(by, date, topic, count): the pivot as rows, for any number of topics."""
    return with_date(df, date_col).where(F.col("topic").isNotNull()).groupBy(*by, "date", "topic").agg(F.count(F.lit(1)).alias("count"))


def add_topic_counts(daily: DataFrame, pivot: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    counts = [c for c in pivot.columns if c.startswith("topic_")]
    return daily.join(pivot, [*by, "date"], "left").na.fill(0, counts)


def sentiment_over_time(df: DataFrame, date_col: str = "publishedAt") -> DataFrame:
    return with_date(df, date_col).groupBy("date", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def daily_class_counts(df: DataFrame, by: Sequence[str] = (), date_col: str = "publishedAt") -> DataFrame:
    """Per day: articles and articles per class, mean and (NULL for one article) deviation.

    A numeric ``sentiment`` is cut into classes first.
    """
    rows = with_date(df, date_col) if date_col in df.columns else df.where(F.col("date").isNotNull())
    if isinstance(df.schema["sentiment"].dataType, T.StringType):
        label, value = F.col("sentiment"), sentiment_numeric(F.col("sentiment"), unknown=None)
    else:
        value = F.col("sentiment").cast("double")
        label = numeric_to_class(value)
    rows = rows.withColumn("__c", label).withColumn("__s", value)
    return rows.groupBy(*by, "date").agg(
        F.count("sentiment").alias("article_count"),
        *[F.count_if(F.col("__c") == c).alias(f"{c}_count") for c in ("positive", "negative", "neutral")],
        F.avg("__s").alias("avg_sentiment"),
        F.stddev_samp("__s").alias("std_sentiment"),
    )


def class_shares(daily: DataFrame) -> DataFrame:
    """Add the share of each class and the score positive minus negative."""
    total = F.col("positive_count") + F.col("negative_count") + F.col("neutral_count")
    with_pct = daily.select("*", *[
        F.try_divide(F.col(f"{c}_count").cast("double"), total.cast("double")).alias(f"{c}_pct")
        for c in ("positive", "negative", "neutral")])
    return with_pct.withColumn("sentiment_score", F.col("positive_pct") - F.col("negative_pct"))


def with_dominant_class(daily: DataFrame) -> DataFrame:
    return daily.withColumn("dominant_sentiment", dominant_balanced(
        F.col("positive_pct"), F.col("negative_pct"), F.col("neutral_pct"), F.col("sentiment_score")))


def class_distribution(daily: DataFrame) -> DataFrame:
    """Share of days per dominant class."""
    counts = daily.groupBy("dominant_sentiment").agg(F.count(F.lit(1)).alias("days"))
    whole = counts.agg(F.sum("days").alias("__all"))
    return counts.join(F.broadcast(whole), F.lit(True)).select(  # one row of total
        "dominant_sentiment", "days", share(F.col("days"), F.col("__all")).alias("share"))

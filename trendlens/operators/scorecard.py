"""Quality scorecard of a processed corpus. Each section is one row from one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.labels import tier
from trendlens.functions.text import text_or_empty, word_count
from trendlens.operators.daily import timestamp_column
from trendlens.operators.summary import is_blank
from trendlens.relational import share


def data_quality(df: DataFrame) -> DataFrame:
    complete = F.col("text").isNotNull() & F.col("sentiment").isNotNull() & F.col("topic").isNotNull() & ~is_blank(F.col("summary"))
    chars, words = F.length(text_or_empty(F.col("text"))), word_count(F.col("text"))
    return df.agg(
        F.count(F.lit(1)).alias("total_articles"), F.count_if(complete).alias("complete_articles"),
        (share(F.count_if(complete), F.count(F.lit(1))) * 100).alias("completeness_rate"),
        F.round(F.avg(chars), 0).alias("avg_text_length"), F.round(F.avg(words), 0).alias("avg_word_count"),
        F.min(chars).alias("min_text_length"), F.max(chars).alias("max_text_length"))


def sentiment_balance(df: DataFrame, warn: float = 10.0) -> DataFrame:
    """Shares of the classes that occur, in percent with one place, and largest over smallest share."""
    counts = df.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"))
    all_rows = counts.agg(F.sum("n").alias("all"))
    known = counts.where(F.col("sentiment").isNotNull()).join(F.broadcast(all_rows), F.lit(True))  # one row
    pct = known.withColumn("pct", F.round(F.col("n") * 100.0 / F.col("all"), 1))
    names = ("negative", "neutral", "positive")
    shares = [F.coalesce(F.max(F.when(F.col("sentiment") == c, F.col("pct"))), F.lit(0.0)).alias(f"{c}_pct") for c in names]
    out = pct.agg(*shares, F.max("pct").alias("hi"), F.min("pct").alias("lo"))
    ratio = F.when(F.col("lo") > 0, F.try_divide("hi", "lo")).otherwise(F.lit(float("inf")))
    return out.select(*[f"{c}_pct" for c in names], ratio.alias("imbalance_ratio"), (ratio > warn).alias("imbalanced"))


def topic_quality(df: DataFrame, warn: float = 5.0) -> DataFrame:
    sizes = df.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    real = (F.col("topic") != -1) & F.col("topic").isNotNull()
    size = F.when(real, F.col("n"))
    out = sizes.agg(
        F.count_if(real).alias("num_topics"), F.coalesce(F.sum(F.when(F.col("topic") == -1, F.col("n"))), F.lit(0)).alias("outlier_count"),
        F.sum("n").alias("all"), F.coalesce(F.round(F.avg(size), 1), F.lit(0.0)).alias("avg_topic_size"),
        F.coalesce(F.min(size), F.lit(0)).alias("min_topic_size"), F.coalesce(F.max(size), F.lit(0)).alias("max_topic_size"))
    ratio = F.try_divide(F.col("max_topic_size").cast("double"), F.col("min_topic_size"))
    return out.select("num_topics", "outlier_count", (share(F.col("outlier_count"), F.col("all")) * 100).alias("outlier_rate"),
                      "avg_topic_size", "min_topic_size", "max_topic_size", ratio.alias("size_ratio"), F.coalesce(ratio > warn, F.lit(False)).alias("uneven"))


def first_labels(df: DataFrame, id_col: str = "article_id") -> DataFrame:
    """Label of the first article of each topic, with the topic's size and share."""
    per = df.where(F.col("topic").isNotNull()).groupBy("topic").agg(
        F.min_by("topic_label", F.when(F.col("topic_label").isNotNull(), F.col(id_col))).alias("topic_label"), F.count(F.lit(1)).alias("count"))
    whole = df.agg(F.count(F.lit(1)).alias("all"))
    return per.join(F.broadcast(whole), F.lit(True)).select("topic", "topic_label", "count", (share(F.col("count"), F.col("all")) * 100).alias("pct"))


def coherence_proxy(terms: DataFrame) -> DataFrame:
    """Mean number of keywords per topic on a 0-100 scale where ten keywords are full marks."""
    per = terms.where(F.col("topic") != -1).groupBy("topic").agg(F.count("term").alias("n"))
    return per.agg(F.round(F.least(F.coalesce(F.avg("n"), F.lit(0.0)) / 10 * 100, F.lit(100.0)), 1).alias("coherence_proxy"))


def summary_section(df: DataFrame) -> DataFrame:
    has = ~is_blank(F.col("summary"))
    chars, words = F.when(has, F.length("summary")), F.when(has, word_count(F.col("summary")))
    ratio = F.when(has, F.try_divide(F.length(text_or_empty(F.col("text"))).cast("double"), F.length("summary")))
    return df.agg(
        (share(F.count_if(has), F.count(F.lit(1))) * 100).alias("coverage"),
        F.round(F.avg(chars), 0).alias("avg_summary_length"), F.round(F.avg(words), 0).alias("avg_summary_words"),
        F.avg(ratio).alias("avg_compression"), F.min(chars).alias("min_summary_length"), F.max(chars).alias("max_summary_length"),
        F.count_if(words < 20).alias("too_short"), F.count_if(words > 150).alias("too_long"),
    ).withColumn("optimal", F.coalesce(F.col("avg_compression").between(5, 15), F.lit(False)))


def _span(lo: Column, hi: Column) -> Column:
    """Whole 24-hour units between two timestamps."""
    return F.timestamp_diff("DAY", lo, hi)


def temporal(df: DataFrame) -> DataFrame:
    ts = timestamp_column(df, "publishedAt")
    out = df.agg(F.count(ts).alias("articles_with_dates"), F.min(ts).alias("start"), F.max(ts).alias("end"))
    out = out.withColumn("date_range_days", _span(F.col("start"), F.col("end")))
    rate = F.round(F.col("articles_with_dates") / F.greatest("date_range_days", F.lit(1)), 2)
    return out.select("articles_with_dates", "date_range_days", rate.alias("articles_per_day"), "start", "end")


def sufficiency_gate(df: DataFrame, minimum: int = 14, comfortable: int = 30) -> DataFrame:
    """Is the time span long enough to train on, and long enough not to warn?"""
    days = F.coalesce(F.col("date_range_days"), F.lit(0))
    return temporal(df).select("date_range_days", (days >= minimum).alias("can_train"), (days < comfortable).alias("warn"))


def overall_score(completeness: Column, imbalance: Column, outlier_rate: Column, size_ratio: Column, coverage: Column,
                  compression: Column) -> dict[str, Column]:
    """Component scores and their weighted sum."""
    balance = F.greatest(F.lit(0.0), 100 - (imbalance - 1) * 10)
    topics = F.greatest(F.lit(0.0), 100 - F.greatest(outlier_rate - 20, F.lit(0.0)) * 2 - F.greatest(F.coalesce(size_ratio, F.lit(0.0)) - 5, F.lit(0.0)) * 5)
    bonus = F.when(compression.between(5, 15), F.least(F.lit(100.0), coverage + 10)).otherwise(coverage)
    total = 0.30 * completeness + 0.15 * balance + 0.25 * topics + 0.30 * bonus
    return {"completeness_score": completeness, "balance_score": balance, "topic_score": topics, "summary_score": bonus, "overall_score": total}


def rating(score: Column) -> Column:
    return tier(score, [(90, "EXCELLENT"), (75, "GOOD"), (60, "ACCEPTABLE")], "NEEDS IMPROVEMENT")


def sections(df: DataFrame) -> dict[str, DataFrame]:
    return {"data_quality": data_quality(df), "sentiment": sentiment_balance(df), "topics": topic_quality(df),
            "summarization": summary_section(df), "temporal": temporal(df)}


def scored(df: DataFrame) -> DataFrame:
    """One row: component scores, overall score and rating."""
    parts = sections(df)
    row = reduce(lambda a, b: a.join(F.broadcast(b), F.lit(True)),  # one row each
                 [parts[k] for k in ("data_quality", "sentiment", "topics", "summarization")])
    cols = overall_score(*[F.col(c) for c in ("completeness_rate", "imbalance_ratio", "outlier_rate", "size_ratio", "coverage", "avg_compression")])
    out = row.select(*[e.alias(n) for n, e in cols.items()])
    return out.select(*[F.round(c, 1).alias(c) for c in out.columns], rating(F.col("overall_score")).alias("rating"))


def full_report(df: DataFrame, terms: DataFrame | None = None, top: int = 20) -> DataFrame:
    """One row of nested structs, one per section.

    With ``terms`` (topic, term) there is the coherence of topics, with a ``topic_label`` column in ``df`` the labels, sizes and
    shares of the ``top`` largest topics.
    """
    parts = {**sections(df), "overall_quality": scored(df)}
    if terms is not None:
        parts["coherence"] = coherence_proxy(terms)
    packed = [part.select(F.struct("*").alias(name)) for name, part in parts.items()]
    if "topic_label" in df.columns:
        largest = first_labels(df).orderBy(F.col("count").desc(), "topic").limit(top)
        order = F.struct((-F.col("count")).alias("minus"), "topic", "topic_label", "count", "pct")
        labels = largest.agg(F.sort_array(F.collect_list(order)).alias("x"))  # at most ``top`` entries
        packed.append(labels.select(F.transform("x", lambda t: F.struct(t["topic"].alias("topic"), t["topic_label"].alias("topic_label"), t["count"].alias("count"), t["pct"].alias("pct"))).alias("topic_labels")))
    return reduce(lambda a, b: a.join(F.broadcast(b), F.lit(True)), packed)  # one row each

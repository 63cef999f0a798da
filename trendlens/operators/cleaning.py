"""Article cleaning: text choice, filters, rejection reasons and the topic document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.functions import text as tx
from trendlens.operators import dedup
from trendlens.operators.ingest import ARTICLE_KEY, merge_append
from trendlens.session import cut_lineage
from trendlens.sources.readers import source_name


def _optional(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def with_clean_text(df: DataFrame) -> DataFrame:
    """Add ``combined_text`` (chosen input), ``clean_text`` and ``words``."""
    combined = tx.choose_text(_optional(df, "text"), F.col("title"), _optional(df, "description"), _optional(df, "content"))
    out = df.withColumn("combined_text", combined)
    # the one-element explode keeps the optimizer from copying the regex chain into every reader
    out = out.withColumn("clean_text", F.explode(F.array(tx.scrub(F.col("combined_text")))))
    return out.withColumn("words", tx.flat_word_count(F.col("clean_text")))


def classify_articles(df: DataFrame, existing: DataFrame | None = None, min_words: int = 100) -> DataFrame:
    """Add ``reject_reason``: existing, paid, short, or NULL for an article to keep; tested in this order."""
    rows = with_clean_text(df.withColumns({"title": tx.text_or_empty(F.col("title")), "source": source_name(F.col("source"))}))
    if existing is not None:
        seen = existing.select(*[F.col(k).alias(f"__e_{k}") for k in ARTICLE_KEY]).distinct().withColumn("__seen", F.lit(True))
        cond = None
        for k in ARTICLE_KEY:
            term = rows[k].eqNullSafe(seen[f"__e_{k}"])
            cond = term if cond is None else cond & term
        rows = rows.join(seen, cond, "left").drop(*[f"__e_{k}" for k in ARTICLE_KEY])
    else:
        rows = rows.withColumn("__seen", F.lit(None).cast("boolean"))
    reason = (
        F.when(F.coalesce(F.col("__seen"), F.lit(False)), "existing")
        .when(tx.is_paywalled(F.col("combined_text")), "paid")
        .when(F.col("words") < min_words, "short")
    )
    return rows.withColumn("reject_reason", reason).drop("__seen")


def rejection_report(df: DataFrame, existing: DataFrame | None = None, min_words: int = 100) -> DataFrame:
    """Counts per outcome: paid, short, existing, exact_duplicate, new."""
    rows = classify_articles(df, existing, min_words)
    first = rows.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    kept = rows.where(F.col("reject_reason").isNull()).groupBy(*ARTICLE_KEY).agg(F.count(F.lit(1)).alias("copies"))
    split = kept.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("exact_duplicate"), F.count(F.lit(1)).alias("new"))
    split = split.select(F.expr("stack(2, 'exact_duplicate', exact_duplicate, 'new', new) AS (reason, n)"))
    return first.where(F.col("reason") != "kept").unionByName(split.where(F.col("n") > 0))


def clean_articles(df: DataFrame, existing: DataFrame | None = None, detect_spread: bool = True, min_words: int = 100,
                   threshold: float = 0.70, id_col: str = "article_id") -> DataFrame:
    """Cleaned articles merged with the existing ones, copies marked when ``detect_spread``."""
    rows = classify_articles(df, existing, min_words).where(F.col("reject_reason").isNull())
    fresh = rows.select(id_col, "title", F.col("clean_text").alias("text"), "publishedAt", "source")
    base = fresh.limit(0) if existing is None else existing.select(id_col, "title", "text", "publishedAt", "source")
    merged = merge_append(base, fresh, order=id_col)
    # the copy detector reads its input several times; cleaning should run once
    return dedup.detect_duplicates_and_spread(cut_lineage(merged), threshold, id_col=id_col) if detect_spread else merged


def build_topic_doc(df: DataFrame, lead_chars: int | None = None, use_title: bool = True) -> DataFrame:
    """Add ``doc``: normalised title plus the normalised text, or its first ``lead_chars`` characters; empty texts and docs go."""
    rows = df.withColumn("text", tx.collapse_ws(tx.text_or_empty(F.col("text")))).where(F.length("text") > 0)
    start = tx.lead(F.col("text"), lead_chars)
    if use_title and "title" in df.columns:
        rows = rows.withColumn("title", tx.collapse_ws(tx.text_or_empty(F.col("title"))))
        doc = F.concat(F.col("title"), F.lit("\n\n"), start)
    else:
        doc = start
    return rows.withColumn("doc", tx.collapse_ws(doc)).where(F.length("doc") > 0)

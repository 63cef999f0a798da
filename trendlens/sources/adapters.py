"""Article-shaped views over the benchmark tables, each with the same view in SQL for checking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions.labels import sentiment_numeric

ARTICLE_COLUMNS = ("article_id", "title", "text", "publishedAt", "source", "sentiment", "topic")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def articles_from_events(spark: SparkSession, folder: str) -> DataFrame:
    """One short article per event: class from the event type, topic from the payload."""
    k = F.regexp_extract("props", r'"k": (\d+)', 1).try_cast("long")
    kind = F.col("event_type")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("article_id"),
        F.concat_ws(" ", kind, F.col("props")).alias("title"),
        F.concat_ws(" ", kind, F.col("props")).alias("text"),
        F.col("ts").cast("timestamp_ntz").alias("publishedAt"),
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("source"),
        F.when(kind.isin("purchase", "signup"), "positive").when(kind == "error", "negative").otherwise("neutral").alias("sentiment"),
        (k % 5).alias("topic"),
    )


def document_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as articles: the first line is the title, the time follows from the id."""
    minute = F.pmod(F.col("doc_id") * 37, F.lit(43200)).cast("int")
    return table(spark, folder, "documents").select(
        F.col("doc_id").alias("article_id"), F.substring_index("text", "\n", 1).alias("title"), "text",
        F.timestamp_add("MINUTE", minute, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("publishedAt"), "source", "lang")


def articles_from_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Document articles with class, topic and summary: labels give the class, language the topic.

    Documents without a label row have topic -1; their summary is NULL, low-quality ones get a
    blank summary, the others their first line.
    """
    labels = table(spark, folder, "labels").groupBy(F.col("doc_id").alias("article_id")).agg(
        F.max("quality").alias("quality"), F.max("toxic").alias("toxic")
    )
    lang = F.when(F.col("lang") == "en", 0).when(F.col("lang") == "fr", 1).when(F.col("lang") == "de", 2).otherwise(3)
    return document_articles(spark, folder).join(labels, "article_id", "left").select(
        "article_id", "title", "text", "publishedAt", "source",
        F.when(F.col("toxic") == 1, "negative").when(F.col("quality") == 1, "positive").otherwise("neutral").alias("sentiment"),
        F.when(F.col("quality").isNull(), -1).otherwise(lang).cast("long").alias("topic"),
        F.when(F.col("quality").isNull(), F.lit(None)).when(F.col("quality") == 0, "").otherwise(F.col("title")).alias("summary"),
    )


def orders_as_articles(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as articles: a long daily series keyed by order status."""
    p = F.col("o_orderpriority")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("article_id"),
        p.alias("title"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("publishedAt"),
        F.col("o_orderstatus").alias("source"),
        F.when(p.isin("1-URGENT", "2-HIGH"), "negative").when(p == "5-LOW", "positive").otherwise("neutral").alias("sentiment"),
    )


def score_of(df: DataFrame) -> DataFrame:
    return df.withColumn("sentiment_numeric", sentiment_numeric(F.col("sentiment")))


# --- the same views for the checking engine -------------------------------------------------

EVENTS_SQL = """
ev AS (
  SELECT event_id AS article_id, event_type || ' ' || props AS title, event_type || ' ' || props AS text,
         ts AS publishedAt, CAST(ts AS DATE) AS date, 'user_' || user_id AS source,
         CASE WHEN event_type IN ('purchase','signup') THEN 'positive' WHEN event_type = 'error' THEN 'negative'
              ELSE 'neutral' END AS sentiment,
         TRY_CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS BIGINT) % 5 AS topic
  FROM events)"""

DOCS_SQL = """
docs AS (
  SELECT d.doc_id AS article_id, split_part(text, chr(10), 1) AS title, text,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((d.doc_id * 37) % 43200 AS BIGINT)) AS publishedAt,
         CAST(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((d.doc_id * 37) % 43200 AS BIGINT)) AS DATE) AS date,
         source,
         CASE WHEN toxic = 1 THEN 'negative' WHEN quality = 1 THEN 'positive' ELSE 'neutral' END AS sentiment,
         CASE WHEN quality IS NULL THEN -1 WHEN lang = 'en' THEN 0 WHEN lang = 'fr' THEN 1 WHEN lang = 'de' THEN 2
              ELSE 3 END AS topic,
         CASE WHEN quality IS NULL THEN NULL WHEN quality = 0 THEN '' ELSE split_part(text, chr(10), 1) END AS summary
  FROM documents d
  LEFT JOIN (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id) l
    ON d.doc_id = l.doc_id)"""

ORDERS_SQL = """
orda AS (
  SELECT o_orderkey AS article_id, o_orderpriority AS title, o_orderdate AS publishedAt, CAST(o_orderdate AS DATE) AS date,
         o_orderstatus AS source,
         CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'negative' WHEN o_orderpriority = '5-LOW' THEN 'positive'
              ELSE 'neutral' END AS sentiment
  FROM orders)"""


def daily_sql(name: str, source: str, by: str = "") -> str:
    """Daily base aggregates of an article view, optionally per key."""
    key = f"{by}, " if by else ""
    join = f"AND m.{by} = a.{by}" if by else ""
    part = f"{by}, date" if by else "date"
    return f"""
{name} AS (
  SELECT {'a.' + by + ',' if by else ''} a.date, total_articles, avg_sentiment, std_sentiment, min_sentiment, max_sentiment,
         dominant_sentiment
  FROM (SELECT {key}date, count(title) AS total_articles, avg(s) AS avg_sentiment,
               coalesce(stddev_samp(s), 0) AS std_sentiment, min(s) AS min_sentiment, max(s) AS max_sentiment
        FROM (SELECT *, CASE sentiment WHEN 'negative' THEN -1.0 WHEN 'positive' THEN 1.0 ELSE 0.0 END::DOUBLE AS s FROM {source})
        WHERE date IS NOT NULL GROUP BY {key}date) a
  LEFT JOIN (SELECT {key}date, sentiment AS dominant_sentiment FROM (
          SELECT {key}date, sentiment, row_number() OVER (PARTITION BY {part} ORDER BY count(*) DESC, sentiment) AS rn
          FROM {source} GROUP BY {key}date, sentiment) WHERE rn = 1) m
    ON m.date = a.date {join})"""


VIEWS_SQL = ",".join([
    EVENTS_SQL, DOCS_SQL, ORDERS_SQL,
    daily_sql("dailye", "ev"), daily_sql("dailyo", "orda"), daily_sql("dailyos", "orda", "source"),
    daily_sql("dailyes", "ev", "source"),
])


def feed_from_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Web pages as a news feed with the feed's own field names."""
    minute = (F.col("page_id") * 53).cast("int")
    when = F.timestamp_add("MINUTE", minute, F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    return table(spark, folder, "pages").select(
        F.col("page_id").alias("pos"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.lit(None).cast("string").alias("description"), F.regexp_extract("url", "//([^/]+)", 1).alias("source_name"),
        when.cast("string").alias("pubDate"), F.col("html").alias("content"), F.col("url").alias("link"))


FEED_SQL = """
feed AS (
  SELECT page_id AS pos, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, CAST(NULL AS VARCHAR) AS description,
         regexp_extract(url, '//([^/]+)', 1) AS source,
         CAST(TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(page_id * 53 AS BIGINT)) AS VARCHAR) AS "publishedAt",
         html AS content, url
  FROM pages)"""

VIEWS_SQL = VIEWS_SQL + "," + FEED_SQL

"""Queries over raw intake and text cleaning."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from trendlens.functions import text as tx
from trendlens.operators import cleaning, html, ingest
from trendlens.operators.sentiment import default_lexicon, score_with_lexicon
from trendlens.plans.queries_copies import SPREAD_SQL
from trendlens.plans.registry import query
from trendlens.sources.adapters import articles_from_documents, articles_from_events, feed_from_pages, table

CUT_FEED = "2024-01-05"  # articles before this day play the part of what was stored by earlier runs
CUT_DOCS = "2024-01-15"


def feed(spark, sf):
    return ingest.rename_feed(feed_from_pages(spark, sf))


def stored_feed(spark, sf):
    return feed(spark, sf).where(F.col("publishedAt") < CUT_FEED)


def docs(spark, sf):
    return articles_from_documents(spark, sf).drop("summary")


def stored_docs(spark, sf):
    return docs(spark, sf).where(F.col("publishedAt") < F.lit(CUT_DOCS).cast("timestamp_ntz"))


_ART = "title:s source:s publishedAt:s url:s pos:i"

query("ing1_rename_feed", "title:s description:s source:s publishedAt:s content:s url:s pos:i", "SELECT * FROM feed")(feed)
query("ing2_new_by_url", _ART, f"""
SELECT * FROM feed WHERE url IS NULL OR url NOT IN (SELECT url FROM feed WHERE publishedAt < '{CUT_FEED}' AND url IS NOT NULL)""")(
    lambda spark, sf: ingest.new_by_url(feed(spark, sf), stored_feed(spark, sf), None))
query("ing2_new_by_url_capped", _ART, f"""
SELECT * FROM (SELECT * FROM feed ORDER BY publishedAt DESC, pos LIMIT 50)
WHERE url IS NULL OR url NOT IN (SELECT url FROM feed WHERE publishedAt < '{CUT_FEED}' AND url IS NOT NULL)""")(
    lambda spark, sf: ingest.new_by_url(feed(spark, sf).withColumn("recent", F.expr("-unix_timestamp(publishedAt)")), stored_feed(spark, sf),
                                        50, ("recent", "pos")))
query("ing2_batch_report", "new:i duplicates:i", f"""
SELECT count(*) FILTER (WHERE url NOT IN (SELECT url FROM feed WHERE publishedAt < '{CUT_FEED}')) AS new,
       count(*) FILTER (WHERE url IN (SELECT url FROM feed WHERE publishedAt < '{CUT_FEED}')) AS duplicates FROM feed""")(
    lambda spark, sf: ingest.batch_report(feed(spark, sf), ingest.new_by_url(feed(spark, sf), stored_feed(spark, sf), None)))
query("ing3_first_by_url", _ART, """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY url ORDER BY source, pos) AS rn FROM feed WHERE url <> '') WHERE rn = 1""")(
    lambda spark, sf: ingest.first_by_url(feed(spark, sf), ("source", "pos")))
query("ing4_not_yet_scraped", _ART, f"SELECT * FROM feed WHERE url NOT IN (SELECT url FROM feed WHERE publishedAt < '{CUT_FEED}')")(
    lambda spark, sf: ingest.not_yet_scraped(feed(spark, sf), stored_feed(spark, sf)))

_WS = tx.WHITESPACE
CLEAN_SQL = f"""
cl AS (SELECT article_id, title, source, publishedAt, text,
  trim(regexp_replace(regexp_replace(regexp_replace(text, '{tx.HTML_TAG}', '', 'g'), '{tx.URL}', '', 'g'), '{_WS}', ' ', 'g')) AS clean_text FROM docs),
cw AS (SELECT *, CASE WHEN clean_text = '' THEN 0 ELSE len(string_split(clean_text, ' ')) END AS words FROM cl)"""


def _words_sql(col):
    flat = f"trim(regexp_replace(coalesce({col}, ''), '{_WS}', ' ', 'g'))"
    return f"CASE WHEN {flat} = '' THEN 0 ELSE len(string_split({flat}, ' ')) END"


_STRIP = f"trim(regexp_replace(regexp_replace(content, '{tx.HTML_TAG}', '', 'g'), '{_WS}', ' ', 'g'))"
RESOLVE_SQL = f"""WITH fx AS (SELECT pos, url, title AS content, {_STRIP} AS extracted FROM feed),
rs AS (SELECT *, {_words_sql('extracted')} > 50 AS extraction_ok FROM fx)"""


def resolved(spark, sf):
    rows = feed(spark, sf).withColumn("extracted", tx.collapse_ws(tx.strip_html(F.col("content")))).withColumn("content", F.col("title"))
    return ingest.resolve_text(rows)


query("ing5_resolve_text", "pos:i url:s text:s extraction_ok:b",
      f"{RESOLVE_SQL}\nRESULT SELECT pos, url, CASE WHEN extraction_ok THEN extracted ELSE content END AS text, extraction_ok FROM rs")(resolved)
query("ing5_extraction_report", "successful:i failed:i", f"""{RESOLVE_SQL}
RESULT SELECT count(*) FILTER (WHERE extraction_ok) AS successful, count(*) FILTER (WHERE NOT extraction_ok) AS failed FROM rs""")(
    lambda spark, sf: ingest.extraction_report(resolved(spark, sf)))
query("ing6_extract_main_text", "page_id:i url:s text:s")(
    lambda spark, sf: html.extract_main_text(table(spark, sf, "pages"), "html").select("page_id", "url", F.col("main_text").alias("text")))

_DOC = "article_id:i title:s source:s publishedAt:s"
_SEEN = f"(SELECT title, publishedAt, source FROM docs WHERE publishedAt < TIMESTAMP '{CUT_DOCS}')"
query("ing7_new_by_key", _DOC, f"SELECT * FROM docs WHERE (title, publishedAt, source) NOT IN {_SEEN}")(
    lambda spark, sf: ingest.new_by_key(docs(spark, sf), stored_docs(spark, sf)))
query("ing8_merge_append", "article_id:i title:s source:s", """
SELECT article_id, title, source FROM (SELECT article_id, title, source, row_number() OVER (PARTITION BY title, source ORDER BY b DESC, article_id DESC) AS rn
  FROM (SELECT article_id, title, source, 0 AS b FROM docs WHERE sentiment = 'positive' UNION ALL SELECT article_id, title, source, 1 AS b FROM docs))
WHERE rn = 1""")(
    lambda spark, sf: ingest.merge_append(docs(spark, sf).where("sentiment = 'positive'"), docs(spark, sf), ("title", "source")))


@query("ing9_score_only_new", "article_id:i sentiment:s sentiment_confidence:d", """
WITH old AS (SELECT article_id, title, publishedAt, sentiment, 1.0 AS sentiment_confidence FROM ev WHERE publishedAt < TIMESTAMP '2024-01-10'),
fresh AS (SELECT * FROM ev WHERE (title, publishedAt) NOT IN (SELECT title, publishedAt FROM old)),
lg AS (SELECT article_id, CASE WHEN title LIKE 'error%' THEN 1.0 ELSE 0.0 END::DOUBLE AS neg, 0.5::DOUBLE AS neu,
       CASE WHEN title LIKE 'purchase%' OR title LIKE 'signup%' THEN 1.0 ELSE 0.0 END::DOUBLE AS pos FROM fresh)
RESULT SELECT article_id, sentiment, sentiment_confidence FROM old
UNION ALL SELECT article_id, CASE WHEN neg = greatest(neg, neu, pos) THEN 'negative' WHEN neu = greatest(neg, neu, pos) THEN 'neutral' ELSE 'positive' END,
  round(exp(greatest(neg, neu, pos)) / (exp(neg) + exp(neu) + exp(pos)), 4) FROM lg""")
def ing9(spark, sf):
    arts = articles_from_events(spark, sf)
    old = arts.where(F.col("publishedAt") < F.lit("2024-01-10").cast("timestamp_ntz")).withColumn("sentiment_confidence", F.lit(1.0))
    return ingest.score_only_new(arts.drop("sentiment"), old, lambda d: score_with_lexicon(d, default_lexicon(spark)))


@query("ing10_reuse_cached", "article_id:i summary:s needs_work:b", f"""
WITH cache AS (SELECT title, source, summary FROM (SELECT *, row_number() OVER (PARTITION BY title, source ORDER BY article_id DESC) AS rn
  FROM docs WHERE publishedAt < TIMESTAMP '{CUT_DOCS}') WHERE rn = 1)
RESULT SELECT d.article_id, c.summary, c.summary IS NULL OR c.summary = '' AS needs_work
FROM docs d LEFT JOIN cache c ON d.title = c.title AND d.source = c.source""")
def ing10(spark, sf):
    full = articles_from_documents(spark, sf)
    cache = full.where(F.col("publishedAt") < F.lit(CUT_DOCS).cast("timestamp_ntz"))
    return ingest.reuse_cached(full, cache, "summary", ("title", "source"))


query("ing11_rejection_report", "reason:s n:i", f"""
WITH {CLEAN_SQL}, rj AS (SELECT *, CASE WHEN (title, publishedAt, source) IN {_SEEN} THEN 'existing'
   WHEN contains(text, '{tx.PAYWALL_MARKER}') THEN 'paid' WHEN words < 100 THEN 'short' END AS reason FROM cw),
nd AS (SELECT title, publishedAt, source, count(*) AS c FROM rj WHERE reason IS NULL GROUP BY ALL)
RESULT SELECT reason, count(*) AS n FROM rj WHERE reason IS NOT NULL GROUP BY reason
UNION ALL SELECT * FROM (SELECT 'exact_duplicate' AS reason, coalesce(sum(c - 1), 0) AS n FROM nd) WHERE n > 0
UNION ALL SELECT * FROM (SELECT 'new' AS reason, count(*) AS n FROM nd) WHERE n > 0""")(
    lambda spark, sf: cleaning.rejection_report(docs(spark, sf), stored_docs(spark, sf)))

# --- cleaning ---------------------------------------------------------------------------------

query("cln1_choose_text", "pos:i chosen:s", """
SELECT pos, CASE WHEN title IS NULL OR title = '' THEN coalesce(title, '') || ' ' || coalesce(description, '') || ' ' || coalesce(content, '') ELSE title END AS chosen FROM feed""")(
    lambda spark, sf: feed(spark, sf).select("pos", tx.choose_text(F.col("title"), F.col("title"), F.col("description"), F.col("content")).alias("chosen")))
query("cln2_drop_paywalled", "article_id:i title:s", f"SELECT article_id, title FROM docs WHERE NOT contains(text, '{tx.PAYWALL_MARKER}')")(
    lambda spark, sf: docs(spark, sf).where(~tx.is_paywalled(F.col("text"))).select("article_id", "title"))
query("cln3_strip_html", "page_id:i stripped:s", f"SELECT page_id, regexp_replace(html, '{tx.HTML_TAG}', '', 'g') AS stripped FROM pages")(
    lambda spark, sf: table(spark, sf, "pages").select("page_id", tx.strip_html(F.col("html")).alias("stripped")))
query("cln4_strip_urls", "article_id:i stripped:s", f"SELECT article_id, regexp_replace(text, '{tx.URL}', '', 'g') AS stripped FROM docs")(
    lambda spark, sf: docs(spark, sf).select("article_id", tx.strip_urls(F.col("text")).alias("stripped")))
query("cln5_collapse_ws", "article_id:i flat:s", f"SELECT article_id, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS flat FROM docs")(
    lambda spark, sf: docs(spark, sf).select("article_id", tx.collapse_ws(F.col("text")).alias("flat")))
query("cln6_word_count", "article_id:i words:i", f"WITH {CLEAN_SQL}\nRESULT SELECT article_id, words FROM cw WHERE words >= 100")(
    lambda spark, sf: cleaning.with_clean_text(docs(spark, sf)).where("words >= 100").select("article_id", "words"))
query("cln7_clean_articles", "article_id:i title:s text:s source:s publishedAt:s", f"""
WITH {CLEAN_SQL}, kp AS (SELECT *, row_number() OVER (PARTITION BY title, publishedAt, source ORDER BY article_id DESC) AS rn
  FROM cw WHERE NOT contains(text, '{tx.PAYWALL_MARKER}') AND words >= 100)
RESULT SELECT article_id, title, clean_text AS text, source, publishedAt FROM kp WHERE rn = 1""")(
    lambda spark, sf: cleaning.clean_articles(docs(spark, sf), detect_spread=False))
_MARKED = "article_id:i title:s source:s is_original:b duplicate_of:d similarity_score:d original_source:s similarity_category:s spread_count:i"
query("cln7_clean_articles_marked", _MARKED, f"""
WITH {CLEAN_SQL}, cdocs AS MATERIALIZED (SELECT article_id, title, text, source, publishedAt FROM (
  SELECT *, row_number() OVER (PARTITION BY title, publishedAt, source ORDER BY b DESC, article_id DESC) AS rn FROM (
    SELECT article_id, title, text, source, publishedAt, 0 AS b FROM docs WHERE publishedAt < TIMESTAMP '{CUT_DOCS}'
    UNION ALL SELECT article_id, title, clean_text, source, publishedAt, 1 FROM cw
      WHERE NOT contains(text, '{tx.PAYWALL_MARKER}') AND words >= 100 AND (title, publishedAt, source) NOT IN {_SEEN})) WHERE rn = 1),
{re.sub(r"\bdocs\b", "cdocs", SPREAD_SQL)}
RESULT SELECT * FROM spr""")(lambda spark, sf: cleaning.clean_articles(docs(spark, sf), stored_docs(spark, sf)))
query("cln8_build_topic_doc", "article_id:i doc:s", f"""
WITH t AS (SELECT article_id, trim(regexp_replace(title, '{_WS}', ' ', 'g')) AS title, trim(regexp_replace(text, '{_WS}', ' ', 'g')) AS text FROM docs),
u AS (SELECT article_id, trim(regexp_replace(title || chr(10) || chr(10) || text, '{_WS}', ' ', 'g')) AS doc FROM t WHERE length(text) > 0)
RESULT SELECT * FROM u WHERE length(doc) > 0""")(lambda spark, sf: cleaning.build_topic_doc(docs(spark, sf)))
query("cln9_lead", "article_id:i lead512:s lead2000:s", "SELECT article_id, substring(text, 1, 512) AS lead512, substring(text, 1, 2000) AS lead2000 FROM docs")(
    lambda spark, sf: docs(spark, sf).select("article_id", tx.lead(F.col("text"), 512).alias("lead512"), tx.lead(F.col("text"), 2000).alias("lead2000")))
query("cln10_parse_ts", "pos:i parsed:s from_title:s", 'SELECT pos, TRY_CAST("publishedAt" AS TIMESTAMP) AS parsed, TRY_CAST(title AS TIMESTAMP) AS from_title FROM feed')(
    lambda spark, sf: feed(spark, sf).select("pos", tx.parse_ts(F.col("publishedAt")).alias("parsed"), tx.parse_ts(F.col("title")).alias("from_title")))
query("cln11_clean_title", "article_id:i clean:s", "SELECT article_id, trim(replace(title || ' - N/A', ' - N/A', '')) AS clean FROM docs")(
    lambda spark, sf: docs(spark, sf).select("article_id", tx.clean_title(F.concat("title", F.lit(" - N/A"))).alias("clean")))

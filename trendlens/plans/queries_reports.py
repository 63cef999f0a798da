"""Queries over sentiment, topics, summaries, metrics, the scorecard and the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.functions import labels
from trendlens.functions.text import WHITESPACE
from trendlens.operators import dashboard, density, metrics, neighbours, scorecard, sentiment, summary, topics, windows
from trendlens.plans.queries_copies import SPREAD_SQL, spread_table
from trendlens.plans.queries_series import orders_daily
from trendlens.plans.registry import query, stage
from trendlens.session import scratch_path
from trendlens.sources.adapters import articles_from_documents, articles_from_events, table

ID = "article_id"


def docs(spark, sf):
    return articles_from_documents(spark, sf)


def words_sql(col):
    flat = f"trim(regexp_replace(coalesce({col}, ''), '{WHITESPACE}', ' ', 'g'))"
    return f"CASE WHEN {flat} = '' THEN 0 ELSE len(string_split({flat}, ' ')) END"


def blank_sql(col):
    return f"({col} IS NULL OR trim(regexp_replace({col}, '{WHITESPACE}', ' ', 'g')) = '')"


# --- sentiment --------------------------------------------------------------------------------

_POS = ", ".join(f"'{w}'" for w in sentiment.POSITIVE)
_NEG = ", ".join(f"'{w}'" for w in sentiment.NEGATIVE)


def lexicon_sql(source: str, text: str) -> str:
    return f"""
hit AS (SELECT article_id, sum(CASE WHEN term IN ({_POS}) THEN 1.0 ELSE 0.0 END)::DOUBLE AS pos, sum(CASE WHEN term IN ({_NEG}) THEN 1.0 ELSE 0.0 END)::DOUBLE AS neg
   FROM (SELECT article_id, unnest(regexp_split_to_array(lower({text}), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM {source}) GROUP BY article_id),
lgt AS (SELECT s.*, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg, 0.5::DOUBLE AS neu FROM {source} s LEFT JOIN hit USING (article_id)),
scd AS (SELECT * EXCLUDE (pos, neg, neu), pos, neg, neu,
   CASE WHEN neg = greatest(neg, neu, pos) THEN 'negative' WHEN neu = greatest(neg, neu, pos) THEN 'neutral' ELSE 'positive' END AS predicted,
   round(exp(greatest(neg, neu, pos)) / (exp(neg) + exp(neu) + exp(pos)), 4) AS confidence FROM lgt)"""


EV_SCORED = f"WITH {lexicon_sql('ev', 'text')}"


def scored_events(spark, sf):
    return sentiment.score_with_lexicon(articles_from_events(spark, sf).drop("sentiment"))


query("sen1_score_lexicon", "article_id:i sentiment:s sentiment_confidence:d",
      f"{EV_SCORED}\nRESULT SELECT article_id, predicted AS sentiment, confidence AS sentiment_confidence FROM scd")(scored_events)
query("sen1_score_lexicon_documents", "article_id:i sentiment:s sentiment_confidence:d", f"""
WITH {lexicon_sql('docs', 'text')}
RESULT SELECT article_id, predicted AS sentiment, confidence AS sentiment_confidence FROM scd""")(
    lambda spark, sf: sentiment.score_with_lexicon(docs(spark, sf).drop("sentiment")))


@query("sen1_score_model", "article_id:i sentiment:s sentiment_confidence:d")
def sen1_model(spark, sf):
    arts = docs(spark, sf)
    model = sentiment.train_text_model(arts.where("topic <> -1").select("text", "sentiment"))
    return sentiment.score_with_model(arts, model)


@query("sen1_model_checks", "article_id:i known_class:b confident:b", "SELECT article_id, true AS known_class, true AS confident FROM docs")
def sen1_model_checks(spark, sf):
    """The model form gives every article one of the classes and the largest of three probabilities."""
    out = sen1_model(spark, sf)
    return out.select("article_id", F.col("sentiment").isin("negative", "neutral", "positive").alias("known_class"), F.col("sentiment_confidence").between(0.333, 1.0).alias("confident"))


@query("sen1_score_callable", "article_id:i sentiment:s sentiment_confidence:d", """
SELECT article_id, CASE WHEN length(coalesce(text, '')) > 600 THEN 'positive' ELSE 'neutral' END AS sentiment,
  round(1 - 1 / (1 + length(coalesce(text, '')))::DOUBLE, 4) AS sentiment_confidence FROM docs""")
def sen1_callable(spark, sf):
    def by_length(texts):
        import pandas as pd
        n = texts.str.len()
        return pd.DataFrame({"label": n.gt(600).map({True: "LABEL_POS", False: "neutral"}), "score": 1 - 1 / (1 + n)})

    return sentiment.score_with_callable(docs(spark, sf).drop("sentiment").select(ID, "text"), by_length)


query("sen2_normalise_label", "raw:s sentiment:s n:i", """
SELECT event_type AS raw, CASE WHEN contains(lower(event_type), 'pos') THEN 'positive' WHEN contains(lower(event_type), 'neg') THEN 'negative' ELSE 'neutral' END AS sentiment,
  count(*) AS n FROM (SELECT CASE event_type WHEN 'purchase' THEN 'POSITIVE' WHEN 'error' THEN 'LABEL_neg' ELSE event_type END AS event_type FROM events) GROUP BY 1""")(
    lambda spark, sf: table(spark, sf, "events").select(
        F.when(F.col("event_type") == "purchase", "POSITIVE").when(F.col("event_type") == "error", "LABEL_neg").otherwise(F.col("event_type")).alias("raw"))
    .groupBy("raw").agg(F.count(F.lit(1)).alias("n")).withColumn("sentiment", labels.normalise_label(F.col("raw"))))


@query("sen3_softmax_confidence", "event_id:i label:s confidence:d", """
WITH l AS (SELECT event_id, value / 50 AS a, (event_id % 7) * 0.25::DOUBLE AS b, (user_id % 5) * 0.3::DOUBLE AS c FROM events)
RESULT SELECT event_id, CASE WHEN a = greatest(a, b, c) THEN 'negative' WHEN b = greatest(a, b, c) THEN 'neutral' ELSE 'positive' END AS label,
  round(exp(greatest(a, b, c)) / (exp(a) + exp(b) + exp(c)), 4) AS confidence FROM l""")
def sen3(spark, sf):
    logits = [F.col("value") / 50, (F.col("event_id") % 7) * 0.25, (F.col("user_id") % 5) * 0.3]
    label, conf = labels.softmax_pick(logits)
    return table(spark, sf, "events").select("event_id", label.alias("label"), conf.alias("confidence"))


query("sen4_confidence_report", "mean_confidence:d low_confidence:i",
      f"{EV_SCORED}\nRESULT SELECT coalesce(avg(confidence), 0) AS mean_confidence, count(*) FILTER (WHERE confidence < 0.7) AS low_confidence FROM scd")(
    lambda spark, sf: sentiment.confidence_report(scored_events(spark, sf)))
query("sen5_sentiment_distribution", "sentiment:s count:i", "SELECT sentiment, count(*) AS count FROM docs GROUP BY 1")(
    lambda spark, sf: sentiment.sentiment_distribution(docs(spark, sf)))
query("sen6_sentiment_numeric", "article_id:i known:d strict:d", """
SELECT article_id, CASE sentiment WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 ELSE 0 END AS known,
  CASE sentiment WHEN 'negative' THEN -1 WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 END AS strict FROM docs""")(
    lambda spark, sf: docs(spark, sf).select(ID, labels.sentiment_numeric(F.col("sentiment")).alias("known"),
                                             labels.sentiment_numeric(F.col("sentiment"), None).alias("strict")))
query("sen7_numeric_to_class", "date:s avg_sentiment:d class:s", """
SELECT date, avg_sentiment, CASE WHEN avg_sentiment > 0.1 THEN 'positive' WHEN avg_sentiment < -0.1 THEN 'negative' ELSE 'neutral' END AS class FROM dailyo""")(
    lambda spark, sf: orders_daily(spark, sf).select("date", "avg_sentiment", labels.numeric_to_class(F.col("avg_sentiment")).alias("class")))
_CMP = f"{EV_SCORED}, cmp AS (SELECT article_id, sentiment AS base, 0.8::DOUBLE AS base_confidence, predicted AS other, confidence AS other_confidence FROM scd)"


def compared(spark, sf):
    base = articles_from_events(spark, sf).withColumn("sentiment_confidence", F.lit(0.8))
    return sentiment.compare_scorers(base, scored_events(spark, sf))


query("sen8_compare_scorers", "article_id:i base:s other:s agree:b confidence_change:d",
      f"{_CMP}\nRESULT SELECT article_id, base, other, base = other AS agree, other_confidence - base_confidence AS confidence_change FROM cmp")(compared)
query("sen8_comparison_report", "total:i agreements:i mean_change:d agreement_rate:d verdict:s", f"""
{_CMP}, r AS (SELECT count(*) AS total, count(*) FILTER (WHERE base = other) AS agreements, avg(other_confidence - base_confidence) AS mean_change FROM cmp)
RESULT SELECT *, agreements::DOUBLE / total AS agreement_rate,
  CASE WHEN mean_change > 0.05 THEN 'more confident' WHEN mean_change < -0.05 THEN 'less confident' ELSE 'similar' END AS verdict FROM r""")(
    lambda spark, sf: sentiment.comparison_report(compared(spark, sf)))
query("sen9_confidence_band", "article_id:i band:s",
      f"{EV_SCORED}\nRESULT SELECT article_id, CASE WHEN confidence >= 0.8 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS band FROM scd")(
    lambda spark, sf: scored_events(spark, sf).select(ID, labels.confidence_band(F.col("sentiment_confidence")).alias("band")))

# --- topics -----------------------------------------------------------------------------------

STOP = (*topics.NEWS_WORDS, "the", "and", "of", "to", "in", "is", "for", "on", "that", "with")
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)


@query("top1_stopwords", "lang:s tokens:i stop_tokens:i", f"""
SELECT lang, count(*) AS tokens, count(*) FILTER (WHERE w IN ({_STOP_SQL})) AS stop_tokens
FROM (SELECT lang, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+')) AS w FROM documents) WHERE w <> '' GROUP BY lang""")
def top1(spark, sf):
    """How much of each language's text is made of stop words."""
    from trendlens.functions.text import words
    tokens = table(spark, sf, "documents").select("lang", F.explode(words(F.col("text"))).alias("w"))
    return tokens.groupBy("lang").agg(F.count(F.lit(1)).alias("tokens"), F.count_if(F.col("w").isin(*STOP)).alias("stop_tokens"))


def terms_sql(unit: str, min_df: int = 3, max_df: float = 0.75) -> str:
    """Term counts over whole documents: unigrams and bigrams after stop words are gone."""
    return f"""
wl AS (SELECT article_id, topic, list_filter(list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}_]+'),
        lambda w: regexp_full_match(w, '[a-z][a-z]+')), lambda w: w NOT IN ({_STOP_SQL})) AS ws FROM docs),
tk AS (SELECT {unit}, unnest(ws) AS term FROM wl UNION ALL
       SELECT {unit}, unnest(list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1])) AS term FROM wl WHERE len(ws) > 1),
tc AS (SELECT {unit}, term, count(*) AS n FROM tk GROUP BY ALL),
vc AS (SELECT term FROM tc GROUP BY term HAVING count(*) >= {min_df} AND count(*) <= {max_df} * (SELECT count(DISTINCT {unit}) FROM docs)),
cnt AS MATERIALIZED (SELECT tc.* FROM tc JOIN vc USING (term))"""


def doc_counts(spark, sf):
    return topics.vectorise_terms(docs(spark, sf), "text", ID, STOP, single=True)


def topic_counts(spark, sf):
    return topics.vectorise_terms(docs(spark, sf), "text", "topic", STOP, min_df=1, max_df=0.75)


CTF_SQL = f"""{terms_sql('topic', 1)},
ctf AS MATERIALIZED (SELECT c.topic, c.term, round(sqrt(c.n / p.words::DOUBLE) * ln(1 + a / f::DOUBLE), 9) AS weight FROM cnt c
   JOIN (SELECT topic, sum(n) AS words FROM cnt GROUP BY topic) p USING (topic) JOIN (SELECT term, sum(n) AS f FROM cnt GROUP BY term) t USING (term),
   (SELECT floor(avg(w)) AS a FROM (SELECT sum(n) AS w FROM cnt GROUP BY topic))),
tt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY weight DESC, term) AS rank FROM ctf) WHERE rank <= 10),
lb AS (SELECT t.topic, CASE WHEN t.topic = -1 THEN 'Outlier' ELSE coalesce(lab, 'Topic ' || t.topic) END AS topic_label FROM (SELECT DISTINCT topic FROM tt) t
   LEFT JOIN (SELECT topic, string_agg(term, ' / ' ORDER BY rank) AS lab FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY rank) AS k FROM tt
     WHERE term NOT IN ({_STOP_SQL}, {', '.join(f"'{w}'" for w in topics.LABEL_WORDS)})) WHERE k <= 3 GROUP BY topic) USING (topic))"""


def weights(spark, sf):
    return topics.class_tfidf(topic_counts(spark, sf)).withColumn("weight", F.round("weight", 9))


def best_terms(spark, sf):
    return stage("terms", spark, sf, lambda s, f: topics.top_terms(weights(s, f)))


def label_table(spark, sf):
    return topics.topic_labels(best_terms(spark, sf), STOP)


query("top2_vectorise_terms", "article_id:i term:s n:i", f"WITH {terms_sql('article_id')}\nRESULT SELECT article_id, term, n FROM cnt")(doc_counts)
query("top3_class_tfidf", "topic:i term:s weight:d", f"WITH {CTF_SQL}\nRESULT SELECT * FROM ctf")(weights)
query("top8_top_terms", "topic:i term:s weight:d rank:i", f"WITH {CTF_SQL}\nRESULT SELECT * FROM tt")(
    lambda spark, sf: topics.top_terms(weights(spark, sf)))
query("top9_topic_labels", "article_id:i topic:i topic_label:s", f"WITH {CTF_SQL}\nRESULT SELECT article_id, topic, topic_label FROM docs LEFT JOIN lb USING (topic)")(
    lambda spark, sf: topics.label_articles(docs(spark, sf), label_table(spark, sf)))
query("top10_topic_stats", "num_topics:i num_outliers:i outlier_ratio:d largest:i smallest:i mean_size:d", """
WITH sz AS (SELECT topic, count(*) AS n FROM docs GROUP BY topic)
RESULT SELECT count(*) FILTER (WHERE topic <> -1) AS num_topics, coalesce(sum(n) FILTER (WHERE topic = -1), 0) AS num_outliers,
  coalesce(sum(n) FILTER (WHERE topic = -1), 0)::DOUBLE / sum(n) AS outlier_ratio, max(n) AS largest, min(n) AS smallest, avg(n) AS mean_size FROM sz""")(
    lambda spark, sf: topics.topic_stats(docs(spark, sf)))
query("top11_top_topics", "topic:i size:i topic_label:s", f"""
WITH {CTF_SQL}, sz AS (SELECT topic, count(*) AS size FROM docs GROUP BY topic ORDER BY size DESC, topic LIMIT 20)
RESULT SELECT topic, size, topic_label FROM sz LEFT JOIN lb USING (topic)""")(
    lambda spark, sf: topics.top_topics(docs(spark, sf), label_table(spark, sf)))
_NAMES = " ".join(f"WHEN {k} THEN '{v}'" for k, v in topics.TOPIC_NAMES.items())
query("top12_topic_name", "article_id:i topic_name:s", f"SELECT article_id, CASE topic {_NAMES} ELSE 'Topic ' || topic END AS topic_name FROM ev")(
    lambda spark, sf: topics.topic_name(articles_from_events(spark, sf)))


@query("top4_cluster_docs", "topic:i size:i")
def top4(spark, sf):
    clustered, _ = topics.cluster_docs(table(spark, sf, "embeddings"), 8)
    return topics.topic_sizes(clustered)


# Density clusters by brute force: all distances, a tree grown point by point, and its edges joined in order. State is in lists,
# one entry a point: its lightest edge to the tree, then its component's label and, by label, size, sum of the inverse weights
# at which points leave, and the best total of the clusters below.
DENSITY_SQL = """
p AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS i, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
d AS MATERIALIZED (SELECT a.i AS a, b.i AS b, round(list_distance(a.v, b.v), 9) AS d FROM p a, p b WHERE a.i <> b.i),
ne AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rank FROM d),
co AS (SELECT a AS i, d AS core FROM ne WHERE rank = 2),
wl AS MATERIALIZED (SELECT a, list(w ORDER BY b) AS ws FROM (
  SELECT a, b, greatest(d, x.core, y.core) AS w FROM d JOIN co x ON x.i = a JOIN co y ON y.i = b UNION ALL SELECT i, i, 'infinity'::DOUBLE FROM p) GROUP BY a),
us AS (SELECT list(i ORDER BY i) AS u FROM p),
pr AS (
  SELECT 1 AS step, NULL::STRUCT(w DOUBLE, lo BIGINT, hi BIGINT, u BIGINT) AS e, list_transform(u, lambda x: x = 1) AS done,
    list_transform(u, lambda x: {'w': ws[x], 'lo': 1::BIGINT, 'hi': x}) AS best FROM us, wl WHERE a = 1
  UNION ALL
  SELECT step + 1, n.e, list_transform(u, lambda x: done[x] OR x = n.e.u),
    list_transform(u, lambda x: least(best[x], {'w': ws[x], 'lo': least(x, n.e.u), 'hi': greatest(x, n.e.u)}))
  FROM (SELECT step, done, best, list_min(list_transform(list_filter(u, lambda x: NOT done[x]), lambda x: {'w': best[x].w, 'lo': best[x].lo, 'hi': best[x].hi, 'u': x})) AS e FROM pr, us WHERE step < len(u)) n
  JOIN wl ON wl.a = n.e.u, us),
te AS MATERIALIZED (SELECT row_number() OVER (ORDER BY e.w, e.lo, e.hi) AS t, e.lo AS lo, e.hi AS hi, e.w AS w FROM pr WHERE e IS NOT NULL),
ag AS (
  SELECT 0::BIGINT AS t, u AS comp, list_transform(u, lambda x: 1::BIGINT) AS size, list_transform(u, lambda x: 0.0::DOUBLE) AS mass, list_transform(u, lambda x: 0.0::DOUBLE) AS below,
    list_transform(u, lambda x: NULL::BIGINT) AS pick FROM us
  UNION ALL
  SELECT s.t, list_transform(comp, lambda c: CASE WHEN c = b THEN a ELSE c END), list_transform(u, lambda x: CASE WHEN x = a THEN size[a] + size[b] ELSE size[x] END),
    list_transform(u, lambda x: CASE WHEN x <> a THEN mass[x] WHEN ba = bb THEN CASE WHEN size[a] + size[b] >= 8 THEN (size[a] + size[b]) * lam ELSE 0.0 END
                                     WHEN ba THEN mass[a] + size[b] * lam ELSE mass[b] + size[a] * lam END),
    list_transform(u, lambda x: CASE WHEN x <> a THEN below[x] WHEN ba AND bb THEN greatest(mass[a] - size[a] * lam, below[a]) + greatest(mass[b] - size[b] * lam, below[b])
                                     WHEN ba THEN below[a] WHEN bb THEN below[b] ELSE 0.0 END),
    list_transform(u, lambda x: CASE WHEN ba AND bb AND comp[x] = a AND round(mass[a] - size[a] * lam - below[a], 9) >= 0 THEN 2 * s.t
                                     WHEN ba AND bb AND comp[x] = b AND round(mass[b] - size[b] * lam - below[b], 9) >= 0 THEN 2 * s.t + 1 ELSE pick[x] END)
  FROM (SELECT te.t, comp, size, mass, below, pick, comp[lo] AS a, comp[hi] AS b, size[comp[lo]] >= 8 AS ba, size[comp[hi]] >= 8 AS bb, 1.0 / greatest(w, 1e-9) AS lam
        FROM ag JOIN te ON te.t = ag.t + 1) s, us),
ch AS MATERIALIZED (SELECT unnest(u) AS i, unnest(pick) AS c FROM (SELECT pick FROM ag ORDER BY t DESC LIMIT 1), us),
tp AS (SELECT c, row_number() OVER (ORDER BY count(*) DESC, min(i)) - 1 AS topic FROM ch WHERE c IS NOT NULL GROUP BY c)"""

query("top4_nearest_neighbours", "id:i other:i distance:d rank:i", f"""
WITH {DENSITY_SQL}
RESULT SELECT x.vec_id AS id, y.vec_id AS other, d AS distance, rank FROM ne JOIN p x ON x.i = a JOIN p y ON y.i = b WHERE rank <= 5""")(
    lambda spark, sf: neighbours.nearest_neighbours(table(spark, sf, "embeddings"), 5))
query("top4_density_spanning_tree", "lo:i hi:i weight:d", f"""
WITH {DENSITY_SQL}
RESULT SELECT x.vec_id AS lo, y.vec_id AS hi, w AS weight FROM te JOIN p x ON x.i = lo JOIN p y ON y.i = hi""")(
    lambda spark, sf: density.tree_edges(table(spark, sf, "embeddings")))
query("top4_density_topics", "vec_id:i topic:i", f"""
WITH {DENSITY_SQL}
RESULT SELECT vec_id, coalesce(topic, -1) AS topic FROM ch JOIN p USING (i) LEFT JOIN tp USING (c)""")(
    lambda spark, sf: density.density_clusters(table(spark, sf, "embeddings")))


def labelled_vectors(spark, sf):
    return table(spark, sf, "embeddings").withColumnRenamed("label", "topic")


CENT_SQL = """
xs AS (SELECT vec_id, label AS topic, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
ce AS (SELECT topic, i, avg(x) AS c FROM xs GROUP BY ALL),
ds AS (SELECT vec_id, xs.topic AS home, ce.topic AS topic, round(sqrt(sum((x - c) * (x - c))), 6) AS distance, sqrt(sum((x - c) * (x - c))) AS raw
       FROM xs JOIN ce USING (i) GROUP BY ALL)"""
query("top5_mark_outliers", "vec_id:i topic:i distance:d", f"""
WITH {CENT_SQL}, h AS (SELECT * FROM ds WHERE home = topic),
b AS (SELECT topic, quantile_cont(distance, 0.95) AS bound, count(*) AS size FROM h GROUP BY topic)
RESULT SELECT vec_id, CASE WHEN distance > bound OR size < 8 THEN -1 ELSE topic END AS topic, distance FROM h JOIN b USING (topic)""")(
    lambda spark, sf: topics.mark_outliers(labelled_vectors(spark, sf)))
query("top6_merge_topics", "topic:i merged:i", """
WITH xs AS (SELECT label AS topic, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings),
ce AS (SELECT topic, i, avg(x) AS c FROM xs GROUP BY ALL), cv AS (SELECT topic, list(c ORDER BY i) AS v FROM ce GROUP BY topic),
ed AS (SELECT a.topic AS a, b.topic AS b FROM cv a JOIN cv b ON round(list_cosine_similarity(a.v, b.v), 6) >= 0.05),
rc AS (SELECT a, b FROM ed UNION SELECT rc.a, ed.b FROM rc JOIN ed ON rc.b = ed.a)
RESULT SELECT a AS topic, min(b) AS merged FROM rc GROUP BY a""")(
    lambda spark, sf: topics.merge_topics(labelled_vectors(spark, sf), 0.05))
query("top7_topic_probabilities", "vec_id:i topic:i probability:d", f"""
WITH {CENT_SQL}, tot AS (SELECT vec_id, sum(exp(-raw)) AS z FROM ds GROUP BY vec_id)
RESULT SELECT vec_id, topic, exp(-raw) / z AS probability FROM ds JOIN tot USING (vec_id)""")(
    lambda spark, sf: topics.topic_probabilities(labelled_vectors(spark, sf)))

# --- summaries --------------------------------------------------------------------------------

query("sum1_summary_input", "article_id:i summary_input:s",
      f"SELECT article_id, CASE WHEN {words_sql('text')} >= 30 THEN text ELSE '' END AS summary_input FROM docs")(
    lambda spark, sf: summary.summary_input(docs(spark, sf)))

SUM_SQL = f"""
inp AS (SELECT article_id AS id, trim(regexp_replace(text, '{WHITESPACE}', ' ', 'g')) AS t FROM docs WHERE {words_sql('text')} >= 30),
se0 AS (SELECT id, unnest(x) AS raw, generate_subscripts(x, 1) AS pos FROM (SELECT id, regexp_extract_all(t, '{summary.SENTENCE}') AS x FROM inp)),
se AS MATERIALIZED (SELECT id, pos, trim(raw) AS sentence FROM se0 WHERE trim(raw) <> ''),
st AS (SELECT id, pos, term, count(*) AS k FROM (SELECT id, pos, unnest(regexp_split_to_array(lower(sentence), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM se) WHERE term <> '' GROUP BY ALL),
sf AS (SELECT term, count(DISTINCT id) AS df FROM st GROUP BY term),
sw AS (SELECT st.*, sum(k) OVER (PARTITION BY id, term) AS tf FROM st),
sg AS (SELECT id, pos, round(sum(k * tf * (ln(((SELECT count(DISTINCT id) FROM se) + 1)::DOUBLE / (df + 1)::DOUBLE) + 1.0::DOUBLE)) / sum(k), 9) AS score FROM sw JOIN sf USING (term) GROUP BY ALL),
sr AS (SELECT se.id, se.pos, sentence, sum({words_sql('sentence')}) OVER w AS used, row_number() OVER w AS rank FROM se LEFT JOIN sg ON se.id = sg.id AND se.pos = sg.pos
       WINDOW w AS (PARTITION BY se.id ORDER BY coalesce(score, 0) DESC, se.pos ROWS UNBOUNDED PRECEDING)),
sm AS (SELECT id, string_agg(sentence, ' ' ORDER BY pos) AS made FROM sr WHERE used <= 130 OR rank = 1 GROUP BY id),
summed AS MATERIALIZED (SELECT d.* EXCLUDE (summary), coalesce(made, '') AS summary FROM docs d LEFT JOIN sm ON sm.id = d.article_id)"""


def summed(spark, sf):
    return stage("summaries", spark, sf, lambda s, f: summary.summarise(docs(s, f)))


query("sum2_summarise", "article_id:i summary:s", f"WITH {SUM_SQL}\nRESULT SELECT article_id, summary FROM summed")(
    lambda spark, sf: summary.summarise(docs(spark, sf)))


@query("sum2_summarise_callable", "article_id:i summary:s", f"""
SELECT article_id, CASE WHEN {words_sql('text')} >= 30 THEN array_to_string(string_split(text, '. ')[1:2], '. ') ELSE '' END AS summary FROM docs""")
def sum2_callable(spark, sf):
    def first_sentences(texts):
        return [". ".join(t.split(". ")[:2]) for t in texts]

    return summary.summarise_with(docs(spark, sf).select(ID, "text"), first_sentences)


query("sum3_summary_quality", "articles:i summaries:i coverage_pct:d mean_words:d min_words:i max_words:i", f"""
WITH {SUM_SQL}, q AS (SELECT {blank_sql('summary')} AS b, {words_sql('summary')} AS w FROM summed)
RESULT SELECT count(*) AS articles, count(*) FILTER (WHERE NOT b) AS summaries, count(*) FILTER (WHERE NOT b) * 100.0 / count(*) AS coverage_pct,
  avg(w) FILTER (WHERE NOT b) AS mean_words, min(w) FILTER (WHERE NOT b) AS min_words, max(w) FILTER (WHERE NOT b) AS max_words FROM q""")(
    lambda spark, sf: summary.summary_quality(summed(spark, sf)))

# --- metrics ----------------------------------------------------------------------------------

NAIVE_SQL = """nv AS (SELECT * FROM (SELECT source, date, avg_sentiment AS y, lag(avg_sentiment, 7) OVER (PARTITION BY source ORDER BY date) AS prediction,
   total_articles AS v, lag(total_articles, 7) OVER (PARTITION BY source ORDER BY date) AS vp FROM dailyos) WHERE prediction IS NOT NULL)"""


def naive(spark, sf):
    w = windows.series_window(["source"])
    return orders_daily(spark, sf, ["source"]).select(
        "source", "date", F.col("avg_sentiment").alias("y"), F.lag("avg_sentiment", 7).over(w).alias("prediction"),
        F.col("total_articles").alias("v"), F.lag("total_articles", 7).over(w).alias("vp")).where(F.col("prediction").isNotNull())


query("met1_mae_rmse", "source:s mae:d rmse:d", f"""
WITH {NAIVE_SQL}
RESULT SELECT source, round(avg(abs(v - vp)), 4) AS mae, round(sqrt(avg((v - vp) * (v - vp))), 4) AS rmse FROM nv GROUP BY source""")(
    lambda spark, sf: metrics.regression_metrics(naive(spark, sf), "v", "vp", ["source"]))
query("met2_mape", "source:s mape:d", f"""
WITH {NAIVE_SQL}
RESULT SELECT source, round(avg(CASE WHEN y <> 0 THEN abs((y - prediction) / y) END) * 100, 2) AS mape FROM nv GROUP BY source""")(
    lambda spark, sf: metrics.mape(naive(spark, sf), by=["source"]))

@query("met8_metric_history", "model:s mae:d rmse:d", f"""
WITH {NAIVE_SQL}, m AS (SELECT round(avg(abs(v - vp)), 4) AS mae, round(sqrt(avg((v - vp) * (v - vp))), 4) AS rmse FROM nv)
RESULT SELECT 'volume' AS model, * FROM m UNION ALL SELECT 'volume', * FROM m UNION ALL SELECT 'again', * FROM m""")
def met8(spark, sf):
    path = scratch_path(spark, "metric-history")
    for name in ("volume", "volume", "again"):
        metrics.append_history(metrics.regression_metrics(naive(spark, sf), "v", "vp"), path, name)
    return spark.read.parquet(path)


QUAL_SQL = """ql AS (SELECT d.doc_id, l.quality AS y, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS prediction, round(n_chars / (n_chars + 1000.0::DOUBLE), 3) AS score
   FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""


def quality(spark, sf):
    return table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        "doc_id", F.col("quality").alias("y"), (F.col("n_chars") > 1000).cast("int").alias("prediction"),
        F.round(F.col("n_chars") / (F.col("n_chars") + 1000.0), 3).alias("score"))


query("met3_precision_recall_f1", "tp:i fp:i fn:i tn:i precision:d recall:d f1:d", f"""
WITH {QUAL_SQL}, c AS (SELECT count(*) FILTER (WHERE y = 1 AND prediction = 1) AS tp, count(*) FILTER (WHERE y = 0 AND prediction = 1) AS fp,
  count(*) FILTER (WHERE y = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE y = 0 AND prediction = 0) AS tn FROM ql),
p AS (SELECT *, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS precision, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS recall FROM c)
RESULT SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM p""")(
    lambda spark, sf: metrics.binary_metrics(quality(spark, sf)))
query("met4_roc_auc", "roc_auc:d", f"""
WITH {QUAL_SQL}, r AS (SELECT y, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0::DOUBLE AS rk FROM ql)
RESULT SELECT (sum(rk) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2.0::DOUBLE)
   / nullif(count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0), 0) AS roc_auc FROM r""")(
    lambda spark, sf: metrics.roc_auc(quality(spark, sf)))
query("met5_confusion_matrix", "actual:i predicted:i count:i", f"WITH {QUAL_SQL}\nRESULT SELECT y AS actual, prediction AS predicted, count(*) AS count FROM ql GROUP BY ALL")(
    lambda spark, sf: metrics.confusion_matrix(quality(spark, sf)))
CLASS_PRED_SQL = f"""{EV_SCORED}, pr AS (SELECT d.sentiment AS y, CASE WHEN d.title LIKE '%1%' THEN 'neutral' ELSE d.predicted END AS prediction FROM scd d)"""


def class_predictions(spark, sf):
    actual = articles_from_events(spark, sf).select(ID, F.col("sentiment").alias("y"))
    said = scored_events(spark, sf).select(ID, F.when(F.col("title").contains("1"), "neutral").otherwise(F.col("sentiment")).alias("prediction"))
    return actual.join(said, ID)


REPORT_SQL = f"""{CLASS_PRED_SQL}, cs AS (SELECT DISTINCT y AS class FROM pr UNION SELECT DISTINCT prediction FROM pr),
pc AS (SELECT class, (SELECT count(*) FROM pr WHERE y = class AND prediction = class)::DOUBLE AS tp, (SELECT count(*) FROM pr WHERE prediction = class) AS named,
  (SELECT count(*) FROM pr WHERE y = class) AS support FROM cs),
pp AS (SELECT class, coalesce(tp / nullif(named, 0), 0) AS precision, coalesce(tp / nullif(support, 0), 0) AS recall, support FROM pc),
pf AS (SELECT class, precision, recall, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1, support FROM pp),
rep AS (SELECT * FROM pf UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM pf
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support), sum(f1 * support) / sum(support), sum(support) FROM pf)"""
query("met6_classification_report", "class:s precision:d recall:d f1:d support:i", f"{REPORT_SQL}\nRESULT SELECT * FROM rep")(
    lambda spark, sf: metrics.classification_report(class_predictions(spark, sf)))
query("met7_accuracy_weighted_f1", "accuracy:d f1_weighted:d", f"""{REPORT_SQL}
RESULT SELECT (SELECT avg(CASE WHEN y = prediction THEN 1.0 ELSE 0.0 END) FROM pr) AS accuracy, f1 AS f1_weighted FROM rep WHERE class = 'weighted avg'""")(
    lambda spark, sf: metrics.accuracy_and_f1(class_predictions(spark, sf)))
query("ml21_collapse_check", "classes:i collapsed:b", f"{CLASS_PRED_SQL}\nRESULT SELECT count(DISTINCT prediction) AS classes, count(DISTINCT prediction) = 1 AS collapsed FROM pr")(
    lambda spark, sf: metrics.collapse_check(class_predictions(spark, sf)))

# --- scorecard --------------------------------------------------------------------------------

DQ_SQL = f"""dq AS (SELECT count(*) AS total_articles,
  count(*) FILTER (WHERE text IS NOT NULL AND sentiment IS NOT NULL AND topic IS NOT NULL AND NOT {blank_sql('summary')}) AS complete_articles,
  round(avg(length(coalesce(text, ''))), 0) AS avg_text_length, round(avg({words_sql('text')}), 0) AS avg_word_count,
  min(length(coalesce(text, ''))) AS min_text_length, max(length(coalesce(text, ''))) AS max_text_length FROM docs),
dq2 AS (SELECT *, complete_articles * 100.0 / total_articles AS completeness_rate FROM dq)"""
SB_SQL = """sb AS (SELECT sentiment, round(count(*) * 100.0 / (SELECT count(*) FROM docs), 1)::DOUBLE AS pct FROM docs GROUP BY sentiment),
sb2 AS (SELECT coalesce(max(pct) FILTER (WHERE sentiment = 'negative'), 0) AS negative_pct, coalesce(max(pct) FILTER (WHERE sentiment = 'neutral'), 0) AS neutral_pct,
  coalesce(max(pct) FILTER (WHERE sentiment = 'positive'), 0) AS positive_pct, max(pct) / min(pct) AS imbalance_ratio, max(pct) / min(pct) > 10 AS imbalanced FROM sb)"""
TQ_SQL = """tz AS (SELECT topic, count(*) AS n FROM docs GROUP BY topic),
tq AS (SELECT count(*) FILTER (WHERE topic <> -1) AS num_topics, coalesce(sum(n) FILTER (WHERE topic = -1), 0) AS outlier_count,
  coalesce(sum(n) FILTER (WHERE topic = -1), 0) * 100.0 / sum(n) AS outlier_rate, round(avg(n) FILTER (WHERE topic <> -1), 1) AS avg_topic_size,
  min(n) FILTER (WHERE topic <> -1) AS min_topic_size, max(n) FILTER (WHERE topic <> -1) AS max_topic_size,
  (max(n) FILTER (WHERE topic <> -1))::DOUBLE / (min(n) FILTER (WHERE topic <> -1)) AS size_ratio,
  (max(n) FILTER (WHERE topic <> -1))::DOUBLE / (min(n) FILTER (WHERE topic <> -1)) > 5 AS uneven FROM tz)"""
SU_SQL = f"""su0 AS (SELECT NOT {blank_sql('summary')} AS has, length(summary) AS c, {words_sql('summary')} AS w, length(coalesce(text, ''))::DOUBLE / nullif(length(summary), 0) AS r FROM docs),
su AS (SELECT count(*) FILTER (WHERE has) * 100.0 / count(*) AS coverage, round(avg(c) FILTER (WHERE has), 0) AS avg_summary_length,
  round(avg(w) FILTER (WHERE has), 0) AS avg_summary_words, avg(r) FILTER (WHERE has) AS avg_compression, min(c) FILTER (WHERE has) AS min_summary_length,
  max(c) FILTER (WHERE has) AS max_summary_length, count(*) FILTER (WHERE has AND w < 20) AS too_short, count(*) FILTER (WHERE has AND w > 150) AS too_long,
  coalesce(avg(r) FILTER (WHERE has) BETWEEN 5 AND 15, false) AS optimal FROM su0)"""
TE_SQL = """te AS (SELECT count(publishedAt) AS articles_with_dates, date_sub('day', min(publishedAt), max(publishedAt)) AS date_range_days, min(publishedAt) AS start, max(publishedAt) AS "end" FROM docs),
te2 AS (SELECT *, round(articles_with_dates::DOUBLE / greatest(date_range_days, 1), 2) AS articles_per_day FROM te)"""

query("evl1_data_quality", "total_articles:i complete_articles:i completeness_rate:d avg_text_length:d avg_word_count:d min_text_length:i max_text_length:i",
      f"WITH {DQ_SQL}\nRESULT SELECT * FROM dq2")(lambda spark, sf: scorecard.data_quality(docs(spark, sf)))
query("evl2_sentiment_balance", "negative_pct:d neutral_pct:d positive_pct:d imbalance_ratio:d imbalanced:b", f"WITH {SB_SQL}\nRESULT SELECT * FROM sb2")(
    lambda spark, sf: scorecard.sentiment_balance(docs(spark, sf)))
query("evl3_topics", "num_topics:i outlier_count:i outlier_rate:d avg_topic_size:d min_topic_size:i max_topic_size:i size_ratio:d uneven:b", f"WITH {TQ_SQL}\nRESULT SELECT * FROM tq")(
    lambda spark, sf: scorecard.topic_quality(docs(spark, sf)))
query("evl3_first_labels", "topic:i topic_label:s count:i pct:d", """
SELECT topic, arg_min(title, article_id) AS topic_label, count(*) AS count, count(*) * 100.0 / (SELECT count(*) FROM docs) AS pct FROM docs GROUP BY topic""")(
    lambda spark, sf: scorecard.first_labels(docs(spark, sf).withColumn("topic_label", F.col("title"))))
query("evl4_coherence_proxy", "coherence_proxy:d", f"""
WITH {CTF_SQL}\nRESULT SELECT round(least(coalesce(avg(n), 0) / 10 * 100, 100), 1) AS coherence_proxy FROM (SELECT count(term) AS n FROM tt WHERE topic <> -1 GROUP BY topic)""")(
    lambda spark, sf: scorecard.coherence_proxy(best_terms(spark, sf)))
query("evl5_summarization", "coverage:d avg_summary_length:d avg_summary_words:d avg_compression:d min_summary_length:i max_summary_length:i too_short:i too_long:i optimal:b",
      f"WITH {SU_SQL}\nRESULT SELECT * FROM su")(lambda spark, sf: scorecard.summary_section(docs(spark, sf)))
query("evl6_temporal", "articles_with_dates:i date_range_days:i articles_per_day:d start:s end:s", f"WITH {TE_SQL}\nRESULT SELECT * FROM te2")(
    lambda spark, sf: scorecard.temporal(docs(spark, sf)))
SCORE_SQL = f"""{DQ_SQL}, {SB_SQL}, {TQ_SQL}, {SU_SQL},
cs AS (SELECT completeness_rate::DOUBLE AS completeness_score, greatest(0, 100 - (imbalance_ratio - 1) * 10)::DOUBLE AS balance_score,
  greatest(0, 100 - greatest(outlier_rate - 20, 0) * 2 - greatest(size_ratio - 5, 0) * 5)::DOUBLE AS topic_score,
  (CASE WHEN avg_compression BETWEEN 5 AND 15 THEN least(100, coverage + 10) ELSE coverage END)::DOUBLE AS summary_score FROM dq2, sb2, tq, su),
ov AS (SELECT *, 0.30::DOUBLE * completeness_score + 0.15::DOUBLE * balance_score + 0.25::DOUBLE * topic_score + 0.30::DOUBLE * summary_score AS overall FROM cs)"""
_SCORE_SPEC = "completeness_score:d balance_score:d topic_score:d summary_score:d overall_score:d rating:s"
query("evl7_overall_score", _SCORE_SPEC, f"""
WITH {SCORE_SQL}
RESULT SELECT round(completeness_score, 1) AS completeness_score, round(balance_score, 1) AS balance_score, round(topic_score, 1) AS topic_score,
  round(summary_score, 1) AS summary_score, round(overall, 1) AS overall_score,
  CASE WHEN overall >= 90 THEN 'EXCELLENT' WHEN overall >= 75 THEN 'GOOD' WHEN overall >= 60 THEN 'ACCEPTABLE' ELSE 'NEEDS IMPROVEMENT' END AS rating FROM ov""")(
    lambda spark, sf: scorecard.scored(docs(spark, sf)))
query("evl8_rating", "date:s score:d rating:s", """
WITH s AS (SELECT date, (avg_sentiment + 1) * 50 AS score FROM dailyo)
RESULT SELECT *, CASE WHEN score >= 90 THEN 'EXCELLENT' WHEN score >= 75 THEN 'GOOD' WHEN score >= 60 THEN 'ACCEPTABLE' ELSE 'NEEDS IMPROVEMENT' END AS rating FROM s""")(
    lambda spark, sf: orders_daily(spark, sf).select("date", ((F.col("avg_sentiment") + 1) * 50).alias("score")).withColumn("rating", scorecard.rating(F.col("score"))))
query("evl9_full_report", "report:s")(lambda spark, sf: scorecard.full_report(docs(spark, sf)).select(F.to_json(F.struct("*")).alias("report")))
query("evl9_report_values", "total_articles:i completeness_rate:d imbalance_ratio:d num_topics:i coherence_proxy:d largest_topic:i largest_label:s labels:i coverage:d date_range_days:i overall_score:d", f"""
WITH {SCORE_SQL}, {TE_SQL}, {CTF_SQL}, co AS (SELECT round(least(coalesce(avg(n), 0) / 10 * 100, 100), 1) AS coherence_proxy FROM (SELECT count(term) AS n FROM tt WHERE topic <> -1 GROUP BY topic)),
la AS (SELECT topic, arg_min(title, article_id) AS topic_label, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, topic) AS place FROM docs GROUP BY topic)
RESULT SELECT total_articles, completeness_rate, imbalance_ratio, num_topics, coherence_proxy, topic AS largest_topic, topic_label AS largest_label, (SELECT count(*) FROM la WHERE place <= 20) AS labels,
  coverage, date_range_days, round(overall, 1) AS overall_score FROM dq2, sb2, tq, su, te2, co, ov, la WHERE place = 1""")(
    lambda spark, sf: scorecard.full_report(docs(spark, sf).withColumn("topic_label", F.col("title")), best_terms(spark, sf)).select(
        "data_quality.total_articles", "data_quality.completeness_rate", "sentiment.imbalance_ratio", "topics.num_topics", "coherence.coherence_proxy",
        F.col("topic_labels")[0]["topic"].alias("largest_topic"), F.col("topic_labels")[0]["topic_label"].alias("largest_label"), F.size("topic_labels").alias("labels"),
        "summarization.coverage", "temporal.date_range_days", "overall_quality.overall_score"))
query("ml22_sufficiency_gate", "date_range_days:i can_train:b warn:b", f"WITH {TE_SQL}\nRESULT SELECT date_range_days, date_range_days >= 14 AS can_train, date_range_days < 30 AS warn FROM te2")(
    lambda spark, sf: scorecard.sufficiency_gate(docs(spark, sf)))

# --- dashboard --------------------------------------------------------------------------------

_ROW = "article_id:i title:s source:s sentiment:s publishedAt:s"
query("dsh1_filter", _ROW, "SELECT * FROM docs WHERE sentiment = 'positive' AND topic = 1")(
    lambda spark, sf: dashboard.filter_articles(docs(spark, sf).withColumn("topic_name", F.concat(F.lit("Topic "), F.col("topic").cast("string"))), "positive", "Topic 1"))
query("dsh2_unique_articles", _ROW, "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY article_id) AS rn FROM docs) WHERE rn = 1")(
    lambda spark, sf: dashboard.unique_articles(docs(spark, sf)))
query("dsh2_originals", "article_id:i title:s", f"WITH {SPREAD_SQL}\nRESULT SELECT article_id, title FROM spr WHERE is_original")(
    lambda spark, sf: dashboard.unique_articles(spread_table(spark, sf)))
query("dsh3_sort_by_date", _ROW, "SELECT * FROM docs ORDER BY publishedAt DESC NULLS LAST, article_id")(lambda spark, sf: dashboard.sort_by_date(docs(spark, sf)))
query("dsh4_headline_counts", "total:i originals:i copies:i top_sentiment:s", """
WITH u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY article_id) AS rn FROM docs) WHERE rn = 1)
RESULT SELECT (SELECT count(*) FROM docs) AS total, (SELECT count(*) FROM u) AS originals, (SELECT count(*) FROM docs) - (SELECT count(*) FROM u) AS copies,
  (SELECT sentiment FROM u GROUP BY sentiment ORDER BY count(*) DESC, sentiment LIMIT 1) AS top_sentiment""")(
    lambda spark, sf: dashboard.headline_counts(docs(spark, sf)))
query("dsh5_articles_by_topic", "topic:i count:i", "SELECT topic, count(*) AS count FROM docs GROUP BY 1")(lambda spark, sf: dashboard.count_by(docs(spark, sf), "topic"))
query("dsh6_sentiment_counts", "sentiment:s count:i", "SELECT sentiment, count(*) AS count FROM docs GROUP BY 1")(lambda spark, sf: dashboard.count_by(docs(spark, sf), "sentiment"))
query("dsh7_with_summary", "article_id:i summary:s", f"SELECT article_id, summary FROM docs WHERE NOT {blank_sql('summary')} AND lower(summary) <> 'nan'")(
    lambda spark, sf: dashboard.with_summary(docs(spark, sf)))
query("dsh8_page", "article_id:i clean_title:s publishedAt:s", """
SELECT article_id, trim(replace(title, ' - N/A', '')) AS clean_title, publishedAt FROM docs ORDER BY publishedAt DESC NULLS LAST, article_id LIMIT 10 OFFSET 20""")(
    lambda spark, sf: dashboard.page(docs(spark, sf), 3, 10))
query("dsh8_page_count", "articles:i pages:i", "SELECT count(*) AS articles, (count(*) - 1) // 10 + 1 AS pages FROM docs")(lambda spark, sf: dashboard.page_count(docs(spark, sf)))
query("dsh9_filter_values", "filter:s value:s", """
SELECT DISTINCT 'sentiment' AS filter, sentiment AS value FROM docs UNION SELECT 'topic', CAST(topic AS VARCHAR) FROM docs UNION SELECT 'source', source FROM docs""")(
    lambda spark, sf: dashboard.filter_values(docs(spark, sf)))
query("dsh10_spread_note", "article_id:i spread_note:s", f"""
WITH {SPREAD_SQL}
RESULT SELECT article_id, CASE WHEN NOT is_original AND similarity_category = 'exact_copy' THEN 'Exact Copy - Same title as article from ' || original_source
  WHEN NOT is_original AND similarity_category = 'semantic_copy' THEN 'Semantic Copy - ' || CAST(round(similarity_score * 100, 0)::INT AS VARCHAR) || '% similar to article from ' || original_source
  WHEN NOT is_original AND similarity_category = 'paraphrased' THEN 'Paraphrased - ' || CAST(round(similarity_score * 100, 0)::INT AS VARCHAR) || '% similar to article from ' || original_source
  WHEN is_original AND spread_count > 0 THEN 'Original Article - Copied by ' || spread_count || ' other sources' END AS spread_note FROM spr""")(
    lambda spark, sf: dashboard.with_notes(spread_table(spark, sf)))

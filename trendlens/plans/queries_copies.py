"""Queries over copy detection and the spread of stories."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.functions.labels import similarity_category
from trendlens.functions.text import dup_text
from trendlens.operators import dedup, similarity, spread, topics
from trendlens.plans.registry import query, stage
from trendlens.sources.adapters import document_articles, table

ID = "article_id"


def docs(spark, sf):
    return document_articles(spark, sf).select(ID, "title", "text", "publishedAt", "source")


def whole(spark, sf):
    return docs(spark, sf).select(ID, dup_text(F.col("title"), F.col("text")).alias("dup"))


def build_spread(spark, sf):
    return dedup.detect_duplicates_and_spread(docs(spark, sf))


def build_prior(spark, sf):
    return dedup.best_prior_match(docs(spark, sf))


def spread_table(spark, sf):
    """Stage table read by the reports, which look at no text: built once per session, as the reports of a run share it."""
    return stage("spread", spark, sf, lambda s, f: build_spread(s, f).drop("text"))


def prior_table(spark, sf):
    return stage("prior", spark, sf, lambda s, f: build_prior(s, f).drop("text"))


EXACT_SQL = """
grp AS (SELECT title AS gt, first(article_id ORDER BY publishedAt NULLS LAST, article_id) AS oid,
               first(source ORDER BY publishedAt NULLS LAST, article_id) AS osrc FROM docs WHERE title IS NOT NULL GROUP BY title HAVING count(*) > 1),
ex AS (SELECT d.*, CASE WHEN oid <> article_id AND source IS DISTINCT FROM osrc THEN oid END AS dup1, osrc FROM docs d LEFT JOIN grp ON title = gt)"""


def pairs_sql(source: str, threshold: float) -> str:
    """Brute-force cosine of all pairs of distinct texts of an article view."""
    return f"""
mem AS MATERIALIZED (SELECT article_id, min(article_id) OVER (PARTITION BY dt) AS vid, dt
   FROM (SELECT article_id, coalesce(title, '') || ' ' || coalesce(text, '') AS dt FROM {source})),
tf AS (SELECT vid, term, count(*) AS tf FROM (
   SELECT vid, unnest(regexp_split_to_array(lower(dt), '[^\\p{{L}}\\p{{N}}_]+')) AS term FROM mem WHERE article_id = vid) WHERE term <> '' GROUP BY ALL),
tdf AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
tw AS (SELECT vid, tf.term, tf * (ln(((SELECT count(DISTINCT vid) FROM mem) + 1)::DOUBLE / (df + 1)::DOUBLE) + 1.0::DOUBLE) AS w FROM tf JOIN tdf ON tf.term = tdf.term),
tv AS MATERIALIZED (SELECT vid, term, w / sqrt(sum(w * w) OVER (PARTITION BY vid)) AS w FROM tw),
prs AS MATERIALIZED (SELECT x.vid AS a, y.vid AS b, round(sum(x.w * y.w), 6) AS cosine FROM tv x JOIN tv y ON x.term = y.term AND x.vid < y.vid
   GROUP BY ALL HAVING round(sum(x.w * y.w), 6) >= {threshold})"""


SPREAD_SQL = f"""{EXACT_SQL},
orig AS (SELECT * FROM ex WHERE dup1 IS NULL), {pairs_sql('orig', 0.70)},
ap AS (SELECT least(x.article_id, y.article_id) AS i, greatest(x.article_id, y.article_id) AS j, cosine
         FROM prs JOIN mem x ON x.vid = prs.a JOIN mem y ON y.vid = prs.b
       UNION ALL SELECT x.article_id, y.article_id, 1.0 FROM mem x JOIN mem y ON x.vid = y.vid AND x.article_id < y.article_id),
ori AS (SELECT i, j, cosine, di.title AS ti, dj.title AS tj,
          CASE WHEN dj.publishedAt IS NULL OR di.publishedAt <= dj.publishedAt THEN i ELSE j END AS o
        FROM ap JOIN docs di ON di.article_id = i JOIN docs dj ON dj.article_id = j
        WHERE di.title <> dj.title AND NOT (di.publishedAt IS NULL AND dj.publishedAt IS NULL)),
cp AS (SELECT o, i + j - o AS c, cosine, i, j FROM ori),
sem AS (SELECT * FROM (SELECT cp.*, row_number() OVER (PARTITION BY c ORDER BY i, j) AS rn FROM cp
          JOIN docs po ON po.article_id = o JOIN docs pc ON pc.article_id = c WHERE po.source IS DISTINCT FROM pc.source) WHERE rn = 1),
mrk AS (SELECT ex.article_id, ex.title, ex.source, ex.publishedAt, coalesce(dup1, sem.o) AS duplicate_of,
          dup1 IS NULL AND sem.o IS NULL AS is_original, coalesce(sem.cosine, 1.0) AS similarity_score,
          CASE WHEN dup1 IS NOT NULL THEN osrc WHEN sem.o IS NOT NULL THEN so.source ELSE ex.source END AS original_source,
          CASE WHEN dup1 IS NOT NULL THEN 'exact_copy' WHEN sem.cosine >= 0.85 THEN 'semantic_copy' WHEN sem.cosine IS NOT NULL THEN 'paraphrased'
               ELSE 'original' END AS similarity_category
        FROM ex LEFT JOIN sem ON sem.c = ex.article_id LEFT JOIN docs so ON so.article_id = sem.o),
spr AS MATERIALIZED (SELECT mrk.*, coalesce(n, 0) AS spread_count FROM mrk
        LEFT JOIN (SELECT duplicate_of AS k, count(*) AS n FROM mrk WHERE NOT is_original GROUP BY 1) ON k = mrk.article_id)"""

PRIOR_SQL = f"""{pairs_sql('docs', 0.70)},
ps AS (SELECT article_id, title, source, publishedAt, row_number() OVER (ORDER BY publishedAt NULLS LAST, article_id) AS pos FROM docs),
ap AS (SELECT x.article_id AS i, y.article_id AS j, cosine FROM prs JOIN mem x ON x.vid = prs.a JOIN mem y ON y.vid = prs.b
       UNION ALL SELECT y.article_id, x.article_id, cosine FROM prs JOIN mem x ON x.vid = prs.a JOIN mem y ON y.vid = prs.b
       UNION ALL SELECT x.article_id, y.article_id, 1.0 FROM mem x JOIN mem y ON x.vid = y.vid AND x.article_id <> y.article_id),
bst AS (SELECT * FROM (SELECT i, j, cosine, row_number() OVER (PARTITION BY i ORDER BY cosine DESC, p.pos) AS rn
          FROM ap JOIN ps c ON c.article_id = i JOIN ps p ON p.article_id = j WHERE p.pos < c.pos) WHERE rn = 1),
pm0 AS (SELECT ps.*, j AS duplicate_of, j IS NULL AS is_original, CASE WHEN pos = 1 THEN 0.0 ELSE cosine END AS similarity_score,
          CASE WHEN cosine >= 0.85 THEN 'duplicate' WHEN cosine >= 0.70 THEN 'similar' ELSE 'original' END AS similarity_category
        FROM ps LEFT JOIN bst ON bst.i = ps.article_id),
rt AS (SELECT article_id, duplicate_of AS ptr, 1 AS depth FROM pm0 WHERE duplicate_of IS NOT NULL
       UNION ALL SELECT rt.article_id, p.duplicate_of, rt.depth + 1 FROM rt JOIN pm0 p ON p.article_id = rt.ptr WHERE p.duplicate_of IS NOT NULL),
root AS (SELECT article_id, arg_max(ptr, depth) AS root, max(depth) AS depth FROM rt GROUP BY article_id),
prior AS MATERIALIZED (SELECT pm0.*, coalesce(rs.source, pm0.source) AS original_source, coalesce(root.depth, 0) AS depth FROM pm0
        LEFT JOIN root ON root.article_id = pm0.article_id LEFT JOIN docs rs ON rs.article_id = root.root)"""

_MARK = "article_id:i is_original:b duplicate_of:d similarity_score:d original_source:s similarity_category:s"

query("dup1_exact_title_copies", "article_id:i is_original:b duplicate_of:d original_source:s similarity_category:s", f"""
WITH {EXACT_SQL}
RESULT SELECT article_id, dup1 IS NULL AS is_original, dup1 AS duplicate_of, CASE WHEN dup1 IS NULL THEN source ELSE osrc END AS original_source,
  CASE WHEN dup1 IS NULL THEN 'original' ELSE 'exact_copy' END AS similarity_category FROM ex""")(
    lambda spark, sf: dedup.exact_title_copies(docs(spark, sf)))
query("dup2_dup_text", "article_id:i with_text:s title_only:s whole:s", """
SELECT article_id, coalesce(title, '') || ' ' || substring(coalesce(text, ''), 1, 500) AS with_text, coalesce(title, '') AS title_only,
  coalesce(title, '') || ' ' || coalesce(text, '') AS whole FROM docs""")(
    lambda spark, sf: docs(spark, sf).select(
        ID, dup_text(F.col("title"), F.col("text"), 500).alias("with_text"),
        dup_text(F.col("title"), F.col("text"), title_only=True).alias("title_only"), dup_text(F.col("title"), F.col("text")).alias("whole")))
query("dup3_vectorise", "vid:i term:s weight:d", f"WITH {pairs_sql('docs', 0.70)}\nRESULT SELECT vid, term, w AS weight FROM tv")(
    lambda spark, sf: similarity.tfidf(similarity.distinct_texts(whole(spark, sf), "dup", ID)[1]))
query("dup4_cosine_pairs", "a:i b:i cosine:d", f"WITH {pairs_sql('docs', 0.70)}\nRESULT SELECT a, b, cosine FROM prs")(
    lambda spark, sf: similarity.text_pairs(whole(spark, sf), "dup", ID, 0.70)[1])


@query("dup4_cosine_pairs_dense", "a:i b:i cosine:d", """
SELECT x.vec_id AS a, y.vec_id AS b, round(list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) AS cosine
FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id
WHERE round(list_cosine_similarity(x.embedding::DOUBLE[], y.embedding::DOUBLE[]), 6) >= 0.40""")
def dup4_dense(spark, sf):
    vectors = table(spark, sf, "embeddings")
    _, model = topics.cluster_docs(vectors, 16)
    return similarity.dense_pairs(vectors, [list(c) for c in model.clusterCenters()], 0.40)


@query("dup4_cosine_pairs_lsh", "outside:i recall_met:b", "SELECT 0 AS outside, true AS recall_met")
def dup4_lsh(spark, sf):
    """The approximate pairs against the exact ones: none outside, at least nine of ten found."""
    vectors = table(spark, sf, "embeddings")
    near = similarity.dense_pairs_lsh(vectors, 0.40).select("a", "b", F.lit(1).alias("near"))
    exact = dup4_dense(spark, sf).select("a", "b", F.lit(1).alias("exact"))
    both = near.join(exact, ["a", "b"], "full")
    found, whole = F.count_if(F.col("near").isNotNull() & F.col("exact").isNotNull()), F.count("exact")
    return both.agg(F.count_if(F.col("exact").isNull()).alias("outside"), (found >= whole * 0.9).alias("recall_met"))


@query("dup5_mark_semantic_copies", _MARK, f"WITH {SPREAD_SQL}\nRESULT SELECT * FROM spr")
def dup5(spark, sf):
    return dedup.mark_semantic_copies(dedup.exact_title_copies(docs(spark, sf)))


query("dup6_similarity_category", "a:i b:i category:s class_name:s", f"""
WITH {pairs_sql('docs', 0.60)}
RESULT SELECT a, b, CASE WHEN cosine >= 0.85 THEN 'semantic_copy' WHEN cosine >= 0.70 THEN 'paraphrased' ELSE 'original' END AS category,
  CASE WHEN cosine >= 0.85 THEN 'duplicate' WHEN cosine >= 0.70 THEN 'similar' ELSE 'original' END AS class_name FROM prs""")(
    lambda spark, sf: similarity.text_pairs(whole(spark, sf), "dup", ID, 0.60)[1].select(
        "a", "b", similarity_category(F.col("cosine")).alias("category"), similarity_category(F.col("cosine"), "duplicate", "similar").alias("class_name")))
query("dup7_spread_count", "article_id:i spread_count:i", f"""
WITH {EXACT_SQL}
RESULT SELECT ex.article_id, coalesce(n, 0) AS spread_count FROM ex LEFT JOIN (SELECT dup1 AS k, count(*) AS n FROM ex WHERE dup1 IS NOT NULL GROUP BY 1) ON k = ex.article_id""")(
    lambda spark, sf: dedup.spread_count(dedup.exact_title_copies(docs(spark, sf))))
query("dup8_best_prior_match", _MARK, f"WITH {PRIOR_SQL}\nRESULT SELECT * FROM prior")(build_prior)
query("dup9_resolve_root", "article_id:i root:i depth:i", f"WITH {PRIOR_SQL}\nRESULT SELECT article_id, root, depth FROM root")(
    lambda spark, sf: dedup.resolve_root(prior_table(spark, sf)))
query("dup10_similarity_clusters", "head:i size:i sources:i start:s end:s", f"""
WITH {PRIOR_SQL}, hd AS (SELECT CASE WHEN depth % 2 = 0 THEN article_id ELSE duplicate_of END AS head, source, publishedAt FROM prior)
RESULT SELECT head, count(*) AS size, count(DISTINCT source) AS sources, min(publishedAt) AS start, max(publishedAt) AS "end" FROM hd GROUP BY head HAVING count(*) >= 2""")(
    lambda spark, sf: dedup.similarity_clusters(prior_table(spark, sf)))
query("dup11_detect_duplicates_and_spread", _MARK + " spread_count:i", f"WITH {SPREAD_SQL}\nRESULT SELECT * FROM spr")(build_spread)
query("dup12_spread_summary", "total:i originals:i copies:i original_pct:d copy_pct:d article_id:i title:s source:s spread_count:i", f"""
WITH {SPREAD_SQL}, tt AS (SELECT count(*) AS total, count(*) FILTER (WHERE is_original) AS originals FROM spr),
tp AS (SELECT article_id, substring(title, 1, 50) AS title, source, spread_count FROM spr WHERE spread_count > 0 ORDER BY spread_count DESC, article_id LIMIT 3)
RESULT SELECT total, originals, total - originals AS copies, originals * 100.0 / total AS original_pct, (total - originals) * 100.0 / total AS copy_pct, tp.*
FROM tt LEFT JOIN tp ON true""")(lambda spark, sf: dedup.spread_summary(spread_table(spark, sf)))

# --- spread reports ---------------------------------------------------------------------------

query("spr1_spread_totals", "total_articles:i original_count:i duplicate_count:i similar_count:i copy_paste_ratio:d duplicate_ratio:d similar_ratio:d", f"""
WITH {PRIOR_SQL}, c AS (SELECT count(*) AS t, count(*) FILTER (WHERE similarity_category = 'original') AS o,
  count(*) FILTER (WHERE similarity_category = 'duplicate') AS d, count(*) FILTER (WHERE similarity_category = 'similar') AS s FROM prior)
RESULT SELECT t AS total_articles, o AS original_count, d AS duplicate_count, s AS similar_count, (d + s)::DOUBLE / t AS copy_paste_ratio,
  d::DOUBLE / t AS duplicate_ratio, s::DOUBLE / t AS similar_ratio FROM c""")(lambda spark, sf: spread.spread_totals(prior_table(spark, sf)))
query("spr2_top_copiers", "source:s copies:i", f"""
WITH {PRIOR_SQL}\nRESULT SELECT source, count(*) AS copies FROM prior WHERE NOT is_original GROUP BY source ORDER BY copies DESC, source LIMIT 10""")(
    lambda spark, sf: spread.top_copiers(prior_table(spark, sf)))
query("spr3_top_originators", "original_source:s originals:i", f"""
WITH {PRIOR_SQL}\nRESULT SELECT original_source, count(*) AS originals FROM prior WHERE is_original GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10""")(
    lambda spark, sf: spread.top_originators(prior_table(spark, sf)))


def chains_sql(view: str, top: int) -> str:
    return f"""cs AS (SELECT duplicate_of AS k, source AS copy_source, count(*) AS from_source FROM {view} WHERE duplicate_of IS NOT NULL GROUP BY ALL),
ct AS (SELECT k, sum(from_source) AS copies FROM cs GROUP BY k),
hd AS (SELECT article_id, title, source, publishedAt AS published, copies FROM {view} JOIN ct ON k = article_id WHERE is_original ORDER BY copies DESC, article_id LIMIT {top})"""


query("spr4_spread_chains", "article_id:i title:s source:s published:s copies:i copy_source:s from_source:i", f"""
WITH {PRIOR_SQL}, {chains_sql('prior', 20)}
RESULT SELECT article_id, substring(title, 1, 100) AS title, source, published, copies, copy_source, from_source FROM hd JOIN cs ON k = article_id""")(
    lambda spark, sf: spread.spread_chains(prior_table(spark, sf)))
query("spr5_top_stories", "article_id:i title:s source:s published:s copies:i copy_source:s", f"""
WITH {SPREAD_SQL}, {chains_sql('spr', 5)}
RESULT SELECT article_id, CASE WHEN length(title) > 80 THEN substring(title, 1, 80) || '...' ELSE title END AS title, source, published, copies, copy_source
FROM hd JOIN cs ON k = article_id""")(lambda spark, sf: spread.top_stories(spread_table(spark, sf)))
query("spr6_source_originality", "source:s original_count:i total_count:i originality_rate:d copied_count:i", f"""
WITH {SPREAD_SQL}, so AS (SELECT source, count(*) FILTER (WHERE is_original) AS original_count, count(*) AS total_count FROM spr GROUP BY source)
RESULT SELECT *, original_count::DOUBLE / total_count AS originality_rate, total_count - original_count AS copied_count FROM so
WHERE total_count >= 2 AND total_count > original_count ORDER BY total_count - original_count DESC, source LIMIT 15""")(
    lambda spark, sf: spread.source_originality(spread_table(spark, sf)))
query("spr7_similarity_histogram", "bin:i bin_start:d bin_end:d count:i", f"""
WITH {SPREAD_SQL}, sc AS (SELECT similarity_score::DOUBLE AS s FROM spr WHERE NOT is_original AND similarity_score > 0),
lm AS (SELECT min(s) AS lo, max(s) AS hi FROM sc),
bn AS (SELECT least(coalesce(floor((s - lo) * 30 / nullif(hi - lo, 0)), 0), 29) + 1 AS bin, lo, hi FROM sc, lm)
RESULT SELECT bin, lo + (hi - lo) / 30 * (bin - 1) AS bin_start, lo + (hi - lo) / 30 * bin AS bin_end, count(*) AS count FROM bn GROUP BY bin, lo, hi""")(
    lambda spark, sf: spread.similarity_histogram(spread_table(spark, sf)))
query("spr8_category_breakdown", "similarity_category:s count:i copy_paste_ratio:d label:s", f"""
WITH {SPREAD_SQL}, r AS (SELECT count(*) FILTER (WHERE similarity_category <> 'original')::DOUBLE / count(*) AS v FROM spr)
RESULT SELECT similarity_category, count(*) AS count, any_value(v) AS copy_paste_ratio,
  CASE WHEN any_value(v) < 0.10 THEN 'Excellent' WHEN any_value(v) < 0.25 THEN 'Moderate' WHEN any_value(v) < 0.40 THEN 'High' ELSE 'Very High' END AS label
FROM spr, r GROUP BY 1""")(lambda spark, sf: spread.category_breakdown(spread_table(spark, sf)))
query("spr9_spread_detail", "article_id:i title:s source:s publishedAt:s similarity_category:s similarity_score:d original_source:s", f"""
WITH {SPREAD_SQL}\nRESULT SELECT * FROM spr WHERE similarity_category = 'exact_copy' ORDER BY article_id LIMIT 100""")(
    lambda spark, sf: spread.spread_detail(spread_table(spark, sf), "exact_copy"))


@query("spr10_analyze", "totals:s copiers:i originators:i chains:i clusters:i")
def spr10(spark, sf):
    """All parts of the copy analysis, one row."""
    marked = prior_table(spark, sf)
    one = [F.count(F.lit(1))]
    parts = [
        spread.spread_totals(marked).select(F.to_json(F.struct("*")).alias("totals")),
        spread.top_copiers(marked).agg(one[0].alias("copiers")), spread.top_originators(marked).agg(one[0].alias("originators")),
        spread.spread_chains(marked).agg(one[0].alias("chains")), dedup.similarity_clusters(marked).agg(one[0].alias("clusters")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.join(F.broadcast(p), F.lit(True))  # one row each
    return out


@query("spr10_analyze_parts", "total_articles:i duplicate_count:i copiers:i originators:i chains:i clusters:i", f"""
WITH {PRIOR_SQL}, {chains_sql('prior', 20)}, h2 AS (SELECT CASE WHEN depth % 2 = 0 THEN article_id ELSE duplicate_of END AS head FROM prior)
RESULT SELECT (SELECT count(*) FROM prior) AS total_articles, (SELECT count(*) FROM prior WHERE similarity_category = 'duplicate') AS duplicate_count,
  (SELECT least(10, count(DISTINCT source)) FROM prior WHERE NOT is_original) AS copiers, (SELECT least(10, count(DISTINCT original_source)) FROM prior WHERE is_original) AS originators,
  (SELECT count(*) FROM hd JOIN cs ON k = article_id) AS chains, (SELECT count(*) FROM (SELECT head FROM h2 GROUP BY head HAVING count(*) >= 2)) AS clusters""")
def spr10_parts(spark, sf):
    out = spr10(spark, sf)
    return out.select(F.get_json_object("totals", "$.total_articles").alias("total_articles"), F.get_json_object("totals", "$.duplicate_count").alias("duplicate_count"), "copiers", "originators", "chains", "clusters")

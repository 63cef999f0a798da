"""The batch job over stage tables: clean, score, topics, summaries, models, scorecard."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.operators import cleaning, dedup, features, forecasting, ingest, scorecard, sentiment, similarity, summary, topics
from trendlens.session import cut_lineage, stage_table
from trendlens.sources.keyed import ARTICLE_KEY, KeyedTable
from trendlens.sources.readers import read_stage_table
from trendlens.sources.writers import write_report, write_stage_table

log = logging.getLogger(__name__)


def topic_vectors(df: DataFrame, width: int = 1 << 9) -> DataFrame:
    """Hashed TF-IDF vectors as an ``embedding`` column, for corpora without supplied vectors.

    Terms are added to their slot with a sign of their own, so terms that share one cancel instead of looking alike.
    """
    rows = similarity.tfidf_rows(df.select(F.col("article_id").alias("vid"), F.col("doc").alias("text"))).where("size(terms) > 0")
    slots = F.transform("terms", lambda t: F.pmod(F.xxhash64(t), F.lit(width)).cast("int"))
    signed = F.zip_with("terms", "ws", lambda t, w: w / F.col("norm") * F.when(F.xxhash64(F.lit(1), t) < 0, -1.0).otherwise(1.0))
    rows = rows.select("vid", slots.alias("slots"), signed.alias("ws")).groupBy("vid").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("slots", "ws")])  # one row an id

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column(1).value_lengths()))
            sums = np.bincount(row * width + batch.column(1).flatten().to_numpy(), batch.column(2).flatten().to_numpy(), batch.num_rows * width)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * width), pa.array(sums))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors], names=["article_id", "embedding"])

    kind = rows.schema["vid"].dataType.simpleString()
    return df.join(rows.mapInArrow(dense, f"article_id {kind}, embedding array<double>"), "article_id")


def add_topics(df: DataFrame, k: int | None = None, stop: list[str] | None = None, min_size: int = 8) -> DataFrame:
    """Topics of the topic documents with labels from class TF-IDF.

    Topics are density clusters with noise; with ``k`` they are k-means clusters with distant vectors marked.
    """
    docs = cleaning.build_topic_doc(df)
    vectors = cut_lineage(topic_vectors(docs))  # clustering passes over the vectors many times
    if k is None:
        found = topics.density_topics(vectors, min_size).select("article_id", "topic")
        marked = cut_lineage(docs.drop("topic").join(found, "article_id", "left").na.fill(-1, ["topic"]))
    else:
        clustered, _ = topics.cluster_docs(vectors, k)
        marked = cut_lineage(topics.mark_outliers(cut_lineage(clustered)).drop("embedding", "distance"))
    stop = topics.stopwords() if stop is None else stop
    counts = topics.vectorise_terms(marked, "doc", "topic", stop, min_df=1, max_df=0.75)
    labels = topics.topic_labels(topics.top_terms(topics.class_tfidf(counts)), stop)
    return topics.label_articles(marked.drop("doc"), labels)


@dataclass
class Run:
    """What a batch run did: the outcome of each stage and how many rows it worked on anew."""

    outcome: dict[str, str]
    worked: dict[str, int]

    def failed(self) -> dict[str, str]:
        return {name: text for name, text in self.outcome.items() if text.startswith("failed")}


def run_batch(spark: SparkSession, raw: DataFrame, out: str, k_topics: int | None = None, scorer: Callable[[DataFrame], DataFrame] | None = None,
              summariser: Callable[[DataFrame], DataFrame] | None = None, rounds: int = 100, by: tuple[str, ...] = (), min_words: int = 100, train: bool = True) -> Run:
    """Bring the stage tables under ``out`` up to date with ``raw``; run it again with more articles and only these are worked on.

    Articles are known by title, time and source. Cleaning takes in keys that no run has seen, kept or rejected; scoring and
    summaries work on articles that have none, and are upserted into the days they belong to. Copies, topics, daily features,
    models and the scorecard look at the corpus as a whole and are made anew when articles came in.

    Cleaning, scoring, topics and summaries stop the job when they fail; models and the scorecard are logged and show up in
    ``failed()``. Models are trained, unless ``train`` is off, when the articles span at least 14 days.
    """
    run = Run({}, {})
    articles, scored, summed = (KeyedTable(spark, f"{out}/{name}") for name in ("articles", "articles_with_sentiment", "articles_with_summary"))

    def step(name: str, work: Callable[[], int]) -> None:
        start = time.time()
        run.worked[name] = work()
        run.outcome[name] = "ok"
        log.info("%s: %d rows in %.1f s", name, run.worked[name], time.time() - start)

    def optional(name: str, work: Callable[[], str]) -> None:
        try:
            run.outcome[name] = work()
        except Exception as error:  # noqa: BLE001  these stages must not stop the job
            log.exception("%s failed", name)
            run.outcome[name] = f"failed: {error}"

    def clean() -> int:
        fresh = stage_table(articles.unseen(raw), "fresh")
        n = fresh.count()
        if n:
            articles.upsert(cleaning.clean_articles(fresh, detect_spread=False, min_words=min_words), processed=fresh)
        return n

    def score() -> int:
        fresh = stage_table(articles.missing_in(scored), "unscored")
        n = fresh.count()
        if n:
            scored.upsert((scorer or sentiment.score_with_lexicon)(fresh))
        return n

    def topic() -> int:
        marked = dedup.detect_duplicates_and_spread(scored.read())
        write_stage_table(add_topics(marked, k_topics), f"{out}/articles_with_topics")
        return read_stage_table(spark, f"{out}/articles_with_topics").count()

    def summarise() -> int:
        now = read_stage_table(spark, f"{out}/articles_with_topics")
        cache = summed.read()
        reused = now.withColumns({"summary": F.lit(None).cast("string"), "needs_work": F.lit(True)}) if cache is None else ingest.reuse_cached(now, cache, "summary")
        reused = stage_table(reused, "reused")
        work = reused.where("needs_work").drop("needs_work", "summary")
        n = work.count()
        made = (summariser or summary.summarise)(work) if n else reused.limit(0).drop("needs_work")
        if n:
            summed.upsert(made.select("article_id", *ARTICLE_KEY, "summary"))
        both = made.unionByName(reused.where("NOT needs_work").drop("needs_work"))
        write_stage_table(both, f"{out}/final")
        return n

    step("articles", clean)
    fresh = run.worked["articles"] > 0 or not _exists(spark, f"{out}/final")
    step("articles_with_sentiment", score)
    if not fresh and not run.worked["articles_with_sentiment"]:
        run.outcome.update(dict.fromkeys(("articles_with_topics", "articles_with_summary", "models", "scorecard"), "unchanged"))
        return run
    step("articles_with_topics", topic)
    step("articles_with_summary", summarise)
    final = read_stage_table(spark, f"{out}/final")

    def models() -> str:
        gate = scorecard.sufficiency_gate(final).first()
        if not gate["can_train"]:
            return "skipped: too few days"
        write_stage_table(features.create_all_features(final.drop("topic"), by=by), f"{out}/daily_aggregates")
        forecasting.train_all(read_stage_table(spark, f"{out}/daily_aggregates"), by, rounds).save(spark, f"{out}/models")
        return "ok"

    def report() -> str:
        write_report(scorecard.full_report(final, topics.topic_terms(final)), f"{out}/report", f"{out}/report_text")
        return "ok"

    if train:
        optional("models", models)
    optional("scorecard", report)
    return run


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException:
        return False
    return True


def retrain(spark: SparkSession, articles: DataFrame, out: str, rounds: int = 100, by: tuple[str, ...] = ()) -> forecasting.Trained:
    """Features, training and saving, as one job."""
    write_stage_table(features.create_all_features(articles, by=by), f"{out}/daily_aggregates")
    trained = forecasting.train_all(read_stage_table(spark, f"{out}/daily_aggregates"), by, rounds)
    trained.save(spark, f"{out}/models")
    return trained

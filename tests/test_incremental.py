"""Keyed tables, the incremental batch run, topics on small data, and plans."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlens.operators import similarity, topics
from trendlens.plans import batch_job
from trendlens.relational import connected, keep_one
from trendlens.sources import readers
from trendlens.sources.keyed import KeyedTable

KEYS = "title string, publishedAt string, source string, article_id long, note string"


def rows_of(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_upsert_replaces_keys_and_touches_its_days_only(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"))
    assert table.read() is None
    first = [("a", "2025-01-01 10:00:00", "s", 1, "old"), ("b", "2025-01-02 10:00:00", "s", 2, "old"), ("c", None, None, 3, "old"), ("c", None, None, 4, "later")]
    table.upsert(spark.createDataFrame(first, KEYS))
    files = lambda day: {str(p) for p in (tmp_path / "t" / "rows" / f"part={day}").glob("*.parquet")}
    other = files("d20250102")
    table.upsert(spark.createDataFrame([("a", "2025-01-01 10:00:00", "s", 5, "new"), ("d", "2025-01-01 11:00:00", "t", 6, "new"), ("c", None, None, 7, "new")], KEYS))
    assert rows_of(table.read(), "title", "article_id", "note") == [("a", 5, "new"), ("b", 2, "old"), ("c", 7, "new"), ("d", 6, "new")]
    assert files("d20250102") == other and other
    fresh = table.unseen(spark.createDataFrame([*first, ("e", None, "s", 9, "x"), ("a", "2025-01-01 10:00:00", None, 10, "x")], KEYS))
    assert rows_of(fresh, "title", "article_id") == [("a", 10), ("e", 9)]
    with pytest.raises(ValueError):
        KeyedTable(spark, "x", ("title",))


def corpus(n, seed=5):
    rng = random.Random(seed)
    fields = [[f"{t}{i}" for i in range(12)] for t in ("alpha", "beta", "gamma")]
    out = []
    for i in range(n):
        words = rng.choices(fields[i % 3], k=110)
        out.append((i, f"title {i}", " ".join(words), f"2025-01-{1 + i % 28:02d} 08:{i % 60:02d}:00", f"s{i % 4}"))
    return out


def test_second_run_works_on_new_articles_only(spark, tmp_path):
    scored, summed = [], []

    def scorer(df):
        scored.append(df.count())
        return df.withColumns({"sentiment": F.lit("neutral"), "sentiment_confidence": F.lit(0.5)})

    def summariser(df):
        summed.append(df.count())
        return df.withColumn("summary", F.concat(F.lit("about "), "title"))

    schema = "article_id long, title string, text string, publishedAt string, source string"
    data = [*corpus(60), (900, "short", "too short", "2025-01-03 00:00:00", "s0")]
    out = str(tmp_path / "out")
    run = lambda rows: batch_job.run_batch(spark, spark.createDataFrame(rows, schema), out, scorer=scorer, summariser=summariser, train=False)
    one = run([r for r in data if r[0] % 3])
    assert one.worked["articles"] == 40 and scored == [40] and summed == [40]
    two = run(data)
    assert two.worked["articles"] == 21 and scored == [40, 20] and summed == [40, 20]  # the short one was looked at and rejected
    three = run(data)
    assert three.worked == {"articles": 0, "articles_with_sentiment": 0} and scored == [40, 20] and set(three.outcome.values()) == {"ok", "unchanged"}
    final = readers.read_stage_table(spark, f"{out}/final")
    assert rows_of(final, "article_id", "summary") == sorted(((r[0], f"about {r[1]}") for r in data[:60]), key=str)
    assert final.where("sentiment <> 'neutral' OR topic IS NULL").isEmpty() and not two.failed()


def test_density_topics_tell_noise_from_topics(spark):
    rng = np.random.default_rng(3)
    centres = np.eye(8)[:3] * 4
    x = np.concatenate([c + rng.normal(0, 0.15, (25, 8)) for c in centres] + [rng.normal(0, 3, (4, 8))])
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)] + [(99, None)], "article_id long, embedding array<double>")
    got = {r.article_id: r.topic for r in topics.density_topics(df, width=3).collect()}
    assert got[99] == -1 and len(got) == 80
    for k in range(3):
        main = {got[i] for i in range(25 * k, 25 * k + 25)} - {-1}
        assert len(main) == 1
    assert {got[i] for i in (0, 30, 60)} == {0, 1, 2}


def test_topic_model_rows_sum_to_one(spark):
    texts = [" ".join(random.Random(i).choices(["goal", "match", "team"] if i % 2 else ["bank", "rate", "money"], k=30)) for i in range(20)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "article_id long, doc string")
    shares, _ = topics.topic_model(df, 2)
    total = {r.article_id: r.t for r in shares.groupBy("article_id").agg(F.sum("probability").alias("t")).collect()}
    assert len(total) == 22 and all(t == pytest.approx(1) for t in total.values())
    top = {r.article_id: r.topic for r in shares.groupBy("article_id").agg(F.max_by("topic", "probability").alias("topic")).collect()}
    assert len({top[i] for i in range(0, 20, 2)}) == 1 and top[0] != top[1]


def test_probabilities_by_blocks(spark):
    rng = np.random.default_rng(4)
    rows = [(i, i % 7, [float(v) for v in rng.normal(0, 30, 4)]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, topic long, embedding array<double>")
    centres = {t: np.mean([r[2] for r in rows if r[1] == t], axis=0) for t in range(7)}
    for block in (2, 256):
        got = {(r.vec_id, r.topic): r.probability for r in topics.topic_probabilities(df, block=block).collect()}
        for i, _, v in rows:
            d = np.array([-np.linalg.norm(np.array(v) - centres[t]) for t in range(7)])
            want = np.exp(d - d.max()) / np.exp(d - d.max()).sum()
            assert [got[i, t] for t in range(7)] == pytest.approx(want.tolist())


def test_connected_chain(spark):
    rng = random.Random(1)
    ids = list(range(300))
    rng.shuffle(ids)
    edges = list(zip(ids, ids[1:], strict=False))[:149] + list(zip(ids[150:], ids[151:], strict=False)) + [(7, 7)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: min(ids[:150]) for i in ids[:150]}, **{i: min(ids[150:]) for i in ids[150:]}}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_evaluates_its_input_once(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = keep_one(docs.withColumn("flat", F.regexp_replace("text", r"\s+", " ")), ["source"], [F.col("doc_id")])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("WindowGroupLimit") == 2  # one before the shuffle, one after it


def test_staleness_reads_no_rows(spark, sf):
    plan = readers.newest_change(spark, f"{sf}/events.parquet")._jdf.queryExecution().executedPlan().toString()
    assert "Scan parquet" not in plan and "modificationTime" in plan and "content" not in plan
    assert readers.newest_change(spark, f"{sf}/events.parquet").first()["modified"] is not None


def test_topic_vectors_add_signed_terms(spark):
    rows = [(1, "a b b c"), (2, "a d"), (3, ""), (4, "e f g a a"), (4, "h a")]
    docs = spark.createDataFrame(rows, "article_id long, doc string")
    got = batch_job.topic_vectors(docs, 8)
    assert "try_element_at" not in got._jdf.queryExecution().analyzed().toString()  # a map is searched from its start
    weights = similarity.tfidf(docs.selectExpr("article_id AS vid", "doc AS text"))
    want = {}
    for r in weights.selectExpr("vid", "pmod(xxhash64(term), 8) AS slot", "CASE WHEN xxhash64(1, term) < 0 THEN -weight ELSE weight END AS w").collect():
        want.setdefault(r["vid"], [0.0] * 8)[r["slot"]] += r["w"]
    got = got.collect()
    assert sorted((r["article_id"], r["doc"]) for r in got) == sorted(r for r in rows if r[1])
    for r in got:
        assert r["embedding"] == pytest.approx(want[r["article_id"]])

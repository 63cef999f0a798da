import numpy as np
import pytest
from pyspark.sql import functions as F

from trendlens.operators import dashboard, metrics, scorecard, summary, topics
from trendlens.relational import group_percentiles, keep_one


def test_overall_score_golden(spark):
    cols = scorecard.overall_score(*[F.lit(v) for v in (100.0, 2.12, 23.68, 348 / 8, 100.0, 14.42)])
    row = spark.range(1).select(*[F.round(c, 1).alias(n) for n, c in cols.items()]).first()
    assert (row.balance_score, row.topic_score, row.summary_score, row.overall_score) == (88.8, 0.0, 100.0, 73.3)
    assert spark.range(1).select(scorecard.rating(F.lit(73.3)).alias("r")).first().r == "ACCEPTABLE"


def test_span_counts_whole_days(spark):
    df = spark.createDataFrame([("2025-01-01 02:00:00",), ("2025-01-03 01:00:00",), ("junk",)], "publishedAt string")
    row = scorecard.temporal(df).first()
    assert (row.date_range_days, row.articles_with_dates, row.articles_per_day) == (1, 2, 2.0)


def test_auc_with_ties_and_one_class(spark):
    rng = np.random.default_rng(1)
    y, s = rng.integers(0, 2, 400), np.round(rng.random(400), 1)
    pos, neg = s[y == 1], s[y == 0]
    want = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "y int, score double")
    assert metrics.roc_auc(df).first().roc_auc == pytest.approx(want)
    assert metrics.roc_auc(df.where("y = 1")).first().roc_auc is None


def test_percentiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    rows = [("a" if i % 3 else "b", float(np.round(v, 2))) for i, v in enumerate(rng.exponential(size=300))]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: (r.q1, r.q2) for r in group_percentiles(df, ["k"], "v", {"q1": 0.25, "q2": 0.95}).collect()}
    for k in ("a", "b"):
        vals = [v for g, v in rows if g == k]
        assert got[k] == pytest.approx((np.percentile(vals, 25), np.percentile(vals, 95)))


def test_zero_division_metrics(spark):
    row = metrics.binary_metrics(spark.createDataFrame([(0, 0), (0, 0)], "y int, prediction int")).first()
    assert (row.precision, row.recall, row.f1) == (0, 0, 0)
    assert metrics.mape(spark.createDataFrame([(0.0, 1.0)], "y double, prediction double")).first().mape is None


def test_blank_and_nan_summaries(spark):
    df = spark.createDataFrame([(1, None), (2, "  "), (3, "NaN"), (4, "ok then")], "article_id long, summary string")
    assert [r.article_id for r in dashboard.with_summary(df).collect()] == [4]
    assert summary.summary_quality(df).first().summaries == 2


def test_thirty_word_rule_and_budget(spark):
    text = " ".join(f"Sentence number {i} holds some few words." for i in range(40))
    df = spark.createDataFrame([(1, text), (2, " ".join(["w"] * 29)), (3, None)], "article_id long, text string")
    got = {r.article_id: r.summary for r in summary.summarise(df, max_words=30).collect()}
    assert 0 < len(got[1].split()) <= 30 and got[2] == "" and got[3] == ""


def test_failing_summary_model_is_retried_text_by_text(spark):
    def fussy(texts):
        if len(texts) > 1 or "bad" in texts[0]:
            raise RuntimeError("no")
        return [texts[0][:5]]

    df = spark.createDataFrame([(1, "good " * 40), (2, "bad " * 40), (3, "fine " * 40)], "article_id long, text string").coalesce(1)
    got = summary.summarise_with(df, fussy).collect()
    assert {r.article_id: r.summary for r in got} == {1: "good ", 2: "", 3: "fine "}
    assert {r.article_id for r in got if r.summary_failed} == {2}


def test_labels_skip_stop_words(spark):
    terms = spark.createDataFrame([(0, "new", 1), (0, "rates", 2), (0, "bank", 3), (1, "said", 1), (-1, "x", 1)], "topic long, term string, rank int")
    got = {r.topic: r.topic_label for r in topics.topic_labels(terms, topics.NEWS_WORDS).collect()}
    assert got == {0: "rates / bank", 1: "Topic 1", -1: "Outlier"}


def test_pages(spark):
    df = spark.range(23).select(F.col("id").alias("article_id"), F.lit("t - N/A").alias("title"), F.lit("2025-01-01").cast("timestamp_ntz").alias("publishedAt"))
    assert [r.article_id for r in dashboard.page(df, 3, 10).collect()] == [20, 21, 22]
    assert dashboard.page_count(df).first().pages == 3
    with pytest.raises(ValueError):
        dashboard.page(df, 1, 500)


def test_keep_one_groups_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a")], "id long, k string")
    assert sorted(r.id for r in keep_one(df, ["k"], [F.col("id")], last=True).collect()) == [2, 3]

import datetime as dt

import pytest
from pyspark.sql import functions as F

from trendlens.functions.labels import dominant_balanced
from trendlens.operators import daily, features, serving, windows


def articles(spark, rows):
    return spark.createDataFrame(rows, "title string, publishedAt string, sentiment string, topic long")


def series(spark, values, start=dt.date(2025, 11, 1)):
    rows = [(start + dt.timedelta(days=i), v, float(i % 3 - 1) / 4) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "date date, total_articles long, avg_sentiment double")


@pytest.fixture(scope="module")
def sample(spark):
    day0 = dt.datetime(2025, 11, 1)
    rows = [(f"t{i}", str(day0 + dt.timedelta(hours=7 * i)), ("positive", "neutral", "negative")[i * 7 % 3], i % 5) for i in range(100)]
    return articles(spark, rows)


def test_daily_totals_and_range(sample):
    rows = daily.daily_base(sample).collect()
    assert sum(r.total_articles for r in rows) == 100
    assert all(-1 <= r.avg_sentiment <= 1 for r in rows)


def test_single_article_day_tie_and_bad_dates(spark):
    df = articles(spark, [("a", "2025-01-01 08:00:00", "positive", 1), ("b", "2025-01-01 09:00:00", "negative", 1),
                          ("c", "2025-01-02 09:00:00", "neutral", 1), ("d", "junk", "neutral", 1), ("e", None, "neutral", 1)])
    rows = {str(r.date): r for r in daily.daily_base(df).collect()}
    assert set(rows) == {"2025-01-01", "2025-01-02"}
    assert rows["2025-01-01"].dominant_sentiment == "negative"
    assert rows["2025-01-02"].std_sentiment == 0.0
    strict = {str(r.date): r for r in daily.daily_class_counts(df).collect()}
    assert strict["2025-01-02"].std_sentiment is None


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="Missing required columns"):
        daily.daily_base(spark.createDataFrame([("a", "b")], "title string, text string"))


def test_all_features_shape(sample):
    frame = features.create_all_features(sample.drop("topic"))
    assert len(frame.columns) == 81
    groups = features.feature_groups(daily.daily_base(sample.drop("topic")))
    assert sorted(c for g in groups.values() for c in g) == sorted(c for c in frame.columns if c not in ("date", "dominant_sentiment", "min_sentiment", "max_sentiment"))
    assert len(groups["lag_features"]) == 10 and len(groups["rolling_features"]) == 40 and len(groups["calendar_features"]) == 11


def test_lags_and_rolling(spark):
    rows = windows.rolling_features(windows.lag_features(series(spark, [5, 7, 9, 1])), windows=[3]).orderBy("date").collect()
    assert [r.total_articles_lag_1d for r in rows] == [None, 5, 7, 9]
    assert rows[0].total_articles_rolling_std_3d == 0 and rows[3].total_articles_rolling_median_3d == 7
    assert rows[1].total_articles_rolling_mean_3d == 6


def test_streak_through_zero_and_zero_volume(spark):
    rows = windows.trend_features(series(spark, [0, 4, 4, 2]).withColumn("avg_sentiment", F.col("total_articles") / 10.0)).orderBy("date").collect()
    assert [r.sentiment_trend for r in rows] == [0, 1, 0, -1]
    assert [r.sentiment_trend_streak for r in rows] == [1, 1, 1, 1]
    assert [r.volume_pct_change_1d for r in rows] == [0, 0, 0, -0.5]
    up = windows.trend_features(series(spark, [1, 2, 3, 4]).withColumn("avg_sentiment", F.col("total_articles") / 10.0)).orderBy("date").collect()
    assert [r.sentiment_trend_streak for r in up] == [1, 1, 2, 3]


def test_smoothing_follows_recurrence(spark):
    xs = [0.9, -0.2, 0.4, -0.9]
    df = spark.createDataFrame([(dt.date(2025, 1, i + 1), x) for i, x in enumerate(xs)], "date date, avg_sentiment double")
    got = [r.avg_sentiment for r in windows.smooth_sentiment(df).orderBy("date").collect()]
    s, want = None, []
    for x in (0.6, -0.2, 0.4, -0.6):
        s = x if s is None else 0.3 * x + 0.7 * s
        want.append(s)
    assert got == pytest.approx(want)


def test_balanced_dominant_branches(spark):
    table = [(0.5, 0.2, 0.3, "positive"), (0.2, 0.5, 0.3, "negative"), (0.2, 0.2, 0.6, "neutral"), (0.36, 0.24, 0.40, "positive"),
             (0.24, 0.36, 0.40, "negative"), (0.33, 0.31, 0.36, "neutral"), (0.4, 0.4, 0.2, "neutral")]
    df = spark.createDataFrame(table, "p double, n double, u double, want string")
    df = df.withColumn("got", dominant_balanced(F.col("p"), F.col("n"), F.col("u"), F.col("p") - F.col("n")))
    assert [r.got for r in df.collect()] == [t[3] for t in table]


def test_model_data_golden_nine_rows(spark):
    frame = features.create_all_features(daily.daily_base(articles(
        spark, [(f"t{i}", str(dt.datetime(2025, 11, 1) + dt.timedelta(hours=12 * i)), ("positive", "negative")[i % 3 == 0], 0) for i in range(60)])), is_aggregated=True)
    data = features.prepare_model_data(frame)
    assert data.count() == 9
    assert "avg_sentiment" not in data.columns and "spike_label" not in data.columns


def test_holidays(spark):
    df = spark.createDataFrame([(dt.date(2025, 12, 25),), (dt.date(2025, 1, 1),), (dt.date(2025, 3, 15),)], "date date")
    assert [r.is_holiday_hr for r in windows.calendar_features(df).collect()] == [1, 1, 0]


def test_walk_forward_blocks(spark):
    folds = features.walk_forward_folds(series(spark, range(23)), 5).groupBy("fold", "role").count().collect()
    got = {(r.fold, r.role): r["count"] for r in folds}
    assert [got[(i, "test")] for i in range(5)] == [3] * 5
    assert [got[(i, "train")] for i in range(5)] == [8, 11, 14, 17, 20]


def test_period_bounds_and_short_series(spark):
    with pytest.raises(ValueError):
        serving.trend_analysis(series(spark, [1, 2]), 1000)
    row = serving.trend_analysis(series(spark, [10, 20]), 30).first()
    assert row.volume_change_pct == 100 and row.volume_trend == "INCREASING"


def test_empty_input(spark):
    assert features.create_all_features(articles(spark, []).drop("topic")).count() == 0

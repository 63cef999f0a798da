"""Read-only answers over the daily table: trends, outlooks, paths and alerts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.labels import direction, risk_level, tier
from trendlens.operators.windows import edge_means, tail
from trendlens.relational import single_row

DAILY_OUTPUT = ("date", "total_articles", "avg_sentiment", "std_sentiment", "dominant_sentiment", "spike_label")


def _check(value: int, lo: int, hi: int, name: str) -> None:
    if not lo <= value <= hi:
        raise ValueError(f"{name} must be between {lo} and {hi}")


def _last_date(df: DataFrame, by: Sequence[str]) -> DataFrame:
    last = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(by)]).agg(F.max("date").alias("end_date"))
    cond = F.lit(True)
    for i, k in enumerate(by):
        cond = cond & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = df.join(last if by else F.broadcast(last), cond)  # one row per series
    return joined.drop(*[f"__k{i}" for i in range(len(by))])


def _pct_change(first: Column, last: Column) -> Column:
    return F.when(first > 0, (last - first) / F.nullif(first.cast("double"), F.lit(0.0)) * 100).otherwise(0.0)


def trend_analysis(daily: DataFrame, period: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Level, change and direction of class and volume over the last ``period`` days of each series."""
    _check(period, 7, 365, "period")
    recent = _last_date(daily, by).where(F.col("date") >= F.date_sub("end_date", period))
    edges = edge_means(recent, by=by)
    means = recent.groupBy(*by).agg(F.max("end_date").alias("end_date"), F.avg("avg_sentiment").alias("mean"), F.sum("total_articles").alias("articles"))
    joined = edges.join(means, list(by)) if by else edges.join(F.broadcast(means), F.lit(True))  # one row
    change = F.col("avg_sentiment_last") - F.col("avg_sentiment_first")
    volume = _pct_change(F.col("total_articles_first"), F.col("total_articles_last"))
    return joined.select(
        *by, F.lit(period).alias("period_days"), F.date_sub("end_date", period).alias("start_date"), "end_date",
        F.round("mean", 4).alias("avg_sentiment"), F.round(change, 4).alias("sentiment_change"), F.col("articles").alias("total_articles"),
        F.round(volume, 2).alias("volume_change_pct"), direction(change, 0.05, "IMPROVING", "DECLINING").alias("sentiment_trend"),
        direction(volume, 10, "INCREASING", "DECREASING").alias("volume_trend"))


def daily_aggregates(daily: DataFrame, days: int = 30, by: Sequence[str] = ()) -> DataFrame:
    _check(days, 1, 365, "days")
    rows = tail(daily, days, by)
    keep = [c for c in DAILY_OUTPUT if c in daily.columns]
    return rows.select(*by, *keep).withColumn("date", F.col("date").cast("string")).orderBy(*by, "date")


def trend_summary(daily: DataFrame, rows: int = 30, by: Sequence[str] = ()) -> DataFrame:
    """Mean class with its tier, change, volume, first-to-last-week change and spikes over the last rows."""
    recent = tail(daily, rows, by)
    edges = edge_means(recent, by=by)
    spikes = F.sum("spike_label") if "spike_label" in daily.columns else F.lit(0)
    n = F.count(F.lit(1))
    means = recent.groupBy(*by).agg(
        F.avg("avg_sentiment").alias("mean_sentiment"), F.sum("total_articles").alias("articles"), F.avg("total_articles").alias("daily_mean"),
        F.coalesce(spikes, F.lit(0)).alias("spikes"), (spikes * 100.0 / n).alias("spike_rate"))
    joined = edges.join(means, list(by)) if by else edges.join(F.broadcast(means), F.lit(True))  # one row
    m = F.col("mean_sentiment")
    return joined.select(
        *by, m, tier(m, [(0.15, "positive"), (-0.15, "neutral")], "negative", strict=True).alias("tier"),
        (F.col("avg_sentiment_last") - F.col("avg_sentiment_first")).alias("sentiment_change"), "articles", "daily_mean",
        (F.col("total_articles_last") - F.col("total_articles_first")).alias("volume_change"),
        _pct_change(F.col("total_articles_first"), F.col("total_articles_last")).alias("volume_change_pct"), "spikes", "spike_rate")


def volume_path(latest: DataFrame, horizon: int = 7, by: Sequence[str] = (), actual: str = "total_articles", predicted: str = "predicted_value") -> DataFrame:
    """Eased daily path from the last actual volume to the prediction, with a widening band.

    ``latest`` has one row per series: its last date, last actual and predicted value.
    """
    i = F.col("i")
    t = (i + 1) / F.lit(float(horizon))
    eased = t * t * (3 - 2 * t)
    days = latest.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(horizon - 1)))).withColumn("day", F.date_add("date", i + 1))
    base = F.col(actual) + (F.col(predicted) - F.col(actual)) * eased
    weekend = F.when(F.weekday("day") >= 5, 0.85).otherwise(1.0)
    valued = days.withColumn("value", F.greatest(F.lit(1.0), base * weekend + F.sin(i * 1.2) * 2))
    spread = F.lit(0.2) * (1 + 0.4 * i / F.lit(float(horizon))) * F.col("value")
    return valued.select(*by, F.col("day").alias("date"), "value", F.greatest(F.lit(0.0), F.col("value") - spread).alias("low"), (F.col("value") + spread).alias("high"))


def volume_outlook(daily: DataFrame, predictions: DataFrame, by: Sequence[str] = (), predicted: str = "predicted_value") -> DataFrame:
    """Predicted volume against the mean of the last seven rows: MORE, FEWER or STABLE beyond three articles."""
    recent = tail(daily, 7, by).groupBy(*by).agg(F.avg("total_articles").alias("recent_mean"))
    joined = recent.join(predictions, list(by)) if by else recent.join(single_row(predictions), F.lit(True))
    change = F.col(predicted) - F.col("recent_mean")
    return joined.select(*by, predicted, "recent_mean", change.alias("change"), direction(change, 3, "MORE", "FEWER").alias("outlook"))


def class_level(col: Column) -> Column:
    return F.when(col == "positive", 0.3).when(col == "negative", -0.3).otherwise(0.0)


def sentiment_series(daily: DataFrame, forecast: DataFrame | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Class of every day as a level, then the forecast path starting at the last actual day.

    ``forecast`` has (by, date, predicted_sentiment). Spike days are flagged on the historical part.
    """
    spike = F.col("spike_label") == 1 if "spike_label" in daily.columns else F.lit(False)
    past = daily.select(*by, "date", class_level(F.col("dominant_sentiment")).alias("value"), spike.alias("spike"))
    out = past.select(*by, F.lit("historical").alias("series"), "date", "value", "spike")
    if forecast is None:
        return out
    last = tail(past, 1, by)
    ahead = forecast.select(*by, "date", class_level(F.col("predicted_sentiment")).alias("value"))
    path = last.select(*by, "date", "value").unionByName(ahead)
    return out.unionByName(path.select(*by, F.lit("forecast").alias("series"), "date", "value", F.lit(False).alias("spike")))


def spike_alert(df: DataFrame, probability: str = "probability") -> DataFrame:
    """Alert text for rows whose spike risk is above MINIMAL."""
    p = F.col(probability)
    rows = df.withColumn("risk_level", risk_level(p)).where(F.col("risk_level") != "MINIMAL")
    head = F.when(F.col("risk_level") == "HIGH", "HIGH SPIKE ALERT").when(F.col("risk_level") == "MEDIUM", "MODERATE SPIKE RISK").otherwise("LOW SPIKE RISK")
    tenths = F.round(p * 1000, 0).cast("long")
    pct = F.concat((tenths / 10).cast("decimal(10,1)").cast("string"), F.lit("%"))
    return rows.withColumn("message", F.concat(head, F.lit(" - probability "), pct))


def prediction_vs_actual(predictions: DataFrame, actuals: DataFrame, days: int = 7, by: Sequence[str] = (),
                         predicted: str = "prediction", actual: str = "actual") -> DataFrame:
    """Predictions joined with what happened, last ``days`` dates of each series."""
    _check(days, 1, 30, "days")
    joined = predictions.select(*by, "date", predicted).join(actuals.select(*by, "date", actual), [*by, "date"])
    return tail(joined, days, by).withColumn("error", F.col(actual) - F.col(predicted))

"""Row-based time-series operators over daily series, one series per ``by`` key.

They run after the daily aggregate, so a window partition holds at most one row per calendar day
of its series however many articles there are. Operators that share ``by`` share one sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from trendlens.functions.calendar import FIXED_HOLIDAYS, calendar_columns

LAGS = (1, 2, 3, 7, 14)
ROLLING = (3, 7, 14, 30)
SERIES = ("avg_sentiment", "total_articles")


def series_window(by: Sequence[str] = ()) -> WindowSpec:
    return Window.partitionBy(*by).orderBy("date")


def trailing(by: Sequence[str], rows: int) -> WindowSpec:
    return series_window(by).rowsBetween(-(rows - 1), 0)


def diff(col: str, k: int, w: WindowSpec) -> Column:
    return F.col(col) - F.lag(col, k).over(w)


def lag_features(df: DataFrame, cols: Sequence[str] = SERIES, lags: Sequence[int] = LAGS, by: Sequence[str] = ()) -> DataFrame:
    w = series_window(by)
    return df.select("*", *[F.lag(c, k).over(w).alias(f"{c}_lag_{k}d") for c in cols if c in df.columns for k in lags])


def rolling_features(df: DataFrame, cols: Sequence[str] = SERIES, windows: Sequence[int] = ROLLING, by: Sequence[str] = (),
                     stats: Sequence[str] = ("mean", "std", "min", "max", "median")) -> DataFrame:
    """Trailing mean, sample deviation (0 for one row), min, max and interpolated median."""
    makers = {
        "mean": lambda c, w: F.avg(c).over(w),
        "std": lambda c, w: F.coalesce(F.stddev_samp(c).over(w), F.lit(0.0)),
        "min": lambda c, w: F.min(c).over(w),
        "max": lambda c, w: F.max(c).over(w),
        "median": lambda c, w: F.percentile(c, 0.5).over(w),
    }
    return df.select("*", *[
        makers[s](c, trailing(by, n)).alias(f"{c}_rolling_{s}_{n}d")
        for c in cols if c in df.columns for n in windows for s in stats])


def calendar_features(df: DataFrame, holidays: Sequence[str] = FIXED_HOLIDAYS, names: Sequence[str] | None = None) -> DataFrame:
    cols = calendar_columns(F.col("date"), holidays)
    return df.select("*", *[e.alias(n) for n, e in cols.items() if names is None or n in names])


def momentum(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    w = series_window(by)
    return df.select(
        "*",
        diff("avg_sentiment", 1, w).alias("sentiment_momentum_1d"), diff("avg_sentiment", 7, w).alias("sentiment_momentum_7d"),
        diff("total_articles", 1, w).alias("volume_change_1d"), diff("total_articles", 7, w).alias("volume_change_7d"))


def second_difference(col: str, w: WindowSpec) -> Column:
    one, two = F.lag(col, 1).over(w), F.lag(col, 2).over(w)
    return (F.col(col) - one) - (one - two)


def trend_sign(col: str, w: WindowSpec) -> Column:
    return F.coalesce(F.signum(diff(col, 1, w)).cast("double"), F.lit(0.0))


def pct_change(col: str, w: WindowSpec) -> Column:
    prev = F.lag(col, 1).over(w)
    return F.coalesce(F.try_divide((F.col(col) - prev).cast("double"), prev.cast("double")), F.lit(0.0))


def streak(df: DataFrame, col: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Length so far of the run of equal consecutive values."""
    w = series_window(by)
    changed = F.when(F.col(col).eqNullSafe(F.lag(col, 1).over(w)) & F.col(col).isNotNull(), 0).otherwise(1)
    runs = df.withColumn("__changed", changed).withColumn("__run", F.sum("__changed").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(*by, "__run").orderBy("date")
    return runs.withColumn(out, F.row_number().over(inside).cast("long")).drop("__changed", "__run")


def trend_features(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Momentum, acceleration, direction, streak and percentage change of both series."""
    w = series_window(by)
    out = df
    if "avg_sentiment" in df.columns:
        out = out.select(
            "*", diff("avg_sentiment", 1, w).alias("sentiment_momentum_1d"), diff("avg_sentiment", 7, w).alias("sentiment_momentum_7d"),
            second_difference("avg_sentiment", w).alias("sentiment_acceleration"),
            trend_sign("avg_sentiment", w).alias("sentiment_trend"))
    if "total_articles" in df.columns:
        out = out.select(
            "*", diff("total_articles", 1, w).alias("volume_change_1d"), diff("total_articles", 7, w).alias("volume_change_7d"),
            pct_change("total_articles", w).alias("volume_pct_change_1d"),
            second_difference("total_articles", w).alias("volume_acceleration"),
            trend_sign("total_articles", w).alias("volume_trend"))
    return streak(out, "sentiment_trend", "sentiment_trend_streak", by) if "avg_sentiment" in df.columns else out


def smooth_sentiment(df: DataFrame, alpha: float = 0.3, clip: float = 0.6, by: Sequence[str] = ()) -> DataFrame:
    """Clip to +-``clip``, then exponential smoothing s = alpha*x + (1-alpha)*s_prev, s_0 = x_0.

    Each series is folded in date order inside the JVM; a series has one entry per day.
    """
    value = F.greatest(F.lit(-clip), F.least(F.lit(clip), F.col("avg_sentiment")))
    rows = df.withColumn("avg_sentiment_raw", F.col("avg_sentiment")).withColumn("avg_sentiment", value)
    fields = [c for c in rows.columns if c not in ("date", *by)]
    series = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("date", *fields))).alias("__rows"))
    start = F.array().cast("array<double>")

    def step(acc: Column, row: Column) -> Column:
        x = row["avg_sentiment"]
        prev = F.coalesce(F.get(acc, F.size(acc) - 1), x)
        return F.concat(acc, F.array(F.lit(alpha) * x + F.lit(1 - alpha) * prev))

    folded = series.withColumn("__s", F.aggregate("__rows", start, step))
    flat = folded.select(*by, F.explode(F.arrays_zip("__rows", "__s")).alias("__z"))
    return flat.select(
        *by, "__z.__rows.date", *[F.col(f"__z.__rows.{c}").alias(c) for c in fields if c != "avg_sentiment"],
        F.col("__z.__s").alias("avg_sentiment"), F.col("__z.__s").alias("avg_sentiment_smoothed"),
        (F.abs(F.col("__z.__rows.avg_sentiment_raw")) > clip).alias("clipped"))


def strict_rolling(df: DataFrame, windows: Sequence[int] = (3, 7), by: Sequence[str] = ()) -> DataFrame:
    """Trailing means of the class shares, NULL until the window is full."""
    cols = []
    for n in windows:
        w = trailing(by, n)
        full = F.count(F.lit(1)).over(w) == n
        for c in ("positive_pct", "negative_pct", "avg_sentiment"):
            cols.append(F.when(full, F.avg(c).over(w)).alias(f"{c}_rolling_{n}d"))
        cols.append(F.when(full, F.stddev_samp("avg_sentiment").over(w)).alias(f"sentiment_volatility_{n}d"))
    return df.select("*", *cols)


def class_lags(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Lags of shares and mean, momentum, three-row trends and lags of the encoded dominant class."""
    w = series_window(by)
    code = F.when(F.col("dominant_sentiment") == "positive", 1).when(F.col("dominant_sentiment") == "neutral", 0).otherwise(-1)
    df = df.withColumn("dominant_encoded", code)
    return df.select(
        "*",
        *[F.lag(c, k).over(w).alias(f"{c}_lag_{k}d") for k in (1, 2, 3, 7)
          for c in ("positive_pct", "negative_pct", "neutral_pct", "avg_sentiment")],
        diff("avg_sentiment", 1, w).alias("sentiment_momentum"),
        diff("positive_pct", 3, w).alias("positive_trend"), diff("negative_pct", 3, w).alias("negative_trend"),
        *[F.lag("dominant_encoded", k).over(w).alias(f"dominant_lag_{k}d") for k in (1, 2, 3)])


def lead_target(df: DataFrame, target: str, horizon: int = 7, by: Sequence[str] = ()) -> DataFrame:
    return df.withColumn(f"{target}_target", F.lead(target, horizon).over(series_window(by)))


def drop_incomplete(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    return df.na.drop("any", subset=list(subset) if subset is not None else None)


def tail(df: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Last ``n`` rows of each series."""
    if not by:
        return df.orderBy(F.col("date").desc()).limit(n)
    w = Window.partitionBy(*by).orderBy(F.col("date").desc())
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def latest_row(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return tail(df, 1, by)


def edge_means(df: DataFrame, cols: Sequence[str] = SERIES, k: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Mean of the first and of the last ``k`` rows; first and last value of shorter series."""
    asc, desc = series_window(by), Window.partitionBy(*by).orderBy(F.col("date").desc())
    ranked = df.withColumn("__a", F.row_number().over(asc)).withColumn("__d", F.row_number().over(desc))
    n = F.count(F.lit(1))

    def edge(c: str, rank: str) -> Column:
        return F.when(n >= k, F.avg(F.when(F.col(rank) <= k, F.col(c)))).otherwise(F.max(F.when(F.col(rank) == 1, F.col(c))))

    aggs = [n.alias("rows")]
    for c in cols:
        aggs += [edge(c, "__a").alias(f"{c}_first"), edge(c, "__d").alias(f"{c}_last")]
    return ranked.groupBy(*by).agg(*aggs)

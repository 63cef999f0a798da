"""Queries over daily series: roll-ups, windows, calendar, spikes and feature frames."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from trendlens.functions import calendar
from trendlens.operators import daily, features, windows
from trendlens.plans.queries_copies import SPREAD_SQL, spread_table
from trendlens.plans.registry import query
from trendlens.relational import require_columns
from trendlens.sources.adapters import articles_from_events, orders_as_articles

BASE = "date:s total_articles:i avg_sentiment:d std_sentiment:d min_sentiment:d max_sentiment:d dominant_sentiment:s"


def events_daily(spark, sf):
    return daily.daily_base(articles_from_events(spark, sf))


def orders_daily(spark, sf, by=()):
    return daily.daily_base(orders_as_articles(spark, sf), by)


# --- daily roll-ups ---------------------------------------------------------------------------

query("agg1_daily_base", BASE, "SELECT * FROM dailye")(events_daily)
query("agg1_daily_base_by_source", "source:s " + BASE, "SELECT * FROM dailyes")(
    lambda spark, sf: daily.daily_base(articles_from_events(spark, sf), ["source"]))
query("agg2_dominant_sentiment", "source:s date:s dominant_sentiment:s", "SELECT source, date, dominant_sentiment FROM dailyos")(
    lambda spark, sf: daily.dominant_sentiment(orders_as_articles(spark, sf), ["source"]))

@query("agg4_required_columns", "date:s total_articles:i missing:s", "SELECT date, total_articles, 'nowhere, sentiment' AS missing FROM dailye")
def agg4(spark, sf):
    """The daily table of articles that have all columns, and what the check names for a table that lacks some."""
    articles = articles_from_events(spark, sf)
    require_columns(articles, ["publishedAt", "sentiment"])
    try:
        require_columns(articles.drop("sentiment"), ["nowhere", "publishedAt", "sentiment"])
    except ValueError as error:
        named = ", ".join(sorted(re.findall(r"'(\w+)'", str(error))))
    return daily.daily_base(articles).select("date", "total_articles", F.lit(named).alias("missing"))


TOPICS = (0, 1, 2, 3, 4)
_TOPIC_SQL = ", ".join(f"count(*) FILTER (WHERE topic = {k}) AS topic_{k}_count" for k in TOPICS)
_TOPIC_SPEC = " ".join(f"topic_{k}_count:i" for k in TOPICS)


@query("agg3_topic_pivot", f"{BASE} {_TOPIC_SPEC}",
       f"SELECT d.*, t.* EXCLUDE (date) FROM dailye d LEFT JOIN (SELECT date, {_TOPIC_SQL} FROM ev GROUP BY date) t USING (date)")
def agg3(spark, sf):
    arts = articles_from_events(spark, sf)
    return daily.add_topic_counts(daily.daily_base(arts), daily.topic_pivot(arts, daily.topic_ids(arts)))


query("agg3_topic_counts", "date:s topic:i count:i", "SELECT date, topic, count(*) AS count FROM ev WHERE topic IS NOT NULL GROUP BY date, topic")(
    lambda spark, sf: daily.topic_counts(articles_from_events(spark, sf)))

CLASS_SQL = """
cls AS (SELECT source, date, count(sentiment) AS article_count,
  count(*) FILTER (WHERE sentiment='positive') AS positive_count, count(*) FILTER (WHERE sentiment='negative') AS negative_count,
  count(*) FILTER (WHERE sentiment='neutral') AS neutral_count,
  avg(CASE sentiment WHEN 'positive' THEN 1.0 WHEN 'negative' THEN -1.0 WHEN 'neutral' THEN 0.0 END::DOUBLE) AS avg_sentiment,
  stddev_samp(CASE sentiment WHEN 'positive' THEN 1.0 WHEN 'negative' THEN -1.0 WHEN 'neutral' THEN 0.0 END::DOUBLE) AS std_sentiment
  FROM orda GROUP BY source, date),
pct AS (SELECT *, positive_count::DOUBLE / nullif(positive_count+negative_count+neutral_count,0) AS positive_pct,
  negative_count::DOUBLE / nullif(positive_count+negative_count+neutral_count,0) AS negative_pct,
  neutral_count::DOUBLE / nullif(positive_count+negative_count+neutral_count,0) AS neutral_pct FROM cls),
scr AS (SELECT *, positive_pct - negative_pct AS sentiment_score FROM pct),
dom AS (SELECT *, CASE
  WHEN positive_pct = greatest(positive_pct,neutral_pct,negative_pct) AND sentiment_score > 0.05 THEN 'positive'
  WHEN negative_pct = greatest(positive_pct,neutral_pct,negative_pct) AND sentiment_score < -0.05 THEN 'negative'
  WHEN neutral_pct = greatest(positive_pct,neutral_pct,negative_pct) AND neutral_pct > positive_pct + 0.10::DOUBLE
       AND neutral_pct > negative_pct + 0.10::DOUBLE THEN 'neutral'
  WHEN sentiment_score > 0.08 THEN 'positive' WHEN sentiment_score < -0.08 THEN 'negative' ELSE 'neutral' END AS dominant_sentiment
  FROM scr)"""
_CLS = "source:s date:s article_count:i positive_count:i negative_count:i neutral_count:i avg_sentiment:d std_sentiment:d"


def class_days(spark, sf):
    return daily.daily_class_counts(orders_as_articles(spark, sf), ["source"])


def class_dominant(spark, sf):
    return daily.with_dominant_class(daily.class_shares(class_days(spark, sf)))


query("agg5_daily_class_counts", _CLS, f"WITH {CLASS_SQL}\nRESULT SELECT * FROM cls")(class_days)
query("agg6_class_pct_score", "source:s date:s positive_pct:d negative_pct:d neutral_pct:d sentiment_score:d",
      f"WITH {CLASS_SQL}\nRESULT SELECT * FROM scr")(lambda spark, sf: daily.class_shares(class_days(spark, sf)))
query("agg7_dominant_balanced", "source:s date:s dominant_sentiment:s", f"WITH {CLASS_SQL}\nRESULT SELECT * FROM dom")(class_dominant)
query("agg8_daily_aggregates_table", f"{BASE} spike_label:i {_TOPIC_SPEC}", f"""
WITH z AS (SELECT *, avg_sentiment - lag(avg_sentiment) OVER (ORDER BY date) AS m FROM dailye)
RESULT SELECT z.*, t.* EXCLUDE (date),
  CASE WHEN total_articles > (SELECT avg(total_articles) + 1.5 * stddev_samp(total_articles) FROM dailye)
         OR coalesce(abs(m) > 0.4, false) THEN 1 ELSE 0 END AS spike_label
FROM z LEFT JOIN (SELECT date, {_TOPIC_SQL} FROM ev GROUP BY date) t USING (date)""")(
    lambda spark, sf: features.daily_aggregates_table(articles_from_events(spark, sf), topics=TOPICS))
query("agg9_sentiment_over_time", "date:s sentiment:s count:i", "SELECT date, sentiment, count(*) AS count FROM ev GROUP BY ALL")(
    lambda spark, sf: daily.sentiment_over_time(articles_from_events(spark, sf)))
query("agg10_class_distribution", "dominant_sentiment:s days:i share:d", f"""
WITH {CLASS_SQL}
RESULT SELECT dominant_sentiment, count(*) AS days, count(*)::DOUBLE / (SELECT count(*) FROM dom) AS share FROM dom GROUP BY 1""")(
    lambda spark, sf: daily.class_distribution(class_dominant(spark, sf)))


# --- windows ----------------------------------------------------------------------------------

_KEY = "source:s date:s "
WS = "OVER (PARTITION BY source ORDER BY date)"
SER = ("avg_sentiment", "total_articles")


def keyed(spark, sf):
    return orders_daily(spark, sf, ["source"])


def frame(n):
    return f"OVER (PARTITION BY source ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


LAG_COLS = [f"{c}_lag_{k}d" for c in SER for k in windows.LAGS]
LAG_SQL = ", ".join(f"lag({c}, {k}) {WS} AS {c}_lag_{k}d" for c in SER for k in windows.LAGS)
query("win1_lag_features", _KEY + " ".join(f"{c}:d" for c in LAG_COLS), f"SELECT source, date, {LAG_SQL} FROM dailyos")(
    lambda spark, sf: windows.lag_features(keyed(spark, sf), by=["source"]))

_STAT = {
    "mean": lambda c, n: f"avg({c}) {frame(n)}",
    "std": lambda c, n: f"coalesce(stddev_samp({c}) {frame(n)}, 0)",
    "min": lambda c, n: f"min({c}) {frame(n)}",
    "max": lambda c, n: f"max({c}) {frame(n)}",
    "median": lambda c, n: f"quantile_cont({c}, 0.5) {frame(n)}",
}


def roll_sql(stats):
    return ", ".join(f"{_STAT[s](c, n)} AS {c}_rolling_{s}_{n}d" for c in SER for n in windows.ROLLING for s in stats)


def roll_spec(stats):
    return " ".join(f"{c}_rolling_{s}_{n}d:d" for c in SER for n in windows.ROLLING for s in stats)


for _i, _s in enumerate(_STAT):
    query(f"win{_i + 2}_rolling_{_s}", _KEY + roll_spec([_s]), f"SELECT source, date, {roll_sql([_s])} FROM dailyos")(
        lambda spark, sf, s=_s: windows.rolling_features(keyed(spark, sf), by=["source"], stats=[s]))

MOM_SQL = f"""avg_sentiment - lag(avg_sentiment, 1) {WS} AS sentiment_momentum_1d,
  avg_sentiment - lag(avg_sentiment, 7) {WS} AS sentiment_momentum_7d,
  total_articles - lag(total_articles, 1) {WS} AS volume_change_1d, total_articles - lag(total_articles, 7) {WS} AS volume_change_7d"""
MOM_SPEC = "sentiment_momentum_1d:d sentiment_momentum_7d:d volume_change_1d:d volume_change_7d:d"
query("win7_momentum", _KEY + MOM_SPEC, f"SELECT source, date, {MOM_SQL} FROM dailyos")(
    lambda spark, sf: windows.momentum(keyed(spark, sf), ["source"]))

MOM_CTE = f"WITH mom AS (SELECT *, {MOM_SQL} FROM dailyos)"
TREND_CTE = f"""{MOM_CTE}, tr AS (SELECT *,
  sentiment_momentum_1d - lag(sentiment_momentum_1d) {WS} AS sentiment_acceleration,
  volume_change_1d - lag(volume_change_1d) {WS} AS volume_acceleration,
  coalesce(sign(sentiment_momentum_1d), 0) AS sentiment_trend, coalesce(sign(volume_change_1d), 0) AS volume_trend,
  coalesce((total_articles - lag(total_articles) {WS})::DOUBLE / nullif(lag(total_articles) {WS}, 0), 0) AS volume_pct_change_1d
  FROM mom),
ch AS (SELECT *, CASE WHEN sentiment_trend = lag(sentiment_trend) {WS} THEN 0 ELSE 1 END AS c FROM tr),
isl AS (SELECT *, sum(c) OVER (PARTITION BY source ORDER BY date ROWS UNBOUNDED PRECEDING) AS g FROM ch),
trend AS (SELECT * EXCLUDE (c, g), row_number() OVER (PARTITION BY source, g ORDER BY date) AS sentiment_trend_streak FROM isl)"""


def trends(spark, sf):
    return windows.trend_features(keyed(spark, sf), ["source"])


for _n, _spec in {
    "win8_acceleration": "sentiment_acceleration:d volume_acceleration:d",
    "win9_trend_sign": "sentiment_trend:i volume_trend:i",
    "win10_trend_streak": "sentiment_trend_streak:i",
    "win11_pct_change": "volume_pct_change_1d:d",
}.items():
    query(_n, _KEY + _spec, f"{TREND_CTE}\nRESULT SELECT * FROM trend")(trends)

query("win12_smooth_sentiment", _KEY + "avg_sentiment_raw:d avg_sentiment:d clipped:b", """
WITH o AS (SELECT source, date, avg_sentiment AS raw, greatest(-0.6, least(0.6, avg_sentiment)) AS x,
           row_number() OVER (PARTITION BY source ORDER BY date) AS rn FROM dailyos),
s AS (SELECT source, rn, x AS v FROM o WHERE rn = 1
      UNION ALL SELECT o.source, o.rn, 0.3::DOUBLE * o.x + 0.7::DOUBLE * s.v FROM s JOIN o ON o.source = s.source AND o.rn = s.rn + 1)
RESULT SELECT o.source, o.date, raw AS avg_sentiment_raw, s.v AS avg_sentiment, abs(raw) > 0.6 AS clipped
FROM o JOIN s ON o.source = s.source AND o.rn = s.rn""")(
    lambda spark, sf: windows.smooth_sentiment(keyed(spark, sf), by=["source"]))

STRICT_SQL = ", ".join(
    [f"CASE WHEN count(*) {frame(n)} = {n} THEN avg({c}) {frame(n)} END AS {c}_rolling_{n}d"
     for n in (3, 7) for c in ("positive_pct", "negative_pct", "avg_sentiment")]
    + [f"CASE WHEN count(*) {frame(n)} = {n} THEN stddev_samp(avg_sentiment) {frame(n)} END AS sentiment_volatility_{n}d" for n in (3, 7)])
STRICT_SPEC = " ".join([f"{c}_rolling_{n}d:d" for n in (3, 7) for c in ("positive_pct", "negative_pct", "avg_sentiment")]
                       + ["sentiment_volatility_3d:d", "sentiment_volatility_7d:d"])
CLAG_SQL = ", ".join(
    [f"lag({c}, {k}) {WS} AS {c}_lag_{k}d" for k in (1, 2, 3, 7) for c in ("positive_pct", "negative_pct", "neutral_pct", "avg_sentiment")]
    + [f"avg_sentiment - lag(avg_sentiment) {WS} AS sentiment_momentum",
       f"positive_pct - lag(positive_pct, 3) {WS} AS positive_trend", f"negative_pct - lag(negative_pct, 3) {WS} AS negative_trend"]
    + [f"lag(CASE dominant_sentiment WHEN 'positive' THEN 1 WHEN 'neutral' THEN 0 ELSE -1 END, {k}) {WS} AS dominant_lag_{k}d" for k in (1, 2, 3)])
CLAG_SPEC = " ".join(
    [f"{c}_lag_{k}d:d" for k in (1, 2, 3, 7) for c in ("positive_pct", "negative_pct", "neutral_pct", "avg_sentiment")]
    + ["sentiment_momentum:d", "positive_trend:d", "negative_trend:d"] + [f"dominant_lag_{k}d:d" for k in (1, 2, 3)])
query("win13_strict_rolling", _KEY + STRICT_SPEC, f"WITH {CLASS_SQL}\nRESULT SELECT *, {STRICT_SQL} FROM dom")(
    lambda spark, sf: windows.strict_rolling(class_dominant(spark, sf), by=["source"]))
query("win14_class_lags", _KEY + CLAG_SPEC, f"WITH {CLASS_SQL}\nRESULT SELECT *, {CLAG_SQL} FROM dom")(
    lambda spark, sf: windows.class_lags(class_dominant(spark, sf), ["source"]))
query("win15_lead_target", _KEY + "avg_sentiment_target:d", f"SELECT source, date, lead(avg_sentiment, 7) {WS} AS avg_sentiment_target FROM dailyos")(
    lambda spark, sf: windows.lead_target(keyed(spark, sf), "avg_sentiment", 7, ["source"]))
query("win16_drop_incomplete", _KEY + "lag14:d std_sentiment:d", f"""
WITH {CLASS_SQL}, l AS (SELECT source, date, lag(avg_sentiment, 14) {WS} AS lag14, std_sentiment FROM cls)
RESULT SELECT * FROM l WHERE lag14 IS NOT NULL AND std_sentiment IS NOT NULL""")(
    lambda spark, sf: windows.drop_incomplete(class_days(spark, sf).select(
        "source", "date", F.lag("avg_sentiment", 14).over(windows.series_window(["source"])).alias("lag14"), "std_sentiment")))
query("win17_tail", _KEY + "total_articles:i avg_sentiment:d", f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM dailyos) WHERE rn <= 10""")(
    lambda spark, sf: windows.tail(keyed(spark, sf), 10, ["source"]))
query("win18_edge_means", "source:s rows:i avg_sentiment_first:d avg_sentiment_last:d total_articles_first:d total_articles_last:d", """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date) AS a,
           row_number() OVER (PARTITION BY source ORDER BY date DESC) AS d FROM dailyes)
RESULT SELECT source, count(*) AS rows,
  CASE WHEN count(*) >= 7 THEN avg(avg_sentiment) FILTER (WHERE a <= 7) ELSE max(avg_sentiment) FILTER (WHERE a = 1) END AS avg_sentiment_first,
  CASE WHEN count(*) >= 7 THEN avg(avg_sentiment) FILTER (WHERE d <= 7) ELSE max(avg_sentiment) FILTER (WHERE d = 1) END AS avg_sentiment_last,
  CASE WHEN count(*) >= 7 THEN avg(total_articles) FILTER (WHERE a <= 7) ELSE max(total_articles) FILTER (WHERE a = 1) END AS total_articles_first,
  CASE WHEN count(*) >= 7 THEN avg(total_articles) FILTER (WHERE d <= 7) ELSE max(total_articles) FILTER (WHERE d = 1) END AS total_articles_last
FROM r GROUP BY source""")(
    lambda spark, sf: windows.edge_means(daily.daily_base(articles_from_events(spark, sf), ["source"]), by=["source"]))


# --- calendar ---------------------------------------------------------------------------------

_HOL = ", ".join(f"'{d}'" for d in calendar.FIXED_HOLIDAYS)
CAL = {
    "day_of_week": "isodow(date) - 1",
    "is_weekend": "CASE WHEN isodow(date) >= 6 THEN 1 ELSE 0 END",
    "day_of_month": "day(date)",
    "week_of_year": "weekofyear(date)",
    "month": "month(date)",
    "quarter": "quarter(date)",
    "is_month_start": "CASE WHEN day(date) = 1 THEN 1 ELSE 0 END",
    "is_month_end": "CASE WHEN date = last_day(date) THEN 1 ELSE 0 END",
    "is_holiday_hr": f"CASE WHEN strftime(date, '%m-%d') IN ({_HOL}) THEN 1 ELSE 0 END",
    "days_since_weekend": "CASE WHEN isodow(date) <= 5 THEN isodow(date) - 1 ELSE 0 END",
    "days_until_weekend": "CASE WHEN isodow(date) <= 5 THEN 6 - isodow(date) ELSE 0 END",
}
for _i, (_n, _e) in enumerate(CAL.items()):
    query(f"cal{_i + 1}_{_n}", f"date:s {_n}:i", f"SELECT date, {_e} AS {_n} FROM dailyo")(
        lambda spark, sf, n=_n: windows.calendar_features(
            daily.with_date(orders_as_articles(spark, sf)).select("date").distinct(), names=(n,)))


# --- spikes and feature frames ----------------------------------------------------------------

SPIKE_COLS = f"""CASE WHEN total_articles > avg(total_articles) OVER (PARTITION BY source)
       + 1.5 * stddev_samp(total_articles) OVER (PARTITION BY source) THEN 1 ELSE 0 END AS volume_spike,
  CASE WHEN abs(sentiment_momentum_1d) > 0.4 THEN 1 ELSE 0 END AS sentiment_spike"""
SPIKE_CTE = f"{MOM_CTE}, sp AS (SELECT *, {SPIKE_COLS} FROM mom), spk AS (SELECT *, greatest(volume_spike, sentiment_spike) AS spike_label FROM sp)"


def spikes(spark, sf):
    return features.spike_labels(keyed(spark, sf), by=["source"])


for _n, _c in {"spk1_volume_spike": "volume_spike", "spk2_sentiment_spike": "sentiment_spike", "spk3_spike_label": "spike_label"}.items():
    query(_n, f"{_KEY}{_c}:i", f"{SPIKE_CTE}\nRESULT SELECT * FROM spk")(spikes)
query("spk4_spike_rate", "source:s days:i spikes:i spike_pct:d", f"""{SPIKE_CTE}
RESULT SELECT source, count(*) AS days, sum(spike_label) AS spikes, sum(spike_label) * 100.0 / count(*) AS spike_pct FROM spk GROUP BY source""")(
    lambda spark, sf: features.spike_rate(spikes(spark, sf), ["source"]))

CAL_SQL = ", ".join(f"{e} AS {n}" for n, e in CAL.items())
ALL_CTE = f"""{TREND_CTE}, allf AS (SELECT *, {LAG_SQL}, {roll_sql(_STAT)}, {CAL_SQL}, {SPIKE_COLS} FROM trend),
fea AS (SELECT *, greatest(volume_spike, sentiment_spike) AS spike_label FROM allf)"""
TREND_SPEC = (MOM_SPEC + " sentiment_acceleration:d sentiment_trend:i sentiment_trend_streak:i volume_pct_change_1d:d "
              "volume_acceleration:d volume_trend:i")
ALL_SPEC = " ".join([BASE, " ".join(f"{c}:d" for c in LAG_COLS), roll_spec(_STAT), " ".join(f"{n}:i" for n in CAL), TREND_SPEC,
                     "volume_spike:i sentiment_spike:i spike_label:i"])


def all_features(spark, sf):
    return features.create_all_features(orders_as_articles(spark, sf), by=["source"])


query("fea1_create_all_features", f"source:s {ALL_SPEC}", f"{ALL_CTE}\nRESULT SELECT * FROM fea")(all_features)


def _single(cte):
    """The same SQL for one global series: a constant key in place of the source."""
    return cte.replace("FROM dailyos)", "FROM (SELECT 'all' AS source, * FROM dailyo))")


query("fea1_create_all_features_global", ALL_SPEC, f"{_single(ALL_CTE)}\nRESULT SELECT * FROM fea")(
    lambda spark, sf: features.create_all_features(orders_as_articles(spark, sf)))

@query("fea2_feature_groups", "feature_group:s columns:i rows:i", """
WITH g AS (SELECT * FROM (VALUES ('base_features', 3), ('lag_features', 10), ('rolling_features', 40), ('calendar_features', 11), ('trend_features', 10), ('target_features', 3)) AS v(feature_group, columns))
RESULT SELECT feature_group, columns, (SELECT count(*) FROM dailyos) AS rows FROM g""")
def fea2(spark, sf):
    base = orders_daily(spark, sf, ["source"])
    sizes = {g: len(c) for g, c in features.feature_groups(base, ["source"]).items()}
    pairs = F.array(*[F.struct(F.lit(g).alias("feature_group"), F.lit(n).alias("columns")) for g, n in sizes.items()])
    return base.agg(F.count(F.lit(1)).alias("rows")).select("rows", F.explode(pairs).alias("g")).select("g.*", "rows")


query("agg11_originals_only", "date:s originals:i", f"""
WITH {SPREAD_SQL}\nRESULT SELECT CAST("publishedAt" AS DATE) AS date, count(*) AS originals FROM spr WHERE is_original AND "publishedAt" IS NOT NULL GROUP BY 1""")(
    lambda spark, sf: daily.with_date(daily.originals_only(spread_table(spark, sf))).groupBy("date").agg(F.count(F.lit(1)).alias("originals")))


MODEL_FEATURES = [c for c in (s.rsplit(":", 1)[0] for s in ALL_SPEC.split())
                  if c not in ("date", "avg_sentiment", "dominant_sentiment", "spike_label", "volume_spike", "sentiment_spike")]
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in MODEL_FEATURES)
query("fea3_prepare_model_data", "source:s date:s total_articles:i avg_sentiment_lag_14d:d sentiment_momentum_7d:d avg_sentiment_target:d",
      f"""{ALL_CTE}, led AS (SELECT *, lead(avg_sentiment, 7) {WS} AS avg_sentiment_target FROM fea)
RESULT SELECT * FROM led WHERE avg_sentiment_target IS NOT NULL AND {_NOT_NULL}""")(
    lambda spark, sf: features.prepare_model_data(all_features(spark, sf), by=["source"]))
query("fea4_trainer_matrix", "source:s date:s avg_sentiment:d total_articles:i label:d is_train:b",
      f"""{ALL_CTE}, led AS (SELECT *, lead(avg_sentiment, 7) {WS} AS label FROM fea),
ok AS (SELECT * FROM led WHERE label IS NOT NULL AND {_NOT_NULL})
RESULT SELECT *, row_number() {WS} <= floor(count(*) OVER (PARTITION BY source) * 0.8::DOUBLE) AS is_train FROM ok""")(
    lambda spark, sf: features.trainer_matrix(all_features(spark, sf), by=["source"]))
FEA5_SPEC = f"{_CLS} positive_pct:d negative_pct:d neutral_pct:d sentiment_score:d dominant_sentiment:s day_of_week:i is_weekend:i day_of_month:i week_of_year:i {STRICT_SPEC} {CLAG_SPEC}"
_FEA5_NAMES = [s.rsplit(":", 1)[0] for s in FEA5_SPEC.split()]
query("fea5_classifier_features", FEA5_SPEC, f"""WITH {CLASS_SQL},
cf AS (SELECT *, {CAL['day_of_week']} AS day_of_week, {CAL['is_weekend']} AS is_weekend, day(date) AS day_of_month,
  weekofyear(date) AS week_of_year, {STRICT_SQL}, {CLAG_SQL} FROM dom)
RESULT SELECT * FROM cf WHERE {' AND '.join(n + ' IS NOT NULL' for n in _FEA5_NAMES)}""")(
    lambda spark, sf: features.classifier_features(orders_as_articles(spark, sf), ["source"]))
query("ml13_time_split", "source:s date:s is_train:b",
      f"SELECT source, date, row_number() {WS} <= floor(count(*) OVER (PARTITION BY source) * 0.8::DOUBLE) AS is_train FROM dailyos")(
    lambda spark, sf: features.time_split(keyed(spark, sf), 0.8, ["source"]))
query("ml14_walk_forward_folds", "source:s date:s fold:i role:s", f"""
WITH n AS (SELECT source, date, row_number() {WS} - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM dailyos),
f AS (SELECT *, n // 6 AS blk FROM n, (SELECT unnest([0,1,2,3,4]) AS fold))
RESULT SELECT source, date, fold, CASE WHEN pos < n - (5 - fold) * blk THEN 'train' ELSE 'test' END AS role
FROM f WHERE pos < n - (5 - fold) * blk + blk""")(
    lambda spark, sf: features.walk_forward_folds(keyed(spark, sf), 5, ["source"]))

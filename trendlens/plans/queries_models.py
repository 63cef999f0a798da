"""Queries over models, serving answers, sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from trendlens.functions.labels import risk_level
from trendlens.functions.text import PAYWALL_MARKER, WHITESPACE
from trendlens.operators import daily, features, forecasting, neighbours, serving, windows
from trendlens.operators.sentiment import score_with_lexicon
from trendlens.plans import batch_job
from trendlens.plans.queries_copies import pairs_sql
from trendlens.plans.queries_series import _NOT_NULL, ALL_CTE, CLASS_SQL, SPIKE_CTE, WS, events_daily, orders_daily
from trendlens.plans.queries_reports import lexicon_sql
from trendlens.plans.queries_text import CLEAN_SQL, feed
from trendlens.plans.registry import query, stage
from trendlens.session import scratch_path
from trendlens.sources import keyed, readers, writers
from trendlens.sources.adapters import articles_from_documents, document_articles, orders_as_articles, table
from trendlens.streaming import copy_index, jobs

BY = ["source"]


def frame(spark, sf):
    return stage("frame", spark, sf, lambda s, f: forecasting.daily_frame(orders_as_articles(s, f), BY))


def spiked(spark, sf):
    return features.spike_labels(orders_daily(spark, sf, BY), by=BY)


# --- scaling, weights, encoding ---------------------------------------------------------------

SCALED = ("total_articles", "avg_sentiment", "std_sentiment")
_Q = " UNION ALL ".join(
    f"SELECT '{c}' AS name, quantile_cont({c}::DOUBLE, 0.5) AS center, quantile_cont({c}::DOUBLE, 0.75) - quantile_cont({c}::DOUBLE, 0.25) AS scale FROM dailyos" for c in SCALED)
_S = " UNION ALL ".join(f"SELECT '{c}' AS name, avg({c}::DOUBLE) AS center, stddev_pop({c}::DOUBLE) AS scale FROM dailyos" for c in SCALED)
query("ml1_standard_scaler", "name:s center:d scale:d", f"SELECT name, center, CASE WHEN scale = 0 THEN 1 ELSE scale END AS scale FROM ({_S})")(
    lambda spark, sf: forecasting.scaler_parameters(orders_daily(spark, sf, BY), SCALED))
query("ml2_robust_scaler", "name:s center:d scale:d", f"SELECT name, center, CASE WHEN scale = 0 THEN 1 ELSE scale END AS scale FROM ({_Q})")(
    lambda spark, sf: forecasting.scaler_parameters(orders_daily(spark, sf, BY), SCALED, "robust"))
query("ml11_balanced_weights", "source:s date:s dominant_sentiment:s weight:d", """
WITH n AS (SELECT dominant_sentiment AS d, count(*) AS c FROM dailyos GROUP BY 1)
RESULT SELECT source, date, dominant_sentiment, (SELECT count(*) FROM dailyos)::DOUBLE / ((SELECT count(*) FROM n) * c) AS weight FROM dailyos JOIN n ON d = dominant_sentiment""")(
    lambda spark, sf: forecasting.balanced_weights(orders_daily(spark, sf, BY), "dominant_sentiment"))


@query("ml12_label_encode", "source:s date:s dominant_sentiment:s code:i", """
SELECT source, date, dominant_sentiment, (SELECT count(*) FROM (SELECT DISTINCT dominant_sentiment AS d FROM dailyos) WHERE d < dominant_sentiment) AS code FROM dailyos""")
def ml12(spark, sf):
    from pyspark.ml.feature import StringIndexer
    rows = orders_daily(spark, sf, BY)
    return StringIndexer(inputCol="dominant_sentiment", outputCol="code", stringOrderType="alphabetAsc").fit(rows).transform(rows)


query("ml20_align_features", "source:s date:s total_articles:d lag:d never_seen:d", """
SELECT source, date, total_articles, coalesce(lag(avg_sentiment, 14) OVER (PARTITION BY source ORDER BY date), 0) AS lag, 0 AS never_seen FROM dailyos""")(
    lambda spark, sf: forecasting.align_features(
        orders_daily(spark, sf, BY).withColumn("lag", F.lag("avg_sentiment", 14).over(windows.series_window(BY))),
        ["total_articles", "lag", "never_seen"], ["source", "date"]))


@query("ml9_smote", "label:i rows:i", f"""
{SPIKE_CTE}, c AS (SELECT source, count(*) FILTER (WHERE spike_label = 1) AS o, count(*) FILTER (WHERE spike_label = 0) AS z FROM spk GROUP BY source),
t AS (SELECT CASE WHEN o <= z AND o >= 2 THEN z ELSE o END AS ones, CASE WHEN z < o AND z >= 2 THEN o ELSE z END AS zeros FROM c)
RESULT SELECT 1 AS label, sum(ones) AS rows FROM t UNION ALL SELECT 0, sum(zeros) FROM t""")
def ml9(spark, sf):
    return forecasting.smote(smote_days(spark, sf), ["total_articles", "avg_sentiment"], by=BY).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))


def smote_days(spark, sf):
    return spiked(spark, sf).select("source", "date", F.col("spike_label").alias("label"), "total_articles", "avg_sentiment")


@query("ml9_smote_neighbours", "source:s day:s rank:i distance:d", f"""
{SPIKE_CTE}, m AS (SELECT source, date, total_articles::DOUBLE AS x, avg_sentiment::DOUBLE AS y FROM spk WHERE spike_label = 1),
d AS (SELECT a.source, a.date AS day, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 9) AS distance FROM m a JOIN m b ON a.source = b.source AND a.date <> b.date)
RESULT SELECT * FROM (SELECT source, day, row_number() OVER (PARTITION BY source, day ORDER BY distance) AS rank, distance FROM d) WHERE rank <= 5""")
def ml9_neighbours(spark, sf):
    """The neighbours that synthetic days are drawn between: the five nearest spike days of a series."""
    rows = smote_days(spark, sf).where("label = 1").select("source", "date", F.xxhash64("date", "source").alias("id"), F.array(F.col("total_articles").cast("double"), F.col("avg_sentiment").cast("double")).alias("v"))
    near = neighbours.nearest_in_groups(rows, 5, BY)
    return near.join(rows, "id").select("source", F.col("date").alias("day"), "rank", "distance")


# --- models -----------------------------------------------------------------------------------

def matrix(spark, sf):
    return stage("matrix", spark, sf, lambda s, f: features.trainer_matrix(frame(s, f), "avg_sentiment", by=BY))


def names_of(rows):
    return [c for c in rows.columns if c not in ("source", "date", "label", "is_train")]


def fitted(spark, sf, kinds, target="avg_sentiment"):
    """(model, matrix) of one session: queries that look at the same model share its fit."""
    rows = matrix(spark, sf) if target == "avg_sentiment" else stage(f"matrix-{target}", spark, sf, lambda s, f: features.trainer_matrix(frame(s, f), target, by=BY))
    key = (spark.sparkContext.applicationId, sf, target, tuple(kinds))
    if key not in _TRAINED:
        make = forecasting.sentiment_forecaster if target == "avg_sentiment" else forecasting.volume_forecaster
        _TRAINED[key] = make().fit(rows.where("is_train"), names_of(rows), kinds)
    return _TRAINED[key], rows


_TRAINED: dict = {}

TEST_DAYS_SQL = f"""{ALL_CTE}, led AS (SELECT *, lead(avg_sentiment, 7) {WS} AS label FROM fea),
ok AS (SELECT * FROM led WHERE label IS NOT NULL AND {_NOT_NULL}),
td AS (SELECT source, date FROM (SELECT source, date, row_number() {WS} > floor(count(*) OVER (PARTITION BY source) * 0.8::DOUBLE) AS is_test FROM ok) WHERE is_test)"""


def sane(prediction, low=None, high=None):
    """A number, and inside the bounds where there are some."""
    ok = prediction.isNotNull() & ~F.isnan(prediction)
    return ok if low is None else ok & prediction.between(low, high)


@query("ml5_predicted_days", "source:s date:s linear_in_range:b boosted_in_range:b", f"""
{TEST_DAYS_SQL}
RESULT SELECT source, date, true AS linear_in_range, true AS boosted_in_range FROM td""")
def ml5_days(spark, sf):
    """ML-3, ML-4 and ML-5 on every held-out day: a mean class is between -1 and 1, a forecast of it at most a little outside."""
    model, rows = fitted(spark, sf, ["linear", "boosted"])
    out = model.predict_both(rows.where("NOT is_train"), ["source", "date"])
    return out.select("source", "date", sane(F.col("linear_prediction"), -1.5, 1.5).alias("linear_in_range"), sane(F.col("boosted_prediction"), -1.5, 1.5).alias("boosted_in_range"))


@query("ml7_volume_days", "source:s date:s linear_in_range:b boosted_in_range:b", f"""
{TEST_DAYS_SQL}
RESULT SELECT source, date, true AS linear_in_range, true AS boosted_in_range FROM td""")
def ml7_days(spark, sf):
    """ML-7 with both kinds: forecasts of the number of articles stay near the numbers that were seen."""
    model, rows = fitted(spark, sf, ["linear", "boosted"], "total_articles")
    most = rows.where("is_train").agg((F.max("label") * 2).alias("most"))
    out = model.predict_both(rows.where("NOT is_train"), ["source", "date"]).join(F.broadcast(most), F.lit(True))  # one row
    ok = lambda c: sane(F.col(c)) & (F.abs(c) <= F.col("most"))
    return out.select("source", "date", ok("linear_prediction").alias("linear_in_range"), ok("boosted_prediction").alias("boosted_in_range"))


@query("ml3_no_worse_than_mean", "target:s model:s no_worse:b", """
SELECT * FROM (VALUES ('avg_sentiment', 'linear', true), ('avg_sentiment', 'boosted', true), ('total_articles', 'linear', true), ('total_articles', 'boosted', true)) AS t(target, model, no_worse)""")
def ml3_mean(spark, sf):
    """Mean absolute errors on held-out days against the mean of the training days, with a tenth to spare for noise."""
    out = None
    for target in ("avg_sentiment", "total_articles"):
        model, rows = fitted(spark, sf, ["linear", "boosted"], target)
        mean = rows.where("is_train").agg(F.avg("label").alias("mean"))
        both = model.predict_both(rows.where("NOT is_train"), ["label"]).join(F.broadcast(mean), F.lit(True))  # one row
        error = lambda c: F.avg(F.abs(F.col("label") - F.col(c)))
        for kind in ("linear", "boosted"):
            one = both.agg((error(f"{kind}_prediction") <= 1.1 * error("mean")).alias("no_worse")).select(F.lit(target).alias("target"), F.lit(kind).alias("model"), "no_worse")
            out = one if out is None else out.unionByName(one)
    return out


@query("ml8_spike_days", "source:s date:s probable:b risk_fits:b", f"""
{TEST_DAYS_SQL}
RESULT SELECT source, date, true AS probable, true AS risk_fits FROM td""")
def ml8_days(spark, sf):
    rows = stage("spike_rows", spark, sf, spike_rows)
    key = (spark.sparkContext.applicationId, sf, "spike")
    if key not in _TRAINED:
        _TRAINED[key] = forecasting.SpikeDetector().fit(rows.where("is_train"), names_of(rows), BY)
    p = F.col("probability")
    risk = F.when(p >= 0.8, "HIGH").when(p >= 0.5, "MEDIUM").when(p >= 0.3, "LOW").otherwise("MINIMAL")
    return _TRAINED[key].predict(rows.where("NOT is_train"), ["source", "date"]).select("source", "date", sane(p, 0.0, 1.0).alias("probable"), ((F.col("risk_level") == risk) & (F.col("prediction") == (p >= 0.5).cast("int"))).alias("risk_fits"))


@query("ml16_importance_checks", "features:i in_order:b shares:b", "SELECT 15 AS features, true AS in_order, true AS shares")
def ml16_checks(spark, sf):
    model, _ = fitted(spark, sf, ["linear", "boosted"])
    whole = model.importance(spark, "boosted").agg(F.abs(F.sum("importance") - 1) < 1e-6)
    top = model.importance(spark, "boosted", 15).agg(F.count("*").alias("features"), F.collect_list("importance").alias("v"))  # 15 values
    return top.select("features", (F.col("v") == F.sort_array("v", False)).alias("in_order")).join(whole.toDF("shares"), F.lit(True))


@query("ml17_forecast_days", "source:s date:s known_class:b sums_to_one:b", f"""
WITH {CLASS_SQL}, l AS (SELECT source, max(date) AS last FROM dom GROUP BY source)
RESULT SELECT source, last + CAST(i AS INTEGER) AS date, true AS known_class, true AS sums_to_one FROM l, range(1, 8) AS t(i)""")
def ml17_days(spark, sf):
    """ML-17 and ML-23: seven days for every series, a known class each, probabilities that sum to one."""
    _, ahead = forecasting.train_class_model(orders_as_articles(spark, sf), BY)
    total = F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda s, p: s + p)
    return ahead.select("source", "date", F.col("predicted_sentiment").isin("negative", "neutral", "positive").alias("known_class"), ((F.abs(total - 1) < 1e-6) & F.col("confidence").between(1 / 3 - 1e-6, 1.0)).alias("sums_to_one"))


@query("ml19_latest_checks", "source:s forecast_horizon:i numbers:b probable:b", "SELECT DISTINCT source, 7 AS forecast_horizon, true AS numbers, true AS probable FROM dailyos")
def ml19_checks(spark, sf):
    """ML-6, ML-18, ML-19, SRV-3 and SRV-4: one answer for every series from models that were trained, saved and read back."""
    path = scratch_path(spark, "trained")
    build_trained(spark, sf).save(spark, path)
    trained = forecasting.Trained.load(spark, path)
    week = forecasting.weekly_prediction(trained, frame(spark, sf), BY)
    spike = forecasting.spike_probability(trained, frame(spark, sf), BY)
    numbers = sane(F.col("sentiment.predicted_value"), -1.5, 1.5) & sane(F.col("volume.predicted_value")) & F.col("sentiment.confidence").between(0, 1) & F.col("volume.confidence").between(0, 1)
    return week.join(spike, "source").select("source", F.col("sentiment.forecast_horizon").alias("forecast_horizon"), numbers.alias("numbers"), sane(F.col("probability"), 0.0, 1.0).alias("probable"))


@query("ml14_fold_checks", "n_splits:i errors:b", "SELECT 5 AS n_splits, true AS errors")
def ml14_checks(spark, sf):
    out = ml14(spark, sf)
    return out.select("n_splits", ((F.col("mean_score") > 0) & (F.col("mean_score") < 1) & (F.col("std_score") >= 0)).alias("errors"))


_PRED = "source:s date:s prediction:d"


@query("ml3_elastic_net", _PRED)
def ml3(spark, sf):
    model, rows = fitted(spark, sf, ["linear"])
    return model.predict(rows.where("NOT is_train"), "linear", ["source", "date"])


@query("ml4_boosted_regressor", _PRED)
def ml4(spark, sf):
    model, rows = fitted(spark, sf, ["linear", "boosted"])
    return model.predict(rows.where("NOT is_train"), "boosted", ["source", "date"])


@query("ml5_predict_both", "source:s date:s linear_prediction:d boosted_prediction:d")
def ml5(spark, sf):
    model, rows = fitted(spark, sf, ["linear", "boosted"])
    return model.predict_both(rows.where("NOT is_train"), ["source", "date"])


@query("ml6_predict_next_week", "source:s predicted_value:d confidence:d forecast_horizon:i model_used:s")
def ml6(spark, sf):
    model, rows = fitted(spark, sf, ["linear"])
    model.evaluate(rows.where("NOT is_train"))
    return model.predict_next_week(windows.latest_row(frame(spark, sf), BY), "linear", ["source"])


@query("ml7_volume_forecaster", "source:s date:s prediction:d")
def ml7(spark, sf):
    rows = features.trainer_matrix(frame(spark, sf), "total_articles", by=BY)
    model = forecasting.volume_forecaster().fit(rows.where("is_train"), names_of(rows), ["linear"])
    return model.predict(rows.where("NOT is_train"), "linear", ["source", "date"])


def spike_rows(spark, sf):
    f = frame(spark, sf)
    return features.trainer_matrix(f.withColumn("spiked", F.col("spike_label")), "spiked", by=BY).drop("spiked")


@query("ml8_spike_detector", "source:s date:s probability:d prediction:i risk_level:s")
def ml8(spark, sf):
    rows = stage("spike_rows", spark, sf, spike_rows)
    model = forecasting.SpikeDetector().fit(rows.where("is_train"), names_of(rows), BY)
    return model.predict(rows.where("NOT is_train"), ["source", "date"])


query("ml10_spike_risk", "event_id:i prediction:i risk_level:s dashboard_risk:s", """
WITH p AS (SELECT event_id, value / (value + 10) AS p FROM events)
RESULT SELECT event_id, CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS prediction,
  CASE WHEN p >= 0.8 THEN 'HIGH' WHEN p >= 0.5 THEN 'MEDIUM' WHEN p >= 0.3 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level,
  CASE WHEN p >= 0.7 THEN 'HIGH' WHEN p >= 0.5 THEN 'MEDIUM' WHEN p >= 0.3 THEN 'LOW' ELSE 'MINIMAL' END AS dashboard_risk FROM p""")(
    lambda spark, sf: forecasting.with_risk(table(spark, sf, "events").select("event_id", (F.col("value") / (F.col("value") + 10)).alias("probability")))
    .withColumn("dashboard_risk", risk_level(F.col("probability"), 0.7)))


def class_days(spark, sf):
    return stage("class_days", spark, sf, lambda s, f: features.classifier_features(orders_as_articles(s, f), BY))


@query("ml11_class_model", "source:s date:s predicted_sentiment:s confidence:d")
def ml11(spark, sf):
    model = forecasting.ClassModel()
    model.fit(class_days(spark, sf), BY)
    return model.predict(class_days(spark, sf), ["source", "date"])


@query("ml14_walk_forward", "mean_score:d std_score:d n_splits:i")
def ml14(spark, sf):
    rows = matrix(spark, sf)

    def fit(train):
        model = forecasting.sentiment_forecaster().fit(train, names_of(rows), ["linear"])
        from trendlens.operators.metrics import regression_metrics
        return lambda test: regression_metrics(model.predict(test.withColumn("y", F.col("label")), "linear", ["y"])).first()["mae"]

    out = forecasting.cross_validate(fit, rows, 5, BY)
    return rows.limit(1).select(*[F.lit(out[k]).alias(k) for k in ("mean_score", "std_score", "n_splits")])


@query("ml15_tune", "trials:i in_space:b full_runs:b best_is_best:b", "SELECT 50 AS trials, true AS in_space, true AS full_runs, true AS best_is_best")
def ml15(spark, sf):
    """The linear space with the default 50 trials and 5 folds."""
    rows = matrix(spark, sf)
    best, tried = forecasting.tune(rows, names_of(rows), "linear", by=BY)
    data = [(i, t["params"]["alpha"], t["params"]["l1"], t["score"], t["folds"], t["stopped"], t["params"] == best) for i, t in enumerate(tried)]
    trials = spark.createDataFrame(data, "trial long, alpha double, l1 double, score double, folds int, stopped boolean, best boolean")
    whole = F.max(F.when(~F.col("stopped"), F.col("score")))
    return trials.agg(
        F.count("*").alias("trials"), F.bool_and(F.col("alpha").between(0.001, 1.0) & F.col("l1").between(0.0, 1.0)).alias("in_space"),
        F.bool_and(F.when(F.col("stopped"), F.col("folds") < 5).otherwise(F.col("folds") == 5)).alias("full_runs"),
        (F.max(F.when(F.col("best"), F.col("score"))) == whole).alias("best_is_best"))


@query("ml16_feature_importance", "feature:s importance:d")
def ml16(spark, sf):
    model, _ = fitted(spark, sf, ["linear", "boosted"])
    return model.importance(spark, "boosted", 15)


@query("ml17_next_day_features", "source:s date:s avg_sentiment_lag_1d:d avg_sentiment_lag_7d:d positive_pct_rolling_3d:d avg_sentiment_rolling_7d:d "
       "sentiment_volatility_7d:d sentiment_momentum:d positive_trend:d day_of_week:i dominant_lag_2d:d", f"""
WITH {CLASS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS b FROM dom)
RESULT SELECT source, max(date) + 1 AS date, max(avg_sentiment) FILTER (WHERE b = 1) AS avg_sentiment_lag_1d, max(avg_sentiment) FILTER (WHERE b = 7) AS avg_sentiment_lag_7d,
  avg(positive_pct) FILTER (WHERE b <= 3) AS positive_pct_rolling_3d, avg(avg_sentiment) FILTER (WHERE b <= 7) AS avg_sentiment_rolling_7d,
  stddev_samp(avg_sentiment) FILTER (WHERE b <= 7) AS sentiment_volatility_7d,
  max(avg_sentiment) FILTER (WHERE b = 1) - max(avg_sentiment) FILTER (WHERE b = 2) AS sentiment_momentum,
  max(positive_pct) FILTER (WHERE b = 1) - max(positive_pct) FILTER (WHERE b = 4) AS positive_trend, isodow(max(date) + 1) - 1 AS day_of_week,
  max(CASE dominant_sentiment WHEN 'positive' THEN 1 WHEN 'negative' THEN -1 ELSE 0 END) FILTER (WHERE b = 2) AS dominant_lag_2d
FROM r GROUP BY source""")
def ml17_features(spark, sf):
    days = daily.with_dominant_class(daily.class_shares(daily.daily_class_counts(orders_as_articles(spark, sf), BY)))
    return forecasting.next_day_features(forecasting.recent_history(windows.class_lags(days, BY), BY), BY)


@query("ml17_forecast_classes", "source:s date:s predicted_sentiment:s confidence:d")
def ml17(spark, sf):
    model = forecasting.ClassModel()
    model.fit(class_days(spark, sf), BY)
    return forecasting.forecast_classes(model, class_days(spark, sf), 7, BY)


def build_trained(spark, sf):
    """All three models of one session, trained once and shared by the serving queries."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        _TRAINED[key] = forecasting.train_all(frame(spark, sf), BY)
    return _TRAINED[key]


query("ml18_train_all", "model:s metrics:s")(lambda spark, sf: build_trained(spark, sf).history)
query("ml19_predictions_all", "source:s sentiment:s volume:s spike:s")(
    lambda spark, sf: forecasting.predictions_all(build_trained(spark, sf), windows.latest_row(frame(spark, sf), BY), BY).select(
        "source", *[F.to_json(c).alias(c) for c in ("sentiment", "volume", "spike")]))
query("ml23_train_class_model", "source:s date:s predicted_sentiment:s confidence:d")(
    lambda spark, sf: forecasting.train_class_model(orders_as_articles(spark, sf), BY)[1])

# --- serving ----------------------------------------------------------------------------------

EDGE = """CASE WHEN count(*) >= 7 THEN avg({c}) FILTER (WHERE {r} <= 7) ELSE max({c}) FILTER (WHERE {r} = 1) END"""


def edges_sql(rows: str) -> str:
    return f"""
rk AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date) AS a, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS d FROM {rows}),
eg AS (SELECT source, count(*) AS n, avg(avg_sentiment) AS m, sum(total_articles) AS t, avg(total_articles) AS dm, {EDGE.format(c='avg_sentiment', r='a')} AS sf,
  {EDGE.format(c='avg_sentiment', r='d')} AS sl, ({EDGE.format(c='total_articles', r='a')})::DOUBLE AS vf, ({EDGE.format(c='total_articles', r='d')})::DOUBLE AS vl,
  max(date) AS e FROM rk GROUP BY source)"""


query("srv1_trend_analysis", "source:s period_days:i start_date:s end_date:s avg_sentiment:d sentiment_change:d total_articles:i volume_change_pct:d sentiment_trend:s volume_trend:s", f"""
WITH mx AS (SELECT source AS s, max(date) AS e FROM dailyos GROUP BY source), rc AS (SELECT o.* FROM dailyos o JOIN mx ON s = source WHERE date >= e - 60), {edges_sql('rc')},
v AS (SELECT *, sl - sf AS ch, CASE WHEN vf > 0 THEN (vl - vf) / vf * 100 ELSE 0 END AS vc FROM eg)
RESULT SELECT source, 60 AS period_days, e - 60 AS start_date, e AS end_date, round(m, 4) AS avg_sentiment, round(ch, 4) AS sentiment_change, t AS total_articles,
  round(vc, 2) AS volume_change_pct, CASE WHEN ch > 0.05 THEN 'IMPROVING' WHEN ch < -0.05 THEN 'DECLINING' ELSE 'STABLE' END AS sentiment_trend,
  CASE WHEN vc > 10 THEN 'INCREASING' WHEN vc < -10 THEN 'DECREASING' ELSE 'STABLE' END AS volume_trend FROM v""")(
    lambda spark, sf: serving.trend_analysis(orders_daily(spark, sf, BY), 60, BY))
query("srv2_daily_aggregates", "source:s date:s total_articles:i avg_sentiment:d std_sentiment:d dominant_sentiment:s spike_label:i", f"""
{SPIKE_CTE}\nRESULT SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM spk) WHERE rn <= 90""")(
    lambda spark, sf: serving.daily_aggregates(spiked(spark, sf), 90, BY))
query("srv3_weekly_prediction", "source:s sentiment:s volume:s")(
    lambda spark, sf: forecasting.weekly_prediction(build_trained(spark, sf), frame(spark, sf), BY).select("source", F.to_json("sentiment").alias("sentiment"), F.to_json("volume").alias("volume")))
query("srv4_spike_probability", "source:s date:s probability:d prediction:i risk_level:s")(
    lambda spark, sf: forecasting.spike_probability(build_trained(spark, sf), frame(spark, sf), BY))
query("srv5_prediction_vs_actual", "source:s date:s prediction:d actual:d error:d", """
WITH p AS (SELECT source, date, avg_sentiment AS actual, lag(avg_sentiment, 7) OVER (PARTITION BY source ORDER BY date) AS prediction FROM dailyos),
q AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM p)
RESULT SELECT source, date, prediction, actual, actual - prediction AS error FROM q WHERE rn <= 14""")(
    lambda spark, sf: serving.prediction_vs_actual(
        orders_daily(spark, sf, BY).select("source", "date", F.lag("avg_sentiment", 7).over(windows.series_window(BY)).alias("prediction")),
        orders_daily(spark, sf, BY).select("source", "date", F.col("avg_sentiment").alias("actual")), 14, BY))
@query("srv5_prediction_history", "source:s date:s actual:d out_of_fold:b consistent:b", """
WITH q AS (SELECT source, date, avg_sentiment AS actual, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM dailyos)
RESULT SELECT source, date, actual, true AS out_of_fold, true AS consistent FROM q WHERE rn <= 14""")
def srv5_history(spark, sf):
    """Stored out-of-fold predictions next to what happened on the days they were for."""
    path = scratch_path(spark, "predictions")
    rows = matrix(spark, sf)
    days = frame(spark, sf).select("source", "date")
    made = forecasting.out_of_fold(rows, names_of(rows), forecasting.sentiment_forecaster, by=BY)
    forecasting.store_predictions(spark, path, made, days, "sentiment", by=BY)
    actuals = orders_daily(spark, sf, BY).select("source", "date", F.col("avg_sentiment").alias("actual"))
    stored = forecasting.stored_predictions(spark, path, "sentiment", BY)
    both = serving.prediction_vs_actual(stored, actuals, 14, BY).join(stored.select("source", "date", "made_on"), BY + ["date"])
    right = F.abs(F.col("error") - (F.col("actual") - F.col("prediction"))) < 1e-9
    return both.select("source", "date", "actual", (F.col("made_on") < F.col("date")).alias("out_of_fold"), (right & ~F.isnan("prediction")).alias("consistent"))


query("srv6_retrain", "model:s metrics:s")(lambda spark, sf: batch_job.retrain(spark, orders_as_articles(spark, sf), scratch_path(spark, "retrain"), by=("source",)).history)
query("srv7_trend_summary", "source:s mean_sentiment:d tier:s sentiment_change:d articles:i daily_mean:d volume_change:d volume_change_pct:d spikes:i spike_rate:d", f"""
{SPIKE_CTE}, rc AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM spk) WHERE rn <= 30), {edges_sql('rc')},
sp2 AS (SELECT source AS s2, sum(spike_label) AS spikes FROM rc GROUP BY source)
RESULT SELECT source, m AS mean_sentiment, CASE WHEN m > 0.15 THEN 'positive' WHEN m > -0.15 THEN 'neutral' ELSE 'negative' END AS tier, sl - sf AS sentiment_change, t AS articles,
  dm AS daily_mean, vl - vf AS volume_change, CASE WHEN vf > 0 THEN (vl - vf) / vf * 100 ELSE 0 END AS volume_change_pct, spikes, spikes * 100.0 / n AS spike_rate
FROM eg JOIN sp2 ON s2 = source""")(lambda spark, sf: serving.trend_summary(spiked(spark, sf), 30, BY))
_LAST_SQL = "lst AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM dailyos) WHERE rn = 1), prd AS (SELECT source AS ps, avg(total_articles) * 1.2::DOUBLE AS predicted_value FROM dailyos GROUP BY source)"


def volume_guess(spark, sf):
    """Stand-in prediction that SQL can restate: the mean volume of the series plus a fifth."""
    return orders_daily(spark, sf, BY).groupBy("source").agg((F.avg("total_articles") * 1.2).alias("predicted_value"))


query("srv8_volume_path", "source:s date:s value:d low:d high:d", f"""
WITH {_LAST_SQL}, st AS (SELECT *, unnest([0,1,2,3,4,5,6]) AS i FROM lst JOIN prd ON ps = source),
pv AS (SELECT source, date + CAST(i + 1 AS INT) AS date, i, greatest(1.0::DOUBLE, (total_articles + (predicted_value - total_articles) * (((i + 1) / 7.0::DOUBLE) * ((i + 1) / 7.0::DOUBLE) * (3 - 2 * ((i + 1) / 7.0::DOUBLE))))
   * (CASE WHEN isodow(date + CAST(i + 1 AS INT)) >= 6 THEN 0.85 ELSE 1.0 END)::DOUBLE + sin(i * 1.2::DOUBLE) * 2) AS value FROM st)
RESULT SELECT source, date, value, greatest(0, value - 0.2::DOUBLE * (1 + 0.4::DOUBLE * i / 7) * value) AS low, value + 0.2::DOUBLE * (1 + 0.4::DOUBLE * i / 7) * value AS high FROM pv""")(
    lambda spark, sf: serving.volume_path(windows.latest_row(orders_daily(spark, sf, BY), BY).join(volume_guess(spark, sf), "source"), 7, BY))
query("srv9_volume_outlook", "source:s predicted_value:d recent_mean:d change:d outlook:s", f"""
WITH {_LAST_SQL}, r7 AS (SELECT source, avg(total_articles) AS recent_mean FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM dailyos) WHERE rn <= 7 GROUP BY source)
RESULT SELECT source, predicted_value, recent_mean, predicted_value - recent_mean AS change,
  CASE WHEN predicted_value - recent_mean > 3 THEN 'MORE' WHEN predicted_value - recent_mean < -3 THEN 'FEWER' ELSE 'STABLE' END AS outlook FROM r7 JOIN prd ON ps = source""")(
    lambda spark, sf: serving.volume_outlook(orders_daily(spark, sf, BY), volume_guess(spark, sf), BY))


@query("srv10_sentiment_series", "source:s series:s date:s value:d spike:b", f"""
{SPIKE_CTE}, h AS (SELECT source, date, CASE dominant_sentiment WHEN 'positive' THEN 0.3 WHEN 'negative' THEN -0.3 ELSE 0 END AS value, spike_label = 1 AS spike,
  row_number() OVER (PARTITION BY source ORDER BY date DESC) AS rn FROM spk)
RESULT SELECT source, 'historical' AS series, date, value, spike FROM h
UNION ALL SELECT source, 'forecast', date, value, false FROM h WHERE rn = 1
UNION ALL SELECT source, 'forecast', date + 7, value, false FROM h WHERE rn <= 7""")
def srv10(spark, sf):
    days = spiked(spark, sf)
    ahead = windows.tail(days, 7, BY).select("source", F.date_add("date", 7).alias("date"), F.col("dominant_sentiment").alias("predicted_sentiment"))
    return serving.sentiment_series(days, ahead, BY)


query("srv11_spike_alert", "event_id:i risk_level:s message:s", """
WITH p AS (SELECT event_id, round(value / (value + 10), 3) AS p FROM events),
q AS (SELECT *, CASE WHEN p >= 0.8 THEN 'HIGH' WHEN p >= 0.5 THEN 'MEDIUM' WHEN p >= 0.3 THEN 'LOW' ELSE 'MINIMAL' END AS risk_level FROM p)
RESULT SELECT event_id, risk_level, CASE risk_level WHEN 'HIGH' THEN 'HIGH SPIKE ALERT' WHEN 'MEDIUM' THEN 'MODERATE SPIKE RISK' ELSE 'LOW SPIKE RISK' END
  || ' - probability ' || (CAST(round(p * 1000) AS BIGINT) / 10)::DECIMAL(10,1)::VARCHAR || '%' AS message FROM q WHERE risk_level <> 'MINIMAL'""")(
    lambda spark, sf: serving.spike_alert(table(spark, sf, "events").select("event_id", F.round(F.col("value") / (F.col("value") + 10), 3).alias("probability"))))


def batch_runs(spark, sf):
    """Three runs of the batch job: two thirds of the articles, all of them, and the same once more."""

    def build(spark, sf):
        out = scratch_path(spark, "batch")
        raw = document_articles(spark, sf).select("article_id", "title", "text", "publishedAt", "source")
        rows = []
        for number, part in enumerate((raw.where("article_id % 3 <> 0"), raw, raw)):
            run = batch_job.run_batch(spark, part, out, summariser=lambda df: df.withColumn("summary", F.substring("text", 1, 200)), train=number == 1)
            rows += [(number + 1, name, run.worked.get(name, 0), outcome, out) for name, outcome in run.outcome.items()]
        return spark.createDataFrame(rows, "run int, stage string, worked long, outcome string, out string")

    return stage("batch-runs", spark, sf, build)


_KEPT_SQL = f"""{CLEAN_SQL}, kp AS (SELECT * FROM (SELECT article_id, title, clean_text AS text, source, publishedAt, row_number() OVER (PARTITION BY title, publishedAt, source ORDER BY article_id DESC) AS rn
  FROM cw WHERE NOT contains(text, '{PAYWALL_MARKER}') AND words >= 100) WHERE rn = 1)"""

query("srv12_run_batch", "run:i stage:s worked:i outcome:s", f"""
WITH {_KEPT_SQL}, n AS (SELECT count_if(article_id % 3 <> 0) AS a, count_if(article_id % 3 = 0) AS b FROM docs), k AS (SELECT count_if(article_id % 3 <> 0) AS a, count_if(article_id % 3 = 0) AS b FROM kp)
RESULT SELECT unnest([1, 1, 1, 1, 1, 2, 2, 2, 2, 2, 2, 3, 3, 3, 3, 3, 3]) AS run,
  unnest(['articles', 'articles_with_sentiment', 'articles_with_topics', 'articles_with_summary', 'scorecard', 'articles', 'articles_with_sentiment', 'articles_with_topics', 'articles_with_summary', 'models', 'scorecard',
          'articles', 'articles_with_sentiment', 'articles_with_topics', 'articles_with_summary', 'models', 'scorecard']) AS stage,
  unnest([n.a, k.a, k.a, k.a, 0, n.b, k.b, k.a + k.b, k.b, 0, 0, 0, 0, 0, 0, 0, 0]) AS worked,
  unnest(['ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'ok', 'unchanged', 'unchanged', 'unchanged', 'unchanged']) AS outcome FROM n, k""")(batch_runs)
query("srv12_incremental_rows", "article_id:i title:s source:s sentiment:s sentiment_confidence:d summary:s", f"""
WITH {_KEPT_SQL}, {lexicon_sql('kp', 'text')}
RESULT SELECT article_id, title, source, predicted AS sentiment, confidence AS sentiment_confidence, substring(trim(regexp_replace(text, '{WHITESPACE}', ' ', 'g')), 1, 200) AS summary FROM scd""")(
    lambda spark, sf: readers.read_stage_table(spark, batch_runs(spark, sf).first()["out"] + "/final"))


@query("snk3_upsert", "article_id:i title:s source:s note:s", """
SELECT article_id, title, source, CASE WHEN article_id % 5 = 0 THEN 'second' ELSE 'first' END AS note FROM docs WHERE article_id % 2 = 0 OR article_id % 5 = 0""")
def snk3_upsert(spark, sf):
    """Two upserts that overlap: the second replaces equal keys and adds new ones, in the days it touches."""
    rows = document_articles(spark, sf).select("article_id", "title", "source", "publishedAt")
    table = keyed.KeyedTable(spark, scratch_path(spark, "upserts"))
    table.upsert(rows.where("article_id % 2 = 0").withColumn("note", F.lit("first")))
    table.upsert(rows.where("article_id % 5 = 0").withColumn("note", F.lit("second")))
    return table.read()


# --- sources and sinks ------------------------------------------------------------------------

RAW = ("title", "description", "source", "publishedAt", "content", "url")
_RAW_SPEC = "title:s description:s source:s publishedAt:s content:s url:s"


def batches(spark, sf, per_batch=50):
    """The feed as JSON arrays, one per fetch of at most ``per_batch`` articles."""
    rows = feed(spark, sf)
    group = rows.groupBy(F.floor(F.col("pos") / per_batch).alias("b"))
    return group.agg(F.sort_array(F.collect_list(F.struct("pos", *RAW))).alias("a")).select("b", F.transform("a", lambda x: F.struct(*[x[c].alias(c) for c in RAW])).alias("a"))


@query("src1_read_raw_articles", _RAW_SPEC, "SELECT * FROM feed")
def src1(spark, sf):
    path = scratch_path(spark, "raw")
    batches(spark, sf).select(F.to_json("a").alias("value")).write.text(path)
    return readers.read_raw_articles(spark, path, multi_line=False)


@query("src2_read_scraped_articles", "title:s source:s publishedAt:s text:s url:s", "SELECT title, source, publishedAt, content AS text, url FROM feed")
def src2(spark, sf):
    path = scratch_path(spark, "scraped")
    item = F.transform("a", lambda x: F.struct(x["title"].alias("title"), F.struct(x["source"].alias("name")).alias("source"), x["publishedAt"].alias("publishedAt"), x["content"].alias("text"), x["url"].alias("url")))
    batches(spark, sf).select(F.to_json(F.struct(item.alias("articles"))).alias("value")).write.text(path)
    return readers.read_scraped_articles(spark, path, multi_line=False)


@query("src3_latest_file", "rows:i", "SELECT count(*) AS rows FROM feed")
def src3(spark, sf):
    """Rows in the newest files of the feed's fetches: a folder per fetch, which is what one task reads."""
    rows, path = feed(spark, sf), scratch_path(spark, "latest")
    if rows.isEmpty():
        return rows.agg(F.count(F.lit(1)).alias("rows"))
    rows.withColumn("fetch", F.spark_partition_id()).write.partitionBy("fetch").parquet(path)
    fetches = [r[0] for r in spark.read.parquet(path).select("fetch").distinct().collect()]  # as many as tasks
    newest = [readers.latest_file(spark, f"{path}/fetch={fetch}/*.parquet").first()["path"] for fetch in fetches]
    return spark.read.parquet(*newest).agg(F.count(F.lit(1)).alias("rows"))


_DOC = "article_id:i title:s text:s source:s"


def doc_rows(spark, sf):
    return articles_from_documents(spark, sf).select("article_id", "title", "text", "source")


@query("src4_read_stage_table", _DOC, "SELECT article_id, title, text, source FROM docs")
def src4(spark, sf):
    path = scratch_path(spark, "csv")
    rows = doc_rows(spark, sf)
    writers.write_stage_table(rows, path, "csv")
    return readers.read_stage_table(spark, path, "csv", rows.schema)


@query("src5_first_available", _DOC, "SELECT article_id, title, text, source FROM docs")
def src5(spark, sf):
    path = scratch_path(spark, "stage")
    writers.write_stage_table(doc_rows(spark, sf).select("article_id"), f"{path}/partial")
    writers.write_stage_table(doc_rows(spark, sf), f"{path}/full")
    return readers.first_available(spark, [f"{path}/missing", f"{path}/partial", f"{path}/full"], "source")


@query("snk1_write_raw_batch", _RAW_SPEC + " ingest_ts:s", "SELECT *, '20240101_080000' AS ingest_ts FROM feed UNION ALL SELECT *, '20240101_200000' FROM feed")
def snk1(spark, sf):
    path = scratch_path(spark, "batches")
    for stamp in ("20240101_080000", "20240101_200000"):
        writers.write_raw_batch(feed(spark, sf).select(*RAW), path, stamp)
    schema = readers.RAW_SCHEMA.add("ingest_ts", "string")
    return spark.read.schema(schema).json(path)


@query("snk2_write_corpus", _DOC, "SELECT article_id, title, text, source FROM docs")
def snk2(spark, sf):
    path = scratch_path(spark, "corpus")
    rows = doc_rows(spark, sf)
    writers.write_corpus(rows.where("source < 'src2'"), path)
    writers.write_corpus(rows.where("source >= 'src2'"), path)
    return readers.read_stage_table(spark, path)


@query("snk3_write_stage_table", _DOC, "SELECT article_id, title, text, source FROM docs")
def snk3(spark, sf):
    path = scratch_path(spark, "stage")
    writers.write_stage_table(doc_rows(spark, sf).select("article_id"), path)
    writers.write_stage_table(doc_rows(spark, sf), path, partition_by=["source"])
    return readers.read_stage_table(spark, path)


@query("snk4_write_report", "total_articles:i", "SELECT count(*) AS total_articles FROM docs")
def snk4(spark, sf):
    from trendlens.operators.scorecard import full_report
    path = scratch_path(spark, "report")
    writers.write_report(full_report(articles_from_documents(spark, sf)), f"{path}/json", f"{path}/text")
    return spark.read.json(f"{path}/json").select("data_quality.total_articles")


@query("snk5_save_load_model", "differing:i largest:d", "SELECT 0 AS differing, 0.0 AS largest")
def snk5(spark, sf):
    path = scratch_path(spark, "model")
    model, rows = fitted(spark, sf, ["linear"])
    model.save(spark, path)
    again = forecasting.Forecaster.load(spark, path)
    a = model.predict(rows, "linear", ["source", "date"])
    b = again.predict(rows, "linear", ["source", "date"]).withColumnRenamed("prediction", "other")
    gap = F.abs(F.col("prediction") - F.col("other"))
    return a.join(b, ["source", "date"]).agg(F.count_if(gap > 0).alias("differing"), F.max(gap).alias("largest"))


@query("snk6_refresh_daily", "date:s total_articles:i avg_sentiment:d", "SELECT * FROM dailye")
def snk6(spark, sf):
    path = scratch_path(spark, "daily")
    build = lambda: events_daily(spark, sf)
    writers.refresh_daily(spark, [f"{sf}/events.parquet"], path, build)
    return writers.refresh_daily(spark, [f"{sf}/events.parquet"], path, build)


# --- streams ----------------------------------------------------------------------------------

@query("str1_intake", "url:s", "SELECT DISTINCT url FROM feed WHERE url <> ''")
def str1(spark, sf):
    path = scratch_path(spark, "intake")
    pages = jobs.table_stream(spark, sf, "pages", table(spark, sf, "pages").schema)
    when = F.timestamp_add("MINUTE", (F.col("page_id") * 53).cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp"))
    jobs.intake(pages.select("url", when.alias("publishedAt")), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{path}/out")


def arrivals(spark, sf, start):
    """The event articles in three batches by time, a third of them up to a day and a half late, each run from the last checkpoint.

    ``start(stream)`` starts the job over the stream of all files that are there.
    """
    path = scratch_path(spark, "arrivals")
    events = table(spark, sf, "events")
    late = F.when(F.col("event_id") % 3 == 0, F.make_dt_interval(hours=F.pmod(F.col("event_id"), F.lit(36)).cast("int"))).otherwise(F.make_dt_interval())
    when = F.col("ts").cast("timestamp")
    span = events.select(when.alias("t")).agg(F.min("t").alias("lo"), F.max("t").alias("hi")).first()
    third = (span["hi"] - span["lo"]) / 3
    part = (when + late > F.lit(span["lo"] + third)).cast("int") + (when + late > F.lit(span["lo"] + 2 * third)).cast("int")
    for batch in range(3):
        events.where(part == batch).write.parquet(f"{path}/batch={batch}")
        rows = jobs.file_stream(spark, f"{path}/*", events.schema)
        start(articles_of(rows)).awaitTermination()


def articles_of(events):
    kind = F.col("event_type")
    return events.select(
        F.col("event_id").alias("article_id"), F.concat_ws(" ", kind, F.col("props")).alias("title"), F.concat_ws(" ", kind, F.col("props")).alias("text"),
        F.col("ts").cast("timestamp").alias("publishedAt"), F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("source"),
        F.when(kind.isin("purchase", "signup"), "positive").when(kind == "error", "negative").otherwise("neutral").alias("sentiment"))


@query("str2_daily_stream", "date:s total_articles:i avg_sentiment:d std_sentiment:d min_sentiment:d max_sentiment:d dominant_sentiment:s", "SELECT * FROM dailye")
def streamed_days(spark, sf):
    path = scratch_path(spark, "days")
    arrivals(spark, sf, lambda rows: jobs.write_updates(jobs.daily_stream(rows), f"{path}/out", f"{path}/checkpoint", compact_every=2))
    return jobs.read_updates(spark, f"{path}/out")


@query("str3_score_stream", "article_id:i sentiment:s", """
SELECT article_id, CASE WHEN title LIKE 'error%' THEN 'negative' WHEN title LIKE 'purchase%' OR title LIKE 'signup%' THEN 'positive' ELSE 'neutral' END AS sentiment FROM ev""")
def str3(spark, sf):
    path = scratch_path(spark, "scored")
    arrivals(spark, sf, lambda rows: jobs.score_stream(rows.drop("sentiment"), f"{path}/out", f"{path}/checkpoint", score_with_lexicon, compact_every=2))
    return jobs.read_scores(spark, f"{path}/out")


_LINK_SQL = f"""{pairs_sql('docs', 0.70)},
ap AS (SELECT least(x.article_id, y.article_id) AS i, greatest(x.article_id, y.article_id) AS j, cosine FROM prs JOIN mem x ON x.vid = prs.a JOIN mem y ON y.vid = prs.b
       UNION ALL SELECT x.article_id, y.article_id, 1.0 FROM mem x JOIN mem y ON x.vid = y.vid AND x.article_id < y.article_id),
ori AS (SELECT i + j - o AS c, o, cosine FROM (
          SELECT i, j, cosine, CASE WHEN dj.publishedAt IS NULL OR di.publishedAt <= dj.publishedAt THEN i ELSE j END AS o FROM ap JOIN docs di ON di.article_id = i JOIN docs dj ON dj.article_id = j
          WHERE coalesce(di.title, '') <> coalesce(dj.title, '') AND di.source IS DISTINCT FROM dj.source AND NOT (di.publishedAt IS NULL AND dj.publishedAt IS NULL))),
bst AS (SELECT c, min(o) AS o, arg_min(cosine, o) AS cosine FROM ori GROUP BY c),
cnt AS (SELECT o, count(*) AS n FROM bst GROUP BY o)"""


@query("str3_copy_check", "article_id:i is_original:b duplicate_of:d original_source:s similarity_score:d similarity_category:s spread_count:i", f"""
WITH {_LINK_SQL}
RESULT SELECT d.article_id, bst.o IS NULL AS is_original, bst.o AS duplicate_of, coalesce(so.source, d.source) AS original_source, coalesce(cosine, 1.0) AS similarity_score,
  CASE WHEN cosine >= 0.85 THEN 'semantic_copy' WHEN cosine IS NOT NULL THEN 'paraphrased' ELSE 'original' END AS similarity_category, coalesce(n, 0) AS spread_count
FROM docs d LEFT JOIN bst ON c = article_id LEFT JOIN docs so ON so.article_id = bst.o LEFT JOIN cnt ON cnt.o = d.article_id""")
def str3_copies(spark, sf):
    """The articles in three files, in no order of time, as micro-batches; late ones become originals of earlier ones."""
    path = scratch_path(spark, "arrivals")
    rows = document_articles(spark, sf).select("article_id", "title", "text", "publishedAt", "source")
    rows.repartitionByRange(3, F.xxhash64("article_id")).write.parquet(path)
    index = copy_index.CopyIndex(spark, scratch_path(spark, "copy-index"), compact_every=2)
    index.prepare(rows)
    copy_index.copy_stream(jobs.file_stream(spark, path, rows.schema, files_per_batch=1), index, scratch_path(spark, "copy-checkpoint")).awaitTermination()
    return index.marked()


@query("str4_spike_alerts", "date:s total_articles:i volume_spike:b sentiment_spike:b", """
WITH m AS (SELECT *, avg_sentiment - lag(avg_sentiment) OVER (ORDER BY date) AS ch FROM dailye), r AS (SELECT avg(total_articles) AS a, stddev_samp(total_articles) AS s FROM dailye),
f AS (SELECT m.*, total_articles > a + 0.5 * s AS volume_spike, coalesce(abs(ch) > 0.02, false) AS sentiment_spike FROM m, r)
RESULT SELECT * FROM f WHERE volume_spike OR sentiment_spike""")
def str4(spark, sf):
    path = scratch_path(spark, "alerts")
    reference = jobs.volume_reference(events_daily(spark, sf))
    arrivals(spark, sf, lambda rows: jobs.alert_stream(jobs.daily_stream(rows), reference, f"{path}/out", f"{path}/checkpoint", 0.5, 0.02, compact_every=2))
    return jobs.read_alerts(spark, f"{path}/out")

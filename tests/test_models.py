import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from trendlens.operators import features, forecasting
from trendlens.operators.metrics import collapse_check, regression_metrics
from trendlens.operators.neighbours import nearest_in_groups


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = []
    for i in range(80):
        a, b = rng.random(), rng.random()
        data.append((dt.date(2025, 1, 1) + dt.timedelta(days=i), a, b, 0.3 * a + 0.2 * b, 1 if a > 0.8 else 0))
    return spark.createDataFrame(data, "date date, f1 double, f2 double, label double, spike int")


def test_unfitted_models_refuse(rows, spark, tmp_path):
    with pytest.raises(RuntimeError):
        forecasting.Forecaster().predict(rows)
    with pytest.raises(RuntimeError):
        forecasting.SpikeDetector().predict(rows)
    with pytest.raises(RuntimeError):
        forecasting.Forecaster().save(spark, str(tmp_path / "m"))


def test_round_trip_and_confidence(rows, spark, tmp_path):
    model = forecasting.volume_forecaster(rounds=3, alpha=0.001).fit(rows, ["f1", "f2"])
    assert model.evaluate(rows).count() == 2 and 0 <= model.confidence("linear") <= 1
    model.save(spark, str(tmp_path / "m"))
    again = forecasting.Forecaster.load(spark, str(tmp_path / "m"))
    a = [r.prediction for r in model.predict(rows, "boosted", ["date"]).orderBy("date").collect()]
    assert a == [r.prediction for r in again.predict(rows, "boosted", ["date"]).orderBy("date").collect()]
    assert model.importance(spark, "linear").count() == 2
    assert again.predict(rows.drop("f2"), "linear").count() == 80  # a missing feature counts as 0


def test_spike_detector_probabilities(rows):
    data = rows.withColumn("label", F.col("spike"))
    out = forecasting.SpikeDetector(rounds=3).fit(data, ["f1", "f2"]).predict(data, ["date"]).collect()
    assert all(0 <= r.probability <= 1 and r.risk_level in ("HIGH", "MEDIUM", "LOW", "MINIMAL") for r in out)


def test_smote_balances_inside_the_minority_range(rows):
    data = rows.withColumn("label", F.col("spike"))
    made = forecasting.smote(data, ["f1", "f2"])
    n = {r.label: r["count"] for r in made.groupBy("label").count().collect()}
    assert n[0] == n[1]
    lo = data.where("label = 1").agg(F.min("f1")).first()[0]
    assert made.where("label = 1").agg(F.min("f1")).first()[0] >= lo - 1e-9


def test_time_split(rows):
    assert features.time_split(rows).where("is_train").count() == 64


def test_class_forecast_covers_seven_days(spark):
    rng = random.Random(5)
    arts = []
    for d in range(40):
        for k in range(6):
            label = rng.choices(["positive", "neutral", "negative"], [1 + d % 4, 2, 1 + (d + 2) % 4])[0]
            arts.append((f"t{d}-{k}", str(dt.datetime(2025, 1, 1, k) + dt.timedelta(days=d)), label))
    df = spark.createDataFrame(arts, "title string, publishedAt string, sentiment string")
    model, ahead = forecasting.train_class_model(df, trees=5)
    got = ahead.orderBy("date").collect()
    assert [str(r.date) for r in got] == [f"2025-02-{d:02d}" for d in range(10, 17)]
    assert all(sum(r.probabilities.values()) == pytest.approx(1) for r in got)
    assert collapse_check(ahead, "predicted_sentiment").first().classes >= 1
    assert len(model.labels) >= 2


def test_search_draws_inside_its_space():
    for t in range(20):
        p = forecasting.draw(forecasting.SPACES["spike"], t)
        assert 50 <= p["rounds"] <= 300 and 1 <= p["weight"] <= 10
    assert forecasting.draw(forecasting.SPACES["linear"], 3) == forecasting.draw(forecasting.SPACES["linear"], 3)


def test_smote_neighbours_are_exact(spark):
    rng = random.Random(8)
    rows = [(g, i, [rng.random() for _ in range(3)]) for i, g in enumerate(rng.choices("ab", k=90))]
    df = spark.createDataFrame([(i, v, g) for g, i, v in rows], "id long, v array<double>, g string")
    got = {}
    for r in nearest_in_groups(df, 4, ["g"], block=7).collect():
        got.setdefault(r.id, []).append((r["rank"], r.other))
    for g, i, v in rows:
        others = sorted((round(sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, 9), j) for h, j, w in rows if h == g and j != i)[:4]
        assert sorted(got[i]) == [(n + 1, j) for n, (_, j) in enumerate(others)]


def test_smote_rows_lie_between_neighbours_and_repeat(rows):
    data = rows.withColumn("label", F.col("spike"))
    made = forecasting.smote(data, ["f1", "f2"], k=2)
    again = forecasting.smote(data.repartition(5), ["f1", "f2"], k=2)
    key = lambda df: sorted((str(r.date), r.label, r.f1, r.f2) for r in df.collect())
    assert key(made) == key(again)
    real = [(r.f1, r.f2) for r in data.where("label = 1").collect()]
    for r in made.where("label = 1").collect():
        between = any(abs((a[0] - r.f1) * (b[1] - r.f2) - (a[1] - r.f2) * (b[0] - r.f1)) < 1e-9 for a in real for b in real)
        assert between


def test_search_learns_and_stops_early():
    space = {"x": (0.0, 1.0, "real"), "n": (1, 100, "int"), "a": (0.001, 1.0, "log")}

    def score(p, fold):
        return -((p["x"] - 0.7) ** 2) - ((p["n"] - 30) / 100) ** 2 - (math.log10(p["a"]) + 2) ** 2 / 9 + fold * 0.001

    tried = forecasting.search(score, space, 60, 4, parallel=4)
    assert tried == forecasting.search(score, space, 60, 4, parallel=4)
    assert len(tried) == 60 and any(t["stopped"] for t in tried) and all(t["folds"] == 4 or t["stopped"] for t in tried)
    assert all(0 <= t["params"]["x"] <= 1 and 1 <= t["params"]["n"] <= 100 and 0.001 <= t["params"]["a"] <= 1 for t in tried)
    start, later = [t["score"] for t in tried[:10]], [t["score"] for t in tried[-20:]]
    assert sum(later) / 20 > sum(start) / 10  # later trials are drawn where earlier ones were good
    blind = max(score(forecasting.draw(space, t), 1.5) for t in range(60))
    assert max(t["score"] for t in tried if not t["stopped"]) >= blind - 0.02


@pytest.mark.parametrize("kind", ["boosted", "spike"])
def test_search_of_tree_spaces(rows, kind):
    data = rows if kind == "boosted" else rows.withColumn("label", F.col("spike"))
    best, tried = forecasting.tune(data, ["f1", "f2"], kind, trials=2, k=2, limits={"rounds": (2, 4, "int"), "depth": (2, 3, "int")})
    assert len(tried) == 2 and 2 <= best["rounds"] <= 4 and 0.01 <= best["step"] <= 0.3


def test_search_scales_a_fold_once(rows, monkeypatch):
    """As many scalers as folds, however many trials there are, and the scores of models that are fitted from scratch."""
    fitted, scaler = [], forecasting.fit_scaler
    monkeypatch.setattr(forecasting, "fit_scaler", lambda *a: fitted.append(1) or scaler(*a))
    _, tried = forecasting.tune(rows, ["f1", "f2"], "linear", trials=3, k=2)
    assert len(fitted) == 2
    folds = features.walk_forward_folds(rows, 2)
    for t in tried[:1]:
        scores = []
        for i in range(2):
            one = folds.where(F.col("fold") == i)
            model = forecasting.Forecaster(**t["params"]).fit(one.where("role = 'train'"), ["f1", "f2"], ["linear"])
            told = model.predict(one.where("role = 'test'").withColumn("y", F.col("label")), "linear", ["y"])
            scores.append(-(regression_metrics(told).first()["rmse"] ** 2))
        assert t["score"] == pytest.approx(sum(scores) / 2, rel=1e-9)


def test_stored_predictions_are_replaced_by_day(rows, spark, tmp_path):
    days = rows.select("date")
    path = str(tmp_path / "store")
    made = forecasting.out_of_fold(rows, ["f1", "f2"], lambda: forecasting.Forecaster(alpha=0.001), k=3)
    assert made.count() == 3 * (80 // 4) and made.groupBy("date").count().where("count > 1").isEmpty()
    forecasting.store_predictions(spark, path, made, days, "m", horizon=7)
    first = forecasting.stored_predictions(spark, path, "m")
    assert first.count() == 60 - 7 and first.where("datediff(date, made_on) <> 7").isEmpty()
    forecasting.store_predictions(spark, path, made.limit(20).withColumn("prediction", F.lit(5.0)), days, "m", horizon=7)
    forecasting.store_predictions(spark, path, made, days, "other", horizon=7)
    again = forecasting.stored_predictions(spark, path, "m")
    assert again.count() == 60 - 7 and again.where("prediction = 5").count() > 10

"""Forecasting and spike models with Spark ML: one pooled model over all series.

A model is fitted on the rows of every series at once and scores every series in one pass. What the
driver holds is the size of a model: scaler parameters, coefficients and trees.
"""

from __future__ import annotations

import json
import math
import random
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.functions.labels import risk_level
from trendlens.operators import daily, features, metrics, windows
from trendlens.operators.neighbours import nearest_in_groups
from trendlens.relational import group_percentiles, scan_ordered
from trendlens.session import cut_lineage
from trendlens.sources.keyed import KeyedTable

VERSION = "1"
SEED = 42


# --- scaling ------------------------------------------------------------------------------------

def scaler_parameters(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> DataFrame:
    """(name, center, scale) per column: mean and population deviation, or median and quartile range.

    A scale of 0 becomes 1. Quartiles are exact and interpolated.
    """
    if kind == "standard":
        stats = df.agg(*[F.struct(F.lit(c).alias("name"), F.avg(c).alias("center"), F.stddev_pop(c).alias("scale")).alias(f"s{i}") for i, c in enumerate(cols)])
        out = stats.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("x")).select("x.*")
    else:
        long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("double").alias("value")) for c in cols])).alias("x")).select("x.*")
        q = group_percentiles(long, ["name"], "value", {"q1": 0.25, "center": 0.5, "q3": 0.75})
        out = q.select("name", "center", (F.col("q3") - F.col("q1")).alias("scale"))
    return out.withColumn("scale", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")))


def fit_scaler(df: DataFrame, cols: Sequence[str], kind: str = "standard") -> dict[str, tuple[float, float]]:
    """Scaler parameters on the driver: two numbers per feature."""
    rows = scaler_parameters(df, cols, kind).toLocalIterator()
    return {r["name"]: (r["center"] or 0.0, r["scale"] or 1.0) for r in rows}


def scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """Replace the columns by their scaled values."""
    return df.withColumns({c: (F.col(c).cast("double") - m) / s for c, (m, s) in params.items()})


def align_features(df: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Columns in trained order; NULL and missing ones become 0."""
    cols = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in df.columns else F.lit(0.0).alias(c) for c in names]
    return df.select(*[c for c in keep if c in df.columns], *cols)


def _vectorised(df: DataFrame, params: dict[str, tuple[float, float]], keep: Sequence[str]) -> DataFrame:
    names = list(params)
    rows = scale(df.select(*keep, *names).na.fill(0, names), params)
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows).select(*keep, "features")


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Add ``weight`` = n / (classes * n_class), over all rows."""
    counts = df.groupBy(F.col(label).alias("__l")).agg(F.count(F.lit(1)).alias("__n"))
    whole = counts.agg(F.sum("__n").alias("__all"), F.count(F.lit(1)).alias("__k"))
    table = counts.join(F.broadcast(whole), F.lit(True)).select("__l", (F.col("__all") / (F.col("__k") * F.col("__n"))).alias("weight"))
    return df.join(F.broadcast(table), F.col(label) == F.col("__l")).drop("__l")  # one row per class


def smote(df: DataFrame, cols: Sequence[str], label: str = "label", by: Sequence[str] = (), k: int = 5, seed: int = SEED) -> DataFrame:
    """Balance each series by interpolating between minority days and their nearest minority days.

    Neighbours are those of the same series, found by a blocked nearest-neighbour join. Every draw is a hash of the seed, the
    day and the number of the copy, so a task that is run again makes the same rows. A series with fewer than two minority
    rows stays as it is. One row per series and day is expected.
    """
    base = df.select(*by, "date", label, *[F.col(c).cast("double").alias(c) for c in cols])
    counts = base.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("ones"), F.count_if(F.col(label) == 0).alias("zeros"))
    counts = counts.select(*[F.col(n).alias(f"__k{i}") for i, n in enumerate(by)], F.when(F.col("ones") <= F.col("zeros"), 1).otherwise(0).alias("__minority"),
                           F.least("ones", "zeros").alias("__m"), F.abs(F.col("ones") - F.col("zeros")).alias("__need"))
    same = F.lit(True)
    for i, n in enumerate(by):
        same = same & F.col(n).eqNullSafe(F.col(f"__k{i}"))
    few = base.join(counts if by else F.broadcast(counts), same)  # one row when there is one series
    few = few.where((F.col(label) == F.col("__minority")) & (F.col("__m") >= 2) & (F.col("__need") > 0)).drop(*[f"__k{i}" for i in range(len(by))], "__minority")
    few = cut_lineage(few.select("*", F.xxhash64("date", *by).alias("__id"), F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in cols]).alias("__v"), F.lit(1).alias("__one")))
    near = nearest_in_groups(few.select(F.col("__id").alias("id"), F.col("__v").alias("v"), *by), k, by)
    others = few.select(F.col("__id").alias("other"), F.col("__v").alias("__w"))
    near = near.join(others, "other").select(F.col("id").alias("__n"), "rank", "__w")
    # copies go round the minority days of a series in order of time
    placed = scan_ordered(few, by, ["date"], ["__one"]).withColumn("__copies", F.ceil((F.col("__need") - F.col("__one_before")) / F.col("__m")).cast("int"))
    copies = placed.where("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    drawn = lambda salt: F.xxhash64(F.lit(seed), F.lit(salt), "__id", "__copy")
    copies = copies.withColumn("__rank", F.pmod(drawn(1), F.least(F.lit(k), F.col("__m") - 1)).cast("int") + 1)
    copies = copies.withColumn("__share", F.pmod(drawn(2), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    both = copies.join(near, (F.col("__id") == F.col("__n")) & (F.col("__rank") == F.col("rank")))
    made = both.select(*by, "date", label, *[(F.get("__v", i) + F.col("__share") * (F.get("__w", i) - F.get("__v", i))).alias(c) for i, c in enumerate(cols)])
    return base.unionByName(made)


# --- models -------------------------------------------------------------------------------------

def _importance(spark: SparkSession, names: Sequence[str], values: Sequence[float]) -> DataFrame:
    pairs = sorted(((n, abs(float(v))) for n, v in zip(names, values)), key=lambda p: (-p[1], p[0]))
    return spark.createDataFrame(pairs, "feature string, importance double")


ROWS_PER_TASK = 50_000


def _packed(rows: DataFrame) -> DataFrame:
    """``rows`` cached in as few partitions as their number asks for: a tree fit runs several jobs a level over them."""
    rows = cut_lineage(rows)
    return rows.coalesce(max(1, -(-rows.count() // ROWS_PER_TASK))).persist()


@dataclass
class Forecaster:
    """Linear (elastic net) and boosted regressors of one target, ``horizon`` rows ahead."""

    target: str = "avg_sentiment"
    horizon: int = 7
    scaler_kind: str = "standard"
    alpha: float = 0.1
    l1: float = 0.5
    rounds: int = 100
    depth: int = 5
    step: float = 0.1
    subsample: float = 1.0
    seed: int = SEED
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    models: dict[str, object] = field(default_factory=dict)
    metrics: dict[str, dict] = field(default_factory=dict)

    def fit(self, train: DataFrame, names: Sequence[str], kinds: Sequence[str] = ("linear", "boosted")) -> Forecaster:
        """Fit on rows with the feature columns and ``label``."""
        rows = self.prepare(train, names)
        self.fit_prepared(rows, kinds)
        rows.unpersist()
        return self

    def prepare(self, train: DataFrame, names: Sequence[str]) -> DataFrame:
        """Learn the scaler and return the scaled rows (label, features), cached: they don't depend on a model's parameters."""
        found = fit_scaler(train, names, self.scaler_kind)
        self.scaler = {c: found[c] for c in names}
        return _packed(_vectorised(train, self.scaler, ["label"]))

    def fit_prepared(self, rows: DataFrame, kinds: Sequence[str] = ("linear", "boosted")) -> Forecaster:
        makers = {
            "linear": LinearRegression(regParam=self.alpha, elasticNetParam=self.l1, maxIter=10_000, standardization=False, labelCol="label"),
            "boosted": GBTRegressor(maxIter=self.rounds, maxDepth=self.depth, stepSize=self.step, subsamplingRate=self.subsample, seed=self.seed, labelCol="label"),
        }
        self.models = {kind: makers[kind].fit(rows) for kind in kinds}
        return self

    def _model(self, kind: str | None):
        if not self.models:
            raise RuntimeError("Model not fitted. Call fit() first.")
        kind = kind or ("boosted" if "boosted" in self.models else "linear")
        return kind, self.models[kind]

    def predict(self, df: DataFrame, kind: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns and ``prediction``; missing features count as 0."""
        _, model = self._model(kind)
        aligned = align_features(df, list(self.scaler), keep)
        return model.transform(_vectorised(aligned, self.scaler, list(keep))).select(*keep, "prediction")

    def predict_both(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns with one prediction column per model, from one pass over the features."""
        self._model(None)
        rows = _vectorised(align_features(df, list(self.scaler), keep), self.scaler, list(keep))
        for kind, model in self.models.items():
            rows = model.transform(rows).withColumnRenamed("prediction", f"{kind}_prediction")
        return rows.drop("features")

    def evaluate(self, test: DataFrame) -> DataFrame:
        """One row per model with MAE, RMSE and MAPE; also kept in ``metrics``."""
        out = None
        for kind in self.models:
            rows = self.predict(test.withColumn("y", F.col("label")), kind, ["y"])
            one = metrics.regression_metrics(rows).select(F.lit(kind).alias("model"), "*")
            out = one if out is None else out.unionByName(one)
        out = cut_lineage(out)
        self.metrics = {r["model"]: {m: r[m] for m in ("mae", "rmse", "mape")} for r in out.toLocalIterator()}
        return out

    def confidence(self, kind: str | None = None) -> float:
        kind, _ = self._model(kind)
        error = self.metrics.get(kind, {}).get("mape")
        return 0.5 if error is None else round(max(0.0, min(1.0, 1 - error / 100)), 2)

    def predict_next_week(self, latest: DataFrame, kind: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
        name, _ = self._model(kind)
        return self.predict(latest, kind, keep).select(
            *keep, F.round("prediction", 4).alias("predicted_value"), F.lit(self.confidence(kind)).alias("confidence"),
            F.lit(self.horizon).alias("forecast_horizon"), F.lit(name).alias("model_used"))

    def importance(self, spark: SparkSession, kind: str | None = None, top: int | None = None) -> DataFrame:
        name, model = self._model(kind)
        values = model.coefficients.toArray() if name == "linear" else model.featureImportances.toArray()
        out = _importance(spark, list(self.scaler), values).orderBy(F.col("importance").desc(), "feature")
        return out if top is None else out.limit(top)

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {k: getattr(self, k) for k in ("target", "horizon", "scaler_kind", "alpha", "l1", "rounds", "depth", "step", "subsample", "seed", "scaler", "metrics")}
        _save(spark, path, self.models, meta)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Forecaster:
        meta, models = _load(spark, path)
        meta["scaler"] = {k: tuple(v) for k, v in meta["scaler"].items()}
        return cls(**meta, models=models)


def sentiment_forecaster(**kw) -> Forecaster:
    return Forecaster(**{"target": "avg_sentiment", "scaler_kind": "robust", **kw})


def volume_forecaster(**kw) -> Forecaster:
    return Forecaster(**{"target": "total_articles", "scaler_kind": "standard", **kw})


@dataclass
class SpikeDetector:
    """Boosted classifier of spike days, with synthetic minority days and a class weight."""

    rounds: int = 100
    depth: int = 5
    step: float = 0.1
    subsample: float = 1.0
    weight: float | None = None
    use_smote: bool = True
    seed: int = SEED
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    class_counts: dict[str, int] = field(default_factory=dict)
    metrics: dict[str, dict] = field(default_factory=dict)
    model: object = None

    def fit(self, train: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> SpikeDetector:
        """Fit on rows with ``date``, the feature columns and a 0/1 ``label``.

        The class weight comes from the counts before balancing, so both corrections apply.
        """
        found = fit_scaler(train, names)
        self.scaler = {c: found[c] for c in names}
        counts = train.agg(F.count_if(F.col("label") == 0).alias("zeros"), F.count_if(F.col("label") == 1).alias("ones")).first()
        self.class_counts = {"0": counts["zeros"], "1": counts["ones"]}
        rows = scale(train.select(*by, "date", "label", *names).na.fill(0, list(names)), self.scaler)
        if self.use_smote and counts["zeros"] and counts["ones"]:
            rows = smote(rows, names, by=by, seed=self.seed)
        weight = self.weight or (counts["zeros"] / counts["ones"] if counts["ones"] and counts["zeros"] else 1.0)
        rows = VectorAssembler(inputCols=list(names), outputCol="features").transform(rows)
        rows = rows.select("features", F.col("label").cast("double").alias("label"), F.when(F.col("label") == 1, weight).otherwise(1.0).alias("weight"))
        rows = _packed(rows)
        self.model = GBTClassifier(maxIter=self.rounds, maxDepth=self.depth, stepSize=self.step, subsamplingRate=self.subsample, seed=self.seed, weightCol="weight").fit(rows)
        rows.unpersist()
        return self

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns with ``probability`` of a spike, ``prediction`` (p >= 0.5) and ``risk_level``."""
        if self.model is None:
            raise RuntimeError("Model not fitted. Call fit() first.")
        rows = _vectorised(align_features(df, list(self.scaler), keep), self.scaler, list(keep))
        out = self.model.transform(rows).select(*keep, vector_to_array("probability")[1].alias("probability"))
        return with_risk(out)

    def evaluate(self, test: DataFrame) -> DataFrame:
        rows = cut_lineage(self.predict(test.withColumn("y", F.col("label")), ["y"]).withColumn("score", F.col("probability")))
        one = metrics.binary_metrics(rows).join(F.broadcast(metrics.roc_auc(rows)), F.lit(True))  # one row each
        one = cut_lineage(one)
        self.metrics = {"boosted": one.first().asDict()}
        return one

    def importance(self, spark: SparkSession) -> DataFrame:
        return _importance(spark, list(self.scaler), self.model.featureImportances.toArray()).orderBy(F.col("importance").desc(), "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        meta = {k: getattr(self, k) for k in ("rounds", "depth", "step", "subsample", "weight", "use_smote", "seed", "scaler", "class_counts", "metrics")}
        _save(spark, path, {"boosted": self.model}, meta)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> SpikeDetector:
        meta, models = _load(spark, path)
        meta["scaler"] = {k: tuple(v) for k, v in meta["scaler"].items()}
        return cls(**meta, model=models["boosted"])


def with_risk(df: DataFrame, high: float = 0.8) -> DataFrame:
    return df.withColumns({"prediction": (F.col("probability") >= 0.5).cast("int"), "risk_level": risk_level(F.col("probability"), high)})


@dataclass
class ClassModel:
    """Multi-class forest of a day's dominant class with balanced weights."""

    trees: int = 150
    depth: int = 3
    seed: int = SEED
    scaler: dict[str, tuple[float, float]] = field(default_factory=dict)
    labels: list[str] = field(default_factory=list)
    metrics: dict[str, dict] = field(default_factory=dict)
    model: object = None

    def fit(self, days: DataFrame, by: Sequence[str] = (), fraction: float = 0.8) -> DataFrame:
        """Fit on the first part of every series and return accuracy and weighted F1 on the rest."""
        names = [c for c in features.CLASS_MODEL_COLUMNS if c in days.columns]
        rows = features.time_split(balanced_weights(days, "dominant_sentiment"), fraction, by)
        index = StringIndexer(inputCol="dominant_sentiment", outputCol="label", stringOrderType="alphabetAsc").fit(rows)
        self.labels = list(index.labels)
        rows = cut_lineage(index.transform(rows).select(*names, "label", "weight", "is_train"))
        train, test = rows.where("is_train"), rows.where("NOT is_train")
        found = fit_scaler(train, names)
        self.scaler = {c: found[c] for c in names}
        ready = _packed(_vectorised(train, self.scaler, ["label", "weight"]))
        self.model = RandomForestClassifier(numTrees=self.trees, maxDepth=self.depth, seed=self.seed, weightCol="weight", labelCol="label").fit(ready)
        ready.unpersist()
        told = self.model.transform(_vectorised(test, self.scaler, ["label"])).select(F.col("label").alias("y"), "prediction")
        out = cut_lineage(metrics.accuracy_and_f1(told))
        self.metrics = {"forest": out.first().asDict()}
        return out

    def predict(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``keep`` columns, predicted class, its probability and the probabilities per class."""
        if self.model is None:
            raise ValueError("Model not fitted yet. Call fit() first.")
        rows = self.model.transform(_vectorised(align_features(df, list(self.scaler), keep), self.scaler, list(keep)))
        p = vector_to_array("probability")
        names = F.array(*[F.lit(c) for c in self.labels])
        return rows.select(*keep, F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_sentiment"),
                           F.array_max(p).alias("confidence"), F.map_from_arrays(names, p).alias("probabilities"))

    def save(self, spark: SparkSession, path: str) -> None:
        _save(spark, path, {"forest": self.model}, {k: getattr(self, k) for k in ("trees", "depth", "seed", "scaler", "labels", "metrics")})

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ClassModel:
        meta, models = _load(spark, path)
        meta["scaler"] = {k: tuple(v) for k, v in meta["scaler"].items()}
        return cls(**meta, model=models["forest"])


# --- recursion over days ------------------------------------------------------------------------

HISTORY = ("positive_pct", "negative_pct", "neutral_pct", "avg_sentiment", "dominant_encoded")


def recent_history(days: DataFrame, by: Sequence[str] = (), n: int = 7) -> DataFrame:
    """One row per series: its last date and its last ``n`` days as an array, oldest first."""
    last = windows.tail(days, n, by)
    packed = last.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("date", *HISTORY))).alias("h"))
    return packed.withColumn("date", F.element_at("h", -1)["date"])


def _deviation(values: Column) -> Column:
    """Sample deviation of an array of numbers."""
    mean = F.aggregate(values, F.lit(0.0), lambda s, x: s + x) / F.size(values)
    squares = F.aggregate(values, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    return F.sqrt(squares / (F.size(values) - 1))


def next_day_features(state: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Model features of the day after ``date`` from the recent history of each series.

    Series with fewer than three days are left out.
    """
    n = F.size("h")
    day = F.date_add("date", 1)

    def back(i: int, c: str) -> Column:
        return F.element_at("h", -i)[c]

    cols: dict[str, Column] = {
        "day_of_week": F.weekday(day), "is_weekend": (F.weekday(day) >= 5).cast("int"), "day_of_month": F.dayofmonth(day)}
    for c in ("positive_pct", "negative_pct", "neutral_pct", "avg_sentiment"):
        for k in (1, 2, 3):
            cols[f"{c}_lag_{k}d"] = back(k, c)
        cols[f"{c}_lag_7d"] = F.when(n >= 7, F.try_element_at("h", F.lit(-7))[c]).when(n > 3, F.element_at("h", 1)[c])
    for k in (3, 7):
        part = F.slice("h", F.greatest(n - (k - 1), F.lit(1)), F.lit(k))

        def mean(c: str, part=part) -> Column:
            return F.aggregate(part, F.lit(0.0), lambda s, x: s + x[c]) / F.size(part)

        for c in ("positive_pct", "negative_pct", "avg_sentiment"):
            cols[f"{c}_rolling_{k}d"] = mean(c)
        cols[f"sentiment_volatility_{k}d"] = _deviation(F.transform(part, lambda x: x["avg_sentiment"]))
    cols["sentiment_momentum"] = back(1, "avg_sentiment") - back(2, "avg_sentiment")
    for c in ("positive", "negative"):
        cols[f"{c}_trend"] = F.when(n >= 4, back(1, f"{c}_pct") - F.try_element_at("h", F.lit(-4))[f"{c}_pct"]).otherwise(0.0)
    for k in (1, 2, 3):
        cols[f"dominant_lag_{k}d"] = back(k, "dominant_encoded")
    ready = state.where(n >= 3)
    return ready.select(*keep, "h", day.alias("date"), *[cols[c].cast("double").alias(c) for c in features.CLASS_MODEL_COLUMNS])


def forecast_classes(model: ClassModel, days: DataFrame, horizon: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """Dominant class of the next ``horizon`` days of every series; each day feeds the next.

    The loop runs over days, not series: a step is one pass over one row per series.
    """
    state = cut_lineage(recent_history(days, by))
    out = None
    for _ in range(horizon):
        feats = next_day_features(state, by)
        step = cut_lineage(model.predict(feats, [*by, "date", "h"]))
        one = step.select(*by, "date", "predicted_sentiment", "confidence", "probabilities")
        out = one if out is None else out.unionByName(one)
        said = F.col("predicted_sentiment")
        sign = F.when(said == "positive", 1).when(said == "negative", -1).otherwise(0)
        new = F.struct(
            F.col("date"), *[F.coalesce(F.try_element_at("probabilities", F.lit(c)), F.lit(0.33)).alias(f"{c}_pct") for c in ("positive", "negative", "neutral")],
            (sign * F.lit(0.3)).alias("avg_sentiment"), sign.alias("dominant_encoded"))
        grown = F.concat(F.col("h"), F.array(new))
        state = step.select(*by, F.slice(grown, F.greatest(F.size(grown) - 6, F.lit(1)), F.lit(7)).alias("h"), "date")
    return out


# --- validation, search, orchestration ----------------------------------------------------------

def cross_validate(fit: Callable[[DataFrame], Callable[[DataFrame], float]], df: DataFrame, k: int = 5, by: Sequence[str] = ()) -> dict:
    """Walk-forward scores: fit on everything earlier, score the next block; mean and population deviation.

    ``df`` may hold the folds already (columns ``fold`` and ``role``).
    """
    folds = df if "fold" in df.columns else cut_lineage(features.walk_forward_folds(df, k, by))
    scores = []
    for i in range(k):
        one = folds.where(F.col("fold") == i)
        scores.append(fit(one.where("role = 'train'"))(one.where("role = 'test'")))
    mean = sum(scores) / k
    return {"mean_score": mean, "std_score": (sum((s - mean) ** 2 for s in scores) / k) ** 0.5, "scores": scores, "n_splits": k}


# Search ranges as (low, high, how numbers are drawn).
SPACES = {
    "boosted": {"rounds": (50, 300, "int"), "depth": (3, 10, "int"), "step": (0.01, 0.3, "real"), "subsample": (0.6, 1.0, "real")},
    "linear": {"alpha": (0.001, 1.0, "log"), "l1": (0.0, 1.0, "real")},
    "spike": {"rounds": (50, 300, "int"), "depth": (3, 10, "int"), "step": (0.01, 0.3, "real"), "subsample": (0.6, 1.0, "real"), "weight": (1.0, 10.0, "real")},
}


def draw(space: dict[str, tuple], trial: int, seed: int = SEED) -> dict:
    rng = random.Random(seed * 1_000_003 + trial)
    out = {}
    for name, (lo, hi, how) in space.items():
        out[name] = rng.randint(lo, hi) if how == "int" else (lo * (hi / lo) ** rng.random() if how == "log" else rng.uniform(lo, hi))
    return out


def _to_unit(space: dict[str, tuple], params: dict) -> np.ndarray:
    """A trial as a point of the unit cube, logarithmic ranges by their logarithm."""
    return np.array([(math.log(params[n] / lo) / math.log(hi / lo)) if how == "log" else (params[n] - lo) / (hi - lo) for n, (lo, hi, how) in space.items()])


def _from_unit(space: dict[str, tuple], point: np.ndarray) -> dict:
    out = {}
    for x, (name, (lo, hi, how)) in zip(np.clip(point, 0.0, 1.0), space.items(), strict=True):
        out[name] = int(round(lo + x * (hi - lo))) if how == "int" else (lo * (hi / lo) ** float(x) if how == "log" else lo + float(x) * (hi - lo))
    return out


def suggest(space: dict[str, tuple], history: Sequence[tuple[dict, float]], trial: int, seed: int = SEED, startup: int = 10, tries: int = 24) -> dict:
    """The next trial of a search that learns from ``history`` (parameters, score; higher is better).

    The first ``startup`` trials are drawn from the whole space. After that the best quarter and the others are two
    densities, sums of bumps around their points and a flat share; of ``tries`` draws around the best quarter the one with the
    greatest ratio of both densities, summed over parameters, is taken.
    """
    if trial < startup or len(history) < 4:
        return draw(space, trial, seed)
    ranked = sorted(history, key=lambda h: -h[1])
    points = np.array([_to_unit(space, p) for p, _ in ranked])
    n = max(2, len(points) // 4)
    good, bad = points[:n], points[n:]
    rng = np.random.default_rng([seed, trial])
    width = max(0.05, len(good) ** -0.5 / 2)
    drawn = good[rng.integers(0, len(good), tries)] + rng.normal(0, width, (tries, points.shape[1]))
    drawn = np.abs(drawn)
    drawn = np.clip(np.where(drawn > 1, 2 - drawn, drawn), 0.0, 1.0)  # mirrored at the borders

    def density(at: np.ndarray, around: np.ndarray) -> np.ndarray:
        bumps = np.exp(-0.5 * ((at[:, None] - around[None]) / width) ** 2) / (width * math.sqrt(2 * math.pi))
        return np.log(0.1 + 0.9 * bumps.mean(axis=1)).sum(axis=1)

    return _from_unit(space, drawn[int(np.argmax(density(drawn, good) - density(drawn, bad)))])


def search(score: Callable[[dict, int], float], space: dict[str, tuple], trials: int = 50, k: int = 5, seed: int = SEED, parallel: int = 4) -> list[dict]:
    """All trials of a search: dicts with ``params``, ``score`` (mean over its folds), ``folds`` (how many it ran) and ``stopped``.

    ``score(params, fold)`` is higher for better. Trials run ``parallel`` at a time, fold by fold. A trial stops after a fold
    if its mean so far is below the median of the finished trials' means over as many folds. The outcome depends on
    the seed alone, not on which job ends first.
    """
    done: list[dict] = []
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        while len(done) < trials:
            history = [(t["params"], t["score"]) for t in done]
            batch = [{"params": suggest(space, history, len(done) + i, seed), "scores": [], "stopped": False} for i in range(min(parallel, trials - len(done)))]
            for fold in range(k):
                live = [t for t in batch if not t["stopped"]]
                for t, value in zip(live, pool.map(lambda t: score(t["params"], fold), live), strict=True):
                    t["scores"].append(value)
                finished = [float(np.mean(t["scores"][: fold + 1])) for t in done if not t["stopped"]]
                if len(finished) >= 4 and fold < k - 1:
                    bar = float(np.median(finished))
                    for t in live:
                        t["stopped"] = float(np.mean(t["scores"])) < bar
            for t in batch:
                t["score"], t["folds"] = float(np.mean(t["scores"])), len(t["scores"])
            done += batch
    return done


def tune(df: DataFrame, names: Sequence[str], kind: str = "linear", trials: int = 50, k: int = 5, by: Sequence[str] = (),
         seed: int = SEED, parallel: int = 4, limits: dict | None = None) -> tuple[dict, list[dict]]:
    """Search of a model's space scored by walk-forward validation: (best parameters, all trials as ``search`` returns them).

    The objective is minus the squared error, or F1 for spikes. Only trials that ran all folds can be the best.
    """
    space = {**SPACES[kind], **(limits or {})}
    folds = cut_lineage(features.walk_forward_folds(df, k, by))  # once for all trials
    parts = [(folds.where((F.col("fold") == i) & (F.col("role") == "train")), folds.where((F.col("fold") == i) & (F.col("role") == "test")).withColumn("y", F.col("label"))) for i in range(k)]
    ready = []
    if kind != "spike":  # a fold is scaled once, not once a trial
        for train, test in parts:
            caster = Forecaster(seed=seed)
            rows = caster.prepare(train, names)
            ready.append((rows, _packed(_vectorised(align_features(test, names, ["y"]), caster.scaler, ["y"]))))

    def score(params: dict, fold: int) -> float:
        if kind == "spike":
            train, test = parts[fold]
            return metrics.binary_metrics(SpikeDetector(**params, seed=seed).fit(train, names, by).predict(test, ["y"])).first()["f1"] or 0.0
        train, test = ready[fold]
        model = Forecaster(**params, seed=seed).fit_prepared(train, [kind]).models[kind]
        return -(metrics.regression_metrics(model.transform(test).select("y", "prediction")).first()["rmse"] ** 2)

    try:
        tried = search(score, space, trials, k, seed, parallel)
    finally:
        for pair in ready:
            for rows in pair:
                rows.unpersist()
    return max((t for t in tried if not t["stopped"]), key=lambda t: t["score"])["params"], tried


def out_of_fold(df: DataFrame, names: Sequence[str], make: Callable[[], Forecaster], kind: str = "linear", k: int = 5, by: Sequence[str] = ()) -> DataFrame:
    """(by, date, fold, prediction, actual): every day of a walk-forward test block, predicted by a model of all earlier days."""
    folds = cut_lineage(features.walk_forward_folds(df, k, by))
    out = None
    for i in range(k):
        one = folds.where(F.col("fold") == i)
        model = make().fit(one.where("role = 'train'"), names, [kind])
        made = model.predict(one.where("role = 'test'").withColumn("actual", F.col("label")), kind, [*by, "date", "actual"])
        made = made.select(*by, "date", F.lit(i).alias("fold"), "prediction", "actual")
        out = made if out is None else out.unionByName(made)
    return cut_lineage(out)


def store_predictions(spark: SparkSession, path: str, made: DataFrame, days: DataFrame, model: str, horizon: int = 7, by: Sequence[str] = ()) -> None:
    """Upsert predictions (by, date, prediction) under the day they are for: ``horizon`` rows of ``days`` (by, date) later.

    The store is keyed by model, series and day, in folders by day; a later run replaces its days.
    """
    ahead = days.select(*by, "date", F.lead("date", horizon).over(windows.series_window(by)).alias("target_date"))
    rows = made.select(*by, "date", "prediction").join(ahead, [*by, "date"]).where(F.col("target_date").isNotNull())
    rows = rows.select(*by, F.lit(model).alias("model"), F.col("date").alias("made_on"), F.col("target_date").alias("date"), "prediction")
    KeyedTable(spark, path, ("model", *by, "date"), "date").upsert(rows, order="made_on")


def stored_predictions(spark: SparkSession, path: str, model: str, by: Sequence[str] = ()) -> DataFrame | None:
    """(by, date, prediction, made_on) of one model."""
    rows = KeyedTable(spark, path, ("model", *by, "date"), "date").read()
    return None if rows is None else rows.where(F.col("model") == model).select(*by, "date", "prediction", "made_on")


@dataclass
class Trained:
    sentiment: Forecaster
    volume: Forecaster
    spike: SpikeDetector
    history: DataFrame

    def save(self, spark: SparkSession, path: str) -> None:
        self.sentiment.save(spark, f"{path}/sentiment")
        self.volume.save(spark, f"{path}/volume")
        self.spike.save(spark, f"{path}/spike")
        self.history.write.mode("overwrite").parquet(f"{path}/training_history")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Trained:
        return cls(Forecaster.load(spark, f"{path}/sentiment"), Forecaster.load(spark, f"{path}/volume"),
                   SpikeDetector.load(spark, f"{path}/spike"), spark.read.parquet(f"{path}/training_history"))


def train_all(frame: DataFrame, by: Sequence[str] = (), rounds: int = 100, horizon: int = 7, same_day: bool = False) -> Trained:
    """Fit the sentiment, volume and spike models on a feature frame and evaluate each on the last fifth."""
    history, fitted = None, {}
    for name, target, maker in (("sentiment", "avg_sentiment", sentiment_forecaster), ("volume", "total_articles", volume_forecaster)):
        rows = cut_lineage(features.trainer_matrix(frame, target, horizon=horizon, same_day=same_day, by=by))
        names = [c for c in rows.columns if c not in (*by, "date", "label", "is_train")]
        model = maker(horizon=horizon, rounds=rounds).fit(rows.where("is_train"), names)
        scored = model.evaluate(rows.where("NOT is_train")).select(F.concat(F.lit(f"{name}_"), "model").alias("model"), F.to_json(F.struct("mae", "rmse", "mape")).alias("metrics"))
        history = scored if history is None else history.unionByName(scored)
        fitted[name] = model
    labelled = frame.withColumn("__spike", F.col("spike_label"))
    rows = cut_lineage(features.trainer_matrix(labelled, "__spike", horizon=horizon, same_day=same_day, by=by))
    names = [c for c in rows.columns if c not in (*by, "date", "label", "is_train", "__spike")]
    spike = SpikeDetector(rounds=rounds).fit(rows.where("is_train"), names, by)
    scored = spike.evaluate(rows.where("NOT is_train"))
    history = history.unionByName(scored.select(F.lit("spike_boosted").alias("model"), F.to_json(F.struct("*")).alias("metrics")))
    return Trained(fitted["sentiment"], fitted["volume"], spike, history.withColumn("trained_at", F.current_timestamp()))


def predictions_all(trained: Trained, latest: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per series: struct of the sentiment, volume and spike predictions."""
    keep = list(by)
    keys = keep or ["__all"]
    latest = latest if keep else latest.withColumn("__all", F.lit(0))
    week = [m.predict_next_week(latest, keep=keys) for m in (trained.sentiment, trained.volume)]
    fields = ("predicted_value", "confidence", "forecast_horizon", "model_used")
    a = week[0].select(*keys, F.struct(*fields).alias("sentiment"))
    b = week[1].select(*keys, F.struct(*fields).alias("volume"))
    c = trained.spike.predict(latest, keys).select(*keys, F.struct("probability", "prediction", "risk_level").alias("spike"))
    for other, made in ((b, "volume"), (c, "spike")):
        other = other.toDF(*[f"__r{i}" for i in range(len(keys))], made)
        same = F.lit(True)
        for i, k in enumerate(keys):
            same = same & F.col(k).eqNullSafe(F.col(f"__r{i}"))
        a = a.join(other, same).drop(*[f"__r{i}" for i in range(len(keys))])
    return a.select(*keep, "sentiment", "volume", "spike")


def weekly_prediction(trained: Trained, daily_frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Next-week class and volume from the latest row of each series."""
    return predictions_all(trained, windows.latest_row(daily_frame, by), by).select(*by, "sentiment", "volume")


def spike_probability(trained: Trained, daily_frame: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return trained.spike.predict(windows.latest_row(daily_frame, by), [*by, "date"])


def train_class_model(articles: DataFrame, by: Sequence[str] = (), horizon: int = 7, trees: int = 150) -> tuple[ClassModel, DataFrame]:
    """Class features, fit, and the forecast of the coming days."""
    days = cut_lineage(features.classifier_features(articles, by))
    model = ClassModel(trees=trees)
    model.fit(days, by)
    return model, forecast_classes(model, days, horizon, by)


# --- storage ------------------------------------------------------------------------------------

def _save(spark: SparkSession, path: str, models: dict, meta: dict) -> None:
    if not models or any(m is None for m in models.values()):
        raise RuntimeError("Model not fitted. Call fit() first.")
    for kind, model in models.items():
        PipelineModel(stages=[model]).write().overwrite().save(f"{path}/{kind}")
    row = [(VERSION, json.dumps(meta), json.dumps(list(models)))]
    spark.createDataFrame(row, "version string, parameters string, models string").coalesce(1).write.mode("overwrite").parquet(f"{path}/metadata")


def _load(spark: SparkSession, path: str) -> tuple[dict, dict]:
    row = spark.read.parquet(f"{path}/metadata").first()
    models = {kind: PipelineModel.load(f"{path}/{kind}").stages[0] for kind in json.loads(row["models"])}
    return json.loads(row["parameters"]), models


def daily_frame(articles: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Feature frame of an article table without topic columns."""
    return features.create_all_features(daily.daily_base(articles, by), is_aggregated=True, by=by)

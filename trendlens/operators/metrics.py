"""Forecast and classification metrics as aggregates over a prediction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.relational import ordered_prefix_sums, share


def regression_metrics(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """MAE and RMSE (4 places) and MAPE (2 places, over non-zero actuals, NULL when there is none)."""
    err = F.col(y).cast("double") - F.col(pred).cast("double")
    return df.groupBy(*by).agg(
        F.round(F.avg(F.abs(err)), 4).alias("mae"), F.round(F.sqrt(F.avg(err * err)), 4).alias("rmse"),
        F.round(F.avg(F.when(F.col(y) != 0, F.abs(err / F.nullif(F.col(y).cast("double"), F.lit(0.0))))) * 100, 2).alias("mape"))


def mape(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    return regression_metrics(df, y, pred, by).select(*by, "mape")


def binary_metrics(df: DataFrame, y: str = "y", pred: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, precision, recall and F1 of class 1; 0 where undefined."""
    hit, said = F.col(y) == 1, F.col(pred) == 1
    c = df.groupBy(*by).agg(F.count_if(hit & said).alias("tp"), F.count_if(~hit & said).alias("fp"),
                            F.count_if(hit & ~said).alias("fn"), F.count_if(~hit & ~said).alias("tn"))
    c = c.select("*", share(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"), share(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
    return c.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def roc_auc(df: DataFrame, y: str = "y", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve with ties counted half; NULL with one class only.

    Rows are counted per distinct score first; ranks come from two-level prefix sums, so no task
    sorts the whole table.
    """
    by = list(by)
    counts = df.groupBy(*by, F.col(score).cast("double").alias("s")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg"))
    ranked = ordered_prefix_sums(counts, by, "s", ["neg"])
    wins = F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.groupBy(*by).agg(F.try_divide(wins, pairs).alias("roc_auc"))


def confusion_matrix(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(y).alias("actual"), F.col(pred).alias("predicted")).agg(F.count(F.lit(1)).alias("count"))


def classification_report(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then the macro and the weighted mean."""
    cells = confusion_matrix(df, y, pred)
    # a cell speaks for the class that was meant and for the class that was named
    long = cells.select(F.explode(F.array(
        F.struct(F.col("actual").cast("string").alias("class"), F.col("count").alias("support"), F.lit(0).cast("long").alias("named"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").cast("string").alias("class"), F.lit(0).cast("long").alias("support"), F.col("count").alias("named"),
                 F.lit(0).cast("long").alias("tp")))).alias("x")).select("x.*")
    per = long.groupBy("class").agg(F.sum("support").alias("support"), F.sum("named").alias("named"), F.sum("tp").alias("tp"))
    per = per.select("class", share(F.col("tp"), F.col("named")).alias("precision"), share(F.col("tp"), F.col("support")).alias("recall"), "support")
    per = per.withColumn("f1", share(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))
    per = per.select("class", "precision", "recall", "f1", "support")
    names = ("precision", "recall", "f1")
    macro = per.agg(F.lit("macro avg").alias("class"), *[F.avg(n).alias(n) for n in names], F.sum("support").alias("support"))
    weighted = per.agg(F.lit("weighted avg").alias("class"), *[share(F.sum(F.col(n) * F.col("support")), F.sum("support")).alias(n) for n in names],
                       F.sum("support").alias("support"))
    return per.unionByName(macro).unionByName(weighted)


def accuracy_and_f1(df: DataFrame, y: str = "y", pred: str = "prediction") -> DataFrame:
    acc = df.agg(share(F.count_if(F.col(y) == F.col(pred)), F.count(F.lit(1))).alias("accuracy"))
    f1 = classification_report(df, y, pred).where(F.col("class") == "weighted avg").select(F.col("f1").alias("f1_weighted"))
    return acc.join(F.broadcast(f1), F.lit(True))  # one row each


def collapse_check(df: DataFrame, pred: str = "prediction") -> DataFrame:
    """Do all predictions name one class?"""
    classes = df.select(pred).distinct().agg(F.count(F.lit(1)).alias("classes"))
    return classes.select("classes", (F.col("classes") == 1).alias("collapsed"))


def append_history(metrics: DataFrame, path: str, model: str) -> None:
    """Append a metric row with the model name and the time of measurement."""
    metrics.select(F.lit(model).alias("model"), F.current_timestamp().alias("measured_at"), "*").write.mode("append").parquet(path)

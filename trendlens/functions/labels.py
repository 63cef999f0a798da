"""Column expressions for class labels, scores, bands and notes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CLASSES = ("negative", "neutral", "positive")


def sentiment_numeric(col: Column, unknown: float | None = 0.0) -> Column:
    """-1 / 0 / 1; other labels give ``unknown``."""
    known = F.when(col == "negative", F.lit(-1.0)).when(col == "neutral", F.lit(0.0)).when(col == "positive", F.lit(1.0))
    return known if unknown is None else known.otherwise(F.lit(float(unknown)))


def normalise_label(raw: Column) -> Column:
    low = F.lower(raw)
    return F.when(F.contains(low, F.lit("pos")), "positive").when(F.contains(low, F.lit("neg")), "negative").otherwise("neutral")


def numeric_to_class(col: Column, cut: float = 0.1) -> Column:
    return F.when(col > cut, "positive").when(col < -cut, "negative").when(col.isNotNull(), "neutral")


def tier(col: Column, steps: list[tuple[float, str]], otherwise: str, strict: bool = False) -> Column:
    """First label whose bound is reached (or exceeded when ``strict``), bounds given high to low."""
    expr = None
    for bound, label in steps:
        test = (col > bound) if strict else (col >= bound)
        expr = F.when(test, label) if expr is None else expr.when(test, label)
    return expr.otherwise(otherwise)


def confidence_band(col: Column) -> Column:
    return tier(col, [(0.8, "high"), (0.6, "medium")], "low")


def risk_level(p: Column, high: float = 0.8) -> Column:
    return tier(p, [(high, "HIGH"), (0.5, "MEDIUM"), (0.3, "LOW")], "MINIMAL")


def similarity_category(score: Column, strong: str = "semantic_copy", weak: str = "paraphrased",
                        hi: float = 0.85, lo: float = 0.70) -> Column:
    return F.when(score >= hi, strong).when(score >= lo, weak).otherwise("original")


def copy_ratio_label(ratio: Column) -> Column:
    return F.when(ratio < 0.10, "Excellent").when(ratio < 0.25, "Moderate").when(ratio < 0.40, "High").otherwise("Very High")


def direction(delta: Column, cut: float, up: str, down: str, flat: str = "STABLE") -> Column:
    return F.when(delta > cut, up).when(delta < -cut, down).otherwise(flat)


def dominant_balanced(pos: Column, neg: Column, neu: Column, score: Column) -> Column:
    """Class of a day from its shares; the order of the rules matters."""
    top = F.greatest(pos, neu, neg)
    return (
        F.when((pos == top) & (score > 0.05), "positive")
        .when((neg == top) & (score < -0.05), "negative")
        .when((neu == top) & (neu > pos + 0.10) & (neu > neg + 0.10), "neutral")
        .when(score > 0.08, "positive")
        .when(score < -0.08, "negative")
        .otherwise("neutral")
    )


def softmax_pick(logits: list[Column], labels: tuple[str, ...] = CLASSES) -> tuple[Column, Column]:
    """(label of the largest logit, its softmax probability rounded to 4 places)."""
    top = F.greatest(*logits)
    total = reduce(lambda a, b: a + b, [F.exp(x - top) for x in logits])
    label = None
    for x, name in zip(logits, labels):
        label = F.when(x == top, name) if label is None else label.when(x == top, name)
    return label, F.round(F.lit(1.0) / total, 4)


def spread_note(is_original: Column, category: Column, source: Column, score: Column, copies: Column) -> Column:
    """Sentence shown next to an article about its place in the spread of a story."""
    pct = F.concat(F.round(score * 100, 0).cast("int").cast("string"), F.lit("%"))
    return (
        F.when(~is_original & (category == "exact_copy"),
               F.concat(F.lit("Exact Copy - Same title as article from "), source))
        .when(~is_original & (category == "semantic_copy"),
              F.concat(F.lit("Semantic Copy - "), pct, F.lit(" similar to article from "), source))
        .when(~is_original & (category == "paraphrased"),
              F.concat(F.lit("Paraphrased - "), pct, F.lit(" similar to article from "), source))
        .when(is_original & (copies > 0),
              F.concat(F.lit("Original Article - Copied by "), copies.cast("string"), F.lit(" other sources")))
    )

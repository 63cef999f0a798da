"""Toxicity score by a logistic classifier with counterfactual regularisation.

Features of a text are the presence of words and of word beginnings (4 to 8 letters, for inflected words),
chosen by the z-value of their log-odds in the labelled rows, the words of the identity list, and whether any
feature with a very high z-value is there. For every labelled text that mentions an identity term a
counterfactual is made: the term swapped for another one of its group. The fit pays for score changes between
a text and its counterfactual, so that the mention of a group alone moves no score.

Labels of rows with crc32(doc_id as text) mod 3 = 1 are held out: neither the features nor the fit see them.
Only the text enters a score. Fitted on at most ``max_labelled`` labelled rows (drawn by a hash of doc_id; the
feature statistics are counted in Spark), applied to every whole text in one map-only pass.

Null text is empty and has the score of a text without any feature. Several label rows of a doc_id vote, ties
count as toxic. With labels of one class only, or none, every score is the share of toxic labels (0 if none).
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches, bounded_rows, byte_texts, cut_lineage, pieces, sigmoid

WORD = re.compile(r"[^\W\d_]+")
BEGINNINGS = range(4, 9)
# each line is a group of interchangeable terms
IDENTITY_GROUPS = [
    line.split()
    for line in (
        "christian muslim jewish hindu buddhist sikh atheist catholic protestant",
        "christians muslims jews hindus buddhists sikhs atheists catholics protestants",
        "black white asian african latino hispanic arab indigenous european american",
        "woman man girl boy female male",
        "women men girls boys females males",
        "gay lesbian straight bisexual transgender queer heterosexual",
        "german french english spanish italian turkish polish russian chinese mexican",
        "deaf blind disabled autistic paralyzed able",
        "young old elderly teenage",
        "immigrant refugee foreigner citizen",
        "immigrants refugees foreigners citizens",
    )
]
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}


def words_of(text: str) -> set[str]:
    return set(WORD.findall(text.lower()))


def features(words: set[str]) -> set[str]:
    """The words and, marked by a star, their beginnings."""
    return words.union(*({w[:k] + "*" for w in words if len(w) >= k} for k in BEGINNINGS))


@dataclass(frozen=True)
class Model:
    index: dict[str, int] = field(default_factory=dict)
    strong: frozenset[str] = frozenset()
    weights: np.ndarray | None = None  # by feature, then any strong feature, then the intercept
    base: float = 0.0

    def vector(self, words: set[str]) -> list[int]:
        found = [i for w in words if (i := self.index.get(w)) is not None]
        return found + [len(self.index)] if not self.strong.isdisjoint(words) else found

    def _lookup(self, text: str) -> set[str]:
        """Features of the text that the model knows."""
        index, out = self.index, set()
        for w in words_of(text):
            if w in index:
                out.add(w)
            for k in BEGINNINGS:
                if len(w) >= k and (p := w[:k] + "*") in index:
                    out.add(p)
        return out

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.base
        return float(sigmoid(np.array(sum(self.weights[i] for i in self.vector(self._lookup(text))) + self.weights[-1])))


def held_out(doc_id) -> "F.Column":
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _statistics(train: DataFrame) -> DataFrame:
    """(feature, toxic, clean): numbers of labelled texts with the feature; counted per batch, then summed."""

    def run(it):
        for batch in pieces(it):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for text, toxic in zip(byte_texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts[toxic].update(features(words_of(text.decode("utf-8", "replace"))))
            names = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([counts[1][n] for n in names], pa.int64()), pa.array([counts[0][n] for n in names], pa.int64())], names=["feature", "toxic", "clean"])

    return train.select("text", "toxic").mapInArrow(run, "feature string, toxic long, clean long").groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit(docs: DataFrame, labels: DataFrame, max_labelled: int = 20_000, max_features: int = 500, swap_penalty: float = 10.0, ridge: float = 0.05) -> Model:
    """``labels`` has (doc_id, toxic 0/1)."""
    votes = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
    votes = cut_lineage(bounded_rows(votes.where(~held_out(F.col("doc_id"))), "doc_id", max_labelled))
    train = cut_lineage(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(votes), "doc_id"))  # votes are bounded by max_labelled
    n = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    if len(n) < 2:
        return Model(base=1.0 if n.get(1) else 0.0)
    odds = lambda c, k: F.log((F.col(c) + 0.5) / (F.lit(float(n[k]) + 0.5) - F.col(c)))
    z = (odds("toxic", 1) - odds("clean", 0)) / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    ranked = _statistics(train).withColumn("z", z).where("abs(z) >= 3").orderBy(F.desc(F.abs("z")), "feature").limit(max_features)
    chosen = ranked.select("feature", "z").collect()
    terms = sorted({r.feature for r in chosen} | set(SWAP))
    strong = frozenset(r.feature for r in chosen if r.z >= 6)
    model = Model({t: i for i, t in enumerate(terms)}, strong)
    x, y, swaps = _examples(train, model)
    return Model(model.index, strong, _fit(x, y, swaps, swap_penalty, ridge))


def _examples(train: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows and labels of the training texts, and the differences to their counterfactuals."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, other = [], []
        for text in byte_texts(batch.column(1)):
            words = words_of(text.decode("utf-8", "replace"))
            own.append(model.vector(features(words)))
            swapped = {SWAP.get(w, w) for w in words}
            other.append(model.vector(features(swapped)) if swapped != words else None)
        kind = pa.list_(pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(own, kind), pa.array(other, kind)], names=["doc_id", "toxic", "own", "other"])

    rows = train.select("doc_id", "text", "toxic").mapInArrow(batches(run), "doc_id long, toxic int, own array<int>, other array<int>").orderBy("doc_id").toArrow().to_pylist()
    width = len(model.index) + 1
    x = np.zeros((len(rows), width), np.float32)
    pairs = []
    for i, r in enumerate(rows):
        x[i, r["own"]] = 1
        if r["other"] is not None:
            gone = np.zeros(width, np.float32)
            gone[r["other"]] = 1
            pairs.append(x[i] - gone)
    return x, np.array([r["toxic"] for r in rows], float), np.array(pairs, np.float32).reshape(-1, width)


def _fit(x: np.ndarray, y: np.ndarray, swaps: np.ndarray, swap_penalty: float, ridge: float, steps: int = 60) -> np.ndarray:
    """Newton steps on the log-loss + ridge + swap_penalty x squared change of the log-odds over all swaps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    extra = np.diag(np.full(x.shape[1], ridge))
    extra[-1, -1] = 1e-6
    extra[:-1, :-1] += 2 * swap_penalty * (swaps.T @ swaps).astype(float)
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + extra @ w
        hess = (x * np.sqrt(p * (1 - p))[:, None].astype(np.float32)).astype(np.float32)
        move = np.linalg.solve((hess.T @ hess).astype(float) + extra, grad)
        w -= move * min(1.0, 3.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-5:
            break
    return w


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = [model.score(t.decode("utf-8", "replace")) for t in byte_texts(batch.column(2))]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    own = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string"))
    return own.mapInArrow(batches(run), "doc_id long, held_out boolean, score double, predicted int")

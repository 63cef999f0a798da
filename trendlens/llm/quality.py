"""Quality classifier by co-training on two views of a document.

Text view: what the words and characters look like. Metadata view: source, language, declared length and
line layout. Each view has its own ridge logistic regression. In every round each classifier scores the
documents without a label and hands its most confident ones (calibrated probability of its verdict at least
``sure``), with that verdict as label, to the other view's training set. Views are calibrated on labelled
rows they aren't trained on (a fold chosen by crc32 of the doc_id); at the end the calibrated log-odds are
added up, the prior counted once.

The features of all documents are made in one pass; models are fitted on the driver on at most
``max_labelled`` labelled rows plus the pseudo-labels (``picks`` a class, view and round). Scoring covers
every document, inside the tasks. A filter scores and drops rows in one pass, so texts are never shuffled.

Null text counts as empty, null source or language is a value of its own. Labels: several rows of a doc_id
are one vote each, ties count as good; labels that are null or for unknown documents are ignored. Without
labels of both classes there is nothing to learn: every score is 1 and every document stays.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import batches, bounded_rows, byte_texts, cut_lineage, fit_logistic, pass_through, sigmoid

TEXT_DIM, META_DIM = 24, 64
_KIND = np.full(256, 6, np.uint8)  # 6: other symbols
for _i, _chars in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c", b"\n", b".,;:?'\"-()")):
    _KIND[list(_chars)] = _i
_KIND[128:] = 0
_ALNUM = np.isin(_KIND, (0, 1, 2))


def text_view(text: bytes) -> np.ndarray:
    """Shares of character kinds, word lengths, repetition and letter case, over the whole text."""
    out = np.zeros(TEXT_DIM, np.float32)
    n = len(text)
    if not n:
        return out
    hist = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = np.bincount(_KIND, weights=hist, minlength=7) / n
    out[:7] = np.sqrt(share)
    p = hist[hist > 0] / n
    out[7] = -(p * np.log2(p)).sum()
    out[8], out[9] = np.sqrt(hist[33] / n), np.sqrt(hist[124] / n)
    words = text.split()
    m = len(words)
    if not m:
        return out
    sizes = np.fromiter(map(len, words), np.int64, m)
    out[10], out[11], out[12] = np.log1p(m), sizes.mean(), np.log1p(sizes.std())
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    out[13], out[14] = len(seen) / m ** 0.85, max(seen.values()) / m
    pairs = len(set(zip(words, words[1:], words[2:], strict=False))) if m > 2 else 1
    out[15] = pairs / max(1, m - 2)
    lines = [x for x in text.split(b"\n") if x.strip()]
    out[16] = len(set(lines)) / max(1, len(lines))
    out[17] = sum(w.isupper() for w in words) / m
    tails = np.fromiter((w[-1] for w in words), np.uint8, m)
    out[18] = (~_ALNUM[tails]).mean()
    twice = np.fromiter((len(w) > 1 and not _ALNUM[w[-1]] and not _ALNUM[w[-2]] for w in words), bool, m)
    out[19] = twice.mean()
    out[20], out[21] = (sizes == 1).mean(), (sizes > 24).mean()
    out[22] = np.sqrt(sum(a == b for a, b in zip(words, words[1:], strict=False)) / m)
    signs = n - hist[_ALNUM].sum() - hist[[9, 10, 11, 12, 13, 32]].sum() - hist[list(b".,;:?'\"-()")].sum()
    out[23] = np.log1p(100 * signs / m)
    return out


def meta_view(source: str | None, lang: str | None, declared: int | None, text: bytes) -> np.ndarray:
    """Hashed source and language, declared length, line layout."""
    out = np.zeros(META_DIM, np.float32)
    out[zlib.crc32(b"s" + ("?" if source is None else "=" + source).encode()) % 32] = 1
    out[32 + zlib.crc32(b"l" + ("?" if lang is None else "=" + lang).encode()) % 16] = 1
    lines = text.count(b"\n") + 1
    out[48] = np.log1p(max(0, declared or 0)) / 8
    out[49] = declared is None
    out[50] = np.log1p(lines) / 4
    out[51] = np.log1p(len(text) / lines) / 6
    out[52 + min(11, int(np.log2(1 + max(0, declared or 0)) // 1.5))] = 1
    return out


@dataclass(frozen=True)
class Model:
    """Both views' standardised weights, their calibration (slope, offset) and the log-odds of the prior."""

    views: tuple[tuple[np.ndarray, np.ndarray, np.ndarray], ...] = ()
    calibration: tuple[tuple[float, float], ...] = ()
    prior: float = 0.0

    def odds(self, view: int, x: np.ndarray) -> np.ndarray:
        mean, std, w = self.views[view]
        return np.clip((x - mean) / std, -8, 8) @ w[:-1] + w[-1]

    def score(self, text: np.ndarray, meta: np.ndarray) -> np.ndarray:
        if not self.views:
            return np.ones(len(text))
        total = np.full(len(text), -self.prior)
        for view, x in enumerate((text, meta)):
            slope, offset = self.calibration[view]
            total += slope * self.odds(view, x) + offset
        return sigmoid(total)


def _both(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    texts = byte_texts(batch.column(batch.schema.get_field_index("text")))
    rest = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("source", "lang", "n_chars")]
    return np.array([text_view(t) for t in texts]), np.array([meta_view(s, g, n, t) for s, g, n, t in zip(*rest, texts, strict=True)])


def _vectors(x: np.ndarray) -> pa.Array:
    flat = pa.array(np.ascontiguousarray(x, np.float32).ravel())
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), flat)


def _inputs(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("source").cast("string"), F.col("lang").cast("string"), F.col("n_chars").cast("long"))


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, text_view, meta_view) of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = _both(batch)
        return pa.RecordBatch.from_arrays([batch.column(0), _vectors(a), _vectors(b)], names=["doc_id", "text_view", "meta_view"])

    return _inputs(docs).mapInArrow(batches(run), "doc_id long, text_view array<float>, meta_view array<float>")


def _collect(df: DataFrame, *more: str) -> tuple[np.ndarray, ...]:
    rows = df.select("doc_id", "text_view", "meta_view", *more).orderBy("doc_id", "text_view").toArrow()
    stack = lambda c, k: rows.column(c).combine_chunks().flatten().to_numpy().reshape(-1, k).astype(np.float64)
    return (stack("text_view", TEXT_DIM), stack("meta_view", META_DIM), *(rows.column(c).to_numpy() for c in more))


def co_train(docs: DataFrame, labels: DataFrame, rounds: int = 3, picks: int = 200, sure: float = 0.97, max_labelled: int = 20_000, fold: int = 5) -> Model:
    """Fit both views; ``labels`` has (doc_id, quality 0/1). One label fold of ``fold`` is kept for calibration."""
    votes = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    votes = votes.agg((F.avg("quality") >= 0.5).cast("int").alias("good"))
    made = features(docs).join(votes, "doc_id", "left")
    made = cut_lineage(made.withColumn("fold", F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(fold))))
    known, pool = bounded_rows(made.where("good IS NOT NULL"), "doc_id", max_labelled), made.where("good IS NULL")
    text, meta, good, folds = _collect(known, "good", "fold")
    train = folds != 0
    if len(set(good[train])) < 2 or len(set(good[~train])) < 2:
        return Model()
    views = [text[train], meta[train]]
    sets = [[(x, good[train].astype(float))] for x in views]
    share, bar = good.mean(), float(np.log(sure / (1 - sure)))
    prior = float(np.log(share / (1 - share)))
    for r in range(rounds + 1):
        fitted = []
        for parts in sets:
            x, y = np.vstack([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            mean, std = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
            fitted.append((mean, std, fit_logistic(np.clip((x - mean) / std, -8, 8), y, penalty=3.0)))
        model = Model(tuple(fitted))
        calibration = []
        for view, x in enumerate((text[~train], meta[~train])):
            w = fit_logistic(model.odds(view, x)[:, None], good[~train].astype(float), penalty=1e-3)
            calibration.append((max(0.0, float(w[0])), float(w[1])))
        model = Model(model.views, tuple(calibration), prior)
        if r == rounds:
            return model
        scored = cut_lineage(_pool_odds(pool, model))
        for view, name in enumerate(("text_odds", "meta_odds")):
            for label in (0, 1):
                certain = F.col(name) <= -bar if label == 0 else F.col(name) >= bar
                top = scored.where(certain).orderBy(F.col(name) if label == 0 else F.desc(name), "doc_id").limit(picks)
                found = _collect(top)
                sets[1 - view].append((found[1 - view], np.full(len(found[0]), float(label))))
    raise AssertionError("unreachable")


def _pool_odds(pool: DataFrame, model: Model) -> DataFrame:
    """Calibrated log-odds of both views for the documents without a label."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        stack = lambda c, k: batch.column(batch.schema.get_field_index(c)).flatten().to_numpy().reshape(-1, k)
        odds = [model.calibration[v][0] * model.odds(v, stack(c, k)) + model.calibration[v][1] for v, c, k in ((0, "text_view", TEXT_DIM), (1, "meta_view", META_DIM))]
        return pass_through(batch, text_odds=pa.array(odds[0]), meta_odds=pa.array(odds[1]))

    kept = pool.select("doc_id", "text_view", "meta_view")
    return kept.mapInArrow(batches(run), "doc_id long, text_view array<float>, meta_view array<float>, text_odds double, meta_odds double")


def score(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """(doc_id, text_score, meta_score, score, keep) of every document."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = _both(batch)
        total = model.score(a, b)
        single = [sigmoid(model.calibration[v][0] * model.odds(v, x) + model.calibration[v][1]) if model.views else total for v, x in enumerate((a, b))]
        return pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (*single, total, total >= threshold))], names=["doc_id", "text_score", "meta_score", "score", "keep"])

    return _inputs(docs).mapInArrow(batches(run), "doc_id long, text_score double, meta_score double, score double, keep boolean")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that the model keeps, all columns as they are, in one pass."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array(model.score(*_both(batch)) >= threshold))

    return docs.mapInArrow(batches(run), docs.schema)

"""Extractive summaries and their quality."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.functions.text import collapse_ws, flat_word_count, lead, text_or_empty, word_count, words
from trendlens.operators.terms import first_and_counts, lists, with_frequencies
from trendlens.session import stage_table

SENTENCE = r"[^.!?]+[.!?]*"


def _input(df: DataFrame, min_words: int, max_chars: int | None) -> Column:
    text = text_or_empty(F.col("text"))
    if "content" in df.columns:
        text = F.when(text == "", text_or_empty(F.col("content"))).otherwise(text)
    return F.when(word_count(text) >= min_words, lead(text, max_chars)).otherwise("")


def summary_input(df: DataFrame, min_words: int = 30, max_chars: int | None = None) -> DataFrame:
    """Add ``summary_input``: text (or content) of at least ``min_words`` words, with ``max_chars`` only its start; else empty."""
    return df.withColumn("summary_input", _input(df, min_words, max_chars))


def is_blank(col: Column) -> Column:
    return col.isNull() | (collapse_ws(text_or_empty(col)) == "")


def summarise(df: DataFrame, max_words: int = 130, min_words: int = 30, max_chars: int | None = None, id_col: str = "article_id") -> DataFrame:
    """Add ``summary``: the sentences with the highest mean TF-IDF up to a word budget, in text order.

    Articles below ``min_words`` words get an empty summary. The best sentence always stays. Terms are counted inside the row,
    known by 64-bit hashes; a sentence leaves its row only as numbers.
    """
    split = F.filter(F.transform(F.regexp_extract_all(collapse_ws(_input(df, min_words, max_chars)), F.lit(SENTENCE), 0), lambda s: F.trim(s)), lambda s: s != "")
    # a one-element explode keeps the optimizer from splitting a text once for every use
    rows = df.select(F.col(id_col).alias("id"), F.explode(F.array(split)).alias("sentences")).where(F.size("sentences") > 0)
    tokens = F.transform("sentences", lambda s: F.transform(words(s), lambda w: F.xxhash64(w)))
    rows = rows.select("id", tokens.alias("tokens"), F.transform("sentences", lambda s: flat_word_count(s).cast("int")).alias("lengths"))
    kind = rows.schema["id"].dataType.simpleString()
    rows = stage_table(rows.mapInArrow(_sentence_terms, f"id {kind}, hashes array<long>, tf array<int>, at array<int>, sizes array<int>, lengths array<int>"), "sentences")
    total = rows.select("id").distinct().count()
    picked = with_frequencies(rows, "id").mapInArrow(_best_sentences(total, max_words), f"id {kind}, picked array<int>")
    picked = picked.groupBy("id").agg(F.min("picked").alias("__picked"))
    joined = df.drop("summary").join(picked, F.col(id_col) == F.col("id"), "left")
    # the outer transform splits the text once for all picked sentences
    made = F.transform(F.array(split), lambda s: F.array_join(F.transform("__picked", lambda i: F.get(s, i)), " "))[0]
    return joined.withColumn("summary", F.when(F.col("__picked").isNotNull(), made).otherwise("")).drop("id", "__picked")


def _sentence_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (id, tokens by sentence, lengths): the different terms with their counts, the term of each token and the tokens of each sentence."""
    for batch in batches:
        tokens, n = batch.column("tokens"), batch.num_rows
        sentences, sizes = tokens.flatten(), np.asarray(tokens.value_lengths())
        each = np.asarray(sentences.value_lengths())
        row, term = np.repeat(np.repeat(np.arange(n), sizes), each), sentences.flatten().to_numpy()
        first, tf, at = first_and_counts(row, term)
        at = at - np.searchsorted(row[first], np.arange(n))[row]
        out = [lists(row[first], n, term[first]), lists(row[first], n, tf.astype(np.int32)), lists(row, n, at.astype(np.int32)), lists(np.repeat(np.arange(n), sizes), n, each.astype(np.int32)), batch.column("lengths")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), *out], names=["id", "hashes", "tf", "at", "sizes", "lengths"])


def _best_sentences(total: int, max_words: int):
    """(id, picked): the places of the chosen sentences in text order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            count = lambda c: np.asarray(batch.column(c).value_lengths()).astype(np.int64)  # noqa: B023, E731
            flat = lambda c: batch.column(c).flatten().to_numpy()  # noqa: B023, E731
            n, terms, sentences = batch.num_rows, count("hashes"), count("sizes")
            weight = flat("tf") * (np.log((total + 1.0) / (flat("df") + 1.0)) + 1.0)
            at = flat("at") + np.repeat(np.cumsum(terms) - terms, count("at"))
            sizes, owner = flat("sizes"), np.repeat(np.arange(n), sentences)
            mean = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weight[at], len(sizes)) / np.maximum(sizes, 1)
            order = np.lexsort((np.arange(len(owner)), -np.round(mean, 9), owner))
            used = np.cumsum(flat("lengths")[order].astype(np.int64))
            starts = np.cumsum(sentences) - sentences
            used = used - np.repeat(np.append(0, used)[starts], sentences)
            kept = used <= max_words
            kept[starts] = True  # every row has a sentence
            kept = np.sort(order[kept])
            yield pa.RecordBatch.from_arrays([batch.column("id"), lists(owner[kept], n, (kept - starts[owner[kept]]).astype(np.int32))], names=["id", "picked"])

    return run


def summarise_with(df: DataFrame, model: Callable[[list[str]], list[str]], min_words: int = 30, max_chars: int | None = None) -> DataFrame:
    """Add ``summary`` from a user model on Arrow batches; a failing batch is retried text by text.

    ``summary_failed`` tells texts that the model couldn't summarise, whose summary is empty, from texts too short for one.
    """
    rows = summary_input(df.drop("summary"), min_words, max_chars)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def one(text: str) -> str | None:
        try:
            return model([text])[0]
        except Exception:  # noqa: BLE001  a text the model cannot handle has no summary, and says so
            return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["summary_input"].tolist()
            todo = [i for i, t in enumerate(texts) if t]
            try:
                made = list(model([texts[i] for i in todo])) if todo else []
            except Exception:  # noqa: BLE001
                made = [one(texts[i]) for i in todo]
            out = [""] * len(texts)
            for i, s in zip(todo, made):
                out[i] = s
            failed = [s is None for s in out]
            yield pdf.assign(summary=[s or "" for s in out], summary_failed=failed)

    return rows.mapInPandas(run, f"{fields}, summary string, summary_failed boolean").drop("summary_input")


def summary_quality(df: DataFrame) -> DataFrame:
    """One row: share of articles with a summary and the words per summary."""
    has = ~is_blank(F.col("summary"))
    n = F.when(has, word_count(F.col("summary")))
    return df.agg(
        F.count(F.lit(1)).alias("articles"), F.count_if(has).alias("summaries"),
        F.coalesce(F.try_divide(F.count_if(has) * 100.0, F.count(F.lit(1))), F.lit(0.0)).alias("coverage_pct"),
        F.avg(n).alias("mean_words"), F.min(n).alias("min_words"), F.max(n).alias("max_words"))

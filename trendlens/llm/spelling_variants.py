"""Spelling variants of the corpus vocabulary by a similarity join of asymmetric q-chunks.

1. One pass over the texts counts words inside the tasks; only (word, count) is shuffled.
2. Words x and y, y as long as x or one longer, are compared if a chunk of x stands in y at the same place or one after it.
   x gives two chunks only, its disjoint halves of q = length // 2 code points at 0 and at q; y gives its positional grams of
   that length. One edit touches one of the halves only. The other one stands at its place if it is the first half or the
   words are of one length, else one place on, so a chunk states where it is looked for, and grams that no chunk looks
   for are left out. The join is an equi-join on (gram, place, length of y): no pair of one edit is missed.
3. What meets is verified by the edit distance itself.

A chunk that more than ``heavy`` words share (and words of which many begin alike, as in junk) would compare the square of
that number. Such a chunk isn't used: its words meet at their deletion variants (the word, and the word without one of
its letters), which two words of one edit share. That finds the same pairs in rows in proportion to the words that hold it.

Null and empty texts have no words. Repeated rows count again. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import cut_lineage, pieces, stage_table

WORD = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}
HELD = 200_000  # distinct words a task holds before it hands them on


def word_counts(docs: DataFrame, edit: Callable[[str, list[str]], list[str]] | None = None, shortest: int = 7, least: int = 2) -> DataFrame:
    """(word, n): words of ``shortest`` code points that occur ``least`` times or more.

    Words are runs of Latin letters, A to Z lower-cased. ``edit`` may change the distinct words of a document (given its id
    as text) before they are counted.
    """

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

        for batch in pieces(it):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                found = Counter(WORD.findall(text.translate(LOWER)))
                words = list(found)
                for word, n in zip(words if edit is None else edit(doc_id, words), found.values(), strict=True):
                    if len(word) >= shortest:
                        total[word] += n
                if len(total) >= HELD:
                    yield out()
                    total.clear()
        yield out()

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def without(word: str, i: int) -> str:
    return word[:i] + word[i + 1 :]


def planted(doc_id: str | None, words: list[str]) -> list[str]:
    """One in 31 words of a document, by a hash of its id and the word, loses a letter; a null id counts as empty."""
    start = zlib.crc32(f"{doc_id or ''}:".encode())
    hashes = [zlib.crc32(w.encode(), start) for w in words]
    return [w if h % 31 else without(w, h % len(w)) for w, h in zip(words, hashes, strict=True)]


def near_pairs(words: DataFrame, heavy: int = 100) -> DataFrame:
    """(a, b), a < b: all pairs of distinct words with exactly one inserted, deleted or replaced code point between them.

    ``words`` (word string) holds distinct words and is read several times: pass a materialised table.
    """
    half = lambda minus: F.expr(f"CAST((length(word) - {minus}) DIV 2 AS INT)")
    sized = words.select("word", F.length("word").cast("int").alias("l"), half(0).alias("q"), half(1).alias("p"))

    def keys(name: str, *places: tuple[Column, Column, Column, Column]) -> DataFrame:
        """(name, gram, at, length): the gram of ``size`` at ``start``, looked for at ``at`` of words of ``length``."""
        each = [F.struct(F.col("word").substr(start + 1, size).alias("gram"), at.alias("at"), length.alias("length")) for start, size, at, length in places]
        return sized.where("l > 1").select(F.col("word").alias(name), F.explode(F.array_distinct(F.array(*each))).alias("k")).select(name, "k.*")

    zero, l, q, p = F.lit(0), F.col("l"), F.col("q"), F.col("p")
    x = keys("x", (zero, q, zero, l), (q, q, q, l), (zero, q, zero, l + 1), (q, q, q + 1, l + 1))
    y = keys("y", (zero, q, zero, l), (q, q, q, l), (zero, p, zero, l), (p + 1, p, p + 1, l))
    x, y = _shuffled(x), _shuffled(y)
    on = ["gram", "at", "length"]
    crowded = cut_lineage(x.groupBy(*on).agg(F.count("*").alias("words")).where(F.col("words") > heavy).select(*on))
    met = x.join(crowded, on, "left_anti").join(y, on).where("x < y OR length(x) < length")  # words of one length meet both ways
    pairs = _verified(met)
    if not crowded.isEmpty():
        held = lambda side, name: side.join(crowded, on, "left_semi").select(F.col(name).alias("word")).distinct()
        pairs = pairs.unionByName(_verified(_by_deletion(held(x, "x"), held(y, "y"))))
    return pairs.distinct()


def _by_deletion(left: DataFrame, right: DataFrame) -> DataFrame:
    """(x, y): words of both sides that share a deletion variant."""

    def variants(df: DataFrame, name: str) -> DataFrame:
        cut = F.transform(F.sequence(F.lit(1), F.length("word")), lambda i: F.concat(F.col("word").substr(F.lit(1), i - 1), F.col("word").substr(i + 1, F.length("word"))))
        return df.select(F.col("word").alias(name), F.explode(F.array_distinct(F.concat(F.array("word"), cut))).alias("variant"))

    return _shuffled(variants(left, "x")).join(_shuffled(variants(right, "y")), "variant").select("x", "y")


def _shuffled(rows: DataFrame) -> DataFrame:
    """``rows`` for joins that shuffle: Spark takes exploded rows for as small as what they come from, and would broadcast them."""
    return rows.hint("merge")


def _verified(met: DataFrame) -> DataFrame:
    near = met.where("x <> y").where(F.levenshtein("x", "y", 1) == 1)
    return near.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def variant_groups(words: DataFrame, times: int = 10, rounds: int = 4, heavy: int = 100) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of every word of ``words`` (word, n).

    ``form`` is the near word of largest n (ties: the first in code-point order), if that is at least ``times`` the word's
    own n. ``root`` is where the forms lead. A chain of forms grows ``times``-fold with each step, and each round of pointer
    jumping doubles the steps it covers: 4 rounds reach 16 steps, more than counts of 64 bits allow for 10.
    """
    words = stage_table(words, "words")
    pairs = stage_table(near_pairs(words.select("word"), heavy), "near-words")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("other")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("other")))
    other = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    best = F.min(F.struct((-F.col("other_n")).alias("minus"), F.col("other").alias("word")))
    near = both.join(_shuffled(other), "other").groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(_shuffled(near), "word", "left")
    enough = -F.col("best.minus") >= times * F.col("n")
    judged = joined.select("word", "n", F.when(enough, F.col("best.word")).alias("form"), F.when(enough, -F.col("best.minus")).alias("form_n"), F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"))
    judged = stage_table(judged, "word-forms")
    up = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        further = up.select(F.col("word").alias("root"), F.col("root").alias("next"))
        up = cut_lineage(up.join(_shuffled(further), "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return judged.join(_shuffled(up), "word", "left").select("word", "n", "form", "form_n", "n_near", F.coalesce("root", "word").alias("root"))

"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest

from trendlens.llm import spelling_variants
from trendlens.llm.queries import QUERIES

DOC = "doc_id long, text string"


def one_edit(a, b):
    """Exactly one code point inserted, deleted or replaced."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def near(words):
    return {(a, b) for i, a in enumerate(words) for b in words[i + 1 :] if abs(len(a) - len(b)) <= 1 and one_edit(a, b)}


def brute(docs):
    count = Counter()
    for doc_id, text in docs:
        for word in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)
            h = zlib.crc32(f"{doc_id}:{word}".encode())
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            count[word] += 1
    count = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    links = {w: [] for w in count}
    for a, b in near(sorted(count)):
        links[a].append(b)
        links[b].append(a)
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form[w] = best if best is not None and count[best] >= 10 * count[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), count[w], len(links[w]), count.get(form[w])) for w in count)


def test_query_matches_brute_force(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op12_spelling_variants"](spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == brute(docs)


@pytest.mark.parametrize("heavy", [1, 3, 1000])
def test_pairs(spark, heavy):
    rng = random.Random(4)
    words = {"aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "äaaaaaa", "ababababab", "babababab", "x", "xy", "y"}
    for _ in range(60):
        w = "".join(rng.choices("abé", k=rng.randrange(3, 12)))
        words.add(w)
        for _ in range(4):
            i = rng.randrange(len(w) + 1)
            words.add(rng.choice((w[:i] + "c" + w[i:], w[:i] + w[i + 1 :] or "q", w[:i] + "d" + w[i + 1 :])))
    df = spark.createDataFrame([(w,) for w in words], "word string").repartition(3)
    got = [(r.a, r.b) for r in spelling_variants.near_pairs(df, heavy).collect()]
    words = sorted(w for w in words if len(w) > 2)  # the halves of shorter words are single letters or none
    assert len(got) == len(set(got)) and {p for p in got if min(map(len, p)) > 2} == near(words)


def test_chain_and_edges(spark):
    rows = [(1, " ".join(["received"] * 500 + ["recieved"] * 2 + ["receivd"] * 5 + ["Receved"] * 50)), (2, None), (3, ""), (None, "received Étonnant étonnant RECEIVED"), (4, "word " * 5 + "w" * 300_000)]
    df = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], f"{DOC}, word string, n int")
    got = {r.word: r for r in spelling_variants.variant_groups(spelling_variants.word_counts(df)).collect()}
    assert set(got) == {"received", "recieved", "receivd", "receved"}
    assert (got["receivd"].form, got["receivd"].root, got["receivd"].n_near) == ("received", "received", 1 + ("receved" in got and one_edit("receivd", "receved")))
    assert got["received"].form is None and got["received"].root == "received" and got["received"].n == 502
    assert got["receved"].form == "received" and got["receved"].n == 50
    steps = [("longwordaa", 2), ("longwordab", 20), ("longwordcb", 200), ("longwodcb", 2000), ("longodcb", 20000)]
    chain = {r.word: r.root for r in spelling_variants.variant_groups(spark.createDataFrame(steps, "word string, n long")).collect()}
    assert set(chain.values()) == {"longodcb"} and len(chain) == 5
    assert spelling_variants.variant_groups(spelling_variants.word_counts(df.limit(0))).count() == 0


def test_exploded_rows_are_never_broadcast(spark, tmp_path):
    """A table of words is small on disk; its chunks and deletion variants aren't."""
    path = str(tmp_path / "words")
    spark.createDataFrame([(f"{w}abcdefgh",) for w in "qrstuvwxyz"], "word string").write.parquet(path)
    pairs = spelling_variants.near_pairs(spark.read.parquet(path), heavy=3)  # both ways to meet
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert pairs.count() == 45

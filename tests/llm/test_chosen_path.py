"""The chosen-path join against brute-force Jaccard links."""

import itertools
import random

import numpy as np
import pytest

from trendlens.llm import chosen_path, shingle_sets
from trendlens.llm.queries import QUERIES

DOC = "doc_id long, text string"


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows):
    """{doc_id: (n_shingles, component_id)} of rows with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 20 * min(len(x), len(y)) >= 17 * max(len(x), len(y)):
            common = len(x & y)
            if 100 * common >= 85 * (len(x) + len(y) - common):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def check(got, rows):
    expected = brute(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_query_matches_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(QUERIES["op13_chosen_path_components"](spark, sf).collect(), rows)


@pytest.mark.parametrize("small", [4, 500])
def test_clusters_chains_and_passages(spark, small):
    """Small nodes, and with ``small`` = 4 also stars, further steps and blocks."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(3000)]
    texts = []
    for _ in range(10):  # sets of near copies at all distances around the threshold
        base = rng.choices(vocabulary, k=rng.randrange(60, 250))
        for _ in range(8):
            own = list(base)
            for i in rng.sample(range(len(own)), rng.randrange(0, 1 + len(own) // 30)):
                own[i] = f"x{rng.randrange(10**6)}"
            texts.append(own)
    chain = rng.choices(vocabulary, k=200)
    for step in range(25):  # each like the next one only
        texts.append(chain[3 * step :] + [f"y{k}" for k in range(3 * step)])
    base = rng.choices(vocabulary, k=150)
    for k in range(60):  # one large set of near copies
        texts.append([*base[:k], f"z{k}", *base[k + 1 :]])
    passage = rng.choices(vocabulary, k=60)  # one passage in many texts
    texts += [passage + rng.choices(vocabulary, k=rng.randrange(5, 80)) for _ in range(60)]
    order = list(range(len(texts)))
    rng.shuffle(order)
    rows = [(i, " ".join(texts[k])) for i, k in enumerate(order)]
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in rows], f"{DOC}, node string, leaf int, size int").repartition(4)
    check(chosen_path.near_duplicates(df, small=small).collect(), rows)


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One  TWO"), (6, "one two three four five"), (7, "a b c d e f " * 50_000), (8, "a b c d e f " * 40_000), (9, "x" * 1_000_000)]
    df = spark.createDataFrame([(i, t) for i, t in [*rows, (4, "one two"), (None, "one two"), (None, "all its own words here now")]], DOC)
    got = chosen_path.near_duplicates(df).collect()
    assert len(got) == 12
    by = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id}
    assert by == {1: (0, 1, True), 2: (0, 2, True), 3: (0, 3, True), 4: (1, 4, True), 5: (1, 4, False), 6: (1, 6, True), 7: (6, 7, True), 8: (6, 7, False), 9: (1, 9, True)}
    assert sum(r.doc_id == 4 for r in got) == 2
    assert sorted((r.component_id or 0, r.kept) for r in got if r.doc_id is None) == [(0, False), (4, False)]
    assert chosen_path.near_duplicates(df.limit(0)).count() == 0


def test_trees_reach_the_recall():
    """Simulated pairs just at the threshold, followed down four steps."""
    rng = np.random.default_rng(1)
    share, width, depth, pairs = 0.85, 128, 4, 2000
    trees = chosen_path.trees_for(share, 0.99, depth)
    same = rng.random((pairs, width)) < share
    a = rng.integers(0, 1 << 32, (pairs, width), dtype=np.uint32)
    b = np.where(same, a, a + np.uint32(1)).astype(np.uint32)
    met = np.zeros(pairs, bool)
    for k in range(pairs):
        at = shingle_sets.mixed(np.arange(1, trees + 1, dtype=np.uint64) + np.uint64(1000 * k))  # other trees for each pair
        for _ in range(depth):
            x = chosen_path.children(at, np.repeat(a[k : k + 1], len(at), axis=0), share)[1]
            y = chosen_path.children(at, np.repeat(b[k : k + 1], len(at), axis=0), share)[1]
            at = np.intersect1d(x, y)
        met[k] = len(at) > 0
    assert met.mean() > 0.98

"""Nearest neighbours, spanning tree and density clusters against brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from trendlens.operators import density, neighbours
from trendlens.relational import follow, scan_ordered
from trendlens.session import GUESSED, cut_lineage

VEC = "vec_id long, embedding array<double>"


def frame(spark, x, ids=None):
    ids = range(len(x)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], VEC).repartition(3)


def distances(x):
    return np.round(np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2)), 9)


def reachable(x, samples):
    d = distances(x)
    core = np.sort(d + np.where(np.eye(len(x), dtype=bool), np.inf, 0), axis=1)[:, min(samples, len(x) - 1) - 1]
    return np.maximum(d, np.maximum(core[:, None], core[None]))


def kruskal(x, samples):
    w = reachable(x, samples)
    root, out = list(range(len(x))), []

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for v, a, b in sorted((w[a, b], a, b) for a in range(len(x)) for b in range(a + 1, len(x))):
        p, q = find(a), find(b)
        if p != q:
            root[q] = p
            out.append((a, b, v))
    return out


def brute_clusters(x, min_size, samples):
    """Sets of points of the clusters chosen by excess of mass, by cutting the tree from the top."""
    edges = kruskal(x, samples)
    clusters = []  # parent, birth, stability, points, children

    def walk(points, inside, cluster):
        while True:
            if len(points) < min_size or not inside:
                return
            a, b, w = max(inside, key=lambda e: (e[2], e[0], e[1]))
            lam = 1 / max(w, 1e-9)
            rest = [e for e in inside if e != (a, b, w)]
            side, grow = {a}, [a]
            while grow:
                p = grow.pop()
                for u, v, _ in rest:
                    for q, r in ((u, v), (v, u)):
                        if q == p and r not in side:
                            side.add(r)
                            grow.append(r)
            parts = [side, points - side]
            cluster["stability"] += (lam - cluster["birth"]) * sum(len(p) for p in parts if len(p) < min_size or all(len(q) >= min_size for q in parts))
            large = [p for p in parts if len(p) >= min_size]
            if len(large) == 2:
                for p in large:
                    child = {"birth": lam, "stability": 0.0, "points": p, "children": []}
                    cluster["children"].append(child)
                    walk(p, [e for e in rest if e[0] in p], child)
                return
            if not large:
                return
            points, inside = large[0], [e for e in rest if e[0] in large[0]]

    if len(x) < 2:
        return []
    top = {"birth": 0.0, "stability": 0.0, "points": set(range(len(x))), "children": []}
    walk(top["points"], edges, top)

    def choose(c):
        found, total = [], 0.0
        for child in c["children"]:
            f, t = choose(child)
            found += f
            total += t
        if c is not top and round(c["stability"] - total, 9) >= 0:
            return [c["points"]], c["stability"]
        return found, max(total, c["stability"])

    chosen = choose(top)[0]
    return sorted((frozenset(p) for p in chosen), key=lambda p: (-len(p), min(p)))


def blobs(seed, n, dims=2):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(rng.uniform(-6, 6, dims), rng.uniform(0.1, 1.2), (int(rng.integers(5, 30)), dims)) for _ in range(7)]
    parts.append(rng.uniform(-9, 9, (15, dims)))
    x = np.concatenate(parts)[:n]
    if seed % 2:  # equal points and equal distances
        x = np.round(x)
    return x


@pytest.mark.parametrize("pivots", [1, 6, 40])
def test_neighbours(spark, pivots):
    x = np.concatenate([blobs(2, 90, 3), blobs(3, 60, 3), np.zeros((6, 3))])
    d = distances(x)
    np.fill_diagonal(d, np.inf)
    k = 5
    got = {}
    for r in neighbours.nearest_neighbours(frame(spark, x), k, pivots=pivots).collect():
        got.setdefault(r.id, []).append((r["rank"], r.other, r.distance))
    for i in range(len(x)):
        order = np.lexsort((np.arange(len(x)), d[i]))[:k]
        assert sorted(got[i]) == [(n + 1, j, d[i, j]) for n, j in enumerate(order)]


def test_few_neighbours(spark):
    got = neighbours.nearest_neighbours(frame(spark, np.array([[0.0, 1], [1, 1], [5, 5]])), 10).collect()
    assert len(got) == 6
    assert neighbours.nearest_neighbours(frame(spark, np.array([[0.0, 1]])), 2).count() == 0
    assert neighbours.nearest_neighbours(spark.createDataFrame([(None, [1.0]), (1, None)], VEC), 2).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_spanning_tree(spark, seed):
    x = blobs(seed, 120)
    got = density.tree_edges(frame(spark, x), 2, pivots=8, listed=2).collect()  # short lists: most edges need the search
    assert sorted((r.lo, r.hi, r.weight) for r in got) == sorted(kruskal(x, 2))


@pytest.mark.parametrize("seed", [2, 4, 5, 6])
def test_clusters(spark, seed):
    x = blobs(seed, 140)
    for min_size in (4, 8):
        got = {r.vec_id: r.topic for r in density.density_clusters(frame(spark, x), min_size).collect()}
        expected = dict.fromkeys(range(len(x)), -1)
        for topic, points in enumerate(brute_clusters(x, min_size, 2)):
            expected.update(dict.fromkeys(points, topic))
        assert got == expected
        assert -1 in got.values() and len(set(got.values())) > 2


def test_small_tables(spark):
    for x in (np.zeros((0, 2)), np.array([[1.0, 2.0]]), np.array([[1.0, 2.0], [3.0, 4.0]])):
        got = density.density_clusters(frame(spark, x)).collect()
        assert sorted((r.vec_id, r.topic) for r in got) == [(i, -1) for i in range(len(x))]
    with pytest.raises(ValueError):
        density.density_clusters(frame(spark, np.ones((2, 2)), [1, 1]))


def test_scan_ordered_spreads_any_values(spark):
    rng = random.Random(1)
    rows = [(g, float(v), i, i % 5) for i, (g, v) in enumerate((rng.choice("ab"), rng.random()) for _ in range(4000))] + [("a", 1e12, 4000, 1), (None, 3.0, 4001, 2)]
    df = spark.createDataFrame(rows, "g string, v double, i long, n int").repartition(5)
    got = scan_ordered(df, ["g"], ["v", "i"], ["n"], ["i"], parts=128).collect()
    assert len(got) == len(rows)
    for group in ("a", "b", None):
        before = 0
        own = sorted(r[1:] for r in rows if r[0] == group)
        mine = {r.i: r for r in got if r.g == group}
        for k, (_, i, n) in enumerate(own):
            assert (mine[i].n_before, mine[i].i_next) == (before, own[k + 1][1] if k + 1 < len(own) else None)
            before += n


def test_follow(spark):
    rows = [(i, i + 1) for i in range(100)] + [(200, 200), (201, 200)]
    got = {r.node: r.root for r in follow(spark.createDataFrame(rows, "node long, up long")).collect()}
    assert all(got[i] == 100 for i in range(100)) and got[200] == got[201] == 200
    with pytest.raises(ValueError):
        follow(spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "node long, up long"), 8)


def test_visits_hand_on_a_bounded_number_of_rows():
    class Captured:
        """Stands in for a DataFrame: keeps the batches that a task hands on."""

        schema = type("Schema", (), {"fields": []})()

        def select(self, *_):
            return self

        def mapInPandas(self, fn, _):
            rows = pd.DataFrame({"id": np.arange(100), "v": [np.array([float(i), 0.0]) for i in range(100)]})
            return list(fn(iter([rows])))

    pivots = np.arange(256.0)[:, None] * [1.0, 0.0]
    cells = neighbours.Cells(None, pivots, np.ones(256), np.ones(256, np.int64))
    parts = neighbours.visits(Captured(), cells, lambda rows, apart: np.ones(apart.shape, bool))
    assert max(map(len, parts)) <= neighbours.BLOCK and sum(map(len, parts)) == 100 * 256
    assert not pd.concat(parts).duplicated(["id", "to"]).any()


def guessed_bits(df):
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()


def test_sizes_that_spark_guesses_stay_short(spark):
    """Clusters in chains of 700: ten rounds, in each of which three tables are joined."""
    n = 1400
    state = spark.range(n).selectExpr("id AS c", "CASE WHEN id % 700 > 0 THEN id - 1 END AS parent", "CAST(id % 7 AS DOUBLE) AS stability")
    got = density._best_below(state)
    assert guessed_bits(got) < 4 * GUESSED
    best, want = 0.0, {}
    for c in reversed(range(n)):
        best = want[c] = max(c % 7, 0.0 if c % 700 == 699 else best)
    assert {r["c"]: r["value"] for r in got.collect()} == want
    now = spark.range(100).selectExpr("id AS k", "(id + 1) % 100 AS up")
    for _ in range(10):
        now = cut_lineage(now.join(now.toDF("a", "b"), F.col("up") == F.col("a")).join(now.toDF("c", "d"), F.col("b") == F.col("c")).select("k", F.col("d").alias("up")))
    assert guessed_bits(now) < 4 * GUESSED and now.where("up = (k + 59049) % 100").count() == 100

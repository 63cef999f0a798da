"""Periodic runs against a quadratic search."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from trendlens.llm import periodic_runs
from trendlens.llm.queries import QUERIES

DOC = "doc_id long, text string"


def brute_runs(words):
    """All (start, length, period), by trying every period at every place."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = brute_runs(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *first, hashlib.sha256(lines).hexdigest(), hashlib.sha256(kept).hexdigest())


def random_words(rng, n, kinds):
    out = []
    while len(out) < n:
        piece = rng.choices("abcdefgh"[:kinds], k=rng.randrange(1, 9))
        if out and rng.random() < 0.3:
            piece = out[-rng.randrange(1, min(30, len(out)) + 1) :]
        out += piece * rng.choice((1, 1, 1, 2, 4, 5, 9))
    return out[:n]


@pytest.mark.parametrize("seed", range(12))
def test_runs_match_brute_force(seed):
    rng = random.Random(seed)
    texts = [[w.encode() for w in random_words(rng, rng.randrange(0, 200), 1 + k % 5)] for k in range(30)]
    found, _ = periodic_runs._collapse(texts, 4, 6)
    assert [[(r["start"], r["length"], r["period"]) for r in f] for f in found] == [brute_runs(t) for t in texts]


def test_sums_of_squared_differences():
    rng = np.random.default_rng(5)
    for size in (1, 2, 8, 64):
        blocks, windows = rng.integers(0, 1 << 19, (3, size)), rng.integers(0, 1 << 19, (3, 2 * size))
        for p, root in periodic_runs.PRIMES:
            got = periodic_runs.squared_differences(blocks, windows, p, root)
            want = np.stack([((blocks - windows[:, t : t + size]) ** 2).sum(axis=1) % p for t in range(size)], axis=1)
            assert (got == want).all()


def test_query_matches_brute_force(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    expected = sorted(brute_row(r.doc_id, r.text) for r in rows if len((r.text or "").split()) <= 400)
    short = {r[0] for r in expected}
    got = QUERIES["op11_periodic_runs"](spark, sf).collect()
    assert len(got) == len(rows)
    assert sorted(tuple(r) for r in got if r.doc_id in short) == expected


def test_edges(spark):
    cell = "one two three"
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (4, "a " * 30_000), (5, "x" * 2_000_000), (6, f"{cell} " * 4), (6, f"{cell} " * 4), (7, f"{cell} " * 3 + "one two"), (8, "b b b b b"), (9, "b\x0bb b\tb\x0cb b"), (10, "à b c à b c à b c à b c"), (None, "c " * 6)]
    df = spark.createDataFrame([(i, t, 1, "runs") for i, t in rows], f"{DOC}, runs int, collapsed string")
    got = periodic_runs.collapse_runs(df).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert all(by[i].runs == [] and by[i].collapsed == "" and by[i].n_words == 0 for i in (1, 2, 3))
    assert [tuple(r) for r in by[4].runs] == [(0, 30_000, 1)] and by[4].collapsed == "a"
    assert by[5].runs == [] and len(by[5].collapsed) == 2_000_000
    assert [tuple(r) for r in by[6].runs] == [(0, 12, 3)] and by[6].collapsed == cell
    assert by[7].runs == [] and by[8].runs == []
    assert [tuple(r) for r in by[9].runs] == [(0, 6, 1)] and by[9].collapsed == "b"
    assert [tuple(r) for r in by[10].runs] == [(0, 8, 2)] and by[10].collapsed == "à b c"
    assert by[None].collapsed == "c"
    empty = periodic_runs.digests(periodic_runs.collapse_runs(df.where("doc_id = 1"))).first()
    assert empty.n_runs == 0 and empty.start is None and empty.exponent_milli is None and empty.runs_sha256 == empty.collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert periodic_runs.digests(periodic_runs.collapse_runs(df.limit(0))).count() == 0

"""Periodic runs of words in documents, found by block convolution.

1. The words of a batch of documents are numbered and laid end to end, with a number of its own between two documents,
   so that nothing matches across them.
2. At each dyadic scale L the line is cut into blocks of L words. A run of period q, L <= q < 2 L, and at least four periods
   holds two neighbouring whole blocks that recur q words later. Number-theoretic transforms give, for every block and all
   its L distances at once, the sum of squared differences to the words that far on: it is zero where the block recurs.
   Residues of two primes are compared where one doesn't suffice, so a zero is a zero.
   Blocks with a word that doesn't recur that near can't match and aren't transformed.
3. Recurring neighbour blocks of one distance are a seed. It is extended to both sides word by word, less than L each.
   A seed inside a known run whose period divides its distance repeats that run and is left out. A smaller period of what is
   found would divide the distance, so it belongs to a smaller scale and is known already: periods are the smallest.

A document is worked on as a whole, whatever its length (up to 2 ** 27 words), in memory in proportion to it. Null and empty
texts have no words and no runs. Rows are independent of each other: repeated rows stay, other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import byte_texts, pieces

# Primes below 2 ** 31 with 2 ** 26 dividing p - 1, and a primitive root of each.
PRIMES = ((2013265921, 31), (469762049, 3))
CHUNK = 1 << 20  # numbers transformed at a time

RUN = "struct<start:long,length:long,period:long>"


def powers(base: int, n: int, p: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo p."""
    out = np.ones(n, np.int64)
    have = 1
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * pow(base, have, p) % p
        have += more
    return out


def transform(x: np.ndarray, p: int, roots: np.ndarray) -> np.ndarray:
    """Number-theoretic transforms of the rows; ``roots`` are the first half of the powers of a root of unity."""
    rows, n = x.shape
    span, done = n // 2, 1
    while span:
        x = x.reshape(rows, 2, span, done)
        a, b = x[:, 0], x[:, 1]
        y = np.empty((rows, span, 2, done), np.int64)
        y[:, :, 0] = (a + b) % p
        y[:, :, 1] = (a - b) % p * roots[::done][:span, None] % p
        x, span, done = y, span // 2, done * 2
    return x.reshape(rows, n)


def squared_differences(blocks: np.ndarray, windows: np.ndarray, p: int, root: int) -> np.ndarray:
    """Modulo p, for L words a block and 2 L words a window: the sum of squared differences at the first L places."""
    n, size = windows.shape[1], blocks.shape[1]
    w = pow(root, (p - 1) // n, p)
    there, back = powers(w, n // 2, p), powers(pow(w, p - 2, p), n // 2, p)
    blocks, windows = blocks % p, windows % p
    turned = np.zeros_like(windows)
    turned[:, 0] = blocks[:, 0]
    turned[:, n - size + 1 :] = blocks[:, :0:-1]
    product = transform(transform(turned, p, there) * transform(windows, p, there) % p, p, back)[:, :size]
    product = product * pow(n, p - 2, p) % p
    squares = np.concatenate([np.zeros((len(windows), 1), np.int64), np.cumsum(windows * windows % p, axis=1)], axis=1)
    own = (blocks * blocks % p).sum(axis=1)
    return (own[:, None] + squares[:, size : 2 * size] - squares[:, :size] - 2 * product) % p


def occurrences(ids: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block start, distance) of all blocks of ``size`` words that recur ``size`` to ``2 * size - 1`` words later."""
    top = int(ids.max()) + 1
    line = np.concatenate([ids, np.full(3 * size, top)])
    primes = PRIMES[:1] if size * top * top < PRIMES[0][0] else PRIMES
    found = [(np.zeros(0, np.int64),) * 2]
    for at in range(0, len(starts), max(1, CHUNK // (2 * size))):
        own = starts[at : at + max(1, CHUNK // (2 * size))]
        blocks, windows = line[own[:, None] + np.arange(size)], line[own[:, None] + np.arange(size, 3 * size)]
        same = np.ones((len(own), size), bool)
        for p, root in primes:
            same &= squared_differences(blocks, windows, p, root) == 0
        row, lag = np.nonzero(same)
        found.append((own[row], lag + size))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def may_recur(ids: np.ndarray, order: np.ndarray, keys: np.ndarray, following: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Whether the words at ``at`` stand once more ``size`` to ``2 * size - 1`` words later."""
    n = len(ids)
    ok = following[at] < at + 2 * size
    some = at[ok]
    place = np.searchsorted(keys, ids[some] * n + np.minimum(some + size, n - 1))
    place = np.minimum(place, n - 1)
    ok[ok] = (ids[order[place]] == ids[some]) & (order[place] >= some + size) & (order[place] < some + 2 * size)
    return ok


def find_runs(ids: np.ndarray, doc_of: np.ndarray, lengths: np.ndarray, exponent: int = 4, shortest: int = 6) -> np.ndarray:
    """Rows (start, length, period) of all runs of ``ids``, in no order; ``doc_of`` names the document of each place.

    ``lengths`` are the documents' word counts: scales too long for a document are passed over.
    """
    if exponent < 4:
        raise ValueError("two whole blocks are in every run of four periods or more only")
    n = len(ids)
    runs: list[tuple[int, int, int]] = []
    if not n:
        return np.zeros((0, 3), np.int64)
    order = np.argsort(ids, kind="stable")
    keys = ids[order] * n + order
    following = np.full(n, 4 * n)
    same = ids[order[1:]] == ids[order[:-1]]
    following[order[:-1][same]] = order[1:][same]
    size = 1
    while size * exponent <= lengths.max():
        if 2 * size > 1 << 26:
            raise ValueError("a document of over 2 ** 27 words")
        starts = np.arange(0, n, size)
        starts = starts[starts + size <= n]
        starts = starts[(lengths[doc_of[starts]] >= size * exponent) & (doc_of[starts] == doc_of[starts + size - 1])]
        for step in sorted({0, size // 2, size - 1, size // 4, 3 * size // 4}):
            starts = starts[may_recur(ids, order, keys, following, starts + step, size)]
        if len(starts):
            _extend(ids, *occurrences(ids, starts, size), size, exponent, shortest, runs)
        size *= 2
    return np.array(runs, np.int64).reshape(-1, 3)


def _extend(ids: np.ndarray, starts: np.ndarray, apart: np.ndarray, size: int, exponent: int, shortest: int, runs: list[tuple[int, int, int]]) -> None:
    """Add the runs of one scale to ``runs``, which holds those of all smaller scales."""
    if not len(starts):
        return
    by = np.lexsort((starts, apart))
    starts, apart = starts[by], apart[by]
    first = np.flatnonzero(np.concatenate(([True], (apart[1:] != apart[:-1]) | (starts[1:] != starts[:-1] + size))))
    ends = starts[np.append(first[1:], len(starts)) - 1] + size
    low, gap = starts[first], apart[first]
    longest = ends - low + 2 * (size - 1)  # words that equal the one a gap later
    can = (longest >= (exponent - 1) * gap) & (longest + gap >= shortest)
    low, high, gap = low[can], ends[can], gap[can]
    by = np.lexsort((gap, low))
    low, high, gap = low[by], high[by], gap[by]
    new = np.ones(len(low), bool)
    for start, length, period in runs:
        if length >= exponent * size:
            a, b = np.searchsorted(low, start), np.searchsorted(low, start + length)
            new[a:b] &= (high[a:b] + gap[a:b] > start + length) | (gap[a:b] % period != 0)
    seen = set()
    for a, b, q in zip(low[new].tolist(), high[new].tolist(), gap[new].tolist(), strict=True):
        left = max(0, a - size + 1)
        differ = np.flatnonzero(ids[left:a] != ids[left + q : a + q])
        a = int(left + differ[-1] + 1) if len(differ) else left
        right = min(len(ids) - q, b + size)
        differ = np.flatnonzero(ids[b:right] != ids[b + q : right + q])
        b = int(b + differ[0]) if len(differ) else max(b, right)
        if b - a >= (exponent - 1) * q and b - a + q >= shortest and (a, q) not in seen:
            seen.add((a, q))
            runs.append((a, b - a + q, q))


def _collapse(texts: list[list[bytes]], exponent: int, shortest: int) -> tuple[list[list[dict]], list[bytes]]:
    """Runs and collapsed text of each list of words."""
    known: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths + 1)  # one place more after each document
    offsets = ends - lengths - 1
    ids = np.empty(int(ends[-1]) if len(ends) else 0, np.int64)
    for at, words in zip(offsets.tolist(), texts, strict=True):
        ids[at : at + len(words)] = [known.setdefault(w, len(known)) for w in words]
    ids[ends - 1] = len(known) + np.arange(len(texts))
    doc_of = np.repeat(np.arange(len(texts)), lengths + 1)
    runs = find_runs(ids, doc_of, lengths, exponent, shortest) if len(ids) else np.zeros((0, 3), np.int64)
    owner = doc_of[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    by = np.lexsort((runs[:, 2], runs[:, 0]))
    found: list[list[dict]] = [[] for _ in texts]
    dropped: dict[int, np.ndarray] = {}
    for k in by.tolist():
        doc = int(owner[k])
        start, length, period = int(runs[k, 0] - offsets[doc]), int(runs[k, 1]), int(runs[k, 2])
        found[doc].append({"start": start, "length": length, "period": period})
        dropped.setdefault(doc, np.zeros(int(lengths[doc]), bool))[start + period : start + length] = True
    kept = [b" ".join(t if i not in dropped else [t[k] for k in np.flatnonzero(~dropped[i]).tolist()]) for i, t in enumerate(texts)]
    return found, kept


def collapse_runs(docs: DataFrame, rewrite: Callable[[str | None, list[bytes]], list[bytes]] | None = None, exponent: int = 4, shortest: int = 6) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): all periodic runs of each document, and its text without their repetitions.

    Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. A run is a longest stretch in which words ``period`` apart are
    identical, ``period`` being the smallest that does it, of ``shortest`` words and ``exponent`` periods at least. ``runs`` is
    sorted by start, then period. ``collapsed`` is the words joined by one space, without those after the first period of
    a run. ``rewrite`` may change the words of a document (given the id as text) before they are searched.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it):
            texts = [t.split() for t in byte_texts(batch.column(1))]  # bytes.split cuts at 0x20 and 0x09 to 0x0D
            if rewrite is not None:
                texts = [rewrite(i, t) for i, t in zip(batch.column(0).cast(pa.string()).to_pylist(), texts, strict=True)]
            runs, kept = _collapse(texts, exponent, shortest)
            kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(runs, kind), pa.array([t.decode() for t in kept], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id long, n_words long, runs array<{RUN}>, collapsed string")


def planted(doc_id: str | None, words: list[bytes]) -> list[bytes]:
    """A tenth of the documents, by a hash of the id, repeats a stretch of its words to its end; null ids never do."""
    n = len(words)
    if doc_id is None or not n:
        return words
    h = zlib.crc32(doc_id.encode())
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    unit = words[a : a + p]
    return words[:a] + (unit * ((n - a) // p + 1))[: n - a]


def best_run(runs: Column) -> Column:
    """The run with the greatest length / period; of equal ones the first in ``runs``. Null for none."""
    more = lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a)
    return F.when(F.size(runs) > 0, F.aggregate(runs, F.element_at(runs, 1), more))


def digests(found: DataFrame) -> DataFrame:
    """Counts, best run and digests of a result of ``collapse_runs``."""
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    best = found.withColumn("best", best_run(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"), F.col("best.period").alias("period"),
        F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )

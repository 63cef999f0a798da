"""SimHash near-duplicates by a self-join of binary tries over the fingerprints.

1. One pass over the texts makes a 64-bit fingerprint per document; only (doc_id, fingerprint) goes on.
2. Equal fingerprints are one leaf: all copies of a text cost one row from here on.
3. Two leaves within 4 differing bits are found by walking pairs of trie nodes from the root together,
   adding up the differing bits of their edges and leaving a pair as soon as it is over the budget.
   The budget is staged: of 8 bytes with at most 4 differing bits there is always a byte to start from
   (cyclically) such that the first l bytes hold at most l/2 of them, for every l. So eight tries, one
   per starting byte, are walked with the budgets 0, 1, 1, 2, 2, 3, 3, 4. The first byte has none, so
   tries fall apart into 8 x 256 independent subtries that Spark deals out; no pair is lost.
4. A subtrie returns a star per connected set of leaves, not its pairs, and skips node pairs whose
   leaves are connected already. Stars meet in a distributed connected-components job.

Null or empty texts have the fingerprint zero and are linked like others. Repeated rows stay repeated.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import byte_texts, components, cut_lineage, pieces

BITS, STEP = 64, 4


def fingerprint(text: bytes, words: int = 4, seed: int = 42) -> int:
    """A bit is set if over half of the shingles' XXH64 values have it; ``bytes.split`` cuts at 0x20, 0x09-0x0D."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    k = min(words, len(tokens))
    line = b" ".join(tokens)
    ends = list(accumulate(map(len, tokens), lambda a, b: a + 1 + b))
    starts = [0, *(e + 1 for e in ends[: len(tokens) - k])]
    digest = xxhash.xxh64_intdigest
    n = len(starts)
    hashes = np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, ends[k - 1 :], strict=True)), np.uint64, n)
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):  # a bounded piece of bits at a time, however long the text
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n, bitorder="little").tobytes(), "little")


def with_fingerprint(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""

    def run(it):
        for batch in pieces(it):
            fps = np.array([fingerprint(t, words, seed) for t in byte_texts(batch.column(1))], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def staged_budget(depth: int, differ: int, blocks: int = 8) -> int:
    """Differing bits allowed in the first ``depth`` bits of a trie."""
    return (-(-depth * blocks // BITS)) * differ // blocks


class Trie:
    """Sorted distinct 64-bit values as a trie with 4-bit edges; a node is an index into its level."""

    def __init__(self, values: np.ndarray):
        self.leaves = values
        levels = range(0, BITS + STEP, STEP)
        self.first = []  # by level: first leaf of each node
        for depth in levels:
            keys = values >> np.uint64(BITS - depth) if depth else np.zeros(len(values), np.uint64)
            self.first.append(np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))))
        self.child = [np.append(np.searchsorted(self.first[i + 1], self.first[i]), len(self.first[i + 1])) for i in range(len(self.first) - 1)]

    def edge(self, level: int, node: np.ndarray) -> np.ndarray:
        """The 4 bits that lead to ``node``."""
        return ((self.leaves[self.first[level][node]] >> np.uint64(BITS - level * STEP)) & np.uint64(15)).astype(np.int64)


POPCOUNT = np.array([bin(i).count("1") for i in range(16)], np.int64)


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        np.minimum.at(label, np.maximum(la, lb)[open_], np.minimum(la, lb)[open_])
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def connected_leaves(values: np.ndarray, differ: int = 4, chunk: int = 1 << 18) -> np.ndarray:
    """For sorted distinct values: the least index connected to each under the staged budget.

    The frontier is a stack of chunks, near pairs on top, so memory is bounded by depth x chunk.
    """
    trie = Trie(values)
    label = np.arange(len(values))
    last = BITS // STEP
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while stack:
        level, a, b, err = stack.pop()
        if level == last:
            _union(label, a, b)
            continue
        if len(a) >= 1024:  # nodes whose leaves are in one set already have nothing to add to each other
            low, high = (f.reduceat(label, trie.first[level]) for f in (np.minimum, np.maximum))
            todo = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
            a, b, err = a[todo], b[todo], err[todo]
        child = trie.child[level]
        na, nb = child[a + 1] - child[a], child[b + 1] - child[b]
        grown = np.cumsum(na * nb)
        if len(a) > 1 and grown[-1] > chunk:
            cut = max(1, int(np.searchsorted(grown, chunk)))
            stack += [(level, a[cut:], b[cut:], err[cut:]), (level, a[:cut], b[:cut], err[:cut])]
            continue
        if not len(a):
            continue
        pair = np.repeat(np.arange(len(a)), na * nb)
        within = np.arange(len(pair)) - np.repeat(grown - na * nb, na * nb)
        ca, cb = child[a][pair] + within // nb[pair], child[b][pair] + within % nb[pair]
        keep = (a[pair] != b[pair]) | (ca <= cb)
        ca, cb, pair = ca[keep], cb[keep], pair[keep]
        total = err[pair] + POPCOUNT[trie.edge(level + 1, ca) ^ trie.edge(level + 1, cb)]
        keep = total <= staged_budget((level + 1) * STEP, differ)
        if level + 1 == last:
            keep &= ca != cb
        order = np.argsort(total[keep], kind="stable")
        ca, cb, total = ca[keep][order], cb[keep][order], total[keep][order]
        for at in reversed(range(0, len(ca), chunk)):
            stack.append((level + 1, ca[at : at + chunk], cb[at : at + chunk], total[at : at + chunk]))
    return label


def _subtrie_links(differ: int):
    def run(group: pa.Table) -> pa.Table:
        turn = np.uint64(8 * (group.column("start")[0].as_py() % 8))
        own = np.unique(group.column("fp").to_numpy().view(np.uint64))
        turned = (own << turn) | (own >> (np.uint64(BITS) - turn)) if turn else own
        order = np.argsort(turned)
        label = connected_leaves(turned[order], differ)
        own, far = own[order], np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": own[far].view(np.int64), "v": own[label[far]].view(np.int64)})

    return run


def fingerprint_links(fps: DataFrame, differ: int = 4, subtrie: int = 65_536) -> DataFrame:
    """Links (u, v) that connect the distinct fingerprints of ``fps`` (fp long) within ``differ`` bits.

    A fingerprint goes to 8 subtries, one per starting byte. Where the count of a subtrie is over
    ``subtrie``, it is split by its second byte, and each leaf visits the parts at most one bit away,
    as the budget of two bytes allows. There are at most 2,048 counts, so the driver may read them.
    """
    if differ > 4:
        raise ValueError("the staged budget of the first byte is zero for up to 7 bits; the split of the second byte needs differ <= 4")
    start = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("start")
    bytes_ = F.array(*[F.shiftrightunsigned("fp", 56 - 8 * i).bitwiseAND(F.lit(255)).cast("int") for i in range(8)])
    dealt = fps.select("fp", bytes_.alias("bytes"), start)
    dealt = dealt.select("fp", "start", F.element_at("bytes", F.col("start") + 1).alias("b0"), F.element_at("bytes", (F.col("start") + 1) % 8 + 1).alias("b1"))
    counts = dealt.groupBy("start", "b0").count().where(F.col("count") > subtrie).select("start", "b0").collect()
    part = F.array(F.lit(-1))
    if counts:
        hot = F.concat_ws(":", "start", "b0").isin([f"{r.start}:{r.b0}" for r in counts])
        part = F.when(hot, F.array(F.col("b1"), *[F.col("b1").bitwiseXOR(F.lit(1 << i)) for i in range(8)])).otherwise(part)
    dealt = dealt.select("fp", "start", "b0", F.explode(part).alias("part"))
    return dealt.groupBy("start", "b0", "part").applyInArrow(_subtrie_links(differ), "u long, v long")


def near_duplicate_components(docs: DataFrame, words: int = 4, seed: int = 42, differ: int = 4) -> DataFrame:
    """(doc_id, fingerprint, component_id): the smallest doc_id reachable over links, the row's own included.

    Rows with a null doc_id are linked too and have a component, but name none. Other columns of ``docs``
    are ignored, whatever their names.
    """
    own = cut_lineage(with_fingerprint(docs, words, seed))
    leaves = cut_lineage(own.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(fingerprint_links(leaves.select("fp"), differ))
    named = leaves.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "root").select("fp", "component_id")
    text = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return own.join(by_fp, "fp").select("doc_id", text.alias("fingerprint"), "component_id")

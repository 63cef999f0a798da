"""Word-shingle sets of documents as arrays, and exact confirmation of candidate pairs.

Tokens are ``[^\\x20\\x09-\\x0D]+`` of the text with A to Z lower-cased. A shingle is a 64-bit hash of its words; a text of
fewer words has one shingle of all of them, a text without words the empty set. A *leaf* is a 64-bit hash of a set: equal
sets, so all copies of a text, are one leaf. Sets travel as binary, eight bytes a shingle, sorted.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import bit_table, byte_texts, components, cut_lineage, in_table, light_side, pieces, stage_table

MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SLACK = 1e-9


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values whose bits all depend on all bits of the argument."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def shingle_sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, ends): the sorted distinct shingles of every text, one after the other, and where each text's end."""
    tokens = [t.lower().split() for t in texts]
    sizes = np.array([len(t) for t in tokens], np.int64)
    number = _Numbers()
    ids = np.fromiter(map(number.__getitem__, chain.from_iterable(tokens)), np.int64, int(sizes.sum()))
    known = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in number), np.uint64, len(number))
    with np.errstate(over="ignore"):
        hashes = known[ids] if len(ids) else np.zeros(0, np.uint64)
        full = max(0, len(hashes) - words + 1)
        values = np.zeros(full, np.uint64)
        for i in range(words):
            values = values * MULTIPLIER + hashes[i : i + full]
        values = mixed(values)
        starts = np.cumsum(sizes) - sizes
        out, counts = [], np.zeros(len(texts), np.int64)
        for k, (start, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
            if n >= words:
                own = np.sort(values[start : start + n - words + 1])
                own = own[np.concatenate(([True], own[1:] != own[:-1]))]
            elif n:
                own = np.zeros(1, np.uint64)
                for x in hashes[start : start + n]:
                    own = own * MULTIPLIER + x
                own = mixed(own)
            else:
                continue
            out.append(own)
            counts[k] = len(own)
    return np.concatenate(out) if out else np.zeros(0, np.uint64), np.cumsum(counts)


def leaves(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The leaf of every set, as signed longs; that of an empty set has no meaning of its own."""
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    hashes = (xxhash.xxh64_intdigest(values[a:b].tobytes(), 1) for a, b in zip(starts.tolist(), ends.tolist(), strict=True))
    return np.fromiter(hashes, np.uint64, len(ends)).view(np.int64)


def row_uid() -> Column:
    """A hash that names a row, or rows that are equal in id and text."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, uid, text)."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_uid().alias("uid"), F.col("text").cast("string").alias("text"))


def wanted_sets(docs: DataFrame, rows: DataFrame, words: int) -> DataFrame:
    """``rows`` (uid, leaf, and further columns; materialised) with the ``items`` of each leaf.

    The rows of ``docs`` (``keyed``) that have them are found by a bit table of fixed size inside the map, so texts aren't
    shuffled. Rows of ``docs`` that are equal give equal rows.
    """
    packed = docs.sparkSession.sparkContext.broadcast(bit_table(rows, "uid"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it, 1 << 20):
            batch = batch.filter(pa.array(in_table(packed.value, batch.column(0).to_numpy())))
            values, ends = shingle_sets(byte_texts(batch.column(1)), words)
            raw = pa.py_buffer(values.astype("<u8").tobytes())
            items = pa.Array.from_buffers(pa.large_binary(), len(ends), [None, pa.py_buffer(np.concatenate(([0], ends * 8)).astype(np.int64).tobytes()), raw])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(leaves(values, ends)), items.cast(pa.binary())], names=["uid", "leaf", "items"])

    found = docs.select("uid", "text").mapInArrow(run, "uid long, leaf long, items binary")
    return found.join(light_side(rows), ["uid", "leaf"])


def sets_of(docs: DataFrame, own: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """(leaf, items) of the ``wanted`` (leaf) leaves, each once, as a table; ``own`` holds (uid, leaf) of the rows of ``docs``."""
    rows = cut_lineage(own.join(wanted, "leaf", "left_semi").groupBy("leaf").agg(F.min("uid").alias("uid")))
    return stage_table(wanted_sets(docs, rows, words).dropDuplicates(["leaf"]).select("leaf", "items"), "shingle-sets")


def common_items(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def confirmed(docs: DataFrame, own: DataFrame, pairs: DataFrame, words: int, share: float) -> DataFrame:
    """Those of the ``pairs`` (u, v) of leaves whose exact Jaccard is ``share`` or more; ``pairs`` must be materialised.

    Of each pair one set is shuffled to where the other is.
    """
    sets = sets_of(docs, own, pairs.select(F.explode(F.array("u", "v")).alias("leaf")).distinct(), words)
    left = sets.select(F.col("leaf").alias("u"), F.col("items").alias("x"))
    right = sets.select(F.col("leaf").alias("v"), F.col("items").alias("y"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it):
            x, y = (batch.column(i).to_pylist() for i in (2, 3))
            keep = np.zeros(batch.num_rows, bool)
            for k, (a, b) in enumerate(zip(x, y, strict=True)):
                a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
                n = common_items(a, b)
                keep[k] = n >= share * (len(a) + len(b) - n) - SLACK
            yield batch.select([0, 1]).filter(pa.array(keep))

    both = pairs.select("u", "v").join(left, "u").join(right, "v").select("u", "v", "x", "y")
    return cut_lineage(both.mapInArrow(run, "u long, v long"))


# --- groups -------------------------------------------------------------------------------------


def grouped(rows: DataFrame) -> DataFrame:
    """Rows dealt by node and sorted, for functions over whole nodes."""
    return rows.repartition("node").sortWithinPartitions("node", "leaf")


def by_node(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by node, cut anew so that no node is cut."""
    rest: list[pa.RecordBatch] = []
    for batch in it:
        if not batch.num_rows:
            continue
        nodes = batch.column(0).to_numpy()
        cut = int(np.searchsorted(nodes == nodes[-1], True))
        if rest and (cut or rest[-1].column(0)[0].as_py() != nodes[0]):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)]).combine_chunks().to_batches()[0]
            rest = []
        elif cut:
            yield batch.slice(0, cut)
        rest.append(batch.slice(cut))
    if rest:
        yield pa.Table.from_batches(rest).combine_chunks().to_batches()[0]


def first_rows(node: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First row and size of each node of sorted rows."""
    first = np.flatnonzero(np.concatenate(([True], node[1:] != node[:-1])))
    return first, np.diff(np.append(first, len(node)))


def linked(sets: list[np.ndarray], share: float, width: int = 4096) -> np.ndarray:
    """Which of the sorted sets have a Jaccard similarity of ``share`` or more, as a matrix."""
    n = np.array([len(x) for x in sets], np.int64)
    items, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), n)
    place = np.cumsum(times > 1) - 1  # items of one set only are in no intersection
    keep = times[at] > 1
    owner, column = owner[keep], place[at[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (low, low + width))
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], column[a:b] - low] = 1
        common += held @ held.T
    return common >= share * (n[:, None] + n - common) - SLACK


def exact_links(share: float):
    """Links (u, v) that connect the rows (node, leaf, items) of each node as all links between them do."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(it):
            own, items = batch.column(1).to_numpy(), batch.column(2)
            u, v = [], []
            for at, n in zip(*(x.tolist() for x in first_rows(batch.column(0).to_numpy())), strict=True):
                near = linked([np.frombuffer(x.as_py(), "<u8") for x in items.slice(at, n)], share)
                free = np.ones(n, bool)
                while free.any():
                    reached = [int(free.argmax())]
                    free[reached[0]] = False
                    for i in reached:
                        new = np.flatnonzero(near[i] & free)
                        free[new] = False
                        reached += new.tolist()
                        u += [own[at + i]] * len(new)
                        v += own[at + new].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["a", "b"])

    return run


def links_in_clusters(docs: DataFrame, own: DataFrame, pairs: DataFrame, words: int, share: float, bound: int = 250) -> DataFrame:
    """Links (u, v) that connect leaves as the ``pairs`` (u, v) of Jaccard ``share`` or more do; ``pairs`` must be materialised.

    Leaves that pairs connect are a cluster. A cluster of up to ``bound`` leaves is compared as a whole in one place, so each
    set is sent once however many pairs it has. In larger ones the end of a pair that has fewer pairs goes to where the
    other one is, up to ``bound`` at a time. Sets are made in the map and shuffled once.
    """
    clusters = components(pairs)
    sizes = cut_lineage(clusters.groupBy("root").agg(F.count("*").alias("size")))
    sized = cut_lineage(clusters.join(sizes, "root").select(F.col("node").alias("leaf"), F.col("root").alias("node"), (F.col("size") > bound).alias("large")))
    groups = sized.where("NOT large").select("leaf", "node")
    large = cut_lineage(pairs.select("u", "v").join(sized.where("large").select(F.col("leaf").alias("u")), "u", "left_semi"))
    if not large.isEmpty():
        degrees = large.select(F.explode(F.array("u", "v")).alias("leaf")).groupBy("leaf").agg(F.count("*").alias("n"))
        of = lambda x: degrees.select(F.col("leaf").alias(x), F.col("n").alias(f"n_{x}"))
        ends = large.join(of("u"), "u").join(of("v"), "v")
        more = F.struct("n_u", "u") > F.struct("n_v", "v")
        ends = ends.select(F.when(more, F.col("u")).otherwise(F.col("v")).alias("hub"), F.when(more, F.col("v")).otherwise(F.col("u")).alias("leaf"), F.greatest("n_u", "n_v").alias("n"))
        node = F.xxhash64("hub", F.pmod(F.xxhash64(F.lit(3), "leaf"), F.ceil(F.col("n") / bound)))
        ends = cut_lineage(ends.withColumn("node", node))
        groups = groups.unionByName(ends.select("leaf", "node")).unionByName(ends.select(F.col("hub").alias("leaf"), "node").distinct())
    named = own.groupBy("leaf").agg(F.min("uid").alias("uid"))
    rows = cut_lineage(groups.join(named, "leaf").select("uid", "leaf", "node"))
    links = grouped(wanted_sets(docs, rows, words).select("node", "leaf", "items")).mapInArrow(exact_links(share), "a long, b long")
    return cut_lineage(links.where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())

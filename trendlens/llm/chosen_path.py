"""Near-duplicates by a chosen-path similarity join over minwise tokens.

1. One pass over the texts makes the set of word shingles of each document and its signature, ``width`` minwise tokens; two
   sets have a token in common with a probability that is their Jaccard similarity. Equal sets are one leaf.
2. Trees over the leaves: a node has chosen one token place, two for some nodes, so that 1 / ``share`` are chosen on average
   and a pair at the threshold goes on together with an expectation of one. A leaf goes to the child of each chosen place
   that its token there names. The choice depends on the path alone, so leaves branch without knowing of each other.
   Most nodes hold a single leaf after one step and end there.
3. In a small node all signatures are compared. A node hands on pairs that connect what looks similar, not all pairs.
   In a node of over ``small`` leaves each leaf is first compared with ``stars`` of them. Nodes whose leaves are connected by
   confirmed links are done; others branch again. What is still large after ``depth`` steps is compared block by block.
4. Links are confirmed on full sets. Where a connecting pair of a node isn't confirmed, and in nodes below large ones, the
   leaves that are alike to one of another component are compared exhaustively on full sets; each set is sent to a node once,
   and a node hands on links that connect what is linked in it. So rows grow with leaves, not with pairs.

Independent trees are repeated until a pair just at the threshold is met with a probability of ``recall`` even if all of
its nodes branch ``depth`` times; pairs met in the first step or of higher similarity are missed far less often. A pair that
was met is given up only if its signature is 4.5 standard deviations below the threshold.

Null texts and texts without words have the empty set and are linked with nothing. Repeated rows stay repeated and are
linked. Rows with a null doc_id are linked too but name no component. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.llm.common import byte_texts, components, cut_lineage, pieces, release, stage_table
from trendlens.llm.shingle_sets import by_node, confirmed, exact_links, first_rows, grouped, keyed, leaves, mixed, sets_of, shingle_sets

MASK = (1 << 64) - 1


def _mix(x: int) -> int:
    return int(mixed(np.array([x & MASK], np.uint64))[0])


def signatures(values: np.ndarray, ends: np.ndarray, width: int) -> np.ndarray:
    """``width`` minwise tokens of 32 bits of every set; zeros for empty ones."""
    starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
    full = np.flatnonzero(ends > starts)
    out = np.zeros((len(ends), width), np.uint32)
    if len(full):
        with np.errstate(over="ignore"):
            for i in range(width):
                turned = (values ^ np.uint64(_mix(2 * i + 1))) * np.uint64(_mix(2 * i + 2) | 1)
                turned ^= turned >> np.uint64(32)
                out[full, i] = mixed(np.minimum.reduceat(turned, starts[full])) >> np.uint64(32)
    return out


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    size = rows.shape[1] * rows.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(size), len(rows), [None, pa.py_buffer(np.ascontiguousarray(rows).tobytes())]).cast(pa.binary())


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, kind).reshape(len(column), -1)


def with_signature(docs: DataFrame, words: int, width: int) -> DataFrame:
    """(doc_id, uid, leaf, n, signature) of ``keyed`` documents; leaf and signature are null for the empty set."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it, 1 << 20):
            values, ends = shingle_sets(byte_texts(batch.column(2)), words)
            n = np.diff(ends, prepend=0)
            leaf = pa.array(leaves(values, ends), mask=n == 0)
            own = _lists(signatures(values, ends, width))
            own = pa.array([x if k else None for x, k in zip(own.to_pylist(), n.tolist(), strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), leaf, pa.array(n), own], names=["doc_id", "uid", "leaf", "n", "signature"])

    return docs.mapInArrow(run, "doc_id long, uid long, leaf long, n long, signature binary")


# --- paths --------------------------------------------------------------------------------------


def trees_for(share: float, recall: float, depth: int) -> int:
    """Trees that meet a pair of similarity ``share`` with probability ``recall`` if it takes ``depth`` steps."""
    whole, part = int(1 / share), 1 / share - int(1 / share)
    meet = 1.0
    for _ in range(depth):
        miss = 1 - share * meet
        meet = 1 - ((1 - part) * miss**whole + part * miss ** (whole + 1))
    return max(1, ceil(log(1 - recall) / log(1 - meet)))


def choices(nodes: np.ndarray, share: float, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, place): the token places that each node has chosen, 1 / ``share`` on average."""
    whole, part = int(1 / share), 1 / share - int(1 / share)
    draw = mixed(nodes ^ np.uint64(0x5851F42D4C957F2D))
    count = whole + ((draw >> np.uint64(11)) * 2.0**-53 < part)
    row = np.repeat(np.arange(len(nodes)), count)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    start, step = mixed(draw + np.uint64(1)) % np.uint64(width), mixed(draw + np.uint64(2)) % np.uint64(width // 2) * np.uint64(2) + np.uint64(1)
    return row, ((start[row] + step[row] * nth.astype(np.uint64)) % np.uint64(width)).astype(np.int64)


def children(nodes: np.ndarray, tokens: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child): the children that each row, a node and the signature of a leaf in it, goes to."""
    row, place = choices(nodes, share, tokens.shape[1])
    path = mixed(nodes[row] + np.uint64(1) + place.astype(np.uint64))
    return row, mixed(path ^ tokens[row, place].astype(np.uint64))


def first_step(leaf_rows: DataFrame, share: float, trees: int) -> DataFrame:
    """(node, leaf) of the first step in every tree."""
    roots = mixed(np.arange(1, trees + 1, dtype=np.uint64))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it):
            tokens, own = _matrix(batch.column(1), "<u4"), batch.column(0).to_numpy()
            row, child = children(np.tile(roots, len(own)), np.repeat(tokens, trees, axis=0), share)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(own[row // trees])], names=["node", "leaf"])

    return leaf_rows.select("leaf", "signature").mapInArrow(run, "node long, leaf long")


def next_step(rows: DataFrame, leaf_rows: DataFrame, share: float) -> DataFrame:
    """(node, leaf) one step further down."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it):
            own = batch.column(1).to_numpy()
            row, child = children(batch.column(0).to_numpy().view(np.uint64), _matrix(batch.column(2), "<u4"), share)
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(own[row])], names=["node", "leaf"])

    return rows.join(leaf_rows.select("leaf", "signature"), "leaf").select("node", "leaf", "signature").mapInArrow(run, "node long, leaf long").distinct()


def shared_nodes(rows: DataFrame) -> DataFrame:
    """(node, leaf, size): nodes of two leaves or more, as a table; ``rows`` must be materialised."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size")).where("size > 1")
    return stage_table(rows.join(sizes, "node"), "nodes")


# --- comparison ---------------------------------------------------------------------------------


def _alike(tokens: np.ndarray, own: np.ndarray, roots: np.ndarray | None, least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row the later rows of other leaves (and other roots) with ``least`` equal tokens."""
    for i in range(len(tokens) - 1):
        ok = (tokens[i + 1 :] == tokens[i]).sum(axis=1) >= least
        ok &= own[i + 1 :] != own[i]
        if roots is not None:
            ok &= roots[i + 1 :] != roots[i]
        yield i, np.flatnonzero(ok) + i + 1


def _connecting(tokens: np.ndarray, own: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, more): pairs of rows that connect all rows alike; ``more`` says that their set has other pairs as well."""
    root = np.arange(len(own))
    a, b, pairs = [], [], np.zeros(len(own), np.int64)
    for i, others in _alike(tokens, own, None, least):
        pairs[i] = len(others)
        for j in others[root[others] != root[i]].tolist():
            if root[j] != root[i]:
                a.append(i)
                b.append(j)
                root[root == root[j]] = root[i]
    a, b = np.array(a, np.int64), np.array(b, np.int64)
    total, kept = np.bincount(root, pairs, len(own)), np.bincount(root[a], minlength=len(own))
    return a, b, (total > kept)[root[a]] if len(a) else np.zeros(0, bool)


def _pairs_in_nodes(least: int):
    """Pairs (node, a, b, more) of the rows (node, leaf, signature) that connect what is alike in each node."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(it):
            node, own = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            tokens = _matrix(batch.column(2), "<u4").astype(np.uint16)
            first, size = first_rows(node)
            two = first[size == 2]
            two = two[((tokens[two] == tokens[two + 1]).sum(axis=1) >= least) & (own[two] != own[two + 1])]
            parts = [(two, two + 1, np.zeros(len(two), bool))]
            for at, n in zip(first[size > 2].tolist(), size[size > 2].tolist(), strict=True):
                a, b, more = _connecting(tokens[at : at + n], own[at : at + n], least)
                parts.append((at + a, at + b, more))
            a, b, more = (np.concatenate(x) for x in zip(*parts, strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(own[a]), pa.array(own[b]), pa.array(more)], names=["node", "a", "b", "more"])

    return run


def _apart_in_nodes(least: int):
    """Rows (node, leaf) of (node, leaf, signature, root) that are alike to a row of the node with another root."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_node(it):
            node, own, roots = (batch.column(i).to_numpy() for i in (0, 1, 3))
            tokens = _matrix(batch.column(2), "<u4").astype(np.uint16)
            marked = np.zeros(len(node), bool)
            for at, n in zip(*(x.tolist() for x in first_rows(node)), strict=True):
                part = slice(at, at + n)
                for i, others in _alike(tokens[part], own[part], roots[part], least):
                    if len(others):
                        marked[at + i] = True
                        marked[at + others] = True
            yield batch.select([0, 1]).filter(pa.array(marked))

    return run


_PAIRS = "node long, a long, b long, more boolean"


def _ends(df: DataFrame, *more: str) -> DataFrame:
    return df.select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"), *more)


def connecting_pairs(rows: DataFrame, leaf_rows: DataFrame, least: int) -> DataFrame:
    """Pairs (u, v, node, more) that connect what is alike in nodes of bounded size."""
    held = rows.select("node", "leaf").join(leaf_rows.select("leaf", "signature"), "leaf").select("node", "leaf", "signature")
    return _ends(grouped(held).mapInArrow(_pairs_in_nodes(least), _PAIRS), "node", "more")


def still_apart(rows: DataFrame, leaf_rows: DataFrame, least: int, roots: DataFrame) -> DataFrame:
    """(node, leaf) of nodes of bounded size whose signature is alike to one of another component in the node."""
    held = _rooted(rows.select("node", "leaf").join(leaf_rows.select("leaf", "signature"), "leaf"), roots)
    return grouped(held.select("node", "leaf", "signature", "root")).mapInArrow(_apart_in_nodes(least), "node long, leaf long")


def links_in_nodes(docs: DataFrame, own: DataFrame, rows: DataFrame, words: int, share: float) -> DataFrame:
    """Links (u, v) between the leaves of nodes of bounded size, all of them compared on full sets; ``rows`` must be materialised."""
    sets = sets_of(docs, own, rows.select("leaf").distinct(), words)
    held = rows.join(sets, "leaf").select("node", "leaf", "items")
    return cut_lineage(_ends(grouped(held).mapInArrow(exact_links(share), "a long, b long")).distinct())


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.withColumnRenamed("node", "leaf")
    return rows.join(named, "leaf", "left").withColumn("root", F.coalesce("root", "leaf"))


def star_pairs(rows: DataFrame, leaf_rows: DataFrame, least: int, stars: int) -> DataFrame:
    """Pairs (u, v) of each leaf of a node and ``stars`` leaves of it, if their signatures allow the similarity.

    The stars come to each leaf in one row.
    """
    own = leaf_rows.select("leaf", "signature")
    heads = rows.groupBy("node").agg(*[F.min_by("leaf", F.xxhash64(F.lit(i), "leaf")).alias(f"h{i}") for i in range(stars)])
    heads = heads.select("node", F.explode(F.array_distinct(F.array(*[f"h{i}" for i in range(stars)]))).alias("leaf")).join(own, "leaf")
    heads = heads.groupBy("node").agg(F.collect_list("leaf").alias("stars"), F.collect_list("signature").alias("tokens"))  # ``stars`` entries at most

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(it):
            if not batch.num_rows:
                continue
            leaf, sizes = batch.column(0).to_numpy(), batch.column(2).value_lengths().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), sizes)
            head = batch.column(2).flatten().to_numpy()
            same = (_matrix(batch.column(1), "<u4")[row] == _matrix(batch.column(3).flatten(), "<u4")).sum(axis=1)
            keep = (same >= least) & (leaf[row] != head)
            a, b = leaf[row][keep], head[keep]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["u", "v"])

    held = rows.select("node", "leaf").join(own, "leaf").join(heads, "node")
    return held.select("leaf", "signature", "stars", "tokens").mapInArrow(run, "u long, v long").distinct()


def apart_in(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` of nodes that hold more than one component."""
    named = cut_lineage(_rooted(rows, roots))
    open_ = named.groupBy("node").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("node")
    return named.join(open_, "node", "left_semi")


def apart_by_blocks(rows: DataFrame, leaf_rows: DataFrame, least: int, roots: DataFrame, small: int) -> DataFrame:
    """As ``still_apart`` for nodes of any size: every two blocks of a node meet in a node of their own."""
    blocks = F.ceil(F.col("size") / (small / 2)).cast("int")
    own = F.pmod(F.xxhash64(F.lit(7), "leaf"), F.col("blocks")).cast("int")
    dealt = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other"))
    return still_apart(dealt.select(part.alias("node"), "leaf").distinct(), leaf_rows, least, roots)


def near_duplicate_roots(docs: DataFrame, own: DataFrame, leaf_rows: DataFrame, words: int, share: float, recall: float, width: int, small: int, stars: int, depth: int) -> list[DataFrame]:
    """Rows (node, root) that lead from leaves to the least leaf that confirmed links connect them to, with the stated recall.

    The second table, if there is one, goes on from roots of the first.
    """
    least = ceil(width * (share - 4.5 * sqrt(share * (1 - share) / width)))
    nodes = shared_nodes(cut_lineage(first_step(leaf_rows, share, trees_for(share, recall, depth))))
    few, many = nodes.where(F.col("size") <= small), nodes.where(F.col("size") > small)
    met = stage_table(connecting_pairs(few, leaf_rows, least), "connecting")
    pairs = met.select("u", "v")
    crowded = not many.isEmpty()
    if crowded:
        pairs = pairs.unionByName(star_pairs(many, leaf_rows, least, stars))
    first = cut_lineage(confirmed(docs, own, cut_lineage(pairs.distinct()), words, share))
    release(docs.sparkSession)
    roots = cut_lineage(components(first))
    # nodes whose connecting pairs didn't all hold, and large nodes, one step after the other
    low, high = roots.toDF("u", "root_u"), roots.toDF("v", "root_v")
    judged = met.where("more").join(low, "u", "left").join(high, "v", "left")
    again = judged.where(F.coalesce("root_u", "u") != F.coalesce("root_v", "v")).select("node").distinct()
    rest = cut_lineage(still_apart(few.join(cut_lineage(again), "node", "left_semi"), leaf_rows, least, roots))
    step = 1
    while crowded:
        open_ = stage_table(apart_in(many, roots), "open-nodes")
        if open_.isEmpty():
            break
        if step == depth:
            rest = rest.unionByName(cut_lineage(apart_by_blocks(open_, leaf_rows, least, roots, small)))
            break
        step += 1
        release(docs.sparkSession)  # what a step shuffled, signatures above all
        nodes = shared_nodes(cut_lineage(next_step(open_.select("node", "leaf"), leaf_rows, share)))
        few, many = nodes.where(F.col("size") <= small), nodes.where(F.col("size") > small)
        rest = rest.unionByName(cut_lineage(still_apart(few, leaf_rows, least, roots)))
        crowded = not many.isEmpty()
    rest = cut_lineage(rest)
    release(docs.sparkSession)
    if rest.isEmpty():
        return [roots]
    side = lambda x: roots.select(F.col("node").alias(x), F.col("root").alias(f"r_{x}"))
    more = links_in_nodes(docs, own, rest, words, share).join(side("u"), "u", "left").join(side("v"), "v", "left")
    more = cut_lineage(more.select(F.coalesce("r_u", "u").alias("u"), F.coalesce("r_v", "v").alias("v")).where("u <> v").distinct())
    return [roots] if more.isEmpty() else [roots, components(more)]


def near_duplicates(docs: DataFrame, words: int = 5, share: float = 0.85, recall: float = 0.999, width: int = 128, small: int = 500, stars: int = 4, depth: int = 4) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row: the size of its set, the smallest doc_id reachable over links
    of Jaccard ``share`` or more, and whether that is its own."""
    if not 0.5 <= share < 1 or width & 1:
        raise ValueError("share must be in [0.5, 1) and width even")
    texts = keyed(docs)
    signed = stage_table(with_signature(texts, words, width), "signatures")
    own = signed.select("doc_id", "uid", "leaf", "n")
    leaf_rows = stage_table(signed.where("leaf IS NOT NULL").select("leaf", "signature").dropDuplicates(["leaf"]), "leaves")
    steps = near_duplicate_roots(texts, own.where("leaf IS NOT NULL"), leaf_rows, words, share, recall, width, small, stars, depth)
    least = own.where("leaf IS NOT NULL").groupBy("leaf").agg(F.min("doc_id").alias("least"))
    named = least.withColumn("root", F.col("leaf"))
    for roots in steps:
        named = named.join(roots.toDF("root", "next"), "root", "left").select("leaf", "least", F.coalesce("next", "root").alias("root"))
    named = cut_lineage(named)
    best = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_leaf = named.join(best, "root").select("leaf", "component_id")
    out = own.join(by_leaf, "leaf", "left").withColumn("component_id", F.when(F.col("leaf").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)).alias("kept"))

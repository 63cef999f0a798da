"""Density clusters with noise: hierarchical clustering over mutual reachability, as Spark jobs.

1. The core distance of a point is that to its ``samples``-th neighbour; the reachability of two points is the largest of
   their distance and both core distances.
2. The minimum spanning tree is grown in Borůvka rounds. Each component takes its lightest edge outwards, from the points'
   neighbour lists where these prove it, else by a search that skips cells beyond the lightest edge known and cells
   that lie in the component as a whole. Edges are ordered by (weight, lower id, higher id), so there is one tree.
3. The rounds give the dendrogram. A component's lightest edge caps all lighter edges inside it, so an edge belongs to the
   first component, from its own round on, whose lightest edge is heavier; edges of one component form a chain by weight.
4. The condensed tree keeps splits whose both sides have ``min_size`` points. Clusters are chosen by excess of mass: a cluster
   stays if it is at least as stable as the best choice below it. The whole table is never a cluster.

Every step is a join, an aggregate or an ordered scan over narrow rows; no task sees a whole component or chain.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendlens.operators.neighbours import DIGITS, Cells, compare, into_cells, nearest, nearest_rows, to_pivots, vectors, visits
from trendlens.relational import follow, scan_ordered
from trendlens.session import cut_lineage, stage_table

LEAST = 1e-9  # weight that stands for zero where its inverse is taken



def _edge() -> Column:
    return F.struct("lo", "hi").alias("e")


@dataclass
class Tree:
    """A minimum spanning tree and how it grew."""

    edges: list[DataFrame]  # by round: lo, hi, w, root (its component after the round)
    choices: list[DataFrame]  # by round: comp, w, lo, hi
    merges: list[DataFrame]  # by round: comp, root


def reachability(cells: Cells, samples: int = 2, listed: int = 16) -> tuple[DataFrame, DataFrame]:
    """(points: id, core, reach; edges: a, b, w): core distances and neighbour lists.

    ``reach`` is the distance up to which the list of a point is complete.
    """
    k = max(samples, listed)
    lists = stage_table(nearest(cells.rows, cells, k), "neighbour-lists")
    core = F.coalesce(F.max(F.when(F.col("rank") == samples, F.col("distance"))), F.max("distance"))
    points = lists.groupBy("id").agg(core.alias("core"), F.when(F.count("*") >= k, F.max("distance")).otherwise(float("inf")).alias("reach"))
    points = cells.rows.select("id").join(points, "id", "left").select("id", F.coalesce("core", F.lit(0.0)).alias("core"), F.coalesce("reach", F.lit(float("inf"))).alias("reach"))
    points = stage_table(points, "cores")
    a, b = points.select(F.col("id").alias("a"), F.col("core").alias("ca")), points.select(F.col("id").alias("b"), F.col("core").alias("cb"))
    edges = lists.select(F.col("id").alias("a"), F.col("other").alias("b"), "distance").join(a, "a").join(b, "b")
    return points, stage_table(edges.select("a", "b", F.greatest("distance", "ca", "cb").alias("w")), "reachability")


def _search(cells: Cells, points: DataFrame, labels: DataFrame, known: DataFrame) -> DataFrame | None:
    """(comp, w, lo, hi): lightest edges outwards that neighbour lists can't prove; None if they prove all.

    ``known`` holds the lightest listed edge (comp, best) of components.
    """
    state = points.join(labels, "id").join(known, "comp", "left")
    open_ = cut_lineage(state.where("best IS NULL OR greatest(core, reach) <= best.w").select("id", "core", "comp", F.coalesce("best.w", F.lit(float("inf"))).alias("limit")))
    if open_.isEmpty():
        return None
    base = stage_table(cells.rows.select("id", "v", "cell").join(points.select("id", "core"), "id").join(labels, "id"), "labelled")
    n, pivots, radius, held = len(cells.count), cells.pivots, cells.radius, cells.count > 0
    low, high, far = np.full(n, 1), np.full(n, 0), np.full(n, np.inf)
    for r in base.groupBy("cell").agg(F.min("comp").alias("a"), F.max("comp").alias("b"), F.max("core").alias("c")).collect():  # one row per pivot at most
        low[r["cell"]], high[r["cell"]], far[r["cell"]] = r["a"], r["b"], r["c"]
    queries = cells.rows.select("id", "v").join(open_, "id")

    def foreign(rows: pd.DataFrame) -> np.ndarray:
        own = rows["comp"].to_numpy()[:, None]
        return ((low != own) | (high != own)) & held

    def at_most(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                apart = to_pivots(vectors(rows["v"]), pivots) + radius
                most = np.where(foreign(rows), np.maximum(np.maximum(apart, far), rows["core"].to_numpy()[:, None]), np.inf).min(axis=1)
                yield pd.DataFrame({"comp": rows["comp"], "most": np.minimum(most + 10.0**-DIGITS, rows["limit"])})

    most = queries.select("v", "core", "comp", "limit").mapInPandas(at_most, "comp long, most double").groupBy("comp").agg(F.min("most").alias("most"))
    bound = cut_lineage(most)
    queries = queries.drop("limit").join(bound, "comp").where("core <= most")

    def near(rows: pd.DataFrame, apart: np.ndarray) -> np.ndarray:
        return foreign(rows) & (apart - radius <= rows["most"].to_numpy()[:, None] + 10.0 ** (1 - DIGITS))

    def pick(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"comp": [], "w": [], "lo": [], "hi": []}).astype({"comp": "int64", "w": "float64", "lo": "int64", "hi": "int64"})
        own, others = left["id"].to_numpy(), right["y_id"].to_numpy()
        i, j, w = nearest_rows(vectors(left["v"]), vectors(right["y_v"]), own, others, 1, (left["core"].to_numpy(), right["y_core"].to_numpy()), (left["comp"].to_numpy(), right["y_comp"].to_numpy()), True)
        found = pd.DataFrame({"comp": left["comp"].to_numpy()[i], "w": w, "lo": np.minimum(own[i], others[j]), "hi": np.maximum(own[i], others[j])})
        return found.sort_values(["comp", "w", "lo", "hi"]).drop_duplicates("comp")

    going = visits(queries, cells, near, ["core", "comp", "most"])
    return compare(going, cells, base, pick, "comp long, w double, lo long, hi long", ["core", "comp"], ["core", "comp"])


def spanning_tree(cells: Cells, samples: int = 2, listed: int = 16) -> Tree:
    """The minimum spanning tree of all points under mutual reachability."""
    points, edges = reachability(cells, samples, listed)
    labels = points.select("id", F.col("id").alias("comp"))
    open_ = edges.select("a", "b", "w", F.col("a").alias("ca"), F.col("b").alias("cb"))
    tree = Tree([], [], [])
    while True:
        key = F.struct("w", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).alias("key")
        ends = open_.select(F.explode(F.array("ca", "cb")).alias("comp"), key)
        known = cut_lineage(ends.groupBy("comp").agg(F.min("key").alias("best")))
        more = _search(cells, points, labels, known)
        every = known.select("comp", "best")
        if more is not None:
            every = every.unionByName(more.select("comp", F.struct("w", "lo", "hi").alias("best")))
        best = cut_lineage(every.groupBy("comp").agg(F.min("best").alias("best")).select("comp", "best.*"))
        if best.isEmpty():
            return tree
        side = lambda x: labels.select(F.col("id").alias(x), F.col("comp").alias(f"c_{x}"))
        aimed = best.join(side("lo"), "lo").join(side("hi"), "hi")
        aimed = cut_lineage(aimed.select("comp", F.when(F.col("c_lo") == F.col("comp"), F.col("c_hi")).otherwise(F.col("c_lo")).alias("to")))
        back = aimed.select(F.col("comp").alias("n"), F.col("to").alias("back"))
        up = F.when((F.col("back") == F.col("comp")) & (F.col("comp") < F.col("to")), F.col("comp")).otherwise(F.col("to"))
        merges = cut_lineage(follow(aimed.join(back, F.col("to") == F.col("n")).select(F.col("comp").alias("node"), up.alias("up"))).toDF("comp", "root"))
        tree.choices.append(best)
        tree.merges.append(merges)
        tree.edges.append(cut_lineage(best.join(merges, "comp").groupBy("lo", "hi").agg(F.min("w").alias("w"), F.min("root").alias("root"))))
        labels = stage_table(labels.join(merges, "comp").select("id", F.col("root").alias("comp")), "labels")
        of = lambda x: merges.select(F.col("comp").alias(x), F.col("root").alias(f"r_{x}"))
        open_ = open_.join(of("ca"), "ca").join(of("cb"), "cb").where("r_ca <> r_cb")
        open_ = stage_table(open_.select("a", "b", "w", F.col("r_ca").alias("ca"), F.col("r_cb").alias("cb")), "open-edges")
        if merges.select("root").distinct().limit(2).count() == 1:
            return tree


def dendrogram(tree: Tree) -> DataFrame:
    """(e, w, size, up): each tree edge (lo, hi), the number of points it joins, and the edge that joins these to others."""
    contributed = tree.choices[0].select(_edge()).groupBy("e").agg(F.count("*").alias("n"))
    done: DataFrame | None = None
    waiting: DataFrame | None = None
    for level in range(1, len(tree.edges) + 1):
        pending = tree.edges[level - 1].select(_edge(), "w", "root")
        pending = pending if waiting is None else pending.unionByName(waiting)
        waiting = None
        if level < len(tree.edges):
            cap = tree.choices[level].select(F.col("comp").alias("root"), F.struct("w", "lo", "hi").alias("cap"))
            capped = cut_lineage(pending.join(cap, "root"))
            inside = F.struct("w", F.col("e.lo").alias("lo"), F.col("e.hi").alias("hi")) < F.col("cap")
            merges = tree.merges[level].toDF("root", "after")
            waiting = capped.where(~inside).join(merges, "root").select("e", "w", F.col("after").alias("root"))
            placed = capped.where(inside).select("e", "w", "root", F.struct("cap.lo", "cap.hi").alias("top"))
        else:
            placed = pending.withColumn("top", F.lit(None).cast("struct<lo:long,hi:long>"))
        placed = placed.join(contributed.groupBy("e").agg(F.sum("n").alias("n")), "e")
        chained = scan_ordered(placed, ["root"], ["w", "e"], ["n"], ["e"])
        chained = stage_table(chained.select("e", "w", (F.col("n") + F.col("n_before")).alias("size"), F.coalesce("e_next", "top").alias("up"), F.col("e_next").isNull().alias("last")), "dendrogram")
        contributed = contributed.unionByName(chained.where("last AND up IS NOT NULL").select(F.col("up").alias("e"), F.col("size").alias("n")))
        part = chained.drop("last")
        done = part if done is None else done.unionByName(part)
    return done


def _best_below(state: DataFrame) -> DataFrame:
    """(c, parent, stability, value): ``value`` is the best total stability within each cluster (c, parent, stability).

    Clusters without open children are settled; a cluster with one open child is max(hi, add + value of it), and two
    such functions compose, so long chains shrink by half each round. Rounds are kept as tables: a checkpoint hands on the size
    that Spark guesses for its plan, the product of what is joined, a number of three times the digits with each round.
    """
    number = F.lit(None).cast("double")
    now = stage_table(state.withColumns({"value": number, "hi": number, "add": number, "next": F.lit(None).cast(state.schema["c"].dataType)}), "best-below")
    while not now.where("value IS NULL").isEmpty():
        below = now.where("parent IS NOT NULL").groupBy(F.col("parent").alias("p")).agg(
            F.coalesce(F.sum("value"), F.lit(0.0)).alias("base"), F.count_if(F.col("value").isNull()).alias("open"), F.max(F.when(F.col("value").isNull(), F.col("c"))).alias("one"))
        ahead = now.select(F.col("c").alias("n"), F.col("value").alias("n_value"), F.col("hi").alias("n_hi"), F.col("add").alias("n_add"), F.col("next").alias("n_next"))
        rows = now.join(below, F.col("c") == F.col("p"), "left").join(ahead, F.col("next") == F.col("n"), "left")
        base, open_ = F.coalesce("base", F.lit(0.0)), F.coalesce("open", F.lit(0))
        unary, fresh = F.col("next").isNotNull(), F.col("next").isNull() & (open_ == 1)
        compose = unary & F.col("n_next").isNotNull()
        value = F.when(unary & F.col("n_value").isNotNull(), F.greatest("hi", F.col("add") + F.col("n_value"))).when(open_ == 0, F.greatest("stability", base))
        now = stage_table(rows.select(
            "c", "parent", "stability", F.coalesce("value", value).alias("value"),
            F.when(compose, F.greatest("hi", F.col("add") + F.col("n_hi"))).when(fresh, F.col("stability")).otherwise(F.col("hi")).alias("hi"),
            F.when(compose, F.col("add") + F.col("n_add")).when(fresh, base).otherwise(F.col("add")).alias("add"),
            F.when(compose, F.col("n_next")).when(fresh, F.col("one")).otherwise(F.col("next")).alias("next")), "best-below")
    return now.select("c", "parent", "stability", "value")


def _chosen(clusters: DataFrame) -> DataFrame:
    """(c, pick): the chosen cluster that each cluster lies in, NULL for none."""
    settled = _best_below(clusters)
    below = settled.where("parent IS NOT NULL").groupBy(F.col("parent").alias("p")).agg(F.sum("value").alias("base"))
    own = F.col("parent").isNotNull() & (F.round(F.col("stability") - F.coalesce("base", F.lit(0.0)), DIGITS) >= 0)
    now = stage_table(settled.join(below, F.col("c") == F.col("p"), "left").select("c", F.col("parent").alias("up"), F.when(own, F.col("c")).alias("pick")), "chosen")
    while not now.where("up IS NOT NULL").isEmpty():  # the highest chosen cluster above, over twice the distance each round
        hop = now.toDF("n", "n_up", "n_pick")
        now = stage_table(now.join(hop, F.col("up") == F.col("n"), "left").select("c", F.col("n_up").alias("up"), F.coalesce("n_pick", "pick").alias("pick")), "chosen")
    return now.select("c", "pick")


def condense(tree: Tree, min_size: int = 8) -> DataFrame:
    """(id, cluster): the chosen cluster of each point, named by an edge, or NULL for noise."""
    joined = stage_table(dendrogram(tree), "joined")
    lam = 1.0 / F.greatest("w", F.lit(LEAST))
    big = joined.where(F.col("size") >= min_size)
    below = big.where("up IS NOT NULL").groupBy(F.col("up").alias("u")).agg(F.count("*").alias("sides"), F.sum("size").alias("held"))
    big = big.join(below, F.col("e") == F.col("u"), "left")
    big = stage_table(big.select("e", "up", lam.alias("lam"), F.coalesce(F.col("sides") == 2, F.lit(False)).alias("split"), F.when(F.col("sides") == 2, F.col("size")).otherwise(F.col("size") - F.coalesce("held", F.lit(0))).alias("ends")), "condensed")
    above = big.select(F.col("e").alias("u"), F.col("split").alias("parts"), F.col("lam").alias("birth"))
    seen = big.join(above, F.col("up") == F.col("u"), "left")
    top = F.col("up").isNull() | F.col("parts")
    cluster_of = follow(seen.select(F.col("e").alias("node"), F.when(top, F.col("e")).otherwise(F.col("up")).alias("up"))).toDF("e", "c")
    cluster_of = cut_lineage(cluster_of)
    heads = seen.where(top).select(F.col("e").alias("c"), F.coalesce("birth", F.lit(0.0)).alias("birth"), F.col("up").alias("at"))
    heads = heads.join(cluster_of.toDF("at", "parent"), "at", "left").select("c", "birth", "parent")
    masses = big.join(cluster_of, "e").join(heads.select("c", "birth"), "c").groupBy("c").agg(F.sum(F.col("ends") * (F.col("lam") - F.col("birth"))).alias("stability"))
    picked = _chosen(cut_lineage(heads.select("c", "parent").join(masses, "c")))
    small = joined.where((F.col("size") < min_size) & F.col("up").isNotNull()).select(F.col("e").alias("node"), "up")
    out_of = follow(small).toDF("e", "fell")  # a climb of fewer than ``min_size`` steps
    points = tree.choices[0].select(F.col("comp").alias("id"), _edge()).join(out_of, "e", "left").select("id", F.coalesce("fell", "e").alias("e"))
    named = points.join(cluster_of, "e", "left").join(picked, "c", "left")
    return named.select("id", F.col("pick").alias("cluster"))


def density_clusters(df: DataFrame, min_size: int = 8, samples: int = 2, id_col: str = "vec_id", vec: str = "embedding", pivots: int = 256, listed: int = 16) -> DataFrame:
    """(id, topic) of every row with a vector: topics from 0 by size (ties: by smallest id), -1 for noise.

    Vectors must be of one length; ids that repeat are an error. Rows without a vector take no part.
    """
    rows = df.where(F.col(id_col).isNotNull() & F.col(vec).isNotNull()).select(id_col, vec)
    if not rows.groupBy(id_col).count().where("count > 1").isEmpty():
        raise ValueError(f"{id_col} repeats")
    cells = into_cells(rows, id_col, vec, pivots)
    tree = spanning_tree(cells, samples, listed)
    alone = cells.rows.select("id", F.lit(-1).cast("long").alias("topic"))
    if not tree.edges:  # one point or none
        return alone.withColumnRenamed("id", id_col)
    found = stage_table(condense(tree, min_size), "clusters")
    sizes = found.where("cluster IS NOT NULL").groupBy("cluster").agg((-F.count("*")).alias("minus"), F.min("id").alias("first"), F.lit(1).alias("one"))
    ranked = scan_ordered(sizes, [], ["minus", "first"], ["one"]).select("cluster", F.col("one_before").cast("long").alias("topic"))
    return found.join(ranked, "cluster", "left").select(F.col("id").alias(id_col), F.coalesce("topic", F.lit(-1).cast("long")).alias("topic"))


def tree_edges(df: DataFrame, samples: int = 2, id_col: str = "vec_id", vec: str = "embedding", pivots: int = 256, listed: int = 16) -> DataFrame:
    """(lo, hi, weight) of the minimum spanning tree under mutual reachability."""
    tree = spanning_tree(into_cells(df, id_col, vec, pivots), samples, listed)
    out = df.sparkSession.createDataFrame([], "lo long, hi long, weight double")
    for part in tree.edges:
        out = out.unionByName(part.select("lo", "hi", F.col("w").alias("weight")))
    return out

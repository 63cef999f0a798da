"""Exact nearest neighbours of dense vectors: a blocked join with bounded heaps.

Vectors live in the cell of their nearest pivot. A cell is known by its radius and count, so by the triangle inequality a
query skips every cell that is farther away than its k-th neighbour can be. Cells are cut into blocks and the queries of a
cell into chunks; a task compares one block with one chunk and hands on k rows a query at most. Nothing depends on the
pivots but the work: any choice gives the same rows. Distances are Euclidean and rounded to nine digits, ties go to the
smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.session import stage_table

DIGITS = 9
BLOCK = 2048  # vectors of one block or chunk
STRIP = 1 << 22  # numbers compared at a time


@dataclass
class Cells:
    """Vectors by cell, and what the driver knows of each cell: at most one entry per pivot."""

    rows: DataFrame  # id, v, cell, and further columns
    pivots: np.ndarray
    radius: np.ndarray
    count: np.ndarray

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.count // BLOCK))


def vectors(column: pa.Array | pd.Series) -> np.ndarray:
    """Lists of one length as a matrix."""
    if isinstance(column, pd.Series):
        return np.stack(column.to_numpy()).astype(np.float64) if len(column) else np.zeros((0, 1))
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distances of all vectors to all pivots."""
    out = np.empty((len(x), len(pivots)))
    step = max(1, STRIP // max(1, pivots.size))
    for at in range(0, len(x), step):
        out[at : at + step] = np.sqrt(((x[at : at + step, None, :] - pivots[None]) ** 2).sum(axis=2))
    return out


def into_cells(df: DataFrame, id_col: str = "vec_id", vec: str = "embedding", pivots: int = 256, carry: Sequence[str] = ()) -> Cells:
    """Rows with a vector, dealt to the cells of at most ``pivots`` of them, chosen by a hash of the id."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec).cast("array<double>").alias("v"), *carry).where("id IS NOT NULL AND v IS NOT NULL")
    chosen = rows.orderBy(F.xxhash64("id"), "id").limit(pivots).select("v").toArrow()
    centres = vectors(chosen.column("v").combine_chunks()) if chosen.num_rows else np.zeros((1, 1))
    centres = np.unique(centres, axis=0)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                apart = to_pivots(vectors(batch.column(1)), centres)
                cell = apart.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(apart[np.arange(len(cell)), cell])], names=[*batch.schema.names, "cell", "apart"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    located = stage_table(rows.mapInArrow(locate, f"{kinds}, cell int, apart double"), "cells")
    radius, count = np.full(len(centres), -np.inf), np.zeros(len(centres), np.int64)
    for r in located.groupBy("cell").agg(F.max("apart").alias("r"), F.count("*").alias("n")).collect():  # one row per pivot at most
        radius[r["cell"]], count[r["cell"]] = r["r"], r["n"]
    return Cells(located.drop("apart"), centres, radius, count)


def nearest_rows(x: np.ndarray, y: np.ndarray, own: np.ndarray, others: np.ndarray, k: int, least: tuple[np.ndarray, np.ndarray] | None = None,
                 group: tuple[np.ndarray, np.ndarray] | None = None, pair_ids: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, distance): the k nearest rows of y of every row of x, itself left out.

    ``least`` are lower bounds of a row's distances (of x, of y), ``group`` labels whose equal rows don't meet.
    With ``pair_ids`` ties go to the smaller (lower id, higher id) instead of the smaller id.
    """
    found: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    yy = (y * y).sum(axis=1)
    slack = 1e-9 * (1.0 + float(yy.max(initial=0)) + float((x * x).sum(axis=1).max(initial=0)))
    step = max(1, STRIP // max(1, y.size))
    for at in range(0, len(x), step):
        part = x[at : at + step]
        square = np.maximum((part * part).sum(axis=1)[:, None] + yy - 2 * part @ y.T, 0)
        if least is not None:
            square = np.maximum(square, np.maximum(least[0][at : at + step, None], least[1]) ** 2)
        barred = own[at : at + step, None] == others
        if group is not None:
            barred |= group[0][at : at + step, None] == group[1]
        square[barred] = np.inf
        if not square.size:
            continue
        kth = np.partition(square, min(k, square.shape[1]) - 1, axis=1)[:, min(k, square.shape[1]) - 1]
        i, j = np.nonzero((square <= kth[:, None] + slack) & ~barred)
        d = np.sqrt(((part[i] - y[j]) ** 2).sum(axis=1)) if len(i) else np.zeros(0)
        d = np.round(d, DIGITS)
        if least is not None:
            d = np.maximum(d, np.maximum(least[0][at + i], least[1][j]))
        if pair_ids:
            order = np.lexsort((np.maximum(own[at + i], others[j]), np.minimum(own[at + i], others[j]), d, i))
        else:
            order = np.lexsort((others[j], d, i))
        i, j, d = i[order], j[order], d[order]
        rank = np.arange(len(i)) - np.searchsorted(i, i)
        found.append((at + i[rank < k], j[rank < k], d[rank < k]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def visits(queries: DataFrame, cells: Cells, reach, carry: Sequence[str] = ()) -> DataFrame:
    """(id, v, carry, to): a row for every cell a query visits; ``reach(pandas rows, distances to pivots)`` marks them."""

    pivots, held = cells.pivots, cells.count > 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            if len(rows):
                marked = reach(rows, to_pivots(vectors(rows["v"]), pivots)) & held
                row, to = np.nonzero(marked)
                for at in range(0, max(1, len(row)), BLOCK):  # a query may visit every cell: its vector is copied for a bounded part at a time
                    yield rows.iloc[row[at : at + BLOCK]].assign(to=to[at : at + BLOCK].astype(np.int32))

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in queries.select("id", "v", *carry).schema.fields)
    return queries.select("id", "v", *carry).mapInPandas(run, f"{kinds}, to int")


def compare(going: DataFrame, cells: Cells, base: DataFrame, fn, kinds: str, carry: Sequence[str] = (), base_carry: Sequence[str] = ()) -> DataFrame:
    """``fn(queries, vectors) -> rows`` of every chunk of visiting queries and every block of the visited cell."""
    counts = {r["to"]: r["n"] for r in going.groupBy("to").agg(F.count("*").alias("n")).collect()}  # one row per pivot at most
    chunks = np.maximum(1, -(-np.array([counts.get(c, 0) for c in range(len(cells.count))]) // BLOCK))
    per = lambda values: F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("c") + 1)
    left = going.withColumnRenamed("to", "c").withColumn("chunk", F.pmod(F.xxhash64(F.lit(1), "id"), per(chunks)).cast("int"))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), per(cells.blocks) - 1)))
    right = base.withColumnRenamed("cell", "c").withColumn("block", F.pmod(F.xxhash64(F.lit(2), "id"), per(cells.blocks)).cast("int"))
    right = right.withColumn("chunk", F.explode(F.sequence(F.lit(0), per(chunks) - 1)))
    left = left.select("c", "block", "chunk", "id", "v", *carry)
    right = right.select("c", "block", "chunk", "id", "v", *base_carry).toDF(*[f"y_{n}" for n in ("c", "block", "chunk", "id", "v", *base_carry)])
    return left.groupBy("c", "block", "chunk").cogroup(right.groupBy("y_c", "y_block", "y_chunk")).applyInPandas(fn, kinds)


def best_of(rows: DataFrame, k: int) -> DataFrame:
    """The k nearest of each id; partitions hand on k rows each."""
    w = Window.partitionBy("id").orderBy("distance", "other")
    return rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def nearest(queries: DataFrame, cells: Cells, k: int) -> DataFrame:
    """(id, other, distance, rank): the k nearest vectors of ``cells`` of each query (id, v), its own id left out."""
    count, radius = cells.count, cells.radius

    def near_cells(rows: pd.DataFrame, apart: np.ndarray) -> np.ndarray:
        """The nearest cells that hold over k vectors together."""
        order = np.argsort(apart, axis=1)
        before = np.cumsum(count[order], axis=1) - count[order]
        out = np.zeros(apart.shape, bool)
        np.put_along_axis(out, order, before <= k, axis=1)
        return out

    def pick(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        i, j, d = nearest_rows(vectors(left["v"]), vectors(right["y_v"]), left["id"].to_numpy(), right["y_id"].to_numpy(), k) if len(left) and len(right) else ([], [], [])
        return pd.DataFrame({"id": left["id"].to_numpy()[i], "other": right["y_id"].to_numpy()[j], "distance": d}) if len(i) else pd.DataFrame({"id": [], "other": [], "distance": []}).astype({"id": "int64", "other": "int64", "distance": "float64"})

    kinds = "id long, other long, distance double"
    first = stage_table(best_of(compare(visits(queries, cells, near_cells), cells, cells.rows, pick, kinds), k), "first-neighbours")
    bound = first.groupBy("id").agg(F.max("distance").alias("bound"), F.count("*").alias("n"))
    bound = queries.select("id", "v").join(bound, "id").withColumn("bound", F.when(F.col("n") >= k, F.col("bound")).otherwise(float("inf")))

    def others(rows: pd.DataFrame, apart: np.ndarray) -> np.ndarray:
        reach = apart - radius <= rows["bound"].to_numpy()[:, None] + 10.0 ** (1 - DIGITS)
        return reach & ~near_cells(rows, apart)

    further = compare(visits(bound, cells, others, ["bound"]), cells, cells.rows, pick, kinds)
    return best_of(first.select("id", "other", "distance").unionByName(further), k)


def nearest_neighbours(df: DataFrame, k: int, id_col: str = "vec_id", vec: str = "embedding", pivots: int = 256) -> DataFrame:
    """(id, other, distance, rank): the k nearest other rows of every row."""
    cells = into_cells(df, id_col, vec, pivots)
    return nearest(cells.rows, cells, k)


def nearest_in_groups(rows: DataFrame, k: int, by: Sequence[str] = (), block: int = 1024) -> DataFrame:
    """(id, other, distance, rank): the k nearest rows of the same group of every row (id, v, by); ids must be unique.

    Groups are cut into blocks; a task compares two blocks and hands on k rows a query, so no task holds a group.
    """
    group = F.xxhash64(*by) if by else F.lit(0).cast("long")
    rows = stage_table(rows.select(group.alias("g"), "id", "v"), "grouped-vectors")
    sizes = rows.groupBy("g").agg(F.ceil(F.count("*") / block).cast("int").alias("n"))
    dealt = rows.join(sizes, "g").withColumn("own", F.pmod(F.xxhash64("id"), F.col("n")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    left = dealt.select("g", F.col("own").alias("i"), F.col("other").alias("j"), "id", "v")
    right = dealt.select("g", F.col("other").alias("i"), F.col("own").alias("j"), "id", "v").toDF("y_g", "y_i", "y_j", "y_id", "y_v")

    def pick(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        if not len(x) or not len(y):
            return pd.DataFrame({"id": [], "other": [], "distance": []}).astype({"id": "int64", "other": "int64", "distance": "float64"})
        i, j, d = nearest_rows(vectors(x["v"]), vectors(y["y_v"]), x["id"].to_numpy(), y["y_id"].to_numpy(), k)
        return pd.DataFrame({"id": x["id"].to_numpy()[i], "other": y["y_id"].to_numpy()[j], "distance": d})

    met = left.groupBy("g", "i", "j").cogroup(right.groupBy("y_g", "y_i", "y_j")).applyInPandas(pick, "id long, other long, distance double")
    return best_of(met, k)

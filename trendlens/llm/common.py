"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.session import cut_lineage, release, scratch_path

__all__ = ["cut_lineage", "release", "table", "byte_texts", "ratio_of_hash", "bounded_rows", "light_side", "components"]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def byte_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, b"" for null."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def ratio_of_hash(col: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the value and the seed alone."""
    return F.pmod(F.xxhash64(F.lit(seed), col), F.lit(1 << 30)) / F.lit(float(1 << 30))


def bounded_rows(df: DataFrame, key: str, rows: int, seed: int = 7) -> DataFrame:
    """About ``rows`` rows of ``df`` (all of them, if there are fewer), chosen by a hash of ``key``.

    The sample is drawn inside the tasks: nothing is sorted and no task sees more than its share.
    Only model fitting uses this; the bound is a parameter of each operator that does.
    """
    total = df.count()
    return df if total <= rows else df.where(ratio_of_hash(F.col(key).cast("string"), seed) < rows / total)


def light_side(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """``df`` with a broadcast hint if a count proves that it has at most ``rows`` narrow rows.

    ``df`` must be materialised (a checkpoint or a table), so that the count is cheap; a larger side
    takes the shuffle join and gives the same rows.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Connected components of ``edges`` (u long, v long): rows (node, root), root the least node.

    Alternating large-star and small-star contraction: every round replaces the edges by edges to the
    least neighbour, so paths shorten exponentially and the edge count never grows. A node of very high
    degree is only ever aggregated (with map-side partials) and joined on its own key, where AQE splits it.
    Every round is checkpointed. Raises if ``rounds`` do not suffice, instead of returning part of the work.
    """
    now = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        now = cut_lineage(small.select("e.*").where("u <> v").distinct())
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table on the shared store: for wide rows, which a checkpoint wouldn't compress."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def bit_table(hashes: DataFrame, name: str = "hash", bits: int = 24) -> np.ndarray:
    """2 ** ``bits`` bits, packed, set for the top bits of every value of a long column.

    A prefilter of fixed size: 2 ** (bits - 6) words at most reach the driver, whatever the table's size. What it
    lets through is a superset; an exact join must follow.
    """
    slot = F.shiftrightunsigned(name, 64 - bits)
    bit = F.expr(f"shiftleft(1L, CAST(shiftrightunsigned({name}, {64 - bits}) % 64 AS INT))")
    words = hashes.where(F.col(name).isNotNull()).groupBy(F.floor(slot / 64).alias("w")).agg(F.bit_or(bit).alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 6), "<i8")
    out[words.column("w").to_numpy().astype(np.int64)] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def in_table(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of the 64-bit values are marked in a table of ``bit_table``."""
    bits = int(np.log2(len(packed))) + 3
    at = (values.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights (last: intercept) of ridge logistic regression by Newton's method; the intercept is free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + ridge * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        move = np.linalg.solve(hess, grad)
        w -= move * min(1.0, 5.0 / max(1e-9, np.abs(move).max()))
        if np.abs(move).max() < 1e-7:
            break
    return w


def pass_through(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with some columns replaced and others added."""
    names = list(batch.schema.names)
    arrays = [columns.pop(n) if n in columns else batch.column(i) for i, n in enumerate(names)]
    return pa.RecordBatch.from_arrays(arrays + list(columns.values()), names=names + list(columns))


def pieces(it: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of about ``size`` bytes, one row at least, so that few texts are Python objects at a time."""
    for batch in it:
        rows = max(1, int(size * batch.num_rows / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def batches(fn):
    """``fn(batch) -> batch`` as a function for ``mapInArrow``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from map(fn, pieces(it))

    return run

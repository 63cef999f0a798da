"""Terms of documents: counted inside the row, and in how many documents each of them occurs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendlens.session import stage_table

ROWS = 1 << 16  # documents of one block
ENTRIES = 1 << 22  # their terms
BITS = 63  # blocks that one mask tells apart


def first_and_counts(row: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, n, at) of entries (row, code): where each pair occurs first, sorted by pair, how often, and the pair of each entry."""
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.concatenate(([True], (code[1:] != code[:-1]) | (row[1:] != row[:-1]))) if len(code) else np.empty(0, bool)
    edges = np.flatnonzero(new)
    at = np.empty(len(code), np.int64)
    at[order] = np.cumsum(new) - 1
    return order[edges], np.diff(np.append(edges, len(code))), at


def lists(row: np.ndarray, rows: int, values: np.ndarray | pa.Array) -> pa.ListArray:
    """``values``, whose ``row`` ascends, as one list a row."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), values if isinstance(values, pa.Array) else pa.array(values))


def count_inside(df: DataFrame, unit: str, terms: str = "terms") -> DataFrame:
    """(unit, terms, n): the different terms of each row's array and how often they occur there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(1).flatten().dictionary_encode()
            row = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column(1).value_lengths().fill_null(0)))
            first, n, _ = first_and_counts(row, words.indices.to_numpy())
            kept = words.dictionary.take(words.indices.take(pa.array(first)))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists(row[first], batch.num_rows, kept), lists(row[first], batch.num_rows, n.astype(np.int32))], names=[unit, "terms", "n"])

    return df.select(unit, terms).mapInArrow(run, f"`{unit}` {df.schema[unit].dataType.simpleString()}, terms array<string>, n array<int>")


def with_frequencies(rows: DataFrame, unit: str, hashes: str = "hashes", rows_per_block: int = ROWS, entries_per_block: int = ENTRIES) -> DataFrame:
    """Add ``df``: for each of a row's different terms, known by 64-bit hashes, the number of rows that hold it.

    ``rows`` is read several times: pass a materialised table. It is dealt to blocks, and a block gets the frequencies of
    its own terms, so a term is sent once per block instead of once per row. Terms of a single row aren't sent at all.
    """
    total, entries = rows.agg(F.count("*"), F.coalesce(F.sum(F.size(hashes)), F.lit(0))).first()
    blocks = max(1, math.ceil(total / rows_per_block), math.ceil(entries / entries_per_block))
    own = F.pmod(F.xxhash64(unit), F.lit(blocks)).cast("int")
    names = rows.columns
    masks = [f"m{i}" for i in range(math.ceil(blocks / BITS))]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("own") % BITS)
    freq = rows.select(own.alias("own"), F.explode(hashes).alias("term")).groupBy("term").agg(
        F.count("*").cast("int").alias("df"), *[F.bit_or(F.when(F.floor(F.col("own") / BITS) == i, bit).otherwise(F.lit(0).cast("long"))).alias(m) for i, m in enumerate(masks)])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, df = batch.column("term").to_numpy(), batch.column("df").to_numpy()
            held = [batch.column(m).to_numpy() for m in masks]
            for block in range(blocks if len(term) else 0):
                at = np.flatnonzero(held[block // BITS] >> np.int64(block % BITS) & 1)
                if len(at):
                    offsets = pa.array([0, len(at)], pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([0], pa.int32()), *[pa.ListArray.from_arrays(offsets, pa.array(c[at])) for c in (term, df)]], names=["__block", "__side", hashes, "df"])

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, known, df = None, [], None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind = batch.column("__block").to_numpy().astype(np.int64) * 2 + batch.column("__side").to_numpy()
            edges = np.flatnonzero(np.concatenate(([True], kind[1:] != kind[:-1], [True])))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if kind[lo] // 2 != now:
                    now, held, known = kind[lo] // 2, [], None
                if kind[lo] % 2 == 0:
                    held.append((part.column(hashes).flatten().to_numpy(), part.column("df").flatten().to_numpy()))
                    continue
                if known is None:
                    known, df = (np.concatenate(c) for c in zip(*held, strict=True)) if held else (np.zeros(1, np.int64), np.ones(1, np.int32))
                    order, held = np.argsort(known), []
                    known, df = known[order], df[order]
                sizes, term = np.asarray(part.column(hashes).value_lengths().fill_null(0)), part.column(hashes).flatten().to_numpy()
                at = np.minimum(np.searchsorted(known, term), len(known) - 1)
                found = np.where(known[at] == term, df[at], 1).astype(np.int32)
                offsets = pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in names], pa.ListArray.from_arrays(offsets, pa.array(found))], names=[*names, "df"])

    dealt = freq.where("df > 1").mapInArrow(deal, f"__block int, __side int, `{hashes}` array<long>, df array<int>")
    both = dealt.unionByName(rows.select(own.alias("__block"), F.lit(1).alias("__side"), *rows.columns), allowMissingColumns=True)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return both.repartitionById(blocks, "__block").sortWithinPartitions("__block", "__side").mapInArrow(look_up, f"{fields}, df array<int>")


def counted_rows(df: DataFrame, unit: str, terms: str = "terms") -> DataFrame:
    """(unit, terms, n, hashes), one row a document, from a table on the shared store; hashes are made as it is read, they don't compress."""
    return stage_table(count_inside(df, unit, terms), "terms").withColumn("hashes", F.transform("terms", lambda t: F.xxhash64(t)))

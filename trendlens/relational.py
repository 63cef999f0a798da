"""Small relational helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trendlens.session import cut_lineage, stage_table


PIECE = 4 << 20  # bytes of an Arrow batch that are Python objects at a time


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches of about ``PIECE`` bytes, one row at least: a task's memory doesn't follow the length of its texts."""
    for batch in batches:
        rows = max(1, int(PIECE * batch.num_rows / max(1, batch.nbytes)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    """Raise ``ValueError`` naming the columns of ``names`` that ``df`` lacks."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column], last: bool = False) -> DataFrame:
    """First (or last) row per key under ``order``.

    A limit of one row per group: every map task reduces its rows to one per key before the shuffle (Spark plans a group
    limit on either side of it), so a key that holds a large share of all rows never meets in one task as a whole, and ``df``
    is evaluated once. NULL keys form one group. ``order`` must be a total order (end it with a row id); NULL comes first.
    """
    by = [c.desc_nulls_last() if last else c.asc_nulls_first() for c in order]
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*by)))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def nulls_last(col: Column | str) -> list[Column]:
    """Two ordering columns that sort NULL after every value inside a struct comparison."""
    c = F.col(col) if isinstance(col, str) else col
    return [c.isNull().cast("int"), c]


def anti_join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``left`` whose key tuple, NULLs compared as equal, is absent from ``right``."""
    seen = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        term = left[k].eqNullSafe(seen[f"__r_{k}"])
        cond = term if cond is None else cond & term
    return left.join(seen, cond, "left_anti")


def share(part: Column, whole: Column) -> Column:
    """``part / whole`` as double, 0 when the whole is 0 or NULL."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def _same(pairs: Iterable[tuple[str, str]]) -> Column:
    """All pairs of columns are equal, NULLs too."""
    cond = F.lit(True)
    for a, b in pairs:
        cond = cond & F.col(a).eqNullSafe(F.col(b))
    return cond


def scan_ordered(df: DataFrame, by: Sequence[str], order: Sequence[str], sums: Sequence[str] = (), following: Sequence[str] = (), parts: int | None = None) -> DataFrame:
    """Add ``<s>_before``, the total over the earlier rows of the group, and ``<c>_next``, the value in the next row.

    ``order`` must be a total order inside a group. Rows are dealt to ``parts`` ranges of (group, order), cut where a sample
    of the rows says, so that ranges hold alike many rows however the values lie, and a group of any size spreads over
    them. Windows see one range of one group; a row per range and group carries totals and first rows across.
    """
    by, order = list(by), list(order)
    spark = df.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cut = stage_table(df.repartitionByRange(parts, *by, *order).withColumn("__part", F.spark_partition_id()), "ordered")
    first = F.struct(*order, *[F.col(c).alias(f"__f{i}") for i, c in enumerate(following)])
    totals = cut.groupBy(*by, "__part").agg(F.min(first).alias("__first"), *[F.sum(s).alias(f"__t_{s}") for s in sums])
    across = Window.partitionBy(*by).orderBy("__part")
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *[F.col(k).alias(f"__o_{k}") for k in by], F.col("__part").alias("__opart"), F.lead("__first").over(across).alias("__after"),
        *[F.coalesce(F.sum(f"__t_{s}").over(earlier), F.lit(0)).alias(f"__off_{s}") for s in sums])
    joined = cut.join(offsets, _same([("__part", "__opart"), *[(k, f"__o_{k}") for k in by]]))
    inside = Window.partitionBy(*by, "__part").orderBy(*order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    last = F.lead(F.lit(True)).over(inside).isNull()
    return joined.select(
        *df.columns, *[(F.col(f"__off_{s}") + F.coalesce(F.sum(s).over(before), F.lit(0))).alias(f"{s}_before") for s in sums],
        *[F.when(last, F.col(f"__after.__f{i}")).otherwise(F.lead(c).over(inside)).alias(f"{c}_next") for i, c in enumerate(following)])


def ordered_prefix_sums(df: DataFrame, by: Sequence[str], value: str, sums: Sequence[str], parts: int | None = None) -> DataFrame:
    """Add, for each column of ``sums``, its total over rows of the group with a smaller ``value``; ``df`` must hold one row per (group, value)."""
    return scan_ordered(df, by, [value], sums, parts=parts)


def follow(pointers: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) of rows (node, up): where the chain of pointers from each node ends, by doubling.

    A chain ends at a value that is no node or that points to itself. Each round is checkpointed and covers twice the distance.
    """
    now = cut_lineage(pointers.select("node", "up"))
    for _ in range(rounds):
        hop = now.select(F.col("node").alias("__n"), F.col("up").alias("__u"))
        step = now.join(hop, F.col("up") == F.col("__n"), "left")
        now = cut_lineage(step.select("node", F.coalesce("__u", "up").alias("up"), (F.col("__u").isNotNull() & (F.col("__u") != F.col("up"))).alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("node", F.col("up").alias("root"))
        now = now.drop("moved")
    raise ValueError("pointers form a cycle")


def connected(edges: DataFrame, rounds: int = 64) -> DataFrame:
    """(node, root) of every node of ``edges`` (u long, v long): the least node that it is connected to.

    Each round hooks every component to the least neighbouring one and contracts the chains, so components halve at least.
    """
    roots = None
    now = cut_lineage(edges.where("u <> v").select("u", "v").distinct())
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = follow(both.groupBy("u").agg(F.least("u", F.min("v")).alias("up")).toDF("node", "up"), rounds)
        if roots is None:
            roots = step
        else:
            hop = step.toDF("root", "next")
            roots = cut_lineage(roots.join(hop, "root", "left").select("node", F.coalesce("next", "root").alias("root")))
        a, b = step.toDF("u", "a"), step.toDF("v", "b")
        now = cut_lineage(now.join(a, "u").join(b, "v").where("a <> b").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct())
        if now.isEmpty():
            return roots
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def group_percentiles(df: DataFrame, by: Sequence[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact interpolated quantiles per group, computed from ranks.

    Equal values are counted first; ranks come from :func:`ordered_prefix_sums`, so a group that
    holds most rows is spread over its value bins instead of being gathered in one task.
    """
    by = list(by)
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).cast("double").alias("__v")).agg(
        F.count(F.lit(1)).alias("__n")
    )
    ranked = ordered_prefix_sums(counts, by, "__v", ["__n"])
    total = counts.groupBy(*[F.col(k).alias(f"__g_{k}") for k in by]).agg(F.sum("__n").alias("__total"))
    if by:
        cond = None
        for k in by:
            term = F.col(k).eqNullSafe(F.col(f"__g_{k}"))
            cond = term if cond is None else cond & term
        ranked = ranked.join(total, cond)
    else:
        ranked = ranked.join(F.broadcast(total), F.lit(True))  # one row
    lo, hi = F.col("__n_before"), F.col("__n_before") + F.col("__n")
    aggs = []
    for q in quantiles.values():
        spot = (F.col("__total") - 1) * F.lit(float(q))
        below, above = F.floor(spot), F.ceil(spot)
        aggs.append(F.max(F.when((below >= lo) & (below < hi), F.col("__v"))))
        aggs.append(F.max(F.when((above >= lo) & (above < hi), F.col("__v"))))
        aggs.append(F.max(spot - below))
    named = [a.alias(f"__a{i}") for i, a in enumerate(aggs)]
    out = ranked.groupBy(*by).agg(*named)
    cols = []
    for i, name in enumerate(quantiles):
        a, b, f = (F.col(f"__a{3 * i + j}") for j in range(3))
        cols.append((a + (b - a) * f).alias(name))
    return out.select(*by, *cols)


def single_row(df: DataFrame) -> DataFrame:
    """``df`` as the broadcast side of a join; running it fails if there is more than one row."""
    row = F.struct(*[F.col(c) for c in df.columns])
    one = df.agg(F.count(F.lit(1)).alias("__n"), F.any_value(row).alias("__row"))
    checked = F.when(F.col("__n") <= 1, F.col("__row")).otherwise(F.raise_error(F.lit("one row expected for a table without series")))
    return F.broadcast(one.where("__n > 0").select(checked.alias("__row")).select("__row.*"))

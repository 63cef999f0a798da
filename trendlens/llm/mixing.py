"""Mix sources to target weights by a low-discrepancy schedule; DataFrame and SQL functions only.

1. A document's size is its number of words. Targets share 100% of all sizes by weight; a target stops at
   ``cap`` times its source's size and the excess goes to the others by weight (water-filling).
2. Slot n of the mix has the point frac(n x golden ratio). The cumulative target shares map it to a source,
   so every stretch of the mix has nearly the target proportions. Slots are ranked within their source.
3. Each source's documents are shuffled (by hash) into one stream of words, cut into blocks of ``block``
   words. The source's k-th slot takes its block k mod (number of blocks); a block is taken at most ``cap``
   times, a document's words at most ``cap`` times its size.

Scale: a source may hold any share of the rows. Offsets in a stream and ranks of slots are sums in two
levels: per hash bucket or stretch of slots first (bounded windows, as bucket counts follow the row
count), then over the buckets' totals. Only one row per source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trendlens.llm.common import cut_lineage

GOLDEN = 0.6180339887498949
CELLS = 1024


def word_count(text) -> "F.Column":
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, cap: float = 3.0, cycle: int = 3) -> DataFrame:
    """(source, source_size, weight, target), one row per source of ``sizes`` (source, size).

    Sources in code point order, null last, weigh 1, 2, .. ``cycle``, repeating. Sources whose
    cap / weight is least are full first; with the first j full, the rest get
    (total - their caps) / (remaining weight) per unit of weight. The right j is the first one for which the
    next source isn't above its cap. The windows are global over one row per source.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = by_source.withColumn("weight", ((F.row_number().over(order) - 1) % cycle + 1).cast("double"))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    upto, whole = fill.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    ranked = ranked.withColumn("full_cap", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
    ranked = ranked.withColumn("full_weight", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
    ranked = ranked.withColumn("total", F.sum("source_size").over(whole)).withColumn("weights", F.sum("weight").over(whole))
    ranked = ranked.withColumn("level", F.try_divide(F.col("total") - F.col("full_cap"), F.col("weights") - F.col("full_weight")))
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    # from the first source that fits on, all do, at that source's level; those before it are full
    ranked = ranked.withColumn("first", F.min(F.when(fits, F.struct("full_weight", "level"))).over(whole))
    open_ = F.col("full_weight") >= F.col("first.full_weight")
    target = F.when(open_, F.col("first.level") * F.col("weight")).otherwise(F.col("cap"))
    return ranked.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix(docs: DataFrame, block: int = 128, cap: int = 3, bucket_rows: int = 4096, seed: int = 11) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken): what the mix takes of every document, repeats counted.

    Null text: size 0, nothing taken. Null sources are a source of their own. Repeated rows are documents of
    their own. Other columns of ``docs`` don't matter. Empty input: no rows.
    """
    sized = cut_lineage(docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), word_count(F.col("text")).alias("size")))
    targets = cut_lineage(source_targets(sized, cap).withColumn("sid", F.xxhash64(F.coalesce("source", F.lit("\u0000null")), F.col("source").isNull())))
    rows, words = sized.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    docs_at = sized.withColumn("sid", F.xxhash64(F.coalesce("source", F.lit("\u0000null")), F.col("source").isNull()))
    placed = _stream(docs_at, max(1, rows // bucket_rows), seed)

    # slots: point -> source, through cells that a few sources cover each
    slots = -(-words // block)
    share = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, 0)
    edges = targets.where("target > 0").withColumn("hi", F.sum("target").over(share)).withColumn("all", F.sum("target").over(Window.partitionBy()))
    edges = edges.select("sid", "source_size", ((F.col("hi") - F.col("target")) / F.col("all")).alias("lo"), F.when(F.row_number().over(Window.orderBy(F.desc("sid"))) == 1, F.lit(2.0)).otherwise(F.col("hi") / F.col("all")).alias("hi"))
    cells = edges.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * CELLS).cast("int"), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1)).cast("int"))))
    drawn = docs.sparkSession.range(slots).select(F.col("id").alias("n"), (F.col("id") + 1).alias("m"))
    drawn = drawn.select("n", (F.col("m") * F.lit(GOLDEN) - F.floor(F.col("m") * F.lit(GOLDEN))).alias("point"))
    drawn = drawn.withColumn("cell", F.floor(F.col("point") * CELLS).cast("int"))
    drawn = drawn.join(cells, "cell").where("point >= lo AND point < hi").select("n", "sid", "source_size")

    # rank of a slot in its source: slots of earlier stretches, then the place inside the stretch
    drawn = drawn.withColumn("stretch", F.floor(F.col("n") / bucket_rows))
    per = drawn.groupBy("sid", "stretch").agg(F.count("*").alias("slots"))
    before = Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("sid", "stretch", F.coalesce(F.sum("slots").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy("sid", "stretch").orderBy("n")) - 1
    ranked = drawn.withColumn("inside", inside).join(per, ["sid", "stretch"]).withColumn("k", F.col("earlier") + F.col("inside"))
    blocks = F.ceil(F.col("source_size") / block)
    used = ranked.where(F.col("k") < blocks * cap).groupBy("sid", (F.col("k") % blocks).alias("b")).agg(F.count("*").alias("times"))

    # documents cut at block borders meet the slots that take their blocks
    end = F.col("start") + F.col("size")
    pieces = placed.where("size > 0").withColumn("b", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))))
    length = F.least(end, (F.col("b") + 1) * block) - F.greatest(F.col("start"), F.col("b") * block)
    taken = pieces.withColumn("length", length).join(used, ["sid", "b"]).groupBy("sid", "start").agg(F.sum(F.col("length") * F.col("times")).alias("taken"))
    taken = taken.withColumnRenamed("sid", "taken_sid").withColumnRenamed("start", "taken_start")
    out = placed.join(taken, (F.col("size") > 0) & (F.col("sid") == F.col("taken_sid")) & (F.col("start") == F.col("taken_start")), "left")
    shares = targets.select("sid", "source_size", "target")
    return out.join(shares, "sid").select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def _stream(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """``docs`` with ``start``: the words of its source before it, in an order shuffled by hash."""
    mark = F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("size"))
    docs = docs.withColumn("mark", mark).withColumn("bucket", F.pmod(F.shiftright("mark", 7), F.lit(buckets)))
    per = docs.groupBy("sid", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("sid", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("earlier"))
    inside = Window.partitionBy("sid", "bucket").orderBy("mark", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    docs = docs.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    return docs.join(per, ["sid", "bucket"]).select("sid", "doc_id", "source", "size", (F.col("earlier") + F.col("inside")).alias("start"))

"""Readers for raw batches, scraped corpora and stage tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in
                           ("title", "description", "source", "publishedAt", "content", "url")])

SCRAPED_FIELDS = ("title", "text", "description", "content", "publishedAt", "source", "url")


def read_raw_articles(spark: SparkSession, glob: str, multi_line: bool = True) -> DataFrame:
    """All raw batch files with file name and position: one JSON array per file, or per line.

    A file (or line) that cannot be parsed contributes no rows; :func:`unreadable_files` lists them.
    """
    return _raw(spark, glob, multi_line).where(F.col("_corrupt_record").isNull() | _has_data()).drop("_corrupt_record")


def unreadable_files(spark: SparkSession, glob: str) -> DataFrame:
    return _raw(spark, glob, True).where(F.col("_corrupt_record").isNotNull() & ~_has_data()).select("file").distinct()


def _has_data():
    """Some field was parsed. Also keeps a data column in the filter: Spark refuses to read the
    corrupt-record column alone, as a bare count would."""
    return F.coalesce(*RAW_SCHEMA.fieldNames()).isNotNull()


def _raw(spark: SparkSession, glob: str, multi_line: bool) -> DataFrame:
    # A JSON array is parsed by one task as a whole, so its records come out in file order.
    schema = T.StructType([*RAW_SCHEMA.fields, T.StructField("_corrupt_record", T.StringType())])
    return (
        spark.read.schema(schema)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("ignoreCorruptFiles", True)
        .json(glob)
        .select("*", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("pos"))
    )


def read_scraped_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Scraped corpus: an array of articles, or an object with an ``articles`` array.

    ``source`` may be a string or an object with a ``name``.
    """
    item = T.StructType([T.StructField(n, T.StringType()) for n in SCRAPED_FIELDS])
    schema = T.StructType([*item.fields, T.StructField("articles", T.ArrayType(item))])
    raw = spark.read.schema(schema).option("multiLine", multi_line).option("ignoreCorruptFiles", True).json(path)
    pos = F.monotonically_increasing_id()
    numbered = raw.select("*", pos.alias("__pos"))
    flat = numbered.where(F.col("articles").isNull()).select(*SCRAPED_FIELDS, F.col("__pos"), F.lit(0).alias("__i"))
    nested = numbered.where(F.col("articles").isNotNull()).select("__pos", F.posexplode("articles").alias("__i", "a")).select(
        *[F.col(f"a.{n}").alias(n) for n in SCRAPED_FIELDS], "__pos", "__i")
    both = flat.unionByName(nested)
    return both.withColumn("source", source_name(F.col("source"))).withColumnRenamed("__pos", "file_pos").withColumnRenamed("__i", "item_pos")


def source_name(col):
    """Name of a source given as plain text or as a JSON object."""
    is_object = F.trim(col).startswith("{")
    return F.when(is_object, F.coalesce(F.get_json_object(col, "$.name"), F.lit(""))).otherwise(col)


def latest_file(spark: SparkSession, glob: str) -> DataFrame:
    """Path and time of the newest file matching ``glob``; raises when nothing matches."""
    files = (
        spark.read.format("binaryFile").load(glob)
        .select("path", F.col("modificationTime").alias("modified"))
    )
    return files.orderBy(F.col("modified").desc(), F.col("path").desc()).limit(1)


def read_stage_table(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Table written by an earlier stage."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.schema(schema).csv(path) if schema is not None else reader.csv(path)


def first_available(spark: SparkSession, paths: Sequence[str], required: str | None = None, fmt: str = "parquet") -> DataFrame:
    """First of ``paths`` that can be read and, when asked, has column ``required``."""
    for path in paths:
        try:
            df = read_stage_table(spark, path, fmt)
        except AnalysisException:
            continue
        if required is None or required in df.columns:
            return df
    raise FileNotFoundError(f"none of {list(paths)} is readable" + (f" with column {required}" if required else ""))


def newest_change(spark: SparkSession, path: str) -> DataFrame:
    """One row: latest modification time among the files under ``path``, from the listing alone; no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)  # only the time is read, not the content
    return files.select(F.col("modificationTime").alias("t")).agg(F.max("t").alias("modified"))


def is_stale(spark: SparkSession, inputs: Sequence[str], output: str, max_age_hours: float = 24.0) -> bool:
    """True when ``output`` is missing, older than any input, or older than ``max_age_hours``."""
    try:
        out = newest_change(spark, output)
        newest_in = None
        for path in inputs:
            one = newest_change(spark, path)
            newest_in = one if newest_in is None else newest_in.unionByName(one)
    except AnalysisException:
        return True
    ins = newest_in.agg(F.max("modified").alias("in_modified")) if newest_in is not None else None
    row = out if ins is None else out.join(F.broadcast(ins), F.lit(True))  # one row each
    age = F.current_timestamp() > F.col("modified") + F.make_dt_interval(hours=F.lit(0), secs=F.lit(max_age_hours * 3600))
    older = F.lit(False) if ins is None else F.col("in_modified") > F.col("modified")
    flag = row.select(F.coalesce(age | older | F.col("modified").isNull(), F.lit(True)).alias("stale")).first()
    return bool(flag["stale"])

"""Writers for batches, corpora, stage tables, reports and daily refreshes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.sources.readers import is_stale, read_stage_table


def write_raw_batch(df: DataFrame, path: str, ingest_ts: str, fmt: str = "json") -> None:
    """Append one batch under its own ``ingest_ts`` partition; nothing is written for an empty batch."""
    if df.isEmpty():
        return
    df.withColumn("ingest_ts", F.lit(ingest_ts)).write.mode("append").partitionBy("ingest_ts").format(fmt).save(path)


def write_corpus(df: DataFrame, path: str) -> None:
    """Append new articles to the corpus table."""
    df.write.mode("append").parquet(path)


def write_stage_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Replace the table of one stage."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(**options).csv(path)
    else:
        writer.format(fmt).save(path)


def write_report(report: DataFrame, path: str, text_path: str | None = None) -> None:
    """One-row report of nested structs as JSON, and as indented text when ``text_path`` is given."""
    report.coalesce(1).write.mode("overwrite").json(path)
    if text_path is not None:
        body = F.to_json(F.struct("*"), {"pretty": "true"})
        report.select(body.alias("value")).coalesce(1).write.mode("overwrite").text(text_path)


def refresh_daily(spark: SparkSession, inputs: Sequence[str], output: str, build: Callable[[], DataFrame],
                  max_age_hours: float = 24.0) -> DataFrame:
    """Daily table, rebuilt through ``build`` when stale, else read back as it is."""
    if is_stale(spark, inputs, output, max_age_hours):
        write_stage_table(build(), output)
    return read_stage_table(spark, output)

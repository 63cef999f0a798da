"""Stored tables with a key: upserts that rewrite touched partitions only, and a manifest of the keys that were processed.

Rows lie in folders by the day of ``time_col``, which is part of the key, so equal keys are of one folder. The manifest holds a
128-bit hash per processed key in the same folders, so new rows are told apart by reading narrow rows of the days that come
in. Data goes first, the manifest after it: a run that breaks off between the two is done again and replaces itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.relational import anti_join_null_safe, keep_one
from trendlens.session import cut_lineage, stage_table

ARTICLE_KEY = ("title", "publishedAt", "source")
PART = "part"


@dataclass
class KeyedTable:
    """The table ``path/rows`` and its manifest ``path/keys``."""

    spark: SparkSession
    path: str
    keys: Sequence[str] = ARTICLE_KEY
    time_col: str = "publishedAt"

    def __post_init__(self) -> None:
        if self.time_col not in self.keys:
            raise ValueError("time_col must be one of keys")

    def with_part(self, df: DataFrame) -> DataFrame:
        day = F.date_format(F.col(self.time_col).try_cast("timestamp"), "yyyyMMdd")
        return df.withColumn(PART, F.concat(F.lit("d"), F.coalesce(day, F.lit("none"))))  # a letter keeps it text

    def key_hash(self) -> Column:
        return F.md5(F.concat_ws("\x01", *[F.coalesce(F.concat(F.lit("v"), F.col(k).cast("string")), F.lit("n")) for k in self.keys]))

    def parts_of(self, df: DataFrame) -> list[str]:
        """The folders that the rows of ``df`` belong to: at most one per day."""
        return [r[0] for r in df.select(PART).distinct().collect()]

    def _stored(self, name: str, parts: Sequence[str] | None = None) -> DataFrame | None:
        try:
            rows = self.spark.read.parquet(f"{self.path}/{name}")
        except AnalysisException:  # not written yet
            return None
        return rows if parts is None else rows.where(F.col(PART).isin(*parts)) if parts else rows.limit(0)

    def read(self) -> DataFrame | None:
        rows = self._stored("rows")
        return None if rows is None else rows.drop(PART)

    def unseen(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key no run has processed."""
        rows = self.with_part(df)
        known = self._stored("keys", self.parts_of(rows))
        if known is None:
            return df
        own = rows.withColumn("__key", self.key_hash())
        return own.join(known.select(F.col("key").alias("__key")).distinct(), "__key", "left_anti").select(*df.columns)

    def missing_in(self, other: KeyedTable) -> DataFrame | None:
        """Stored rows whose key ``other`` has not processed; keys are compared first, whole rows are read from their days only."""
        rows, known = self._stored("rows"), other._stored("keys")
        if rows is None:
            return None
        if known is None:
            return rows.drop(PART)
        keys = rows.select(PART, self.key_hash().alias("__key")).join(known.select(PART, F.col("key").alias("__key")), [PART, "__key"], "left_anti")
        keys = cut_lineage(keys.distinct())
        some = self._stored("rows", self.parts_of(keys))
        return some.withColumn("__key", self.key_hash()).join(keys, [PART, "__key"], "left_semi").drop(PART, "__key")

    def _overwrite(self, rows: DataFrame, name: str, spread: Column) -> None:
        """Replace the folders that ``rows`` belong to; all others stay. A day's rows are dealt to tasks by ``spread``."""
        writer = stage_table(rows, name).repartition(PART, spread).write  # staged first: a folder isn't overwritten while it is read
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(f"{self.path}/{name}")

    def upsert(self, rows: DataFrame, order: str = "article_id", processed: DataFrame | None = None) -> None:
        """Add ``rows``, replacing stored rows of the same key; of rows that share a key the last by ``order`` stays.

        ``processed`` (default: ``rows``) are the rows whose keys count as processed, kept or not. Columns that one side lacks
        are NULL there.
        """
        fresh = self.with_part(keep_one(cut_lineage(rows), self.keys, [F.col(order)], last=True))
        stored = self._stored("rows", self.parts_of(fresh))
        if stored is not None:
            fresh = anti_join_null_safe(stored, fresh, self.keys).unionByName(fresh, allowMissingColumns=True)
        self._overwrite(fresh, "rows", F.pmod(F.xxhash64(*self.keys), F.lit(16)))
        self.mark(rows if processed is None else processed)

    def mark(self, rows: DataFrame) -> None:
        """Count the keys of ``rows`` as processed."""
        own = self.with_part(rows).select(PART, self.key_hash().alias("key")).distinct()
        known = self._stored("keys", self.parts_of(own))
        if known is not None:
            own = known.select(PART, "key").unionByName(own.select(PART, "key")).distinct()
        self._overwrite(own, "keys", F.pmod(F.xxhash64("key"), F.lit(4)))

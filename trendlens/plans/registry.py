"""Registry of named queries: the Spark function, its output columns and the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendlens.session import cut_lineage
from trendlens.sources.adapters import VIEWS_SQL

# Kinds of output columns, one letter each: s text, i integer, d double, b boolean.
_SPARK = {
    "s": lambda c: F.col(c).cast("string"),
    "i": lambda c: F.col(c).cast("long"),
    "d": lambda c: F.round(F.col(c).cast("double"), 6) + F.lit(0.0),
    "b": lambda c: F.col(c).cast("boolean"),
}
_SQL = {
    "s": 'CAST("{0}" AS VARCHAR)',
    "i": 'CAST("{0}" AS BIGINT)',
    "d": 'round(CAST("{0}" AS DOUBLE), 6) + 0.0',
    "b": 'CAST("{0}" AS BOOLEAN)',
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    columns: tuple[tuple[str, str], ...]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(spark, folder)
        if not self.columns:
            return df
        return df.select(*[_SPARK[kind](name).alias(name) for name, kind in self.columns])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql.strip()
        if body.upper().startswith("WITH "):
            views, body = VIEWS_SQL + ", " + body[5:], ""
            # the last top-level SELECT is marked by a line that starts with "RESULT"
            views, body = views.split("\nRESULT", 1)
        else:
            views = VIEWS_SQL
        cols = ", ".join(f'{_SQL[kind].format(name)} AS "{name}"' for name, kind in self.columns)
        return f"WITH RECURSIVE {views} SELECT {cols} FROM ({body.strip()}) AS result"


REGISTRY: dict[str, Query] = {}

_STAGES: dict[tuple[str, str, str], DataFrame] = {}


def stage(name: str, spark: SparkSession, folder: str, build: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """Materialised intermediate table of one session, built on first use."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _STAGES:
        _STAGES[key] = cut_lineage(build(spark, folder))
    return _STAGES[key]


def columns(spec: str) -> tuple[tuple[str, str], ...]:
    """``"date:s total:i"`` -> (("date", "s"), ("total", "i"))."""
    return tuple((n, k) for n, k in (item.rsplit(":", 1) for item in spec.split()))


def query(name: str, spec: str = "", sql: str | None = None):
    """Register ``fn(spark, folder) -> DataFrame`` under ``name``."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        REGISTRY[name] = Query(name, fn, columns(spec), sql)
        return fn

    return add

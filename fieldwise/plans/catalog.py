"""Registry of the queries run over the driver tables.

Each entry pairs a Spark builder ``(spark, sf_dir) -> DataFrame`` with the
equivalent DuckDB SQL over the same Parquet tables (``None`` where the
operator has no SQL form). Output timestamps are naive UTC wall clocks, the
way DuckDB returns ``TIMESTAMP``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_semantics
from ..sources.tables import read_table


@dataclass(frozen=True)
class Registered:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    operators: str


REGISTRY: dict[str, Registered] = {}


def naive_output(df: DataFrame) -> DataFrame:
    """Instants leave as naive UTC wall clocks (DuckDB ``TIMESTAMP``)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            cols.append(F.col(f.name).cast("timestamp_ntz").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None, operators: str):
    """Register ``fn(spark, sf_dir)``; the result is passed through ``naive_output``."""

    def wrap(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_semantics(spark)
            return naive_output(fn(spark, sf_dir))

        build.__name__ = fn.__name__
        build.__doc__ = fn.__doc__
        REGISTRY[name] = Registered(name, build, sql, operators)
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, name, columns or None)

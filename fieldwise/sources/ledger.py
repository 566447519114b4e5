"""Operational logs as tables (S15) and landed JSON payloads.

The API call ledger is JSON lines: one call per line with its instance,
path, parameters, HTTP status, rows returned and latency. It feeds quota
accounting (A-11) and latency figures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CALL_LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("ts", T.TimestampType()),
        T.StructField("instance", T.StringType()),
        T.StructField("path", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("status", T.IntegerType()),
        T.StructField("rows", T.LongType()),
        T.StructField("ms", T.LongType()),
    ]
)


def read_call_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The call ledger with an explicit schema (no inference, malformed lines kept null)."""
    return spark.read.schema(CALL_LEDGER_SCHEMA).option("mode", "PERMISSIVE").json(path)


def call_latency(ledger: DataFrame) -> DataFrame:
    """Calls, errors and latency percentiles per instance and path."""
    return ledger.groupBy("instance", "path").agg(
        F.count(F.lit(1)).alias("calls"),
        F.count_if(F.col("status") >= 400).alias("errors"),
        F.percentile_approx("ms", [0.5, 0.95], 1000).alias("ms_p50_p95"),
    )


def read_landed_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Landed API payloads (nested JSON) with a declared schema.

    ``_sweep_from``/``_sweep_to`` (the window a sweep covered) travel with
    each row when present in the schema.
    """
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)

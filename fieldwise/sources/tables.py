"""Scans (S1, S3, S4-S6, S13).

Every scan goes through ``spark.read`` with the column list the caller needs,
so Catalyst prunes columns and pushes filters into the Parquet reader. Naive
timestamps (``timestamp_ntz``, how the landed files read) are turned into
instants once, here, because watermarks, ``greatest`` over instants and zone
functions need ``timestamp`` (trap T19).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import entity_today, local_date
from ..operators.joins import bounded_broadcast, keep_bound
from ..session import ensure_semantics

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def as_instants(df: DataFrame) -> DataFrame:
    """Cast every ``timestamp_ntz`` column to ``timestamp`` (UTC session)."""
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.TimestampNTZType):
            cols.append(F.col(field.name).cast("timestamp").alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


#: Rows a task sorts or hashes at once: some hundred MB even where a row holds a report's text.
ROWS_PER_TASK = 250_000


def spread(scan: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """A scan dealt evenly over as many partitions as its rows need, so that what a task holds
    does not grow with the table, whatever its files and row groups are.

    Counted while the plan is built (of Parquet, the footers alone). A scan that has as
    many splits already stays as it is. Rows are dealt by their place in the scan, not by
    a key: a frequent key is combined in every task before it is shuffled.
    """
    n = -(-scan.count() // rows)
    if n <= scan.rdd.getNumPartitions():
        return scan
    return scan.withColumn("_place", F.monotonically_increasing_id()).repartition(n, "_place").drop("_place")


def read_table(
    spark: SparkSession,
    base: str,
    name: str,
    columns: Iterable[str] | None = None,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """S1 ``read_entity``: one landed table, typed, instants in UTC.

    ``base`` is a folder holding ``<name>.parquet`` (or ``<name>.json``...).
    """
    ensure_semantics(spark)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    path = f"{base.rstrip('/')}/{name}.{fmt}"
    df = reader.format(fmt).load(path)
    if columns is not None:
        df = df.select(*columns)
    return as_instants(df)


def register_tables(spark: SparkSession, base: str, names: Iterable[str] = DRIVER_TABLES) -> None:
    """Register each landed table as a temp view under its own name."""
    for name in names:
        read_table(spark, base, name).createOrReplaceTempView(name)


def optional_source(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """A table that may not exist yet yields an empty, typed arm."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], schema)


def optional_path(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """S13 for files: an absent folder yields an empty, typed arm."""
    jvm_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)  # noqa: SLF001
    fs = jvm_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    if fs.exists(jvm_path):
        return spark.read.schema(schema).format(fmt).load(path)
    return spark.createDataFrame([], schema)


def stamp(df: DataFrame, instance_id: str | Column, extracted_at, entity_id: str | Column | None = None) -> DataFrame:
    """S3: add ``source_instance_id``, ``entity_id`` and one extraction instant per run.

    ``extracted_at`` is a literal instant for the whole run, so every row of one
    run carries the same observation time.
    """
    inst = instance_id if isinstance(instance_id, Column) else F.lit(instance_id)
    out = df.withColumn("source_instance_id", inst)
    if entity_id is not None:
        ent = entity_id if isinstance(entity_id, Column) else F.lit(entity_id)
        out = out.withColumn("entity_id", ent)
    return out.withColumn("_extracted_at", F.lit(extracted_at).cast("timestamp"))


def attach_tenant(df: DataFrame, instances: DataFrame, instance_col: str = "source_instance_id") -> DataFrame:
    """S3: tenant (``entity_id``) from the instance dimension (small, seeded)."""
    dim = instances.select(F.col("instance_id").alias(instance_col), "entity_id")
    return df.drop("entity_id").join(bounded_broadcast(keep_bound(dim, instances), 100_000), instance_col, "left")


def read_window(df: DataFrame, date_col: str | Column, start, end) -> DataFrame:
    """Rows whose business date lies in ``[start, end]``, the window recorded on each row.

    The filter is a plain comparison on the scanned column, so it is pushed into
    the Parquet reader.
    """
    c = F.col(date_col) if isinstance(date_col, str) else date_col
    return (
        df.filter(c.between(F.lit(start), F.lit(end)))
        .withColumn("_window_from", F.lit(start))
        .withColumn("_window_to", F.lit(end))
    )


def read_leads_window(
    leads: DataFrame, created_at: str, as_of, zone: str | Column, start=None, end=None
) -> DataFrame:
    """Leads created, by the tenant's calendar, from ``start`` to ``end``; either defaults to
    today in the tenant's zone at ``as_of``. Bad and lost leads are leads too."""
    today = entity_today(as_of, zone)
    lo = today if start is None else F.lit(start).cast("date")
    hi = today if end is None else F.lit(end).cast("date")
    return leads.filter(local_date(created_at, zone).between(lo, hi))


def read_service_window(rows: DataFrame, service_date: str | Column, as_of, zone: str | Column, days_ahead: int = 60) -> DataFrame:
    """Rows with a service date from today in the tenant's zone to ``days_ahead`` days later; each
    records the window it was read in as ``_sweep_from`` and ``_sweep_to`` (yyyymmdd)."""
    today = entity_today(as_of, zone)
    last = F.date_add(today, days_ahead)
    c = F.col(service_date) if isinstance(service_date, str) else service_date
    ymd = lambda d: F.date_format(d, "yyyyMMdd").cast("int")
    return rows.filter(c.between(today, last)).withColumn("_sweep_from", ymd(today)).withColumn("_sweep_to", ymd(last))


def read_detail(details: DataFrame, ids: DataFrame, keys: list[str]) -> DataFrame:
    """The landed detail rows for an explicit id list (semi join, no fan-out)."""
    return details.join(ids.select(*keys), keys, "left_semi")

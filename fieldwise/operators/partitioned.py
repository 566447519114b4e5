"""Upserts and retention on partitioned Parquet tables.

A batch rewrites only the partitions that its changes touch: their rows are read,
merged with the batch and put in place by dynamic partition overwrite; all other
partitions keep their files. Rows of a batch that the table already holds are no
changes, so a replayed batch writes nothing. Generations that retention gives up are
whole partitions and are removed as folders, without reading a row.

The merged rows are written once to the shared checkpoint folder before they
replace what they were read from, so a lost executor or a broken job can be run
again. Partition columns are functions of the key (a bucket of it, or a part of it):
a row never moves between partitions.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.time import local_date
from ..session import written_once
from ..sources import files
from .merge import upsert

#: Touched partitions up to this many are named in the scan's partition filter; beyond, the scan is joined to them.
MAX_NAMED = 10_000


def bucket_of(keys: Sequence[str], n: int) -> Column:
    """A partition column for keys that have no natural one."""
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path`` with its declared types; an absent one is empty."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def _same(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> Column:
    return functools.reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def in_partitions(df: DataFrame, touched: DataFrame, partition_by: Sequence[str], max_named: int = MAX_NAMED) -> DataFrame:
    """Rows of ``df`` in the partitions ``touched`` (distinct values): by a static partition
    filter where these are few, else by a semi join on the partition columns."""
    named = touched.limit(max_named + 1).collect()  # partition names, at most max_named
    if len(named) <= max_named:
        one = lambda r: functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(r[c])) for c in partition_by])
        if len(partition_by) == 1 and all(r[0] is not None for r in named):
            return df.filter(F.col(partition_by[0]).isin([r[0] for r in named]))
        return df.filter(functools.reduce(lambda x, y: x | y, [one(r) for r in named], F.lit(False)))
    return df.join(touched.withColumnsRenamed({c: f"_{c}" for c in partition_by}), functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in partition_by]), "left_semi")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace exactly the partitions that ``df`` has rows of; nothing, if it is empty."""
    rows = df.repartition(*partition_by) if partition_by else df  # a partition's rows come from few tasks, and few files
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def upsert_partitions(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str], order: Sequence[str] = ()
) -> int:
    """Put the batch's rows into the table at ``path`` by key; returns the number of partitions rewritten.

    ``order`` decides between batch rows of one key. Rows that the table holds unchanged
    touch no partition.
    """
    keys, columns = list(keys), batch.columns
    batch = written_once(upsert(batch.limit(0), batch, keys, order).select(*columns))
    table = read_partitioned(spark, path, batch.schema)
    there = in_partitions(table, batch.select(*partition_by).distinct(), partition_by)
    held = there.withColumnsRenamed({c: f"_{c}" for c in columns})
    unchanged = functools.reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    changed = written_once(batch.join(held, unchanged, "left_anti"))
    touched = changed.select(*partition_by).distinct()
    n = touched.count()
    if n:
        merged = upsert(in_partitions(table, touched, partition_by), changed, keys).select(*columns)
        overwrite_partitions(written_once(merged), path, partition_by)
    return n


def generations_of(spark: SparkSession, path: str, instance: str, generated_at: str) -> DataFrame:
    """(instance, generated_at) of a table partitioned by both, from its folder names alone."""
    found = []
    for outer in files.folders(spark, path):
        if outer.startswith(f"{instance}="):
            found += [(outer.split("=", 1)[1], inner.split("=", 1)[1]) for inner in files.folders(spark, f"{path.rstrip('/')}/{outer}") if inner.startswith(f"{generated_at}=")]
    return spark.createDataFrame(found, f"{instance} string, {generated_at} string")


def drop_generations(
    spark: SparkSession,
    path: str,
    as_of,
    zones: DataFrame,
    keep_days: int = 10,
    instance: str = "source_instance_id",
    generated_at: str = "generated",
) -> list[str]:
    """R7/J16 on a table partitioned by (instance, generation): remove the generations that
    retention gives up, as whole folders; returns them.

    Kept are all generations of the last ``keep_days`` days and, of each older day in
    the instance's zone (``zones``: instance, timezone; UTC for others), the newest.
    Generations are named ``yyyyMMddHHmmssSSSSSS`` in UTC (see ``generation_name``).
    """
    gens = generations_of(spark, path, instance, generated_at)
    at = F.to_timestamp(F.concat(F.substring(generated_at, 1, 14), F.lit("."), F.substring(generated_at, 15, 6)), "yyyyMMddHHmmss.SSSSSS")
    gens = gens.withColumn("_at", at).join(zones.select(instance, "timezone"), instance, "left")
    gens = gens.withColumn("_day", local_date(F.col("_at"), F.coalesce("timezone", F.lit("UTC"))))
    old = gens.filter(F.col("_at") < F.lit(as_of).cast("timestamp") - F.make_interval(days=F.lit(keep_days)))
    # the newest of a day among all its generations, also of a day that the bound cuts
    newest = gens.groupBy(instance, "_day").agg(F.max("_at").alias("_at"))
    gone = old.join(newest, [instance, "_day", "_at"], "left_anti").select(instance, generated_at)
    folders = [f"{instance}={r[0]}/{generated_at}={r[1]}" for r in gone.orderBy(instance, generated_at).collect()]  # names of folders
    for folder in folders:
        files.remove(spark, f"{path.rstrip('/')}/{folder}")
    return folders


def generation_name(generated_at: str | Column) -> Column:
    """A generation's time as a partition value that sorts and reads back exactly."""
    t = F.col(generated_at) if isinstance(generated_at, str) else generated_at
    return F.date_format(t, "yyyyMMddHHmmssSSSSSS")

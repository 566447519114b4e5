"""Idempotent upserts on plain Parquet.

Plain Parquet tables refuse ``MERGE``, so an upsert is a rewrite: the target
rows whose key is not in the batch (``left_anti``), plus the batch. A
parent's children are replaced wholesale (anti on the *parent* key). The
result is written to a new version folder and then read back, which cuts
the lineage; replaying the same batch yields the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Batch rows win by key; a batch with duplicate keys keeps the row
    with the largest ``order`` values (max_by - partial aggregation, no window)."""
    b = batch
    if order:
        payload = [c for c in batch.columns if c not in set(keys)]
        pick = F.max_by(F.struct(*payload), F.struct(*[F.col(c) for c in order]))
        b = batch.groupBy(*keys).agg(pick.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in payload])
    kept = target.join(b.select(*keys), list(keys), "left_anti")
    return kept.unionByName(b.select(*target.columns))


def replace_children(target: DataFrame, batch: DataFrame, parent_keys: Sequence[str]) -> DataFrame:
    """S12 for child tables: every parent present in the batch gets exactly the batch's children."""
    parents = batch.select(*parent_keys)
    kept = target.join(parents, list(parent_keys), "left_anti")
    return kept.unionByName(batch.select(*target.columns))


def write_version(df: DataFrame, base: str, version: int, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write one immutable version of a table and return it read back (lineage cut)."""
    path = f"{base.rstrip('/')}/v={version}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def upsert_dimension(
    spark: SparkSession, target: DataFrame, batch: DataFrame, instance_col: str = "source_instance_id", id_col: str = "id"
) -> DataFrame:
    """Reference lists are upserted per instance on ``(instance, id)``."""
    return upsert(target, batch, [instance_col, id_col])


def append_unique(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append rows not already present on ``keys`` (quarantine / dead-letter)."""
    fresh = rows.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(fresh.select(*target.columns))

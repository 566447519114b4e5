"""Drains whose guards hold across micro-batches.

Each drain appends to plain Parquet tables below one folder, a partition a batch id, so
a replayed batch overwrites what it wrote and adds nothing. What earlier batches took
is known from key tables, partitioned by the day of the event: a drain reads only the
days that its own rows can collide with (a static partition filter), never the history.

* ``GuardedLog``: the append-only event log. A delivery at most ``delay_days`` from one of
  the same hash that is in the log is a replay, in whatever batch it comes.
* ``RetryDrain``: takes events off the log, raises the attempts of those that fail, hands
  them to the next drain, and after ``max_attempts`` failures to the dead letters, which
  are unique on (event, error) over all batches.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.events import MAX_ATTEMPTS, dedupe_replays
from ..operators.partitioned import in_partitions, read_partitioned
from ..session import written_once
from ..sources import files

DAY, BATCH = "day", "batch_id"


def _days_around(rows: DataFrame, days: int) -> DataFrame:
    """The days of ``rows`` and up to ``days`` before and after them."""
    near = F.sequence(F.date_sub(DAY, days), F.date_add(DAY, days))
    return rows.select(DAY).distinct().select(F.explode(near).alias(DAY)).distinct()


def _put(rows: DataFrame, base: str, batch_id: int, by_day: bool = False) -> None:
    """One batch's part of a table: ``batch_id`` outermost, so that a replay replaces it whole."""
    writer = rows.write.mode("overwrite")
    (writer.partitionBy(DAY) if by_day else writer).parquet(f"{base}/{BATCH}={batch_id}")


def _earlier(spark: SparkSession, base: str, schema: T.StructType, batch_id: int) -> DataFrame:
    """What batches before ``batch_id`` put into a table."""
    whole = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    return read_partitioned(spark, base, whole).filter(F.col(BATCH) < batch_id)


class GuardedLog:
    """The event log at ``base`` as a ``foreachBatch`` sink."""

    def __init__(self, base: str, key: str = "dedupe_hash", ts: str = "received_at", delay_days: int = 7, tiebreak: Sequence[str] = ("event_id",)) -> None:
        self.base, self.key, self.ts, self.delay_days, self.tiebreak = base.rstrip("/"), key, ts, delay_days, list(tiebreak)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, delay = batch.sparkSession, self.delay_days * 86_400
        rows = written_once(batch.withColumn(DAY, F.to_date(self.ts)))
        keys = T.StructType([batch.schema[self.key], batch.schema[self.ts], T.StructField(DAY, T.DateType())])
        held = in_partitions(_earlier(spark, f"{self.base}/keys", keys, batch_id), _days_around(rows, self.delay_days), [DAY])
        # kept deliveries of a hash lie more than the delay apart: a few in these days
        near = held.groupBy(F.col(self.key).alias("_key")).agg(F.collect_list(F.unix_micros(self.ts)).alias("_kept"))
        close = lambda t: F.abs(F.unix_micros(self.ts) - t) <= delay * 1_000_000
        known = rows.join(near, F.col(self.key) == F.col("_key"), "left")
        fresh = known.filter(~F.coalesce(F.exists("_kept", close), F.lit(False))).select(*rows.columns)
        kept = written_once(dedupe_replays(fresh, self.key, self.ts, delay, self.tiebreak))
        _put(kept.drop(DAY), f"{self.base}/events", batch_id)
        _put(kept.select(self.key, self.ts, DAY), f"{self.base}/keys", batch_id, by_day=True)

    def events(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Everything in the log."""
        return read_partitioned(spark, f"{self.base}/events", T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])).drop(BATCH)


class RetryDrain:
    """Events and what failed before through ``process``, as a ``foreachBatch`` sink.

    ``process`` returns its input's rows with a column ``error``, null where the event
    was taken. Tables: ``processed``, ``queue`` (to try again, with the attempts so far),
    ``dead_letter`` (event, error, attempts), ``letters`` (their keys by day).
    """

    def __init__(self, base: str, process: Callable[[DataFrame], DataFrame], schema: T.StructType, key: str = "event_id", ts: str = "received_at", max_attempts: int = MAX_ATTEMPTS) -> None:
        self.base, self.process, self.key, self.ts, self.max_attempts = base.rstrip("/"), process, key, ts, max_attempts
        more = {"process_attempts": T.IntegerType(), "last_error": T.StringType()}
        self.schema = T.StructType([f for f in schema.fields if f.name not in more] + [T.StructField(n, t) for n, t in more.items()])

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, names = batch.sparkSession, self.schema.fieldNames()
        for c, t in (("process_attempts", "int"), ("last_error", "string")):
            batch = batch if c in batch.columns else batch.withColumn(c, F.lit(None).cast(t))
        # the last queue: every drain empties it, so an earlier one holds nothing that is due
        due = [int(x.split("=")[1]) for x in files.folders(spark, f"{self.base}/queue")]
        last = max((n for n in due if n < batch_id), default=None)
        work = batch.select(*names)
        if last is not None:
            work = work.unionByName(spark.read.schema(self.schema).parquet(f"{self.base}/queue/{BATCH}={last}"))
        done = written_once(self.process(work).select(*names, "error"))  # once: it may have effects
        attempts = F.coalesce("process_attempts", F.lit(0)) + 1
        failed = done.filter(F.col("error").isNotNull()).withColumn("process_attempts", attempts).withColumn("last_error", F.col("error")).drop("error")
        letters = failed.filter(F.col("process_attempts") >= self.max_attempts)
        _put(done.filter(F.col("error").isNull()).select(*names), f"{self.base}/processed", batch_id)
        _put(failed.filter(F.col("process_attempts") < self.max_attempts), f"{self.base}/queue", batch_id)
        self._bury(letters, batch_id)

    def _bury(self, letters: DataFrame, batch_id: int) -> None:
        """Dead letters that no earlier batch has, by the day of the event (the same in any batch)."""
        spark = letters.sparkSession
        rows = written_once(letters.withColumn(DAY, F.to_date(self.ts)).withColumnRenamed("last_error", "error").dropDuplicates([self.key, "error"]))
        keys = T.StructType([self.schema[self.key], T.StructField("error", T.StringType()), T.StructField(DAY, T.DateType())])
        held = in_partitions(_earlier(spark, f"{self.base}/letters", keys, batch_id), rows.select(DAY).distinct(), [DAY])
        fresh = written_once(rows.join(held.select(self.key, "error"), [self.key, "error"], "left_anti"))
        _put(fresh.select(self.key, "error", F.col("process_attempts").alias("attempts")), f"{self.base}/dead_letter", batch_id)
        _put(fresh.select(self.key, "error", DAY), f"{self.base}/letters", batch_id, by_day=True)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        """``processed``, ``queue`` or ``dead_letter`` over all batches; of the queue what is still due."""
        key, error = self.schema[self.key], T.StructField("error", T.StringType())
        kind = T.StructType([key, error, T.StructField("attempts", T.IntegerType())]) if name == "dead_letter" else self.schema
        rows = read_partitioned(spark, f"{self.base}/{name}", T.StructType([*kind.fields, T.StructField(BATCH, T.LongType())]))
        if name == "queue":
            due = [int(x.split("=")[1]) for x in files.folders(spark, f"{self.base}/queue")]
            rows = rows.filter(F.col(BATCH) == F.lit(max(due, default=-1)))
        return rows.drop(BATCH)

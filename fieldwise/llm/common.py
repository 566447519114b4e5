"""Helpers shared by the operators of this package.

Words are the runs ``[^\\x20\\x09-\\x0D]+``: on UTF-8 bytes that is exactly
``bytes.split()``, and ``bytes.lower()`` lower-cases exactly A-Z.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

# Python functions run in the workers; by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

U64 = np.uint64
#: Odd multipliers of the hashes below (fixed, so that hashes agree between runs and tasks).
MULT = 0x9E3779B97F4A7C15
MIX_1 = 0xBF58476D1CE4E5B9
MIX_2 = 0x94D049BB133111EB


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, label: str = "t") -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: a lineage
    cut that survives lost executors and is computed once."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Rows in one batch that goes to Python, at most, where whole texts and other columns travel.
BATCH_ROWS = 2_000


def bounded_batches(spark: SparkSession) -> None:
    """Let batches of documents hold ``BATCH_ROWS`` rows at most: a task's memory is that of a batch,
    in the JVM and in Python, and stays with the worker for the rest of the session."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def crc_bucket(id_col: str, modulus: int):
    """crc32 of the id as text, modulo ``modulus`` (null ids count as empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def bounded_sample(df: DataFrame, id_col: str, max_rows: int, n_rows: int) -> DataFrame:
    """A hash sample of about ``max_rows`` of the ``n_rows`` rows (all, if fewer)."""
    if n_rows <= max_rows:
        return df
    scale = 1_000_000
    keep = max(1, int(scale * max_rows / n_rows))
    return df.filter(F.pmod(F.xxhash64(F.col(id_col)), F.lit(scale)) < keep)


def map_texts(
    df: DataFrame,
    fn: Callable[[Sequence[str | None]], dict[str, object]],
    keep: Sequence[str],
    out: T.StructType,
    text_col: str = "text",
) -> DataFrame:
    """Apply ``fn(texts) -> {column: values}`` batch by batch; ``keep`` columns pass through."""
    kept = [df.schema[c] for c in keep]
    schema = T.StructType([*kept, *out.fields])
    arrow = {f.name: _arrow_type(f.dataType) for f in out.fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            got = fn(b.column("_text").to_pylist())
            cols = [b.column(i) for i in range(len(keep))]
            cols += [v if isinstance(v, pa.Array) else pa.array(v, arrow[n]) for n, v in ((n, got[n]) for n in arrow)]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *arrow])

    text = F.col(text_col).cast("string").alias("_text")
    return df.select(*[F.col(c) for c in keep], text).mapInArrow(run, schema)


def _arrow_type(t: T.DataType) -> pa.DataType:
    if isinstance(t, T.ArrayType):
        return pa.list_(_arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([pa.field(f.name, _arrow_type(f.dataType)) for f in t.fields])
    return {
        "bigint": pa.int64(),
        "int": pa.int32(),
        "string": pa.string(),
        "double": pa.float64(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }[t.simpleString()]


def shared(spark: SparkSession, state: object, build: Callable[[object], object]) -> Callable[[], object]:
    """Broadcast plain ``state``; workers build one object from it and keep it between tasks."""
    sent = spark.sparkContext.broadcast({"state": state})

    def get():
        held = sent.value
        if "made" not in held:
            held["made"] = build(held["state"])
        return held["made"]

    return get


class WordHash(dict):
    """word -> 64-bit hash, remembered; emptied when it holds ``limit`` words."""

    def __init__(self, limit: int = 400_000) -> None:
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        self[word] = h
        return h

    def of(self, words: Iterable[bytes], n: int) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), U64, n)


def mixed(h: np.ndarray) -> np.ndarray:
    """Final mix of 64-bit values (a bijection), in place on a copy."""
    h = h.copy()
    h ^= h >> U64(30)
    h *= U64(MIX_1)
    h ^= h >> U64(27)
    h *= U64(MIX_2)
    h ^= h >> U64(31)
    return h


def gram_hashes(word_hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words, by its first word; empty if there are fewer."""
    n = len(word_hashes) - k + 1
    if n <= 0:
        return np.empty(0, U64)
    h = np.zeros(n, U64)
    for j in range(k):
        h *= U64(MULT)
        h += word_hashes[j : j + n]
        h ^= h >> U64(29)
    return mixed(h)


def chunks(sizes: Sequence[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of items whose sizes add up to ``limit`` at most (one larger item stays alone)."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > limit:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


#: Bits of the table that keeps rows without a partner out of a shuffle; a fixed size.
FILTER_BITS = 1 << 24


def likely_rows(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose bigint ``key`` is not in ``wanted``, before a join to it.

    The keys set bits of a table of fixed size, which is broadcast; when it
    fills up it only lets more rows through, which the join then drops.
    """
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    byte = wanted.select(bit(key).alias("b")).groupBy(F.floor(F.col("b") / 8).cast("int").alias("at"))
    got = byte.agg(F.expr("bit_or(shiftleft(1, cast(b % 8 as int)))").alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 8, np.uint8)
    table[got.column("at").to_numpy()] = got.column("bits").to_numpy().astype(np.uint8)
    state = shared(rows.sparkSession, table, lambda s: s)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = state()
        for b in batches:
            at = b.column(b.num_columns - 1).to_numpy(zero_copy_only=False)
            keep = ((held[at >> 3] >> (at & 7).astype(np.uint8)) & 1).astype(bool)
            if keep.any():
                yield b.filter(pa.array(keep)).drop_columns(["_bit"])

    return rows.withColumn("_bit", bit(key)).mapInArrow(run, rows.schema)


#: Bits a wanted key has in the table of ``without_rows``, and the table's largest size (2 and 16 MB).
BITS_A_KEY = 16
TABLE_BITS = (1 << 24, 1 << 27)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it as long as a column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def maybe_in(wanted: DataFrame, key: str) -> Callable[[Column], Column]:
    """A test of a bigint column that holds for every key of ``wanted`` and for few others.

    A bit table, broadcast and sized by the number of keys up to ``TABLE_BITS``;
    beyond, the test holds for more and more others. Only the column goes to Python.
    """
    n = wanted.count()
    bits = min(max(1 << (BITS_A_KEY * n).bit_length(), TABLE_BITS[0]), TABLE_BITS[1])
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(bits))
    byte = wanted.select(bit(F.col(key)).alias("b")).groupBy(F.floor(F.col("b") / 8).cast("int").alias("at"))
    got = byte.agg(F.expr("bit_or(shiftleft(1, cast(b % 8 as int)))").alias("bits")).toArrow()
    table = np.zeros(bits // 8, np.uint8)
    table[got.column("at").to_numpy()] = got.column("bits").to_numpy().astype(np.uint8)
    state = shared(wanted.sparkSession, table, lambda s: s)

    @F.pandas_udf("boolean")
    def held(at: pd.Series) -> pd.Series:
        i = at.to_numpy()
        return pd.Series(((state()[i >> 3] >> (i & 7).astype(np.uint8)) & 1).astype(bool))

    return lambda c: held(bit(c))


def without_rows(rows: DataFrame, key: Column, gone: DataFrame, once: DataFrame | None = None) -> DataFrame:
    """``rows`` whose bigint ``key`` is not in ``gone`` (``row``); of rows whose key is in ``once`` one stays.

    Rows that stay go through without a shuffle, but for the few that a bit table
    cannot tell from those that go; only these are joined to the keys.
    """
    name = free_name(rows, "_row")
    keyed = rows.withColumn(name, key)
    wanted = gone.select("row") if once is None else gone.select("row").unionByName(once.select("row"))
    maybe = maybe_in(wanted, "row")
    doubtful = keyed.filter(maybe(F.col(name))).join(gone.select(F.col("row").alias(name)).distinct(), name, "left_anti")
    if once is not None:
        doubtful = doubtful.dropDuplicates([name])
    return keyed.filter(~maybe(F.col(name))).unionByName(doubtful).select(*rows.columns)

"""Operator 13: nearest vectors by an inverted multi-index.

The two halves of every (unit) vector are quantised apart, by k centroids each, so
that k * k cells cover the space with two small codebooks. A query takes pairs of
centroids by the sum of their squared distances to its halves, smallest first, from
a heap over the two sorted lists, until the cells taken hold its share of all
vectors. Those vectors are ranked again by their exact cosine.

Bounded sample: codebooks are fitted by k-means on at most ``FIT_ROWS`` distinct
vectors, taken by hash; every vector is indexed. On the same sample the share of
vectors is measured that ``RECALL`` of the nearest neighbours of ``PROBES`` of its
vectors need; a search takes that share, and ``LEAST_TAKEN`` vectors at least, so
tables of up to that size are searched whole. Close vectors lie in few cells;
vectors without any clusters need a large share (about 0.4 of 64 independent
components), whatever the index.

Equal vectors are one entry. As equal scores go to the smaller id, an entry carries
its ``k + 1`` smallest ids and no more (one may be the query's own); equal queries
are one search. Entries are dealt by cell into groups of about ``GROUP_ROWS``, a
large cell into several, and queries into blocks of about ``QUERY_ROWS``; each group
meets each block that has a query for it in one task.

Defined results: vectors that are null, zero or hold null or non-finite components
(also squares that overflow) take no part, nor do vectors of another length than
the most frequent (of equally frequent ones the smallest). A row is no candidate for
itself; other rows of the same id are. Candidates of null id come after others
of equal score and are no queries. Repeated query rows are answered one by one.
Fewer candidates than asked for are all returned. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIT_ROWS = 20_000
PROBES = 200
RECALL = 0.97
MARGIN = 1.1
LEAST_TAKEN = 1_000
GROUP_ROWS = 2_048
QUERY_ROWS = 4_096
MAX_CENTROIDS = 1_024
ROUNDS = 10


def components(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, v) of the vectors that take part, ``v`` their components as doubles, and their length."""
    v = F.col(vec_col).cast("array<double>")
    sound = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == math.inf))
    square = F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x)
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), v.alias("v"), (sound & (square > 0) & (square < math.inf)).alias("_ok"))
    rows = rows.filter(F.coalesce("_ok", F.lit(False))).drop("_ok")
    # one row, whatever the input: the most frequent length
    best = rows.groupBy(F.size("v").alias("d")).count().agg(F.max(F.struct("count", (-F.col("d")).alias("d"))).alias("best")).first().best
    d = -best.d if best else 0
    return rows.filter(F.size("v") == d), d


def packed(rows: DataFrame) -> DataFrame:
    """Components as little-endian doubles in one binary, the key of equal vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                flat = b.column(1).flatten().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([b.column(0), _binary(flat.reshape(b.num_rows, -1))], names=["vec_id", "v"])

    return rows.mapInArrow(run, "vec_id bigint, v binary")


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    rows = np.ascontiguousarray(rows)
    width = rows.shape[1] * rows.itemsize
    ends = pa.py_buffer((np.arange(len(rows) + 1, dtype=np.int64) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, ends, pa.py_buffer(rows)])


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, d)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances, less the row's own square (the same for all centroids)."""
    return (centroids * centroids).sum(axis=1) - 2 * (x @ centroids.T)


def _means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k centroids of the rows of ``x`` (Lloyd's rounds from rows drawn by a fixed seed)."""
    found = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        own = _distances(x, found).argmin(axis=1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(found)
        np.add.at(sums, own, x)
        found[n > 0] = sums[n > 0] / n[n > 0, None]
    return found


@dataclass
class Codebooks:
    """Centroids of either half, and the share of all vectors that a search takes."""

    left: np.ndarray
    right: np.ndarray
    share: float

    @property
    def k(self) -> int:
        return len(self.left)

    def halves(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distances of the two halves of unit vectors to their centroids."""
        cut = self.left.shape[1]
        return _distances(units[:, :cut], self.left), _distances(units[:, cut:], self.right)

    def cells(self, units: np.ndarray) -> np.ndarray:
        a, b = self.halves(units)
        return a.argmin(axis=1) * self.k + b.argmin(axis=1)


def fit(units: np.ndarray, n_entries: int, k_nearest: int = 5) -> Codebooks:
    """Codebooks from sampled unit vectors, of a size that suits ``n_entries`` vectors."""
    cut = (units.shape[1] + 1) // 2
    k = 1 << max(0, round(math.log2(max(1.0, math.sqrt(n_entries) / 3))))
    k = max(1, min(k, MAX_CENTROIDS, len(units)))
    books = Codebooks(_means(units[:, :cut], k, 1), _means(units[:, cut:], k, 2), 1.0)
    probes = units[:: max(1, len(units) // PROBES)][:PROBES]
    near = probes @ units.T
    near[np.arange(len(probes)), np.arange(len(units))[:: max(1, len(units) // PROBES)][:PROBES]] = -2  # not itself
    if len(units) > 2 * k_nearest:
        top = np.argpartition(-near, k_nearest, axis=1)[:, :k_nearest]
        a, b = books.halves(probes)
        cells = books.cells(units)
        reach = a[:, cells // k] + b[:, cells % k]
        wanted = np.take_along_axis(reach, top, axis=1)
        shares = [(r[:, None] <= w[None, :]).mean(axis=0) for r, w in zip(reach, wanted, strict=True)]
        books.share = min(1.0, MARGIN * float(np.quantile(np.concatenate(shares), RECALL)))
    return books


def taken(near_left: np.ndarray, near_right: np.ndarray, held: np.ndarray, target: int) -> np.ndarray:
    """Cells in order of summed distance, until they hold ``target`` vectors; empty cells are passed.

    ``held``: vectors by cell. The heap holds one pair for each left centroid that was begun.
    """
    k = len(near_left)
    lefts, rights = near_left.argsort(kind="stable"), near_right.argsort(kind="stable")
    a, b = near_left[lefts].tolist(), near_right[rights].tolist()
    rows, columns = (lefts * k).tolist(), rights.tolist()
    heap, got, total = [(a[0] + b[0], 0, 0)], [], 0
    while heap and total < target:
        _, i, j = heapq.heappop(heap)
        n = held.item(rows[i] + columns[j])
        if n:
            got.append(rows[i] + columns[j])
            total += n
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
    return np.array(sorted(got), np.int32)


def _first_ids(rows: DataFrame, n: int) -> DataFrame:
    """(v, ids): equal vectors as one row with their ``n`` smallest ids (null last)."""
    place = F.row_number().over(Window.partitionBy("v").orderBy(F.col("vec_id").asc_nulls_last()))
    some = rows.withColumn("_place", place).filter(F.col("_place") <= n)  # limited in each task before the shuffle
    return some.groupBy("v").agg(F.transform(F.array_sort(F.collect_list(F.struct("_place", "vec_id"))), lambda x: x["vec_id"]).alias("ids"))


def search(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest of every vector whose id ``is_query`` holds for."""
    spark = vectors.sparkSession
    valid, d = components(vectors, id_col, vec_col)
    rows = written(packed(valid), "vectors")
    entries = written(_first_ids(rows, k + 1), "entries")
    n_entries = entries.count()
    queries = rows.filter(is_query & F.col("vec_id").isNotNull())
    searches = written(queries.select("v").distinct(), "queries")
    if not n_entries:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    scale = 1 << 30
    keep = min(scale, max(1, scale * FIT_ROWS // n_entries))
    sample = entries.filter(F.pmod(F.xxhash64("v"), F.lit(scale)) < keep) if n_entries > FIT_ROWS else entries
    units = _unit(_matrix(sample.select("v").orderBy(F.xxhash64("v"), "v").toArrow().column("v").combine_chunks(), d))  # FIT_ROWS or so
    books = fit(units if len(units) else _unit(_matrix(entries.limit(1).toArrow().column("v").combine_chunks(), d)), n_entries, k)
    found = _searched(entries, searches, books, d, n_entries, k)
    # a query row takes its own row out, once
    own = F.array_position(F.transform("near", lambda x: F.when(x["own"], x["vec_id"])), F.col("query_id"))
    others = F.slice(F.filter("near", lambda x, i: i + 1 != F.col("_own")), 1, k)
    rows = queries.select(F.col("vec_id").alias("query_id"), "v").join(found, "v").withColumn("_own", own)
    rows = rows.select("query_id", F.posexplode(others).alias("_at", "x"))
    return rows.select("query_id", (F.col("_at") + 1).alias("rank"), "x.vec_id", "x.score")


def _searched(entries: DataFrame, searches: DataFrame, books: Codebooks, d: int, n_entries: int, k: int) -> DataFrame:
    """(v, near): for each vector searched its ``k + 1`` nearest as (score, vec_id, own), nearest first."""
    spark = entries.sparkSession
    plain = (books.left, books.right, books.share)  # workers build the class, which they cannot import
    state = shared(spark, plain, lambda s: Codebooks(*s))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = state().cells(_unit(_matrix(b.column("v"), d)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cells, pa.int32())], names=[*b.schema.names, "cell"])

    indexed = written(entries.mapInArrow(place, "v binary, ids array<bigint>, cell int"), "cells")
    counts = indexed.groupBy("cell").count().toArrow()  # MAX_CENTROIDS squared rows at most
    held = np.zeros(books.k * books.k, np.int64)
    held[counts.column("cell").to_numpy()] = counts.column("count").to_numpy()
    first, groups = _groups(held)
    target = max(LEAST_TAKEN, math.ceil(books.share * n_entries))
    n_blocks = max(1, -(-searches.count() // QUERY_ROWS))
    dealt = shared(spark, (plain, held, first, groups), lambda s: (Codebooks(*s[0]), *s[1:]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries with their group; a large cell's are dealt by hash."""
        first, groups = dealt()[2:]
        for b in batches:
            if b.num_rows:
                cell = b.column("cell").to_numpy()
                group = first[cell] + np.mod(b.column("spread").to_numpy(), groups[cell])
                yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(group, pa.int64())], names=["v", "ids", "cell", "grp"])

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each search and group that it needs, the cells it takes there."""
        books, held, first, groups = dealt()
        schema = pa.schema([("grp", pa.int64()), ("v", pa.binary()), ("cells", pa.binary())])
        for b in batches:
            if not b.num_rows:
                continue
            near = books.halves(_unit(_matrix(b.column("v"), d)))
            for v, left, right in zip(b.column("v").to_pylist(), *near, strict=True):
                cells = taken(left, right, held, target)
                at = np.repeat(cells, groups[cells])
                group = np.repeat(first[cells], groups[cells]) + (np.arange(len(at)) - np.repeat(np.cumsum(groups[cells]) - groups[cells], groups[cells]))
                cut = np.flatnonzero(np.diff(group)) + 1
                parts = np.split(at.astype(np.int32), cut)
                starts = group[np.concatenate(([0], cut))]
                yield pa.RecordBatch.from_arrays([pa.array(starts, pa.int64()), pa.array([v] * len(parts), pa.binary()), pa.array([p.tobytes() for p in parts], pa.binary())], schema=schema)

    block = F.pmod(F.xxhash64("v"), F.lit(n_blocks))
    probes = searches.mapInArrow(probe, "grp bigint, v binary, cells binary").withColumn("block", block)
    dealt_entries = indexed.withColumn("spread", F.xxhash64("v")).mapInArrow(deal, "v binary, ids array<bigint>, cell int, grp bigint")
    copies = dealt_entries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_blocks - 1).cast("bigint"))))

    def rank(wanted: pa.Table, own: pa.Table) -> pa.Table:
        return _ranked(wanted, own, d, k + 1)

    near = probes.groupBy("grp", "block").cogroup(copies.groupBy("grp", "block")).applyInArrow(rank, "v binary, score double, vec_id bigint, own boolean")
    place_of = F.row_number().over(Window.partitionBy("v").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last()))
    best = near.withColumn("_place", place_of).filter(F.col("_place") <= k + 1)
    held_rows = F.array_sort(F.collect_list(F.struct("_place", "score", "vec_id", "own")))
    return best.groupBy("v").agg(held_rows.alias("near"))


def _groups(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each cell its first group and its number of groups: neighbouring cells share one
    up to ``GROUP_ROWS`` vectors, a larger cell has several of its own."""
    first, groups = np.zeros(len(held), np.int64), np.ones(len(held), np.int64)
    group, room = 0, GROUP_ROWS
    for cell in np.flatnonzero(held):
        n = int(held[cell])
        if n > room and room < GROUP_ROWS:
            group, room = group + 1, GROUP_ROWS
        first[cell], groups[cell] = group, max(1, -(-n // GROUP_ROWS))
        if n >= room:
            group, room = group + int(groups[cell]), GROUP_ROWS
        else:
            room -= n
    return first, groups


def _cosines(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with the rows of ``x``, summed component by component in order."""
    dot, left, right = np.zeros(len(x)), 0.0, np.zeros(len(x))
    for j in range(x.shape[1]):
        dot += x[:, j] * q[j]
        right += x[:, j] * x[:, j]
        left += q[j] * q[j]
    product = left * right
    length = np.where((product > 0) & (product < math.inf), np.sqrt(product), math.sqrt(left) * np.sqrt(right))
    return np.clip(dot / length, -1.0, 1.0)


def _ranked(wanted: pa.Table, own: pa.Table, d: int, k: int) -> pa.Table:
    """Of each search its ``k`` nearest ids among the entries of the cells it takes."""
    out: tuple[list, list, list, list] = ([], [], [], [])
    if wanted.num_rows and own.num_rows:
        x = _matrix(own.column("v").combine_chunks(), d)
        raw, ids = own.column("v").to_pylist(), own.column("ids").to_pylist()
        cell = own.column("cell").to_numpy()
        units = _unit(x)
        vs, cells = wanted.column("v").to_pylist(), wanted.column("cells").to_pylist()
        for start in range(0, len(vs), 256):
            q = np.frombuffer(b"".join(vs[start : start + 256]), np.float64).reshape(-1, d)
            near = _unit(q) @ units.T
            for i in range(len(q)):
                at = np.flatnonzero(np.isin(cell, np.frombuffer(cells[start + i], np.int32)))
                s = near[i, at]
                if len(at) > k:  # all that may be among the nearest, rounding apart
                    at = at[s >= np.partition(s, len(s) - k)[len(s) - k] - 1e-9]
                exact = _cosines(q[i], x[at]).tolist()
                v = vs[start + i]
                rows = sorted(((-c, n is None, n or 0, raw[a] == v) for c, a in zip(exact, at.tolist(), strict=True) for n in ids[a]))[:k]
                for c, lost, n, same in rows:
                    out[0].append(v)
                    out[1].append(-c)
                    out[2].append(None if lost else n)
                    out[3].append(same)
    types = (pa.binary(), pa.float64(), pa.int64(), pa.bool_())
    return pa.table([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["v", "score", "vec_id", "own"])

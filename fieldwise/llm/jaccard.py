"""Operator 4: n-gram Jaccard join by T-occurrence search.

Two documents link when the Jaccard similarity of their sets of five-word
shingles reaches 0.75. Equal sets are one node, known by a 64-bit key.

1. Cells. Linked sets share at least ``extra`` of their first
   ``n - ceil(0.75 n) + extra`` shingles in any common order, with ``extra`` of
   the smaller set; the order here is rare before frequent, then by hash. These first shingles are shuffled, packed
   by buckets of the shingle. Each shingle that several sets hold gives its
   holders to the cell of its most central holder, so two linked sets always
   meet in a cell. A set leaves its smallest cells, as long as these hold fewer
   than half of the shingles it shares with any linked set at least: two
   linked sets still have a cell in common.
2. Search. Within a cell the sets are indexed by inverted lists and every set is
   searched by DivideSkip: a partner must occur in at least T of the lists; the
   longest L lists are put aside, the shorter ones merged, and sets found T - L
   times are looked up in the long lists by binary search. Before that, all
   sets are compared to the cell's centre; those linked to it need no search
   for each other, and the triangle inequality of the Jaccard distance rules
   out pairs whose distances to the centre differ by more than 0.25.
3. Large cells are dealt into blocks that all hold the centre. Sets linked to
   it are done, save as partners of the others, which are then searched against
   every block.
4. Components of the links, by alternating stars.

A table of the most frequent shingles (``MAX_FREQUENT``, a bound) is broadcast
for the order only; any order gives the same links.

Defined results: a text without words, or null, has no shingle and links with
nothing; with fewer than five words the whole sequence is the one shingle.
Repeated rows and rows of one id with different texts all take part; a null id
counts as larger than any other and a component of null ids only has a null
component. Ties in similarity link (100 * intersection >= 75 * union).
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, WordHash, chunks, likely_rows, shared, written
from .components import components
from .substring import NO_ID, Powers, run_hashes

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
PERCENT = 75
CHUNK_WORDS = 300_000
#: Of a set's size, this part is asked for as shared first shingles.
EXTRA = 10
#: Frequent shingles that the order knows, and sets of one cell searched in one task.
MAX_FREQUENT = 200_000
BLOCK = 1_200
#: A list counts as long from so many times the mean work of probing it.
DIVIDE = 0.05


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def shingle_sets(texts: Sequence[list[bytes]], known: WordHash, powers: Powers) -> tuple[np.ndarray, np.ndarray]:
    """(owner, shingle hash) of all texts' sets, sorted by both."""
    sizes = np.array([len(w) for w in texts], np.int64)
    words = known.of(itertools.chain.from_iterable(texts), int(sizes.sum()))
    owner = np.repeat(np.arange(len(texts)), sizes)
    ends = np.cumsum(sizes)
    h = run_hashes(words, SHINGLE, powers)
    inside = np.arange(len(h)) + SHINGLE <= ends[owner[: len(h)]]
    h, owner = h[inside], owner[: len(inside)][inside]
    short = [i for i, n in enumerate(sizes.tolist()) if 0 < n < SHINGLE]
    if short:
        whole = [xxhash.xxh64_intdigest(b" ".join(texts[i]), seed=len(texts[i])) for i in short]
        h = np.concatenate([h, np.array(whole, U64)])
        owner = np.concatenate([owner, np.array(short, np.int64)])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[new], h[new]


def set_keys(owner: np.ndarray, h: np.ndarray, n: int) -> tuple[list[int | None], np.ndarray]:
    """A signed 64-bit key of each set (None if empty) and the sets' sizes."""
    sizes = np.bincount(owner, minlength=n)
    at = np.concatenate([[0], np.cumsum(sizes)])
    keys = [
        xxhash.xxh64_intdigest(h[a:z].tobytes()) - (1 << 63) if z > a else None
        for a, z in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)
    ]
    return keys, sizes


def least_overlap(n):
    """Shingles that a set of ``n`` shares with any linked set, at least."""
    return (n * PERCENT + 99) // 100


def extra(n):
    """Shared first shingles that are asked for."""
    return np.maximum(1, n // EXTRA)


def linked(overlap, n, m):
    return 100 * overlap >= PERCENT * (n + m - overlap)


# -- scans over the documents ------------------------------------------------


def row_key(id_col: str, text_col: str) -> Column:
    """A 64-bit key of a row's id and text: rows without an id and rows of one id are told apart by it."""
    return F.xxhash64(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"), F.col(id_col).isNull(), F.col(text_col).isNull())


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """A row a document (id, row, n, key) and a row a chunk with its frequent shingles (shingles, counts)."""

    def run(batches):
        known, powers = WordHash(), Powers()
        for b in batches:
            ids = b.column(0).to_pylist()
            texts = [words_of(t) for t in b.column(1).to_pylist()]
            for lo, hi in chunks([len(w) for w in texts], CHUNK_WORDS):
                owner, h = shingle_sets(texts[lo:hi], known, powers)
                keys, sizes = set_keys(owner, h, hi - lo)
                first = {}
                for i, k in enumerate(keys):
                    first.setdefault(k, i)
                own = np.zeros(hi - lo, bool)
                own[list(first.values())] = True
                value, count = np.unique(h[own[owner]], return_counts=True)
                often = count >= 3
                rows = hi - lo
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([NO_ID if i is None else i for i in ids[lo:hi]] + [None], pa.int64()),
                        pa.array([*b.column(2)[lo:hi].to_pylist(), None], pa.int64()),
                        pa.array(sizes.tolist() + [None], pa.int64()),
                        pa.array([*keys, None], pa.int64()),
                        pa.array([None] * rows + [value[often].view(np.int64)], pa.list_(pa.int64())),
                        pa.array([None] * rows + [count[often]], pa.list_(pa.int64())),
                    ],
                    names=["id", "row", "n", "key", "shingles", "counts"],
                )

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"), row_key(id_col, text_col))
    return rows.mapInArrow(run, "id bigint, row bigint, n bigint, key bigint, shingles array<bigint>, counts array<bigint>")


def frequent_shingles(described: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``MAX_FREQUENT`` most frequent shingles (sorted) and their counts; a bounded table."""
    rows = described.filter("shingles is not null").select(F.explode(F.arrays_zip("shingles", "counts")).alias("s"))
    total = rows.groupBy(F.col("s.shingles").alias("h")).agg(F.sum("s.counts").alias("c"))
    top = total.orderBy(F.desc("c"), "h").limit(MAX_FREQUENT).toArrow()
    h = top.column("h").to_numpy().view(U64)
    order = np.argsort(h)
    return h[order], top.column("c").to_numpy()[order]


def first_shingles(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray], text_col: str, buckets: int) -> DataFrame:
    """Each set's first shingles, packed a row a chunk and bucket."""
    state = shared(docs.sparkSession, frequent, lambda s: s)
    names = ["bucket", "keys", "sizes", "ranks", "owner", "shingles"]

    def run(batches):
        value, count = state()
        known, powers = WordHash(), Powers()
        for b in batches:
            texts = [w for w in (words_of(t) for t in b.column(0).to_pylist()) if w]
            for lo, hi in chunks([len(w) for w in texts], CHUNK_WORDS):
                owner, h = shingle_sets(texts[lo:hi], known, powers)
                keys, sizes = set_keys(owner, h, hi - lo)
                keys = np.array(keys, np.int64)
                once = np.zeros(hi - lo, bool)
                once[np.unique(keys, return_index=True)[1]] = True
                mine = once[owner]
                owner, h = owner[mine], h[mine]
                if len(value):
                    at = np.minimum(np.searchsorted(value, h), len(value) - 1)
                    often = np.where(value[at] == h, count[at], 0)
                else:
                    often = np.zeros(len(h), np.int64)
                ranks = np.bincount(owner, weights=often == 0, minlength=hi - lo).astype(np.int32)
                order = np.lexsort((h, often, owner))
                owner, h = owner[order], h[order]
                place = np.arange(len(owner)) - np.searchsorted(owner, owner)
                n = sizes[owner]
                take = place < n - least_overlap(n) + extra(n)
                owner, h = owner[take], h[take]
                bucket = (h % U64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                owner, h, bucket = owner[order], h[order], bucket[order]
                present, start = np.unique(bucket, return_index=True)
                rows = []
                for k, a, z in zip(present.tolist(), start, np.append(start[1:], len(h)), strict=True):
                    docs_here, local = np.unique(owner[a:z], return_inverse=True)
                    rows.append(
                        (
                            k,
                            keys[docs_here].tobytes(),
                            sizes[docs_here].astype(np.int32).tobytes(),
                            ranks[docs_here].tobytes(),
                            local.astype(np.uint16 if len(docs_here) < 1 << 16 else np.int32).tobytes(),
                            h[a:z].tobytes(),
                        )
                    )
                cols = [pa.array([r[c] for r in rows], pa.int32() if c == 0 else pa.binary()) for c in range(6)]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    schema = "bucket int, keys binary, sizes binary, ranks binary, owner binary, shingles binary"
    return docs.select(F.col(text_col).cast("string")).mapInArrow(run, schema)


def bucket_cells(bucket: pd.DataFrame) -> pd.DataFrame:
    """(cell, key, n, shared): for each shingle of several sets, its holders in the cell of the most central one."""
    keys, sizes, ranks, owner, h = [], [], [], [], []
    base = 0
    for r in bucket.itertuples(index=False):
        k = np.frombuffer(r.keys, np.int64)
        keys.append(k)
        sizes.append(np.frombuffer(r.sizes, np.int32))
        ranks.append(np.frombuffer(r.ranks, np.int32))
        h.append(np.frombuffer(r.shingles, U64))
        kind = np.uint16 if len(k) < 1 << 16 else np.int32
        owner.append(np.frombuffer(r.owner, kind).astype(np.int64) + base)
        base += len(k)
    keys, sizes, ranks, owner, h = map(np.concatenate, (keys, sizes, ranks, owner, h))
    order = np.lexsort((keys[owner], ranks[owner], h))
    owner, h = owner[order], h[order]
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    again = same.copy()  # the same set from another chunk
    again[1:] &= keys[owner[1:]] == keys[owner[:-1]]
    owner, h = owner[~again], h[~again]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    start = np.flatnonzero(new)
    count = np.diff(np.append(start, len(h)))
    cell = np.repeat(keys[owner[start]], count)
    several = np.repeat(count, count) > 1
    cell, owner = cell[several], owner[several]
    out = pd.DataFrame({"cell": cell, "key": keys[owner], "n": sizes[owner].astype(np.int64), "shared": 1})
    return out.groupby(["cell", "key", "n"], as_index=False)["shared"].sum()


# -- search within a cell ----------------------------------------------------


class Cell:
    """Sets of one cell with inverted lists over the shingles that several of them hold."""

    def __init__(self, sets: Sequence[np.ndarray]) -> None:
        self.n = np.array([len(s) for s in sets], np.int64)
        owner = np.repeat(np.arange(len(sets)), self.n)
        value, token, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        several = held[token] > 1
        owner, token = owner[several], token[several]
        self.tokens = token
        self.at = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sets)))])
        order = np.argsort(token, kind="stable")
        self.lists = owner[order]
        self.list_at = np.searchsorted(token[order], np.arange(len(value) + 1))
        self.parent = np.arange(len(sets))
        self.owner = owner

    def root(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return int(i)

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.root(i), self.root(j)))
        self.parent[b] = a

    def distances(self, centre: int) -> tuple[np.ndarray, np.ndarray]:
        """Jaccard distances to the centre and which sets link to it."""
        marked = np.zeros(len(self.list_at), bool)
        marked[self.tokens[self.at[centre] : self.at[centre + 1]]] = True
        overlap = np.bincount(self.owner, weights=marked[self.tokens], minlength=len(self.n)).astype(np.int64)
        overlap[centre] = self.n[centre]
        together = self.n + self.n[centre] - overlap
        return 1 - overlap / together, linked(overlap, self.n, self.n[centre])

    def search(self, query: int, allowed: np.ndarray) -> np.ndarray:
        """Allowed sets that occur in enough of the query's lists (DivideSkip), already verified."""
        n = int(self.n[query])
        need = int(least_overlap(n))
        tokens = self.tokens[self.at[query] : self.at[query + 1]]
        if len(tokens) < need:
            return np.empty(0, np.int64)
        starts, ends = self.list_at[tokens], self.list_at[tokens + 1]
        order = np.argsort(ends - starts, kind="stable")
        starts, ends = starts[order], ends[order]
        longest = int(ends[-1] - starts[-1])
        aside = min(need - 1, int(need / (DIVIDE * np.log2(longest + 2) + 1)))
        cut = len(tokens) - aside
        merged = np.sort(np.concatenate([self.lists[a:z] for a, z in zip(starts[:cut], ends[:cut], strict=True)]))
        found, count = np.unique(merged, return_counts=True)
        fits = (count >= need - aside) & allowed[found] & (4 * self.n[found] >= 3 * n) & (4 * n >= 3 * self.n[found])
        found, count = found[fits], count[fits]
        for a, z in zip(starts[cut:], ends[cut:], strict=True):
            if not len(found):
                break
            at = np.minimum(np.searchsorted(self.lists[a:z], found), z - a - 1)
            count = count + (self.lists[a:z][at] == found)
        return found[linked(count, self.n[found], n)]


def cell_links(sets: Sequence[np.ndarray], centre: int | None, queries: Iterable[int] | None = None) -> tuple[list[int], np.ndarray]:
    """Each set's least linked set in this cell (itself if none) and which sets
    are not linked to the centre. ``queries``: only these are searched for."""
    cell = Cell(sets)
    away = np.ones(len(sets), bool)
    distance = np.zeros(len(sets))
    if centre is not None:
        distance, near = cell.distances(centre)
        for i in np.flatnonzero(near).tolist():
            cell.join(centre, i)
        away = ~near
    chosen = np.flatnonzero(away).tolist() if queries is None else list(queries)
    for q in sorted(chosen, key=lambda i: int(cell.n[i])):
        root = cell.root(q)
        allowed = (np.abs(distance - distance[q]) <= 0.25 + 1e-9) & (cell.parent != root)
        allowed[q] = False
        for i in cell.search(q, allowed).tolist():
            cell.join(q, i)
    return [cell.root(i) for i in range(len(sets))], away


def _sets(rows: pd.DataFrame) -> dict[int, np.ndarray]:
    """The set of each key, from a row whose text has that key (ids need not be unique)."""
    texts = [words_of(t) for t in rows["text"]]
    wanted = rows["key"].tolist()
    known, powers, out = WordHash(), Powers(), {}
    for lo, hi in chunks([len(w) for w in texts], CHUNK_WORDS):
        owner, h = shingle_sets(texts[lo:hi], known, powers)
        keys, _ = set_keys(owner, h, hi - lo)
        for k, want, s in zip(keys, wanted[lo:hi], np.split(h, np.searchsorted(owner, np.arange(1, hi - lo))), strict=True):
            if k == want:
                out[k] = s
    return out


def _groups(rows: pd.DataFrame, names: Sequence[str]) -> Iterable[pd.DataFrame]:
    """The rows of each combination of ``names``."""
    order = np.lexsort([rows[c].to_numpy() for c in reversed(names)])
    rows = rows.iloc[order].reset_index(drop=True)
    new = np.zeros(len(rows), bool)
    for c in names:
        v = rows[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    at = [0, *np.flatnonzero(new).tolist(), len(rows)]
    return (rows.iloc[a:z] for a, z in itertools.pairwise(at) if z > a)


def search_blocks(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) of some blocks of cells, and the sets of split cells away from the centre (a, cell)."""
    first = rows.drop_duplicates(["key", "text"])
    sets = _sets(first)
    a, b, cell = [], [], []
    rows = rows[rows["key"].isin(sets)].drop(columns="text").drop_duplicates()
    for block in _groups(rows, ["cell", "block"]):
        keys = block["key"].tolist()
        if len(keys) < 2:
            continue
        centre = np.flatnonzero(block["centre"].to_numpy())
        roots, away = cell_links([sets[k] for k in keys], int(centre[0]) if len(centre) else None)
        for i, r in enumerate(roots):
            if i != r:
                a.append(keys[r])
                b.append(keys[i])
                cell.append(None)
        if block["blocks"].iloc[0] > 1:
            for i in np.flatnonzero(away).tolist():
                a.append(keys[i])
                b.append(None)
                cell.append(int(block["cell"].iloc[0]))
    return pd.DataFrame({"a": pd.array(a, "Int64"), "b": pd.array(b, "Int64"), "cell": pd.array(cell, "Int64")})


def search_pairs(rows: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) between sets of large cells that were away from the centre and the cells' blocks."""
    sets = _sets(rows.drop_duplicates(["key", "text"]))
    a, b = [], []
    rows = rows[rows["key"].isin(sets)].drop(columns="text").sort_values("query", ascending=False)
    for block in _groups(rows.drop_duplicates(["cell", "block", "part", "key"]), ["cell", "block", "part"]):
        keys = block["key"].tolist()
        roots, _ = cell_links([sets[k] for k in keys], None, np.flatnonzero(block["query"].to_numpy()).tolist())
        for i, r in enumerate(roots):
            if i != r:
                a.append(keys[r])
                b.append(keys[i])
    return pd.DataFrame({"a": np.array(a, np.int64), "b": np.array(b, np.int64)})


# -- the join ------------------------------------------------------------------


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(described documents, links): ``described`` has (id, row, n, key) a row, ``links`` (a, b)
    joins keys of sets that are linked directly or through other links."""
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    described = written(describe(docs, id_col, text_col), "described")
    frequent = frequent_shingles(described)
    described = described.filter("id is not null").select("id", "row", "n", "key")
    cells = (
        first_shingles(docs, frequent, text_col, buckets)
        .groupBy("bucket")
        .applyInPandas(bucket_cells, "cell bigint, key bigint, n bigint, shared bigint")
        .groupBy("cell", "key")
        .agg(F.sum("shared").alias("shared"), F.max("n").alias("n"))
    )
    # a set's cells, smallest first, are bounded by its own first shingles
    upwards = Window.partitionBy("key").orderBy("shared", "cell").rowsBetween(Window.unboundedPreceding, 0)
    least = F.greatest(F.lit(1), F.expr(f"((3 * n + 3) div 4) div {EXTRA}"))
    cells = written(cells.withColumn("s", F.sum("shared").over(upwards)).filter(2 * F.col("s") >= least).drop("s"), "cells")
    size = cells.groupBy("cell").agg(
        F.count("*").alias("m"), F.max(F.struct("shared", (-F.col("n")).alias("n"), "key"))["key"].alias("centre")
    )
    size = size.filter("m > 1").withColumn("blocks", F.expr(f"cast(ceil(m / {BLOCK}) as int)"))
    member = cells.select("cell", "key").join(size.select("cell", "centre", "blocks"), "cell")
    member = written(member, "members").withColumn("block", F.expr("cast(pmod(xxhash64(key, cell), blocks) as int)"))
    holders = described.filter("key is not null").groupBy("key").agg(F.min(F.struct("id", "row"))["row"].alias("row"))
    own = F.col("key") == F.col("centre")
    places = member.withColumn("block", F.explode(F.when(own, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array("block"))))
    found = written(
        _with_texts(docs, places.withColumn("centre", own), holders, id_col, text_col)
        .groupBy(_task(spark, "cell", "block"))
        .applyInPandas(search_blocks, "a bigint, b bigint, cell bigint"),
        "found",
    )
    out = found.filter("b is not null").select("a", "b")
    rest = found.filter("b is null").select("cell", F.col("a").alias("key")).distinct()
    n_rest = rest.groupBy("cell").agg(F.expr(f"cast(ceil(count(*) / {BLOCK}) as int)").alias("parts"))
    if not rest.isEmpty():
        large = member.join(n_rest, "cell").select("cell", "key", "block", "blocks", "parts")
        part = F.expr("cast(pmod(xxhash64(key, 7), parts) as int)")
        among = large.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        asked = (
            large.join(rest, ["cell", "key"])
            .withColumn("part", part)
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        )
        columns = ["cell", "key", "block", "part"]
        both = among.select(*columns, F.lit(False).alias("query")).unionByName(asked.select(*columns, F.lit(True).alias("query")))
        more = _with_texts(docs, both, holders, id_col, text_col).groupBy(_task(spark, "cell", "block", "part"))
        more = more.applyInPandas(search_pairs, "a bigint, b bigint")
        out = out.unionByName(more)
    return described, out


def _task(spark, *names: str):
    """Blocks are searched some at a time: eight tasks' worth for each shuffle partition."""
    tasks = 8 * max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return F.pmod(F.xxhash64(*names), F.lit(tasks)).alias("task")


def _with_texts(docs: DataFrame, places: DataFrame, holders: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``places`` with the text of a document of each key; the text is shuffled once by its row's key, then to its places."""
    names = [c for c in places.columns if c != "key"]
    by_row = (
        places.groupBy("key").agg(F.collect_list(F.struct(*names)).alias("_places")).join(holders, "key").select("row", "key", "_places")
    )
    by_row = written(by_row, "places")
    texts = docs.select(row_key(id_col, text_col).alias("row"), F.col(text_col).cast("string").alias("text"))
    joined = likely_rows(texts, "row", by_row).join(by_row, "row").filter(F.col("text").isNotNull())
    return joined.select("key", "text", F.explode("_places").alias("_p")).select("key", "text", *[F.col(f"_p.{c}").alias(c) for c in names])


def _placed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, row, n, root) of every row of ``docs``; ``root`` is null without shingles."""
    described, found = links(docs, id_col, text_col)
    roots = components(found)
    placed = described.join(roots.withColumnRenamed("node", "key"), "key", "left").select(
        "id", "row", "n", F.coalesce("root", "key").alias("root")
    )
    return written(placed, "placed")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``."""
    placed = _placed(docs, id_col, text_col)
    least = placed.filter("root is not null").groupBy("root").agg(F.min("id").alias("component"))
    out = placed.join(least, "root", "left").select(
        F.nullif("id", F.lit(NO_ID)).alias(id_col),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("component", "id"), F.lit(NO_ID)).alias("component_id"),
    )
    return out


def repeated_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two sets of ``row_key``s: rows that go when of each component the row of least id stays (of rows
    of that id, or without one, that of least key), and rows that occur more than once."""
    rows = _placed(docs, id_col, text_col).groupBy("root", "id", "row").agg(F.count("*").alias("copies"))
    first = rows.filter("root is not null").groupBy("root").agg(F.min(F.struct("id", "row")).alias("f"), F.count("*").alias("n")).filter("n > 1")
    gone = rows.join(first, "root").filter(F.col("row") != F.col("f.row")).select("row")
    return written(gone, "gone"), written(rows.filter("copies > 1").select("row"), "copies")

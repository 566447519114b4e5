"""Operator 12: ranked lexical search by pipelined term partitioning.

Documents are indexed once, in blocks of up to ``BLOCK_DOCS`` documents: for each
block and each of ``OWNERS`` owners of terms (by hash) one row holds the postings of
that owner's terms in that block. Every item goes to every block as a bundle: its
terms with their weights, and a sparse accumulator of (document, score), empty at
first. A stage is one owner: bundles and the owner's postings of the same block meet
by ``cogroup``, the owner adds the integer contributions of its terms to the
accumulators, and the bundles go on to the next owner. After the last one a block's
best documents of each item are selected, and of these the best of all blocks.

Bundles, postings and blocks are bounded, whatever a term's frequency: a term that
every document holds has a part in each block. Items are dealt into sets of
``SET_ITEMS``; beyond one set the postings are copied for each. Only terms that an
item holds are indexed while these are ``MAX_TERMS`` at most (they are broadcast);
beyond that all terms are.

Scores are integers and agree with 64-bit arithmetic whose divisions round down;
term weights come from one logarithm in doubles.

Defined results: null texts and texts without a term are no match and are not
counted. Every document row is ranked, also rows of equal id and rows without an
id (after others of equal score). Every item row is answered by itself, also where
ids repeat or lack. Items without a term that a document holds give no row. Other
columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import shared, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OWNERS = 4
BLOCK_DOCS = 2_048
BLOCK_TERMS = 1_000_000
SET_ITEMS = 256
#: Blocks that take the bundles of a set of items from one copy of the set.
SALT_BLOCKS = 32
MAX_TERMS = 1_000_000
TOP = 10
#: ASCII letters and digits stay, A-Z as a-z, other ASCII characters part terms; bytes of others stay.
TABLE = bytes(c if c > 127 or chr(c).isalnum() else 32 for c in range(256)).lower()

INDEX = "block bigint, owner int, terms array<binary>, ends binary, docs binary, tfs binary, lengths binary, ids binary, no_id binary"
BUNDLE = "block bigint, item_set int, item bigint, terms array<binary>, weights array<bigint>, docs binary, scores binary"


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(TABLE).split() if text else []


def owner_of(term: bytes) -> int:
    return xxhash.xxh32_intdigest(term) % OWNERS


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term): the distinct terms of each item row; ``item`` numbers the rows."""
    rows = items.select(F.monotonically_increasing_id().alias("item"), F.col(id_col).alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    id_type = rows.schema["item_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column("text").to_pylist()):
                terms = sorted(set(terms_of(text)))
                at = pa.array([i] * len(terms), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column("item").take(at), b.column("item_id").take(at), pa.array(terms, pa.binary())], names=["item", "item_id", "term"])

    return rows.mapInArrow(run, f"item bigint, item_id {id_type}, term binary")


class _Block:
    """The postings of the documents gathered so far."""

    def __init__(self) -> None:
        self.ids: list = []
        self.lengths: list[int] = []
        self.postings: dict[bytes, list[int]] = {}

    def add(self, doc_id: int | None, terms: list[bytes], wanted) -> None:
        doc = len(self.ids)
        self.ids.append(doc_id)
        self.lengths.append(len(terms))
        for term, tf in Counter(terms).items():
            if wanted is None or term in wanted:
                held = self.postings.get(term)
                if held is None:
                    self.postings[term] = [doc, tf]
                else:
                    held.append(doc)
                    held.append(tf)

    def rows(self, block: int) -> Iterator[dict]:
        """One row an owner, those without postings too: they carry the lengths and ids."""
        lost = np.array([i is None for i in self.ids])
        common = {
            "lengths": np.array(self.lengths, np.int64).tobytes(),
            "ids": np.array([i or 0 for i in self.ids], np.int64).tobytes(),
            "no_id": lost.tobytes() if lost.any() else None,
        }
        owned: list[list[bytes]] = [[] for _ in range(OWNERS)]
        for term in self.postings:
            owned[owner_of(term)].append(term)
        for owner, terms in enumerate(owned):
            pairs = [np.array(self.postings[t], np.int32).reshape(-1, 2) for t in terms]
            whole = np.concatenate(pairs) if pairs else np.empty((0, 2), np.int32)
            yield common | {
                "block": block, "owner": owner, "terms": terms,
                "ends": np.cumsum([len(p) for p in pairs], dtype=np.int32).tobytes(),
                "docs": whole[:, 0].astype(np.uint16).tobytes(), "tfs": np.ascontiguousarray(whole[:, 1]).tobytes(),
            }


def index(docs: DataFrame, wanted: frozenset[bytes] | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted file: one row for each block of documents and owner of terms (see ``INDEX``)."""
    vocabulary = shared(docs.sparkSession, wanted, lambda s: s)
    schema = pa.schema([("block", pa.int64()), ("owner", pa.int32()), ("terms", pa.list_(pa.binary())), *[(c, pa.binary()) for c in ("ends", "docs", "tfs", "lengths", "ids", "no_id")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, part, n = vocabulary(), TaskContext.get().partitionId(), 0
        block, held = _Block(), 0
        for b in batches:
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("text"), strict=True):
                terms = terms_of(text.as_py())
                if not terms:
                    continue
                block.add(doc_id, terms, known)
                held += len(terms)
                if len(block.ids) == BLOCK_DOCS or held >= BLOCK_TERMS:
                    yield pa.RecordBatch.from_pylist(list(block.rows((part << 32) + n)), schema)
                    block, held, n = _Block(), 0, n + 1
        if block.ids:
            yield pa.RecordBatch.from_pylist(list(block.rows((part << 32) + n)), schema)

    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, INDEX)


def _sums(index_rows: DataFrame) -> tuple[int, int]:
    """Documents with a term, and all their terms with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = [np.frombuffer(x, np.int64) for x in b.column("lengths").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in lengths], pa.int64()), pa.array([int(x.sum()) for x in lengths], pa.int64())], names=["n", "l"])

    got = index_rows.filter("owner = 0").select("lengths").mapInArrow(run, "n bigint, l bigint").agg(F.sum("n"), F.sum("l")).first()
    return got[0] or 0, got[1] or 0


def _frequencies(index_rows: DataFrame) -> DataFrame:
    """(term, df): in how many documents each term is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for terms, ends in zip(b.column("terms"), b.column("ends").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([terms.values, pa.array(np.diff(np.frombuffer(ends, np.int32), prepend=0), pa.int64())], names=["term", "n"])

    return index_rows.select("terms", "ends").mapInArrow(run, "term binary, n bigint").groupBy("term").agg(F.sum("n").alias("df"))


def search(docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of every item by score, then id."""
    spark = docs.sparkSession
    item_terms = written(_item_terms(items, item_id, text_col), "items")
    vocabulary = item_terms.select("term").distinct()
    wanted = None
    if vocabulary.count() <= MAX_TERMS:
        wanted = frozenset(vocabulary.toArrow().column("term").to_pylist())
    postings = written(index(docs, wanted, doc_id, text_col), "index")
    n_docs, n_terms = _sums(postings)
    weight = F.floor(1000 * F.log((2.0 * n_docs + 2) / (2.0 * F.col("df") + 1))).cast("bigint")
    weighted = item_terms.join(_frequencies(postings), "term").withColumn("weight", weight)
    both = F.array_sort(F.collect_list(F.struct("term", "weight")))  # an item's own terms
    weighed = written(weighted.groupBy("item", "item_id").agg(both.alias("t")).select("item", "item_id", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "weights")
    n_sets = max(1, -(-weighed.count() // SET_ITEMS))
    by_set = F.explode(F.sequence(F.lit(0), F.lit(n_sets - 1))).alias("item_set")
    blocks = postings.filter("owner = 0").select("block", by_set)
    # every block takes every set of items; the sets are copied so that no key has many blocks
    n_salts = blocks.count() // n_sets // SALT_BLOCKS + 1
    placed = weighed.withColumn("item_set", F.pmod(F.xxhash64("item"), F.lit(n_sets)).cast("int"))
    salted = placed.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n_salts - 1).cast("bigint"))))
    none = F.lit(b"").alias("docs"), F.lit(b"").alias("scores")
    met = blocks.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(n_salts))).join(salted, ["item_set", "salt"])
    bundles = met.select("block", "item_set", "item", "terms", "weights", *none)
    sizes = (n_docs, max(1, n_terms))
    for owner in range(OWNERS):
        own = postings.filter(F.col("owner") == owner).select("*", by_set).withColumn("block", F.col("block") + 0)  # a column of its own, beside the bundles'
        last = owner == OWNERS - 1
        stage = _stage(owner, sizes, top if last else None)
        schema = "item bigint, doc_id bigint, score bigint" if last else BUNDLE
        bundles = bundles.groupBy("block", "item_set").cogroup(own.groupBy("block", "item_set")).applyInArrow(stage, schema)
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last()))
    best = bundles.withColumn("rank", place).filter(F.col("rank") <= top)  # limited in each task before the shuffle
    return best.join(weighed.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _stage(owner: int, sizes: tuple[int, int], top: int | None):
    """What an owner does with the bundles of one block and set of items; the last one selects."""
    n_docs, n_terms = sizes

    def run(bundles: pa.Table, own: pa.Table) -> pa.Table:
        rows = own.to_pylist()[0]  # a block has one row an owner
        lengths = np.frombuffer(rows["lengths"], np.int64)
        m = 100 - 90 + (90 * lengths * n_docs) // n_terms
        ends = np.frombuffer(rows["ends"], np.int32)
        docs, tfs = np.frombuffer(rows["docs"], np.uint16), np.frombuffer(rows["tfs"], np.int32).astype(np.int64)
        part = (1_000_000_000 * tfs) // (1_000 * tfs + 8 * m[docs])
        place = {t: i for i, t in enumerate(rows["terms"])}
        starts = np.concatenate(([0], ends[:-1])) if len(ends) else ends
        out: list[tuple] = []
        for item, terms, weights, held, scores in zip(*[bundles.column(c).to_pylist() for c in ("item", "terms", "weights", "docs", "scores")], strict=True):
            total = np.zeros(len(lengths), np.int64)
            total[np.frombuffer(held, np.uint16)] = np.frombuffer(scores, np.int64)
            rest = []
            for term, weight in zip(terms, weights, strict=True):
                at = place.get(term)
                if at is not None:
                    a, b = starts[at], ends[at]
                    total[docs[a:b]] += weight * part[a:b]
                elif owner_of(term) > owner:
                    rest.append((term, weight))
            out.append((item, rest, total))
        return _selected(out, rows, top) if top else _passed(bundles, out)

    return run


def _passed(bundles: pa.Table, out: list[tuple]) -> pa.Table:
    """The bundles for the next owner: the terms that are left, and the accumulators' documents with a score."""
    at = [np.flatnonzero(total) for *_, total in out]
    columns = {
        "terms": pa.array([[t for t, _ in rest] for _, rest, _ in out], pa.list_(pa.binary())),
        "weights": pa.array([[w for _, w in rest] for _, rest, _ in out], pa.list_(pa.int64())),
        "docs": pa.array([a.astype(np.uint16).tobytes() for a in at], pa.binary()),
        "scores": pa.array([total[a].tobytes() for (*_, total), a in zip(out, at, strict=True)], pa.binary()),
    }
    return pa.table([bundles.column(c) for c in ("block", "item_set", "item")] + list(columns.values()), names=["block", "item_set", "item", *columns])


def _selected(out: list[tuple], rows: dict, top: int) -> pa.Table:
    """Of each item the block's ``top`` documents by score, then id."""
    ids = np.frombuffer(rows["ids"], np.int64)
    lost = np.frombuffer(rows["no_id"], np.bool_) if rows["no_id"] else np.zeros(len(ids), np.bool_)
    found: tuple[list, list, list] = ([], [], [])
    for item, _, total in out:
        at = np.flatnonzero(total)
        if len(at) > top:
            least = np.partition(total[at], len(at) - top)[len(at) - top]
            at = at[total[at] >= least]
        best = at[np.lexsort((ids[at], lost[at], -total[at]))][:top]
        found[0].extend([item] * len(best))
        found[1].extend(None if lost[i] else int(ids[i]) for i in best)
        found[2].extend(total[best].tolist())
    return pa.table([pa.array(c, pa.int64()) for c in found], names=["item", "doc_id", "score"])

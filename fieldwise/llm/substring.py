"""Operator 6: substring dedup by level-wise doubling.

Windows of half the length come first: each window of ``window`` words is
represented by the least hash among its half-length runs, so equal windows
meet under one representative. Representatives met in one document alone are
dropped; what is left is extended to the doubled, full length and compared
there, by (representative, 64-bit hash of the full window): one hot passage can
stand for millions of different windows, whose own hashes must tell them apart.
A window that also starts in a document with a smaller id is removed with all its words.

The work is shuffled once, by representative. Before it, each chunk of texts
keeps of equal windows only those of the least id (the others are already known
to repeat), so a passage that a third of all documents share reaches a bucket
once a chunk, not once a document. Only removed window starts travel on; they
are joined to the texts, by id and a hash of the text: rows without an id, or of one
id, are told apart by it.

Words are runs ``[^\\x20\\x09-\\x0D]+``, unchanged. Defined results: a null or
blank text has no words, nothing to remove and the hash of an empty text; so
has a text of fewer words than a window nothing to remove. Ties: windows of
rows with one id never remove each other. A null id counts as larger than any
other. Repeated rows get equal results. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, WordHash, chunks, mixed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 50
CHUNK_WORDS = 400_000
NO_ID = (1 << 63) - 1
#: An odd multiplier and its inverse modulo 2**64 (fixed, so that hashes agree between tasks).
STEP = 0xD6E8FEB86659FD93
STEP_INVERSE = pow(STEP, -1, 1 << 64)

PACKED = (
    "bucket int, doc_ids binary, doc_keys binary, owner binary, first binary, count binary, least binary, hash binary,"
    " gone_ids binary, gone_keys binary, gone_first binary, gone_count binary"
)
GONE = "id bigint, doc_key bigint, first binary, count binary"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


def text_key(words: Sequence[bytes]) -> int:
    """A signed 64-bit key of a text's words."""
    return xxhash.xxh64_intdigest(b" ".join(words)) - (1 << 63)


def powers_of(x: int, n: int) -> np.ndarray:
    factors = np.full(n + 1, x, U64)
    factors[0] = 1
    return np.cumprod(factors, dtype=U64)


class Powers:
    """Powers of ``STEP`` and of its inverse, as far as needed so far."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def to(self, n: int) -> None:
        if len(self.up) < n:
            self.up = powers_of(STEP, n)
            self.down = powers_of(STEP_INVERSE, n)


def run_hashes(words: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """Hash of the ``length`` words from each position."""
    n = len(words) - length + 1
    if n <= 0:
        return np.empty(0, U64)
    powers.to(len(words) + 1)
    total = np.concatenate([np.zeros(1, U64), np.cumsum(words * powers.up[: len(words)], dtype=U64)])
    return mixed((total[length:] - total[:n]) * powers.down[:n])


def least_of(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by doubling."""
    reach, low = 1, h
    while reach * 2 <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def window_table(texts: Sequence[list[bytes]], window: int, known: WordHash, powers: Powers) -> dict[str, np.ndarray]:
    """Every whole window of the texts: owner, first word, least half-length hash, own hash."""
    sizes = np.array([len(w) for w in texts], np.int64)
    ends = np.cumsum(sizes)
    words = known.of(itertools.chain.from_iterable(texts), int(sizes.sum()))
    half = run_hashes(words, window // 2, powers)
    n = max(0, len(words) - window + 1)
    if not n:
        none = np.empty(0, np.int64)
        return {"owner": none, "first": none, "least": none.astype(U64), "full": none.astype(U64)}
    least = least_of(half, window - window // 2 + 1)[:n]
    right = half[window - window // 2 :][:n]
    full = mixed(half[:n] * U64(STEP) + (right ^ (right >> U64(31))))
    owner = np.repeat(np.arange(len(texts)), sizes)[:n]
    at = np.arange(n)
    ok = at + window <= ends[owner]
    owner, at = owner[ok], at[ok]
    return {"owner": owner, "first": at - (ends - sizes)[owner], "least": least[ok], "full": full[ok]}


def runs_of(*same: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of the stretches in which ``same`` stay and ``first`` grows by one."""
    n = len(first)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.ones(n, bool)
    new[1:] = np.diff(first) != 1
    for s in same:
        new[1:] |= s[1:] != s[:-1]
    start = np.flatnonzero(new)
    return start, np.diff(np.append(start, n))


def pack(
    texts: Sequence[list[bytes]], ids: Sequence[int], window: int, buckets: int, known: WordHash, powers: Powers, keys: Sequence[int] | None = None
):
    """One row a bucket: the chunk's windows of least id, and (spread over the
    buckets) those that some smaller id in the chunk already repeats. ``keys`` tell texts of one id apart."""
    t = window_table(texts, window, known, powers)
    ids = np.array(ids, np.int64)
    keys = np.array([text_key(w) for w in texts] if keys is None else keys, np.int64)
    own = ids[t["owner"]]
    order = np.lexsort((own, t["full"]))
    new = np.ones(len(order), bool)
    new[1:] = t["full"][order][1:] != t["full"][order][:-1]
    group = np.cumsum(new) - 1
    least_id = own[order][new]
    gone = np.zeros(len(order), bool)
    gone[order] = own[order] > least_id[group] if len(order) else False
    bucket = (t["least"] % U64(buckets)).astype(np.int64)
    stay = np.flatnonzero(~gone)
    stay = stay[np.lexsort((stay, bucket[stay]))]
    left = np.flatnonzero(gone)
    start, count = runs_of(t["owner"][left], first=t["first"][left])
    left_owner, left_first = t["owner"][left][start], t["first"][left][start]
    # a document's known repeats go to the bucket of its key
    left_bucket = keys[left_owner] % buckets if len(left) else np.empty(0, np.int64)
    for b in np.union1d(np.unique(bucket[stay]), np.unique(left_bucket)).tolist():
        lo, hi = np.searchsorted(bucket[stay], [b, b + 1])
        mine = stay[lo:hi]
        start, n = runs_of(t["owner"][mine], t["least"][mine], first=t["first"][mine])
        docs, owner = np.unique(t["owner"][mine][start], return_inverse=True)
        away = np.flatnonzero(left_bucket == b)
        yield (
            b,
            ids[docs].tobytes(),
            keys[docs].tobytes(),
            owner.astype(np.uint16).tobytes(),
            t["first"][mine][start].astype(np.int32).tobytes(),
            n.astype(np.int32).tobytes(),  # a run of a repetitive text can pass 65,535
            t["least"][mine][start].tobytes(),
            t["full"][mine].tobytes(),
            ids[left_owner[away]].tobytes(),
            keys[left_owner[away]].tobytes(),
            left_first[away].astype(np.int32).tobytes(),
            count[away].astype(np.int32).tobytes(),
        )


def meet(bucket: pd.DataFrame) -> dict[str, np.ndarray]:
    """The runs of a bucket's windows that also start in a document of smaller id."""
    ids, keys, owner, first, count, least, hashes = [], [], [], [], [], [], []
    base = 0
    for r in bucket.itertuples(index=False):
        d = np.frombuffer(r.doc_ids, np.int64)
        ids.append(d)
        keys.append(np.frombuffer(r.doc_keys, np.int64))
        owner.append(np.frombuffer(r.owner, np.uint16).astype(np.int64) + base)
        first.append(np.frombuffer(r.first, np.int32))
        count.append(np.frombuffer(r.count, np.int32).astype(np.int64))
        least.append(np.frombuffer(r.least, U64))
        hashes.append(np.frombuffer(r.hash, U64))
        base += len(d)
    ids, keys, owner, first, count, least, hashes = map(np.concatenate, (ids, keys, owner, first, count, least, hashes))
    # half length: a representative that one document alone holds goes
    order = np.argsort(least, kind="stable")
    new = np.ones(len(order), bool)
    new[1:] = least[order][1:] != least[order][:-1]
    group = np.cumsum(new) - 1
    n_groups = int(group[-1]) + 1 if len(group) else 0
    lo, hi = np.full(n_groups, NO_ID, np.int64), np.full(n_groups, -NO_ID, np.int64)
    np.minimum.at(lo, group, ids[owner[order]])
    np.maximum.at(hi, group, ids[owner[order]])
    runs = np.sort(order[(lo < hi)[group]]) if n_groups else order
    # full length: windows of the runs that are left
    at = np.concatenate([[0], np.cumsum(count)])
    n = count[runs]
    run = np.repeat(runs, n)
    step = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    hashed = hashes[at[run] + step]
    own = ids[owner[run]]
    order = np.lexsort((own, hashed, least[run]))
    new = np.ones(len(order), bool)
    new[1:] = (hashed[order][1:] != hashed[order][:-1]) | (least[run][order][1:] != least[run][order][:-1])
    gone = np.zeros(len(order), bool)
    if len(order):
        gone[order] = own[order] > own[order][new][np.cumsum(new) - 1]
    run, step = run[gone], step[gone]
    start, n = runs_of(run, first=step)
    return {"id": ids[owner[run[start]]], "key": keys[owner[run[start]]], "first": first[run[start]] + step[start], "count": n}


def removed_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, doc_key, first, count): runs of removed window starts, packed as int32, a row a document and bucket."""
    spark = docs.sparkSession
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed_names = [c.split()[0] for c in PACKED.split(", ")]

    def split(batches):
        known, powers = WordHash(), Powers()
        for b in batches:
            ids = [NO_ID if i is None else i for i in b.column(0).to_pylist()]
            texts, keys = [words_of(t) for t in b.column(1).to_pylist()], b.column(2).to_pylist()
            # rows repeated with id and text are one document
            first = {(ids[i], keys[i]): i for i in reversed(range(len(texts)))}
            kept = sorted(i for i in first.values() if len(texts[i]) >= window)
            ids, texts, keys = ([x[i] for i in kept] for x in (ids, texts, keys))
            for lo, hi in chunks([len(w) for w in texts], CHUNK_WORDS):
                rows = list(pack(texts[lo:hi], ids[lo:hi], window, buckets, known, powers, keys[lo:hi]))
                cols = [pa.array([r[c] for r in rows], pa.int32() if c == 0 else pa.binary()) for c in range(len(packed_names))]
                yield pa.RecordBatch.from_arrays(cols, names=packed_names)

    def join(bucket: pd.DataFrame) -> pd.DataFrame:
        met = meet(bucket)
        parts = [met] + [
            {
                "id": np.frombuffer(r.gone_ids, np.int64),
                "key": np.frombuffer(r.gone_keys, np.int64),
                "first": np.frombuffer(r.gone_first, np.int32),
                "count": np.frombuffer(r.gone_count, np.int32),
            }
            for r in bucket.itertuples(index=False)
        ]
        ids, keys, first, count = (np.concatenate([p[c] for p in parts]) for c in ("id", "key", "first", "count"))
        # runs that several chunks found for rows of one id and text are one run
        order = np.lexsort((count, first, keys, ids))
        ids, keys, first, count = (x[order] for x in (ids, keys, first, count))
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]) | (first[1:] != first[:-1]) | (count[1:] != count[:-1])
        ids, keys = ids[fresh], keys[fresh]
        first, count = first[fresh].astype(np.int32), count[fresh].astype(np.int32)
        new = np.ones(len(ids), bool)
        new[1:] = (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
        start = np.flatnonzero(new)
        ends = np.append(start, len(ids))[1:]
        return pd.DataFrame(
            {
                "id": ids[start],
                "doc_key": keys[start],
                "first": [first[a:z].tobytes() for a, z in zip(start, ends, strict=True)],
                "count": [count[a:z].tobytes() for a, z in zip(start, ends, strict=True)],
            }
        )

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"), F.xxhash64(F.col(text_col).cast("string")))
    return rows.toDF("id", "text", "doc_key").mapInArrow(split, PACKED).groupBy("bucket").applyInPandas(join, GONE)


def removal_mask(n_words: int, parts: Sequence[tuple[bytes, bytes]] | None, window: int) -> np.ndarray:
    """Which words of a text lie in a removed window."""
    step = np.zeros(n_words + 1, np.int64)
    for first, count in parts or ():
        a = np.frombuffer(first, np.int32)
        np.add.at(step, a, 1)
        np.add.at(step, a + np.frombuffer(count, np.int32) + window - 1, -1)
    return np.cumsum(step[:-1]) > 0


def _with_parts(docs: DataFrame, id_col: str, text_col: str, keep: Sequence[str], window: int) -> DataFrame:
    """``keep`` columns as one struct, the text and its removed windows, found by id and text."""
    gone = removed_windows(docs, id_col, text_col, window)
    found = gone.groupBy(F.col("id").alias("_id"), F.col("doc_key").alias("_key")).agg(F.collect_list(F.struct("first", "count")).alias("_parts"))
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_key"), text.alias("_text"), F.struct(*keep).alias("_doc")
    )
    return rows.join(found, ["_id", "_key"], "left").select("_doc", "_text", "_parts")


def _parts(values: list | None) -> list[tuple[bytes, bytes]]:
    return [(p["first"], p["count"]) for p in values or ()]


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with the kept words of each text, joined by one space, in ``text_col``."""
    keep = [c for c in docs.columns if c != text_col]
    rows = _with_parts(docs, id_col, text_col, keep, window)

    @F.pandas_udf("string")
    def kept(text: pd.Series, parts: pd.Series) -> pd.Series:
        out = []
        for t, p in zip(text, parts, strict=True):
            words = words_of(t)
            mask = removal_mask(len(words), _parts(None if p is None else list(p)), window)
            out.append(b" ".join([w for w, m in zip(words, mask.tolist(), strict=True) if not m]).decode("utf-8"))
        return pd.Series(out)

    return rows.select("_doc.*", kept("_text", "_parts").alias(text_col)).select(*docs.columns)


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(id, n_words, n_removed, kept_sha256) of every row."""
    rows = _with_parts(docs, id_col, text_col, [id_col], window).select(f"_doc.{id_col}", "_text", "_parts")

    def run(batches):
        for b in batches:
            n_words, n_removed, digest = [], [], []
            for text, parts in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                words = words_of(text)
                if parts:
                    mask = removal_mask(len(words), _parts(parts), window)
                    kept = [words[i] for i in np.flatnonzero(~mask).tolist()]
                else:
                    kept = words
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            cols = [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digest, pa.string())]
            yield pa.RecordBatch.from_arrays(cols, names=[id_col, "n_words", "n_removed", "kept_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"{id_col} {kind}, n_words bigint, n_removed bigint, kept_sha256 string")

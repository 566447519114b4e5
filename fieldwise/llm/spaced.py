"""Operator 10: benchmark decontamination by spaced-seed hashing.

A seed is a fixed mask over consecutive words; the words under its holes are
ignored, so a hash of the others still meets when those were substituted. Every
position of every text and of every benchmark item is hashed under every mask,
equal hashes are joined, and each hit names an alignment (document, item, offset
of the item in the document). Every alignment is then verified word by word: it
is an overlap if some stretch of at least ``MIN_OVERLAP`` aligned words (the
whole item, if that is shorter) agrees in at least ``MIN_SAME`` of them.

The text side keeps only hashes that a bit table of all benchmark hashes lets
through. The table has a fixed size (``TABLE_BITS``), whatever the benchmark's;
what it lets through by mistake the join drops. Texts of documents with a hit
are carried on, others are read once and left.

Words are lower-cased runs of letters and digits. Defined results: null and
blank texts or items have no words and never meet; items with fewer words than
the shortest of ``MASKS`` are looked for word for word, as runs that agree wholly.
Repeated document rows are reported alike; repeated items (one id, several
texts) are all looked for. A document with no overlap has no row in ``overlaps``.
"""

from __future__ import annotations

import itertools
import sys
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MULT, U64, WordHash, chunks, mixed, shared, written

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Masks over words: x counts, - is ignored. Some mask is whole at some position
#: of every stretch of 13 to 25 words that agrees in 80%, found by enumeration
#: (tested); a longer one can be cut into such stretches, of which one agrees so.
MASKS = (
    "xxxxxxxx",
    "xxxx-x-xxx",
    "xxx--xxx-xx",
    "xx-xx--xx-xx",
    "xx-x-xx--xxx",
    "xxx-xx--x-xx",
    "xx--x--xxx-xx",
    "xx--x-x-x-xxx",
    "xx-xx-xxx---x",
    "xx-x-x-x--x-xx",
    "xx-x----xx-xxx",
    "xxxx--x----x-xx",
)
#: Masks of items shorter than ``MIN_OVERLAP``, (fewest words, most words): masks; by enumeration too.
SHORT_MASKS = {
    (8, 9): ("xxx-xxx", "x-xxxx-x", "xx-xx-xx"),
    (10, 12): ("xxx-xxx", "x-xxxxx", "xxxxx--x", "xxx--x-xx", "xx--x-x-xx"),
}
MIN_OVERLAP = 13
MIN_SAME = 0.8
TABLE_BITS = 1 << 24
#: ASCII other than letters and digits, as spaces.
SPACED = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))
#: Words hashed at once.
CHUNK_WORDS = 400_000


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased runs of letters, digits and non-ASCII characters, in UTF-8."""
    return (text or "").lower().encode("utf-8").translate(SPACED).split()


def seed_hashes(words: np.ndarray, mask: str, which: int) -> np.ndarray:
    """Hash of the words under ``mask`` from each position where it fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.empty(0, U64)
    h = np.full(n, (which + 1) * 0x632BE59BD9B4E019 % (1 << 64), U64)
    for j, c in enumerate(mask):
        if c == "x":
            h *= U64(MULT)
            h += words[j : j + n]
            h ^= h >> U64(29)
    return mixed(h)


def masks_for(n_words: int) -> list[str]:
    """The masks for an item: those of its length where it is short, a solid one where no mask fits."""
    for (least, most), masks in SHORT_MASKS.items():
        if least <= n_words <= most:
            return list(masks)
    return [m for m in MASKS if len(m) <= n_words] or (["x" * n_words] if n_words else [])


def all_masks() -> list[str]:
    """Every mask that any item can use."""
    shortest = min(map(len, MASKS))
    return list(dict.fromkeys([*MASKS, *itertools.chain(*SHORT_MASKS.values()), *("x" * n for n in range(1, shortest))]))


def item_seeds(items: DataFrame) -> DataFrame:
    """(hash, mask, seq, item_at) of every seed of (seq, item_text) rows."""

    def run(batches):
        known = WordHash()
        numbers = {m: i for i, m in enumerate(all_masks())}
        for b in batches:
            out = ([], [], [], [])
            for seq, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text)
                hashed = known.of(words, len(words))
                for mask in masks_for(len(words)):
                    h = seed_hashes(hashed, mask, numbers[mask])
                    out[0].extend(h.view(np.int64).tolist())
                    out[1].extend([numbers[mask]] * len(h))
                    out[2].extend([seq] * len(h))
                    out[3].extend(range(len(h)))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int32())
            cols = [pa.array(v, t) for v, t in zip(out, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(cols, names=["hash", "mask", "seq", "item_at"])

    return items.select("seq", "item_text").mapInArrow(run, "hash bigint, mask int, seq bigint, item_at int")


def table_bits(h: np.ndarray) -> list[np.ndarray]:
    """The bits of a hash in the table, from three separate parts of it."""
    return [(h >> U64(shift)) % U64(TABLE_BITS) for shift in (0, 20, 40)]


def bit_table(seeds: DataFrame) -> np.ndarray:
    """A bit table of all hashes: ``TABLE_BITS`` bits, however many hashes there are."""

    def run(batches):
        table = np.zeros(TABLE_BITS // 8, np.uint8)
        seen = False
        for b in batches:
            for at in table_bits(b.column(0).to_numpy(zero_copy_only=False).view(U64)):
                np.bitwise_or.at(table, (at >> U64(3)).astype(np.int64), (1 << (at & U64(7)).astype(np.uint8)).astype(np.uint8))
            seen = seen or b.num_rows > 0
        if seen:
            byte = np.flatnonzero(table)
            yield pa.RecordBatch.from_arrays([pa.array(byte.astype(np.int32)), pa.array(table[byte].astype(np.int32))], names=["at", "bits"])

    parts = seeds.select("hash").mapInArrow(run, "at int, bits int").groupBy("at").agg(F.expr("bit_or(bits)").alias("bits"))
    got = parts.toArrow()
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    table[got.column("at").to_numpy()] = got.column("bits").to_numpy().astype(np.uint8)
    return table


def chunk_hits(texts: Sequence[list[bytes]], known: WordHash, table: np.ndarray, masks: Sequence[tuple[str, int]]):
    """(text, hashes, positions) of each text with hashes that the table lets through;
    the texts are hashed end to end, and hashes that reach into the next one dropped."""
    ends = np.cumsum([len(w) for w in texts])
    hashed = known.of(itertools.chain.from_iterable(texts), int(ends[-1]) if len(ends) else 0)
    found, at, owner = [], [], []
    for mask, number in masks:
        h = seed_hashes(hashed, mask, number)
        ok = np.arange(len(h))
        for bits in table_bits(h):
            bit = bits[ok]
            ok = ok[((table[(bit >> U64(3)).astype(np.int64)] >> (bit & U64(7)).astype(np.uint8)) & 1).astype(bool)]
        text = np.searchsorted(ends, ok, side="right")
        inside = ok + len(mask) <= ends[text] if len(ok) else np.zeros(0, bool)
        found.append(h[ok[inside]].view(np.int64))
        at.append(ok[inside])
        owner.append(text[inside])
    found, at, owner = np.concatenate(found or [[]]), np.concatenate(at or [[]]), np.concatenate(owner or [[]])
    for i in np.unique(owner).astype(int).tolist():
        mine = owner == i
        yield i, found[mine], (at[mine] - (ends[i] - len(texts[i]))).astype(np.int32)


def text_hits(docs: DataFrame, table: np.ndarray, masks: Sequence[str], doc_col: str, text_col: str) -> DataFrame:
    """(doc, text, hashes, positions) of every row with a hash that the bit table lets through."""
    numbers = {m: i for i, m in enumerate(all_masks())}
    state = shared(docs.sparkSession, (table, [(m, numbers[m]) for m in masks]), lambda s: s)

    def run(batches):
        table, masks = state()
        known = WordHash()
        for b in batches:
            words = [words_of(t) for t in b.column(1).to_pylist()]
            rows, hashes, places = [], [], []
            for lo, hi in chunks([len(w) for w in words], CHUNK_WORDS):
                for i, found, at in chunk_hits(words[lo:hi], known, table, masks):
                    rows.append(lo + i)
                    hashes.append(found)
                    places.append(at)
            if rows:
                take = pa.array(rows, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(take), b.column(1).take(take), pa.array(hashes, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.int32()))],
                    names=["doc", "text", "hashes", "places"],
                )

    kind = docs.schema[doc_col].dataType.simpleString()
    rows = docs.select(F.col(doc_col).alias("doc"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc {kind}, text string, hashes array<bigint>, places array<int>")


def agreement(doc: Sequence[bytes], item: Sequence[bytes], offset: int) -> tuple[int, int, int, int] | None:
    """The widest stretch of aligned words that agrees enough, as (document word,
    item word, words, equal words); None if there is none."""
    lo, hi = max(0, -offset), min(len(item), len(doc) - offset)
    least = min(MIN_OVERLAP, len(item))
    if hi - lo < least or not least:
        return None
    same = np.fromiter((doc[offset + i] == item[i] for i in range(lo, hi)), bool, hi - lo)
    need = MIN_SAME if len(item) >= min(map(len, MASKS)) else 1.0
    # widest stretch with a share of at least ``need``: prefix sums of same - need
    total = np.concatenate([[0], np.cumsum(same - need)])
    low = np.minimum.accumulate(total)
    best = None
    for end in range(len(same), 0, -1):
        if best and end <= best[1] - best[0]:
            break
        start = int(np.searchsorted(-low, -(total[end] + 1e-9), side="left"))
        if start < end and end - start >= least and (not best or end - start > best[1] - best[0]):
            best = (start, end)
    if not best:
        return None
    start, end = best
    return offset + lo + start, lo + start, end - start, int(same[start:end].sum())


OVERLAP = "first_word int, item_word int, n_words int, n_same int"


def overlaps(
    docs: DataFrame,
    bench: DataFrame,
    doc_col: str = "doc_id",
    item_col: str = "item_id",
    text_col: str = "text",
    bench_text_col: str = "text",
) -> DataFrame:
    """Every verified overlap: (doc, item, first_word, item_word, n_words, n_same)."""
    items = bench.select(F.col(item_col).alias("item"), F.col(bench_text_col).cast("string").alias("item_text"))
    items = written(items.withColumn("seq", F.monotonically_increasing_id()), "items")
    seeds = written(item_seeds(items), "seeds")
    names = all_masks()
    used = sorted(r["mask"] for r in seeds.select("mask").distinct().collect())  # one row a mask
    hits = text_hits(docs, bit_table(seeds), [names[m] for m in used], doc_col, text_col)
    hits = written(hits.withColumn("row", F.monotonically_increasing_id()), "hits")
    met = (
        hits.select("row", F.explode(F.arrays_zip("hashes", "places")).alias("h"))
        .select("row", F.col("h.hashes").alias("hash"), F.col("h.places").alias("at"))
        .join(seeds, "hash")
        .select("row", "seq", (F.col("at") - F.col("item_at")).alias("offset"))
        .distinct()
    )
    aligned = (
        met.join(items, "seq").join(hits.select("row", "doc", "text"), "row").select("doc", "item", "offset", "item_text", "text")
    )

    def run(batches):
        split: dict[str, list[bytes]] = {}

        def words(text: str) -> list[bytes]:
            if text not in split:
                if len(split) >= 64:
                    split.clear()
                split[text] = words_of(text)
            return split[text]

        for b in batches:
            docs_, items_ = b.column(0), b.column(1)
            rows, got = [], []
            for i, (offset, item, text) in enumerate(zip(*(b.column(c).to_pylist() for c in (2, 3, 4)), strict=True)):
                if found := agreement(words(text), words(item), offset):
                    rows.append(i)
                    got.append(found)
            take = pa.array(rows, pa.int32())
            found = [pa.array([g[c] for g in got], pa.int32()) for c in range(4)]
            yield pa.RecordBatch.from_arrays(
                [docs_.take(take), items_.take(take), *found], names=["doc", "item", "first_word", "item_word", "n_words", "n_same"]
            )

    schema = f"doc {docs.schema[doc_col].dataType.simpleString()}, item {bench.schema[item_col].dataType.simpleString()}, {OVERLAP}"
    return aligned.mapInArrow(run, schema).distinct()

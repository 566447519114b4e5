"""Operator 7: quality rules on repeated text, by suffix array.

The words of a batch of documents are laid end to end, each document closed by
a symbol of its own, and sorted into one suffix array by prefix doubling; the
kept ranks of each doubling give the longest common prefixes of neighbours.
Since the first symbol carries its document, no match leaves a document. A
suffix's longest common prefix with either neighbour is the longest repeat
that starts there (the LCP interval it belongs to); the maximal ones among
them (no longer repeat covers them from the left) are the repeated spans. Their
union, as a share of the words' characters, and the longest of them are
limited.

Defined results: a null or blank text has no words, counts 0 and fails the base
rule. Words are runs ``[^\\x20\\x09-\\x0D]+``. Each row is judged alone, so
repeated rows, ties and other columns change nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, map_texts

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Base rule.
MIN_WORDS = 20
WINDOW = 8
MAX_REPEAT_PCT = 30
#: The method's rule: repeats of at least so many words count, may cover so
#: large a share of the characters in words, and none may be longer than this.
MIN_REPEAT = 5
MAX_COVERED = 0.4
MAX_LONGEST = 100
#: Words sorted in one suffix array (a longer document has its own).
BATCH_WORDS = 300_000


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols; the last are all different.

    A rank is the number of suffixes in earlier groups, so a refined group
    keeps its place and only groups of two or more are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = symbols[order[1:]] != symbols[order[:-1]]
    starts = np.flatnonzero(new)
    rank = np.empty(n, np.int32)
    rank[order] = np.repeat(starts, np.diff(np.append(starts, n)))
    levels, active, k = [rank], order[_shared(new)], 1
    while len(active):
        after = np.where(active + k < n, rank[np.minimum(active + k, n - 1)], -1).astype(np.int64)
        key = rank[active].astype(np.int64) * (n + 1) + after + 1
        by = np.argsort(key, kind="stable")
        active, key = active[by], key[by]
        group = rank[active]
        new = np.empty(len(active), bool)
        new[0] = True
        new[1:] = key[1:] != key[:-1]
        at = np.arange(len(active))
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        group_at = np.repeat(first, np.diff(np.append(first, len(active))))
        starts = np.flatnonzero(new)
        own_at = np.repeat(starts, np.diff(np.append(starts, len(active))))
        rank = rank.copy()
        rank[active] = group + (own_at - group_at)
        levels.append(rank)
        active = active[at[_shared(new)]]
        k *= 2
    return levels


def _shared(new: np.ndarray) -> np.ndarray:
    """Which members of sorted groups (``new`` marks each first) are not alone."""
    return ~(new & np.append(new[1:], True))


def longest_repeats(symbols: np.ndarray) -> np.ndarray:
    """For each position the length of the longest run that starts there and also elsewhere."""
    n = len(symbols)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    levels = suffix_ranks(symbols)
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    left, right = suffixes[:-1], suffixes[1:]
    pair = np.flatnonzero(levels[0][left] == levels[0][right])
    a, b = left[pair], right[pair]
    common = np.zeros(len(pair), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        i, j = a + common, b + common
        inside = (i < n) & (j < n)
        i, j = np.minimum(i, n - 1), np.minimum(j, n - 1)
        common += np.where(inside & (levels[k][i] == levels[k][j]), 1 << k, 0)
    np.maximum.at(out, a, common)
    np.maximum.at(out, b, common)
    return out


def covered(lengths: np.ndarray, least: int, span: int | None = None) -> np.ndarray:
    """Which positions lie in a repeat of at least ``least`` words (or its first ``span``)."""
    n = len(lengths)
    at = np.flatnonzero(lengths >= least)
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, np.minimum(at + (lengths[at] if span is None else span), n), -1)
    return np.cumsum(step[:-1]) > 0


def repeats_of(texts: Sequence[str | None], limit: int = BATCH_WORDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(longest repeat from each word, characters of each word) of every text."""
    held: list[list[bytes]] = []
    total = 0
    for t in texts:
        words = (t or "").encode("utf-8").split()
        if held and total + len(words) + 1 > limit:
            yield from _batch_repeats(held)
            held, total = [], 0
        held.append(words)
        total += len(words) + 1
    if held:
        yield from _batch_repeats(held)


def _batch_repeats(words: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The same of documents that share one suffix array."""
    ids: dict[bytes, int] = {}
    known = [np.fromiter((ids.setdefault(w, len(ids)) for w in own), np.int64, len(own)) for own in words]
    n_ids = len(ids) + 1
    docs = [np.append(own, n_ids - 1) + d * n_ids for d, own in enumerate(known)]
    lengths = longest_repeats(np.concatenate(docs))
    at = 0
    for own in words:
        yield lengths[at : at + len(own)], np.fromiter((len(w.decode("utf-8")) for w in own), np.int64, len(own))
        at += len(own) + 1


def maximal_spans(lengths: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(first word, word count) of the repeats that no repeat from one word before covers."""
    before = np.append(0, lengths[:-1])
    at = np.flatnonzero((lengths >= least) & (before <= lengths))
    return [(int(i), int(lengths[i])) for i in at]


OUT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("word_chars", T.LongType()),
        T.StructField("n_symbols", T.LongType()),
        T.StructField("n_dup_lines", T.LongType()),
        T.StructField("n_repeat_words", T.LongType()),
        T.StructField("covered_chars", T.LongType()),
        T.StructField("longest_repeat", T.LongType()),
    ]
)


def measures(texts: Sequence[str | None]) -> dict[str, list[int]]:
    """The measures of every text, by name."""
    got: dict[str, list[int]] = {f.name: [] for f in OUT.fields}
    for text, (lengths, chars) in zip(texts, repeats_of(texts), strict=True):
        text = text or ""
        lines = [x for x in text.split("\n") if x.strip(SPACES)]
        got["n_words"].append(len(chars))
        got["word_chars"].append(int(chars.sum()))
        got["n_symbols"].append(sum(map(text.count, SYMBOLS)))
        got["n_dup_lines"].append(len(lines) - len(set(lines)))
        got["n_repeat_words"].append(int(covered(lengths, WINDOW, WINDOW).sum()))
        got["covered_chars"].append(int(chars[covered(lengths, MIN_REPEAT)].sum()))
        got["longest_repeat"].append(int(lengths.max(initial=0)))
    return got


def measure(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns and the measures of every whole text."""
    return map_texts(docs, measures, keep, OUT, text_col)


def measured(text: Column) -> Column:
    """The measures as a struct column: only the text goes to Python, whatever else a row holds."""

    @F.pandas_udf(OUT)
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(measures(texts.tolist()))

    return run(text.cast("string"))


def repeated_spans(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text", least: int = MIN_REPEAT) -> DataFrame:
    """``keep`` columns and the maximal repeated spans of every text as (first word, words)."""
    span = T.StructType([T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())])

    def run(texts):
        spans = [maximal_spans(lengths, least) for lengths, _ in repeats_of(texts)]
        return {"spans": [[{"first_word": a, "n_words": n} for a, n in s] for s in spans]}

    return map_texts(docs, run, keep, T.StructType([T.StructField("spans", T.ArrayType(span))]), text_col)


def base_failed(of: str = ""):
    """Of measures in columns, or (``of``: its name and a dot) in a struct."""
    n_words = F.col(f"{of}n_words")
    return (n_words < MIN_WORDS) | (100 * F.col(f"{of}n_repeat_words") > MAX_REPEAT_PCT * n_words)


def verdict(of: str = ""):
    """Kept: the base rule holds and repeats are neither too much of the text nor too long."""
    return (
        ~base_failed(of)
        & (F.col(f"{of}covered_chars") <= MAX_COVERED * F.col(f"{of}word_chars"))
        & (F.col(f"{of}longest_repeat") <= MAX_LONGEST)
    )


def kept_rows(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, as they are."""
    name = free_name(docs, "_measures")
    return docs.withColumn(name, measured(F.col(text_col))).filter(verdict(f"{name}.")).drop(name)


def judge(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every row."""
    return measure(docs, keep, text_col).withColumns({"base_failed": base_failed(), "kept": verdict()})

"""Operator 3: BPE encoding and decoding with a contiguous rank array.

A word's symbols and the merge ranks of its adjacent pairs lie in two short
lists. The minimum rank is found by scanning, the right part of that pair is
deleted, and only the two neighbouring ranks are looked up again. Words over
``SHORT`` symbols keep their pairs in a heap instead, which merges in the same
order (lowest rank, then leftmost) without a quadratic scan.

The vocabulary (a ``tokenizers`` JSON file whose path is a parameter) is read
on the driver and broadcast; its size is fixed by the file.

Defined results: a null text encodes as an empty one: no ids, empty decoded
text, and the hash of no bytes. Special tokens written in a text become their
one id. Characters that Unicode 15.1 leaves unassigned may be split otherwise
than by the library. Repeated rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
import unicodedata
from collections.abc import Callable

import numpy as np
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_texts, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHORT = 200
WORD_END = "</w>"
#: Words whose encoding a task remembers at once.
REMEMBERED = 250_000
#: Control characters that Python, but not the pre-tokenizer, takes for white space.
SEPARATORS = regex.compile(r"[\x1c-\x1f]")
#: Fixed value: the pre-tokenizer's pattern, with its white space spelled out.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+"


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in a byte-level vocabulary: printable
    Latin-1 bytes stand for themselves, the rest follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(0x100, 0x200))
    own = set(plain)
    return [chr(b) if b in own else chr(next(shifted)) for b in range(256)]


class _Remembered(dict):
    """key -> make(key); emptied when it holds ``limit`` keys, long keys are not held."""

    def __init__(self, make: Callable[[str], tuple[bytes, str]], limit: int) -> None:
        self.make = make
        self.limit = limit

    def __missing__(self, key: str) -> tuple[bytes, str]:
        if len(self) >= self.limit:
            self.clear()
        got = self.make(key)
        if len(key) <= SHORT:
            self[key] = got
        return got


class Vocabulary:
    """Ids, merges and special tokens of a word-end BPE file."""

    def __init__(self, spec: dict) -> None:
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in self.ids.items()} | {i: t for t, i in self.special.items()}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[self.ids[left], self.ids[right]] = (rank, self.ids[left + right])
        symbols = byte_symbols()
        self.inner = [self.ids[s] for s in symbols]
        self.last = [self.ids[s + WORD_END] for s in symbols]

    def encode_word(self, word: str) -> list[int]:
        raw = word.encode("utf-8")
        parts = [self.inner[b] for b in raw[:-1]] + [self.last[raw[-1]]]
        return self._scan(parts) if len(parts) <= SHORT else self._heap(parts)

    def _scan(self, parts: list[int]) -> list[int]:
        pairs, none = self.pairs, (1 << 60, -1)
        ranks = [pairs.get(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least is none:
                break
            at = ranks.index(least)
            parts[at] = least[1]
            del parts[at + 1]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = pairs.get((parts[at], parts[at + 1]), none)
            if at:
                ranks[at - 1] = pairs.get((parts[at - 1], parts[at]), none)
        return parts

    def _heap(self, parts: list[int]) -> list[int]:
        n = len(parts)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heap = []

        def push(left: int) -> None:
            right = after[left]
            if right < n and (found := self.pairs.get((parts[left], parts[right]))):
                heapq.heappush(heap, (found[0], left, found[1], parts[left], parts[right]))

        for i in range(n - 1):
            push(i)
        while heap:
            _, left, new, a, b = heapq.heappop(heap)
            right = after[left]
            if parts[left] != a or right >= n or parts[right] != b:
                continue
            parts[left], parts[right] = new, -1
            after[left] = after[right]
            if after[left] < n:
                before[after[left]] = left
            push(left)
            if before[left] >= 0:
                push(before[left])
        return [p for p in parts if p >= 0]


def read_vocabulary(path: str) -> dict:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


class Codec:
    """Encodes and decodes whole texts; remembers the words and the runs
    between white space that it has met."""

    def __init__(self, vocabulary: Vocabulary, remembered: int = REMEMBERED) -> None:
        self.v = vocabulary
        self.words = regex.compile(WORDS).findall
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.specials = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.known_words = _Remembered(self._encode_word, remembered)
        self.known_runs = _Remembered(self._encode_run, remembered)

    def _encode_word(self, word: str) -> tuple[bytes, str]:
        ids = self.v.encode_word(word)
        return np.array(ids, "<u4").tobytes(), " ".join([self.v.tokens[i] for i in ids])

    def _encode_run(self, run: str) -> tuple[bytes, str]:
        """A run without white space; no word crosses its ends."""
        got = [self.known_words[w] for w in self.words(run)]
        return got[0] if len(got) == 1 else (b"".join([g[0] for g in got]), " ".join([g[1] for g in got]))

    def _plain(self, text: str) -> list[tuple[bytes, str]]:
        text = unicodedata.normalize("NFC", text)
        # lower-casing goes character by character, so a sigma never takes its final form
        text = text.replace("Σ", "σ").lower()
        if SEPARATORS.search(text):  # str.split() would drop them; the pre-tokenizer keeps them
            return [self.known_words[w] for w in self.words(text)]
        return list(map(self.known_runs.__getitem__, text.split()))

    def encode(self, text: str | None) -> tuple[bytes, str]:
        """(ids as little-endian unsigned 32-bit integers, decoded text)."""
        text = text or ""
        if self.specials is None or not self.specials.search(text):
            got = self._plain(text)
        else:
            got, at = [], 0
            for m in self.specials.finditer(text):
                got += self._plain(text[at : m.start()])
                got.append((np.array([self.v.special[m[0]]], "<u4").tobytes(), m[0]))
                at = m.end()
            got += self._plain(text[at:])
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got if g[0]])

    def decode(self, ids: bytes) -> str:
        """The decoded text: the vocabulary's tokens joined by a space."""
        tokens = self.v.tokens
        return " ".join([tokens[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _shared_codec(spark: SparkSession, path: str) -> Callable[[], Codec]:
    return shared(spark, read_vocabulary(path), lambda spec: Codec(Vocabulary(spec)))


def encode(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` array and ``decoded`` text of every row's whole text."""
    codec = _shared_codec(docs.sparkSession, path)

    def run(texts):
        got = [codec().encode(t) for t in texts]
        return {"ids": [np.frombuffer(g[0], "<u4").astype("i8") for g in got], "decoded": [g[1] for g in got]}

    out = T.StructType([T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.StringType())])
    return map_texts(docs, run, keep, out, text_col)


def decode(rows: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), ids_col: str = "ids") -> DataFrame:
    """``keep`` columns and the ``decoded`` text of every row's ``ids`` (null: empty)."""
    codec = _shared_codec(rows.sparkSession, path)

    @F.pandas_udf(T.StringType())
    def decoded(ids):
        return ids.map(lambda x: "" if x is None else codec().decode(np.asarray(x, "<u4").tobytes()))

    return rows.select(*keep, decoded(F.col(ids_col)).alias("decoded"))


def digests(docs: DataFrame, path: str, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``n_tokens`` and hashes of ids and decoded text of every row."""
    codec = _shared_codec(docs.sparkSession, path)

    def run(texts):
        n, a, b = [], [], []
        for t in texts:
            ids, text = codec().encode(t)
            n.append(len(ids) // 4)
            a.append(hashlib.sha256(ids).hexdigest())
            b.append(hashlib.sha256(text.encode("utf-8")).hexdigest())
        return {"n_tokens": n, "ids_sha256": a, "decoded_sha256": b}

    out = T.StructType(
        [
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )
    return map_texts(docs, run, keep, out, text_col)

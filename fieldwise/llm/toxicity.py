"""Operator 9: toxicity by compression distance.

Two zstandard dictionaries, one trained on toxic and one on ordinary labelled
text, compress every window of a text. A window that the toxic dictionary
shortens more than the ordinary one speaks for toxicity.

A window is one word, set into a fixed carrier, because blocks of a few bytes
are not compressed at all. Its bytes are doubled by a fixed code first, which
doubles what literals cost while a dictionary match costs the same; else words
of five letters would be no longer as literals than as a match. Each
dictionary is trained on the words that lean to its class (``LEAN`` times the share of
texts), since most words of toxic texts are ordinary; a text that is labelled wrongly,
or quotes, takes no word from the other dictionary.

Thresholds are calibrated on labelled rows that no dictionary was trained on:
every kind of window (word length, length by the ordinary, length by the toxic
dictionary) has a log ratio of how many toxic and ordinary texts hold one, and
the sum of the ``TOP`` largest of a text's windows goes through a fitted
logistic curve, the score.

Training uses a hash sample of about ``MAX_TOXIC`` and ``MAX_ORDINARY``
labelled rows, a documented bound, fitted on the driver. Every whole text is
scored.

Defined results: a null or blank text has no window; its score is the curve's
value at no evidence. Without both classes in training every score is 0. Scores
do not depend on other rows, so repeated rows score alike. Of several labels
of an id the largest counts; null labels do not.
"""

from __future__ import annotations

import math
import sys
from collections import Counter
from collections.abc import Iterable, Sequence

import numpy as np
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bounded_sample, crc_bucket, map_texts, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TOXIC, MAX_ORDINARY = 2_400, 6_000
HELD_OUT_MODULUS, HELD_OUT_REST = 4, 2
THRESHOLD = 0.3
DICT_BYTES = 200_000
SEGMENT, DMER = 40, 8
LEVEL = 19
#: Share of the training rows, and most rows of each class, that train the
#: dictionaries; thresholds are calibrated on the others.
DICTIONARY_PCT = 60
MAX_DICTIONARY = (4_000, 800)
#: A kind of window met in fewer training texts takes the ratio of its margin.
LEAST_TEXTS = 5
TOP = 3
#: How much larger a word's share of the texts of a class must be than of the other's.
LEAN = 6
LONGEST_WORD = 16
STRIP = b".,;:!?*#%&$|\"'()"
CARRIER = b"the and of in to "
#: Windows whose lengths a task remembers at once.
REMEMBERED = 300_000

Sample = Sequence[tuple[str, int]]


def windows(text: str | None) -> dict[bytes, None]:
    """The different words of a text in order, in lower case and without punctuation."""
    return dict.fromkeys((text or "").lower().encode("utf-8").translate(None, STRIP).split())


def doubled(raw: bytes) -> bytes:
    """Each byte followed by a fixed image of it."""
    out = bytearray(2 * len(raw))
    out[0::2] = raw
    out[1::2] = raw.translate(IMAGE)
    return bytes(out)


IMAGE = bytes((i * 167 + 91) % 256 for i in range(256))


def train_dictionary(samples: Iterable[bytes]) -> bytes:
    """A trained dictionary, or the samples themselves where they are too few to train on."""
    samples = [doubled(s) for s in samples if len(s) > 16]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples, k=SEGMENT, d=DMER).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:] or doubled(CARRIER)


class Model:
    """Two dictionaries, the windows' log ratios and the logistic curve."""

    def __init__(self, ordinary: bytes, toxic: bytes) -> None:
        self.dictionaries = (ordinary, toxic)
        self.ratios: dict[tuple[int, ...], float] = {}
        self.curve: tuple[float, float] | None = None
        self._work: tuple | None = None

    def _lengths(self, word: bytes) -> tuple[int, int, int]:
        if self._work is None:
            coders = []
            for raw in self.dictionaries:
                d = zstandard.ZstdCompressionDict(raw)
                d.precompute_compress(level=LEVEL)
                c = zstandard.ZstdCompressor(
                    level=LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False
                )
                coders.append((c.compress, len(c.compress(doubled(CARRIER)))))
            self._work = (coders, {})
        coders, known = self._work
        if (got := known.get(word)) is None:
            raw = doubled(CARRIER + word + b" ")
            cost = [len(compress(raw)) - base for compress, base in coders]
            if len(known) >= REMEMBERED:
                known.clear()
            got = (min(len(word), LONGEST_WORD), min(cost[0], 60), min(cost[1], 60))
            if len(word) <= 100:
                known[word] = got
        return got

    def kinds(self, text: str | None) -> list[tuple[int, int, int]]:
        """(word length, ordinary length, toxic length) of each of a text's different windows."""
        return [self._lengths(w) for w in windows(text)]

    def evidence(self, kinds: Iterable[tuple[int, int, int]]) -> float:
        """Sum of the largest log ratios of a text's different windows."""
        get = self.ratios.get
        found = [r if (r := get(k)) is not None else get(margin(k), 0.0) for k in kinds]
        return float(sum(sorted([r for r in found if r > 0], reverse=True)[:TOP]))

    def score(self, text: str | None) -> float:
        if self.curve is None:
            return 0.0
        at = self.curve[0] + self.curve[1] * self.evidence(self.kinds(text))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, at))))


def rebuilt(state: tuple) -> Model:
    model = Model(*state[0])
    model.ratios, model.curve = state[1:]
    return model


def margin(kind: tuple[int, int, int]) -> tuple[int, int]:
    """The coarser kind of a window: its word's length and the difference of its lengths."""
    return kind[0], kind[1] - kind[2]


def dictionaries(parts: dict[int, list[str]]) -> Model:
    """Both dictionaries, each of the words that lean to its class, by how many texts of either hold them."""
    held = {y: Counter(w for t in p for w in windows(t)) for y, p in parts.items()}

    def leans(w: bytes, y: int) -> bool:
        rate = {c: (held[c][w] + 0.5) / (len(parts[c]) + 1) for c in (0, 1)}
        return rate[y] >= LEAN * rate[1 - y] or (y == 0 and not held[1][w])

    made = {y: train_dictionary(b" ".join([w for w in windows(t) if leans(w, y)]) for t in p) for y, p in parts.items()}
    return Model(made[0], made[1])


def fit(sample: Sample) -> Model:
    """A model from (text, toxic 0/1) rows; its curve is missing unless both classes are there."""
    parts = {label: [t for t, y in sample if int(y == 1) == label] for label in (0, 1)}
    if not parts[0] or not parts[1]:
        return Model(b"", b"")
    at = {y: min(len(p) * DICTIONARY_PCT // 100, MAX_DICTIONARY[y]) for y, p in parts.items()}
    trained = {y: p[: at[y]] or p for y, p in parts.items()}
    held = {y: p[at[y] :] or p for y, p in parts.items()}
    model = dictionaries(trained)
    counts = {0: Counter(), 1: Counter()}
    found = []
    for y, p in held.items():
        for kinds in map(model.kinds, p):
            counts[y].update({*kinds, *map(margin, kinds)})
            found.append((y, kinds))
    rate = {y: lambda k, c=counts[y], n=len(held[y]): (c[k] + 0.5) / (n + 1) for y in (0, 1)}
    model.ratios = {
        k: math.log(rate[1](k) / rate[0](k)) for k in {*counts[0], *counts[1]} if counts[0][k] + counts[1][k] >= LEAST_TEXTS
    }
    x = np.array([model.evidence(kinds) for _, kinds in found])
    y = np.array([float(y) for y, _ in found])
    model.curve = logistic(x, y)
    return model


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[float, float]:
    """Intercept and slope of a lightly penalised logistic curve, by Newton's method."""
    w = np.zeros(2)
    design = np.stack([np.ones_like(x), x], axis=1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        ridge = np.array([1e-6, penalty])
        gradient = design.T @ (p - y) + ridge * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(ridge)
        step = np.linalg.solve(hessian, gradient)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return float(w[0]), float(w[1])


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    label_col: str = "toxic",
    text_col: str = "text",
    max_toxic: int = MAX_TOXIC,
    max_ordinary: int = MAX_ORDINARY,
) -> Model:
    """A model from the labelled rows of ``docs`` (a hash sample of the stated sizes)."""
    one = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    one = one.groupBy(F.col(id_col).alias("_id")).agg((F.max(label_col) == 1).cast("int").alias("_y")).persist()
    counts = {r["_y"]: r["count"] for r in one.groupBy("_y").count().collect()}
    chosen = None
    for y, most in ((0, max_ordinary), (1, max_toxic)):
        part = bounded_sample(one.filter(F.col("_y") == y), "_id", most, counts.get(y, 0))
        chosen = part if chosen is None else chosen.unionByName(part)
    rows = (
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
        .filter(F.col("_text").isNotNull())
        .join(F.broadcast(chosen), "_id")  # of the stated size
        .collect()
    )
    one.unpersist()
    rows.sort(key=lambda r: (r["_id"], r["_text"]))
    return fit([(r["_text"], r["_y"]) for r in rows])


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` and ``predicted`` of every row's whole text."""
    state = (model.dictionaries, model.ratios, model.curve)
    shared_model = shared(docs.sparkSession, state, rebuilt)

    def run(texts):
        got = list(map(shared_model().score, texts))
        return {"score": got, "predicted": [int(s >= THRESHOLD) for s in got]}

    out = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return map_texts(docs, run, keep, out, text_col)


def held_out():
    """Rows whose labels are never learned: crc32 of the id as text leaves 2 when divided by 4."""
    return crc_bucket("doc_id", HELD_OUT_MODULUS) == HELD_OUT_REST

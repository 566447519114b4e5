"""Operator 1: language identification by word-first backoff.

A word of the model scores the log frequency it has in each language. A word
the model has not seen falls back to its character n-grams, longest first: the
longest length at which any n-gram is known scores their mean log frequency.
The sum over the text's words, with the languages' prior, decides.

Training counts words in Spark over labelled rows with a letter (a hash sample of
about ``MAX_TRAIN_DOCS`` of them, a documented bound, dealt over the languages
so that rare ones give all their rows), n-grams come from the word counts, and
the model keeps ``MAX_WORDS`` words and ``MAX_GRAMS`` n-grams, the most frequent
of each language, so its broadcast size is bounded. What a language lacks scores
one floor, the same for all languages, however few words it was learned from. Runs of
more than ``LONGEST_LEARNED`` letters, as in languages written without spaces, are
learned in parts of ``PART`` letters, whose n-grams then tell the language.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
or a model without any language. Ties go to the language that sorts first.
Rows with a null language are predicted but never learned from; a language whose
rows have no letter is none of the model's. Repeated rows are predicted alike and each counts in training.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_bucket, map_texts, shared

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TRAIN_DOCS = 20_000
MAX_WORDS = 150_000
MAX_GRAMS = 150_000
LONGEST_GRAM = 5
UNDETERMINED = "und"
HELD_OUT_MODULUS = 5
LETTERS = re.compile(r"[^\W\d_]+")
#: Added to each count, and the log frequency of what a language lacks.
SMOOTH = 0.5
#: Words of at most ``LONGEST_WORD`` characters are remembered, so many at once.
REMEMBERED = 200_000
LONGEST_WORD = 100
#: Longer runs of letters are learned in parts of so many.
LONGEST_LEARNED = 100
PART = 50


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters; empty if the text has no letter."""
    if not text:
        return []
    words = LETTERS.findall(text.lower())
    return words if any(any(c.isalpha() for c in w) for w in words) else []


@dataclass
class Model:
    """Bounded tables of log frequencies: word or n-gram -> one value a language."""

    langs: list[str]
    prior: list[float]
    words: dict[str, list[float]]
    grams: dict[str, list[float]]
    longest: int = LONGEST_GRAM
    _rows: dict[str, int] = field(default_factory=dict, repr=False)
    _scores: np.ndarray | None = field(default=None, repr=False)

    def backoff(self, word: str) -> list[float]:
        padded = f"_{word}_"
        get = self.grams.get
        for n in range(min(self.longest, len(padded)), 0, -1):
            known = [g for i in range(len(padded) - n + 1) if (g := get(padded[i : i + n]))]
            if known:
                return [sum(x) / len(known) for x in zip(*known, strict=True)]
        return [0.0] * len(self.langs)

    def word_scores(self, word: str) -> list[float]:
        return self.words.get(word) or self.backoff(word)

    def _places(self, words: list[str]) -> list[int]:
        """Rows of the words' scores in the table of remembered words."""
        if self._scores is None or len(self._rows) + len(words) > len(self._scores):
            self._rows.clear()
            self._scores = np.zeros((max(REMEMBERED, len(words)), len(self.langs)))
        rows, out = self._rows, []
        for word in words:
            if (at := rows.get(word)) is None:
                at = rows[word] = len(rows)
                self._scores[at] = self.word_scores(word)
            out.append(at)
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNDETERMINED, 0.0
        total = np.array(self.prior)
        if long := [w for w in words if len(w) > LONGEST_WORD]:  # not remembered
            total = total + np.sum([self.word_scores(w) for w in long], axis=0)
            words = [w for w in words if len(w) <= LONGEST_WORD]
        if words:
            total = total + self._scores_of(words)
        best = int(np.argmax(total))
        return self.langs[best], float(1.0 / np.exp(total - total[best]).sum())

    def _scores_of(self, words: list[str]) -> np.ndarray:
        places = self._places(words)
        return self._scores[places].sum(axis=0)


def pieces(word: str) -> list[str]:
    """A run of letters as it is learned: a very long one (text without spaces) in parts, for their n-grams."""
    if len(word) <= LONGEST_LEARNED:
        return [word]
    return [word[i : i + PART] for i in range(0, len(word), PART)]


def word_counts(docs: DataFrame, lang_col: str, text_col: str) -> DataFrame:
    """(lang, word, n) over all rows; counted batch by batch before the shuffle."""

    def run(batches):
        import pyarrow as pa

        for b in batches:
            counts: dict[tuple[str, str], int] = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                counts.update((lang, p) for w in words_of(text) for p in pieces(w))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([k[0] for k in counts], pa.string()),
                    pa.array([k[1] for k in counts], pa.string()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                names=["lang", "word", "n"],
            )

    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "lang string, word string, n bigint").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def gram_counts(words: DataFrame, longest: int = LONGEST_GRAM) -> DataFrame:
    """(lang, gram, n): how many different words of a language hold an n-gram of 1 to ``longest`` characters."""
    padded = F.concat(F.lit("_"), F.col("word"), F.lit("_"))
    grams = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.lit(longest)),
            lambda n: F.when(
                F.length("padded") >= n,
                F.transform(F.sequence(F.lit(1), F.length("padded") - n + 1), lambda i: F.substring("padded", i, n)),
            ).otherwise(F.array().cast("array<string>")),
        )
    )
    return (
        words.withColumn("padded", padded)
        .select("lang", F.explode(F.array_distinct(grams)).alias("gram"))
        .groupBy("lang", "gram")
        .agg(F.count("*").alias("n"))
    )


def shares(sizes: dict[str, int], most: int) -> dict[str, int]:
    """How many of each group's members add up to ``most``: small groups whole, the others alike (one at least)."""
    out, left = {}, most
    for i, x in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[x] = max(1, min(sizes[x], left // (len(sizes) - i)))
        left = max(0, left - out[x])
    return out


def dealt_sample(rows: DataFrame, lang_col: str, id_col: str, text_col: str, per_lang: dict[str, int], max_docs: int) -> DataFrame:
    """A hash sample of about ``max_docs`` rows, dealt over the languages; rows without an id are told apart by their texts."""
    scale = 1_000_000_000
    cut = {x: max(1, scale * k // per_lang[x]) for x, k in shares(per_lang, max_docs).items() if k < per_lang[x]}
    if not cut:
        return rows
    keep = F.create_map(*[F.lit(v) for item in cut.items() for v in item])[F.col(lang_col).cast("string")]
    return rows.filter(F.pmod(F.xxhash64(id_col, text_col), F.lit(scale)) < F.coalesce(keep, F.lit(scale)))


def train(
    docs: DataFrame,
    id_col: str = "doc_id",
    lang_col: str = "lang",
    text_col: str = "text",
    max_docs: int = MAX_TRAIN_DOCS,
    max_words: int = MAX_WORDS,
    max_grams: int = MAX_GRAMS,
) -> Model:
    """A model from the rows with a language (about ``max_docs`` of them)."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).cast("string").rlike(r"\p{L}"))
    per_lang = {r[0]: r[1] for r in rows.groupBy(F.col(lang_col).cast("string")).count().collect()}
    if not per_lang:
        return Model([], [], {}, {})
    words = word_counts(dealt_sample(rows, lang_col, id_col, text_col, per_lang, max_docs), lang_col, text_col).persist()
    totals = {r["lang"]: (r["n"], r["v"]) for r in words.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    langs = sorted(x for x in per_lang if x in totals)
    n = sum(per_lang[x] for x in langs)
    grams = gram_counts(words).persist()
    gram_totals = {r["lang"]: (r["n"], r["v"]) for r in grams.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()}
    model = Model(
        langs,
        [math.log(per_lang[x] / n) for x in langs],
        _table(words, "word", max_words, langs, totals),
        _table(grams, "gram", max_grams, langs, gram_totals),
    )
    grams.unpersist()
    words.unpersist()
    return model


def _table(counts: DataFrame, key: str, most: int, langs: list[str], totals: dict) -> dict[str, list[float]]:
    """``most`` entries (a bound on the model), the most frequent of each language, as log frequencies in all languages."""
    share = shares({x: v for x, (_, v) in totals.items()}, most)
    if any(share[x] < v for x, (_, v) in totals.items()):
        limit = F.create_map(*[F.lit(v) for item in share.items() for v in item])[F.col("lang")]
        place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), key))
        top = counts.withColumn("_place", place).filter(F.col("_place") <= limit).select(key).distinct()
        counts = counts.join(top, key, "left_semi")
    at = {x: i for i, x in enumerate(langs)}
    size = [totals[x][0] + SMOOTH * totals[x][1] for x in langs]
    lacking = [math.log(SMOOTH / max(size))] * len(langs) if langs else []
    out: dict[str, list[float]] = {}
    rows = counts.select("lang", key, "n").toArrow()
    for lang, k, n in zip(*(rows.column(c).to_pylist() for c in ("lang", key, "n")), strict=True):
        out.setdefault(k, list(lacking))[at[lang]] = math.log((n + SMOOTH) / size[at[lang]])
    return out


def identify(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` of every row's whole text."""
    state = (model.langs, model.prior, model.words, model.grams, model.longest)
    shared_model = shared(docs.sparkSession, state, lambda s: Model(*s))

    def run(texts):
        predict = shared_model().predict
        got = [predict(t) for t in texts]
        return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got]}

    out = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return map_texts(docs, run, keep, out, text_col)


def held_out():
    """Rows that are never learned from: crc32 of the id as text divides by 5."""
    return crc_bucket("doc_id", HELD_OUT_MODULUS) == 0

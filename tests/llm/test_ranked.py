"""Operator 12 against a plain evaluation of its formula."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from fieldwise.llm import ranked

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))


def plain(docs, items, top):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    big_n = sum(bool(b) for _, b in bags)
    big_l = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for doc, bag in bags:
            if bag:
                m = 100 - 90 + 90 * bag.total() * big_n // big_l
                w = lambda t: math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                score = sum(w(t) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t in set(terms(text)) if t in bag)
                scores += [(-score, doc is None, doc or 0)] * (score > 0)
        out += [(item, rank, None if lost else doc, -score) for rank, (score, lost, doc) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def tables(spark, seed=1, n=300):
    r = random.Random(seed)
    words = ["Alpha", "beta", "ÄÖ", "äö", "x1", "the", "THE", "naïve", "日本", "a_b", "q"] + [f"w{i}" for i in range(60)]
    text = lambda k: r.choice([" ", "-", ", ", "\x00", "\n"]).join(r.choices(words, weights=[30] * 8 + [5] * (len(words) - 8), k=k))
    docs = [(i, text(r.randint(0, 30))) for i in range(n)] + [(3, text(5)), (None, text(4)), (None, None), (n, ""), (n + 1, "...")]
    docs += [(n + 2 + i, "the same words here") for i in range(30)]
    items = [(i, text(r.randint(1, 9))) for i in range(12)] + [(5, "the same"), (None, "words here"), (90, None), (91, "unseen-term"), (92, "the same words here")]
    return docs, items


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("blocks, sets, known", [(2_048, 256, 1_000_000), (7, 3, 1_000_000), (50, 256, 0)])
def test_scores_are_those_of_the_formula(spark, monkeypatch, blocks, sets, known):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", blocks)
    monkeypatch.setattr(ranked, "SET_ITEMS", sets)
    monkeypatch.setattr(ranked, "MAX_TERMS", known)
    monkeypatch.setattr(ranked, "SALT_BLOCKS", 5)
    docs, items = tables(spark)
    d = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("item", F.lit("x")).withColumn("block", F.lit("x")).withColumn("id", F.lit(1))
    i = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("x")).withColumn("item", F.lit("x"))
    assert got(ranked.search(d.repartition(3), i)) == plain(docs, items, 10)


def test_empty_tables_and_a_long_text(spark):
    held, asked = [(1, " ".join(f"w{i % 50_000}" for i in range(300_000))), (2, "w7")], [("a", "w7 w49999")]
    docs, items = spark.createDataFrame(held, "doc_id bigint, text string"), spark.createDataFrame(asked, "item_id string, text string")
    assert got(ranked.search(docs, items)) == plain(held, asked, 10)
    assert ranked.search(docs.limit(0), items).count() == 0
    assert ranked.search(docs, items.limit(0)).count() == 0
    assert ranked.search(docs.filter("doc_id = 2"), items, top=1).count() == 1

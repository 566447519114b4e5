"""Operator 1: languages with few or no sampled words leave the others alone."""

import math
import random
import re

from fieldwise.llm import langid

COMMON = [f"en{a}{b}" for a in "abcdefgh" for b in "stuvw"]
RARE = ["ñandu", "oseo", "agil", "quiza"]


def rows_of(n, seed=8):
    r = random.Random(seed)
    rows = [(i, " ".join(r.choice(COMMON) for _ in range(30)), "en") for i in range(n)]
    return [*rows, (n, " ".join(RARE * 2), "es"), (n + 1, None, "qq"), (n + 2, "12 34", "pp"), (None, " ".join(RARE), None)]


def test_languages_of_few_or_no_words(spark):
    df = spark.createDataFrame(rows_of(300), "doc_id bigint, text string, lang string")
    fresh = [t for _, t, x in rows_of(50, 9) if x == "en"]
    for most in (langid.MAX_TRAIN_DOCS, 40):
        model = langid.train(df, max_docs=most)
        assert model.langs == ["en", "es"]
        assert {model.predict(t)[0] for t in fresh} == {"en"}
        assert model.predict(" ".join(RARE))[0] == "es"


def test_each_language_keeps_its_most_frequent_words(spark):
    df = spark.createDataFrame(rows_of(300), "doc_id bigint, text string, lang string")
    model = langid.train(df, max_words=8, max_grams=50)
    assert set(RARE) <= set(model.words) and len(model.words) == 8
    assert model.predict(" ".join(RARE))[0] == "es" and model.predict(" ".join(COMMON))[0] == "en"


def test_shares_and_the_sample_of_rows_without_an_id(spark):
    assert langid.shares({"a": 1000, "b": 3, "c": 500}, 100) == {"b": 3, "c": 48, "a": 49}
    rows = [(None, f"text number {i}", "en") for i in range(4000)] + [(1, "uno dos", "es")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = langid.dealt_sample(df, "lang", "doc_id", "text", {"en": 4000, "es": 1}, 401).groupBy("lang").count().collect()
    n = {r["lang"]: r["count"] for r in got}
    assert n["es"] == 1 and 300 < n["en"] < 500


def plain_prediction(model, text):
    """The scorer, word by word, from the model's tables."""
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not words:
        return "und", 0.0
    total = list(model.prior)
    for w in words:
        scores = model.words.get(w)
        padded = f"_{w}_"
        for n in range(min(5, len(padded)), 0, -1) if scores is None else ():
            known = [model.grams[g] for i in range(len(padded) - n + 1) if (g := padded[i : i + n]) in model.grams]
            if known:
                scores = [sum(k) / len(known) for k in zip(*known, strict=True)]
                break
        total = [a + b for a, b in zip(total, scores or [0.0] * len(total), strict=True)]
    best = max(total)
    return model.langs[total.index(best)], 1 / sum(math.exp(x - best) for x in total)


def test_predictions_are_those_of_a_plain_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    model = langid.train(docs.filter(~langid.held_out()))
    got = langid.identify(docs.withColumn("held_out", langid.held_out()), model, ("doc_id", "held_out")).collect()
    text = {r.doc_id: r for r in docs.collect()}
    for r in got:
        want, score = plain_prediction(model, text[r.doc_id].text)
        assert r.lang_pred == want and abs(r.score - score) < 1e-9
    known = [(text[r.doc_id].lang, r.lang_pred) for r in got if r.held_out and text[r.doc_id].lang and r.lang_pred != "und"]
    assert len(known) > 100 and sum(a == b for a, b in known) >= 0.99 * len(known)


def test_a_language_written_without_spaces(spark):
    r = random.Random(4)
    thai = lambda n: "".join(chr(r.randrange(0x0E01, 0x0E2E)) for _ in range(n))
    rows = [(i, " ".join(r.choice(COMMON) for _ in range(20)), "en") for i in range(50)] + [(100 + i, thai(150), "th") for i in range(50)]
    model = langid.train(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert model.langs == ["en", "th"]
    assert model.predict(thai(150))[0] == model.predict(rows[60][1])[0] == "th" and model.predict(rows[0][1])[0] == "en"

"""Operator 9 on rows that it never learned from, and with labels that are wrong here and there."""

import random

from pyspark.sql import functions as F

from fieldwise.llm import queries, toxicity


def test_held_out_rows_of_the_given_tables(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in queries.QUERIES["op9_toxicity"](spark, sf).filter("held_out").select("doc_id", "predicted").collect() if labels.get(r.doc_id) is not None]
    hit = sum(r.predicted == 1 and labels[r.doc_id] == 1 for r in rows)
    said, toxic = sum(r.predicted for r in rows), sum(labels[r.doc_id] for r in rows)
    # about half with some 330 toxic rows to learn from (with 1,600, as in check_s, 0.99 are found)
    assert toxic > 100 and hit >= 0.45 * toxic and said - hit <= 0.03 * (len(rows) - toxic)


def test_wrong_labels_take_no_word_from_the_dictionary(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 8)))
    common, insults = [word() for _ in range(900)], [word() + "zq" for _ in range(12)]
    prose = lambda n: r.choices(common, k=n)

    def text(toxic):
        words = prose(40)
        for _ in range(2 if toxic else 0):
            words.insert(r.randrange(len(words)), r.choice(insults))
        return " ".join(words)

    rows = [(i, text(i % 4 == 0), int(i % 4 == 0)) for i in range(1_200)]
    quoting = [(5_000 + i, " ".join([*prose(40), w]), 0) for i, w in enumerate(insults)]  # each insult in an ordinary text
    wrong = [(6_000 + i, text(False), 1) for i in range(6)]
    df = spark.createDataFrame(rows + quoting + wrong, "doc_id bigint, text string, toxic int")
    model = toxicity.train(df.select("doc_id", "text"), df.select("doc_id", "toxic"))
    fresh = [(i, text(i % 2 == 0)) for i in range(300)]
    got = {x.doc_id: x.predicted for x in toxicity.score(spark.createDataFrame(fresh, "doc_id bigint, text string"), model).collect()}
    assert sum(got[i] == 1 for i in range(0, 300, 2)) >= 140 and sum(got[i] == 1 for i in range(1, 300, 2)) <= 12
    assert toxicity.score(df.limit(0), model).count() == 0 and df.select(F.max("toxic")).first()[0] == 1

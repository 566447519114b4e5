"""Pipeline stages decide by row: null ids and repeated ids are not one document."""

import random
import time

import corpus_pipeline
from fieldwise.llm import jaccard, substring

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def rows_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], SCHEMA)


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def test_decontamination_by_row(spark, tmp_path):
    r = random.Random(11)
    item = prose(r, 30)
    bad, clean, twin = prose(r, 20) + " " + item, prose(r, 40), prose(r, 40)
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = rows_of(spark, [(None, bad), (None, clean), (None, None), (4, bad), (4, twin), (5, clean)])
    out = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert sorted([(x.doc_id, x.text) for x in out.collect()], key=repr) == sorted([(None, clean), (None, None), (4, twin), (5, clean)], key=repr)


def test_near_duplicates_by_row(spark):
    r = random.Random(12)
    near = lambda t: " ".join(["other" if k == 30 else w for k, w in enumerate(t.split())])
    a, b, c, lone = (prose(r, 60) for _ in range(4))
    docs = rows_of(spark, [(None, lone), (None, a), (None, near(a)), (None, a), (7, b), (7, near(b)), (7, c), (3, near(c)), (None, None), (8, "")])
    got = [(x.doc_id, x.text) for x in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(got) == len(set(got)) == 6
    assert {(None, lone), (3, near(c)), (None, None), (8, "")} < set(got)
    assert sum(t in (a, near(a)) for _, t in got) == sum(t in (b, near(b)) for _, t in got) == 1


def test_texts_without_an_id_meet_their_own_sets_only(spark):
    r = random.Random(13)
    docs = rows_of(spark, [(None, prose(r, 12)) for _ in range(50)])
    key = docs.select(jaccard.row_key("doc_id", "text").alias("row")).distinct()
    holders = key.select("row", jaccard.F.col("row").alias("key"))
    places = holders.select("key", jaccard.F.lit(1).alias("cell"))
    assert jaccard._with_texts(docs, places, holders, "doc_id", "text").count() == 50


def test_substring_dedup_of_many_rows_without_an_id(spark):
    """They take no longer than rows with ids, and only a row with an id takes words from them."""
    r = random.Random(14)
    shared, took = prose(r, 60), []
    texts = [prose(r, 20) + " " + shared + " " + prose(r, 20) for _ in range(3_000)]
    for ids in (range(len(texts)), [None] * len(texts)):
        docs = rows_of(spark, [*zip(ids, texts, strict=True), (-1, shared), (None, texts[7]), (None, texts[7])])
        began = time.perf_counter()
        got = substring.digests(docs).collect()
        took.append(time.perf_counter() - began)
        # (a neighbouring word may be equal by chance)
        assert len(got) == len(texts) + 3 and all(60 <= x.n_removed < 64 or x.n_removed == 100 for x in got if x.doc_id != -1)
        assert sum(x.n_removed == 100 for x in got) == (2 if ids[0] == 0 else 0)
    assert took[1] < 3 * took[0] + 10


def test_texts_of_one_id_keep_their_own_windows(spark):
    r = random.Random(15)
    a, b = prose(r, 60), prose(r, 70)
    got = {(x.doc_id, x.n_words): x.n_removed for x in substring.digests(rows_of(spark, [(1, a), (2, a + " x"), (2, b), (3, b), (2, b)])).collect()}
    assert got == {(1, 60): 0, (2, 61): 60, (2, 70): 0, (3, 70): 70}

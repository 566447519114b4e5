"""The pipeline and the registered queries over the smallest driver tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldwise.llm import queries, repetition
from fieldwise.llm.common import documents

SMALL = "/root/testdata/sf0.001"
TABLES = ("documents", "pages", "benchmark", "labels", "embeddings", "conversations")


def normal(v):
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, duck, name):
    df = queries.QUERIES[name](spark, SMALL)
    cols = sorted(df.columns)
    mine = sorted(tuple(normal(r[c]) for c in cols) for r in df.collect())
    got = duck.sql(queries.SQL[name])
    at = [got.columns.index(c) for c in cols]
    assert sorted(got.columns) == cols
    assert mine == sorted(tuple(normal(x[i]) for i in at) for x in got.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_stages_keep_the_columns_of_documents(spark):
    docs = documents(spark, SMALL)
    kept = {r.doc_id for r in repetition.judge(docs).filter("kept").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and (name != "quality_rules" or set(ids) == kept)


def test_stages_take_odd_rows_and_clashing_columns(spark, odd):
    df = odd("a clean text of some length " + " ".join(f"w{i}" for i in range(40))).withColumn("n_words", F.lit(1))
    for c in ("_row", "_pii_found", "_pii_base", "_measures", "_bit"):
        df = df.withColumn(c, F.lit("mine"))
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.limit(0)):
            out = stage(spark, docs, SMALL)
            assert name == "encoding" or out.columns == docs.columns
            assert out.count() <= docs.count()
            assert name == "encoding" or out.filter("_row <> 'mine' or _pii_found <> 'mine' or _measures <> 'mine'").isEmpty()


def test_the_pipeline_on_planted_rows(spark, tmp_path):
    import random

    r = random.Random(3)
    prose = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    item, first = prose(30), prose(60)
    twice, alone = prose(60), prose(50)
    near = first.split()
    near[30] = "other"
    rows = [
        (1, first, "en", "s", 1),
        (2, first, "en", "s", 1),  # exact copy
        (3, " ".join(near), "en", "s", 1),  # near copy
        (4, prose(20) + " " + item + " " + prose(20), "en", "s", 1),  # benchmark passage
        (5, "again and again " * 30, "en", "s", 1),  # repetition
        (6, prose(40) + " write to ann@example.org today", "en", "s", 1),
        (7, prose(40), None, None, None),
        (8, None, "en", "s", None),
        (9, "", "en", "s", 0),
        (7, prose(40), "en", "s", 1),  # an id that repeats with another text
        *[(10, twice, "en", "s", 1)] * 3,  # a row that occurs three times
        *[(None, twice + " end", "en", "s", 1)] * 2,  # near it, without an id
        *[(None, alone, "en", "s", 1)] * 2,
    ]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in out), key=lambda i: i or 0) == [None, 1, 6, 7, 7, 10] and all(r.n_tokens > 0 for r in out)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "ngram_jaccard", "decontamination", "pii", "encoding",
    ]

"""Operator 13 against brute force: exact where all vectors are searched, recall where not."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldwise.llm import nearest

SCHEMA = "vec_id bigint, embedding array<double>"


def brute(rows, k=5):
    """[(query_id, rank, vec_id, score)] over all rows, the row itself apart."""
    sound = [(i, np.array(v, float)) for i, v in rows if v is not None and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = []
    for a, (q, v) in enumerate(sound):
        if q is None or q % 50:
            continue
        scores = []
        for b, (i, w) in enumerate(sound):
            if a != b:
                dot, x, y = 0.0, 0.0, 0.0
                for s, t in zip(v.tolist(), w.tolist(), strict=True):
                    dot, x, y = dot + s * t, x + s * s, y + t * t
                scores.append((-max(-1.0, min(1.0, dot / math.sqrt(x * y))), i is None, i or 0))
        out += [(q, rank, None if lost else i, -s) for rank, (s, lost, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def is_query():
    return F.col("vec_id") % 50 == 0


def test_small_tables_are_searched_whole(spark):
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=7).tolist()) for i in range(260)]
    same = rows[17][1]
    rows += [(1000 + i, same) for i in range(20)] + [(50, same), (50, same), (None, same), (2000, [2 * x for x in same])]
    rows += [(3000, None), (3050, [0.0] * 7), (3100, [1.0] * 6 + [None]), (3150, [math.nan] + [1.0] * 6), (3200, [math.inf] * 7), (3250, []), (3300, [1.0, 2.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("x")).withColumn("cell", F.lit(1)).withColumn("score", F.lit(1))
    assert got(nearest.search(df, is_query())) == brute([x for x in rows if x[0] != 3300])


@pytest.mark.parametrize("group, block", [(2_048, 4_096), (16, 2)])
def test_a_hot_vector_and_small_groups(spark, monkeypatch, group, block):
    monkeypatch.setattr(nearest, "GROUP_ROWS", group)
    monkeypatch.setattr(nearest, "QUERY_ROWS", block)
    r = np.random.default_rng(8)
    near = r.normal(size=9)
    rows = [(i, (near if i % 3 == 0 else near + 0.01 * r.normal(size=9) if i % 3 == 1 else r.normal(size=9)).tolist()) for i in range(700)]
    assert got(nearest.search(spark.createDataFrame(rows, SCHEMA).repartition(3), is_query())) == brute(rows)


def test_few_candidates_and_empty_tables(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [0.0, -1.0])], SCHEMA)
    assert [(r.query_id, r.rank, r.vec_id) for r in nearest.search(df, is_query()).orderBy("rank").collect()] == [(0, 1, 1), (0, 2, 2)]
    assert nearest.search(df.limit(0), is_query()).count() == 0 and nearest.search(df.filter("vec_id = 0"), is_query()).count() == 0
    assert nearest.search(df, F.lit(False)).count() == 0


@pytest.mark.parametrize("clusters", [0, 40])
def test_recall_beyond_the_least_taken(spark, clusters):
    r = np.random.default_rng(2)
    centres = r.normal(size=(max(1, clusters), 24))
    x = r.normal(size=(12_000, 24)) * (0.3 if clusters else 1) + (centres[r.integers(0, clusters, 12_000)] if clusters else 0)
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], SCHEMA)
    found = {(q, v) for q, _, v, _ in got(nearest.search(df, is_query()))}
    units = x / np.linalg.norm(x, axis=1)[:, None]
    scores = units[::50] @ units.T
    scores[np.arange(len(scores)), np.arange(0, len(x), 50)] = -2
    true = {(50 * i, int(j)) for i, row in enumerate(np.argsort(-scores, axis=1)[:, :5]) for j in row}
    assert len(found) == len(true) and len(found & true) >= 0.93 * len(true)
    assert nearest.fit(units, len(units)).share < (0.15 if clusters else 0.8)


def test_cells_come_by_summed_distance():
    r = np.random.default_rng(1)
    a, b, held = r.random(6), r.random(6), r.integers(0, 3, 36)
    order = np.argsort((a[:, None] + b[None, :]).ravel())
    want, total = [], 0
    for c in order:
        if total >= 20:
            break
        if held[c]:
            want.append(c)
            total += held[c]
    assert nearest.taken(a, b, held, 20).tolist() == sorted(want)

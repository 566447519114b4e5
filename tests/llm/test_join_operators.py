"""Operators 4 and 6 against brute force on small fixtures with skewed, repeated and odd rows."""

import collections
import hashlib
import random

import pytest

from fieldwise.llm import jaccard, substring
from fieldwise.llm.components import components

NO_ID = substring.NO_ID


def shingles(text):
    w = tuple((text or "").encode().lower().split())
    return {w[i : i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else ({w} if w else set())


def classes_by_brute_force(rows):
    sets = [(NO_ID if i is None else i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for j, (_, x) in enumerate(sets):
        for k in range(j):
            y = sets[k][1]
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                parent[root(j)] = root(k)
    least = {}
    for j, (i, _) in enumerate(sets):
        least[root(j)] = min(least.get(root(j), NO_ID), i)
    out = [(rows[j][0], len(x), None if least[root(j)] == NO_ID else least[root(j)]) for j, (_, x) in enumerate(sets)]
    return sorted(out, key=repr)


def near_copies(seed):
    r = random.Random(seed)
    rows = []
    for _ in range(10):
        base = [r.choice("abcdefghijklmnop") + r.choice("xyz") for _ in range(r.choice([1, 3, 4, 5, 6, 30, 60]))]
        for _ in range(r.randrange(1, 14)):
            w = list(base)
            for _ in range(r.randrange(4)):
                a = r.randrange(len(w) + 1)
                w[a : a + r.randrange(2)] = [r.choice("abcdefg") for _ in range(r.randrange(3))]
            rows.append((r.choice([len(rows)] * 8 + [3, None]), r.choice([" ".join(w).upper(), " ".join(w), " \n".join(w)])))
    rows += [(1000, None), (1001, ""), (1002, " ")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [3, 1200])
def test_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_copies(block)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted([tuple(x) for x in jaccard.classes(df).collect()], key=repr) == classes_by_brute_force(rows)


def test_a_search_finds_all_links_of_a_cell():
    r = random.Random(9)
    for _ in range(40):
        sets = []
        for _ in range(12):
            base = r.sample(range(400), r.randrange(1, 60))
            sets += [set(r.sample(base, max(1, len(base) - r.randrange(4)))) for _ in range(r.randrange(1, 4))]
        import numpy as np

        arrays = [np.array(sorted(s), np.uint64) for s in sets]
        for centre in (None, 0):
            roots, _ = jaccard.cell_links(arrays, centre)
            parent = list(range(len(sets)))

            def root(x, parent=parent):
                while parent[x] != x:
                    x = parent[x]
                return x

            for i, a in enumerate(sets):
                for j in range(i):
                    if 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                        x, y = sorted((root(i), root(j)))
                        parent[y] = x
            assert roots == [root(i) for i in range(len(sets))]


def test_classes_of_odd_rows(odd, empty):
    rows = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.classes(odd("a lone row without an id")).collect()}
    assert (1, 0, 1) in rows and (2, 0, 2) in rows and (5, 1, 5) in rows
    assert (None, 2, 100) in rows and (100, 2, 100) in rows
    assert jaccard.classes(empty).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}


def dedup_by_brute_force(rows, size):
    least = {}
    for i, t in rows:
        w = (t or "").split()
        for k in range(len(w) - size + 1):
            g = tuple(w[k : k + size])
            least[g] = min(least.get(g, NO_ID), NO_ID if i is None else i)
    out = []
    for i, t in rows:
        w, gone = (t or "").split(), set()
        for k in range(len(w) - size + 1):
            if least[tuple(w[k : k + size])] < (NO_ID if i is None else i):
                gone.update(range(k, k + size))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size", [6, 7])
def test_removed_windows_equal_brute_force(spark, monkeypatch, size):
    monkeypatch.setattr(substring, "CHUNK_WORDS", 100)
    r = random.Random(size)
    pool = [[r.choice("abcdefgh") for _ in range(40)] for _ in range(5)]
    rows = []
    for i in range(60):
        w = []
        for _ in range(r.randrange(4)):
            a = r.randrange(30)
            w += r.choice(pool)[a : a + r.randrange(3, 25)] if r.random() < 0.6 else [r.choice("abcdefgh") for _ in range(r.randrange(1, 12))]
        rows.append((r.choice([i, i, i, 3, None]), " ".join(w) if w else r.choice([None, "", " \n"])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    want = dedup_by_brute_force(rows, size)
    assert sorted([tuple(x) for x in substring.digests(df, window=size).collect()], key=repr) == [w[:4] for w in want]
    kept = collections.Counter((r.doc_id, r.text) for r in substring.dedup(df, window=size).collect())
    assert kept == collections.Counter((w[0], w[4]) for w in want)


def met_runs(texts, window=50):
    """The removed runs of one bucket in which each (id, words) is a chunk of its own."""
    import pandas as pd

    known, powers = substring.WordHash(), substring.Powers()
    rows = [r for i, w in texts for r in substring.pack([[x.encode() for x in w]], [i], window, 1, known, powers)]
    met = substring.meet(pd.DataFrame(rows, columns=[c.split()[0] for c in substring.PACKED.split(", ")]))
    return {(i, a + k) for i, a, n in zip(met["id"].tolist(), met["first"].tolist(), met["count"].tolist(), strict=True) for k in range(n)}


@pytest.mark.parametrize("period", [1, 20, 26])
def test_runs_of_a_long_periodic_text_leave_the_bucket_whole(period):
    periodic = [f"r{i % period}" for i in range(70_000)]
    passage = [f"p{i}" for i in range(120)]
    texts = [(1, periodic), (2, passage), (3, ["x", *passage, "y"]), (4, ["z", *periodic[:100]])]
    assert met_runs(texts) == {(3, 1 + k) for k in range(71)} | {(4, 1 + k) for k in range(51)}


@pytest.mark.parametrize("bits", [0xFFFFFFFF, 0xFFFFFFFF << 32])
def test_windows_around_one_passage_differ_by_all_bits_of_their_hashes(monkeypatch, bits):
    import numpy as np

    whole = substring.window_table
    half = lambda *a: (t := whole(*a)) | {"full": t["full"] & np.uint64(bits)}
    monkeypatch.setattr(substring, "window_table", half)
    shared = [f"s{i}" for i in range(30)]
    texts = [(d, [f"a{d}.{i}" for i in range(30)] + shared + [f"b{d}.{i}" for i in range(30)]) for d in range(40)]
    assert met_runs(texts) == set()  # one representative, no window that repeats


def test_substring_dedup_of_odd_rows(odd, empty):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = {r.doc_id: r for r in substring.digests(odd(passage, "x " + passage)).collect()}
    assert rows[100].n_removed == 0 and rows[101].n_removed == 60
    assert rows[1].n_words == 0 and rows[2].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert substring.digests(empty).count() == 0
    df = odd(passage, "x " + passage)
    kept = substring.dedup(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    assert {r.text for r in kept.filter("doc_id in (101, 5)").collect()} == {"x", "twice"}

"""Operator 10: every overlap that the rule allows has a seed, by enumeration."""

import itertools

import numpy as np
import pytest

from fieldwise.llm import spaced


@pytest.mark.parametrize("n", range(8, 26))
def test_every_allowed_overlap_has_a_whole_mask(n):
    most = int(n * (1 - spaced.MIN_SAME) + 1e-9)
    changed = np.array([sum(1 << i for i in c) for c in itertools.combinations(range(n), most)], np.int64)
    hit = np.zeros(len(changed), bool)
    for mask in spaced.masks_for(n):
        bits = sum(1 << i for i, c in enumerate(mask) if c == "x")
        for at in range(n - len(mask) + 1):
            hit |= (changed & (bits << at)) == 0
    assert hit.all()


def test_overlaps_with_substitutions_at_any_place(spark):
    items, docs = [], []
    for n in (8, 10, 12, 13):
        item = [f"i{n}x{j}" for j in range(n)]
        items.append((n, " ".join(item)))
        for c in itertools.combinations(range(n), int(n * 0.2 + 1e-9)):
            text = [f"a{n}x{j}" for j in range(9)] + [w if j not in c else "other" for j, w in enumerate(item)] + ["z", "end"]
            docs.append((len(docs) + 1000 * n, " ".join(text)))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = spaced.overlaps(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    assert sorted(r.doc for r in found) == sorted(i for i, _ in docs) and all(r.item == r.doc // 1000 for r in found)

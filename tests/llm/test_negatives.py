"""Hard negatives against plain Python, which scores every pair."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from cases import collected
from pyspark.sql import functions as F

from roadstream.llm import negatives
from roadstream.llm.negatives import Best, Rows, hard_negatives, spanning_tree, visit

SCHEMA = "vec_id long, embedding array<double>, label int, key string, copies int, rank int"
COLUMNS = (
    "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
)


def brute_force(rows, every=10, positives=5, negatives=3):
    def whole(x):
        return math.floor(x) * 256 if abs(x) > 2**60 else math.floor(256 * x)

    held = [
        (i, [whole(x) for x in v], label)
        for i, v, label in rows
        if i is not None and label is not None and v is not None
        and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for at, (i, v, label) in enumerate(held):
        if i % every:
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w, strict=True)), j, other == label)
            for n, (j, w, other) in enumerate(held)
            if n != at and len(w) == len(v)
        ]
        scored.sort()
        for minus, positive, _ in [s for s in scored if s[2]][:positives]:
            inside = [
                (j, -m) for m, j, same in scored if not same and -50 * minus <= -100 * m <= -95 * minus
            ]
            for rank, (j, score) in enumerate(inside[:negatives], 1):
                shown = [x if abs(x) < 2**63 - 1 else None for x in (-minus, score)]
                out.append((i, positive, rank, j, *shown))
    return sorted(out, key=repr)


def check(spark, rows, **options):
    vectors = spark.createDataFrame([(*r, "x", 7, 7) for r in rows], SCHEMA)
    found = hard_negatives(vectors.repartition(3), F.col("vec_id") % 10 == 0, **options)
    expected = brute_force(rows)
    assert collected(found, *COLUMNS) == expected
    return expected


def some_rows(n, width, seed=3, step=1 / 16):
    chance = random.Random(seed)
    middles = [[chance.gauss(0, 1) for _ in range(width)] for _ in range(4)]
    return [
        (i, [round((m + chance.gauss(0, 0.4)) / step) * step for m in middles[i % 4]], chance.choice([0, 0, 1, 2]))
        for i in range(n)
    ]


@pytest.mark.parametrize("small", [False, True])
def test_against_plain_python(spark, small, monkeypatch):
    rows = some_rows(300, 8) + some_rows(40, 8, seed=4)  # ids stand for two rows
    rows += [(500 + i, [0.5] * 8, i % 2) for i in range(60)]  # ties, anchors among them
    rows += [(700, [0.25] * 8, 1)] * 7 + [(701, [0.5] * 8, 0)] * 9  # copies of whole rows
    rows += [(None, [1.0] * 8, 0), (3, None, 1), (4, [1.0] * 8, None), (10, [None] * 8, 0)]
    rows += [(20, [math.nan] * 8, 0), (30, [math.inf] * 8, 1), (40, [], 0), (50, [1.0], 0)]
    rows += [(60, [-1.0] * 8, 3), (70, [0.0] * 8, 4), (80, [0.0] * 8, 4)]
    options = {"tree_rows": 7, "shard_rows": 50} if small else {}
    assert len(check(spark, rows, **options)) > 100


def test_components_of_any_size(spark):
    rows = some_rows(80, 4)
    rows += [(200 + i, [1e20 * (1 + i % 7), 3.0, 1e19, 0.5], i % 2) for i in range(20)]
    rows += [(300 + 5 * i, [-1e150, 1e150 * i, 1e3, 2.0**45], i % 2) for i in range(8)]
    check(spark, rows)


def test_one_label_few_and_none(spark):
    assert check(spark, [(i, [1.0 * i], 0) for i in range(30)]) == []
    assert check(spark, [(0, [1.0], 0)]) == []
    assert check(spark, []) == []
    assert check(spark, [(i, [1.0], i) for i in range(30)]) == []  # no label twice
    assert check(spark, [(i, [1.0 + i], i % 2) for i in range(5)])


def test_order_of_scores():
    scores = sorted([0, 5, -5, 2**63 - 1, 2**63, -(2**63), 1 - 2**63, 10**40, -(10**40), 10**39, -7 * 10**40])
    assert sorted(map(negatives.sortable, scores)) == [negatives.sortable(x) for x in scores]


def test_tree_passes_over_most_candidates():
    chance = np.random.default_rng(1)
    middles = chance.normal(0, 40, (5, 16))

    def rows(n):
        kind = np.sort(chance.integers(0, 5, n))
        vectors = np.round(middles[kind] + chance.normal(0, 1, (n, 16)))
        return Rows(np.arange(n), kind, np.arange(n), np.ones(n, dtype=int), vectors)

    anchors, candidates = rows(64), rows(4000)
    anchors.keys[:] = -1
    tree = spanning_tree(anchors.vectors)
    assert sorted(tree.order) == [*range(64)]
    assert all(tree.parent[i] in tree.order[:n] for n, i in enumerate(tree.order) if n)
    best = [Best([(-np.inf, np.inf)], 5) for _ in range(64)]
    scored = visit(anchors, tree, candidates, best, True)
    assert scored < 0.5 * 64 * 4000
    full = anchors.vectors @ candidates.vectors.T
    for i, found in enumerate(best):
        mine = full[i][candidates.labels == anchors.labels[i]]
        assert [s for s, _, _ in found.held[0]] == sorted(mine, reverse=True)[:5]

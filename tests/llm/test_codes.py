"""Product codes against plain Python, which compares every part with every entry."""

from __future__ import annotations

import math
import random

import numpy as np
from cases import collected
from hypothesis import given, settings
from hypothesis import strategies as st

from roadstream.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, code string, vector int, tally string"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "x") for r in rows], SCHEMA)


def brute_force(rows, parts=4, entries=256, rounds=4):
    kept = [
        (i, [math.floor(x) * 1024 if abs(x) > 2**60 else math.floor(1024 * x) for x in v], label)
        for i, v, label in rows
        if v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    spans = codes.cuts(len(kept[0][1]), parts)
    books = [[tuple(v[b:e]) for _, v, _ in kept[:entries]] for b, e in spans]

    def assigned():
        out = []
        for _, v, _ in kept:
            row = []
            for (b, e), book in zip(spans, books, strict=True):
                gaps = [sum((x - y) ** 2 for x, y in zip(v[b:e], c, strict=True)) for c in book]
                row.append((min(gaps), gaps.index(min(gaps))))
            out.append(row)
        return out

    for _ in range(rounds):
        now = assigned()
        for p, (b, e) in enumerate(spans):
            for c in range(len(books[p])):
                mine = [v[b:e] for (_, v, _), row in zip(kept, now, strict=True) if row[p][1] == c]
                if mine:
                    books[p][c] = tuple(sum(col) // len(mine) for col in zip(*mine, strict=True))
    result = []
    for (i, _, label), row in zip(kept, assigned(), strict=True):
        error = sum(gap for gap, _ in row)
        result.append((i, label, "".join(f"{c:02x}" for _, c in row), error if error < 2**63 else None))
    return sorted(result, key=repr), [[list(c) for c in book] for book in books]


def check(spark, rows, **options):
    made = codes.compress(table(spark, rows).repartition(3), **options)
    expected, books = brute_force(rows, **options)
    assert collected(made.rows, "vec_id", "label", "code", "error") == expected
    assert [b.tolist() for b in made.books] == books


def some_rows(n, width, step, seed=5):
    chance = random.Random(seed)
    return [
        (i, [round(chance.gauss(0, 1) / step) * step for _ in range(width)], chance.choice([0, 1, None]))
        for i in range(n)
    ]


def test_against_plain_python(spark):
    rows = some_rows(400, 8, 0.01)
    rows += [(i, [0.25, -0.25] * 4, 1) for i in range(1000, 1150)]  # copies of one vector
    rows += [(5, [1.0] * 8, 0), (5, [1.0] * 8, 0), (5, [2.0] * 8, None), (None, [-1.5] * 8, 2)]
    rows += [(2, None, 0), (3, [None] * 8, 0), (4, [math.nan] * 8, 0), (6, [math.inf] * 8, 1)]
    check(spark, rows, entries=16)
    check(spark, rows[::4])  # all 256 entries, most of them with a part or two


def test_ties_on_a_coarse_grid(spark):
    check(spark, some_rows(300, 4, 1.0), entries=8, rounds=6)


def test_widths(spark):
    check(spark, some_rows(40, 6, 0.1), entries=5)  # parts of one and two components
    check(spark, some_rows(40, 3, 0.1), entries=5)  # a part of none
    check(spark, some_rows(40, 4, 0.1) + [(90, [1.0], 0), (91, [], 0)], entries=5)
    check(spark, [(i, [], 0) for i in range(3)])


def test_components_of_any_size(spark):
    rows = some_rows(60, 4, 0.1) + [(200 + i, [3e30 * i, -1e20, 1.7e308, 2.0**40], 1) for i in range(5)]
    check(spark, rows, entries=9)


def test_few_and_none(spark):
    made = codes.compress(table(spark, []))
    assert made.rows.count() == 0 and made.books == []
    check(spark, some_rows(1, 8, 0.1))


def test_no_rounds(spark):
    check(spark, some_rows(30, 4, 0.1), entries=4, rounds=0)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_reassigned_is_nearest(seed):
    chance = np.random.default_rng(seed)
    parts = chance.integers(-3, 4, (40, 2)).astype(float)
    old = chance.integers(-3, 4, (7, 2)).astype(float)
    new = old.copy()
    moved = chance.random(7) < 0.4
    new[moved] = chance.integers(-3, 4, (moved.sum(), 2))
    index, distance = codes.nearest(parts, old)
    for stored in (distance, np.where(chance.random(40) < 0.2, codes.UNSTORED, distance)):
        found = codes.reassigned(parts, new, moved, index, stored)
        for a, b in zip(found, codes.nearest(parts, new), strict=True):
            assert (a == b).all()


@given(st.lists(st.integers(-(2**200), 2**200)))
def test_limbs_add_up(values):
    total = [0] * len(values)
    for cell, limb, value in zip(*codes.limbs(np.array([*values, 0], dtype=object)[:-1]), strict=True):
        assert abs(int(value)) < 2**codes.LIMB
        total[cell] += int(value) << (codes.LIMB * int(limb))
    assert total == values

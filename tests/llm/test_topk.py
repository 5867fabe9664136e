from __future__ import annotations

import math
import struct
from fractions import Fraction

from cases import collected

from roadstream.llm.topk import top_k


def brute_force(rows, asked, k=10):
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    def whole(v):
        return [math.floor(1024 * Fraction(x)) for x in v]

    held = [(i, whole(v)) for i, v in rows if i is not None and usable(v)]
    out = []
    for own, (q, v) in enumerate(held):
        if q in asked:
            scores = sorted(
                (-sum(a * b for a, b in zip(v, w, strict=True)), i)
                for row, (i, w) in enumerate(held)
                if row != own and len(w) == len(v)
            )
            out += [
                (q, n + 1, i, -s if abs(s) < (1 << 63) - 1 else None)
                for n, (s, i) in enumerate(scores[:k])
            ]
    return sorted(out, key=repr)


def test_against_brute_force(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [((i * 37 + d * 11) % 23 - 11) / 8.0 for d in range(20)]) for i in range(300)]
    rows += [(500 + i, [0.5] * 20) for i in range(30)]  # ties
    rows += [(900, None), (901, [None] * 20), (902, [nan] * 20), (903, [inf] * 20), (904, [])]
    rows += [(None, [1.0] * 20), (100000, [1.0, 2.0]), (100001, [1.0, -2.0]), (200000, [3.0] * 7)]
    rows += [(800, [500.0] * 20)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = vectors.where("vec_id % 100 = 0")
    expected = brute_force(rows, {i for i, _ in rows if i is not None and i % 100 == 0})
    for block in (4096, 16):
        found = top_k(vectors, asked, block=block, query_block=3)
        assert collected(found, "query_id", "rank", "vec_id", "score") == expected


def test_few_and_none(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(empty, empty).count() == 0
    one = spark.createDataFrame([(0, [1.0])], "vec_id long, embedding array<float>")
    assert top_k(one, one).count() == 0


def held_against_brute_force(spark, rows, kind="double", **options):
    vectors = spark.createDataFrame(
        [(i, v, 1, "x", 2) for i, v in rows],
        f"vec_id long, embedding array<{kind}>, rank int, key string, score long",
    )
    found = top_k(vectors, vectors.where("vec_id % 100 = 0"), **options)
    expected = brute_force(rows, {i for i, _ in rows if i is not None and i % 100 == 0})
    assert collected(found, "query_id", "rank", "vec_id", "score") == expected


def test_repeated_ids_and_rows(spark):
    rows = [(i % 7 * 50, [((i * 5 + d) % 9 - 4) / 4.0 for d in range(12)]) for i in range(80)]
    rows += [(100, [0.25] * 12)] * 30 + [(300, [2.0] * 12), (300, [2.0] * 12), (3, [2.0] * 12)]
    rows += [(0, []), (1, []), (0, [])]
    held_against_brute_force(spark, rows, block=8, query_block=3, shard_components=200)
    held_against_brute_force(spark, rows)


def test_components_of_any_size(spark):
    rows = [(i, [((i * 13 + d * 7) % 17 - 8) / 4.0 for d in range(10)]) for i in range(120)]
    rows += [(200 + i, [3e5 + i, -4e5, *[0.5] * 8]) for i in range(5)]  # beyond doubles
    rows += [(300 + i, [3e9 + i, -1.0, *[0.5] * 8]) for i in range(5)]  # beyond 64 bits
    rows += [(400 + i, [-1e200, 1e150 * i, *[0.0] * 8]) for i in range(5)]
    rows += [(500, [1.7e308] * 10), (501, [-1.7e308] * 10), (600, [-0.0] * 10)]
    held_against_brute_force(spark, rows, block=16, query_block=2, shard_components=300)
    narrow = [(i, [struct.unpack("f", struct.pack("f", x))[0] for x in v]) for i, v in rows[:130]]
    held_against_brute_force(spark, narrow, kind="float")

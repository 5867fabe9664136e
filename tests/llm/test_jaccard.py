from __future__ import annotations

import math
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from cases import SMALL, collected, documents, jaccard, shingle_set
from pyspark.sql import GroupedData

from roadstream.llm import jaccard as join
from roadstream.llm.components import components
from roadstream.llm.queries import op2_ngram_jaccard_join


def brute_force(rows, threshold=0.8):
    """{position: (class id, links)} of (doc_id, text) rows."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a, b in combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= threshold:
            links[a] += 1
            links[b] += 1
            root[find(b)] = find(a)
    least = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        least[find(i)].append(doc_id)
    first = {k: min((x for x in v if x is not None), default=None) for k, v in least.items()}
    return [(rows[i][0], first[find(i)], links[i]) for i in range(len(rows))]


def awkward_rows():
    rng = random.Random(3)

    def prose(n):
        return [f"w{rng.randrange(400)}" for _ in range(n)]

    def edited(words, n):
        words = list(words)
        for i in rng.sample(range(len(words)), n):
            words[i] = f"e{rng.randrange(9999)}"
        return words

    rows = [" ".join(prose(60)) for _ in range(6)]
    for _ in range(3):
        base = prose(120)
        rows += [" ".join(base)] * 2 + [" ".join(edited(base, n)) for n in (1, 1, 2, 2, 3, 4, 6)]
    rows += [None, "", "  \n", "one", "ONE", "one two three", "one  two\tthree", "one two four"]
    # Exactly four fifths of the shingles are shared: 8 of 10.
    shared = [f"s{i}" for i in range(12)]
    rows += [" ".join(shared + ["p"]), " ".join(shared + ["q"])]
    return [(None if i == 3 else i, t) for i, t in enumerate(rows)]


@pytest.mark.parametrize("block", [256, 3])
def test_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(join, "BLOCK", block)
    rows = awkward_rows()
    found = join.similar_classes(documents(spark, rows))
    assert collected(found, "doc_id", "class_id", "n_links") == sorted(brute_force(rows), key=repr)


def test_query_against_brute_force(spark):
    rows = [
        (r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    ]
    found = op2_ngram_jaccard_join(spark, SMALL)
    assert collected(found, "doc_id", "class_id", "n_links") == sorted(brute_force(rows), key=repr)


def test_one_of_each_class_stays(spark):
    rows = [(4, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (9, ""), (8, None)]
    docs = documents(spark, rows)
    left = join.one_of_each_class(docs)
    assert left.columns == docs.columns
    assert collected(left, "doc_id", "text") == [(2, "a b c d e f g"), (8, None), (9, "")]


def test_empty_table(spark):
    docs = documents(spark, [])
    assert join.similar_classes(docs).count() == 0
    assert join.one_of_each_class(docs).count() == 0


def test_looks_drop_the_unlikely_only():
    least = join.least_matches(0.8, 1e-7)
    assert list(least) == sorted(least)
    for n, m in zip(join.LOOKS, least, strict=True):
        assert m < 0.8 * n
        p = 0.8 + 0.2 / 256  # a true pair rarely has fewer matches than the look asks for
        assert sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(m)) < 1e-6
    values = np.zeros((2, join.HASHES), dtype=np.uint8)
    values[1, ::2] = 1  # half of the values match
    pairs = np.array([[0, 0], [0, 1]])
    assert join.survivors(values, values, pairs, 0.8, 1e-7).tolist() == [[0, 0]]


def test_components(spark):
    edges = [(1, 2), (2, 3), (3, 4), (9, 4), (7, 8), (8, 7), (5, 5), (None, 1), (20, 19), (19, 18)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    assert collected(found, "node", "root") == [
        (1, 1), (18, 18), (19, 18), (2, 1), (20, 18), (3, 1), (4, 1), (5, 5), (7, 7), (8, 7), (9, 1)
    ]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_large_group_is_dealt_to_many_tasks(spark, monkeypatch):
    """However large the group of near copies, a call has a few pairs of blocks, not the group."""
    monkeypatch.setattr(join, "BLOCK", 16)
    limits = {"ROWS_A_SHARD": 2048, "TEXTS_A_SHARD": 32}
    for name, limit in limits.items():
        monkeypatch.setattr(join, name, limit, raising=False)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join([*words[:-1], f"e{i}"])) for i in range(400)]
    rows += [(400 + i, f"other text number {i} of many that are not alike") for i in range(200)]
    calls, plain = [], GroupedData.applyInPandas

    def counted(self, function, schema):
        sizes = plain(self, lambda frame: pd.DataFrame({"n": [len(frame)]}), "n long")
        calls.append([r.n for r in sizes.collect()])
        return plain(self, function, schema)

    monkeypatch.setattr(GroupedData, "applyInPandas", counted)
    found = join.similar_classes(documents(spark, rows))
    assert collected(found, "doc_id", "class_id", "n_links") == sorted(brute_force(rows), key=repr)
    assert len(calls) == 2
    for sizes, limit in zip(calls, limits.values(), strict=True):
        assert sum(sizes) >= 400 * 400 // 16  # all pairs of blocks are there
        assert max(sizes) < 12 * limit  # shards are filled by hash


def test_sizes_of_groups(spark):
    rows = [(f"n{i}", 0) for i in range(500)] + [(f"m{i}", 1 + i // 2) for i in range(100)]
    members = spark.createDataFrame([*rows, ("alone", 99)], "name string, root long")
    counts = members.groupBy("root").count().withColumnRenamed("count", "n").where("n > 1")
    found = join._with_sizes(members, "root", counts)
    expected = [(name, root, 500 if root == 0 else 2) for name, root in rows]
    assert collected(found, "name", "root", "n") == sorted(expected, key=repr)
    nothing = join._with_sizes(members, "root", counts.where("n < 0"))
    assert nothing.count() == 0

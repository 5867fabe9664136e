from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import SMALL, collected, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from roadstream.llm import packing, tokens
from roadstream.llm.queries import op6_best_fit_packing


def ids_of(text):
    return [*tokens.encoder(tokens.vocabulary_path())(text or ""), tokens.END]


def check(rows, pieces, most=1024):
    """Every document's ids come back in order, and sequences are gapless and not too full."""
    lengths = sorted(len(ids_of(t)) for _, t in rows)
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p.sequence_id].append((p.offset, p.length))
        assert (p.length == most) or p.piece == 0
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= most
    assert sum(p.length for p in pieces) == sum(lengths)
    return by_sequence


def test_query_packs_every_token(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    pieces = op6_best_fit_packing(spark, SMALL).collect()
    sequences = check(rows, pieces)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    for doc_id, text in rows:
        ids = np.array(ids_of(text), dtype="<u4")
        at = 0
        for n, p in enumerate(sorted(by_doc[doc_id], key=lambda p: p.piece)):
            assert (p.piece, p.start) == (n, at)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    long = sum(p.length > 512 for p in pieces)
    assert len(sequences) <= 1.02 * max(long, -(-sum(p.length for p in pieces) // 1024))


def test_awkward_rows_in_several_groups(spark):
    rows = [(None, None), (None, ""), (1, "x y z"), (1, "x y z"), (2, "word " * 5000)]
    rows += [(10 + i, "tail " * (i * 7 % 400)) for i in range(60)]
    docs = documents(spark, rows)
    pieces = packing.pack(docs, group_rows=8).collect()
    check(rows, pieces)
    again = packing.pack(docs.repartition(3), group_rows=8).collect()
    assert sorted(map(tuple, pieces), key=repr) == sorted(map(tuple, again), key=repr)
    assert packing.pack(documents(spark, [])).count() == 0


def test_repeated_rows_are_dealt_evenly(spark):
    rows = [(5, "one and the same " * 12)] * 700 + [(i, "x " * (i % 90)) for i in range(300)]
    rows += [(9000, "very long text " * 30_000)]
    docs = documents(spark, rows)
    pieces = packing.pack(docs, group_rows=100).collect()
    check(rows, pieces)
    groups = defaultdict(int)
    for p in pieces:
        groups[p.sequence_id >> 32] += 1
    assert max(groups.values()) <= 2 * 100
    cut = packing.cut(docs)
    again = packing.numbered(cut, most=50)  # the numbers of a piece come in several rows
    assert collected(again.drop("copy"), *cut.columns) == collected(cut, *cut.columns)
    assert again.distinct().count() == again.count() == len(pieces)


@settings(max_examples=60, deadline=None)
@given(
    st.lists(st.integers(1, 100), max_size=60),
    st.sampled_from(["norm", "dot"]),
    st.integers(1, 5),
)
def test_every_capacity_holds(sizes, rule, documents_each):
    sizes = np.array(sorted(sizes, reverse=True), dtype=np.int64)
    limits = (100.0, float(documents_each), 10_500.0)
    sequence, offset = packing.best_fit(sizes, limits, rule=rule)
    for s in set(sequence.tolist()):
        here = sizes[sequence == s]
        assert here.sum() <= 100 and len(here) <= documents_each
        assert (here**2).sum() <= 10_500
        order = np.argsort(offset[sequence == s])
        assert offset[sequence == s][order].tolist() == [0, *np.cumsum(here[order])[:-1]]


def test_best_fit_fills_exactly():
    sizes = np.array([700, 600, 424, 324])
    sequence, _ = packing.best_fit(sizes, packing.capacities())
    assert sequence.tolist() == [0, 1, 1, 0]
    with pytest.raises(ValueError):
        packing.best_fit(np.array([50]), (40.0, 9.0, 9e9))

from __future__ import annotations

import re

import pytest
from cases import collected, documents

from roadstream.llm import mixing
from roadstream.llm.common import ROW
from roadstream.llm.queries import op10_mix_sources


def shared_out(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing again and again what exceeds a cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, rest, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        unit = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * unit > cap * sizes[s]}
        if not full:
            return target | {s: weight[s] * unit for s in open_}
        for s in full:
            target[s] = cap * sizes[s]
            rest -= target[s]
        open_ -= full
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_and_taken_words(spark):
    rows = [(i, "w " * (i * 13 % 90 + 1), f"s{i % 3}") for i in range(900)]
    rows += [(1000 + i, "é x y\tz", "ä") for i in range(40)]
    rows += [(2000 + i, "a b c", None) for i in range(300)]
    rows += [(3000, None, "empty"), (3001, "", "empty"), (None, "one two", "s1"), (5, "five", "s0")]
    rows += [(5, "five", "s0")] * 2
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + words(text)
    target = shared_out(sizes)
    docs = documents(spark, rows)
    made = mixing.sample_copies(docs).select(
        f"{ROW}.doc_id", f"{ROW}.source", "size", "source_size", "target", "copies"
    )
    found = made.collect()
    assert len(found) == len(rows)
    taken = dict.fromkeys(sizes, 0)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(target[r.source])
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for source, n in taken.items():
        assert abs(n - target[source]) <= 200
    again = mixing.sample_copies(docs.repartition(5)).select(f"{ROW}.doc_id", "size", "copies")
    assert collected(again, "doc_id", "size", "copies") == collected(
        made, "doc_id", "size", "copies"
    )


def test_the_mix_repeats_rows(spark):
    rows = [(i, "a b c", "big" if i < 90 else "small") for i in range(100)]
    docs = documents(spark, rows)
    mix = mixing.mixed(docs)
    assert mix.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in mix.groupBy("doc_id").count().collect()}
    copies = mixing.sample_copies(docs).select(f"{ROW}.doc_id", "copies").where("copies > 0")
    assert counts == {r.doc_id: r.copies for r in copies.collect()}


def test_empty_tables(spark):
    assert mixing.sample_copies(documents(spark, [])).count() == 0
    blank = mixing.sample_copies(documents(spark, [(1, None, None), (2, " ", "x")])).collect()
    assert [(r.target, r.copies) for r in blank] == [(0.0, 0), (0.0, 0)]


def test_no_python_on_the_main_path(spark, capsys):
    op10_mix_sources(spark, "/root/testdata/sf0.001").explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan

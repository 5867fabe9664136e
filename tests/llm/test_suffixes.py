from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from cases import SMALL, collected, documents

from roadstream.llm import suffixes
from roadstream.llm.queries import op1_suffix_dedup


def brute_force(texts, length=200):
    """(n_bytes, n_removed, n_spans, sha256 of the rest) of every text."""
    datas = [(t or "").encode() for t in texts]
    seen = Counter(d[p : p + length] for d in datas for p in range(len(d) - length + 1))
    out = []
    for data in datas:
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            if seen[data[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def awkward_texts():
    rng = random.Random(5)
    words = ["größe", "the", "of", "señal", "été", "run", "stone", "light", "a", "tin"]

    def prose(n):
        return " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))

    passage, other = prose(60), prose(45)
    texts = [prose(80) for _ in range(6)]
    texts += [prose(10) + passage + prose(30), passage + prose(12), prose(40) + passage]
    texts += [passage[:-7] + "X" + other + prose(5), "Y" + other[3:] + passage[20:]]
    texts += [prose(7) + passage[:199], prose(6) + other[:200] + prose(3), other[:200]]
    texts += ["ab" * 150, "z" * 199, "z" * 200, "z" * 201, "xyz" * 200 + prose(9)]
    texts += [None, "", "short", texts[0], texts[0], texts[1] + "!"]
    return texts + [f"{prose(8)} {passage} {prose(9)}" for _ in range(9)]


@pytest.mark.parametrize("hot", [256, 2])
def test_against_brute_force(spark, hot):
    texts = awkward_texts()
    ids = [None if i == 2 else 5 if i in (3, 4) else i for i in range(len(texts))]
    rows = [(i, t) for i, t in zip(ids, texts, strict=True)]
    made = suffixes.without_repeats(documents(spark, rows), hot=hot).collect()
    found = [
        (
            r.doc_id,
            r.n_bytes,
            sum(s.end - s.begin for s in r.spans),
            len(r.spans),
            hashlib.sha256(r.kept).hexdigest(),
        )
        for r in made
    ]
    expected = [(i, *b) for i, b in zip(ids, brute_force(texts), strict=True)]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def found_by(spark, rows):
    made = suffixes.without_repeats(documents(spark, rows)).collect()
    return sorted(
        (
            (r.doc_id, r.n_bytes, sum(s.end - s.begin for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
            for r in made
        ),
        key=repr,
    )


def test_many_rows_without_an_id_and_copies_of_rows(spark):
    """Rows are told apart by their texts, and copies of one give it no longer lists."""
    rng = random.Random(9)

    def prose(n):
        return " ".join(f"{rng.choice('abcdef')}{rng.randrange(1000)}" for _ in range(n))

    passage = prose(70)
    rows = [(None, f"{prose(20)} {passage if i % 50 == 0 else ''}") for i in range(1500)]
    rows += [(5, prose(60)) for _ in range(300)]
    rows += [(6, f"{prose(40)} {passage}")] * 400 + [(None, prose(90))] * 200
    expected = [(i, *b) for (i, _), b in zip(rows, brute_force([t for _, t in rows]), strict=True)]
    assert found_by(spark, rows) == sorted(expected, key=repr)


def test_a_very_long_text(spark):
    rng = random.Random(3)
    long = " ".join(str(rng.randrange(10**6)) for _ in range(150_000))
    rows = [(1, long), (2, "x" + long[500_000:500_400] + "y"), (3, None)]
    (n, removed, spans), (m, gone, _) = (r[1:4] for r in found_by(spark, rows)[:2])
    assert (n, removed, spans) == (len(long), 400, 1) and (m, gone) == (402, 400)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = [
        (d.doc_id, *b) for d, b in zip(docs, brute_force([d.text for d in docs]), strict=True)
    ]
    found = collected(
        op1_suffix_dedup(spark, SMALL), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"
    )
    assert found == sorted(expected, key=repr)


def test_empty_table(spark):
    assert suffixes.without_repeats(documents(spark, [])).count() == 0

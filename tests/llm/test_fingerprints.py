from __future__ import annotations

import hashlib

import numpy as np
from cases import SMALL, documents, jaccard, shingle_set

from roadstream.llm import fingerprints as fp
from roadstream.llm.queries import op8_fingerprints
from roadstream.llm.shingles import shingle_hashes


def expected(rows):
    out = {}
    for n, (doc_id, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        part = len(text) // 4
        edited = text[: len(text) - part] + following[:part]
        a = shingle_set(text)
        out[doc_id] = (
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            jaccard(a, shingle_set(edited)),
            jaccard(a, shingle_set(following)),
        )
    return out


def agree(found, wanted, most):
    for r in found:
        n, sha, near_edited, near_next = wanted[r.doc_id]
        assert (r.n_chars, r.edited_sha256) == (n, sha)
        assert abs(r.near_edited - near_edited) <= most
        assert abs(r.near_next - near_next) <= most


def test_query_against_brute_force(spark):
    rows = [
        (r.doc_id, r.text)
        for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    ]
    found = op8_fingerprints(spark, SMALL).collect()
    assert len(found) == len(rows)
    agree(found, expected(rows), 0.2)
    prints = {r.doc_id: r.fingerprint for r in found}
    for a, x in rows:
        for b, y in rows[:30]:
            assert (prints[a] == prints[b]) == (shingle_set(x) == shingle_set(y)) or x != y


def test_short_texts_are_exact(spark):
    texts = ["", "one", "one two three", "é" * 9, "a b c d e f g h", "a b c d e f g h", "🙂 x" * 20]
    texts += ["", "w " * 400, "tail of all"]
    rows = [(i * 3, t) for i, t in enumerate(texts)]
    asked = [(i, None if t == "" else t) for i, t in rows]
    found = fp.edit_probe(documents(spark, asked[::-1])).collect()
    agree(found, expected(rows), 1e-12)


def test_null_and_repeated_ids_and_one_row(spark):
    found = fp.edit_probe(documents(spark, [(None, "x y"), (2**60 + 1, "p q"), (2**60 + 1, "p q")]))
    assert sorted((r.doc_id or 0) for r in found.collect()) == [0, 2**60 + 1, 2**60 + 1]
    one = fp.edit_probe(documents(spark, [(1, "abcdefgh")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest()
    assert fp.edit_probe(documents(spark, [])).count() == 0


def test_sketches_merge_and_estimate():
    words = [f"w{i}" for i in range(6000)]
    whole, first, second = (
        fp.sketch(next(shingle_hashes([" ".join(words[a:b])])))
        for a, b in ((0, 6000), (0, 3004), (3000, 6000))
    )
    assert np.array_equal(fp.merged(first, second), whole)
    assert abs(fp.distinct_shingles(whole) / 5996 - 1) < 0.3
    assert abs(fp.resemblance(first, whole) - 3000 / 5996) < 0.15
    assert abs(fp.containment(first, whole) - 1) < 0.2
    assert fp.containment(whole, first) < 0.75
    assert np.array_equal(fp.from_text(fp.as_text(whole)), whole)


def test_fingerprints_of_a_table(spark):
    rows = [(1, "a b c d e f"), (2, None), (3, "a b c d e f")]
    found = {r.doc_id: r for r in fp.fingerprints(documents(spark, rows)).collect()}
    assert found[1].fingerprint == found[3].fingerprint and found[1].n_shingles == 2
    assert found[2].fingerprint == "" and found[2].n_shingles == 0


def test_shingles_do_not_depend_on_neighbours():
    texts = ["a b c d e f", "", "one two", "X\ty\n z w v  u", "long " * 3000, "tail of five words here"]
    together = list(shingle_hashes(texts))
    for text, hashes in zip(texts, together, strict=True):
        assert np.array_equal(next(shingle_hashes([text])), hashes)
        assert len(set(hashes.tolist())) == len(shingle_set(text))

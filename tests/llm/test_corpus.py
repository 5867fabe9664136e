from __future__ import annotations

from collections import Counter
from itertools import combinations

import duckdb
from cases import SMALL, documents, jaccard, shingle_set
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from roadstream.llm import language, lines, mixing
from roadstream.llm.common import id_hash
from roadstream.llm.packing import pieces_of
from roadstream.llm.tokens import encoder, vocabulary_path


def in_sql(path, sql):
    """A query of DuckDB over a stage's input, as a dict by doc_id."""
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}/*.parquet')")
    found = connection.execute(sql)
    names = [c[0] for c in found.description]
    return {row[names.index("doc_id")]: dict(zip(names, row, strict=True)) for row in found.fetchall()}


def first_of_each_class(texts):
    """The smallest id of every chain of texts that share 0.8 of their shingles, all pairs compared."""
    sets = {i: shingle_set(text) for i, text in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        return i if root[i] == i else find(root[i])

    for a, b in combinations(sorted(texts), 2):
        if sets[a] and sets[b] and jaccard(sets[a], sets[b]) >= 0.8:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i for i in texts if find(i) == i}


def test_every_stage_on_its_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, str(tmp_path / "input")
    docs.write.parquet(before)
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path / name)
        stage(spark, docs, SMALL).write.parquet(path)
        given, docs = docs, spark.read.parquet(path)
        texts = {r.doc_id: r.text for r in given.collect()}
        if name != "pack":
            assert docs.columns == columns
            found = {r.doc_id: r for r in docs.collect()}
        if name == "language":
            model = language.learn(given.where(id_hash(F.col("doc_id")) % 4 != 2))
            languages = language.coders(model)
            told = {i: language.decide(text, languages) for i, text in texts.items()}
            kept = {i: lang for i, (lang, _, _, rejected) in told.items() if not rejected}
            assert {i: r.lang for i, r in found.items()} == kept
            assert len(kept) >= 0.97 * len(texts)
        if name == "lines":
            clean = {i: r["text"] for i, r in in_sql(before, lines.SQL).items()}
            assert {i: r.text for i, r in found.items()} == clean
            assert all(r.n_chars == len(r.text) for r in found.values())
            assert sum(clean[i] != texts[i] for i in texts) > 0
        if name == "near_copies":
            assert {r.doc_id for r in docs.collect()} == first_of_each_class(texts)
            assert len(found) < len(texts)
        if name == "mix":
            taken = in_sql(before, mixing.SQL)
            often = Counter(r.doc_id for r in docs.collect())
            assert {i: r["taken"] for i, r in taken.items() if r["size"]} == {
                i: often[i] * r["size"] for i, r in taken.items() if r["size"]
            }
            assert all(r.text == texts[i] for i, r in found.items())
        if name == "pack":
            rows = docs.collect()
            copies = Counter(r.doc_id for r in given.collect())
            encode = encoder(vocabulary_path())
            held = Counter((r.doc_id, r.piece, r.start, r.length) for r in rows)
            expected = Counter()
            for i, n in copies.items():
                cuts = pieces_of(len(encode(texts[i] or "")) + 1, 1024)
                expected.update({(i, piece, *cut): n for piece, cut in enumerate(cuts)})
            assert held == expected
            places = {}
            for r in rows:
                places.setdefault(r.sequence_id, []).append((r.offset, r.length))
            for inside in places.values():
                at = 0
                for offset, length in sorted(inside):
                    assert offset == at
                    at += length
                assert at <= 1024
        before = path


def test_run_and_registration(spark):
    assert len(corpus_pipeline.STAGES) == 5
    assert entry_points.queries()["pipeline"] is corpus_pipeline.run
    made = corpus_pipeline.run(spark, SMALL)
    assert made.columns[0] == "doc_id" and made.count() > 0


def test_stages_take_empty_and_awkward_tables(spark):
    rows = [(None, None), (1, ""), (2, "the of and to"), (2, "the of and to"), (3, "x" * 100_000)]
    for docs in (documents(spark, []), documents(spark, rows)):
        for name, stage in corpus_pipeline.STAGES:
            made = stage(spark, docs, SMALL)
            if name != "pack":
                assert made.columns == docs.columns
            made.collect()

from __future__ import annotations

from cases import collected, documents
from tokenizers import Tokenizer

from roadstream.llm import packing, tokens

TEXTS = [
    "", " ", "hello  world", "It's they'll we'd I'm \n\n x", "größe señal été œuvre ½²３", "日本語 текст 🙂",
    "tab\tvt\x0bff\x0c nb sp", "<|endoftext|> inside", "a" * 3000, "\r\n" * 40, "9" * 700, "\x00\x1c\x85",
]


def test_ids_equal_the_tokenizer():
    path = tokens.vocabulary_path()
    encode, exact = tokens.encoder(path), Tokenizer.from_file(path)
    for text in TEXTS:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids


def test_ids_of_documents_equal_the_tokenizer(spark):
    path = tokens.vocabulary_path()
    encode, exact = tokens.encoder(path), Tokenizer.from_file(path)
    for row in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        assert encode(row.text) == exact.encode(row.text, add_special_tokens=False).ids


def test_length_table_against_brute_force(spark):
    lengths = [1, 1, 1, 5, 5, 9, 1023, 1024, 1025, 5000, 5000, 70_000, 2048]
    table = tokens.length_table(spark.createDataFrame([(n,) for n in lengths], "n_tokens long"))
    expected = [
        (
            limit,
            lengths.count(limit),
            sum(n <= limit for n in lengths),
            sum(n > limit for n in lengths),
            sum(n for n in lengths if n <= limit),
            sum(min(n, limit) for n in lengths),
            len(lengths),
            sum(lengths),
            sum(n <= limit for n in lengths) / len(lengths),
        )
        for limit in set(lengths)
    ]
    assert collected(table, *table.columns) == sorted(expected, key=repr)


def test_lengths(spark):
    rows = [(1, None), (2, ""), (2, ""), (None, "hello world"), (3, "x " * 5000)]
    encode = tokens.encoder(tokens.vocabulary_path())
    found = collected(tokens.lengths(documents(spark, rows)), "n_tokens")
    assert found == sorted(((len(encode(t or "")) + 1,) for _, t in rows), key=repr)
    empty = tokens.length_table(tokens.lengths(documents(spark, [])))
    assert empty.count() == 0


def test_long_runs_of_white_space(spark):
    path = tokens.vocabulary_path()
    encode, exact = tokens.encoder(path), Tokenizer.from_file(path)
    n = tokens.LONGEST_RUN
    texts = [" " * 1_000_000, "\n" * 1_000_000, "a" + "\u2003 \r\n" * 300_000 + "b"]
    texts += ["a" + " " * k + "b" for k in (n - 1, n, n + 1)]
    texts += ["\n" * n + "x" + " " * 1_500_000, (" " * n + "x") * 20]
    for text in texts:
        assert encode(text) == exact.encode(text, add_special_tokens=False).ids
    rows = [(1, texts[0]), (2, "hello world"), (3, texts[1])]
    found = collected(tokens.lengths(documents(spark, rows)), "n_tokens")
    assert found == sorted(((len(encode(t)) + 1,) for _, t in rows), key=repr)
    assert packing.pack(documents(spark, rows)).select("doc_id").distinct().count() == 3

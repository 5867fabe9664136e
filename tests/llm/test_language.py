from __future__ import annotations

import random

from cases import documents

from roadstream.llm import language
from roadstream.llm.queries import op7_language_id


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    found = op7_language_id(spark, sf_dir).where("held_out").join(docs, "doc_id").collect()
    assert len(found) > 200
    assert all(0 <= r.score <= 1 for r in found)
    assert sum(r.lang_pred == r.lang for r in found) / len(found) > 0.97
    sure = [r for r in found if not r.rejected]
    assert len(sure) / len(found) > 0.97
    assert sum(r.lang_pred == r.lang for r in sure) / len(sure) > 0.985


ROWS = [(i, "the quick brown fox and the lazy dog %d" % i, "s", "en") for i in range(30)]
ROWS += [(50 + i, "der schnelle braune fuchs und der faule hund %d" % i, "s", "de") for i in range(20)]


def test_awkward_rows(spark):
    taught = [*ROWS, (90, None, "s", "fr"), (91, "123 !!", "s", "es"), (92, "text", "s", None)]
    model = language.learn(documents(spark, taught))
    assert list(model) == ["en", "de"]
    asked = [(1, None), (2, ""), (3, "12 34 ?!"), (None, "der hund und der fuchs"), (5, "zqx")]
    asked += [(6, "the dog and the fox"), (6, "the dog and the fox"), (7, "the dog " * 30_000)]
    docs = documents(spark, asked)
    made = language.identify(docs, model)
    assert made.columns == [*docs.columns, "__lang"]
    found = [(r.doc_id, r["__lang"].lang_pred, r["__lang"].rejected) for r in made.collect()]
    assert found[:3] == [(1, "und", True), (2, "und", True), (3, "und", True)]
    assert found[3] == (None, "de", False)
    assert found[4] == (5, "en", True)  # a tie goes to the language with more labelled rows
    # Repetition tells as little about a language as a few words: here the margin is too small.
    assert found[5:] == [(6, "en", False), (6, "en", False), (7, "en", True)]
    assert language.identify(documents(spark, []), model).count() == 0


def test_without_labels(spark):
    model = language.learn(documents(spark, [(1, "text")]))
    assert model == {}
    assert language.identify(documents(spark, [(1, "text")]), model).first()["__lang"][0] == "und"


def test_the_sample_is_bounded(spark):
    model = language.learn(documents(spark, ROWS), texts=3, chars=10)
    assert all(len(content) <= 3 * 11 for content in model.values())


def test_every_part_of_a_long_text_counts_alike(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select(
        "doc_id", "text", "lang"
    )
    languages = language.coders(language.learn(docs))
    rng = random.Random(5)

    def prose(lang, chars):
        """Words of a language in random order, so that long texts do not repeat themselves."""
        rows = docs.where("text IS NOT NULL").where(docs.lang == lang).collect()
        words = sorted({w for r in rows for w in r.text.split()})
        return " ".join(rng.choices(words, k=chars // 4))[:chars]

    english, french = prose("en", 4_000_000), prose("fr", 800_000)
    for text in (french + " " + english, english + " " + french):
        found, _, lead, rejected = language.decide(text, languages)
        assert found == "en" and not rejected
    leads = [language.decide(english[:n], languages)[2] for n in (250_000, 4_000_000)]
    assert leads[1] > 0.8 * leads[0]


def test_fractions_and_circled_numbers_are_no_letters(spark):
    model = language.learn(documents(spark, ROWS))
    languages = language.coders(model)
    for text in ("½ ² 10", "①②", "Ⅷ", "٣", "_"):
        assert language.decide(text, languages) == ("und", 0.0, 0.0, True)
    assert language.decide("½ the dog and the fox", languages)[0] == "en"

from __future__ import annotations

from cases import documents

from roadstream.llm import toxicity
from roadstream.llm.queries import op9_toxicity


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    found = op9_toxicity(spark, sf_dir)
    assert found.count() == 10_000
    held = found.where("held_out").join(labels, "doc_id").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in held)
    toxic = [r for r in held if r.toxic == 1]
    clean = [r for r in held if r.toxic == 0]
    assert sum(r.predicted for r in toxic) / len(toxic) > 0.8
    assert sum(r.predicted for r in clean) / len(clean) < 0.01
    # Calibrated: scores are near the shares of toxic texts.
    assert sum((r.score - r.toxic) ** 2 for r in held) / len(held) < 0.03


def test_features():
    lexicon = {"idiot": 2.0}
    named = dict(
        zip(toxicity.FEATURES, toxicity.features("YOU idiot, 1d1ot! nooo", lexicon), strict=True)
    )
    assert named["lexicon_density"] == 2 / 4
    assert named["near_second_person"] == 2 / 4
    assert named["disguised_hits"] == 1
    assert named["shouted_words"] == 1 / 4
    assert named["letter_runs"] == 1 / 4
    assert set(toxicity.features("", lexicon)) == {0.0}


def test_without_labels_or_one_class(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "text"), (2, "x" * 200_000)])
    for rows, share in (([], 0.0), ([(1, 1), (2, 1)], 1.0), ([(1, 0), (2, None), (3, 7)], 0.0)):
        model = toxicity.learn(docs, spark.createDataFrame(rows, "doc_id long, toxic int"))
        found = toxicity.score(docs, model).collect()
        assert [r.score for r in found] == [share] * 4
    assert toxicity.score(documents(spark, []), model).count() == 0


def test_small_fit_scores_every_row(spark):
    rows = [(i, "plain words of a text %d" % i if i % 2 else "you idiot %d" % i) for i in range(80)]
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(80)], "doc_id long, toxic int")
    model = toxicity.learn(documents(spark, rows), labels)
    asked = documents(spark, [(None, None), (1, ""), (2, "you idiot"), (2, "you idiot")])
    found = {r.doc_id: r for r in toxicity.score(asked, model).collect()}
    assert found[2].predicted == 1 and found[1].predicted == 0 and found[None].predicted == 0

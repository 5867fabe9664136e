"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is learned from labelled rows: words that occur in far more toxic texts than their
share. Trees are grown on one part of the learning rows, their score is calibrated on another.
"""

from __future__ import annotations

import math
import re
import string
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import checkpointed

# The classifier learns from so many labelled rows at most, chosen by hash of their id.
SAMPLE_ROWS = 20_000
LEXICON_WORDS = 48
LEAST_Z = 4.0  # standard errors by which a word's log odds must exceed those of all words
TREES, DEPTH, STEP = 20, 3, 0.3
CALIBRATION_SHARE = 4  # every fourth learning row calibrates
NEAR_WORDS = 4
ORDER_SHARE = 0.01  # of the score that still orders texts within one calibrated step

SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi ton ta tes vous "
    "votre vos tú ti tus usted ustedes vosotros".split()
)
LOOKALIKES = str.maketrans("013457@$!|+", "oieastasiit")
EDGE = string.punctuation + "¡¿«»„“”"
DISGUISED = re.compile(r"(?<=[^\W\d_])[\d@$!|+*._\-]+(?=[^\W\d_])")
NOT_LETTERS = re.compile(r"[\W\d_]+")
RUN = re.compile(r"([^\W\d_])\1\1")

FEATURES = (
    "lexicon_density",
    "lexicon_hits",
    "lexicon_kinds",
    "lexicon_weight",
    "near_second_person",
    "second_person_density",
    "capitals",
    "shouted_words",
    "punctuation",
    "exclamations",
    "disguised_words",
    "disguised_hits",
    "letter_runs",
    "words",
)


def features(text: str, lexicon: dict[str, float]) -> tuple[float, ...]:
    """The FEATURES of a text, all finite; an empty text has zeros."""
    raw = text.split()
    words = [w.strip(EDGE).lower() for w in raw]
    n = max(len(words), 1)
    hits = [i for i, w in enumerate(words) if w in lexicon]
    disguised = hidden = 0
    if DISGUISED.search(text):
        for i, w in enumerate(words):
            if DISGUISED.search(w):
                disguised += 1
                plain = NOT_LETTERS.sub("", w.translate(LOOKALIKES))
                if w not in lexicon and plain in lexicon:
                    hidden += 1
                    words[i] = plain
                    hits.append(i)
    persons = [w in SECOND_PERSON for w in words]
    near = sum(any(persons[max(0, i - NEAR_WORDS) : i + NEAR_WORDS + 1]) for i in hits)
    letters = sum(map(str.isalpha, text)) or 1
    signs = sum(map(text.count, string.punctuation))
    return (
        len(hits) / n,
        math.log1p(len(hits)),
        float(len({words[i] for i in hits})),
        sum(lexicon[words[i]] for i in hits) / n,
        near / n,
        sum(persons) / n,
        sum(map(str.isupper, text)) / letters,
        sum(len(w) > 1 and w.isupper() for w in raw) / n,
        signs / max(len(text), 1),
        text.count("!") / n,
        disguised / n,
        float(hidden),
        len(RUN.findall(text)) / n,
        math.log1p(len(words)),
    )


def featured(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """``docs`` with its column text replaced by the FEATURES; a null text counts as empty."""
    rest = [f for f in docs.schema.fields if f.name != "text"]
    made = F.pandas_udf(_feature_frame(lexicon), ", ".join(f"{name} double" for name in FEATURES))
    vector = docs.select(
        *[f"`{f.name}`" for f in rest], made(F.coalesce("text", F.lit(""))).alias("__made")
    )
    return vector.select(*[f"`{f.name}`" for f in rest], "__made.*")


def _feature_frame(lexicon: dict[str, float]):
    def made(texts: pd.Series) -> pd.DataFrame:
        rows = np.array([features(t, lexicon) for t in texts], dtype=float)
        return pd.DataFrame(rows.reshape(-1, len(FEATURES)), columns=list(FEATURES))

    made.__annotations__ = {"texts": pd.Series, "return": pd.DataFrame}
    return made


def learn_lexicon(rows: DataFrame, most: int = LEXICON_WORDS) -> dict[str, float]:
    """The words most typical of toxic rows, with their log odds, from text and toxic.

    A word counts once a distinct text, so that copies weigh nothing; log odds are compared with
    those of all words in standard errors. At most ``most`` words come back.
    """
    named = rows.withColumn("name", F.xxhash64("text"))
    distinct = named.dropDuplicates(["name", "toxic"]).select(
        "toxic", F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("token")
    )
    word = F.regexp_replace("token", r"^[\p{Punct}¡¿«»„“”]+|[\p{Punct}¡¿«»„“”]+$", "")
    counts = (
        distinct.withColumn("word", word)
        .where(F.length("word") > 1)
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    totals = counts.agg(F.sum("bad").alias("b"), F.sum("good").alias("g")).first()
    if not totals["b"]:
        return {}
    base = math.log((totals["b"] + 1) / ((totals["g"] or 0) + 1))
    odds = F.log((F.col("bad") + 0.5) / (F.col("good") + 0.5)) - base
    error = F.sqrt(1 / (F.col("bad") + 0.5) + 1 / (F.col("good") + 0.5))
    best = (
        counts.select("word", odds.alias("odds"), (odds / error).alias("z"))
        .where(F.col("z") >= LEAST_Z)
        .orderBy(F.desc("z"), "word")
        .limit(most)
    )
    return {row["word"]: row["odds"] for row in best.collect()}


@dataclass(frozen=True)
class ToxicityModel:
    """A fitted classifier; without trees every text gets the share of toxic learning rows."""

    lexicon: dict[str, float]
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    base: float


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="__features").transform(df)


def _raw(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    scored = trees.transform(df)
    return scored.withColumn("__raw", vector_to_array("probability")[1])


def learn(
    docs: DataFrame, labels: DataFrame, *, most: int = SAMPLE_ROWS, seed: int = 7
) -> ToxicityModel:
    """A model of ``labels`` (doc_id, toxic 0/1) on ``docs`` (doc_id, text).

    At most ``most`` labelled rows are used. Rows with another or no label teach nothing; a null
    text counts as empty; of repeated labels of an id the largest counts. With no rows of one of
    the classes the model gives everybody the share of toxic rows.
    """
    known = labels.where("toxic IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id")
    chosen = (
        known.agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    # Stored before anything is learned: the documents are read once, by as many tasks as they have.
    rows = checkpointed(
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")  # at most ``most`` rows of two numbers
        .select("doc_id", "toxic", "text")
    )
    lexicon = learn_lexicon(rows)
    held = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(CALIBRATION_SHARE)) == 0
    table = _assembled(
        checkpointed(featured(rows.withColumn("calibrates", held), lexicon).coalesce(4))
    ).withColumn("toxic", F.col("toxic").cast("double"))
    counted = {
        (row["calibrates"], row["toxic"]): row["count"]
        for row in table.groupBy("calibrates", "toxic").count().collect()
    }
    total = sum(counted.values())
    base = sum(n for (_, y), n in counted.items() if y == 1) / total if total else 0.0
    if any(not counted.get((part, y)) for part in (False, True) for y in (0.0, 1.0)):
        return ToxicityModel(lexicon, None, None, base)
    trees = GBTClassifier(
        featuresCol="__features", labelCol="toxic", predictionCol="__class",
        maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, minInstancesPerNode=5, seed=seed,
        checkpointInterval=-1,
    ).fit(table.where("NOT calibrates"))
    steps = IsotonicRegression(
        featuresCol="__raw", labelCol="toxic", predictionCol="__step"
    ).fit(_raw(trees, table.where("calibrates")))
    return ToxicityModel(lexicon, trees, steps, base)


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score, predicted of every row of ``docs`` (doc_id, text).

    Null and empty texts are scored like any other, repeated rows stay repeated, an empty table
    gives no rows. Only the text decides.
    """
    table = featured(docs.select("doc_id", "text"), model.lexicon)
    if model.trees is None:
        scored = table.select("doc_id", F.lit(model.base).alias("score"))
    else:
        raw = _raw(model.trees, _assembled(table))
        blend = (1 - ORDER_SHARE) * F.col("__step") + ORDER_SHARE * F.col("__raw")
        scored = model.steps.transform(raw).select("doc_id", blend.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


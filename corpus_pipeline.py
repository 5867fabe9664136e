"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the
columns of documents. Each stage's result is written as Parquet to the shared folder and read
again as the next one's input, so that a lost executor costs part of one stage at most.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import jaccard, language, lines, mixing, packing
from roadstream.llm.common import ROW, discard, id_hash, shared_folder, small_batches, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; lang becomes the language found.

    The dictionaries are learned from the labelled documents that operator 7 learns from. Texts
    that are null, have no letter, or lie too close to a second language go.
    """
    small_batches(spark)
    model = language.learn(docs.where(id_hash(F.col("doc_id")) % 4 != 2))
    found = language.identify(docs, model)
    columns = [
        F.col("__lang.lang_pred").alias(c) if c == "lang" else F.col(f"`{c}`")
        for c in docs.columns
    ]
    return found.where("NOT __lang.rejected").select(*columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand on many sites; n_chars follows the text."""
    made = lines.without_spread_lines(docs)
    changed = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return made.select(
        *[changed.get(c, F.col(f"{ROW}.`{c}`")).alias(c) for c in docs.columns]
    )


def join_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates, the one with the smallest id."""
    small_batches(spark)
    return jaccard.one_of_each_class(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the target weights of their sources take them."""
    return mixing.mixed(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 1024 tokens."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near_copies", join_near_copies),
    ("mix", mix_sources),
    ("pack", pack_sequences),
]

# Compression, similarity of shingle sets and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents. A stage's table goes once the next one's is
    written."""
    folder = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before:
            discard(spark, f"{folder}/{before}")
        before = name
    return docs

"""The named queries of this package and, where SQL can express them, the same results as SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.llm import (
    codes,
    fingerprints,
    hosts,
    jaccard,
    language,
    lines,
    mixing,
    negatives,
    packing,
    suffixes,
    tokens,
    topk,
    toxicity,
)
from roadstream.llm.common import ROW, id_hash, join_groups, table, written


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the 200-byte strings that occur twice."""
    made = suffixes.without_repeats(_documents(spark, sf_dir))
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return made.select(
        "doc_id",
        "n_bytes",
        gone.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near-duplicates of every document and the number of its links."""
    return jaccard.similar_classes(_documents(spark, sf_dir)).select(
        "doc_id", "class_id", "n_links", "n_texts"
    )


def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all vectors for every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that stand on ten or more sources."""
    made = lines.without_spread_lines(_documents(spark, sf_dir, "source"))
    return made.select(
        f"{ROW}.doc_id", "n_lines", "n_removed", F.col("clean_text").alias("text")
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and tokens within, beyond and cut at every encoded length that occurs."""
    return tokens.length_table(tokens.lengths(_documents(spark, sf_dir)))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 1024 tokens."""
    return packing.pack(_documents(spark, sf_dir))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of the labelled ones."""
    docs = _documents(spark, sf_dir, "lang")
    held_out = id_hash(F.col("doc_id")) % 4 == 2
    model = language.learn(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id",
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
        "__lang.lang_pred",
        "__lang.score",
        "__lang.margin",
        "__lang.rejected",
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of an edited copy, and how alike they are."""
    return fingerprints.edit_probe(_documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learned from four fifths of the labelled ones."""
    docs = _documents(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    held_out = id_hash(F.col("doc_id")) % 5 == 0
    model = toxicity.learn(docs, labels.where(~held_out))
    return toxicity.score(docs, model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", "predicted"
    )


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    mix = mixing.sample_copies(_documents(spark, sf_dir, "source"), keep=["doc_id"])
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mix.select(f"{ROW}.doc_id", "size", "source_size", "target", taken)


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every vector whose id is divisible by
    50; every seventh vector counts under the next label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    other = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10)
    shifted = vectors.withColumn("label", F.coalesce(other, F.col("label")))
    return negatives.hard_negatives(shifted, F.col("vec_id") % 50 == 0)


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product code of every vector, its error and the error of its label."""
    made = codes.compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    # Errors beyond 64 bits are null, and so is a sum that holds one.
    error = F.sum(F.col("error").cast("decimal(38,0)"))
    whole = F.when(F.count("error") == F.count("*"), error)
    labels, _ = written(
        made.rows.groupBy("label").agg(
            F.count("*").alias("n"), whole.try_cast("long").alias("label_error")
        )
    )
    digest = hashlib.sha256(codes.book_text(made.books).encode()).hexdigest()
    return join_groups(made.rows, labels, "label", "n").select(
        "vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )


def op13_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document, and whether it passes the rules for itself and its host."""
    made = hosts.judged(_documents(spark, sf_dir, "source"), keep=["doc_id"])
    return made.select(
        f"{ROW}.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_exact_top_k": op3_exact_top_k,
    "op4_line_dedup": op4_line_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_language_id": op7_language_id,
    "op8_fingerprints": op8_fingerprints,
    "op9_toxicity": op9_toxicity,
    "op10_mix_sources": op10_mix_sources,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_vector_codes": op12_vector_codes,
    "op13_host_rules": op13_host_rules,
}

ORACLE_SQL = {
    "op3_exact_top_k": topk.SQL,
    "op4_line_dedup": lines.SQL,
    "op10_mix_sources": mixing.SQL,
    "op11_hard_negatives": negatives.SQL,
    "op12_vector_codes": codes.SQL,
    "op13_host_rules": hosts.SQL,
}

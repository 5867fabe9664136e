"""Token ids of a byte-level BPE vocabulary, and exact length histograms.

The vocabulary is a file of the ``tokenizers`` library; the library that reads ranks gives the
same ids several times faster and is used for all texts but those that spell out a special token or
hold a very long run of white space, which the tokenizer itself encodes.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import checkpointed

VOCABULARY = "byte_bpe_50k.json"
END = 2  # closes every document
SPAN = 1024  # lengths per block of the suffix sums
# The fast library's stack overflows on runs of white space between 700,000 and 1,000,000
# characters. A run is tried from its first character only, so the search is linear.
LONGEST_RUN = 100_000
LONG_RUN = re.compile(r"(?<!\s)\s{%d}" % (LONGEST_RUN + 1))


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _bytes_of_characters() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies: Latin-1's
    printable ones for themselves, the rest in order from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str], list[int]]:
    """text -> ids, as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``."""
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    special = [t["content"] for t in content.get("added_tokens", [])]
    of = _bytes_of_characters()
    ranks = {
        bytes(of[c] for c in token): rank
        for token, rank in content["model"]["vocab"].items()
        if token not in special
    }
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    exact = Tokenizer.from_file(path)

    def encode(text: str) -> list[int]:
        long_run = len(text) > LONGEST_RUN and LONG_RUN.search(text)
        if long_run or any(token in text for token in special):
            return exact.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def lengths(docs: DataFrame, *, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """n_tokens of every row of ``docs``, the closing token included; a null text is empty."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            yield pd.DataFrame({"n_tokens": [len(encode(t)) + 1 for t in batch["text"]]})

    return docs.select(F.coalesce(F.col(text), F.lit("")).alias("text")).mapInPandas(
        run, "n_tokens long"
    )


def length_table(counted: DataFrame) -> DataFrame:
    """What every context limit does to a corpus, from n_tokens of its documents.

    One row for each length that occurs, taken as the limit: docs of just that length;
    docs_longer and docs_within; tokens_within, the tokens of documents that fit;
    truncated_total, all tokens left if longer documents are cut to the limit; tokens_total and
    docs_total; quantile, the share of documents that fit. For a limit between two rows the lower
    row's counts hold, and its truncated total grows by docs_longer for every token of limit.

    The histogram is summed in two levels, so that no task holds more than one span of lengths
    or one row a span. An empty table gives no rows.
    """
    # Used twice below; the texts behind it are encoded once.
    histogram = (
        checkpointed(counted.groupBy("n_tokens").agg(F.count("*").alias("docs")))
        .withColumn("span", F.floor(F.col("n_tokens") / SPAN))
        .withColumn("tokens", F.col("n_tokens") * F.col("docs"))
    )
    sums = [F.sum("docs").alias("d"), F.sum("tokens").alias("t")]
    spans = histogram.groupBy("span").agg(*sums)
    later = Window.orderBy("span").rowsBetween(1, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    spans = spans.select(
        "span",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("d").over(everything).alias("docs_total"),
        F.sum("t").over(everything).alias("tokens_total"),
    )
    inside = Window.partitionBy("span").orderBy("n_tokens").rowsBetween(
        1, Window.unboundedFollowing
    )
    longer = F.coalesce(F.sum("docs").over(inside), F.lit(0)) + F.col("later_docs")
    longer_tokens = F.coalesce(F.sum("tokens").over(inside), F.lit(0)) + F.col("later_tokens")
    within = F.col("tokens_total") - F.col("longer_tokens")
    return (
        histogram.join(spans, "span")
        .withColumn("docs_longer", longer)
        .withColumn("longer_tokens", longer_tokens)
        .select(
            F.col("n_tokens").alias("context_limit"),
            "docs",
            (F.col("docs_total") - F.col("docs_longer")).alias("docs_within"),
            "docs_longer",
            within.alias("tokens_within"),
            (within + F.col("n_tokens") * F.col("docs_longer")).alias("truncated_total"),
            "docs_total",
            "tokens_total",
            ((F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total")).alias("quantile"),
        )
    )

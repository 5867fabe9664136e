"""Best-fit packing of documents into sequences with several capacities at once.

A sequence has room for tokens, documents and attention cost (the sum of squared lengths, as a
document attends to itself only). Pieces are placed longest first. Among the open sequences
that have room for a piece in every respect, the one that fits best is taken: by the smallest
weighted norm of what would be left, or by the largest weighted dot product of what is left
and what the piece needs, all in shares of the capacities.

Pieces are stored, so that texts are encoded once, and spread over groups of a few thousand by
hash; a group is packed by one task, so any number of documents can be packed; a group leaves a
sequence or two partly filled. Equal pieces of repeated rows are numbered before they are spread.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import written
from roadstream.llm.tokens import END, VOCABULARY, encoder, vocabulary_path

TOKENS = 1024
GROUP_ROWS = 4096
COPIES = 1 << 16  # numbers of equal pieces that a row holds at a time

PIECES = "piece int, start long, length long, ids_crc32 long"


def capacities(tokens: int = TOKENS) -> tuple[float, float, float]:
    """The loosest limits on documents and attention cost that a sequence of ``tokens`` can reach,
    so that the tokens decide."""
    return float(tokens), float(tokens), float(tokens) ** 2


def best_fit(
    sizes: np.ndarray,
    capacity: tuple[float, float, float],
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of pieces of the given lengths, in descending order.

    ``rule`` is "norm" or "dot". A piece that no empty sequence can hold raises ValueError.
    """
    full = np.array(capacity)
    sequence = np.empty(len(sizes), dtype=np.int64)
    offset = np.empty(len(sizes), dtype=np.int64)
    room = np.empty((max(len(sizes), 1), 3))  # of open sequences, compacted
    number = np.empty(max(len(sizes), 1), dtype=np.int64)
    used = opened = 0
    least = sizes[-1] if len(sizes) else 0
    weight = np.array(weights) / full**2
    for i, size in enumerate(sizes.tolist()):
        need = np.array([size, 1.0, float(size) ** 2])
        if (need > full).any():
            raise ValueError(f"a piece of {size} tokens exceeds the capacity of a sequence")
        best = -1
        if used:
            left = room[:used] - need
            fits = np.flatnonzero((left >= 0).all(axis=1))
            if len(fits):
                if rule == "dot":
                    best = fits[np.argmax(room[fits] @ (weight * need))]
                else:
                    best = fits[np.argmin(left[fits] ** 2 @ weight)]
        if best < 0:
            best = used
            room[used], number[used] = full, opened
            used, opened = used + 1, opened + 1
        sequence[i] = number[best]
        offset[i] = full[0] - room[best, 0]
        room[best] -= need
        if room[best, 0] < least or room[best, 1] < 1:  # nothing more can go in
            used -= 1
            room[best], number[best] = room[used], number[used]
    return sequence, offset


def pieces_of(ids_length: int, most: int) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than ``most``."""
    first = ids_length % most or most
    yield 0, first
    for start in range(first, ids_length, most):
        yield start, most


def cut(docs: DataFrame, *, most: int = TOKENS, vocabulary: str = VOCABULARY) -> DataFrame:
    """Every document's pieces: doc_id, piece, start, length, ids_crc32."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary_path(vocabulary))
        for batch in batches:
            out = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = np.array([*encode(text), END], dtype="<u4")
                for piece, (start, length) in enumerate(pieces_of(len(ids), most)):
                    crc = zlib.crc32(ids[start : start + length].tobytes())
                    out.append((doc_id, piece, start, length, crc))
            frame = pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            frame["doc_id"] = frame["doc_id"].astype("Int64")
            yield frame

    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    return texts.mapInPandas(run, f"doc_id long, {PIECES}")


def numbered(pieces: DataFrame, most: int = COPIES) -> DataFrame:
    """``pieces`` with column ``copy``, which numbers equal ones from 0. They are counted, with
    map-side combine, and made again from the count, so that none of them need meet."""
    counted = pieces.groupBy(*pieces.columns).agg(F.count("*").alias("n"))
    begin = F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(most).cast("long"))
    begun = counted.withColumn("begin", F.explode(begin))
    end = F.least(F.col("begin") + most, F.col("n")) - 1
    return begun.select(*pieces.columns, F.explode(F.sequence("begin", end)).alias("copy"))


def pack(
    docs: DataFrame,
    *,
    capacity: tuple[float, float, float] | None = None,
    weights: tuple[float, float, float] = (1.0, 0.02, 0.02),
    rule: str = "norm",
    most: int = TOKENS,
    vocabulary: str = VOCABULARY,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``docs`` has doc_id and text. A null or empty text is a document of the closing token alone.
    Documents longer than ``most`` are cut; the first piece may be shorter. Repeated rows are
    documents of their own, dealt to groups like any others. An empty table gives no rows.
    Sequence numbers are unique, the same on every run, and have gaps. By default the limits on
    documents and attention cost are the loosest possible, so that the tokens decide.
    """
    limits = capacity or capacities(most)
    pieces, _ = written(cut(docs, most=most, vocabulary=vocabulary))
    groups = max(1, -(-pieces.count() // group_rows))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]
        )
        sequence, offset = best_fit(frame["length"].to_numpy(), limits, weights, rule)
        group = int(frame["group"].iloc[0]) if len(frame) else 0
        return frame.drop(columns=["copy", "group"]).assign(
            sequence_id=sequence + (group << 32), offset=offset
        )

    dealt = F.xxhash64("doc_id", "piece", "ids_crc32", "copy")
    spread = F.pmod(dealt, F.lit(groups)).cast("int")
    return (
        numbered(pieces)
        .withColumn("group", spread)
        .groupBy("group")
        .applyInPandas(run, f"doc_id long, {PIECES}, sequence_id long, offset long")
    )

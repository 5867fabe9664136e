"""Document fingerprints: the k smallest distinct shingle hashes of a text.

Two fingerprints of parts merge into the fingerprint of the whole. The k smallest of a union
are a uniform sample of it, so the share of them that both texts hold estimates resemblance;
how dense they lie estimates the number of distinct shingles; both together containment. With
fewer than k distinct shingles everything is exact.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import slices
from roadstream.llm.shingles import WIDTH, shingle_hashes

K = 128
ROWS_A_BUCKET = 1 << 15
LEAST_BUCKETS, MOST_BUCKETS = 32, 10_000


def sketch(hashes: np.ndarray, k: int = K) -> np.ndarray:
    return np.unique(hashes)[:k]


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    return np.union1d(a, b)[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    return float(len(a)) if len(a) < k else (k - 1) * 2.0**64 / float(a[-1])


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the distinct shingles of either text that both have; two texts without
    any are alike."""
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.count_nonzero(both <= union[-1])) / len(union)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the distinct shingles of ``a`` that ``b`` has too; 1 if it has none."""
    own = distinct_shingles(a, k)
    if not own:
        return 1.0
    shared = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    return min(1.0, shared / own)


def as_text(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), dtype=">u8").astype(np.uint64)


def sketches(texts: list[str], k: int = K, width: int = WIDTH) -> Iterator[np.ndarray]:
    return (sketch(hashes, k) for hashes in shingle_hashes(texts, width))


def fingerprints(
    docs: DataFrame, *, id_column: str = "doc_id", text: str = "text", k: int = K
) -> DataFrame:
    """doc_id, fingerprint, n_shingles (distinct, estimated). A null text counts as empty; texts
    without words have an empty fingerprint; repeated rows give repeated rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made = list(sketches([t or "" for t in batch.column("text").to_pylist()], k))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([as_text(a) for a in made], pa.string()),
                    pa.array([distinct_shingles(a, k) for a in made], pa.float64()),
                ],
                names=["doc_id", "fingerprint", "n_shingles"],
            )

    chosen = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))
    kind = chosen.schema["doc_id"].dataType.simpleString()
    return chosen.mapInArrow(run, f"doc_id {kind}, fingerprint string, n_shingles double")


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text, next_text: the text that follows by ascending doc_id, the first after the
    last. Ids are cut into buckets at approximate quantiles; only the ends of buckets, one row
    each, need a look beyond their own bucket. Null ids come first; equal ids by hash of text."""
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = texts.count()
    buckets = min(max(rows // ROWS_A_BUCKET, LEAST_BUCKETS), MOST_BUCKETS)
    steps = [i / buckets for i in range(1, buckets)]
    bounds = texts.agg(F.percentile_approx("doc_id", steps, 20_000)).first()[0] or []
    cuts = np.unique(np.array(bounds, dtype=np.int64))

    @F.pandas_udf("int")
    def bucket_of(ids: pd.Series) -> pd.Series:
        known = ids.notna().to_numpy()
        found = np.full(len(ids), -1, dtype=np.int32)
        found[known] = np.searchsorted(cuts, ids[known].to_numpy(np.int64))
        return pd.Series(found)

    ids = texts.select(bucket_of("doc_id").alias("bucket"), "doc_id", "text")
    firsts = ids.groupBy("bucket").agg(F.min("doc_id").alias("first_id"))
    order = Window.orderBy("bucket")  # over one row a bucket
    around = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pairs = firsts.select(
        F.col("bucket").alias("before"),
        F.coalesce(F.lead("bucket").over(order), F.first("bucket").over(around)).alias("bucket"),
    )
    heads = (
        ids.join(F.broadcast(firsts), "bucket")  # at most MOST_BUCKETS rows of two numbers
        .where(F.col("doc_id").eqNullSafe(F.col("first_id")))
        .groupBy("bucket")
        .agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("head"))
        .join(pairs, "bucket")
        .select(F.col("before").alias("bucket"), "head")
    )
    inside = Window.partitionBy("bucket").orderBy("doc_id", F.xxhash64("text"), "text")
    return (
        ids.withColumn("following", F.lead("text").over(inside))
        .join(heads, "bucket")
        .select("doc_id", "text", F.coalesce("following", "head").alias("next_text"))
    )


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, n_shingles double, "
    "edited_contained double"
)
EDITED_NAMES = [part.split()[0] for part in EDITED.split(", ")]


def edit_probe(docs: DataFrame, *, k: int = K) -> DataFrame:
    """Fingerprints of every text and of the text whose last quarter is replaced by the start of
    the next document, with their resemblance to each other and to the next document's.

    A null text counts as empty. A table of one row is its own successor; an empty table gives
    no rows; repeated rows follow each other.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            following = batch.column("next_text").to_pylist()
            known = dict(zip(texts, sketches(texts, k), strict=True))
            # Most successors are rows of the same batch.
            other = [t for t in dict.fromkeys(following) if t not in known]
            known.update(zip(other, sketches(other, k), strict=True))
            edited = [
                t[: len(t) - len(t) // 4] + f[: len(t) // 4]
                for t, f in zip(texts, following, strict=True)
            ]
            own = [known[t] for t in texts]
            after = [known[f] for f in following]
            new = list(sketches(edited, k))
            columns = [
                batch.column("doc_id"),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(e.encode()).hexdigest() for e in edited]),
                pa.array([as_text(a) for a in own]),
                pa.array([as_text(a) for a in new]),
                pa.array([resemblance(a, b, k) for a, b in zip(own, new, strict=True)]),
                pa.array([resemblance(a, b, k) for a, b in zip(own, after, strict=True)]),
                pa.array([distinct_shingles(a, k) for a in own]),
                pa.array([containment(b, a, k) for a, b in zip(own, new, strict=True)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=EDITED_NAMES)

    return with_next(docs).mapInArrow(run, EDITED)

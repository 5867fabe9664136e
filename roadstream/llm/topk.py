"""Exact top-k by inner product: columnar branch and bound.

Vectors become blocks in vertical layout (one row of the array per dimension). A query adds up
a few dimensions at a time for all candidates of a block. What the remaining dimensions can
still add or take away is at most the product of the norms of both remainders, so a candidate
whose upper bound lies below the k-th best lower bound is dropped, and the survivors are
compacted before the next dimensions. The scores that remain are exact integers.

Candidates are dealt to shards of a bounded number of components, and every block of queries
visits every shard once: a task reads the blocks of a shard and then lets the queries stream
past. A query takes the k-th best score of the blocks behind it to the next, so that later blocks
lose most candidates after a few dimensions. Only the k best of a (query, shard) leave the task.
Neither side is broadcast or gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import as_integers, is_finite_vector, largest, whole_numbers
from roadstream.llm.negatives import sortable

K = 10
SCALE = 1024
BLOCK = 4096
QUERY_BLOCK = 256
DIMENSIONS = 8  # added up between two prunings
SHARD_COMPONENTS = 1 << 23  # of the candidates that one task holds: 64 MB as doubles

# Rows of one shard, width and range: candidates, or queries.
BLOCKS = (
    "shard int, asking boolean, width int, n int, ids binary, keys binary, copies binary, "
    "columns binary"
)
# A score beyond 64 bits has the nearest long as score; digits and text then put it in order.
FOUND = (
    "query_id long, query_key long, query_copies long, vec_id long, score long, digits int, "
    "text string"
)
NAMES = {shape: [f.split()[0] for f in shape.split(", ")] for shape in (BLOCKS, FOUND)}
# Sums below these bounds are exact as doubles and as 64-bit integers.
AS_DOUBLE, AS_LONG = 2.0**52, 2.0**62


def _blocks(rows: int, asking: bool):
    """Rows of (shard, vec_id, key, copies, embedding) to BLOCKS of at most ``rows`` vectors. Vectors
    with components too large for sums of doubles get blocks of their own, so that they do not
    slow down the others."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            width = batch["embedding"].map(len).rename("width")
            most = batch["embedding"].map(largest) * SCALE
            reach = [np.searchsorted([AS_DOUBLE, AS_LONG], m * m * w) for m, w in zip(most, width, strict=True)]
            by = [batch["shard"], width, pd.Series(reach, batch.index, name="reach")]
            for (shard, wide, _), group in batch.groupby(by, sort=True):
                for at in range(0, len(group), rows):
                    part = group.iloc[at : at + rows]
                    values = np.stack(part["embedding"].to_numpy()).astype("<f8")
                    numbers = [part[c].to_numpy("<i8").tobytes() for c in ("vec_id", "key", "copies")]
                    columns = np.ascontiguousarray(values.T).tobytes()
                    out.append((shard, asking, wide, len(part), *numbers, columns))
            yield pd.DataFrame(out, columns=NAMES[BLOCKS])

    return blocks


def _remainders(columns: np.ndarray, step: int) -> np.ndarray:
    """Norm of what each vector still has from dimension 0, step, 2 * step, ... on."""
    if not len(columns):
        return np.zeros((0, columns.shape[1]))
    squares = columns.astype(np.float64) ** 2
    sums = np.add.reduceat(squares, np.arange(0, len(columns), step), axis=0)
    return np.sqrt(sums[::-1].cumsum(axis=0)[::-1])


@dataclass
class Block:
    """Vectors in vertical layout; ``remainder`` is there if sums of their like are doubles."""

    ids: np.ndarray
    keys: np.ndarray
    copies: np.ndarray
    columns: np.ndarray
    most: float
    remainder: np.ndarray | None

    @staticmethod
    def read(row) -> Block:
        numbers = [np.frombuffer(x, "<i8") for x in (row.ids, row.keys, row.copies)]
        columns = whole_numbers(np.frombuffer(row.columns, "<f8").reshape(row.width, row.n), SCALE)
        most = largest(columns)
        bounded = most * most * row.width < AS_DOUBLE
        return Block(*numbers, columns, most, _remainders(columns, DIMENSIONS) if bounded else None)


def best_of_block(
    query: np.ndarray, block: Block, copies: np.ndarray, k: int, floor: float, step: int = DIMENSIONS
) -> tuple[np.ndarray, np.ndarray]:
    """Places and scores of the ``k`` best of a block, ties by id, of which ``copies`` are left and
    that reach ``floor``, in the number type of the query."""
    alive = np.flatnonzero(copies > 0)
    total = np.zeros(len(alive), dtype=query.dtype)
    pruned = query.dtype == np.float64 and block.remainder is not None
    mine = _remainders(query[:, None], step)[:, 0] if pruned else np.zeros(0)
    columns = block.columns if pruned else _typed(block.columns, query.dtype)
    for i, at in enumerate(range(0, len(query), step)):
        part = columns[at : at + step]
        part = part if len(alive) == part.shape[1] else part[:, alive]
        total = total + query[at : at + step].dot(part)
        if not pruned or i + 1 == len(mine):
            continue
        # A little wider than computed, so that rounding drops nobody.
        slack = mine[i + 1] * block.remainder[i + 1][alive] * (1 + 1e-9) + 1e-6
        least = floor
        if len(alive) > k:
            least = max(least, np.partition(total - slack, len(alive) - k)[len(alive) - k])
        stay = total + slack >= least
        if not stay.all():
            alive, total = alive[stay], total[stay]
    order = np.lexsort((block.ids[alive], -total))[:k]
    return alive[order], total[order]


def _typed(columns: np.ndarray, kind: np.dtype) -> np.ndarray:
    return as_integers(columns) if kind == object else columns.astype(kind)


def _search(k: int):
    """Streams the BLOCKS of some shards, candidates first, to the FOUND of every query."""

    def best(queries: Block, i: int, blocks: list[Block]) -> list[tuple]:
        """(score, vec_id, copies) of the best of the blocks, better ones first."""
        held: list[tuple] = []
        vectors: dict[np.dtype, np.ndarray] = {}
        for block in blocks:
            reach = queries.most * block.most * len(queries.columns)
            kind = np.dtype(float if reach < AS_DOUBLE else np.int64 if reach < AS_LONG else object)
            if kind not in vectors:
                vectors[kind] = _typed(queries.columns[:, i], kind)
            # Other rows: one copy fewer of the query's own.
            own = (block.keys == queries.keys[i]) & (block.ids == queries.ids[i])
            copies = block.copies - own
            floor = held[-1][0] if len(held) == k else -np.inf
            floor = float(min(max(floor, -AS_LONG), AS_LONG))  # far beyond every sum of doubles
            places, scores = best_of_block(vectors[kind], block, copies, k, floor)
            found = zip(map(int, scores), block.ids[places].tolist(), copies[places].tolist(), strict=True)
            held = sorted([*held, *found], key=lambda r: (-r[0], r[1]))[:k]
        return held

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.shard != shard:
                    shard, held = row.shard, {}
                block = Block.read(row)
                if not row.asking:
                    held.setdefault(row.width, []).append(block)
                    continue
                out = [
                    (block.ids[i], block.keys[i], block.copies[i], vec_id, *sortable(score))
                    for i in range(row.n)
                    for score, vec_id, copies in best(block, i, held.get(row.width, []))
                    for _ in range(min(copies, k))
                ]
                if out:
                    yield pd.DataFrame(out, columns=NAMES[FOUND])

    return search


def top_k(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    k: int = K,
    block: int = BLOCK,
    query_block: int = QUERY_BLOCK,
    shard_components: int = SHARD_COMPONENTS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` candidates with the largest inner product.

    Both inputs have vec_id and embedding; queries are rows of ``vectors``. Components count as
    floor(1024 * x). A vector that is null, has no id, or has a null or non-finite component takes
    no part; empty vectors meet each other with score 0. Candidates are all rows but the query's
    own that have as many components as the query; fewer than ``k`` are returned if there are
    fewer. Ties go to the smaller vec_id. Rows of one id, or repeated in full, are rows of their own,
    as candidates and as queries, each answered by itself. Scores are exact for components of
    any size; one beyond 64 bits ranks as it should and is returned as null. Empty tables give no
    rows.
    """
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        # Copies of a row are one row with a count, so that no group of them fills a shard.
        fine = F.col("vec_id").isNotNull() & is_finite_vector(F.col("embedding"))
        rows = df.where(fine).select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
        whole = rows.groupBy("vec_id", "embedding").agg(F.count("*").alias("copies"))
        return whole.withColumn("key", F.xxhash64("vec_id", "embedding"))

    rows, components = vectors.agg(
        F.count("embedding"), F.coalesce(F.sum(F.size("embedding").cast("long")), F.lit(0))
    ).first()
    tasks = 2 * spark.sparkContext.defaultParallelism
    shards = max(1, -(-components // shard_components), min(tasks, -(-rows // block)))
    columns = ["shard", "vec_id", "key", "copies", "embedding"]
    held = (
        usable(vectors)
        .withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int"))
        .repartitionById(shards, F.col("shard"))
        .sortWithinPartitions("shard")
        .select(*columns)
        .mapInPandas(_blocks(block, False), BLOCKS)
    )
    asked = (
        usable(queries)
        .withColumn("shard", F.lit(0))
        .select(*columns)
        .mapInPandas(_blocks(query_block, True), BLOCKS)
        .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    )
    dealt = held.unionByName(asked).repartitionById(shards, F.col("shard"))
    found = dealt.sortWithinPartitions("shard", "asking").mapInPandas(_search(k), FOUND)
    order = [F.desc("score"), F.desc("digits"), F.desc("text"), "vec_id"]
    best = Window.partitionBy("query_id", "query_key").orderBy(*order)
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    # A repeated query row asks as often as it is there.
    again = F.explode(F.sequence(F.lit(1), F.col("query_copies")))
    return ranked.withColumn("copy", again).select(
        "query_id", "rank", "vec_id", F.when(F.col("digits") == 0, F.col("score")).alias("score")
    )


SQL = f"""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding,
      lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, coalesce(list_sum(
      list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])), 0) AS score
  FROM usable q JOIN usable c ON len(q.v) = len(c.v) AND q.r <> c.r
  WHERE q.vec_id % 100 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank
  FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, TRY_CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= {K}
"""

"""Vector code compression: product codes with active-entry Lloyd rounds.

Vectors are cut into consecutive parts, every part position has a codebook, and a part is coded
as the index of its nearest entry. A round assigns all parts and replaces every entry by the
rounded-down mean of its parts.

Between two rounds a part keeps the entry it had and the exact distance to it. If that entry did
not move, it is still nearer than (or as near as, with a smaller index) every other entry that
did not move, so only the moved entries are compared, against the stored distance. Parts whose
entry moved are compared with all entries.

A round is one pass over a stored table of vectors, codes and distances: it writes the table of
the next round and, on one row of every batch, the sums of the parts of each entry. Those are
added up by Spark; only the codebooks (entries x components numbers) pass through the driver.
All numbers are whole and exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import (
    as_integers,
    discard,
    is_finite_vector,
    largest,
    whole_numbers,
    written,
)

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
ROWS = 2048  # parts compared at a time

LIMB = 31  # bits of a sum that travel in one number, so that Spark's sums of them fit in a long
UNSTORED = -1  # in place of a distance beyond 64 bits; such a part is compared with all entries
LONG = (1 << 63) - 1

TALLY = pa.struct([("cell", pa.int32()), ("limb", pa.int32()), ("value", pa.int64())])


def cuts(width: int, parts: int) -> list[tuple[int, int]]:
    """Begin and end of every part; equal if ``parts`` divides ``width``."""
    return [(p * width // parts, (p + 1) * width // parts) for p in range(parts)]


def comparable(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles if doubles hold every distance exactly, else as Python integers."""
    top = max(largest(parts), largest(entries))
    if 4.0 * max(parts.shape[1], 1) * top * top < 2.0**53:
        return parts.astype(np.float64), entries.astype(np.float64)
    return as_integers(parts), as_integers(entries)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each part's nearest entry, the lowest of several, and the squared distance."""
    own, other = (parts * parts).sum(axis=1), (entries * entries).sum(axis=1)
    gaps = own[:, None] - 2 * parts.dot(entries.T) + other
    index = gaps.argmin(axis=1)
    return index, gaps[np.arange(len(parts)), index]


def reassigned(
    parts: np.ndarray,
    entries: np.ndarray,
    moved: np.ndarray,
    index: np.ndarray,
    distance: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """``nearest``, from what it was before the entries marked in ``moved`` moved."""
    index, distance = index.copy(), distance.astype(parts.dtype)
    again = moved[index] | (distance < 0)
    fixed, active = np.flatnonzero(~again), np.flatnonzero(moved)
    if len(fixed) and len(active):
        place, gap = nearest(parts[fixed], entries[active])
        place = active[place]
        held = distance[fixed]
        closer = (gap < held) | ((gap == held) & (place < index[fixed]))
        index[fixed[closer]], distance[fixed[closer]] = place[closer], gap[closer]
    rows = np.flatnonzero(again)
    if len(rows):
        index[rows], distance[rows] = nearest(parts[rows], entries)
    return index, distance


def longs(values: np.ndarray) -> np.ndarray:
    """Distances as 64-bit numbers, UNSTORED where they do not fit."""
    if values.dtype != object:
        return values.astype(np.int64)
    return np.array([x if x <= LONG else UNSTORED for x in values.tolist()], dtype=np.int64)


def part_sums(parts: np.ndarray, index: np.ndarray, entries: int) -> np.ndarray:
    """Per entry the number of its parts and the sums of their components."""
    made = np.zeros((entries, parts.shape[1] + 1), dtype=object)
    made[:, 0] = np.bincount(index, minlength=entries)
    for i in range(parts.shape[1]):
        column = parts[:, i]
        if column.dtype != object and largest(column) * len(column) < 2.0**53:
            made[:, i + 1] = np.bincount(index, weights=column, minlength=entries)
        else:
            np.add.at(made[:, i + 1], index, as_integers(column))
    return as_integers(made)


def limbs(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cell, limb, value) of whole numbers: their digits to the base 2**LIMB, signed, without
    zeros."""
    place = np.flatnonzero(cells != 0)
    left = cells[place]
    sign = np.where(left < 0, -1, 1)
    left = abs(left)
    out = []
    limb = 0
    while len(place):
        digit = (left & ((1 << LIMB) - 1)).astype(np.int64) * sign
        some = digit != 0
        out.append((place[some], np.full(some.sum(), limb), digit[some]))
        left = left >> LIMB
        more = (left != 0).astype(bool)
        place, left, sign, limb = place[more], left[more], sign[more], limb + 1
    columns = zip(*out, strict=True) if out else [[np.zeros(0, dtype=np.int64)]] * 3
    return tuple(np.concatenate(c) for c in columns)


def _table(batch: pa.RecordBatch, name: str, width: int, kind) -> np.ndarray:
    """A list column of ``width`` numbers a row as an array."""
    values = batch.column(name).flatten().to_numpy(zero_copy_only=False)
    return values.astype(kind, copy=False).reshape(batch.num_rows, width)


def _pass(books: list[np.ndarray], moved: list[np.ndarray] | None, scale: int, last: bool):
    """One assignment of all parts. Without ``moved`` no part has an entry yet. The last pass gives
    the code and the error of every vector, the others the next table and its sums."""
    spans = cuts(sum(b.shape[1] for b in books), len(books))
    width = spans[-1][1]

    def assign(parts, p, index, distance):
        # A few thousand parts at a time: they meet every entry.
        done = []
        for at in range(0, len(parts), ROWS):
            here = slice(at, at + ROWS)
            some, entries = comparable(parts[here], books[p])
            if moved is None:
                done.append(nearest(some, entries))
            else:
                done.append(reassigned(some, entries, moved[p], index[here], distance[here]))
        if len({d.dtype for _, d in done}) > 1:
            done = [(i, as_integers(d)) for i, d in done]
        return tuple(np.concatenate(c) for c in zip(*done, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            if not rows:
                continue
            vectors = whole_numbers(_table(batch, "vector", width, np.float64), scale)
            held = [None] * 2
            if moved is not None:
                held = [
                    _table(batch, "code", len(books), np.int64),
                    _table(batch, "distances", len(books), np.int64),
                ]
            codes, distances, sums = [], [], []
            for p, (begin, end) in enumerate(spans):
                parts = vectors[:, begin:end]
                before = [h if h is None else h[:, p] for h in held]
                index, distance = assign(parts, p, *before)
                codes.append(index)
                distances.append(distance)
                if not last:
                    sums.append(part_sums(parts, index, len(books[p])).ravel())
            kept = [batch.column("vec_id"), batch.column("label")]
            if last:
                text = np.stack(codes, axis=1).astype(np.uint8).tobytes().hex()
                size = 2 * len(books)
                code = [text[at : at + size] for at in range(0, rows * size, size)]
                total = sum(as_integers(d) for d in distances)
                error = [x if x <= LONG else None for x in total.tolist()]
                made = {"code": pa.array(code, pa.string()), "error": pa.array(error, pa.int64())}
            else:
                tally = pa.StructArray.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(limbs(np.concatenate(sums)), TALLY, strict=True)],
                    fields=list(TALLY),
                )
                ends = np.full(rows + 1, len(tally), dtype=np.int32)
                ends[0] = 0  # all of it on the first row
                every = np.arange(0, rows * len(books) + 1, len(books), dtype=np.int32)
                numbers = [np.stack(codes, axis=1), np.stack([longs(d) for d in distances], axis=1)]
                made = {
                    "vector": batch.column("vector"),
                    "code": pa.ListArray.from_arrays(every, pa.array(numbers[0].ravel(), pa.int16())),
                    "distances": pa.ListArray.from_arrays(every, pa.array(numbers[1].ravel())),
                    "tally": pa.ListArray.from_arrays(ends, tally),
                }
            yield pa.RecordBatch.from_arrays(
                [*kept, *made.values()], names=["vec_id", "label", *made]
            )

    return run


def first_entries(kept: DataFrame, parts: int, entries: int, scale: int) -> list[np.ndarray]:
    """A codebook for every part position: that part of the first ``entries`` vectors."""
    order = [F.col("vec_id").asc_nulls_last(), "vector"]

    def first(some: DataFrame) -> list[list]:
        return [list(row["vector"]) for row in some.orderBy(*order).limit(entries).collect()]

    rows = first(kept)
    if not rows:
        return []
    width = len(rows[0])
    if any(len(r) != width for r in rows):
        rows = first(kept.where(F.size("vector") == width))
    made = whole_numbers(np.array(rows, dtype=np.float64).reshape(len(rows), width), scale)
    return [as_integers(made[:, begin:end]) for begin, end in cuts(width, parts)]


def next_entries(state: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The rounded-down means of the parts of each entry; an entry without parts stays."""
    sums = state.select(F.explode("tally").alias("t")).groupBy("t.cell", "t.limb")
    total = [np.zeros(b.shape[0] * (b.shape[1] + 1), dtype=object) for b in books]
    ends = np.cumsum([len(t) for t in total])
    flat = np.concatenate(total)
    for cell, limb, value in sums.agg(F.sum("t.value")).collect():  # bounded by the codebooks
        flat[cell] += value << (LIMB * limb)
    made = []
    for book, cells in zip(books, np.split(flat, ends[:-1]), strict=True):
        table = as_integers(cells).reshape(book.shape[0], book.shape[1] + 1)
        new = book.copy()
        used = np.flatnonzero(table[:, 0] != 0)
        new[used] = table[used, 1:] // table[used, :1]
        made.append(new)
    return made


@dataclass(frozen=True)
class Compressed:
    """rows: vec_id, label, code, error of every vector; books: the final codebooks."""

    rows: DataFrame
    books: list[np.ndarray]


def compress(
    vectors: DataFrame,
    *,
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> Compressed:
    """Codes of ``vectors`` (vec_id, embedding, label), with their squared errors.

    Components count as floor(scale * x); scale is a power of two. Vectors that are null or hold a
    null or non-finite component are dropped. All others must have as many components as the
    one with the smallest vec_id; those that have not are dropped as well. Where ``parts`` does
    not divide that number, parts differ by one component; a part of none has distance 0. The
    codebooks start as the vectors of the smallest vec_ids (null last; rows that share an id
    count one by one, in the order of their vectors) and are smaller if there are fewer vectors.
    Repeated rows and null ids and labels are kept. Sums and comparisons are exact for
    components of any size; an error beyond 64 bits is null. At most 256 entries, so that a code
    is two hex digits a part. An empty table gives no rows and no codebooks.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of two hex digits tells at most 256 entries apart")
    spark = vectors.sparkSession
    kept = vectors.where(is_finite_vector(F.col("embedding"))).select(
        "vec_id", "label", F.col("embedding").alias("vector")
    )
    books = first_entries(kept, parts, entries, scale)
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    names = f"vec_id {kinds['vec_id']}, label {kinds['label']}"
    done = f"{names}, code string, error long"
    if not books:
        return Compressed(spark.createDataFrame([], done), [])
    width = sum(b.shape[1] for b in books)
    table = kept.where(F.size("vector") == width)
    between = (
        f"{names}, vector {kinds['vector']}, code array<smallint>, distances array<long>, "
        "tally array<struct<cell:int, limb:int, value:long>>"
    )
    moved, folder = None, None
    for _ in range(rounds):
        columns = ["vec_id", "label", "vector"] + ["code", "distances"] * (moved is not None)
        step = table.select(*columns).mapInArrow(_pass(books, moved, scale, False), between)
        table, made = written(step)
        if folder:
            discard(spark, folder)
        folder = made
        new = next_entries(table, books)
        moved = [(a != b).any(axis=1) for a, b in zip(new, books, strict=True)]
        books = new
    columns = ["vec_id", "label", "vector"] + ["code", "distances"] * (moved is not None)
    rows, _ = written(table.select(*columns).mapInArrow(_pass(books, moved, scale, True), done))
    if folder:
        discard(spark, folder)
    return Compressed(rows, books)


def book_text(books: list[np.ndarray]) -> str:
    """All integer components by part, entry and position, joined by commas."""
    return ",".join(str(x) for book in books for x in book.ravel().tolist())


def _sql() -> str:
    """The rounds one after the other, all distances in full."""
    steps = [
        f"""
kept AS MATERIALIZED (
  SELECT vec_id, label, embedding,
    row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding,
    lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT r, i * {PARTS} // len(embedding) AS part, i,
    CAST(floor({SCALE} * CAST(embedding[i + 1] AS DOUBLE)) AS BIGINT) AS x
  FROM kept, unnest(range(len(embedding))) AS places(i)),
book0 AS MATERIALIZED (SELECT part, i, r AS entry, x FROM cells WHERE r < {ENTRIES})"""
    ]
    for k in range(ROUNDS + 1):
        steps.append(
            f"""
gaps{k} AS (
  SELECT c.r, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x)) AS gap
  FROM cells c JOIN book{k} b ON c.part = b.part AND c.i = b.i GROUP BY ALL),
near{k} AS MATERIALIZED (
  SELECT r, part, min(gap * {ENTRIES} + entry) AS best FROM gaps{k} GROUP BY ALL)"""
        )
        if k < ROUNDS:
            steps.append(
                f"""
sums{k} AS (
  SELECT c.part, c.i, best % {ENTRIES} AS entry, sum(x) AS s, count(*) AS n
  FROM cells c JOIN near{k} a ON c.r = a.r AND c.part = a.part GROUP BY ALL),
book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.i, b.entry,
    CAST(coalesce((s - ((s % n) + n) % n) // n, b.x) AS BIGINT) AS x
  FROM book{k} b LEFT JOIN sums{k} m ON b.part = m.part AND b.i = m.i AND b.entry = m.entry)"""
            )
    return (
        "WITH "
        + ",".join(steps)
        + f""",
coded AS (
  SELECT r, string_agg(printf('%02x', best % {ENTRIES}), '' ORDER BY part) AS code,
    CAST(sum(best // {ENTRIES}) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY r),
digest AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, i)) AS sha
  FROM book{ROUNDS})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  sha AS codebooks_sha256
FROM kept JOIN coded USING (r) CROSS JOIN digest
"""
    )


SQL = _sql()

"""Hard-negative mining with score bounds along a spanning tree of anchors.

An anchor's positives are the best rows of its own label; for each of them, its hard negatives are
the best rows of other labels whose score lies in a window below the positive's score.

Anchors come in blocks, each with the minimum spanning tree of its vectors. Only the root is scored
against all candidates of a block. From a parent to its child the score of a candidate x
changes by at most the length of the edge times the norm of x, so the parent's scores, or bounds
of them, give bounds for the child. Candidates whose bounds cannot reach the window, or lie
below as many sure members of it as are asked for, are passed over; the others are scored
exactly, which makes their bounds tight for the next edge. Whole numbers: the scores that
decide are exact.

Candidates are dealt to shards by hash, and every block of anchors visits every shard once; a
task reads the candidates of a shard and then lets the anchors stream past. It does so twice:
for the positives, and, once their scores are known, for the negatives. Of each anchor (and
positive) only the best few of a shard leave the task.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import as_integers, is_finite_vector, largest, whole_numbers, written

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
WINDOW = (50, 95)  # percent of the positive's score that a negative may have
ANCHORS = 256  # in a tree
CANDIDATES = 4096  # compared with an anchor at a time
SHARD_ROWS = 1 << 16  # candidates that one task holds: 64 MB of 128 components

# Rows of one shard and width: candidates, or the anchors of a tree with the scores of their
# positives (JSON).
BLOCKS = (
    "shard int, anchors boolean, width int, n int, ids binary, labels binary, keys binary, "
    "copies binary, vectors binary, asked string"
)
# A score beyond 64 bits has the nearest long as score; digits and text then put it in order.
FOUND = (
    "anchor_id long, anchor_key long, anchor_copies long, place int, vec_id long, score long, "
    "digits int, text string"
)
LONG = (1 << 63) - 1
NAMES = {shape: [f.split()[0] for f in shape.split(", ")] for shape in (BLOCKS, FOUND)}
DIGITS, COMPLEMENT = "0123456789", "9876543210"


def sortable(score: int) -> tuple[int, int, str]:
    """(score, digits, text), which come in the order of the scores, however large."""
    if abs(score) < LONG:
        return score, 0, ""
    text = str(abs(score))
    if score > 0:
        return LONG, len(text), text
    return -LONG, -len(text), text.translate(str.maketrans(DIGITS, COMPLEMENT))


def score_text() -> Column:
    """The score of a row of FOUND in full."""
    below = F.concat(F.lit("-"), F.translate("text", DIGITS, COMPLEMENT))
    wide = F.when(F.col("digits") > 0, F.col("text")).otherwise(below)
    return F.when(F.col("digits") == 0, F.col("score").cast("string")).otherwise(wide)


@dataclass
class Tree:
    """An order in which every anchor follows its parent, the parents (-1 for the root) and the
    lengths of the edges."""

    order: list[int]
    parent: list[int]
    edge: list[float]
    children: list[int] = field(default_factory=list)

    def __post_init__(self):
        parents = np.array([p for p in self.parent if p >= 0], dtype=int)
        self.children = np.bincount(parents, minlength=len(self.parent)).tolist()


def spanning_tree(vectors: np.ndarray) -> Tree:
    """Prim's minimum spanning tree of the rows of ``vectors``, from the first."""
    n = len(vectors)
    squares = (vectors * vectors).sum(axis=1)
    apart = np.maximum(squares[:, None] - 2 * (vectors @ vectors.T) + squares, 0)
    gap, parent, out = apart[0].copy(), np.zeros(n, dtype=int), np.ones(n, dtype=bool)
    order, parent[0], out[0], edge = [0], -1, False, np.zeros(n)
    for _ in range(n - 1):
        best = int(np.where(out, gap, np.inf).argmin())
        order.append(best)
        out[best], edge[best] = False, np.sqrt(gap[best])
        closer = out & (apart[best] < gap)
        gap[closer], parent[closer] = apart[best][closer], best
    return Tree(order, parent.tolist(), edge.tolist())


def overlapping(
    low: np.ndarray, high: np.ndarray, among: np.ndarray, windows: list[tuple], k: int
) -> np.ndarray:
    """Candidates, of those ``among``, that can be one of the ``k`` best of a window
    (from, to, least): scores from ``from`` to ``to``, of which ``k`` of ``least`` or more are known
    already."""
    need = np.zeros(len(low), dtype=bool)
    for begin, end, least in windows:
        reach = among & (low <= end) & (high >= max(begin, least))
        sure = low[reach & (low >= begin) & (high <= end)]
        if len(sure) > k:
            reach &= high >= np.partition(sure, len(sure) - k)[len(sure) - k]
        need |= reach
    return np.flatnonzero(need)


@dataclass
class Rows:
    """Rows of one width: of the candidates of a shard, or the anchors of a tree."""

    ids: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    copies: np.ndarray
    vectors: np.ndarray

    @staticmethod
    def read(row, scale: int) -> Rows:
        columns = [np.frombuffer(x, "<i8") for x in (row.ids, row.labels, row.keys, row.copies)]
        vectors = np.frombuffer(row.vectors, "<f8").reshape(row.n, row.width)
        return Rows(*columns, whole_numbers(vectors, scale))

    def part(self, at: int, rows: int) -> Rows:
        here = slice(at, at + rows)
        return Rows(self.ids[here], self.labels[here], self.keys[here], self.copies[here], self.vectors[here])


class Best:
    """The ``k`` best (score, id, copies) so far in every window of an anchor."""

    def __init__(self, windows: list[tuple], k: int):
        self.windows, self.k = windows, k
        self.held: list[list[tuple]] = [[] for _ in windows]

    def open_windows(self) -> list[tuple]:
        return [
            (begin, end, held[-1][0] if len(held) == self.k else begin)
            for (begin, end), held in zip(self.windows, self.held, strict=True)
        ]

    def offer(self, scores: np.ndarray, ids: np.ndarray, copies: np.ndarray) -> None:
        for place, window in enumerate(self.windows):
            begin, end = map(clamped, window) if scores.dtype != object else window
            inside = np.flatnonzero((scores >= begin) & (scores <= end))
            if len(inside) > 4 * self.k:  # the best and all that tie with the last of them
                some = scores[inside]
                inside = inside[some >= np.sort(some)[-self.k]]
            if len(inside):
                numbers = (int(x) for x in scores[inside])
                new = zip(numbers, ids[inside].tolist(), copies[inside].tolist(), strict=True)
                joined = sorted([*self.held[place], *new], key=lambda r: (-r[0], r[1]))
                self.held[place] = joined[: self.k]


def clamped(score):
    """A score, moved into the range that doubles hold; what it is compared with lies well inside."""
    return min(max(score, -(2.0**60)), 2.0**60)


def visit(anchors: Rows, tree: Tree, candidates: Rows, best: list[Best], same_label: bool) -> int:
    """Offer a block of candidates to the anchors of a tree; how many pairs were scored."""
    scored = 0
    width = max(1, anchors.vectors.shape[1])
    bounded = max(largest(anchors.vectors), largest(candidates.vectors)) ** 2 * width < 2.0**50
    if bounded:  # then doubles hold every score exactly
        rows, asking = candidates.vectors.astype(np.float64), anchors.vectors.astype(np.float64)
        # A little longer than computed, so that rounding passes over nobody.
        norms = np.sqrt((rows * rows).sum(axis=1)) * (1 + 1e-9)
    else:
        rows, asking = as_integers(candidates.vectors), as_integers(anchors.vectors)
    kept: dict[int, tuple] = {}
    waiting = list(tree.children)
    for i in tree.order:
        among = (candidates.labels == anchors.labels[i]) == same_label
        copies = candidates.copies
        if same_label:  # other rows: one copy fewer of the anchor's own
            own = (candidates.keys == anchors.keys[i]) & (candidates.ids == anchors.ids[i])
            copies = copies - own
            among &= copies > 0
        windows = best[i].open_windows()
        parent = tree.parent[i]
        if bounded:
            windows = [tuple(map(clamped, w)) for w in windows]
        if bounded and parent >= 0:
            slack = norms * (tree.edge[i] * (1 + 1e-9)) + 1e-6
            low, high = kept[parent][0] - slack, kept[parent][1] + slack
            need = overlapping(low, high, among, windows, best[i].k)
            if 4 * len(need) > len(low):  # all of them cost no more
                low = high = rows @ asking[i]
                scores = low[need]
                scored += len(low)
            else:
                scores = rows[need] @ asking[i]
                low[need] = high[need] = scores
                scored += len(need)
        else:
            low = high = rows.dot(asking[i])
            need = overlapping(low, high, among, windows, best[i].k)
            scores = low[need]
            scored += len(low)
        best[i].offer(scores, candidates.ids[need], copies[need])
        if waiting[i]:
            kept[i] = (low, high)
        if parent >= 0:
            waiting[parent] -= 1
            if not waiting[parent]:
                del kept[parent]
    return scored


def percent_window(score: int, percent: tuple[int, int]) -> tuple[int, int]:
    """The scores s with low * score <= 100 * s <= high * score."""
    low, high = percent
    return -(-low * score // 100), high * score // 100


def _search(scale: int, k: int, percent: tuple[int, int] | None):
    """Streams the BLOCKS of some shards, candidates first, to the FOUND of every anchor: its best of
    the same label, or, with ``percent``, the best of other labels in the window of each positive."""

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held = None, {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                if row.shard != shard:
                    shard, held = row.shard, {}
                rows = Rows.read(row, scale)
                if not row.anchors:
                    held.setdefault(row.width, []).append(rows)
                    continue
                if largest(rows.vectors) ** 2 * max(1, row.width) < 2.0**50:
                    tree = spanning_tree(rows.vectors)
                else:
                    tree = Tree([*range(row.n)], [-1] * row.n, [])
                windows = [[(-np.inf, np.inf)]] * row.n
                if percent is not None:
                    asked = json.loads(row.asked)
                    windows = [[percent_window(score, percent) for score in a] for a in asked]
                best = [Best(w, k) for w in windows]
                for candidates in held.get(row.width, []):
                    for at in range(0, len(candidates.ids), CANDIDATES):
                        visit(rows, tree, candidates.part(at, CANDIDATES), best, percent is None)
                out = [
                    (rows.ids[i], rows.keys[i], rows.copies[i], place, vec_id, *sortable(score))
                    for i, found in enumerate(best)
                    for place, held_here in enumerate(found.held)
                    for score, vec_id, copies in held_here
                    for _ in range(min(copies, k))
                ]
                if out:
                    yield pd.DataFrame(out, columns=NAMES[FOUND])

    return search


def _blocks(rows: int, anchors: bool):
    """Rows to BLOCKS of at most ``rows`` of one shard and width."""

    def blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            width = batch["embedding"].map(len)
            for (shard, wide), group in batch.groupby([batch["shard"], width], sort=True):
                for at in range(0, len(group), rows):
                    part = group.iloc[at : at + rows]
                    values = np.stack(part["embedding"].to_numpy()).astype("<f8")
                    numbers = [
                        part[c].to_numpy("<i8").tobytes() for c in ("vec_id", "label", "key", "copies")
                    ]
                    asked = None
                    if "asked" in part:
                        asked = json.dumps([[int(x) for x in scores] for scores in part["asked"]])
                    out.append((shard, anchors, wide, len(part), *numbers, values.tobytes(), asked))
            yield pd.DataFrame(out, columns=NAMES[BLOCKS])

    return blocks


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: tuple[int, int] = WINDOW,
    scale: int = SCALE,
    tree_rows: int = ANCHORS,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``vectors`` has vec_id, label and embedding; ``anchor`` tells from vec_id which rows are anchors.
    Components count as floor(scale * x), scores are integer inner products with the anchor,
    higher first, ties by the smaller vec_id. An anchor's positives are its first ``positives``
    other rows of the same label. Of each, the first ``negatives`` rows of other labels are
    returned whose score lies within ``percent`` of the positive's score, both ends included; a
    negative positive score leaves no such rows. Fewer are returned where there are fewer.

    Rows without a vec_id or a label, or whose vector is null or holds a null or non-finite
    component, take no part; only vectors of as many components meet. Repeated rows are rows of
    their own, as anchors, positives and negatives; an id may stand for different rows. Scores
    are exact for components of any size; one beyond 64 bits is returned as null. An empty table
    gives no rows.
    """
    spark = vectors.sparkSession
    usable = vectors.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_finite_vector(F.col("embedding"))
    ).select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding")
    # Copies of a row are one row with a count, so that no group of them fills a shard.
    whole = usable.groupBy("vec_id", "label", "embedding").agg(F.count("*").alias("copies"))
    whole = whole.withColumn("key", F.xxhash64("vec_id", "label", "embedding"))
    rows, _ = written(whole.withColumn("anchor", F.coalesce(anchor, F.lit(False))))
    total, asking = rows.agg(F.count("*"), F.count_if("anchor")).first()
    tasks = 2 * spark.sparkContext.defaultParallelism
    shards = max(1, -(-total // shard_rows), min(tasks, -(-total // CANDIDATES)))

    columns = ["shard", "vec_id", "label", "key", "copies", "embedding"]
    spread = F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int")
    held = (
        rows.withColumn("shard", spread)
        .repartition(shards, "shard")
        .sortWithinPartitions("shard")
        .select(*columns)
        .mapInPandas(_blocks(CANDIDATES, False), BLOCKS)
    )
    trees = max(1, -(-asking // (4 * tree_rows)))
    near = ["label", "vec_id", "key"]  # anchors of one label are the most alike
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))

    def met(asked: DataFrame, k: int, window: tuple[int, int] | None) -> DataFrame:
        """The ``k`` best of each anchor, or of each window of an anchor, with their rank."""
        blocks = (
            asked.repartitionByRange(trees, *near)
            .sortWithinPartitions(*near)
            .withColumn("shard", F.lit(0))
            .select(*columns, *["asked"] * (window is not None))
            .mapInPandas(_blocks(tree_rows, True), BLOCKS)
            .withColumn("shard", every)
        )
        dealt = held.unionByName(blocks).repartition(shards, "shard")
        found = dealt.sortWithinPartitions("shard", "anchors").mapInPandas(
            _search(scale, k, window), FOUND
        )
        order = [F.desc("score"), F.desc("digits"), F.desc("text"), "vec_id"]
        best = Window.partitionBy("anchor_id", "anchor_key", "place").orderBy(*order)
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    anchors = rows.where("anchor")
    first, _ = written(met(anchors, positives, None).withColumn("exact", score_text()))
    lists = first.groupBy("anchor_id", "anchor_key").agg(
        F.sort_array(F.collect_list(F.struct("rank", "exact"))).alias("found")  # at most ``positives``
    )
    lists = lists.select(
        "anchor_id", "anchor_key", F.transform("found", lambda p: p["exact"]).alias("asked")
    )
    same = (F.col("vec_id") == F.col("anchor_id")) & (F.col("key") == F.col("anchor_key"))
    mined = met(anchors.join(lists, same), negatives, percent)
    score = F.when(F.col("digits") == 0, F.col("score"))
    pairs = first.select(
        "anchor_id",
        "anchor_key",
        (F.col("rank") - 1).alias("place"),
        F.col("vec_id").alias("positive_id"),
        score.alias("positive_score"),
    )
    # A repeated anchor row asks as often as it is there.
    again = F.explode(F.sequence(F.lit(1), F.col("anchor_copies")))
    return (
        mined.join(pairs, ["anchor_id", "anchor_key", "place"])
        .withColumn("copy", again)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            score.alias("negative_score"),
        )
    )


SQL = f"""
WITH usable AS (
  SELECT row_number() OVER () AS r, vec_id, embedding,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS (
  SELECT r, vec_id, label, i, len(embedding) AS width,
    CAST(floor({SCALE} * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM usable, unnest(range(1, len(embedding) + 1)) AS places(i)),
scored AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, a.label = b.label AS same, b.r AS b,
    b.vec_id AS vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM cells a JOIN cells b ON a.i = b.i AND a.width = b.width AND a.r <> b.r
  WHERE a.vec_id % 50 = 0 GROUP BY ALL),
positive AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= {POSITIVES}),
negative AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, n.vec_id AS negative_id,
    p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.vec_id) AS rank
  FROM positive p JOIN scored n ON p.a = n.a AND NOT n.same
    AND {WINDOW[0]} * p.score <= 100 * n.score AND 100 * n.score <= {WINDOW[1]} * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score,
  negative_score
FROM negative WHERE rank <= {NEGATIVES}
"""

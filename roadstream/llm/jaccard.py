"""Jaccard self-join on word shingles with Bayesian candidate pruning.

Texts with the same set of shingles are one text with copies. Texts that agree in one of the
bands of their MinHash values are candidates. Their values are compared a few at a time, and a
pair is dropped as soon as the posterior probability that its similarity reaches the threshold,
given the matches so far, is below a tolerance. Texts that survivors connect are brought
together once, and there every pair is decided on the shingle sets themselves.

No step emits pairs: a task that compares a block of texts with another reports, for candidates,
a spanning forest, and for verified links the number of links of each text and a spanning forest.
Buckets and groups of any size are cut into blocks, and every pair of blocks is a task's work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import ROW, checkpointed, packed, slices
from roadstream.llm.components import components
from roadstream.llm.shingles import WIDTH, U, mixed, shingle_hashes

THRESHOLD = 0.8
BANDS, ROWS = 32, 4  # a pair at the threshold shares no band once in 20 million
HASHES = BANDS * ROWS
LOOKS = (16, 32, 48, 64, 96, 128)  # MinHash values compared before each decision
TOLERANCE = 1e-7
BLOCK = 256  # texts of a bucket or group that are compared at once
PAIRS_AT_ONCE = 1 << 15
# Pairs of blocks are dealt to shards by hash; a shard has about so many rows, a text being a row
# in every pair of blocks it belongs to, or one pair of blocks.
ROWS_A_SHARD, TEXTS_A_SHARD = 16 * BLOCK, BLOCK
BUCKETS = 4096  # of hashed groups; a bucket gets slots in proportion to its members
STRIDE = 2048  # shingles hashed at once

_A = np.random.default_rng(11).integers(1, 1 << 63, HASHES, dtype=np.uint64) * U(2) + U(1)
_B = np.random.default_rng(12).integers(1, 1 << 63, HASHES, dtype=np.uint64)


def min_hashes(hashes: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a non-empty set."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), STRIDE):
        part = hashes[at : at + STRIDE, None] * _A + _B
        np.minimum(best, part.min(axis=0), out=best)
    return best


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 32-bit key a band."""
    rows = values.reshape(BANDS, ROWS)
    key = rows[:, 0]
    for i in range(1, ROWS):
        key = mixed(key) + rows[:, i]
    return (mixed(key) >> U(32)).astype("<u4")


def set_name(hashes: np.ndarray) -> bytes:
    """128 bits that stand for a sorted set."""
    place = np.arange(1, len(hashes) + 1, dtype=np.uint64)
    one = mixed(hashes + place).sum(dtype=np.uint64)
    two = mixed(hashes ^ mixed(place)).sum(dtype=np.uint64)
    return np.array([one, two], dtype=">u8").tobytes()


@lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For every look, the matches below which a pair is dropped.

    Values are compared by one byte, so a pair of similarity s matches with probability
    s + (1 - s) / 256. With all probabilities equally likely beforehand, the posterior after m of
    n matches is Beta(m + 1, n - m + 1); its tail above p is the chance that at most m of n + 1
    trials with probability p succeed.
    """
    p = threshold + (1 - threshold) / 256

    def posterior(m: int, n: int) -> float:
        return sum(
            math.comb(n + 1, i) * p**i * (1 - p) ** (n + 1 - i) for i in range(m + 1)
        )

    return tuple(
        next(m for m in range(n + 1) if posterior(m, n) >= tolerance) for n in LOOKS
    )


def survivors(
    a: np.ndarray, b: np.ndarray, pairs: np.ndarray, threshold: float, tolerance: float
) -> np.ndarray:
    """The pairs (row of a, row of b) that no look drops; a and b hold one-byte MinHash values."""
    found = np.zeros(len(pairs), dtype=np.int32)
    seen = 0
    for look, least in zip(LOOKS, least_matches(threshold, tolerance), strict=True):
        left, right = a[pairs[:, 0], seen:look], b[pairs[:, 1], seen:look]
        found = found + (left == right).sum(axis=1)
        stay = found >= least
        pairs, found, seen = pairs[stay], found[stay], look
    return pairs


def forest(n: int, pairs: np.ndarray) -> list[tuple[int, int]]:
    """Pairs that connect what all ``pairs`` of 0..n-1 connect, without a cycle."""
    parent = list(range(n))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in pairs.tolist():
        rx, ry = root(x), root(y)
        if rx != ry:
            parent[max(rx, ry)] = min(rx, ry)
            kept.append((x, y))
    return kept


SIGNED = "name binary, keys binary, values binary"


def signatures(width: int = WIDTH):
    """text -> set name, band keys and one-byte MinHash values; nulls for a text without words."""

    kinds = [pa.field(part.split()[0], pa.binary()) for part in SIGNED.split(", ")]

    @F.arrow_udf(SIGNED)
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            out: list[list] = [[], [], []]
            for part in slices([texts]):
                for hashes in shingle_hashes(part.to_pylist(), width):
                    made = (None, None, None)
                    if len(hashes):
                        held = np.unique(hashes)
                        values = min_hashes(held)
                        short = ((values >> U(16)) & U(255)).astype(np.uint8)
                        made = set_name(held), band_keys(values).tobytes(), short.tobytes()
                    for column, value in zip(out, made, strict=True):
                        column.append(value)
            yield pa.StructArray.from_arrays([pa.array(c, pa.binary()) for c in out], fields=kinds)

    return sign


def _with_sizes(members: DataFrame, group: str, counts: DataFrame) -> DataFrame:
    """The ``members`` whose group is in ``counts`` (group, n), with n.

    Groups are hashed into buckets, and a bucket gets as many slots as it holds times the average
    number of members of a bucket. A member goes to one slot, the sizes of its bucket's groups are
    in all of them, so that no group fills a task. Only the slots of the buckets are broadcast."""
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 1
    place = F.pmod(F.xxhash64(group, F.lit(5)), F.lit(BUCKETS)).cast("int")
    sized = counts.withColumn("place", place)
    share = F.sum("n") / F.lit(float(total))
    slots = sized.groupBy("place").agg(F.ceil(share * BUCKETS).cast("int").alias("slots"))
    every_slot = F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot")
    known = sized.join(F.broadcast(slots), "place").select(group, "n", every_slot)
    own = F.pmod(F.xxhash64("name", F.lit(7)), F.col("slots")).cast("int")
    dealt = members.withColumn("place", place).join(F.broadcast(slots), "place")
    dealt = dealt.select(*members.columns, own.alias("slot"))
    return dealt.join(known, [group, "slot"]).drop("slot")


def _in_block_pairs(members: DataFrame) -> DataFrame:
    """``members`` (with n, the size of their group) repeated for every pair (i, j) of the blocks
    of their group that has theirs. A group of one block has one pair."""
    placed = members.withColumn("blocks", _blocks(F.col("n")).cast("int"))
    placed = placed.withColumn("own", F.pmod(F.xxhash64("name", F.lit(3)), "blocks").cast("int"))
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    return (
        placed.withColumn("other", F.explode(others))
        .withColumn("i", F.least("own", "other"))
        .withColumn("j", F.greatest("own", "other"))
        .drop("other", "blocks", "n")
    )


def _blocks(n: Column) -> Column:
    return F.ceil(n / BLOCK)


def _shards(counts: DataFrame, rows: int) -> int:
    """How many shards hold about ``rows`` rows each of what _in_block_pairs makes of groups of
    the sizes n in ``counts``. It grows with the square of a group, as the rows do."""
    n = F.col("n").cast("long")
    total = counts.agg(F.sum(n * _blocks(n)).alias("rows")).first()["rows"] or 0
    return max(1, min(-(-total // rows), (1 << 31) - 1))


def _bounds(*columns: np.ndarray) -> list[tuple[int, int]]:
    """Begin and end of every run of rows that agree in all columns."""
    n = len(columns[0])
    new = np.ones(n, dtype=bool)
    new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    first = np.flatnonzero(new)
    return list(zip(first.tolist(), [*first[1:].tolist(), n], strict=True))


def _pairs_of(low: int, high: int, own: np.ndarray, i: int, j: int) -> np.ndarray:
    """The pairs of rows low..high that the pair of blocks (i, j) has to look at."""
    first = low + np.flatnonzero(own[low:high] == i)
    if i == j:
        x, y = np.triu_indices(len(first), 1)
        return np.stack([first[x], first[y]], axis=1)
    second = low + np.flatnonzero(own[low:high] == j)
    return np.stack([np.repeat(first, len(second)), np.tile(second, len(first))], axis=1)


def candidate_edges(
    texts: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE
) -> DataFrame:
    """Edges (a, b) between names of ``texts`` (name, keys, values, one row a name) that connect
    every pair that shares a band and that no look drops."""

    def words(at: int):
        return F.conv(F.hex(F.substring("keys", 4 * at + 1, 4)), 16, 10).cast("long")

    keyed = texts.select(
        "name",
        F.explode(F.array(*[words(i) + (i << 32) for i in range(BANDS)])).alias("bucket"),
    )
    counts = checkpointed(keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    members = _with_sizes(keyed, "bucket", counts).join(texts, "name")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bucket", "i", "j", "name"], ignore_index=True)
        keys = np.frombuffer(b"".join(frame["keys"]), "<u4").reshape(-1, BANDS)
        values = np.frombuffer(b"".join(frame["values"]), np.uint8).reshape(-1, HASHES)
        bucket, own = frame["bucket"].to_numpy(), frame["own"].to_numpy()
        i, j = frame["i"].to_numpy(), frame["j"].to_numpy()
        kept, waiting = [], []

        def decide() -> None:
            pairs = np.concatenate(waiting)
            # A pair belongs to the first band it shares.
            same = keys[pairs[:, 0]] == keys[pairs[:, 1]]
            pairs = pairs[same.argmax(axis=1) == bucket[pairs[:, 0]] >> 32]
            kept.append(survivors(values, values, pairs, threshold, tolerance))
            waiting.clear()

        for low, high in _bounds(bucket, i, j):
            waiting.append(_pairs_of(low, high, own, int(i[low]), int(j[low])))
            if sum(map(len, waiting)) >= PAIRS_AT_ONCE:
                decide()
        if waiting:
            decide()
        # Rows of one text are one node.
        names, node = np.unique(frame["name"].to_numpy(), return_inverse=True)
        edges = forest(len(names), node[np.concatenate(kept)] if kept else [])
        return pd.DataFrame(
            {"a": [names[x] for x, _ in edges], "b": [names[y] for _, y in edges]}, dtype=object
        )

    blocks = _in_block_pairs(members)
    shards = _shards(counts, ROWS_A_SHARD)
    shard = F.pmod(F.xxhash64("bucket", "i", "j"), F.lit(shards))
    return blocks.groupBy(shard.alias("shard")).applyInPandas(compare, "a binary, b binary")


def _common(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many shingles every one of ``first`` shares with every one of ``second``."""
    used = np.unique(np.concatenate([first, second]))
    every, places = np.unique(np.concatenate([sets[i] for i in used]), return_inverse=True)
    owner = np.repeat(np.arange(len(used)), [len(sets[i]) for i in used])
    at = {int(i): k for k, i in enumerate(used)}
    total = np.zeros((len(first), len(second)), dtype=np.float32)
    rows = [at[int(i)] for i in first], [at[int(i)] for i in second]
    for low in range(0, len(every), STRIDE):  # some columns at a time
        here = (places >= low) & (places < low + STRIDE)
        table = np.zeros((len(used), min(STRIDE, len(every) - low)), dtype=np.float32)
        table[owner[here], places[here] - low] = 1
        total += table[rows[0]] @ table[rows[1]].T
    return total


def verified(
    texts: DataFrame, counts: DataFrame, threshold: float = THRESHOLD, width: int = WIDTH
) -> DataFrame:
    """Of ``texts`` (root, n, name, text, copies), the n of a root as in ``counts``: rows (a, b,
    links, count), one for every edge of a spanning forest of the links within a pair of blocks,
    and, with null b, one for every text with its number of linked texts (links) and of their
    copies (count)."""

    def check(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["root", "i", "j", "name"], ignore_index=True)
        frame = frame.drop_duplicates(["root", "i", "j", "name"], ignore_index=True)
        names, copies = frame["name"].tolist(), frame["copies"].to_numpy()
        own, root = frame["own"].to_numpy(), frame["root"].to_numpy()
        i, j = frame["i"].to_numpy(), frame["j"].to_numpy()
        sets = [np.unique(h) for h in shingle_hashes(frame["text"].tolist(), width)]
        sizes = np.array([len(s) for s in sets], dtype=np.float64)
        out = []
        for low, high in _bounds(root, i, j):
            first = low + np.flatnonzero(own[low:high] == i[low])
            second = low + np.flatnonzero(own[low:high] == j[low])
            if not len(first) or not len(second):
                continue
            common = _common(sets, first, second).astype(np.float64)
            either = sizes[first][:, None] + sizes[second][None, :] - common
            # The quotient is rounded once, as in a plain comparison of both counts.
            linked = common / either >= threshold
            if i[low] == j[low]:
                np.fill_diagonal(linked, False)
            x, y = np.nonzero(linked)
            pairs = np.stack([first[x], second[y]], axis=1) - low
            for p, q in forest(high - low, pairs):
                out.append((names[low + p], names[low + q], 0, 0))
            sides = [(first, linked, copies[second])]
            if i[low] != j[low]:
                sides.append((second, linked.T, copies[first]))
            for here, table, there in sides:
                texts_linked, copies_linked = table.sum(axis=1), table @ there
                for p in np.flatnonzero(texts_linked).tolist():
                    out.append((names[here[p]], None, int(texts_linked[p]), int(copies_linked[p])))
        return pd.DataFrame(out, columns=["a", "b", "links", "count"])

    blocks = _in_block_pairs(texts)
    shards = _shards(counts, TEXTS_A_SHARD)
    shard = F.pmod(F.xxhash64("root", "i", "j"), F.lit(shards))
    return blocks.groupBy(shard.alias("shard")).applyInPandas(
        check, "a binary, b binary, links long, count long"
    )


def _keyed(docs: DataFrame, doc_id: str, text: str) -> list:
    """A document's id, a hash of its id and text, and the text without null."""
    ident, words = F.col(f"`{doc_id}`"), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    return [ident.alias("doc_id"), F.xxhash64(ident, words).alias("id_key"), words.alias("text")]


def similar_classes(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = THRESHOLD,
    tolerance: float = TOLERANCE,
    width: int = WIDTH,
) -> DataFrame:
    """Per row of ``docs``: doc_id, id_key, class_id, n_links, n_texts and stays.

    Two documents are linked if the Jaccard similarity of their sets of ``width``-word shingles
    is at least ``threshold``. class_id is the smallest doc_id among all documents that chains of
    links connect; n_links is the number of documents linked directly, copies included, and
    n_texts the number of different shingle sets among them. stays holds for the documents of
    each class that have its smallest id, and of those for one text only.

    A text without words, or null, is linked to nothing and is a class of its own. Repeated rows
    are copies of each other. Null ids come after others. An empty table gives no rows.
    """
    texts = docs.select(*_keyed(docs, doc_id, text))
    made = checkpointed(
        texts.select("doc_id", "id_key", signatures(width)("text").alias("s")).select(
            "doc_id", "id_key", "s.*"
        )
    )
    # One row a set: its copies, and the first of them to read the text from.
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "id_key")
    sets = checkpointed(
        made.where("name IS NOT NULL")
        .groupBy("name")
        .agg(
            F.count("*").alias("copies"),
            F.min(place).alias("place"),
            F.first("keys").alias("keys"),
            F.first("values").alias("values"),
        )
    )
    near = components(candidate_edges(sets.select("name", "keys", "values"), threshold, tolerance))
    counts = checkpointed(near.groupBy("root").agg(F.count("*").alias("n")))
    chosen = _with_sizes(near.withColumnRenamed("node", "name"), "root", counts).join(
        sets.select("name", "copies", F.col("place.id_key").alias("id_key")), "name"
    )
    read = chosen.join(texts.select("id_key", "text"), "id_key").dropDuplicates(["name"])
    checked = checkpointed(
        verified(read.select("root", "n", "name", "text", "copies"), counts, threshold, width)
    )
    linked = components(checked.where("b IS NOT NULL").select("a", "b"))
    links = (
        checked.where("b IS NULL")
        .groupBy(F.col("a").alias("name"))
        .agg(F.sum("links").alias("n_texts"), F.sum("count").alias("n_near"))
    )
    about = (
        sets.select("name", "copies", "place")
        .join(links, "name", "left")
        .join(linked.withColumnRenamed("node", "name"), "name", "left")
        .withColumn("root", F.coalesce("root", "name"))
    )
    firsts = about.groupBy("root").agg(F.min("place").alias("first"))
    about = about.join(firsts, "root").select(
        "name",
        F.col("first.doc_id").alias("class_id"),
        F.col("first.id_key").alias("first_key"),
        F.coalesce("n_texts", F.lit(0)).cast("long").alias("n_texts"),
        (F.coalesce("n_near", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
    )
    with_words = (
        made.where("name IS NOT NULL")
        .join(about, "name")
        .withColumn("stays", F.col("id_key") == F.col("first_key"))
    )
    without = made.where("name IS NULL").select(
        "doc_id",
        "id_key",
        F.col("doc_id").alias("class_id"),
        F.lit(0).cast("long").alias("n_links"),
        F.lit(0).cast("long").alias("n_texts"),
        F.lit(True).alias("stays"),
    )
    columns = without.columns
    return with_words.select(*columns).union(without)


def one_of_each_class(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """``docs`` with one row of each class of similar_classes, the one with the smallest id.

    Rows that agree in id and text are one document and leave one row, also those without words.
    """
    found = similar_classes(docs, doc_id=doc_id, text=text, **options)
    stay = found.where("stays").select("id_key").distinct()
    rows = docs.select(packed(docs), _keyed(docs, doc_id, text)[1])
    one = Window.partitionBy("id_key").orderBy("id_key")
    return (
        rows.join(stay, "id_key", "left_semi")
        .withColumn("copy", F.row_number().over(one))
        .where("copy = 1")
        .select(f"{ROW}.*")
    )

"""Suffix-array dedup: removal of every byte under a 200-byte string that starts twice or more.

1.  Every text is cut into segments of neighbouring 200-byte windows whose smallest 96-gram hash
    is the same. Equal windows have equal smallest hashes, wherever they are, so a window only
    has to be compared within segments of its own hash, called the anchor.
2.  Anchors are counted. Segments with an anchor that occurs once hold nothing repeated. If all
    segments of an anchor are equal, all of their windows are repeated.
3.  The different segments of the other anchors are brought together, each once with its number
    of copies. What follows the anchor is one sparse suffix array, what precedes it, read
    backwards, another; both are sorted deep-shallow. With the common prefixes of neighbours,
    windows are equal if and only if they have as much left and right of the anchor in common
    as they need.
4.  An anchor with very many different segments is not brought together: its windows are spread
    by a hash of their own 200 bytes and counted there.

Only segments that share an anchor leave their document, and the bytes of each different one
travel once. Hashes of segments and of spread windows count as equal with their anchor's, that
is with 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import slices, written
from roadstream.llm.deepshallow import sort_strings
from roadstream.llm.shingles import _BASE, _BYTES, _INVERSE, U, mixed, powers

LENGTH = 200
GRAM = 96
HOT = 1024  # different segments of one anchor that are still sorted in one task
BUCKET = 2048  # segments that one task sorts together

RUN_BITS = 7  # of a segment's place, its start and its number of windows


class Hashed:
    """Hashes of all substrings of one text in constant time each."""

    def __init__(self, data: bytes):
        size = len(data)
        self.sums = np.zeros(size + 1, dtype=np.uint64)
        content = np.frombuffer(data, dtype=np.uint8)
        np.cumsum(_BYTES[content] * powers(_BASE, size)[:size], out=self.sums[1:])
        self.back = powers(_INVERSE, size + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def grams(self, width: int) -> np.ndarray:
        n = len(self.sums) - width
        return mixed((self.sums[width:] - self.sums[:n]) * self.back[:n])


def smallest_of(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` values in a row."""
    best, done = values, 1
    while done * 2 <= width:
        best = np.minimum(best[:-done], best[done:])
        done *= 2
    return np.minimum(best[: len(best) - (width - done)], best[width - done :])


def segments(
    data: bytes, length: int = LENGTH, gram: int = GRAM
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """start, number of windows, anchor, hash and whether the anchor occurs twice, per segment."""
    width = length - gram + 1
    hashed = Hashed(data)
    grams = hashed.grams(gram)
    anchor = smallest_of(grams, width)
    start = np.r_[0, np.flatnonzero(anchor[1:] != anchor[:-1]) + 1]
    run = np.diff(np.r_[start, len(anchor)])
    if run.max() > width:  # periodic text
        pieces = -(-run // width)
        part = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        run = np.minimum(np.repeat(run, pieces) - part * width, width)
        start = np.repeat(start, pieces) + part * width
    name = anchor[start]
    whole = mixed(hashed.of(start, start + run - 1 + length) + run.astype(np.uint64))
    span = np.arange(2 * width - 1)
    twice = np.zeros(len(start), dtype=bool)
    for at in range(0, len(start), 1 << 12):
        s, r, a = start[at : at + (1 << 12)], run[at : at + (1 << 12)], name[at : at + (1 << 12)]
        place = s[:, None] + span
        inside = span < (r + width - 1)[:, None]
        same = grams[np.minimum(place, len(grams) - 1)] == a[:, None]
        twice[at : at + (1 << 12)] = (same & inside).sum(axis=1) > 1
    return start, run, name, whole, twice


# A document is known by 128 bits of hashes of its id and text, for rows may share an id or have
# none. Rows that agree in both are one document in several copies.
KEY = ["key", "more"]
ANCHORS = "key long, more long, at long, anchor long, whole long, twice boolean"


def _anchors(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows, found = [], []
            for i, text in enumerate(batch.column("text")):
                data = text.as_py().encode()
                if len(data) >= length:
                    start, many, name, whole, twice = segments(data, length, gram)
                    rows.append(np.full(len(start), i))
                    at = (start << RUN_BITS) | many
                    found.append((at, name.view(np.int64), whole.view(np.int64), twice))
            if rows:
                owner = pa.array(np.concatenate(rows))
                columns = [np.concatenate(c) for c in zip(*found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(owner) for c in KEY], *map(pa.array, columns)],
                    names=[*KEY, "at", "anchor", "whole", "twice"],
                )

    return run


CUT = "anchor long, whole long, copies long, twice boolean, kinds long, bytes binary"


def _cut(length: int):
    """Rows of documents (key, text, wanted) to the bytes of the segments wanted of them. Copies of
    a document come one after the other, and the first of them is enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in slices(batches):
            keys = list(zip(*[batch.column(c).to_pylist() for c in KEY], strict=True))
            wanted, out = batch.column("wanted"), []
            for i, text in enumerate(batch.column("text")):
                if keys[i] == last:
                    continue
                last, data = keys[i], text.as_py().encode()
                for w in wanted[i].as_py():
                    start, run = w["at"] >> RUN_BITS, w["at"] & ((1 << RUN_BITS) - 1)
                    end = start + run + length - 1
                    out.append((w["anchor"], w["whole"], w["copies"], w["twice"], w["kinds"], data[start:end]))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                names = [column.split()[0] for column in CUT.split(", ")]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def repeated_windows(
    anchors: list[int],
    copies: list[int],
    twice: list[bool],
    texts: list[bytes],
    length: int = LENGTH,
    gram: int = GRAM,
) -> list[np.ndarray]:
    """For each segment which of its windows occur more than once among all, copies included.

    All segments of an anchor must be there. A segment whose anchor occurs twice takes part with
    each window by itself, and so do the others of that anchor.
    """
    alone = {a for a, t in zip(anchors, twice, strict=True) if t}
    row, place, lowest, highest = [], [], [], []
    right: list[bytes] = []
    left: list[bytes] = []
    repeated = []
    for i, (anchor, text) in enumerate(zip(anchors, texts, strict=True)):
        run = len(text) - length + 1
        repeated.append(np.zeros(run, dtype=bool))
        if anchor in alone:
            for p in range(run):
                row.append(i), place.append(p), lowest.append(0), highest.append(0)
                right.append(text[p : p + length]), left.append(b"")
        else:
            p = int((Hashed(text).grams(gram).view(np.int64) == anchor).argmax())
            row.append(i), place.append(p)
            lowest.append(max(0, p - run + 1)), highest.append(p)
            right.append(text[p : p + length]), left.append(text[:p][::-1])
    row, place = np.array(row), np.array(place)
    lowest, highest = np.array(lowest), np.array(highest)
    weight = np.array(copies)[row]
    (after, after_lcp), (before, before_lcp) = sort_strings(right), sort_strings(left)
    after_class = np.empty(len(row), dtype=np.int64)
    before_class = np.empty(len(row), dtype=np.int64)
    for back in range(int(highest.max()) + 1):  # bytes of the window before the anchor
        here = np.flatnonzero((lowest <= back) & (back <= highest))
        if not len(here):
            continue
        after_class[after] = np.cumsum(after_lcp < length - back)
        before_class[before] = np.cumsum(before_lcp < back)
        key = before_class[here] * (len(row) + 1) + after_class[here]
        _, inverse = np.unique(key, return_inverse=True)
        often = np.bincount(inverse, weights=weight[here])[inverse] > 1
        for item in here[often].tolist():
            repeated[row[item]][place[item] - back] = True
    return repeated


def _runs(marks: np.ndarray) -> np.ndarray:
    """Begin and end of every run of true marks."""
    edge = np.flatnonzero(np.diff(np.r_[0, marks.astype(np.int8), 0]))
    return edge.reshape(-1, 2)


def _sorted_windows(length: int, gram: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        # Rows that agree in id and text were read once each.
        frame = frame.drop_duplicates(["anchor", "whole"])
        found = repeated_windows(
            frame["anchor"].tolist(),
            frame["copies"].tolist(),
            frame["twice"].tolist(),
            frame["bytes"].tolist(),
            length,
            gram,
        )
        runs = [(r[:, 0] << 8 | r[:, 1]).tolist() for r in map(_runs, found)]
        made = frame[["anchor", "whole"]].assign(runs=runs)
        return made[made["runs"].map(len) > 0]

    return run


WINDOWS = "anchor long, whole long, copies long, place int, window long"


def _spread_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many, windows = [], []
            for text in batch.column("bytes"):
                data = text.as_py()
                start = np.arange(len(data) - length + 1)
                windows.append(mixed(Hashed(data).of(start, start + length) + U(length)))
                many.append(len(start))
            if many:
                rows = pa.array(np.repeat(np.arange(len(many)), many))
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(c).take(rows) for c in ("anchor", "whole", "copies")],
                        pa.array(np.concatenate([np.arange(n) for n in many]).astype(np.int32)),
                        pa.array(np.concatenate(windows).view(np.int64)),
                    ],
                    names=["anchor", "whole", "copies", "place", "window"],
                )

    return run


def repeated_spans(
    docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """key, more, spans for every segment of ``docs`` (key, more, doc_id, text) that holds repeated
    bytes; a span is start << 9 | number of bytes, spans of a document overlap. The copies of a
    document give its spans as often."""
    pieces = docs.select(*KEY, "text").mapInArrow(_anchors(length, gram), ANCHORS)
    counts = pieces.groupBy("anchor").agg(
        F.count("*").alias("n"),
        F.min("whole").alias("least"),
        F.max("whole").alias("most"),
        F.max("twice").alias("any_twice"),
    )
    counts = counts.where("n > 1 OR any_twice").select(
        "anchor", (F.col("any_twice") | (F.col("least") != F.col("most"))).alias("differ")
    )
    shared, _ = written(pieces.join(counts, "anchor"))
    number = F.expr(f"cast(at & {(1 << RUN_BITS) - 1} AS int)")
    start = F.shiftright("at", RUN_BITS)
    # Repeated windows of a segment come as runs, begin << 8 | end.
    whole_runs = shared.where("NOT differ").select(*KEY, "at", F.array(number).alias("runs"))

    # Each different segment once, with one of its places.
    mixed_ones = shared.where("differ")
    different = mixed_ones.groupBy("anchor", "whole").agg(
        F.count("*").alias("copies"),
        F.max("twice").alias("twice"),
        F.min(F.struct(*KEY, "at")).alias("place"),
    )
    kinds = different.groupBy("anchor").agg(F.count("*").alias("kinds"))
    segment = F.struct("anchor", "whole", "copies", "twice", "kinds", "place.at")
    wanted = (
        different.join(kinds, "anchor")
        .groupBy(*[F.col(f"place.{c}").alias(c) for c in KEY])
        .agg(F.collect_list(segment).alias("wanted"))  # at most the segments of one document
    )
    # The same exchange of the texts as that of the last join serves this one, too.
    read = docs.join(wanted, KEY).mapInArrow(_cut(length), CUT)
    buckets = max(1, mixed_ones.count() // BUCKET)
    few = (
        read.where(F.col("kinds") <= hot)
        .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
        .select("bucket", "anchor", "whole", "copies", "twice", "bytes")
        .groupBy("bucket")
        .applyInPandas(
            _sorted_windows(length, gram), "anchor long, whole long, runs array<int>"
        )
    )
    many = (
        read.where(F.col("kinds") > hot)
        .dropDuplicates(["anchor", "whole"])
        .select("anchor", "whole", "copies", "bytes")
        .mapInArrow(_spread_windows(length), WINDOWS)
    )
    often = many.groupBy("anchor", "window").agg(F.sum("copies").alias("n")).where("n > 1")
    places = (
        many.join(often, ["anchor", "window"])
        .groupBy("anchor", "whole")
        .agg(F.array_sort(F.collect_list("place")).alias("places"))  # at most 127 of a segment
    )
    begins = F.filter("places", lambda p: ~F.array_contains("places", p - 1))
    ends = F.filter("places", lambda p: ~F.array_contains("places", p + 1))
    encoded = F.zip_with(begins, ends, lambda b, e: F.shiftleft(b, 8).bitwiseOR(e + 1))
    one_by_one = places.select("anchor", "whole", encoded.alias("runs"))
    parts = mixed_ones.join(few.union(one_by_one), ["anchor", "whole"]).select(*KEY, "at", "runs")

    def span(run):
        """Bytes under the windows begin <= place < end of a segment."""
        begin, end = F.shiftright(run, 8), run.bitwiseAND(F.lit(255))
        return F.shiftleft(start + begin, 9).bitwiseOR((end - begin + (length - 1)).cast("long"))

    return whole_runs.union(parts).select(*KEY, F.transform("runs", span).alias("spans"))


CLEANED = "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))


def without_repeats(
    docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_bytes, spans (maximal removed stretches of
    bytes, in order) and kept (the other bytes).

    A byte goes if it lies in a string of ``length`` bytes that also starts somewhere else, in the
    same text or another; strings are judged on the input, overlaps count, and nothing matches
    across texts. Null texts are empty. Repeated rows are copies of each other and lose all of
    their strings. Null ids are allowed. An empty table gives no rows.
    """
    ident, words = F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))
    keyed = docs.select(
        F.xxhash64(ident, words).alias("key"),
        F.xxhash64(words, F.lit(1), ident).alias("more"),
        ident.alias("doc_id"),
        words.alias("text"),
    )
    spans = repeated_spans(keyed, length=length, gram=gram, hot=hot)
    # A set: the copies of a document have the same spans.
    lists = (
        spans.select(*KEY, F.explode("spans").alias("span"))
        .groupBy(*KEY)
        .agg(F.collect_set("span").alias("spans"))
    )

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, removed, kept = [], [], []
            found = batch.column("spans")
            for i, text in enumerate(batch.column("text")):
                data = text.as_py().encode()
                marks = np.zeros(len(data) + 1, dtype=np.int32)
                if found[i].is_valid:
                    places = found[i].values.to_numpy()
                    np.add.at(marks, places >> 9, 1)
                    np.add.at(marks, (places >> 9) + (places & 511), -1)
                gone = _runs(np.cumsum(marks[:-1]) > 0)
                edges = [0, *gone.ravel().tolist(), len(data)]
                sizes.append(len(data))
                removed.append([{"begin": b, "end": e} for b, e in gone.tolist()])
                pairs = zip(edges[::2], edges[1::2], strict=True)
                kept.append(b"".join(data[b:e] for b, e in pairs))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(removed, SPANS),
                    pa.array(kept, pa.binary()),
                ],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return keyed.join(lists, KEY, "left").drop("more").mapInArrow(clean, CLEANED)

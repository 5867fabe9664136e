"""Host-level quality rules: a document is judged by its own text and by the company it keeps.

1.  Every text is measured once and judged by the rules below. The measures, a few numbers a
    document, are stored; nothing after this reads a text.
2.  Failures are added up by host. A host of few documents says little about itself, so its rate
    of failures is shrunk towards the rate of all hosts: with the prior Beta(a, b) the rate is
    (failures + a) / (documents + a + b). The prior is learned from the hosts themselves: its
    mean is the rate of all documents, its weight follows from how much more the rates of hosts
    differ than chance would make them (the intra-class correlation of the beta-binomial,
    estimated by moments).
3.  A host whose shrunk rate exceeds the limit is rejected, with all of its documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import ROW, join_groups, packed, slices, written

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of words in repeated windows
MAX_SYMBOLS = 10  # symbols per 100 words
MAX_DUP_LINES = 30  # percent of lines with words
WORD_LENGTH = (2, 12)  # mean characters of a word
WINDOW = 3

MAX_RATE = 0.5  # of failures, shrunk, that a host may have
# Bounds of the correlation within hosts, and so of the weight of the prior, 1 / correlation - 1
# documents: where hosts differ no more than by chance, or where all fail in full or not at all.
CORRELATION = (1e-4, 0.5)

# The white space that ends words, and what counts as a symbol.
WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
KINDS = [pa.field(name, pa.int64()) for name in MEASURES]


def repeated_words(words: np.ndarray, kinds: int, window: int = WINDOW) -> int:
    """How many of ``words``, numbered from 0 to ``kinds`` - 1, lie in a window that occurs twice or
    more, the first occurrence included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    code, many = words[:n], kinds
    for at in range(1, window):
        if many * kinds >= 1 << 62:  # number the windows so far anew
            found, code = np.unique(code, return_inverse=True)
            many = len(found)
        code, many = code * kinds + words[at : at + n], many * kinds
    _, place, often = np.unique(code, return_inverse=True, return_counts=True)
    begins = np.flatnonzero(often[place] > 1)
    inside = np.zeros(len(words), dtype=bool)
    for at in range(window):
        inside[begins + at] = True
    return int(inside.sum())


def measured(text: str | None) -> tuple[int, ...]:
    """The MEASURES of a text; null has no words."""
    if not text:
        return (0,) * len(MEASURES)
    number: dict[bytes, int] = {}
    ids: list[int] = []
    lines, n_lines = set(), 0
    for line in text.split("\n"):
        words = line.encode().split()  # bytes are split at ASCII white space alone
        if words:
            n_lines += 1
            lines.add(line)
            ids.extend([number.setdefault(word, len(number)) for word in words])
    return (
        len(ids),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        n_lines,
        n_lines - len(lines),
        repeated_words(np.array(ids, dtype=np.int64), len(number)),
    )


def _measures(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = [measured(text) for part in slices([texts]) for text in part.to_pylist()]
        columns = zip(*rows, strict=True) if rows else [[]] * len(KINDS)
        yield pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields=KINDS)


def rule_failures(
    min_words: int = MIN_WORDS,
    max_repeated: int = MAX_REPEATED,
    max_symbols: int = MAX_SYMBOLS,
    max_dup_lines: int = MAX_DUP_LINES,
    word_length: tuple[int, int] = WORD_LENGTH,
) -> dict[str, Column]:
    """Whether a measured document fails each rule. The base rules also reject it by itself."""
    words, low, high = F.col("n_words"), *word_length
    few = words < min_words
    repeats = 100 * F.col("n_repeat_words") > max_repeated * words
    return {
        "base_failed": few | repeats,
        "soft_failed": (100 * F.col("n_symbols") > max_symbols * words)
        | (100 * F.col("n_dup_lines") > max_dup_lines * F.col("n_lines"))
        | (F.col("word_chars") < low * words)
        | (F.col("word_chars") > high * words),
    }


def prior(hosts: DataFrame) -> tuple[float, float]:
    """(a, b) of the beta prior of failure rates, from host_docs and host_failed of every host.

    Sums of decimals, so that the order of the hosts leaves no trace in the result. Without hosts,
    or if all documents pass or all fail, the hosts tell nothing apart and the weight is the
    largest.
    """
    docs, failed = F.col("host_docs"), F.col("host_failed")
    share = (failed * failed / docs).cast("decimal(38,9)")
    row = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum(docs).alias("docs"),
        F.sum(failed).alias("failed"),
        F.sum((docs * docs).cast("decimal(38,0)")).alias("squares"),
        F.sum(share).alias("share"),
    ).first()
    if not row["hosts"]:
        return 0.5, 0.5
    n, mean, groups = row["docs"], row["failed"] / row["docs"], row["hosts"]
    chance = mean * (1 - mean)
    spare = n - float(row["squares"]) / n - (groups - 1)
    correlation = 0.0
    if chance > 0 and spare > 0:
        between = float(row["share"]) - mean * row["failed"]
        correlation = (between - chance * (groups - 1)) / (chance * spare)
    low, high = CORRELATION
    weight = 1 / min(max(correlation, low), high) - 1
    return mean * weight, (1 - mean) * weight


def judged(
    docs: DataFrame,
    *,
    text: str = "text",
    host: str = "source",
    keep: list[str] | None = None,
    max_rate: float = MAX_RATE,
    **limits,
) -> DataFrame:
    """Per row of ``docs``: __row (its ``keep`` columns, all by default), the MEASURES, base_failed,
    soft_failed, host_docs, host_failed (documents that fail any rule), host_rate and kept.

    A document is kept unless it fails a base rule (too few words, too many of them in repeated
    windows) or its host's shrunk rate of failures exceeds ``max_rate``. The other rules (symbols,
    repeated lines, lengths of words) only count for the host. Words are runs of anything but ASCII
    white space; a null or empty text has none and fails. A null host is no host: its documents
    are judged by the base rules alone, and the host columns are null. Repeated rows are documents
    of their own; null and repeated ids are allowed. An empty table gives no rows.
    """
    name = F.col(f"`{host}`").cast("string")
    measure = F.arrow_udf(_measures, ", ".join(f"{m} long" for m in MEASURES))
    found = docs.select(
        packed(docs, keep), name.alias("host"), measure(F.col(f"`{text}`")).alias("found")
    )
    rules = rule_failures(**limits)
    rows, _ = written(found.select(ROW, "host", "found.*").withColumns(rules))
    failed = F.col("base_failed") | F.col("soft_failed")
    hosts = rows.where("host IS NOT NULL").groupBy("host").agg(
        F.count("*").alias("host_docs"), F.count_if(failed).alias("host_failed")
    )
    hosts, _ = written(hosts)
    a, b = prior(hosts)
    hosts = hosts.withColumn(
        "host_rate", (F.col("host_failed") + F.lit(a)) / (F.col("host_docs") + F.lit(a + b))
    )
    none = {c: F.lit(None).cast(t) for c, t in hosts.dtypes if c != "host"}
    alone = rows.where("host IS NULL").withColumns(none)
    known = join_groups(rows.where("host IS NOT NULL"), hosts, "host", "host_docs")
    all_rows = known.unionByName(alone)
    fine = F.coalesce(F.col("host_rate") <= max_rate, F.lit(True))
    return all_rows.withColumn("kept", ~F.col("base_failed") & fine).drop("host")


SQL = f"""
WITH texts AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(len(words))) AS place FROM texts),
windows AS (
  SELECT a.doc_id, a.place, count(*) OVER (
      PARTITION BY a.doc_id, a.word, b.word, c.word) AS often
  FROM words a JOIN words b ON a.doc_id = b.doc_id AND b.place = a.place + 1
    JOIN words c ON a.doc_id = c.doc_id AND c.place = a.place + 2),
repeats AS (
  SELECT doc_id, count(DISTINCT place + step) AS n
  FROM windows CROSS JOIN (SELECT unnest([0, 1, 2]) AS step) AS steps
  WHERE often > 1 GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dups
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM texts)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
measured AS (
  SELECT t.doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(l.n, 0) AS n_lines, coalesce(l.dups, 0) AS n_dup_lines,
    coalesce(r.n, 0) AS n_repeat_words
  FROM texts t LEFT JOIN lines l ON t.doc_id = l.doc_id LEFT JOIN repeats r ON t.doc_id = r.doc_id),
ruled AS (
  SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
    100 * n_symbols > {MAX_SYMBOLS} * n_words OR 100 * n_dup_lines > {MAX_DUP_LINES} * n_lines
      OR word_chars < {WORD_LENGTH[0]} * n_words OR word_chars > {WORD_LENGTH[1]} * n_words
      AS soft_failed
  FROM measured),
hosts AS (
  SELECT source, count(*) AS docs, count(*) FILTER (WHERE base_failed OR soft_failed) AS failed
  FROM ruled WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT CAST(count(*) AS DOUBLE) AS hosts, CAST(sum(docs) AS DOUBLE) AS n,
    CAST(sum(failed) AS DOUBLE) AS failed, CAST(sum(docs * docs) AS DOUBLE) AS squares,
    sum(failed * failed / docs::DOUBLE) AS share, sum(failed) / sum(docs)::DOUBLE AS mean
  FROM hosts),
fitted AS (
  SELECT mean, CASE WHEN mean > 0 AND mean < 1 AND n - squares / n - (hosts - 1) > 0
    THEN (share - mean * failed - mean * (1 - mean) * (hosts - 1))
      / (mean * (1 - mean) * (n - squares / n - (hosts - 1))) ELSE 0 END AS correlation
  FROM moments),
weighed AS (
  SELECT mean, 1 / least(greatest(correlation, {CORRELATION[0]}), {CORRELATION[1]}) - 1 AS weight
  FROM fitted),
rated AS (
  SELECT source, (failed + mean * weight) / (docs + weight) AS rate FROM hosts, weighed)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(rate <= {MAX_RATE}, true) AS kept
FROM ruled LEFT JOIN rated ON ruled.source = rated.source
"""

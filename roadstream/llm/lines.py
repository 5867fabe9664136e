"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate. How many sites a line has is counted with one
HyperLogLog sketch per line hash, which tasks merge before and after the shuffle, so a line of
billions of documents costs one small sketch a task. Lines whose estimate lies near the
threshold get an exact distinct count.

The lines that go are stored with their number of documents before their occurrences are looked
up. Those of the lines that are everywhere are spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.llm.common import ROW, packed, written

MIN_SITES = 10
PRECISION = 12  # log2 of the sketch's registers: a standard error of 1.6 %
NEAR = 0.1  # six standard errors: estimates closer to the threshold are counted exactly
BREAK = "\n"
HOT = 1000  # a line with one occurrence of so many is spread; there are at most so many such lines
SLOTS = 256  # over so many places


def split_lines(text: Column) -> Column:
    return F.split(text, BREAK, -1)


def is_blank(line: Column) -> Column:
    return F.trim(line) == ""


def spread_lines(
    docs: DataFrame,
    *,
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    precision: int = PRECISION,
    near: float = NEAR,
) -> DataFrame:
    """Hashes of the lines (column ``line``) that stand on at least ``min_sites`` sites, and in how
    many documents they do (``n``).

    Blank lines are never among them. A null site is a site of its own.
    """
    where = F.col(f"`{site}`").cast("string")
    lines = docs.select(
        F.coalesce(where, F.lit("\0no site")).alias("site"),
        F.explode(F.array_distinct(split_lines(F.col(f"`{text}`")))).alias("content"),
    ).where(~is_blank(F.col("content")))
    lines = lines.select("site", F.xxhash64("content").alias("line"))
    sketches = lines.groupBy("line").agg(
        F.hll_sketch_agg("site", precision).alias("sketch"), F.count("*").alias("n")
    )
    estimates = sketches.select("line", "n", F.hll_sketch_estimate("sketch").alias("sites"))
    low, high = min(min_sites * (1 - near), min_sites - 1), max(min_sites * (1 + near), min_sites + 1)
    estimates = estimates.where(F.col("sites") >= low)
    sure = estimates.where(F.col("sites") > high).select("line", "n")
    unsure = estimates.where(F.col("sites") <= high).select("line", "n")
    exact = (
        lines.join(unsure, "line")
        .groupBy("line", "n", "site")
        .agg(F.lit(1).alias("one"))
        .groupBy("line", "n")
        .agg(F.count("*").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("line", "n")
    )
    return sure.union(exact)


def _slots(spread: DataFrame, slots: int) -> tuple[DataFrame, Column]:
    """``spread`` with a row for every ``slot`` of a line, and the slot of an occurrence, from
    columns line and key."""
    total = spread.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = spread.where(F.col("n") * HOT >= total).select("line")
    known = [row["line"] for row in hot.collect()]  # at most HOT numbers
    is_hot = F.col("line").isin(known)
    last = F.when(is_hot, F.lit(slots - 1)).otherwise(F.lit(0))
    placed = spread.select("line", F.explode(F.sequence(F.lit(0), last)).alias("slot"))
    own = F.pmod(F.xxhash64("key"), F.lit(slots)).cast("int")
    return placed, F.when(is_hot, own).otherwise(F.lit(0))


def without_spread_lines(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
) -> DataFrame:
    """Per row of ``docs``: __row (its columns), n_lines, n_removed and clean_text.

    Lines are what stands between line breaks, compared exactly. Every occurrence of a line on
    ``min_sites`` or more sites goes. A document of nothing but such lines and blank ones stays
    whole: it is a copy, not a frame around something else, and is left to duplicate removal. A
    null text stays null and has no lines; an empty one has one blank line. Repeated rows give
    repeated rows; null ids are allowed.
    """
    ident = F.col(f"`{doc_id}`")
    words = F.col(f"`{text}`")
    rows = docs.select(
        packed(docs),
        F.struct(ident.alias("id"), F.xxhash64(ident, words).alias("hash")).alias("key"),
    )
    spread, _ = written(spread_lines(docs, text=text, site=site, min_sites=min_sites))
    spread, slot = _slots(spread, SLOTS)
    found = (
        docs.select(
            F.struct(ident.alias("id"), F.xxhash64(ident, words).alias("hash")).alias("key"),
            F.explode(F.array_distinct(split_lines(words))).alias("content"),
        )
        .where(~is_blank(F.col("content")))
        .select("key", F.xxhash64("content").alias("line"))
        .withColumn("slot", slot)
        .join(spread, ["line", "slot"], "left_semi")
        .groupBy("key")
        .agg(F.collect_set("line").alias("spread"))  # at most the lines of one document
    )
    joined = rows.join(found.withColumnRenamed("key", "found_key"), F.expr("key <=> found_key"), "left")
    lines = split_lines(F.col(f"{ROW}.`{text}`"))  # of the row: the text is dealt out once
    spread_here = F.coalesce(F.col("spread"), F.array().cast("array<bigint>"))
    kept = F.filter(
        lines, lambda line: is_blank(line) | ~F.array_contains(spread_here, F.xxhash64(line))
    )
    whole = F.forall("kept", is_blank)
    return (
        joined.withColumn("lines", lines)
        .withColumn("kept", kept)
        .withColumn("kept", F.when(whole, F.col("lines")).otherwise(F.col("kept")))
        .select(
            ROW,
            F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
            F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_removed"),
            F.array_join("kept", BREAK).alias("clean_text"),
        )
    )


SQL = f"""
WITH lines AS (
  SELECT doc_id, coalesce(source, chr(1) || 'no site') AS site,
    unnest(string_split(text, chr(10))) AS line,
    unnest(range(1, len(string_split(text, chr(10))) + 1)) AS place
  FROM documents),
spread AS (
  SELECT line FROM lines WHERE trim(line, ' ') <> ''
  GROUP BY line HAVING count(DISTINCT site) >= {MIN_SITES}),
marked AS (
  SELECT l.doc_id, l.place, l.line, s.line IS NOT NULL AS spread
  FROM lines l LEFT JOIN spread s ON l.line = s.line),
summed AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE spread) AS n_spread,
    bool_and(spread OR trim(line, ' ') = '') AS whole,
    string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT spread) AS rest
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines,
  CASE WHEN whole IS NULL OR whole THEN 0 ELSE n_spread END AS n_removed,
  CASE WHEN whole IS NULL OR whole THEN d.text ELSE rest END AS text
FROM documents d LEFT JOIN summed s ON d.doc_id = s.doc_id
"""

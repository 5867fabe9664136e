"""Mixing sources to target weights by systematic sampling; DataFrame functions only.

Every source has a target number of words. Each of its documents is expected
``target / source_size`` times in the mix. The expected copies are summed along the source, one
random offset per source is added, and a document is emitted once for every whole number its
stretch of the sum crosses.

Along a source documents run by size class and then by size, so that the sample takes its share
of short and of long documents alike and the words taken come within about one long document of
the target.

A source may hold a third of all rows, and so may one size, so no step gathers a source: rows
are numbered within chunks of (source, size class, salt) and each chunk starts at the sum of
the chunks before it. The chunk table has at most classes x salts rows a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream.llm.common import ROW, packed, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
CAP = 3
SEED = "mix-1"
LEAST_SALTS = 32
ROWS_A_SALT = 1 << 20

SOURCE = ["no_source", "source"]
CHUNK = [*SOURCE, "size_class", "salt"]


def word_count(text: Column) -> Column:
    """Number of words of ``text``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _hex(text: Column) -> Column:
    """An unsigned 32-bit number that depends on ``text``."""
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """One row a source of ``sizes`` (no_source, source, size): source_size, target, rate.

    Sources by code point, null last, take ``weights`` in turn. Targets share all words by
    weight; none exceeds ``cap`` times its source, and what would is shared again by weight.
    With sources in ascending order of cap per weight, giving the first few their cap and the
    rest the same amount a weight unit has its largest unit at the solution: each source that
    is rightly capped raises it, each that is not lowers it.
    """
    table = sizes.groupBy(*SOURCE).agg(F.sum("size").alias("source_size"))
    # Windows over one row a source.
    place = F.row_number().over(Window.orderBy(*SOURCE)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    table = table.withColumn("weight", weight)
    order = Window.orderBy(F.col("source_size") / F.col("weight"), *SOURCE)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - cap * F.coalesce(
        F.sum("source_size").over(before), F.lit(0)
    )
    unit = F.max("unit").over(
        Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    most = F.col("source_size") * F.lit(float(cap))
    return (
        table.withColumn("unit", left / F.sum("weight").over(onward))
        .withColumn("target", F.least(most, unit * F.col("weight")).cast("double"))
        .withColumn(
            "rate",
            F.when(F.col("source_size") == 0, 0.0).otherwise(
                F.least(F.lit(float(cap)), F.col("target") / F.col("source_size"))
            ),
        )
        .select(*SOURCE, "source_size", "target", "rate")
    )


def sample_copies(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    keep: list[str] | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
    seed: str = SEED,
) -> DataFrame:
    """Per row of ``docs``: __row (its ``keep`` columns, all by default), size, source_size,
    target, rate and copies, how often the mix takes it: at most ``cap`` times.

    Null and empty texts have size 0 and count as documents of their source. A null source is a
    source of its own. A repeated row is a document of its own. Rows of one source that agree in
    size, doc_id and text are interchangeable, otherwise the result is the same on every run. A
    source without words has target 0. An empty table gives no rows.
    """
    rows = docs.count()
    salts = max(LEAST_SALTS, rows // ROWS_A_SALT)
    name = F.col(f"`{source}`").cast("string")
    ident = F.col(f"`{doc_id}`")
    sized = docs.select(
        packed(docs, keep),
        name.isNull().alias("no_source"),
        F.coalesce(name, F.lit("")).alias("source"),
        word_count(F.col(f"`{text}`")).alias("size"),
        (_hex(F.coalesce(ident.cast("string"), F.lit(""))) % salts).alias("salt"),
        F.xxhash64(ident, F.col(f"`{text}`")).alias("tie"),
        ident.alias("ident"),
    ).withColumn("size_class", F.floor(F.sqrt("size")))

    # Stored, so that the words of all texts are counted once for it and not for each of its uses.
    counts, _ = written(sized.groupBy(*CHUNK).agg(F.count("*").alias("n"), F.sum("size").alias("size")))
    earlier = (
        Window.partitionBy(*SOURCE)
        .orderBy("size_class", "salt")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select(*CHUNK, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    offset = _hex(F.concat(F.lit(seed), F.col("source"))) / F.lit(4294967296.0)
    starts = starts.join(source_targets(counts, weights, cap), SOURCE).withColumn("offset", offset)

    inside = Window.partitionBy(*CHUNK).orderBy("size", "ident", "tie")
    placed = sized.withColumn("place", F.row_number().over(inside)).join(starts, CHUNK)
    place = F.col("start") + F.col("place")
    crossed = F.floor(place * F.col("rate") + F.col("offset")) - F.floor(
        (place - 1) * F.col("rate") + F.col("offset")
    )
    copies = F.least(crossed, F.lit(cap)).cast("long")
    return placed.select(ROW, "size", "source_size", "target", "rate", copies.alias("copies"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, columns unchanged."""
    taken = sample_copies(docs, **options).where(F.col("copies") > 0)
    repeated = taken.select(ROW, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return repeated.select(f"{ROW}.*")


SQL = f"""
WITH sized AS (
  SELECT doc_id, source IS NULL AS no_source, coalesce(source, '') AS source,
    CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
    (('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT
      % (SELECT greatest({LEAST_SALTS}, count(*) // {ROWS_A_SALT}) FROM documents)) AS salt
  FROM documents),
by_source AS (
  SELECT no_source, source, CAST(sum(size) AS BIGINT) AS source_size,
    [{", ".join(map(str, WEIGHTS))}][(row_number() OVER (ORDER BY no_source, source) - 1)
      % {len(WEIGHTS)} + 1] AS weight
  FROM sized GROUP BY no_source, source),
units AS (
  SELECT *, (sum(source_size) OVER () - {CAP} * coalesce(sum(source_size) OVER (
      ORDER BY source_size / weight, no_source, source
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / (sum(weight) OVER (ORDER BY source_size / weight, no_source, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS unit
  FROM by_source),
targets AS (
  SELECT no_source, source, source_size,
    least({CAP}.0::DOUBLE * source_size, max(unit) OVER () * weight) AS target
  FROM units),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY no_source, source
    ORDER BY floor(sqrt(size)), salt, size, doc_id) AS place FROM sized),
rated AS (
  SELECT p.doc_id, p.size, t.source_size, t.target, p.place,
    CASE WHEN t.source_size = 0 THEN 0.0
      ELSE least({CAP}.0::DOUBLE, t.target / t.source_size) END AS rate,
    ('0x' || substr(md5('{SEED}' || p.source), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS shift
  FROM placed p JOIN targets t USING (no_source, source))
SELECT doc_id, size, source_size, target,
  CAST(size * least(floor(place * rate + shift) - floor((place - 1) * rate + shift), {CAP})
    AS BIGINT) AS taken
FROM rated
"""


"""Mixing sources to target weights by systematic sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keys import with_surrogate_key
from ..session import settle
from .registry import query, table
from .rows import held, released

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(
    sized: DataFrame, weights=WEIGHTS, most_copies: int = MOST_COPIES, share: float = 1.0
) -> DataFrame:
    """One row per source: its size, row count, first position in source order, weight and target.

    Sources are numbered by code point, NULL last; the weights repeat in that
    order. All targets together are ``share`` of all sizes. No target exceeds
    ``most_copies`` times the size of its source; what a source cannot take is
    shared again by weight among the others until none is above. Only two sums
    per round reach the driver.
    """
    listed = with_surrogate_key(
        sized.groupBy("__source", "__none")
        .agg(F.sum("__size").alias("__source_size"), F.count(F.lit(1)).alias("__count")),
        "__number", ["__none", "__source"], start=0,
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("__number") % len(weights) + 1).cast("int"))
    listed = settle(listed.withColumn("__weight", weight), "sources")
    total = (listed.agg(F.sum("__source_size")).first()[0] or 0) * share
    limit = F.col("__source_size") * most_copies
    level, capped_before = None, -1
    while True:
        capped = F.lit(False) if level is None else F.lit(level) * F.col("__weight") > limit
        row = listed.agg(
            F.count_if(capped).alias("n"),
            F.sum(F.when(capped, limit).otherwise(0)).alias("full"),
            F.sum(F.when(capped, 0).otherwise(F.col("__weight"))).alias("open"),
        ).first()
        if row["n"] == capped_before or not row["open"]:
            break
        capped_before = row["n"]
        level = (total - row["full"]) / row["open"]
    target = F.least(F.lit(level or 0.0) * F.col("__weight"), limit.cast("double"))
    return listed.withColumn("__target", target)


def mix(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """``mix_sized`` with the words of the text as size; whole rows travel."""
    return mix_sized(docs.withColumn("__size", word_count(F.col("text"))), seed, **shares)


def mix_sized(docs: DataFrame, seed: str = "mix", **shares) -> DataFrame:
    """Give every document its number of copies, ``__copies``, so that each source meets its target.

    Within a source all documents expect the same number of copies, target by
    size. They stand in order of size and doc_id; the expected copies are
    summed up in that order, a random offset of the source is added, and a
    document is emitted once for each whole number that its own stretch
    crosses. Neighbours are of about one size, so that the words taken differ
    from the target by about one document. The offset comes from a digest of
    seed and source: reruns agree.

    Rows are numbered over range partitions, so that a source with a third of
    all rows is spread like any other. All columns of ``docs`` are returned,
    with ``__size``, ``__source_size``, ``__target`` and ``__copies``.

    NULL or empty texts have size 0 and take part like others; a NULL source is
    one source, last in order; repeated rows are sampled each on its own; an
    empty table gives an empty result; a source without words has target 0 and
    is not taken.
    """
    sized = (
        docs.withColumn("__none", F.col("source").isNull())
        .withColumn("__source", F.coalesce("source", F.lit("")))
    )
    placed = with_surrogate_key(
        sized, "__row", ["__none", "__source", "__size", "doc_id"], start=0
    )
    targets = source_targets(placed, **shares)
    # Rows before the source's own: the numbers of all rows follow the same order.
    firsts = placed.groupBy("__none", "__source").agg(F.min("__row").alias("__first"))
    targets = targets.join(firsts, ["__none", "__source"])
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.when(F.col("__none"), "null").otherwise(
        F.concat(F.lit("source "), F.col("__source")))))
    offset = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)
    targets = targets.select(
        "__none", "__source", "__source_size", "__target", "__first",
        F.when(F.col("__source_size") > 0, F.col("__target") / F.col("__source_size")).otherwise(0.0).alias("__rate"),
        offset.alias("__offset"),
    )
    targets = settle(targets, "targets")  # its size is known now, a row per source
    before = (F.col("__row") - F.col("__first")) * F.col("__rate") + F.col("__offset")
    after = (F.col("__row") - F.col("__first") + 1) * F.col("__rate") + F.col("__offset")
    return (
        placed.join(targets, ["__none", "__source"])
        .withColumn("__copies", F.floor(after) - F.floor(before))
        .drop("__none", "__source", "__row", "__first", "__rate", "__offset")
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, with the columns of ``docs``."""
    taken = mix(held(docs, "doc_id", "text", "source"), **options).filter("__copies > 0")
    copied = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
    return released(copied, docs)


SQL = f"""
WITH sized AS (
  SELECT doc_id, source, source IS NULL AS none,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT none, source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY none, source) - 1) % 3 AS number
  FROM sized GROUP BY none, source),
weighed AS (SELECT *, CASE number WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sources),
-- The sources that are full at a common level are those with the least size by weight.
ranked AS (
  SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, none, source) AS k FROM weighed),
levels AS (
  SELECT a.k, any_value(a.source_size * 3.0::DOUBLE / a.weight) AS least,
         ((SELECT sum(source_size) FROM ranked) - coalesce(sum(b.source_size * 3) FILTER (b.k < a.k), 0))::DOUBLE
           / sum(b.weight) FILTER (b.k >= a.k) AS level
  FROM ranked a, ranked b GROUP BY a.k),
chosen AS (SELECT level FROM levels WHERE level <= least ORDER BY k LIMIT 1),
targets AS (
  SELECT none, source, source_size,
         least(coalesce((SELECT level FROM chosen), 0) * weight, source_size * 3.0::DOUBLE) AS target,
         ('0x' || substr(md5('mix:' || CASE WHEN none THEN 'null' ELSE 'source ' || source END), 1, 8))::BIGINT
           / 4294967296.0::DOUBLE AS offset_
  FROM weighed),
placed AS (
  SELECT doc_id, size, t.source_size, t.target, offset_,
         CASE WHEN t.source_size > 0 THEN target / t.source_size ELSE 0 END AS rate,
         row_number() OVER (PARTITION BY s.none, s.source ORDER BY size, doc_id) - 1 AS r
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (size * (floor((r + 1) * rate + offset_) - floor(r * rate + offset_)))::BIGINT AS taken
FROM placed
"""


@query("op5_mix_sources", SQL)
def op5_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    sized = docs.withColumn("__size", word_count(F.col("text")))
    return mix_sized(sized.drop("text")).select(
        "doc_id", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
        F.col("__target").alias("target"), (F.col("__size") * F.col("__copies")).alias("taken"),
    )

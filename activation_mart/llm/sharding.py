"""Sharding by sampled splitters: shards of near equal bytes, cut from ranges of the text's hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import settle
from .registry import query, table
from .rows import WHOLE, held

SHARDS = 40
RANGES_PER_SHARD = 8
SAMPLES_PER_RANGE = 16
MOST_SLICE_BYTES = 256 << 20
ROW_BYTES = 16


def _uniform(hashed: Column) -> Column:
    """A hash as a number of [0, 1)."""
    return F.shiftrightunsigned(hashed, 11).cast("double") / float(2**53)


def splitters(sized: DataFrame, total: int, ranges: int) -> list[int]:
    """Quantile boundaries of the key, from a sample drawn in proportion to size.

    A row is drawn where its hashed number falls below its share; one larger
    than a sample's worth is always drawn and weighs more. The sample, some
    ``ranges`` x SAMPLES_PER_RANGE keys, does not grow with the table.
    """
    worth = max(total / (ranges * SAMPLES_PER_RANGE), 1.0)
    drawn = _uniform(F.xxhash64(F.col("__key"), F.col("doc_id"), F.lit(7))) < F.col("__size") / worth
    sample = sized.filter(drawn).select("__key", F.greatest(F.lit(1.0), F.col("__size") / worth).alias("w"))
    keys = sorted((row["__key"], row["w"]) for row in sample.collect())
    step, passed, out = sum(w for _, w in keys) / ranges, 0.0, []
    for key, weight in keys:
        passed += weight
        if passed >= step * (len(out) + 1) and len(out) < ranges - 1 and key not in out[-1:]:
            out.append(key)
    return out


def _range_of(key: Column, bounds: list[int], low: int = 0) -> Column:
    """Number of boundaries below the key, by halving."""
    if not bounds:
        return F.lit(low)
    mid = len(bounds) // 2
    return F.when(key <= F.lit(bounds[mid]), _range_of(key, bounds[:mid], low)).otherwise(
        _range_of(key, bounds[mid + 1 :], low + mid + 1)
    )


def assign_shards(sized: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Add ``shard`` and ``slot`` to settled rows of (doc_id, __id, __key, __size, ...).

    Rows fall into ranges between splitters. A range above its share, or above
    MOST_SLICE_BYTES, is subdivided by a hash of the key, and what is still
    above by a hash of doc_id, and of the row's number where text and doc_id are
    repeated, as one key or one row may be a third of the table. Then
    each row's first byte is known: bytes of ranges before, of slices before,
    and a running sum within its slice; the shard is that byte's share of the
    total, so shards differ by about one row in size. Slots number the rows of
    a shard from 0 in the same order.

    Equal keys stand together unless their range was subdivided by doc_id.
    NULL keys or ids are hashed like others, rows that are equal in everything
    take slots in any order, and an empty table gives an empty result.
    """
    ranges = shards * RANGES_PER_SHARD
    total = sized.agg(F.sum("__size")).first()[0] or 1
    share = min(max(total / ranges, 1.0), MOST_SLICE_BYTES)
    bounds = splitters(sized, total, ranges)
    # Settled, for some hundred boundaries in the plan of every branch that follows fill the driver's memory.
    placed = settle(sized.withColumn("__range", _range_of(F.col("__key"), bounds)), "ranges")

    def slices(frame: DataFrame, cell: list[str], name: str, by: Column) -> DataFrame:
        """Split each cell above twice its share by a hash."""
        totals = frame.groupBy(*cell).agg(F.sum("__size").alias("__bytes"))
        pieces = totals.select(
            *cell, F.when(F.col("__bytes") > 2 * share, F.ceil(F.col("__bytes") / share)).otherwise(1).alias("__k")
        )
        return (
            frame.join(pieces, cell)
            .withColumn(name, F.floor(_uniform(by) * F.col("__k")).cast("int"))
            .drop("__k")
        )

    placed = slices(placed, ["__range"], "__slice", F.xxhash64("__key", F.lit(1)))
    # Rows equal in text and doc_id, which may be many, are told apart by their numbers; all others don't depend on these.
    repeated = sized.groupBy(F.col("__key").alias("__of_key"), F.col("doc_id").alias("__of_doc")).agg(
        F.count(F.lit(1)).alias("__times")
    )
    repeated = settle(repeated.filter("__times > 1"), "repeated")
    placed = placed.join(repeated, F.expr("__key <=> __of_key AND doc_id <=> __of_doc"), "left")
    by_row = F.when(F.col("__times").isNotNull(), F.xxhash64("__id")).otherwise(F.xxhash64("doc_id", F.lit(2)))
    placed = slices(placed, ["__range", "__slice"], "__part", by_row).drop("__of_key", "__of_doc", "__times")
    placed = settle(placed, "parts")
    cell = ["__range", "__slice", "__part"]
    cells = placed.groupBy(*cell).agg(F.sum("__size").alias("__bytes"), F.count(F.lit(1)).alias("__rows"))
    # Sums of what stands before: of ranges (at most a fixed number), and of cells within a range.
    whole = cells.groupBy("__range").agg(F.sum("__bytes").alias("__b"), F.sum("__rows").alias("__r"))
    earlier = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = whole.select(
        "__range",
        F.coalesce(F.sum("__b").over(earlier), F.lit(0)).alias("__range_byte"),
        F.coalesce(F.sum("__r").over(earlier), F.lit(0)).alias("__range_row"),
    )
    inside = Window.partitionBy("__range").orderBy("__slice", "__part").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select(
        *cell,
        F.coalesce(F.sum("__bytes").over(inside), F.lit(0)).alias("__cell_byte"),
        F.coalesce(F.sum("__rows").over(inside), F.lit(0)).alias("__cell_row"),
    ).join(whole, "__range")
    order = Window.partitionBy(*cell).orderBy("__key", "doc_id")
    running = order.rowsBetween(Window.unboundedPreceding, -1)
    local = placed.withColumn("__byte", F.coalesce(F.sum("__size").over(running), F.lit(0))).withColumn(
        "__row", F.row_number().over(order) - 1
    )
    local = local.join(cells, cell).select(
        *sized.columns,
        F.expr(f"CAST(({shards} * CAST(__range_byte + __cell_byte + __byte AS DECIMAL(28,0))) DIV {total} AS INT)").alias("shard"),
        (F.col("__range_row") + F.col("__cell_row") + F.col("__row")).alias("__place"),
    )
    local = settle(local, "shards")
    firsts = local.groupBy("shard").agg(F.min("__place").alias("__first"))
    return local.join(firsts, "shard").withColumn("slot", F.col("__place") - F.col("__first")).drop("__place", "__first")


def sized_rows(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, hash and size of each text, settled; NULL texts have no bytes but those of a row."""
    return settle(
        docs.select(
            "doc_id", *more, F.monotonically_increasing_id().alias("__id"),
            F.xxhash64("text").alias("__key"),
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("__size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        ),
        "sized",
    )


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every document by the law of bytes; see ``assign_shards``."""
    return assign_shards(sized_rows(docs), shards).select("doc_id", *_assigned())


def _assigned() -> list[Column]:
    return [
        F.col("__size").alias("size"), F.col("text_crc32"), F.lit("bytes").alias("law"),
        F.col("shard"), F.col("slot"), F.lit(None).cast("int").alias("grown_shard"),
    ]


def sharded_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The documents themselves with their shard and slot, and the other columns of ``shard_documents``.

    Rows are numbered once, in a settled copy, for equal rows stand in different
    slots. Columns of ``docs`` that are named like the ones added go.
    """
    added = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")
    names = [c for c in docs.columns if c not in added]
    numbered = settle(held(docs).withColumn("__number", F.monotonically_increasing_id()), "documents")
    texts = numbered.select("__number", F.col(f"{WHOLE}.doc_id").alias("doc_id"), F.col(f"{WHOLE}.text").alias("text"))
    placed = assign_shards(sized_rows(texts, "__number"), shards).select(
        F.col("__number").alias("__of"), *_assigned()
    )
    both = numbered.select(WHOLE, "__number").join(placed, F.col("__number") == F.col("__of"))
    return both.select(*(F.col(f"{WHOLE}.`{c}`") for c in names), *added)


@query("op7_sampled_splitters")
def op7_sampled_splitters(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(table(spark, folder, "documents"))

"""Dense row keys and positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle

POSITION_BITS = 33


def in_positions(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in ``order`` with their range partition, ``__part``, and their ``__position`` from 0 over all rows.

    No task sees them all. The rows are range-partitioned and sorted, then each
    gets its partition number and its place there (``monotonically_increasing_id``
    holds both). Writing them down fixes these: range bounds come from a sample
    and would differ when computed again. One count per partition gives the
    position of its first row.
    """
    placed = settle(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
        .withColumn("__part", F.shiftright("__id", POSITION_BITS).cast("int")),
        "positions",
    )
    counts = placed.groupBy("__part").count().collect()  # one row per partition
    offsets, following = [], 0
    for part, count in sorted((row["__part"], row["count"]) for row in counts):
        offsets.append((part, following))
        following += count
    # As many rows as partitions, hence small enough to broadcast.
    firsts = df.sparkSession.createDataFrame(offsets, "__part int, __first bigint")
    place = F.col("__id").bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    return placed.join(F.broadcast(firsts), "__part").select(
        *df.columns, "__part", (F.col("__first") + place).alias("__position")
    )


def with_surrogate_key(
    df: DataFrame, name: str, order: Sequence[str], start: int = 1
) -> DataFrame:
    """Number all rows ``start``, ``start`` + 1, … in ``order``, without one task seeing them all."""
    return in_positions(df, order).select((F.col("__position") + start).alias(name), *df.columns)

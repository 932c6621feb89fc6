"""Consecutive surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tradeloom.session import cut_lineage

_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def with_surrogate(
    df: DataFrame, order: Sequence[Column], name: str = "utility_id", start: Column | int = 0
) -> DataFrame:
    """Append ids ``start+1 .. start+n`` in ``order``, which must rank rows uniquely.

    Rows are range-partitioned and sorted by all tasks; each row takes its position in its
    partition plus the number of rows in earlier partitions. The sorted rows are stored
    once, because a recomputed range partitioning could place rows differently.
    """
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    stored = cut_lineage(ordered).withColumns(
        {
            "_part": F.shiftright("_place", _POSITION_BITS),
            "_position": F.col("_place").bitwiseAND((1 << _POSITION_BITS) - 1),
        }
    )
    # One row per partition, so this window sees as many rows as there are partitions.
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = stored.groupBy("_part").agg(F.count("*").alias("_rows")).select(
        "_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before")
    )
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        stored.join(F.broadcast(offsets), "_part")
        .withColumn(name, (first + F.col("_before") + F.col("_position") + 1).cast("long"))
        .select(*df.columns, name)
    )

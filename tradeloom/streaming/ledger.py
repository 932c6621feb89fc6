"""Which batches a downstream step has processed, and runs over the rest."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.session import cut_lineage
from tradeloom.sources.publish import publish_partitions, published
from tradeloom.streaming.stores import read_or_empty

LEDGER = "step string, batch_id string, rows long, finished timestamp"


def processed_batches(spark: SparkSession, ledger: str, step: str) -> DataFrame:
    """Entries of one step."""
    return read_or_empty(spark, ledger, LEDGER).where(F.col("step") == step)


def pending_batches(registry: DataFrame, ledger: str, step: str) -> DataFrame:
    """``batch_id`` of the registered batches that the step has not recorded; rows without a batch wait for none."""
    known = registry.where("batch_id IS NOT NULL").select("batch_id").distinct()
    done = processed_batches(registry.sparkSession, ledger, step).select("batch_id")
    return known.join(done, "batch_id", "left_anti")


def run_pending(
    registry: DataFrame,
    landing: DataFrame,
    harmonise: Callable[[DataFrame], DataFrame],
    ledger: str,
    step: str,
    target: str,
) -> int:
    """Harmonise the landing rows of all pending batches into ``target`` and record them; returns their number.

    The pending batches are stored before any of their rows is read: one that is registered meanwhile waits for the
    next run. Rows are published by batch and recorded after that, so a run that fails in between is repeated
    as a whole and replaces what it had published. Batches without rows are recorded with 0.
    """
    spark = registry.sparkSession
    waiting = cut_lineage(pending_batches(registry, ledger, step))
    batches = waiting.count()
    if not batches:
        return 0
    rows = harmonise(landing.join(waiting, "batch_id", "left_semi"))
    publish_partitions(rows, target, ["batch_id"])
    written = published(spark, target, rows.schema).join(waiting, "batch_id", "left_semi")
    counted = waiting.join(written.groupBy("batch_id").agg(F.count("*").alias("rows")), "batch_id", "left")
    entries = counted.select(
        F.lit(step).alias("step"),
        "batch_id",
        F.coalesce("rows", F.lit(0)).cast("long").alias("rows"),
        F.current_timestamp().alias("finished"),
    )
    entries.coalesce(1).write.mode("append").parquet(ledger)
    return batches

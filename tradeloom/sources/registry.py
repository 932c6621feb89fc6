"""Batches and submissions in the file registry."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.companies import join_key
from tradeloom.functions.dates import submission_number


def batch_rows(df: DataFrame, batch_id: str, company: str | None = None) -> DataFrame:
    """Rows of one batch, optionally of one company, whatever its letter case."""
    rows = df.filter(F.col("batch_id") == batch_id)
    if company is not None:
        rows = rows.filter(join_key(F.col("company_name")) == company.strip().upper())
    return rows


def batch_companies(registry: DataFrame, batch_id: str) -> DataFrame:
    return batch_rows(registry, batch_id).select("company_name").distinct()


def latest_batch(registry: DataFrame, company: str | None = None) -> DataFrame:
    """One row with the batch ingested last; the higher id wins a tie."""
    known = registry.filter(F.col("batch_id").isNotNull())
    if company is not None:
        known = known.filter(join_key(F.col("company_name")) == company.strip().upper())
    return known.agg(
        F.max(F.struct("ingestion_time", "batch_id"))["batch_id"].alias("batch_id")
    ).filter(F.col("batch_id").isNotNull())


def resolve_batch(registry: DataFrame, explicit: str | None = None, job: str | None = None, company: str | None = None) -> str:
    """Batch to process: the one asked for, the one of the running job, or the latest."""
    if explicit or job:
        return explicit or job
    row = latest_batch(registry, company).first()
    if row is None:
        raise ValueError("The registry holds no batch")
    return row["batch_id"]


def submission(registry: DataFrame) -> DataFrame:
    """Arrival time and sortable submission number of every batch."""
    return (
        registry.filter(F.col("batch_id").isNotNull())
        .groupBy("batch_id")
        .agg(F.max("ingestion_time").alias("submission_ts"))
        .withColumn("submission_id", submission_number(F.col("submission_ts")))
    )

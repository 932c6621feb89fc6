"""Incremental registration of arriving files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tradeloom.streaming.stores import read_or_empty, stream_identity

COMPANY_PATTERN = r"^(company_\d+)_"  # default key at the start of a file name
# The columns the binary file source gives, stated so the stream needs no inference.
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"
PUBLISHED = "position int, generation string"


def file_stream(
    spark: SparkSession, folder: str, batch_id: str, company_pattern: str = COMPANY_PATTERN, **options: str
) -> DataFrame:
    """Stream of file metadata under ``folder``; contents are never selected, so not read."""
    path = F.col("path")
    return (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .options(**options)
        .load(folder)
        .select(
            "path",
            "modificationTime",
            "length",
            F.lit(batch_id).alias("batch_id"),
            F.current_timestamp().alias("ingestion_time"),
            F.col("_metadata.file_name").alias("file_name"),
            F.col("_metadata.file_size").alias("file_size"),
            F.regexp_extract(F.col("_metadata.file_name"), company_pattern, 1).alias("company_name"),
            F.regexp_replace(path, "^[a-z0-9]+:(?://(?=/))?", "").alias("file_path"),
            F.element_at(F.split(path, r"\."), -1).alias("file_extension"),
        )
    )


def _published(spark: SparkSession, target: str) -> Row | None:
    """The generation published last."""
    known = read_or_empty(spark, f"{target}/published", PUBLISHED)
    return known.agg(F.max(F.struct("position", "generation")).alias("newest")).first()["newest"]


def register_files(
    spark: SparkSession,
    folder: str,
    batch_id: str,
    target: str,
    checkpoint: str,
    company_pattern: str = COMPANY_PATTERN,
    full_refresh: bool = False,
    **options: str,
) -> DataFrame:
    """Register the files that arrived since the last run, then return the registry.

    A registry is a generation: a folder of its own below ``target`` and a checkpoint of its
    own below ``checkpoint`` that remembers the files seen. The first run and every full
    refresh fill a new generation and publish it when the stream has drained, so a refresh
    that fails leaves the registry as it was. Later runs go on with the published one; they
    fail where its checkpoint is missing, because files would be registered twice. Runs on
    one target must not overlap.
    """
    newest = _published(spark, target)
    fresh = full_refresh or newest is None
    generation = uuid.uuid4().hex if fresh else newest["generation"]
    own = f"{checkpoint}/{generation}"
    if not fresh and stream_identity(spark, own) is None:
        raise ValueError(f"{own} holds no checkpoint of {target}; give the one in use or ask for a full refresh")
    stream = file_stream(spark, folder, batch_id, company_pattern, **options)
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{target}/generations/{generation}")
        .option("checkpointLocation", own)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if fresh:
        position = 0 if newest is None else newest["position"] + 1
        entry = spark.createDataFrame([(position, generation)], PUBLISHED)
        entry.coalesce(1).write.mode("append").parquet(f"{target}/published")
    return read_or_empty(spark, f"{target}/generations/{generation}", stream.schema)

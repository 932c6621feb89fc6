"""Corrected reports arriving as a stream: the newest submission of a key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructType

from tradeloom.plans.marts import latest_version
from tradeloom.session import file_system
from tradeloom.sources.publish import publish_partitions, published
from tradeloom.streaming.stores import read_or_empty, stream_identity

BUCKETS = 16  # parts of the current rows of a new target; keys are dealt to them by hash
ROWS_PER_BUCKET = 5_000_000  # beyond it on average, buckets are doubled
OWNER = "origin string, buckets int"


def _owner(spark: SparkSession, target: str):
    return read_or_empty(spark, f"{target}/owner", OWNER).first()


def land_batch(batch: DataFrame, folder: str) -> None:
    batch.write.mode("overwrite").parquet(folder)


def append_submissions(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], buckets: int = BUCKETS
) -> None:
    """Land every micro-batch in its own ``_epoch`` folder of the target's log until the source is drained.

    A batch that is replayed after a failure overwrites its own folder, so each row is
    stored exactly once without a transactional table format. Epochs are numbered by the
    checkpoint; the target therefore belongs to the first one that wrote to it, and any
    other is refused. The number of buckets stays as the target began.
    """
    spark = stream.sparkSession
    owner = _owner(spark, target)
    if owner is not None and owner["origin"] != stream_identity(spark, checkpoint):
        raise ValueError(f"{target} belongs to another checkpoint than {checkpoint}")
    parts = owner["buckets"] if owner is not None else buckets

    def land(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        if _owner(session, target) is None:
            claim = session.createDataFrame([(stream_identity(session, checkpoint), parts)], OWNER)
            claim.coalesce(1).write.mode("overwrite").parquet(f"{target}/owner")
        land_batch(batch, f"{target}/log/_epoch={epoch}")

    query = (
        stream.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def _log(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    return read_or_empty(spark, f"{target}/log", StructType([*schema.fields]).add("_epoch", LongType()))


def _placed(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("_epoch", LongType()).add("_bucket", IntegerType())


def _buckets(spark: SparkSession, target: str) -> int:
    """Parts of the current rows: the layout written last has the most."""
    grown = read_or_empty(spark, f"{target}/layout", "buckets int").agg(F.max("buckets")).first()[0]
    owner = _owner(spark, target)
    return grown or (owner["buckets"] if owner is not None else BUCKETS)


def _dealt(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    return rows.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def refresh_current(
    spark: SparkSession,
    target: str,
    schema: StructType,
    keys: Sequence[str],
    version: str,
    rows_per_bucket: int = ROWS_PER_BUCKET,
) -> None:
    """Merge the epochs that landed since the last refresh into the current rows of the keys they touch.

    Earlier epochs are never read again: a key's current rows stand for them. Only the buckets of touched keys are read
    and published in place. Current rows know their epoch; those of a refresh that was published and not recorded
    are left out when it is repeated, because its epochs are merged again.
    """
    applied = read_or_empty(spark, f"{target}/applied", "epoch long").agg(F.max("epoch")).first()[0]
    applied = -1 if applied is None else applied
    buckets = _buckets(spark, target)
    fresh = _dealt(_log(spark, target, schema).where(F.col("_epoch") > applied), keys, buckets)
    touched = fresh.groupBy("_bucket").agg(F.max("_epoch").alias("epoch")).collect()  # a row for each bucket
    if not touched:
        return
    folder = f"{target}/current/{buckets}"
    current = published(spark, folder, _placed(schema))
    known = current.where(F.col("_bucket").isin([r["_bucket"] for r in touched]) & (F.col("_epoch") <= applied))
    merged = latest_version(known.unionByName(fresh), [F.col(k) for k in keys], version)
    publish_partitions(merged, folder, ["_bucket"])
    done = spark.createDataFrame([(max(r["epoch"] for r in touched),)], "epoch long")
    done.coalesce(1).write.mode("append").parquet(f"{target}/applied")
    _grow(spark, target, schema, keys, buckets, rows_per_bucket)


def _grow(
    spark: SparkSession, target: str, schema: StructType, keys: Sequence[str], buckets: int, rows_per_bucket: int
) -> None:
    """Deal the current rows to more buckets once they hold too many, so that what a refresh rewrites stays bounded."""
    folder = f"{target}/current/{buckets}"
    current = published(spark, folder, _placed(schema))
    rows, wanted = current.count(), buckets  # counted from the file footers
    while wanted * rows_per_bucket < rows:
        wanted *= 2
    if wanted == buckets:
        return
    publish_partitions(_dealt(current, keys, wanted), f"{target}/current/{wanted}", ["_bucket"])
    spark.createDataFrame([(wanted,)], "buckets int").coalesce(1).write.mode("append").parquet(f"{target}/layout")
    files, place = file_system(spark, folder)
    files.delete(place, True)


def current_submissions(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """Rows of the newest version of each key among everything landed so far."""
    folder = f"{target}/current/{_buckets(spark, target)}"
    return published(spark, folder, _placed(schema)).drop("_bucket", "_epoch")


def apply_resubmissions(
    stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], version: str
) -> DataFrame:
    append_submissions(stream, target, checkpoint, keys)
    refresh_current(stream.sparkSession, target, stream.schema, keys, version)
    return current_submissions(stream.sparkSession, target, stream.schema)

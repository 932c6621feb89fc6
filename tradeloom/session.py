"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every plan relies on. AQE re-plans shuffle joins whose measured
# side turns out small, and splits partitions that one hot key makes too large.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(app_name: str = "tradeloom", master: str | None = None, **extra: str) -> SparkSession:
    """Create a session with the runtime settings; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost together with its executor.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("Set spark.checkpoint.dir to a folder shared by all executors")
    created = tempfile.mkdtemp(prefix="tradeloom-")
    spark.conf.set("spark.checkpoint.dir", created)
    return created


# Paths stored by the innermost block of ``intermediates``; None outside of one.
_STORED: ContextVar[list[str] | None] = ContextVar("stored", default=None)


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system and path object of ``path``."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Delete the tables that ``cut_lineage`` stores inside the block when it ends, also after an error.

    Results that read them must be written or collected inside the block. Blocks may be nested; each deletes its own.
    """
    stored: list[str] = []
    token = _STORED.set(stored)
    try:
        yield stored
    finally:
        _STORED.reset(token)
        for path in stored:
            files, place = file_system(spark, path)
            files.delete(place, True)


# With this setting Spark removes the shuffle files of a job when it ends, not when the driver's garbage is collected.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _new_table(spark: SparkSession) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/tradeloom-{uuid.uuid4().hex}"
    if (stored := _STORED.get()) is not None:
        stored.append(path)
    return path


def _store(df: DataFrame, path: str, compression: str | None = None) -> None:
    """Add the rows of ``df`` to the table at ``path``; the shuffle files of its job are gone afterwards."""
    settings = df.sparkSession.conf
    before = settings.get(SHUFFLE_CLEANUP, "false")
    settings.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path, mode="append", compression=compression)
    finally:
        settings.set(SHUFFLE_CLEANUP, before)


def _stored(df: DataFrame, path: str) -> DataFrame:
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._stored_at = path
    return back


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    Later uses agree on its rows, survive lost executors, read only the columns they need,
    and know its size, so Spark can broadcast it when it is small. ``compression`` is the
    session's if none is given.
    """
    path = _new_table(df.sparkSession)
    _store(df, path, compression)
    return _stored(df, path)


def in_slice(key: Column, number: int, count: int) -> Column:
    """Rows of one of ``count`` slices. Equal keys of one type share a slice, and so do all NULL keys."""
    return F.pmod(F.xxhash64(key), F.lit(count)) == number if count > 1 else F.lit(True)


def in_slices(
    spark: SparkSession,
    count: int,
    build: Callable[..., DataFrame],
    prepare: Callable[[], tuple] = tuple,
) -> DataFrame:
    """The rows of ``build(number, *prepare())`` for all numbers below ``count``, stored slice by slice.

    What a slice stores on its way and its shuffle files are deleted before the next one begins, what ``prepare``
    stores for all of them after the last: the disk holds that, the result and one slice. A single slice stays lazy.
    """
    if count == 1:
        return build(0, *prepare())
    path = _new_table(spark)
    with intermediates(spark):
        prepared = prepare()
        for number in range(count):
            with intermediates(spark):
                part = build(number, *prepared)
                _store(part, path, "zstd")
    return _stored(part, path)


def stored_bytes(stored: DataFrame) -> int:
    """Size of the files of a table that ``cut_lineage`` returned."""
    files, place = file_system(stored.sparkSession, stored._stored_at)
    return files.getContentSummary(place).getLength()

"""Intermediate tables in the shared folder, deleted as soon as nothing reads them any more."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from tradeloom.session import shared_folder


class Tables:
    """Writes DataFrames below ``spark.checkpoint.dir`` and remembers which are still on disk."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.made = 0
        self.live: set[str] = set()

    def put(self, df: DataFrame) -> DataFrame:
        self.made += 1
        path = f"{self.folder}/{self.made}"
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._tradeloom_path = path
        self.live.add(path)
        return back

    def drop(self, *frames: DataFrame) -> None:
        self._delete(df._tradeloom_path for df in frames)

    def keep_only(self, *frames: DataFrame) -> None:
        """Delete every table but those of ``frames``."""
        self._delete(self.live - {df._tradeloom_path for df in frames})

    def keep_since(self, before: set[str], *frames: DataFrame) -> None:
        """Delete the tables made since ``live`` was ``before``, but those of ``frames``."""
        self._delete(self.live - before - {df._tradeloom_path for df in frames})

    def _delete(self, paths: Iterable[str]) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name in list(paths):
            path = hadoop.Path(name)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
            self.live.discard(name)
        # Shuffle files of finished jobs go when the driver's garbage collector finds their plans unused.
        self.spark._jvm.System.gc()

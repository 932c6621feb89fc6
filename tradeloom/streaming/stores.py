"""Reading what streams leave behind."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_or_empty(spark: SparkSession, path: str, schema: str | StructType, source: str = "parquet") -> DataFrame:
    """The table at ``path``, without rows where nothing was written yet."""
    try:
        return spark.read.schema(schema).format(source).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stream_identity(spark: SparkSession, checkpoint: str) -> str | None:
    """The id that the stream of a checkpoint keeps over restarts; None before its first run."""
    known = read_or_empty(spark, f"{checkpoint}/metadata", "id string", "json").first()
    return known and known["id"]

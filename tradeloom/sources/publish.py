"""Publishing a table by partition: rows are staged, checked, and swapped into place.

A table is a folder of Parquet files below ``column=value`` folders. A publish touches the partitions of its rows
only. It writes them to ``_staged``, checks what was written, renames that folder into ``_ready`` - from then on the
publish is decided - and swaps its partitions one by one. A publish that died before the rename has changed nothing;
one that died after it is completed by the next writer or reader. Spark does not list folders that begin with an
underscore, so neither is ever read as data. Writers of one table must not overlap.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tradeloom.operators.quality import CONTROL_DECIMAL, control_totals, rows_from
from tradeloom.session import file_system
from tradeloom.streaming.stores import read_or_empty

STAGED, READY = "_staged", "_ready"


class ReconciliationError(ValueError):
    """What was staged is not what was read; the target is as it was."""


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], **metrics: Column) -> dict:
    """Write ``df`` and return its row count (``rows``) and other aggregates, taken while the rows pass by.

    The rows are computed once: nothing is counted before or after.
    """
    watch = Observation(f"write-{uuid.uuid4().hex}")
    named = [m.alias(name) for name, m in metrics.items()]
    write(df.observe(watch, F.count(F.lit(1)).alias("rows"), *named))
    return watch.get


class _Folder:
    """The folder of one table on the file system that its path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._files, _ = file_system(spark, path)
        self._spark = spark

    def _at(self, name: str):
        return file_system(self._spark, f"{self.path}/{name}" if name else self.path)[1]

    def exists(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def folders(self, name: str) -> list[str]:
        """Names of the folders below ``name``."""
        if not self.exists(name):
            return []
        return sorted(s.getPath().getName() for s in self._files.listStatus(self._at(name)) if s.isDirectory())

    def delete(self, name: str) -> None:
        self._files.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        self._files.mkdirs(self._at(to).getParent())
        if not self._files.rename(self._at(name), self._at(to)):
            raise OSError(f"{self.path}: could not move {name} to {to}")

    def partitions(self, name: str) -> list[str]:
        """Paths of the innermost ``column=value`` folders, relative to ``name``."""
        found = []
        for child in self.folders(name):
            if "=" in child:
                inner = self.partitions(f"{name}/{child}" if name else child)
                found += [f"{child}/{p}" for p in inner] or [child]
        return found


def _swap(folder: _Folder, run: str) -> None:
    for part in folder.partitions(f"{READY}/{run}"):
        folder.delete(part)
        folder.move(f"{READY}/{run}/{part}", part)
    folder.delete(f"{READY}/{run}")


def recover(spark: SparkSession, target: str) -> None:
    """Complete the publish that was decided and not finished; forget those that were not decided."""
    folder = _Folder(spark, target)
    for run in folder.folders(READY):
        _swap(folder, run)
    folder.delete(STAGED)


def published(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The rows of a table; without rows where nothing was published yet."""
    recover(spark, target)
    return read_or_empty(spark, target, schema)


def publish_partitions(
    df: DataFrame,
    target: str,
    by: Sequence[str],
    check: Callable[[DataFrame], None] | None = None,
) -> int:
    """Replace the partitions of ``target`` that ``df`` has rows of and return the number of rows written.

    ``check`` gets the staged rows as they were stored and raises to discard them. Files of other partitions are
    neither read nor written; the same rows published again give the same table.
    """
    spark = df.sparkSession
    recover(spark, target)
    folder, run = _Folder(spark, target), uuid.uuid4().hex
    staged = f"{folder.path}/{STAGED}/{run}"
    try:
        seen = observed_write(df, lambda rows: rows.write.partitionBy(*by).parquet(staged))
        stored = read_or_empty(spark, staged, df.schema) if seen["rows"] else spark.createDataFrame([], df.schema)
        written = stored.count()  # from the file footers
        if written != seen["rows"]:
            raise ReconciliationError(f"{target}: {seen['rows']} rows were to be written, {written} are stored")
        if check is not None:
            check(stored)
    except BaseException:
        folder.delete(f"{STAGED}/{run}")
        raise
    folder.move(f"{STAGED}/{run}", f"{READY}/{run}")
    _swap(folder, run)
    return written


def reconciliation(expected: DataFrame, loaded: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``metric, expected, loaded, passed`` of two one-row control totals."""
    metrics = ("row_count", *columns)
    typed = {m: F.col(m).cast(CONTROL_DECIMAL) for m in metrics}
    ours = rows_from(expected, typed, "metric", "expected")
    theirs = rows_from(loaded, typed, "metric", "loaded")
    return ours.join(theirs, "metric").withColumn("passed", F.col("expected") == F.col("loaded"))


def load_reconciled(
    batch: DataFrame,
    expected: DataFrame,
    target: str,
    by: Sequence[str] = ("batch_id",),
    columns: Sequence[str] = ("quantity", "gross_sales"),
) -> int:
    """Stage a batch, compare its control totals with those of the source, then publish it or discard it.

    ``expected`` is one row of control totals of what the source holds, from its text, not from ``batch``. A batch
    that does not add up raises and leaves the target as it was; a batch loaded again replaces itself.
    """

    def check(staged: DataFrame) -> None:
        outcome = reconciliation(expected, control_totals(staged, columns), columns).collect()  # a row for each metric
        wrong = [f"{r['metric']}: expected {r['expected']}, staged {r['loaded']}" for r in outcome if not r["passed"]]
        if wrong:
            raise ReconciliationError(f"{target}: " + "; ".join(sorted(wrong)))

    return publish_partitions(batch, target, by, check)

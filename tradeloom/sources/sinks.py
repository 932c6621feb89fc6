"""Writing tables: replace, append, insert what is missing, replace a period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.operators.joins import equal_keys
from tradeloom.session import cut_lineage
from tradeloom.sources.publish import observed_write

PRUNE_VALUES = 10_000  # values of a partition column that become literals of a filter
PANEL_KEYS = ("company", "item_code", "date", "customer", "channel", "_original_period")


def touched(target: DataFrame, source: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of ``target`` with a value of each of ``columns`` that ``source`` has too; NULL equals NULL.

    The values become literals, which prune partitions of the target before any file of them is read. A column
    with more than PRUNE_VALUES of them is left to the join that follows.
    """
    for name in columns:
        found = [r[0] for r in source.select(name).distinct().limit(PRUNE_VALUES + 1).collect()]
        if len(found) <= PRUNE_VALUES:
            given = F.col(name).isin([v for v in found if v is not None])
            target = target.where(given | F.col(name).isNull() if None in found else given)
    return target


def insert_only(
    target: DataFrame, source: DataFrame, keys: Sequence[str], partitioned_by: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``source`` whose key ``target`` lacks; NULL keys equal NULL.

    The target keys are reduced to distinct ones first, so a frequent key is shuffled once
    per map task, not once per row. Of a target that is ``partitioned_by`` some of the keys only the
    partitions that the source touches are read.
    """
    known = touched(target, source, [c for c in partitioned_by if c in keys]).select(*keys).distinct()
    return source.join(known, equal_keys(source, known, keys, null_safe=True), "left_anti")


def replace_period(target: DataFrame, source: DataFrame, period: str = "_original_period") -> DataFrame:
    """Content of ``target`` after ``source`` replaced the periods it covers."""
    renewed = source.select(period).distinct()
    kept = target.join(renewed, equal_keys(target, renewed, [period], null_safe=True), "left_anti")
    return kept.unionByName(source)


def replace_batch(target: DataFrame, source: DataFrame) -> DataFrame:
    """Content of ``target`` after a rerun of the batches in ``source``: no double counting."""
    return replace_period(target, source, "batch_id")


def overwrite_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a table and its schema."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    df.write.mode("append").saveAsTable(table)


def merge_table(df: DataFrame, table: str, keys: Sequence[str]) -> None:
    """Append the rows whose key the table lacks; create the table if it is absent.

    A partitioned table stays so, and of its partitions only those that the rows touch are read.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        append_table(df, table)
        return
    partitions = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    staged = cut_lineage(df) if partitions else df  # read for the partitions and for the join
    fresh = insert_only(spark.table(table), staged, keys, partitions).select(*spark.table(table).columns)
    (fresh.write.partitionBy(*partitions) if partitions else fresh.write).mode("append").saveAsTable(table)


def write_verified(df: DataFrame, table: str) -> None:
    """Replace a table and fail if it does not hold the rows that were to be written.

    The rows are counted while they are written, those stored from the files' footers.
    """
    expected = observed_write(df, lambda rows: overwrite_table(rows, table))["rows"]
    written = df.sparkSession.table(table).count()
    if written != expected:
        raise ValueError(f"{table}: expected {expected}, wrote {written}")


def existing_tables(spark, names: Sequence[str]) -> dict[str, DataFrame | None]:
    """Each named table, or None where the catalog has none."""
    return {n: spark.table(n) if spark.catalog.tableExists(n) else None for n in names}


def require_tables(spark, names: Sequence[str]) -> None:
    missing = [n for n in names if not spark.catalog.tableExists(n)]
    if missing:
        raise ValueError(f"Tables not found: {missing}")


def inline_table(spark, rows, schema: str) -> DataFrame:
    """Configured rows as a table."""
    return spark.createDataFrame(list(rows), schema)


def non_empty(df: DataFrame) -> bool:
    return not df.isEmpty()


__all__ = [
    "PANEL_KEYS", "append_table", "existing_tables", "inline_table", "insert_only", "merge_table",
    "non_empty", "overwrite_table", "replace_batch", "replace_period", "require_tables",
    "write_verified",
]

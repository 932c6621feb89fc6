"""A corpus pipeline: each stage works on the documents its predecessor kept, written and read as Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import jaccard_join, passages, queries
from tradeloom.llm.store import Tables


def _apart(docs: DataFrame) -> tuple[DataFrame, list]:
    """What a judging stage reads and, in one column, all others, whose names may clash with its own; and the way back."""
    others = [c for c in docs.columns if c != "text"]
    held = F.struct(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)]).alias("_others")
    back = {c: F.col("_others").getField(f"_{i}").alias(c) for i, c in enumerate(others)}
    return docs.select("doc_id", "text", "lang", "source", held), [back.get(c, F.col("text")) for c in docs.columns]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    rows, back = _apart(docs)
    found = queries.judged_quality(rows, queries.table(spark, sf_dir, "labels"), ["text", "_others"])
    return found.where("good").select(*back)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not predict toxic."""
    rows, back = _apart(docs)
    found = queries.toxic_scores(rows, queries.table(spark, sf_dir, "labels"), ["text", "_others"])
    return found.where("score < 0.5").select(*back)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of those with the smallest id (NULL is the largest) the first in a
    stored table. Rows that repeat an id and rows without one are rows like all others."""
    tables = Tables(spark)
    columns = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)]
    rows = tables.put(docs.select(F.monotonically_increasing_id().alias("row"), *columns))
    back = dict(zip(docs.columns, (f"_{i}" for i in range(len(docs.columns)))))
    # Rows take the place of ids, so every row has a name of its own.
    named = rows.select(F.col("row").alias("doc_id"), F.col(back["text"]).alias("text"))
    found = jaccard_join.jaccard_classes(named, tables).select(F.col("doc_id").alias("row"), "class_id")
    order = F.struct(F.col(back["doc_id"]).isNull().alias("none"), F.col(back["doc_id"]).alias("id"), "row")
    first = rows.join(found, "row").groupBy("class_id").agg(F.min(order).alias("least"))
    kept = first.select(F.col("least.row").alias("row"))
    return rows.join(kept, "row").select(*[F.col(back[c]).alias(c) for c in docs.columns])


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that repeat one of a smaller id; n_chars follows the text."""
    found = passages.remove_passages(docs, Tables(spark))
    return found.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars")).select(*docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of the documents, placed into sequences."""
    return queries.packed_rows(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("substring dedup", passage_stage),
    ("best-fit packing", packing_stage),
]

ORACLE_SQL = None  # SQL cannot express the stages; tests/llm compares them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = queries.table(spark, sf_dir, "documents")
    tables = Tables(spark)
    for k, (_, stage) in enumerate(STAGES[:-1]):
        kept = tables.put(stage(spark, docs, sf_dir))
        if k:
            tables.drop(docs)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)

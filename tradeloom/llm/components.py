"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.store import Tables


def _largest_first(edges: DataFrame) -> DataFrame:
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return pairs.distinct()


def components(edges: DataFrame, tables: Tables, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b longs); component is the smallest node reached.

    Each round hangs the larger neighbours of a node under its smallest neighbour, then the smaller ones.
    Both are an aggregate and a join on the node, whose hot partitions Spark splits; edges never multiply.
    NULL ends are ignored. Fails rather than return a partial result.
    """
    now = tables.put(_largest_first(edges))
    mark = None
    for _ in range(rounds):
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
        both = now.select("a", "b").unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = _largest_first(large)
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = least.select("a", F.col("m").alias("b")).unionAll(hung)
        after = tables.put(_largest_first(small))
        tables.drop(now)
        now = after
    else:
        raise RuntimeError(f"Components did not settle in {rounds} rounds")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)

"""Join helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.session import cut_lineage, stored_bytes

# A side is broadcast only after it was stored and its files found to be at most this large.
BROADCAST_BYTES = 16 * 1024 * 1024


def measured(lookup: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Store an aggregated lookup and broadcast it only if its files are small, however long its rows are.

    A larger lookup comes back without a hint, so Spark joins it by shuffle and AQE
    splits the partitions of hot keys. Use it where the other side is the whole fact
    table: a small lookup then spares shuffling the facts.
    """
    stored = cut_lineage(lookup)
    return F.broadcast(stored) if stored_bytes(stored) <= limit else stored


def proven_unique(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key; a key with several rows fails the query that reads it and is named in the error.

    The proof is part of the lookup's own aggregate: the facts that are joined to it are never counted. NULL keys
    are keys like any other.
    """
    others = [c for c in lookup.columns if c not in keys]
    grouped = lookup.groupBy(*keys).agg(F.count("*").alias("_rows"), *[F.first(c).alias(c) for c in others])
    named = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    refused = F.raise_error(F.concat(F.lit("Lookup key has several rows: "), named)).cast("boolean")
    return grouped.where(F.when(F.col("_rows") == 1, F.lit(True)).otherwise(refused)).select(*lookup.columns)


def equal_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str | tuple[str, str]], null_safe: bool = False
) -> Column:
    """Conjunction of key equalities; with ``null_safe`` NULL equals NULL."""
    pairs = [(k, k) if isinstance(k, str) else k for k in keys]
    conditions = [
        left[a].eqNullSafe(right[b]) if null_safe else left[a] == right[b] for a, b in pairs
    ]
    return reduce(and_, conditions)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    keys: dict[str, Column],
    take: Sequence[str],
    null_safe: bool = False,
    unique: bool = True,
) -> DataFrame:
    """Left join that keeps every fact row and appends the ``take`` columns of ``lookup``.

    ``keys`` maps a lookup column to the fact expression it must equal. The lookup must
    be unique on those columns; where that is not known, ``unique=False`` proves it in the
    same job (see ``proven_unique``). Fact columns with a taken name are replaced.
    """
    if not unique:
        lookup = proven_unique(lookup.select(*keys, *take), list(keys))
    kept = [name for name in facts.columns if name not in take]
    named = {name: f"_lookup_{i}" for i, name in enumerate(keys)}
    right = lookup.select(
        *[F.col(name).alias(alias) for name, alias in named.items()],
        *[F.col(name).alias(f"_take_{name}") for name in take],
    )
    conditions = [
        expression.eqNullSafe(F.col(named[name])) if null_safe else expression == F.col(named[name])
        for name, expression in keys.items()
    ]
    joined = facts.join(right, reduce(and_, conditions), "left")
    return joined.select(
        *[F.col(name) for name in kept], *[F.col(f"_take_{name}").alias(name) for name in take]
    )

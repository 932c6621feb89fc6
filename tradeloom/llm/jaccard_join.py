"""Operator 9: Jaccard join of word n-gram sets by chosen paths."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.blocks import Words, map_texts, mix
from tradeloom.llm.components import components
from tradeloom.llm.store import Tables

SIGNATURE = 64  # min-hashes that stand for a set in the tree
THRESHOLD = (4, 5)  # similarity 0.8 as a fraction, compared in whole numbers
RECALL = 0.999  # of pairs at the threshold; more similar ones are found more often
DEPTH = 4  # levels of splitting before a bucket counts as dense
SMALL = 48  # members of a bucket that is compared at once
BLOCK = 256  # members of one block of a dense bucket; blocks are compared in pairs
NO_ID = -(2**63)  # stands for a NULL doc_id


def runs_needed(recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs after which a pair at the threshold has met in a bucket with probability ``recall``.

    In one level a pair at the threshold shares one chosen token on average, so the levels are a critical
    branching process.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    shingles, bounds = Words(texts).shingles()
    return [np.unique(shingles[a:b]) for a, b in zip(bounds, bounds[1:])]


def digest(values: np.ndarray) -> int:
    """A 64-bit name of a set: equal sets have equal names."""
    with np.errstate(over="ignore"):
        total = np.uint64(len(values)) * np.uint64(0x9E3779B97F4A7C15) + mix(values).sum(dtype=np.uint64)
    return int(mix(np.array([total]))[0].view(np.int64)) if len(values) else 0


def signature(values: np.ndarray) -> np.ndarray:
    """The smallest of each hash function over a set, as 32-bit integers."""
    out = np.full(SIGNATURE, 0xFFFFFFFF, dtype=np.uint64)
    for start in range(0, len(values), 4096):
        hashed = (values[None, start : start + 4096] * FACTORS[:, None]) >> np.uint64(32)
        out = np.minimum(out, hashed.min(axis=1))
    return out.astype(np.uint32)


FACTORS = mix(np.arange(1, SIGNATURE + 1, dtype=np.uint64)) | np.uint64(1)


def _sketch(texts: list[str]) -> list[pa.Array]:
    sets = shingle_sets(texts)
    marks = [signature(s).view(np.int32) if len(s) else None for s in sets]
    return [
        pa.array([digest(s) for s in sets], pa.int64()),
        pa.array([len(s) for s in sets], pa.int32()),
        pa.array(marks, pa.list_(pa.int32())),
    ]


def _split(rows: DataFrame) -> DataFrame:
    """Children (bucket, node) of every (bucket, node, marks) row: one for each token that the bucket's seed samples."""
    share = THRESHOLD[1] / (THRESHOLD[0] * SIGNATURE)
    seeds = F.filter(
        F.sequence(F.lit(0), F.lit(SIGNATURE - 1)),
        lambda i: F.pmod(F.xxhash64("bucket", i), F.lit(1 << 30)) < int(share * (1 << 30)),
    )
    spread = rows.select("bucket", "node", "marks", F.explode(seeds).alias("i"))
    return spread.select(F.xxhash64("bucket", "i", F.get("marks", F.col("i"))).alias("bucket"), "node")


def _promising(batches):
    """Of each bucket the members that some other member resembles by its marks, split where none connects them.

    A pair at the threshold agrees on fewer than half of its marks with probability below 1 in 10 million.
    """
    for batch in batches:
        out = []
        for members in batch.column(0).to_pylist():
            marks = np.array([m["marks"] for m in members], dtype=np.int64)
            alike = (marks[:, None, :] == marks[None, :, :]).sum(axis=2) * 2 >= SIGNATURE
            place = np.arange(len(members))
            while True:
                after = np.where(alike, place[None, :], len(members)).min(axis=1)
                if (after == place).all():
                    break
                place = after
            for low in np.unique(place):
                own = np.flatnonzero(place == low)
                if len(own) > 1:
                    out.append(sorted(members[i]["node"] for i in own))
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], ["members"])


def chosen_paths(nodes: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Small buckets (members) and rows (bucket, node) of dense ones, from nodes (node, marks).

    Every run starts a tree of its own. A bucket splits on tokens that its seed samples until it is small or
    DEPTH levels deep; single members drop out. Equal buckets of several runs are looked at once.
    """
    starts = F.explode(F.array(*[F.lit(r).cast("long") for r in range(runs_needed())])).alias("bucket")
    rows, small = _split(nodes.select(starts, "node", "marks")), []
    dense = None
    for level in range(DEPTH):
        rows = tables.put(rows)
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        few = rows.join(sizes.where(f"n <= {SMALL}"), "bucket").groupBy("bucket")
        few = few.agg(F.sort_array(F.collect_list("node")).alias("members")).select("members")
        small.append(tables.put(few.distinct()))
        many = rows.join(sizes.where(f"n > {SMALL}").select("bucket"), "bucket")
        if level + 1 < DEPTH:
            after = tables.put(_split(many.join(nodes.select("node", "marks"), "node")))
            tables.drop(rows)
            rows = after
        else:
            dense = tables.put(many.select("bucket", "node"))
            tables.drop(rows)
    found = reduce(DataFrame.unionAll, small).distinct()
    members = found.select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("node"))
    marked = members.join(nodes.select("node", "marks"), "node").groupBy("bucket")
    marked = marked.agg(F.collect_list(F.struct("node", "marks")).alias("members")).select("members")
    return marked.mapInArrow(_promising, "members array<long>").distinct(), dense


def compare(group: pa.Table) -> pa.Table:
    """Links inside one bucket, or between two blocks of a dense one.

    Counts a pair only in the first bucket (by number) that holds both, and a pair of one block only where the
    block meets itself; returns each member's linked documents and the smallest member it is connected to.
    """
    bucket, first, second = (group.column(c)[0].as_py() for c in ("bucket", "first", "second"))
    _, one_each = np.unique(group.column("node").to_numpy(), return_index=True)  # ids that repeat bring a node twice
    group = group.take(pa.array(one_each))
    names = group.column("node").to_numpy()
    block = group.column("block").to_numpy()
    copies = group.column("copies").to_numpy().astype(float)
    n = len(names)
    sizes = group.column("size").to_numpy().astype(np.int64)
    sets = group.column("tokens").combine_chunks()
    tokens, owner = sets.flatten().to_numpy(), np.repeat(np.arange(n), sizes)
    _, column, uses = np.unique(tokens, return_inverse=True, return_counts=True)
    shared = uses[column] > 1
    column, owner = np.unique(column[shared], return_inverse=True)[1], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), dtype=np.float32)
    width = 4096
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [start, start + width])
        part = np.zeros((n, width), dtype=np.float32)
        part[owner[a:b], column[a:b] - start] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    union = sizes[:, None] + sizes[None, :] - both
    linked = THRESHOLD[1] * both >= THRESHOLD[0] * union
    np.fill_diagonal(linked, False)
    if first != second:
        linked &= block[:, None] != block[None, :]
    lists = group.column("buckets").to_pylist()
    earlier = sorted({b for own in lists for b in own if b < bucket})
    if earlier:
        place = {b: i for i, b in enumerate(earlier)}
        held = np.zeros((n, len(earlier)), dtype=np.float32)
        for i, own in enumerate(lists):
            held[i, [place[b] for b in own if b < bucket]] = 1
        counted = linked & (held @ held.T == 0)
    else:
        counted = linked
    least = np.arange(n)
    rank = np.argsort(names)
    linked, position = linked[np.ix_(rank, rank)], np.arange(n)
    while True:
        seen = np.where(linked, position[None, :], n).min(axis=1, initial=n)
        after = np.minimum(position, seen)
        after = after[after]
        if (after == position).all():
            break
        position = after
    least[rank] = rank[position]
    out = [pa.array(names), pa.array((counted @ copies).astype(np.int64)), pa.array(names[least])]
    return pa.Table.from_arrays(out, ["node", "links", "root"])


def jaccard_classes(docs: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """doc_id, class_id and n_links of every document: links are other documents of Jaccard similarity >= 0.8.

    Sets are those of five-word shingles (a shorter text is one shingle); class_id is the smallest doc_id
    reachable by links. Texts without words (NULL, empty) link with nothing. Documents with equal sets are one
    node from the start, so copies are neither joined nor expanded. Rows with one doc_id are documents that
    share a name; NULL ids are kept. Pairs stay inside tasks: only sums and one edge per member leave them.
    """
    plain = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.coalesce(f"`{text}`", F.lit("")).alias("text"))
    kinds = [
        T.StructField("node", T.LongType()),
        T.StructField("size", T.IntegerType()),
        T.StructField("marks", T.ArrayType(T.IntegerType())),
    ]
    sketches = tables.put(map_texts(plain, ["id"], "text", _sketch, kinds))
    full = sketches.where("size > 0")
    known_id = F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("first_id")
    nodes = full.groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("id"), known_id, F.min("marks").alias("marks"))
    nodes = tables.put(nodes)
    small, dense = chosen_paths(nodes.select("node", "marks"), tables)
    small = small.select(F.xxhash64("members").alias("bucket"), F.explode("members").alias("node"))
    # Dense buckets that overlap, of whatever run, are compared as one.
    star = dense.groupBy("bucket").agg(F.min("node").alias("least"))
    joined = dense.join(star, "bucket").select(F.col("node").alias("a"), F.col("least").alias("b"))
    merged = components(joined, tables).select(F.col("component").alias("bucket"), "node")
    merged = tables.put(merged)
    blocks = merged.groupBy("bucket").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = merged.join(blocks, "bucket").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    places = tables.put(
        small.select("bucket", "node", F.lit(0).alias("block"), F.lit(1).alias("blocks")).unionAll(
            placed.select("bucket", "node", "block", "blocks")
        )
    )
    held = places.groupBy("node").agg(F.collect_list(F.struct("bucket", "block", "blocks")).alias("places"))
    wanted = held.join(nodes.select("node", "id", "copies"), "node")
    found = plain.join(wanted, "id")
    kept = [c for c in found.columns if c != "text"]

    def sets(texts: list[str]) -> list[pa.Array]:
        own = shingle_sets(texts)
        lists = pa.array([s.view(np.int64) for s in own], pa.list_(pa.int64()))
        return [pa.array([digest(s) for s in own], pa.int64()), lists]

    added = [T.StructField("own", T.LongType()), T.StructField("tokens", T.ArrayType(T.LongType()))]
    found = map_texts(found, kept, "text", sets, added).where("own = node")
    spread = found.select(
        "node",
        "copies",
        F.size("tokens").alias("size"),
        "tokens",
        F.transform("places", lambda p: p["bucket"]).alias("buckets"),
        F.inline("places"),
    )
    paired = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    grouped = paired.select(
        "bucket",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        "block",
        "node",
        "copies",
        "size",
        "tokens",
        "buckets",
    ).groupBy("bucket", "first", "second")
    links = tables.put(grouped.applyInArrow(compare, "node long, links long, root long"))
    own = sketches.select(F.col("id"), F.when(F.col("size") > 0, F.col("node")).alias("node"))
    return class_rows(own, nodes, links, tables).withColumnRenamed("id", "doc_id")


def class_rows(rows: DataFrame, nodes: DataFrame, links: DataFrame, tables: Tables) -> DataFrame:
    """(id, class_id, n_links) of every row (id, node) from the links found between nodes.

    ``nodes`` (node, copies, first_id) are groups of equal rows, ``links`` (node, links, root) counted partners
    and connections. Rows whose node is NULL link with nothing; NO_ID turns into NULL.
    """
    sums = links.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")), tables)
    named = nodes.select("node", "copies", "first_id").join(sums, "node", "left").join(roots, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("first_id").alias("class_id"))
    result = named.join(least, "component").select(
        "node", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
    )
    out = rows.join(result, "node", "left")
    own = F.when(F.col("id") != NO_ID, F.col("id"))
    return out.select(
        own.alias("id"),
        F.coalesce("class_id", own).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )

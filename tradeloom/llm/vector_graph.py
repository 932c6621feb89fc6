"""Operator 6: near-duplicate embeddings by a robust-pruned flat graph over overlapping shards."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.jaccard_join import NO_ID, class_rows
from tradeloom.llm.store import Tables

SAMPLE = 20_000  # vectors the shard centres are fitted on, in order of a hash
SHARD = 1_000  # vectors a shard is meant to hold
CENTRES = 2_048
OVERLAP = 4  # shards of each vector
BLOCK = 1_000  # vectors of one block of a shard that holds more; blocks are searched in pairs
POOL = 48  # nearest vectors that pruning chooses from
DEGREE = 16
ALPHA = 1.2
SLACK = 0.05  # vectors this much below the threshold are still walked through


def usable(embedding):
    """Whether a vector can be compared: no NULL, no missing or non-finite component, not all zero."""
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return embedding.isNotNull() & F.coalesce(fine, F.lit(False)) & F.exists(embedding, lambda x: x != 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    scale = np.abs(vectors).max(axis=1, keepdims=True)  # keeps squares of tiny and huge numbers in range
    vectors = vectors / scale
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def centres_of(vectors: np.ndarray, count: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from the first vectors."""
    count = min(count, len(vectors))
    centres = vectors[:count].copy()
    for _ in range(rounds):
        own = np.argmax(vectors @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, vectors)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-300), centres)
    return centres


def matrix(column) -> np.ndarray:
    chunk = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    return chunk.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(chunk), -1)


def pruned_graph(x: np.ndarray) -> np.ndarray:
    """Out-neighbours of each vector (its own number pads): the nearest first, others only where no kept
    neighbour is clearly nearer to them than the vector itself is."""
    n = len(x)
    pool = min(POOL, n - 1)
    if pool < 1:
        return np.zeros((n, 1), dtype=np.int64)
    alike = x @ x.T
    np.fill_diagonal(alike, -np.inf)
    near = np.argpartition(-alike, pool - 1, axis=1)[:, :pool]
    own = np.take_along_axis(alike, near, axis=1)
    order = np.argsort(-own, axis=1, kind="stable")
    near, own = np.take_along_axis(near, order, 1), np.take_along_axis(own, order, 1)
    far = np.sqrt(np.maximum(0, 2 - 2 * own))
    open_ = np.ones_like(near, dtype=bool)
    rows = np.arange(n)
    out = np.repeat(rows[:, None], DEGREE, axis=1)
    for k in range(min(DEGREE, pool)):
        at = np.argmax(open_, axis=1)
        live = open_[rows, at]
        if not live.any():
            break
        kept = near[rows, at]
        out[live, k] = kept[live]
        between = np.empty_like(far)
        for i in range(0, n, 256):  # few rows at once: their pools' vectors are copied
            part = slice(i, i + 256)
            between[part] = 2 - 2 * np.einsum("nd,npd->np", x[kept[part]], x[near[part]])
        between = np.sqrt(np.maximum(0, between))
        open_ &= ~((ALPHA * between <= far) & live[:, None])
        open_[rows, at] = False
    return out


def search(x: np.ndarray, edges: list[np.ndarray], threshold: float) -> list[np.ndarray]:
    """In-range vectors of each vector: a greedy walk from the medoid and its own place, then range expansion."""
    n = len(x)
    medoid = int(np.argmax(x @ x.mean(axis=0)))
    wide = max(len(e) for e in edges)
    padded = np.repeat(np.arange(n)[:, None], wide, axis=1)
    for i, own in enumerate(edges):
        padded[i, : len(own)] = own
    now, best = np.full(n, medoid), x @ x[medoid]
    for _ in range(n):
        step = padded[now]
        alike = np.concatenate(
            [np.einsum("nd,nwd->nw", x[i : i + 256], x[step[i : i + 256]]) for i in range(0, n, 256)]
        )
        at = np.argmax(alike, axis=1)
        better = alike[np.arange(n), at] > best
        if not better.any():
            break
        now = np.where(better, step[np.arange(n), at], now)
        best = np.where(better, alike[np.arange(n), at], best)
    found = []
    seen = np.zeros(n, dtype=bool)
    for q in range(n):
        frontier = np.array([q, now[q]])
        touched = [np.array([q])]
        seen[q] = True
        inside = []
        while len(frontier):
            fresh = np.unique(np.concatenate([padded[frontier].ravel(), frontier]))
            fresh = fresh[~seen[fresh]]
            seen[fresh] = True
            touched.append(fresh)
            alike = x[fresh] @ x[q]
            inside.append(fresh[alike >= threshold])
            frontier = fresh[alike >= threshold - SLACK]
        seen[np.concatenate(touched)] = False
        found.append(np.concatenate(inside))
    return found


def _build(group: pa.Table) -> pa.Table:
    names = group.column("node").to_numpy()
    edges = pruned_graph(unit(matrix(group.column("embedding"))))
    lists = [names[e[e != i]].tolist() for i, e in enumerate(edges)]
    return pa.Table.from_arrays([pa.array(names), pa.array(lists, pa.list_(pa.int64()))], ["node", "near"])


def _walk(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        shard, first, second = (group.column(c)[0].as_py() for c in ("shard", "first", "second"))
        names, block = group.column("node").to_numpy(), group.column("block").to_numpy()
        copies = group.column("copies").to_numpy()
        x = unit(matrix(group.column("embedding")))
        place = {name: i for i, name in enumerate(names.tolist())}
        edges: list[set[int]] = [set() for _ in names]
        for i, near in enumerate(group.column("near").to_pylist()):
            for other in near:
                j = place.get(other)
                if j is not None:
                    edges[i].add(j)
                    edges[j].add(i)  # links hold both ways
        found = search(x, [np.array(sorted(e) or [i]) for i, e in enumerate(edges)], threshold)
        linked = np.zeros((len(names), len(names)), dtype=bool)
        for i, own in enumerate(found):
            linked[i, own] = True
        del found
        linked |= linked.T
        counted = linked if first == second else linked & (block[:, None] != block[None, :])
        lists = group.column("shards").to_pylist()
        earlier = sorted({s for own in lists for s in own if s < shard})  # a pair counts in its first common shard
        held = np.zeros((len(names), max(1, len(earlier))), dtype=np.float32)
        for i, own in enumerate(lists):
            held[i, [k for k, s in enumerate(earlier) if s in own]] = 1
        links = (counted & (held @ held.T == 0)) @ copies.astype(float)
        order = np.argsort(names)
        linked = linked[np.ix_(order, order)]
        root = np.arange(len(names))
        while True:
            after = np.array([root[own].min(initial=root[i]) for i, own in enumerate(linked)])
            after = after[after]
            if (after == root).all():
                break
            root = after
        names, links = names[order], links[order].astype(np.int64)
        arrays = [pa.array(names), pa.array(links), pa.array(names[root])]
        return pa.Table.from_arrays(arrays, ["node", "links", "root"])

    return run


def near_classes(vectors: DataFrame, tables: Tables, threshold: float = 0.9, key: str = "vec_id") -> DataFrame:
    """id, class_id (smallest id reachable over links) and n_links of every vector, by cosine >= threshold.

    Equal vectors are one node. Shard centres come from at most SAMPLE vectors; every vector is indexed, in
    the OVERLAP nearest shards. Each shard (each pair of blocks of a large one) builds a pruned graph; the
    lists of a vector are united; searches run on the united lists. Cosines are verified in double precision,
    so no link below the threshold is returned; a pair counts in its first common shard. Vectors that cannot
    be compared link with nothing, vectors of different length neither; repeated rows are copies.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.coalesce(key, F.lit(NO_ID)).alias("id"), "embedding")
    rows = rows.withColumn("node", F.when(usable(F.col("embedding")), F.xxhash64("embedding")))
    known = F.min(F.when(F.col("id") != NO_ID, F.col("id"))).alias("first_id")
    nodes = rows.where("node IS NOT NULL").groupBy("node", "embedding").agg(F.count("*").alias("copies"), known)
    nodes = tables.put(nodes)
    total = nodes.count()
    picked = nodes.orderBy("node").limit(SAMPLE).select("embedding").collect()
    by_size: dict[int, list] = {}
    for r in picked:
        by_size.setdefault(len(r[0]), []).append(r[0])
    count = max(1, min(CENTRES, math.ceil(total * OVERLAP / SHARD / 2)))
    centres = {
        size: centres_of(unit(np.array(own, dtype=np.float64)), math.ceil(count * len(own) / len(picked)))
        for size, own in by_size.items()
    }

    def deal(batches):
        for batch in batches:
            lists = []
            for own in batch.column(0).to_pylist():
                base = len(own) * 10_000
                if len(own) not in centres:
                    lists.append([base])
                    continue
                alike = centres[len(own)] @ unit(np.array([own], dtype=np.float64))[0]
                kept = np.argsort(-alike, kind="stable")[:OVERLAP]
                lists.append((base + kept).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int64()))], names)

    names = ["embedding", "node", "copies", "shards"]
    kind = nodes.schema["embedding"].dataType.simpleString()  # of floats or of doubles
    dealt = nodes.select(*names[:3]).mapInArrow(deal, f"embedding {kind}, node long, copies long, shards array<long>")
    placed = dealt.withColumn("shard", F.explode("shards"))
    sizes = placed.groupBy("shard").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    placed = placed.join(sizes, "shard").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    spread = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = tables.put(
        spread.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")).drop("other")
    )
    keys = ["shard", "first", "second"]
    graph = spread.groupBy(*keys).applyInArrow(_build, "node long, near array<long>")
    united = graph.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"))
    ready = spread.join(united, "node")
    links = tables.put(ready.groupBy(*keys).applyInArrow(_walk(threshold), "node long, links long, root long"))
    return class_rows(rows.select("id", "node"), nodes, links, tables)


def audit_recall(vectors: DataFrame, found: DataFrame, queries: int = 200, threshold: float = 0.9, key: str = "vec_id") -> float:
    """Share of the true links of ``queries`` vectors (in order of a hash) that ``found`` (id, n_links) counts.

    The queries go to all tasks and are compared with every vector; fails where more links are counted than exist.
    """
    own = vectors.where(usable(F.col("embedding"))).select(F.col(key).alias("id"), "embedding")
    picked = own.orderBy(F.xxhash64("id"), "id").limit(queries).collect()
    by_size: dict[int, list] = {}
    for r in picked:
        by_size.setdefault(len(r["embedding"]), []).append(r)

    def compare(batches):
        for batch in batches:
            totals: dict[int, int] = {}
            for size, asked in by_size.items():
                same = [v for v in batch.column(1).to_pylist() if len(v) == size]
                if same:
                    x = unit(np.array(same, dtype=np.float64))
                    q = unit(np.array([r["embedding"] for r in asked], dtype=np.float64))
                    for r, n in zip(asked, ((x @ q.T) >= threshold).sum(axis=0)):
                        totals[r["id"]] = int(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.int64()), pa.array(list(totals.values()), pa.int64())], ["id", "n"]
            )

    exact = own.mapInArrow(compare, "id long, n long").groupBy("id").agg((F.sum("n") - 1).alias("n"))
    both = exact.join(found, "id").agg(F.sum("n").alias("n"), F.sum("n_links").alias("found"), F.count_if(F.col("n_links") > F.col("n")).alias("more")).first()
    if both["more"]:
        raise AssertionError(f"{both['more']} vectors count links that do not exist")
    return 1.0 if not both["n"] else both["found"] / both["n"]

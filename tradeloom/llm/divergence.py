"""How far sources of a language differ in their words: exact sums of differences of smoothed shares.

Terms get numbers, groups get arrays of (number, share) sorted by number and cut into blocks of numbers. For every
unordered pair of a language's groups, the arrays of one block are merged: the shorter is looked up in the longer by
galloping search, and terms that both, one or neither of the groups hold are priced apart, so no array has a place for
a term that its group lacks. Blocks bound what a task holds; groups are dealt to tasks in packets, so that an array is
sent once for each packet it meets, not once for each pair.

Defined results: NULL text, lang or source is an empty string. Repeated rows and repeated ids count as rows. A group
without terms has the share of zero counts; a language without kept terms has pairs of value 0 and no terms.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.blocks import slices
from tradeloom.llm.store import Tables
from tradeloom.operators.surrogate import with_surrogate

SCALE = 1_000_000_000
PRIOR = 5
LEAST_DOCS = 30
TOP = 50
BLOCK_BITS = 16  # an array covers 2 ** 16 term numbers
PACKET = 16  # groups of one side of a task
HELD = 400_000  # distinct (group, term) counts that a task holds before it hands them on

# Bytes that are no part of a term become spaces, A-Z become lower case.
TERM_BYTES = bytes(32 if c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if c <= 0x5A else c for c in range(128))
TERM_BYTES += bytes(range(128, 256))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) of every group, summed over all rows of ``docs`` (lang, source, text)."""

    def run(batches):
        held: dict[tuple[str, str], tuple[Counter, Counter]] = defaultdict(lambda: (Counter(), Counter()))
        size = 0

        def flush():
            for (lang, source), (n, seen) in held.items():
                columns = [
                    pa.array([lang] * len(n), pa.string()),
                    pa.array([source] * len(n), pa.string()),
                    pa.array([t.decode() for t in n], pa.string()),
                    pa.array(list(n.values()), pa.int64()),
                    pa.array([seen[t] for t in n], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])
            held.clear()

        for batch in batches:
            for part in slices(batch, 2):
                for lang, source, text in zip(*(part.column(i).to_pylist() for i in range(3))):
                    n, seen = held[lang, source]
                    found = Counter(text.encode().translate(TERM_BYTES).split())
                    before = len(n)
                    n.update(found)
                    seen.update(found.keys())
                    size += len(n) - before
                    if size > HELD:
                        yield from flush()
                        size = 0
        yield from flush()

    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    parts = given.mapInArrow(run, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), exact for counts of up to 18 digits."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(19,0)")
    return F.lit(1) + F.call_function("div", top, (total + PRIOR * terms).cast("decimal(19,0)"))


def numbered_terms(counts: DataFrame, tables: Tables, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Stored (lang, term, number, n): the kept terms of every language, numbered from 1 in the order of both."""
    summed = counts.groupBy("lang", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    kept = tables.put(summed.where(F.col("docs") >= least_docs).select("lang", "term", "n"))
    return tables.put(with_surrogate(kept, [F.col("lang"), F.col("term")], "number"))


def group_shares(counts: DataFrame, groups: DataFrame, terms: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Stored (lang, source, terms, total, none) of every group and (lang, source, term, number, p, q) of what it holds.

    ``none`` is the share of a term that the group lacks, p the group's share and q the language's.
    """
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("n").alias("lang_total"))
    held = tables.put(counts.join(terms.select("lang", "term", "number", F.col("n").alias("lang_n")), ["lang", "term"]))
    totals = held.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sized = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    sized = sized.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("terms", "total", "lang_total")])
    none = F.when(F.col("terms") > 0, _share(F.lit(0), F.col("total"), F.col("terms")))
    sized = tables.put(sized.withColumn("none", none))
    of = held.join(sized.select("lang", "source", "terms", "total", "lang_total"), ["lang", "source"])
    p, q = _share(F.col("n"), F.col("total"), F.col("terms")), _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))
    return sized, tables.put(of.select("lang", "source", "term", "number", p.alias("p"), q.alias("q")))


def gallop(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``keys`` would stand in sorted ``among``: steps double from the place of the key before
    until they pass it, then halve; all keys of a slice do so at once."""
    if len(among) < 4 * len(keys):  # arrays of like size: the steps would be of one or two places
        return np.searchsorted(among, keys)
    low = np.zeros(len(keys), dtype=np.int64)
    start = 0
    for a in range(0, len(keys), 64):
        part = keys[a : a + 64]
        step = 64
        while start + step < len(among) and among[start + step] < part[-1]:
            step *= 2
        low[a : a + 64] = start + np.searchsorted(among[start : start + step + 1], part)
        start = int(low[min(a + 63, len(keys) - 1)])
    return low


def pair_value(a: np.ndarray, p: np.ndarray, none_a: int, b: np.ndarray, q: np.ndarray, none_b: int) -> tuple[int, int]:
    """(sum of |p - q| over terms that either holds, their number); ``a`` and ``b`` are sorted term numbers."""
    if len(a) > len(b):
        a, p, none_a, b, q, none_b = b, q, none_b, a, p, none_a
    at = gallop(a, b)
    both = at < len(b)
    both[both] = b[at[both]] == a[both]
    alone = np.ones(len(b), dtype=bool)
    alone[at[both]] = False
    value = int(np.abs(p[both] - q[at[both]]).sum()) + int(np.abs(p[~both] - none_b).sum())
    return value + int(np.abs(q[alone] - none_a).sum()), len(a) + len(b) - int(both.sum())


def pair_divergence(groups: DataFrame, shares: DataFrame, tables: Tables) -> DataFrame:
    """(lang, source, item, value) for every ordered pair of a language's groups."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    named = tables.put(groups.select("lang", "source", "terms", "none", place.alias("place")))
    packets = named.groupBy("lang").agg(F.floor(F.max("place") / PACKET).cast("int").alias("last"))
    blocked = shares.withColumn("block", F.shiftright("number", BLOCK_BITS))
    arrays = blocked.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("number", "p"))).alias("held"))
    # Every group has a place in every block, with an empty array where it holds none of the block's terms.
    blocks = packets.join(blocked.select("lang", "block").distinct(), "lang", "left")
    frame = named.join(blocks.withColumn("block", F.coalesce("block", F.lit(-1).cast("long"))), "lang")
    own = F.floor(F.col("place") / PACKET).cast("int").alias("own")
    other = F.explode(F.sequence(F.lit(0), F.col("last"))).alias("other")
    sent = frame.join(arrays, ["lang", "source", "block"], "left").select("*", own, other)
    cells = tables.put(sent.select(
        "lang",
        "block",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "place",
        F.coalesce("none", F.lit(0)).cast("long").alias("none"),
        F.coalesce(F.col("held.number"), F.array().cast("array<long>")).alias("numbers"),
        F.coalesce(F.col("held.p"), F.array().cast("array<long>")).alias("shares"),
    ))
    key = ["lang", "block", "low", "high"]

    def merge(key, first: pa.Table, second: pa.Table) -> pa.Table:
        def groups_of(table):
            lists = [table.column(c).combine_chunks() for c in ("numbers", "shares")]
            for k, (i, none) in enumerate(zip(table.column("place").to_pylist(), table.column("none").to_pylist())):
                yield i, none, *(c[k].values.to_numpy(zero_copy_only=False) for c in lists)

        found = []
        right = list(groups_of(second))
        for i, none_a, a, p in groups_of(first):
            for j, none_b, b, q in right:
                if i < j:  # one packet against itself has every pair twice
                    found.append((i, j, *pair_value(a, p, none_a, b, q, none_b), abs(none_a - none_b)))
        columns = zip(*found) if found else [()] * 5
        lang = pa.array([key[0].as_py()] * len(found), pa.string())
        names = ["lang", "i", "j", "value", "seen", "gap"]
        return pa.table([lang, *(pa.array(list(c), pa.int64()) for c in columns)], names)

    left = cells.where("own = low").groupBy(*key)
    right = cells.where("own = high").toDF(*cells.columns).groupBy(*key)
    priced = left.cogroup(right).applyInArrow(merge, "lang string, i long, j long, value long, seen long, gap long")
    summed = priced.groupBy("lang", "i", "j").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"), F.max("gap").alias("gap"))
    a = named.select("lang", F.col("place").alias("i"), F.col("source").alias("a"), "terms")
    b = named.select("lang", F.col("place").alias("j"), F.col("source").alias("b"))
    whole = F.col("value") + (F.col("terms") - F.col("seen")) * F.col("gap")
    pairs = tables.put(summed.join(a, ["lang", "i"]).join(b, ["lang", "j"]).select("lang", "a", "b", whole.alias("value")))
    both = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value")
    return both.unionByName(pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value"))


def audit(docs: DataFrame, tables: Tables, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): a group's distance from every other of its language (part ``pair``),
    and the ``top`` terms in which it exceeds its language most (part ``term``)."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    counts = tables.put(term_counts(docs))
    terms = numbered_terms(counts, tables, least_docs)
    sized, shares = group_shares(counts, groups, terms, tables)
    pairs = pair_divergence(sized, shares, tables)
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair"))
    over = shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    first = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).withColumn("part", F.lit("term"))
    found = tables.put(ranked.unionByName(first).select("lang", "source", "part", "item", "value", "rank"))
    tables.keep_only(found)
    return found

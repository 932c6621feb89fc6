"""Operator 3: best-fit packing of token pieces with large-item matching."""

from __future__ import annotations

import base64
import math
import re
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.blocks import map_texts, worker_store
from tradeloom.llm.store import Tables

# A space between two characters that are no white space; Python's white space includes all of the pattern's.
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
UNIT_LIMIT = 400_000  # units a worker remembers; only memory depends on it, not the ids


class UnitTable:
    """Token ids (as int32 bytes) of each distinct unit of text between lone spaces.

    The pattern of this vocabulary starts a new chunk at a space between two characters that are no white space, so
    units can be encoded apart there; a longer run of white space of any kind stays within its unit.
    Units in common Latin characters go through the faster library with the same vocabulary, if its file is
    there; all others through ``tokenizers``.
    """

    def __init__(self, vocabulary: str, ranks: str | None, pattern: str | None):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(vocabulary)
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.plain = re.compile("[\\t\\n\\r -~¡-ɏ]*")
        self.fast = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("same", pat_str=pattern, mergeable_ranks=table, special_tokens={})
        self.known: dict[str, bytes] = {}

    def _encode(self, text: str) -> bytes:
        if self.fast and self.plain.fullmatch(text):
            ids = self.fast.encode_ordinary(text)
        else:
            ids = self.lib.encode(text, add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.specials):
            return np.array(self.lib.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
        if not text:
            return b""
        found = self._joined(text.split(" "))
        return self._joined(LONE_SPACE.split(text), sure=True) if found is None else found

    def _joined(self, units: list[str], sure: bool = False) -> bytes | None:
        """Ids of units between single spaces; None where one begins or ends with white space and so, unless the units
        are ``sure``, may share a run of white space with its neighbour."""
        known = self.known
        if len(known) > UNIT_LIMIT:
            known.clear()
        first, *rest = units
        if not sure and rest and (not first or first[-1].isspace()):
            return None
        out = [self._encode(first)]
        for unit in rest:
            ids = known.get(unit)
            if ids is None:
                if not sure and (not unit or unit[0].isspace() or unit[-1].isspace()):
                    return None
                ids = self._encode(" " + unit)
                if unit and not unit[0].isspace() and not unit[-1].isspace():
                    known[unit] = ids
            out.append(ids)
        return b"".join(out)


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece; only texts over the capacity are cut, the first piece takes the rest."""
    head = tokens % capacity or min(tokens, capacity)
    starts = [0, *range(head, tokens, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], tokens])]


def token_pieces(
    docs: DataFrame,
    vocabulary: str,
    end_id: int,
    capacity: int,
    ranks: str | None = None,
    pattern: str | None = None,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per piece: key, piece, start, length and ``ids`` (packed little-endian unsigned 32-bit integers).

    NULL counts as an empty text, which is the end token alone; repeated rows are documents of their own.
    """

    def make(texts: list[str]) -> list[pa.Array]:
        store = worker_store()
        if ("units", vocabulary) not in store:
            store["units", vocabulary] = UnitTable(vocabulary, ranks, pattern)
        end = np.array([end_id], dtype="<u4").tobytes()
        rows = []
        for body in texts:
            ids = store["units", vocabulary].encode(body) + end
            rows.append(
                [
                    {"piece": i, "start": a, "length": n, "ids": ids[4 * a : 4 * (a + n)]}
                    for i, (a, n) in enumerate(cut(len(ids) // 4, capacity))
                ]
            )
        kind = pa.list_(
            pa.struct([("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        )
        return [pa.array(rows, kind)]

    piece = T.StructType(
        [
            T.StructField("piece", T.IntegerType()),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
        ]
    )
    found = map_texts(docs, [key], text, make, [T.StructField("_pieces", T.ArrayType(piece))])
    return found.select(key, F.inline("_pieces"))


class _Gaps:
    """Runs of equally filled sequences, found by their free space."""

    def __init__(self, capacity: int):
        self.capacity, self.next = capacity, 0
        self.sizes: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, gap: int, first: int, count: int) -> None:
        if gap and count:
            if gap not in self.runs:
                insort(self.sizes, gap)
            self.runs.setdefault(gap, []).append((first, count))

    def take(self, length: int) -> tuple[int, int, int | None]:
        """The run with the smallest gap that holds ``length``: gap, first sequence, count (None: a new one)."""
        at = bisect_left(self.sizes, length)
        if at == len(self.sizes):
            return self.capacity, self.next, None
        gap = self.sizes[at]
        first, count = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap], self.sizes[at]
        return gap, first, count


def plan_packing(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, rank_from, rank_to, sequence_from, offset) that place every item of each length.

    Works on the number of items of each length only, so its size depends on the capacity, not on the rows.
    Items over a third of the capacity are matched greedily, each with the largest that still fits, two to a
    sequence at most; smaller ones, in falling length, go to the smallest gap that holds them.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    gaps = _Gaps(capacity)
    left, ranks = dict(counts), dict.fromkeys(counts, 0)

    def place(length: int, number: int, sequence: int, offset: int) -> None:
        rows.append((length, ranks[length], ranks[length] + number, sequence, offset))
        ranks[length] += number
        left[length] -= number

    large = sorted(n for n in counts if 3 * n > capacity)
    for length in reversed(large):
        while left[length] > 0:
            at = bisect_left(large, min(capacity - length, length) + 1) - 1
            while at >= 0 and left[large[at]] < (2 if large[at] == length else 1):
                at -= 1
            mate = large[at] if at >= 0 else None
            number = left[length]
            if mate is not None:
                number = left[length] // 2 if mate == length else min(number, left[mate])
            place(length, number, gaps.next, 0)
            if mate is not None:
                place(mate, number, gaps.next, length)
            gaps.add(capacity - length - (mate or 0), gaps.next, number)
            gaps.next += number
    for length in sorted((n for n in counts if 3 * n <= capacity), reverse=True):
        while left[length] > 0:
            gap, first, count = gaps.take(length)
            each = gap // length
            whole = left[length] // each
            used = whole if count is None else min(whole, count)
            if used:
                for slot in range(each):
                    place(length, used, first, capacity - gap + slot * length)
                gaps.add(gap - each * length, first, used)
            rest = left[length]
            if used == whole and rest and (count is None or used < count):  # the last, partly filled
                for slot in range(rest):
                    place(length, 1, first + used, capacity - gap + slot * length)
                gaps.add(gap - rest * length, first + used, 1)
                used += 1
            if count is None:
                gaps.next += used
            elif used < count:
                gaps.add(gap, first + used, count - used)
    return rows


def pack(items: DataFrame, capacity: int, tables: Tables, order: list[str]) -> DataFrame:
    """Add sequence_id and offset (longs) to items with a ``length`` between 1 and the capacity.

    ``order`` names columns that tell items apart. Only the count of each length reaches the driver (one
    number for each length up to the capacity). An item's rank among those of its length comes from parts of
    about the square root of the count, so a length that a third of all rows share is no single task.
    ``items`` should be a stored table: it is read twice.
    """
    spark = items.sparkSession
    counts = {int(r["length"]): int(r["n"]) for r in items.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(n is None or not 1 <= n <= capacity for n in counts):
        raise ValueError(f"Lengths must be between 1 and {capacity}")
    parts = [(n, max(1, math.isqrt(c))) for n, c in counts.items()]
    lengths = spark.createDataFrame(parts, "length long, _parts int")
    kept = items.columns
    dealt = items.join(F.broadcast(lengths), "length")
    dealt = tables.put(dealt.withColumn("_part", F.pmod(F.xxhash64(*order), F.col("_parts")).cast("int")).drop("_parts"))
    sizes = dealt.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)) - 1)
    ranked = ranked.join(sizes, ["length", "_part"]).withColumn("_rank", F.col("_rank") + F.col("_before"))
    places = spark.createDataFrame(
        plan_packing(counts, capacity), "length long, _from long, _to long, _sequence long, offset long"
    )
    placed = ranked.join(
        F.broadcast(places),
        (ranked["length"] == places["length"]) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    )
    return placed.select(
        *[ranked[c] for c in kept],
        (F.col("_sequence") + F.col("_rank") - F.col("_from")).alias("sequence_id"),
        F.col("offset").cast("long").alias("offset"),
    )

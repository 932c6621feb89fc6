"""Texts in Arrow blocks of bounded size, and vectorised word and shingle hashes."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator, Sequence
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BYTES = 2_000_000  # text handled at once by one task; a longer text is a block of its own
SHINGLE_WORDS = 5


def worker_store() -> dict:
    """A dictionary that lives as long as the Python worker, for tokenizers and chunk tables."""
    name = "_tradeloom_worker"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
        sys.modules[name].store = {}
    return sys.modules[name].store


def slices(batch: pa.RecordBatch, column: int, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch where the bytes of its text column pass ``limit``."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    groups = np.cumsum(sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def map_texts(
    df: DataFrame,
    keep: Sequence[str],
    text: str,
    make: Callable[[list[str]], list],
    fields: Sequence[T.StructField],
) -> DataFrame:
    """Add columns computed from ``text`` (NULL counts as empty) block by block; ``keep`` columns pass through."""
    kept = [df.schema[name] for name in keep]
    schema = T.StructType([*kept, *fields])
    width = len(kept)
    at = list(keep).index(text) if text in keep else width

    def run(batches):
        names = [f.name for f in schema]
        for batch in batches:
            for part in slices(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:width], *make(texts)], names)

    picked = [F.col(f"`{name}`").alias(f"_{i}") for i, name in enumerate(keep)]
    if at == width:
        picked.append(F.col(f"`{text}`").alias("_text"))
    return df.select(*picked).mapInArrow(run, schema)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers so that every input bit moves every output bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, count: int) -> np.ndarray:
    steps = np.full(max(count, 1), base, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


WORD_BASE = 0x9E3779B97F4A7C15
SHINGLE_BASE = 0xC2B2AE3D27D4EB4F


class Words:
    """The words of a block of texts: runs of bytes other than ASCII white space, A-Z lower-cased in their hashes.

    ``start`` and ``end`` are byte places in ``data``; ``doc`` is the text's place in the block,
    ``bounds`` the first word of each text (and the number of words at its end).
    """

    def __init__(self, texts: list[str]):
        parts = [t.encode("utf-8", "surrogatepass") for t in texts]
        self.data = b"\n".join(parts)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        self.text_start = np.concatenate([[0], np.cumsum(sizes + 1)])[:-1] if parts else np.zeros(0, np.int64)
        codes = np.frombuffer(self.data, dtype=np.uint8)
        inside = (codes != 32) & ((codes < 9) | (codes > 13))
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0)))
        self.start, self.end = edges[::2], edges[1::2]
        self.doc = np.searchsorted(self.text_start, self.start, "right") - 1
        self.bounds = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        self._codes, self._inside = codes, inside

    @cached_property
    def hash(self) -> np.ndarray:
        codes, inside = self._codes, self._inside
        if not len(self.start):
            return np.zeros(0, np.uint64)
        lower = np.arange(1, 257, dtype=np.uint64)
        lower[65:91] += 32
        lengths = self.end - self.start
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        terms = lower[codes[inside]] * powers(WORD_BASE, int(lengths.max()))[place]
        return mix(np.add.reduceat(terms, first))

    def shingles(self, size: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of ``size`` neighbouring words and the first shingle of each text (then their number).

        A text of fewer words has one shingle of all its words, a text without words none.
        """
        counts = np.diff(self.bounds)
        n = len(self.hash)
        steps = powers(SHINGLE_BASE, size)
        full = self.hash * steps[0]
        for k in range(1, min(size, n)):
            full[: n - k] += self.hash[k:] * steps[k]
        short = np.flatnonzero((counts > 0) & (counts < size))  # words past the text's end count as nothing
        begin = self.bounds[short]
        full[begin] = self.hash[begin] * steps[0]
        for k in range(1, size - 1):
            ok = counts[short] > k
            full[begin[ok]] += self.hash[begin[ok] + k] * steps[k]
        per_text = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
        bounds = np.concatenate([[0], np.cumsum(per_text)])
        index = np.arange(bounds[-1]) - np.repeat(bounds[:-1], per_text) + np.repeat(self.bounds[:-1], per_text)
        return mix(full[index]), bounds


def int_list(values: np.ndarray, bounds: np.ndarray, kind=pa.int64()) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, kind))

"""Operator 4: document fingerprints by winnowing."""

from __future__ import annotations

import math
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.blocks import BLOCK_BYTES, map_texts, mix, powers

GRAM = 16  # characters of a rolling hash
WINDOW = 16  # neighbouring hashes of which one is kept: a match of GRAM + WINDOW - 1 characters is always seen
GRAM_BASE = 0xA24BAED4963EE407
GRAM_INVERSE = pow(GRAM_BASE, -1, 1 << 64)


def fingerprint(text: str, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Places and 32-bit hashes that winnowing keeps: of each window the smallest hash, the rightmost of equal ones.

    A text shorter than a gram has one hash of all of it at place 0, an empty text none; a text of fewer
    hashes than a window is one window.
    """
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
    gram = min(gram, n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((codes + np.uint64(1)) * powers(GRAM_BASE, n))])
    rolled = (sums[gram:] - sums[:-gram]) * powers(GRAM_INVERSE, n - gram + 1)
    hashes = mix(rolled) >> np.uint64(32)
    count = len(hashes)
    # Later places make a smaller key, so the minimum is the rightmost of equal hashes.
    least = (hashes << np.uint64(32)) | (np.uint64(0xFFFFFFFF) - np.arange(count, dtype=np.uint64))
    width, window = 1, min(window, count)
    while width < window:
        step = min(width, window - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    kept = least[np.concatenate([[True], least[1:] != least[:-1]])]
    return (np.uint64(0xFFFFFFFF) - (kept & np.uint64(0xFFFFFFFF))).astype(np.uint32), (kept >> np.uint64(32)).astype(
        np.uint32
    )


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of hashes; two empty sets are alike."""
    a, b = np.unique(a), np.unique(b)
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``places``, ``hashes`` (array<long>) of every whole text; NULL counts as empty."""

    def make(texts: list[str]) -> list[pa.Array]:
        found = [fingerprint(t) for t in texts]
        bounds = pa.array(np.concatenate([[0], np.cumsum([len(p) for p, _ in found])]), pa.int32())
        return [
            pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(column).astype(np.int64)))
            for column in zip(*found)
        ]

    kind = T.ArrayType(T.LongType())
    return map_texts(docs, keep, text, make, [T.StructField("places", kind), T.StructField("hashes", kind)])


def packed(places: np.ndarray, hashes: np.ndarray) -> str:
    """Places and hashes as one string: 8 hexadecimal digits of each in turn (little-endian bytes)."""
    return np.column_stack([places, hashes]).astype("<u4").tobytes().hex()


# Ranges of keys for the successor pass. More ranges only mean more tasks; rows inside one are streamed.
RANGE_LIMIT = 4096
RANGE_CHARS = 4_000_000

RESULT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
)


def edited(text: str, following: str) -> str:
    """The text with its last third replaced by as many of the first characters of the following text."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def with_following(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and the next document in falling doc_id (after the last: the first).

    Texts are shuffled once, into ranges of ids that are sorted and streamed; the first document of a range is
    also sent to the range before it. Range bounds are at most RANGE_LIMIT ids of the table. NULL texts are
    empty, NULL ids come last, rows with one id are ordered by text. A single document follows itself.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id"), F.lit(-(2**63))).alias("id"),
        F.col("doc_id").isNull().alias("unknown"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    size = rows.agg(F.sum(F.length("text")), F.count("*")).first()
    if not size[1]:
        return docs.sparkSession.createDataFrame([], RESULT)
    wanted = max(1, min(RANGE_LIMIT, math.ceil((size[0] or 0) / RANGE_CHARS), size[1]))
    shares = [i / wanted for i in range(1, wanted)] + [1.0]
    found = rows.agg(F.percentile_approx("id", F.array(*map(F.lit, shares)), 100 * RANGE_LIMIT), F.max("id")).first()
    heads = np.array(sorted({*found[0], found[1]}, reverse=True), dtype=np.int64)  # the first id of each range
    count = len(heads)

    def deal(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy()
            part = count - 1 - np.searchsorted(heads[::-1], ids, "left")  # the last range whose head is >= the id
            first = np.flatnonzero(heads[part] == ids)  # these also end the range before
            rows = np.concatenate([np.arange(len(ids)), first])
            parts = np.concatenate([part, (part[first] - 1) % count])
            extra = np.arange(len(rows)) >= len(ids)
            sent = batch.take(pa.array(rows))
            names = ["part", "extra", "id", "unknown", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(parts.astype(np.int32)), pa.array(extra), *sent.columns], names)

    def walk(batches):
        """Rows of a range in order, its own ones first; each is finished when the next one is seen."""
        before, over = None, True
        for batch in batches:
            out, weight = [], 0
            for part, extra, number, unknown, text in zip(*[c.to_pylist() for c in batch.columns]):
                now = (part, None if unknown else number, text, fingerprint(text))
                if before is not None and before[0] == part and not over:
                    out.append(finish(before, now))
                    weight += len(text)
                if extra:
                    over = True  # only the first of several rows with the head's id follows
                else:
                    before, over = now, False
                if weight > BLOCK_BYTES:
                    yield pa.RecordBatch.from_pylist(out, kind)
                    out, weight = [], 0
            if out:
                yield pa.RecordBatch.from_pylist(out, kind)

    def finish(own, following) -> dict:
        _, doc_id, text, (places, hashes) = own
        changed = edited(text, following[2])
        new_places, new_hashes = fingerprint(changed)
        return {
            "doc_id": doc_id,
            "n_chars": len(text),
            "edited_sha256": sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": packed(places, hashes),
            "edited_fingerprint": packed(new_places, new_hashes),
            "near_edited": likeness(hashes, new_hashes),
            "near_next": likeness(hashes, following[3][1]),
        }

    arrow = {T.LongType(): pa.int64(), T.DoubleType(): pa.float64(), T.StringType(): pa.string()}
    kind = pa.schema([(f.name, arrow[f.dataType]) for f in RESULT])
    dealt = rows.mapInArrow(deal, "part int, extra boolean, id long, unknown boolean, text string")
    sorted_rows = dealt.repartition("part").sortWithinPartitions("part", "extra", F.desc("id"), "unknown", "text")
    return sorted_rows.mapInArrow(walk, RESULT)


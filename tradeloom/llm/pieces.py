"""Operator 8: SentencePiece encoding and decoding by a distinct-chunk table."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tradeloom.llm.blocks import map_texts, worker_store

MARK = "▁"
TABLE_LIMIT = 400_000  # chunks a worker remembers; only memory depends on it, not the ids


def split_marked(text: str) -> list[str]:
    """The chunks of a text: a run of white-space marks with what follows, the dummy prefix mark left off.

    Joined with one mark in front of each they give the whole marked text again.
    """
    marked = text.replace(MARK, " ")
    if "  " not in marked and marked[:1] != " ":
        return marked.split(" ")
    return [chunk[1:] for chunk in re.findall(r" +[^ ]*|^[^ ]+", " " + marked)]


class ChunkTable:
    """Ids (as int32 bytes) and decoded text of each distinct marked chunk, segmented once."""

    def __init__(self, model: str):
        import sentencepiece

        self.lib = sentencepiece.SentencePieceProcessor(model_file=model)
        pieces = [self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size())]
        probe = "a  b \tc　ﬁ"  # white space and compatibility forms that a normaliser would change
        as_is = self.lib.decode(self.lib.encode(probe)) == probe and len(self.lib.encode("  ")) > 0
        self.splits = as_is and not any(MARK in p.lstrip(MARK) for p in pieces)
        self.known: dict[str, tuple[bytes, str]] = {}

    def learn(self, chunks: set[str]) -> None:
        if len(self.known) + len(chunks) > TABLE_LIMIT:
            self.known.clear()
        new = [c for c in chunks if c not in self.known]
        ids = self.lib.encode(new, num_threads=1)
        mark = self.lib.piece_to_id(MARK)
        ids = [i if c else [mark] for c, i in zip(new, ids)]
        for chunk, own, back in zip(new, ids, self.lib.decode(ids, num_threads=1) if new else []):
            self.known[chunk] = (np.array(own, dtype=np.int32).tobytes(), back)

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        if not self.splits:  # pieces cross marks, or the model rewrites texts: encode whole texts
            ids = self.lib.encode(texts, num_threads=1)
            return [np.array(i, dtype=np.int32).tobytes() for i in ids], self.lib.decode(ids, num_threads=1)
        split = [split_marked(t) if t else [] for t in texts]
        self.learn(set().union(*split) if split else set())
        found = [[self.known[c] for c in chunks] for chunks in split]
        ids = [b"".join([row[0] for row in rows]) for rows in found]
        return ids, [" ".join([row[1] for row in rows]) for rows in found]


def encode_decode(docs: DataFrame, model: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``ids`` array<int> and ``decoded`` string of every text, exactly as the library gives them.

    NULL and empty texts have no ids and decode to an empty text. One narrow pass without a shuffle: each
    worker segments a distinct marked chunk once and joins ids back by position. If the model has pieces that
    cross a mark, or normalises texts, whole texts are encoded. Rows, repeated ones too, map one to one.
    """

    def make(texts: list[str]) -> list[pa.Array]:
        store = worker_store()
        if ("pieces", model) not in store:
            store["pieces", model] = ChunkTable(model)
        ids, decoded = store["pieces", model].encode(texts)
        bounds = np.concatenate([[0], np.cumsum([len(i) // 4 for i in ids])])
        values = np.frombuffer(b"".join(ids), dtype=np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
        return [lists, pa.array(decoded, pa.string())]

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return map_texts(docs, keep, text, make, fields)

"""Operator 7: language-model scores from a lattice of subword pieces."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.blocks import slices
from tradeloom.llm.store import Tables

MARK = "▁"
CODE_POINTS = 1_114_112
END = " "  # cannot be a word: words hold no white space
WORDS_AT_ONCE = 50_000
CELLS_AT_ONCE = 200_000  # characters of one block of words
HEAD_WORDS = 50_000  # the most frequent words, whose scores every task gets; all others are joined
COUNTER_LIMIT = 300_000
ROUNDS = 3
GROUPS = 7  # classes with a model of their own


def split_words(text: str) -> list[bytes]:
    """Words of the contract: runs of bytes outside 0x20 and 0x09-0x0D, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split()


@dataclass
class Lattice:
    """Pieces as a trie in arrays; all segmentations of many words of one length are walked together."""

    pieces: list[str]
    log_p: np.ndarray  # (class, piece): natural logs; last but one: unknown character, last: end of a word

    def __post_init__(self):
        children: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for number, piece in enumerate(self.pieces):
            node = 0
            for char in piece:
                node = children.setdefault((node, ord(char)), len(children) + 1)
            ends[node] = number
        keys = np.array([a * CODE_POINTS + c for a, c in children], dtype=np.int64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.child = np.array(list(children.values()), dtype=np.int64)[order]
        self.piece = np.full(len(children) + 1, -1, dtype=np.int64)
        self.piece[list(ends)] = list(ends.values())
        self.unknown = len(self.pieces)

    def arcs(self, codes: np.ndarray):
        """(rows, start, stop, piece numbers) for every arc, by rising start; rows are unique in each group."""
        count, length = codes.shape
        for start in range(length):
            rows, node = np.arange(count), np.zeros(count, dtype=np.int64)
            for stop in range(start + 1, length + 1):
                wanted = node * CODE_POINTS + codes[rows, stop - 1]
                at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
                ok = self.keys[at] == wanted
                if stop == start + 1:  # a character that is no piece of its own
                    single = np.zeros(count, dtype=bool)
                    single[ok] = self.piece[self.child[at[ok]]] >= 0
                    if not single.all():
                        lone = np.flatnonzero(~single)
                        yield lone, start, stop, np.full(len(lone), self.unknown)
                rows, node = rows[ok], self.child[at[ok]]
                if not len(rows):
                    break
                hit = self.piece[node] >= 0
                if hit.any():
                    yield rows[hit], start, stop, self.piece[node[hit]]

    def _blocks(self, words: list[str]):
        lengths = np.array([len(w) + 1 for w in words])
        for length in np.unique(lengths):
            places = np.flatnonzero(lengths == length)
            step = max(1, CELLS_AT_ONCE // int(length))
            for i in range(0, len(places), step):
                part = places[i : i + step]
                joined = "".join([MARK + words[p] for p in part])
                codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                yield part, codes.astype(np.int64).reshape(len(part), length)

    def score(self, words: list[str]) -> np.ndarray:
        """(class, word): log of the sum, over all segmentations of each word, of their probabilities."""
        out = np.zeros((len(self.log_p), len(words)))
        for places, codes in self._blocks(words):
            forward = np.full((codes.shape[1] + 1, len(self.log_p), codes.shape[0]), -np.inf)
            forward[0] = 0
            for rows, start, stop, piece in self.arcs(codes):
                into = forward[stop][:, rows]
                forward[stop][:, rows] = np.logaddexp(into, forward[start][:, rows] + self.log_p[:, piece])
            out[:, places] = forward[-1] + self.log_p[:, -1:]
        return out

    def expected(self, words: list[str], of_class: int) -> np.ndarray:
        """Expected number of uses of each piece in one class, each word once, by forward and backward sums."""
        log_p = self.log_p[of_class]
        total = np.zeros(len(log_p))
        for places, codes in self._blocks(words):
            shape = (codes.shape[1] + 1, codes.shape[0])
            forward, backward = np.full(shape, -np.inf), np.full(shape, -np.inf)
            forward[0], backward[-1] = 0, 0
            arcs = list(self.arcs(codes))
            for rows, start, stop, piece in arcs:
                forward[stop][rows] = np.logaddexp(forward[stop][rows], forward[start][rows] + log_p[piece])
            whole = forward[-1]
            for rows, start, stop, piece in reversed(arcs):
                tail = log_p[piece] + backward[stop][rows]
                backward[start][rows] = np.logaddexp(backward[start][rows], tail)
                used = np.exp(forward[start][rows] + tail - whole[rows])
                total += np.bincount(piece, weights=used, minlength=len(total))
        total[-1] = len(words)
        return total


def normalised(uses: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """Log probabilities from uses: those of pieces that open a word, and those of all that may follow, sum to 1.

    The unknown character shares its part among all code points.
    """
    log_p = np.log(uses)
    for group in (opens, ~opens):
        log_p[:, group] -= np.log(uses[:, group].sum(axis=1, keepdims=True))
    log_p[:, -2] -= np.log(CODE_POINTS)
    return log_p


def pieces_of(model: str) -> list[str]:
    """The pieces of an existing vocabulary that lower-cased marked words can hold."""
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model)
    every = range(lib.get_piece_size())
    named = [lib.id_to_piece(i) for i in every if not (lib.is_control(i) or lib.is_unknown(i) or lib.is_byte(i))]
    fit = [p for p in named if not any("A" <= c <= "Z" or c.isspace() for c in p) and MARK not in p[1:]]
    return sorted(set(fit) | {MARK})


def word_counts(docs: DataFrame, text: str, group: str, groups: int) -> DataFrame:
    """(word, c0, c1, ...): uses of each word of any text in the learning texts of each class; END: their number.

    ``group`` is the class of a learning text and -1 for all others, whose words count 0.
    """

    def count(batches):
        seen: list[Counter] = [Counter() for _ in range(groups)]

        def rows():
            for k, own in enumerate(seen):
                if own:
                    words = pa.array([w.decode("utf-8", "surrogatepass") for w in own])
                    counts = pa.array(list(own.values()), pa.int64())
                    yield pa.RecordBatch.from_arrays([words, pa.array([k] * len(own), pa.int32()), counts], NAMES)
                    own.clear()

        for batch in batches:
            for part in slices(batch, 0):
                for body, k in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = split_words(body or "")
                    if k >= 0:
                        seen[k].update(words)
                        seen[k][b" "] += 1
                    else:
                        for word in words:
                            if word not in seen[0]:
                                seen[0][word] = 0
                if sum(map(len, seen)) > COUNTER_LIMIT:
                    yield from rows()
        yield from rows()

    found = docs.select(text, group).mapInArrow(count, "word string, k int, n long")
    sums = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"c{k}") for k in range(groups)]
    return found.groupBy("word").agg(*sums)


NAMES = ["word", "k", "n"]


def head_bound(scored: DataFrame) -> int:
    """The smallest count (a power of 2 ** (1 / 8), rounded up) that at most HEAD_WORDS words reach."""
    step = F.floor(8 * F.log2(F.greatest(F.col("c"), F.lit(1)))).cast("int")
    sizes = scored.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()  # at most 512 rows
    words, bound = 0, None
    for row in sizes:
        words += row["count"]
        if words > HEAD_WORDS:
            break
        bound = row["step"]
    return (1 << 62) if bound is None else max(1, int(np.ceil(2 ** (bound / 8) - 1e-9)))


def gathered(batches):
    """Batches of about WORDS_AT_ONCE rows, so that words of one length are many."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= WORDS_AT_ONCE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def learn(words: DataFrame, pieces: list[str], groups: int, rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities of each class that fit its distinct words, by expectation maximisation from equal ones.

    Each round is one pass over the distinct words of the corpus; only one sum per piece of the (fixed)
    vocabulary and class comes back. Every piece keeps a small share, so no word is impossible.
    """
    size = len(pieces) + 2
    opens = np.array([p.startswith(MARK) for p in pieces] + [False, False])
    uses = np.ones((groups, size))
    for _ in range(rounds):
        log_p = normalised(uses, opens)

        def expect(batches, log_p=log_p):
            lattice, total = Lattice(pieces, log_p), np.zeros((groups, size))
            for batch in gathered(batches):
                every = np.array(batch.column(0).to_pylist(), dtype=object)
                for k in range(groups):
                    own = every[batch.column(k + 1).to_numpy() > 0].tolist()
                    if own:
                        total[k] += lattice.expected(own, k)
            k, piece = np.nonzero(total)
            out = [pa.array(k, pa.int32()), pa.array(piece, pa.int32()), pa.array(total[k, piece])]
            yield pa.RecordBatch.from_arrays(out, ["k", "piece", "uses"])

        found = words.where(f"word <> '{END}'").mapInArrow(expect, "k int, piece int, uses double")
        uses = np.full((groups, size), 0.01)
        for row in found.groupBy("k", "piece").agg(F.sum("uses").alias("uses")).collect():
            uses[row["k"], row["piece"]] += row["uses"]
    return normalised(uses, opens)


def score_documents(
    docs: DataFrame, model: str, held_out: str, tables: Tables, text: str = "text", group: str = "lang"
) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every whole text.

    ``score`` is the log10 probability of the text, summed over classes (the GROUPS most frequent values of
    ``group`` among learning texts, and all others): of each class, the product over the words and the end of
    the text. A word's probability is the sum over all segmentations of the word into pieces, among which a
    word the class has seen is one arc of its own; arcs are weighed by the share of words seen once. Pieces
    cannot cross the mark before a word, so the forward recursion of a document is that of its words one
    after the other, and each distinct word is walked once. The class of a text is never read for its score.

    Scores of the HEAD_WORDS most frequent words go to every task (a fixed number); all other words are
    joined on the word. NULL counts as an empty text (its end only); repeated rows are documents of their own.
    """
    held = F.col(f"`{held_out}`")
    named = F.coalesce(F.col(f"`{group}`").cast("string"), F.lit(""))
    flagged = docs.select("doc_id", F.col(f"`{text}`").alias("_text"), held.alias("_held"), named.alias("_name"))
    common = flagged.where(~F.col("_held")).groupBy("_name").count().orderBy(F.desc("count"), "_name").limit(GROUPS + 1)
    names = [r["_name"] for r in common.collect()]
    groups = max(1, len(names))  # with more than GROUPS values the last class is that of all others
    names = names[:GROUPS]
    number = F.lit(groups - 1)
    for k, name in enumerate(names):
        number = F.when(F.col("_name") == name, k).otherwise(number)
    flagged = flagged.withColumn("_group", F.when(F.col("_held"), -1).otherwise(number).cast("int"))
    counts = tables.put(word_counts(flagged, "_text", "_group", groups))
    every = [f"c{k}" for k in range(groups)]
    total = sum((F.col(c) for c in every[1:]), F.col(every[0]))
    is_end = F.col("word") == END
    seen = counts.agg(
        F.count_if(total > 0).alias("distinct"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(f"n_{c}") for c in every],
        *[F.count_if((F.col(c) == 1) & ~is_end).alias(f"once_{c}") for c in every],
        *[F.coalesce(F.max(F.when(is_end, F.col(c))), F.lit(0)).alias(f"end_{c}") for c in every],
    ).first()
    size = np.array([float(seen[f"n_{c}"]) for c in every])
    ends = np.array([float(seen[f"end_{c}"]) for c in every])
    tokens, distinct = int(size.sum()), int(seen["distinct"])
    novel = np.clip(np.array([float(seen[f"once_{c}"]) for c in every]) / np.maximum(size, 1), 0.001, 0.5)
    size = np.maximum(size, 1.0)
    share = np.log10((ends + 0.1) / (ends + 0.1).sum())
    pieces = pieces_of(model)
    log_p = learn(counts, pieces, groups)
    base = np.log10(tokens + 0.1 * (distinct + 1))
    end_base = float(np.log10(ends.sum() + 0.1) - base)
    end_score = (share + np.log10((1 - novel) * (ends + 0.1) / size)).tolist()
    own_names = [f"own{k}" for k in range(groups)]

    def score(batches):
        lattice = Lattice(pieces, log_p)
        for batch in gathered(batches):
            count = np.stack([batch.column(k + 1).to_numpy() for k in range(groups)]).astype(float)
            spelled = np.log(novel)[:, None] + lattice.score(batch.column(0).to_pylist())
            with np.errstate(divide="ignore"):
                whole = np.log((1 - novel)[:, None] * count / size[:, None])
            own = np.logaddexp(spelled, whole) / np.log(10)
            every = count.sum(axis=0)
            out = [batch.column(0), pa.array(every.astype(np.int64)), pa.array(np.log10(every + 0.1) - base)]
            yield pa.RecordBatch.from_arrays([*out, *map(pa.array, own)], ["word", "c", "base", *own_names])

    kinds = ", ".join(f"{name} double" for name in own_names)
    scored = counts.where(~is_end).mapInArrow(score, f"word string, c long, base double, {kinds}")
    scored = tables.put(scored)
    top = scored.where(F.col("c") >= head_bound(scored)).collect()
    head = {r["word"].encode("utf-8", "surrogatepass"): (int(r["c"] > 0), *r[2:]) for r in top}

    def walk(batches):
        """One row for a document with the sums of its head words and end, and one for each other distinct word."""
        for batch in batches:
            for part in slices(batch, 3):
                out: dict[str, list] = {name: [] for name in kind.names}
                for row, doc_id, held_out, body in zip(*[c.to_pylist() for c in part.columns]):
                    words = Counter(split_words(body or ""))
                    known, sums, rest = int(ends.sum() > 0), [end_base, *end_score], []
                    for word, n in words.items():
                        if (found := head.get(word)) is None:
                            rest.append((word.decode("utf-8", "surrogatepass"), n))
                        else:
                            known += n * found[0]
                            sums = [a + n * b for a, b in zip(sums, found[1:])]
                    out["row"] += [row] * (len(rest) + 1)
                    out["word"] += [f" {row}", *[w for w, _ in rest]]  # with a space: joins with no word
                    out["n"] += [0, *[n for _, n in rest]]
                    own = [doc_id, held_out, sum(words.values()) + 1, known, *sums]
                    for name, value in zip(kind.names[3:], own):
                        out[name].append(value)
                        out[name] += [None] * len(rest)
                yield pa.RecordBatch.from_pydict(out, kind)

    kind = pa.schema(
        [("row", pa.int64()), ("word", pa.string()), ("n", pa.int32()), ("doc_id", pa.int64()), ("held", pa.bool_())]
        + [("tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64())]
        + [(name, pa.float64()) for name in own_names]
    )
    numbered = flagged.select(F.monotonically_increasing_id().alias("row"), "doc_id", "_held", "_text")
    sent = numbered.mapInArrow(
        walk, f"row long, word string, n int, doc_id long, held boolean, tokens long, known long, base double, {kinds}"
    )
    looked = scored.select("word", *[F.col(c).alias(f"_{c}") for c in ("c", "base", *own_names)])
    joined = sent.join(looked, "word", "left").select(
        "row",
        "doc_id",
        "held",
        "tokens",
        F.coalesce("known", F.when(F.col("_c") > 0, F.col("n")).otherwise(0)).alias("known"),
        *[F.coalesce(c, F.col("n") * F.col(f"_{c}")).alias(c) for c in ("base", *own_names)],
    )
    sums = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"),
        F.max("held").alias("held_out"),
        F.max("tokens").alias("n_tokens"),
        F.sum("known").cast("long").alias("n_known"),
        F.sum("base").alias("base_score"),
        *[F.sum(c).alias(c) for c in own_names],
    )
    best = F.greatest(*own_names) if groups > 1 else F.col(own_names[0])
    parts = sum((F.pow(F.lit(10.0), F.col(c) - F.col("_best")) for c in own_names), F.lit(0.0))
    return sums.withColumn("_best", best).select(
        "doc_id",
        "held_out",
        "n_tokens",
        "n_known",
        F.lit(tokens).cast("long").alias("train_tokens"),
        "base_score",
        (F.col("_best") + F.log10(parts)).alias("score"),
    )

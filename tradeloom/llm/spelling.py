"""Groups of spelling variants: words that differ by one inserted, deleted or replaced letter.

The letters of a word are counted; two words that differ by one edit have counts at a squared distance of 1 (insertion)
or 2 (replacement). All distances of a block of words come from one NumPy product of its letter counts (its Gram
matrix); pairs at most 2 apart, of equal or adjacent length, are kept and their edits verified letter by letter.

Blocks are signatures: letters are dealt to a few classes, and a signature counts the letters of each class. Words
one edit apart share a signature after one letter is taken from the longer, or from each if they are of one length. So
a word goes to its own signature and to those that lack one of its letters (once for each class it uses), and every
near pair meets in exactly one block that counts it. The number of classes follows the number of words, which keeps
blocks small; blocks that still are large are cut into parts that meet in pairs, so a task holds two parts at most.

Defined results: words are runs of letters after A-Z is lower-cased. NULL and empty texts have none; a NULL id counts
as empty text; repeated rows count again. A word near nothing has no form and is its own root. Ties of ``n`` go to
the first word in code-point order.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.blocks import mix, slices
from tradeloom.llm.store import Tables

LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_RATIO = 10  # a form occurs at least this many times as often as its variant
DAMAGE = 31  # one of so many words of a document loses a letter
HELD = 300_000  # distinct words that a task holds before it hands their counts on
PART = 4096  # words of a block that one task compares with as many others
TILE = 512  # words of one side of a Gram matrix
LETTERS = 90  # a-z and the code points 0xC0 to 0xFF
EXACT_LENGTH = 2000  # beyond it products of counts need double precision
PAIR_LETTERS = 4_000_000  # letters compared at once when edits are verified

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
LETTER_OF = np.zeros(256, dtype=np.int64)  # by code point
LETTER_OF[97:123] = np.arange(26)
LETTER_OF[0xC0:] = np.arange(26, 90)


def word_counts(docs: DataFrame, least: int = LEAST_LETTERS, damage: int = DAMAGE) -> DataFrame:
    """(word, n) over all texts of ``docs`` (doc_id, text); a word that its checksum in the document marks loses a letter."""
    run_of_letters = re.compile("[A-Za-zÀ-ÿ]{%d,}" % least)

    def run(batches):
        held: Counter = Counter()

        def flush():
            words, n = list(held), list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

        for batch in batches:
            for part in slices(batch, 1):
                for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    lowered = text.encode().translate(LOWER).decode()
                    for word, n in Counter(run_of_letters.findall(lowered)).items():
                        h = zlib.crc32(f"{name}:{word}".encode())
                        if h % damage == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        held[word] += n
                    if len(held) > HELD:
                        yield flush()
        yield flush()

    given = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("doc_id", "text")])
    return given.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


class Letters:
    """Words of a batch as code points in one array, with their places and letter counts."""

    def __init__(self, words: pa.Array):
        texts = words.to_pylist()
        self.length = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer("".join(texts).encode("latin-1"), dtype=np.uint8)

    def counts(self, classes: np.ndarray, width: int) -> np.ndarray:
        """Letters of each word by class; ``classes`` maps code points to 0 .. width - 1."""
        row = np.repeat(np.arange(len(self.length)), self.length)
        return np.bincount(row * width + classes[self.data], minlength=len(self.length) * width).reshape(-1, width)


def class_count(words: int) -> int:
    """Letter classes for so many words: about half the binary digits of their number."""
    return min(16, max(4, round(np.log2(max(words, 2)) / 2)))


def block_rows(words: DataFrame, classes: int) -> DataFrame:
    """(block, taken, first, word, n): every word in its own signature (taken -1) and without a letter of each class
    that it uses; ``first`` marks the smallest such class, in whose block words of equal signature are compared."""
    weights = mix(np.arange(1, classes + 1)).astype(np.uint64) | np.uint64(1)
    class_of = LETTER_OF % classes

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = Letters(batch.column(0)).counts(class_of, classes)
            own = (counts.astype(np.uint64) * weights).sum(axis=1, dtype=np.uint64)
            row, taken = np.nonzero(counts)
            first = np.concatenate([[True], row[1:] != row[:-1]])
            block = np.concatenate([own, own[row] - weights[taken]]).view(np.int64)
            index = pa.array(np.concatenate([np.arange(len(own)), row]))
            arrays = [
                pa.array(block),
                pa.array(np.concatenate([np.full(len(own), -1), taken]), pa.int32()),
                pa.array(np.concatenate([np.zeros(len(own), bool), first])),
                batch.column(0).take(index),
                batch.column(1).take(index),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["block", "taken", "first", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "block long, taken int, first boolean, word string, n long")


def dealt_rows(rows: DataFrame, tables: Tables, part: int = PART) -> DataFrame:
    """Rows with the pair of parts (low, high) of their block that they meet in and their own part (side).

    Blocks of up to ``part`` rows have one part; a row of a larger block goes to one task for each part of the block.
    """
    large = rows.groupBy("block").agg(F.count("*").alias("size")).where(F.col("size") > part)
    large = tables.put(large.select("block", F.ceil(F.col("size") / part).cast("int").alias("parts")))
    split = rows.join(large, "block", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    side = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("word"), "parts").cast("int")).otherwise(0)
    meets = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    dealt = split.withColumn("side", side).withColumn("other", meets)
    low, high = F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high")
    return dealt.select("block", low, high, "side", "taken", "first", "word", "n")


def _ragged(letters: Letters, words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``data`` of the first ``size`` letters of ``words``, and where each word's places begin."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) - np.repeat(first, size) + np.repeat(letters.start[words], size), first


def one_edit(letters: Letters, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs of different words differ by one replaced letter or, where b is one longer than a, one inserted."""
    found = np.zeros(len(a), dtype=bool)
    total = np.cumsum(letters.length[a]) // PAIR_LETTERS
    for group in range(int(total[-1]) + 1 if len(total) else 0):
        here = np.flatnonzero(total == group)
        if not len(here):
            continue
        x, y = a[here], b[here]
        size = letters.length[x]
        left, first = _ragged(letters, x, size)
        right, _ = _ragged(letters, y, size)
        place = np.arange(len(left)) - np.repeat(first, size)
        differ = letters.data[left] != letters.data[right]
        longer = letters.length[y] > size
        same_length = np.add.reduceat(differ.astype(np.int64), first) == 1
        # Inserted: equal up to some place, and equal from there on to the letters one further.
        after = letters.data[left] != letters.data[np.minimum(right + 1, len(letters.data) - 1)]
        head = np.minimum.reduceat(np.where(differ, place, len(left)), first)
        tail = np.maximum.reduceat(np.where(after, place, -1), first)
        found[here] = np.where(longer, tail < head, same_length)
    return found


def near_pairs(letters: Letters, run: np.ndarray, side: np.ndarray, split: np.ndarray, taken: np.ndarray, first: np.ndarray):
    """Pairs (a, b), b not shorter, that their run (a block's pair of parts) counts; rows are sorted by run."""
    wide = letters.counts(LETTER_OF, LETTERS)
    kind = np.float64 if letters.length.max(initial=0) > EXACT_LENGTH else np.float32
    used = wide[:, wide.any(axis=0)].astype(kind)
    norm = (used * used).sum(axis=1)
    pairs = []
    for a in range(0, len(run), TILE):
        rows = slice(a, min(a + TILE, len(run)))
        for c in range(a, len(run), TILE):
            if run[c] > run[rows.stop - 1]:
                break
            columns = slice(c, min(c + TILE, len(run)))
            distance = norm[rows, None] + norm[None, columns] - 2 * (used[rows] @ used[columns].T)
            i, j = np.divmod(np.flatnonzero(distance <= 2), columns.stop - columns.start)
            i, j = i + a, j + c
            gap = np.abs(letters.length[i] - letters.length[j])
            equal = taken[i] == taken[j]  # of one length; of one signature, or both the block's own
            ok = (i < j) & (run[i] == run[j]) & (gap <= 1)
            ok &= np.where(equal, first[i], (gap == 0) == ((taken[i] >= 0) & (taken[j] >= 0)))
            ok &= ~split[i] | (side[i] != side[j])
            pairs.append((i[ok], j[ok]))
    i = np.concatenate([p[0] for p in pairs])
    j = np.concatenate([p[1] for p in pairs])
    swap = letters.length[i] > letters.length[j]
    i, j = np.where(swap, j, i), np.where(swap, i, j)
    ok = one_edit(letters, i, j)
    return i[ok], j[ok]


def near_words(dealt: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words and the best of them as struct (minus, near), minus being -n."""
    schema = "word string, n_near long, minus long, near string"

    def run(batches):
        left = None

        def judged(table):
            key = [np.asarray(table.column(c).combine_chunks()) for c in ("block", "low", "high")]
            changed = np.concatenate([[False], np.any([k[1:] != k[:-1] for k in key], axis=0)])
            words = table.column("word").combine_chunks()
            side, taken, first = (np.asarray(table.column(c).combine_chunks()) for c in ("side", "taken", "first"))
            a, b = near_pairs(Letters(words), np.cumsum(changed), side, key[1] != key[2], taken, first)
            n = np.asarray(table.column("n").combine_chunks())
            this, that = np.concatenate([a, b]), np.concatenate([b, a])
            rank = np.zeros(len(n), dtype=np.int64)
            some = np.unique(this)
            texts = np.array(words.take(pa.array(some)).to_pylist(), dtype=object)
            rank[some] = np.unique(texts, return_inverse=True)[1] if len(texts) else 0
            order = np.lexsort((rank[that], -n[that], this))
            this, that = this[order], that[order]
            lead = np.flatnonzero(np.diff(this, prepend=-1))
            size = np.diff(np.append(lead, len(this)))
            best = that[lead]
            arrays = [
                words.take(pa.array(this[lead])),
                pa.array(size, pa.int64()),
                pa.array(-n[best], pa.int64()),
                words.take(pa.array(best)),
            ]
            return pa.RecordBatch.from_arrays(arrays, ["word", "n_near", "minus", "near"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([left, table]) if left is not None else table
            if not table.num_rows:
                continue
            last = [table.column(c)[-1] for c in ("block", "low", "high")]
            same = pc.and_(pc.equal(table.column("block"), last[0]), pc.equal(table.column("low"), last[1]))
            begun = pc.sum(pc.and_(same, pc.equal(table.column("high"), last[2]))).as_py()
            whole = table.slice(0, table.num_rows - begun)
            left = table.slice(table.num_rows - begun).combine_chunks()
            if whole.num_rows:
                yield judged(whole)
        if left is not None and left.num_rows:
            yield judged(left)

    key = ["block", "low", "high"]
    found = dealt.repartition(*key).sortWithinPartitions(*key).mapInArrow(run, schema)
    best = F.min(F.struct("minus", "near")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)


def roots(forms: DataFrame, tables: Tables, rounds: int = 40) -> DataFrame:
    """(word, root) of ``forms`` (word, form): forms followed to the last, twice as far in each round.

    Every form is more frequent than its word, so there are no cycles. Fails rather than return a partial result.
    """
    now = tables.put(forms.select("word", F.col("form").alias("root")))
    for _ in range(rounds):
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = tables.put(now.join(onward, "root", "left").select("word", "root", "next"))
        moved = after.where("next is not null").limit(1).count()
        tables.drop(now)
        now = after.select("word", F.coalesce("next", "root").alias("root"))
        now._tradeloom_path = after._tradeloom_path
        if not moved:
            return now
    raise RuntimeError(f"Roots did not settle in {rounds} rounds")


def variant_groups(docs: DataFrame, tables: Tables, least: int = LEAST_COUNT, part: int = PART) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of enough letters and occurrences."""
    words = tables.put(word_counts(docs).where(F.col("n") >= least))
    rows = tables.put(block_rows(words, class_count(words.count())))
    near = tables.put(near_words(dealt_rows(rows, tables, part)))
    tables.drop(rows)
    joined = words.join(near, "word", "left").withColumn("most", -F.col("best.minus"))
    formed = F.col("most") >= FORM_RATIO * F.col("n")
    judged = joined.select(
        "word",
        F.when(formed, F.col("best.near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("most")).alias("form_n"),
    )
    judged = tables.put(judged)
    last = roots(judged.where("form is not null"), tables)
    tables.keep_only(judged, last)
    rooted = judged.join(last, "word", "left")
    return rooted.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

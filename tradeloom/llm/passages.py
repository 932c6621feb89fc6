"""Operator 1: repeated passages by compact windows of min-hashes."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.blocks import SHINGLE_WORDS, Words, int_list, mix, slices
from tradeloom.llm.components import components
from tradeloom.llm.store import Tables

LEAST_WORDS = 50  # a shorter passage is no repeat
LEAST = LEAST_WORDS - SHINGLE_WORDS + 1  # the same in shingles
SIMILARITY = 0.8
SPARE = 1 / SIMILARITY - 1  # unmatched shingles that a passage may hold for each matched one
SHIFT = 16  # words by which insertions may move a match, or SPARE of the span where that is more
LEAST_SHARED = math.ceil(SIMILARITY * LEAST)  # shingles that texts with a common passage share at least
# An edit or a move leaves 8 shingles or more unmatched, so k unbroken runs are alike only if they hold 32 (k - 1)
# matches and LEAST_SHARED: one run has 19 shingles, which are 23 words. Windows of such runs miss no passage.
RUN_WORDS = math.ceil(LEAST_SHARED / 2) + SHINGLE_WORDS - 1
PROBE_WORDS = 12  # words of one hash of a window
RUN = RUN_WORDS - PROBE_WORDS + 1  # the same run in hashes
PART = 2 * LEAST  # a longer passage has a shorter part (of LEAST or more) that is alike too
BESIDE = (RUN_WORDS - PROBE_WORDS + 1) // 2  # the run goes on for so many words before or after the hashed ones
THIN = 23  # words in which a hash that a text says again and again counts once
NEAR = math.ceil(PART / SIMILARITY) + THIN  # so a shared place sees one in so many shingles on either side
WINDOW_BYTES = 500_000  # text whose windows are found at once
ASKERS = 2000  # spans asked of one copy of a text
BLOCK = 256  # members of one block of a group; blocks are compared in pairs
PAIRS = 512  # pairs of members looked through at once
CODE = 5  # bytes of a shingle's hash that are sent


def compact_windows(hashes: np.ndarray, bounds: np.ndarray, least: int = LEAST):
    """(text, left, centre, right) of every compact window: all sequences of at least ``least`` hashes inside
    [left, right] that hold ``centre`` have their (leftmost) minimum there.

    The Cartesian tree of each text is walked level by level, all texts together; a part shorter than
    ``least`` has no window.
    """
    sizes = np.diff(bounds)
    text = np.flatnonzero(sizes >= least)
    left, right = bounds[:-1][text], bounds[1:][text] - 1
    out = []
    while len(text):
        lengths = right - left + 1
        first = np.cumsum(lengths) - lengths
        part = np.repeat(np.arange(len(text)), lengths)
        place = np.arange(len(part)) + (left - first)[part]
        values = hashes[place]
        hit = np.flatnonzero(values == np.minimum.reduceat(values, first)[part])
        owner = part[hit]
        centre = place[hit[np.concatenate([[True], owner[1:] != owner[:-1]])]]
        start = bounds[text]
        out.append((text, left - start, centre - start, right - start))
        lefts, rights = np.concatenate([left, centre + 1]), np.concatenate([centre - 1, right])
        text = np.concatenate([text, text])
        keep = rights - lefts + 1 >= least
        text, left, right = text[keep], lefts[keep], rights[keep]
    if not out:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(column) for column in zip(*out))


PLACES = "id long, row long, h array<long>, c array<int>, before array<int>, after array<int>"


def thinned(text: np.ndarray, h: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Which windows (in order) are kept: of neighbours with one hash in one text one in THIN words."""
    new = np.concatenate([[True], (np.diff(text) != 0) | (h[1:] != h[:-1])])[: len(text)]
    step = (centre - centre[new][np.cumsum(new) - 1]) // THIN
    return new | np.concatenate([[True], np.diff(step) != 0])[: len(text)]


def window_rows(docs: DataFrame) -> DataFrame:
    """The hash and the centre of the compact windows of each text (id, row, text), with names of the words before
    and after: of a run that two texts share, one of them is shared as well."""
    names = ["id", "row", "h", "c", "before", "after"]

    def make(batches):
        for batch in batches:
            for part in slices(batch, 2, WINDOW_BYTES):
                hashes, bounds = Words(part.column(2).to_pylist()).shingles(PROBE_WORDS)
                text, _, centre, _ = compact_windows(hashes, bounds, RUN)
                order = np.lexsort((centre, text))
                text, centre = text[order], centre[order]
                kept = thinned(text, hashes[bounds[text] + centre], centre)
                text, centre = text[kept], centre[kept]
                edges = np.searchsorted(text, np.arange(part.num_rows + 1))
                at = bounds[text] + centre
                none = mix(part.column(0).to_numpy()[text].view(np.uint64))  # a text that ends there shares nothing
                before = np.where(centre >= BESIDE, hashes[np.maximum(at - BESIDE, 0)], none)
                after = np.where(at + BESIDE < bounds[text + 1], hashes[np.minimum(at + BESIDE, len(hashes) - 1)], none)
                lists = [int_list(hashes[at].view(np.int64), edges)]
                for values in (centre, before, after):
                    low = (values.astype(np.uint64) & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                    lists.append(int_list(low, edges, pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names)

    return docs.select("id", "row", "text").mapInArrow(make, PLACES).where("size(h) > 0")


def encoded(shingles: np.ndarray) -> bytes:
    return shingles.astype("<u8", copy=False).view(np.uint8).reshape(-1, 8)[:, :CODE].tobytes()


def decoded(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // CODE, 8), np.uint8)
    out[:, :CODE] = np.frombuffer(data, np.uint8).reshape(-1, CODE)
    return out.view("<u8").ravel()


PAIR = ["b", "b_row", "a", "a_row"]
SPANS = "b long, b_row long, a long, a_row long, b_from array<int>, b_to array<int>, a_from array<int>, a_to array<int>"
FOUND = "b long, b_row long, a long, a_row long, passages array<struct<`from`:int,`to`:int,similarity:double>>"
PASSAGE = pa.struct([("from", pa.int32()), ("to", pa.int32()), ("similarity", pa.float64())])
FOUND_KIND = pa.schema([*((n, pa.int64()) for n in PAIR), ("passages", pa.list_(PASSAGE))])


def joined_spans(place: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Rows (b_from, b_to, a_from, a_to) in shingles: shared places of two texts, with what a passage may hold on
    either side; places whose surroundings meet and are moved about alike are one span."""
    order = np.lexsort((other, place))
    place, shift = place[order], (other - place)[order]
    reach = PART + THIN
    cut = (np.diff(place) > 2 * reach) | (np.abs(np.diff(shift)) > reach)
    first = np.flatnonzero(np.concatenate([[True], cut]))
    last = np.concatenate([first[1:], [len(place)]]) - 1
    low, high = place[first] - reach, place[last] + reach + PROBE_WORDS
    slack = np.maximum(SHIFT, np.ceil(SPARE * (high - low))).astype(np.int64)
    a_low = low + np.minimum.reduceat(shift, first) - slack
    a_high = high + np.maximum.reduceat(shift, first) + slack
    return np.stack([np.maximum(low, 0), high, np.maximum(a_low, 0), a_high], axis=1)


def _join_places(batches):
    """Candidate spans of pairs of texts from the places of their common windows."""
    names = [n.split()[0] for n in SPANS.split(", ")]
    for batch in batches:
        places = batch.column(4)
        edges = places.offsets.to_numpy() - places.offsets[0].as_py()
        own, other = (x.to_numpy().astype(np.int64) for x in places.flatten().flatten())
        found = [joined_spans(own[i:j], other[i:j]) for i, j in zip(edges, edges[1:])]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in found])])
        columns = np.concatenate(found).astype(np.int32).T if found else np.zeros((4, 0), np.int32)
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *(int_list(x, bounds, pa.int32()) for x in columns)], names)


def hopeful(match: np.ndarray, place: np.ndarray | None = None) -> np.ndarray:
    """Which rows of ``match`` (shingles of a text that hold no repeats, found in each of several others) may hold a
    passage (over the row's ``place``): a part of LEAST shingles or more of which SIMILARITY are matched. Without one
    passages_of finds nothing."""
    if match.shape[1] < LEAST:
        return np.zeros(len(match), bool)
    over = np.zeros((len(match), match.shape[1] + 1), np.float32)
    np.cumsum(match - np.float32(SIMILARITY), axis=1, out=over[:, 1:])
    begin, stops = over[:, : over.shape[1] - LEAST], over[:, LEAST:]
    if place is not None:  # a part begins at the place or before and stops after it
        column = np.arange(over.shape[1])
        begin = np.where(column[: over.shape[1] - LEAST] <= place[:, None], begin, np.float32(np.inf))
        stops = np.where(column[LEAST:] > place[:, None], stops, np.float32(-np.inf))
    return (stops - np.minimum.accumulate(begin, axis=1)).max(axis=1) > -1e-2


def close_over(match: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Which rows of ``match`` have a part over their ``centre`` as long as a passage, with enough matches and no gap at
    which passages_of cuts first."""
    row, at = np.nonzero(match)
    gap = (SPARE * np.bincount(row, minlength=len(match))).astype(np.int64)
    first = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(at, prepend=-1) - 1 > gap[row]))
    last = np.append(first[1:], len(row))[: len(first)] - 1
    there = centre[row[first]]
    long = (last + 1 - first >= LEAST_SHARED) & (at[last] + 1 - at[first] >= LEAST)
    over = (at[first] <= there + THIN) & (at[last] >= there - SHINGLE_WORDS)
    out = np.zeros(len(match), bool)
    out[row[first[long & over]]] = True
    return out


def alike_over(there: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Which rows of ``there`` may hold a passage over their ``centre``, for texts in which no shingle comes twice: the
    places in another text of each shingle (-1: none). A part that begins and ends with a match has to be as long as a
    passage, and its matches have to outweigh what both texts hold between them.

    Where matches are moved about by more than SHIFT, single_passages may look at some of them only; such rows stay.
    """
    if there.shape[1] < LEAST:
        return np.zeros(len(there), bool)
    match = there >= 0
    column = np.arange(there.shape[1], dtype=np.int32)
    shift = there - column
    far = np.where(match, shift, -(1 << 20)).max(axis=1) - np.where(match, shift, 1 << 20).min(axis=1) > SHIFT
    over = np.cumsum(match, axis=1, dtype=np.float32)
    over *= np.float32(1 + SIMILARITY)
    over -= np.float32(SIMILARITY) * (shift + 2 * column)
    begin = np.where(match & (column <= centre[:, None] + THIN), over, np.float32(np.inf))[:, : 1 - LEAST]
    stops = np.where(match & (column >= centre[:, None] - SHINGLE_WORDS), over, np.float32(-np.inf))[:, LEAST - 1 :]
    return far | ((stops - np.minimum.accumulate(begin, axis=1)).max(axis=1) > SIMILARITY - 1 - 1e-2)


LIGHT = "id long, row long, h long, c int, before int, after int, class long, open boolean, asks boolean, d long, size int"
MEMBER = "id long, row long, h long, c int, before int, after int, class long, open boolean, asks boolean, d long, blocks long, near binary"


def surroundings(plain: DataFrame, members: DataFrame, kinds: str) -> DataFrame:
    """Places of texts with the shingles within NEAR of each (``kinds`` is MEMBER), or only with their name and number
    (LIGHT): few of them are ever compared."""
    names = [k.split()[0] for k in kinds.split(", ")]
    given = [n for n in names[2:] if n in members.columns]
    held = members.groupBy("id", "row").agg(F.collect_set(F.struct(*given)).alias("own"))

    def make(batches):
        for batch in batches:
            for part in slices(batch, 2):
                shingles, bounds = Words(part.column(2).to_pylist()).shingles()
                rows = part.column(3)
                text = np.repeat(np.arange(part.num_rows), np.diff(rows.offsets.to_numpy()))
                own = rows.flatten()
                get = dict(zip([f.name for f in own.type], own.flatten()))
                low, high = bounds[text], bounds[text + 1]
                centre = low + get["c"].to_numpy()
                starts, stops = np.maximum(centre - NEAR, low), np.minimum(centre + NEAR + 1, high)
                for i in range(0, len(text), 1000):
                    near = [encoded(shingles[p:q]) for p, q in zip(starts[i : i + 1000], stops[i : i + 1000])]
                    ids = [part.column(k).take(pa.array(text[i : i + 1000])) for k in (0, 1)]
                    if names[-1] == "near":
                        made = [pa.array(near, pa.binary())]
                    else:
                        d = [int.from_bytes(hashlib.blake2b(x, digest_size=8).digest(), "little", signed=True) for x in near]
                        made = [pa.array(d, pa.int64()), pa.array([len(x) // CODE for x in near], pa.int32())]
                    yield pa.RecordBatch.from_arrays([*ids, *(get[n].slice(i, 1000) for n in given), *made], names)

    return plain.join(held, ["id", "row"]).select("id", "row", "text", "own").mapInArrow(make, kinds)


def _root(parent: dict, node: int) -> int:
    while (up := parent.get(node, node)) != node:
        parent[node] = node = parent.get(up, up)
    return node


def _places(codes: np.ndarray, text: np.ndarray, spot: np.ndarray, group: np.ndarray):
    """Where the shingles of each member stand in any other member of its group.

    Gives a table of places, the first cell of each member in it, the column of each shingle (-1: no other has it; the
    place of a shingle in a member is in the member's first cell and so many on, -1: it has none) and the members in
    which no shingle comes twice.
    """
    owner = group[text]
    values, number, counts = np.unique(codes | owner.astype(np.uint64) << np.uint64(8 * CODE), return_inverse=True, return_counts=True)
    shared = counts > 1
    kept = np.cumsum(shared) - shared  # numbers of the shared ones alone
    width = np.bincount((values[shared] >> np.uint64(8 * CODE)).astype(np.int64), minlength=int(group[-1]) + 1)
    column = np.where(shared[number], kept[number] - (np.cumsum(width) - width)[owner], -1)
    cells = np.cumsum(width[group])
    first = cells - width[group]
    table = np.full(int(cells[-1]) + 1, -1, np.int16)
    held = np.flatnonzero(column >= 0)
    at = first[text[held]] + column[held]
    table[at[::-1]] = spot[held][::-1]  # of a shingle that comes twice the first place
    again = np.bincount(text[held], weights=table[at] != spot[held], minlength=len(group))
    return table, first, column, again == 0


def _common(text: np.ndarray, column: np.ndarray, asks: np.ndarray, there: np.ndarray) -> np.ndarray:
    """How many shingles (of these columns) of each asking member any other one has, for many pairs at once."""
    both = np.zeros((len(asks), len(asks)), np.float32)
    for start in range(0, int(column.max(initial=-1)) + 1, 1024):
        here = (column >= start) & (column < start + 1024)
        counts = np.bincount(text[here] * 1024 + column[here] - start, minlength=len(asks) * 1024)
        counts = counts.reshape(-1, 1024).astype(np.float32)
        both[np.ix_(asks, there)] += counts[asks] @ (counts[there] > 0).astype(np.float32).T
    return both


def _compare(batches):
    """FOUND rows of two blocks of a group: a later member is compared with the smaller ones of other classes, and
    with all of them as long as its place lies in no passage. Classes that a passage links are one from then on. A member
    that heeds is compared with the smaller ones that ask and are not there.

    Only members that share LEAST_SHARED places around the common one, and enough of them close together, are
    compared exactly. Small groups are looked through together, pairs in slices.
    """
    for batch in batches:
        out = []
        groups = batch.column(0)
        edges = groups.offsets.to_numpy().astype(np.int64)
        edges -= edges[0]
        members = groups.flatten()
        packs = np.flatnonzero(np.diff(edges[:-1] // BLOCK, prepend=-1, append=-1))
        for i, j in zip(packs, packs[1:]):
            pack = members.slice(edges[i], edges[j] - edges[i])
            out.extend(_compare_pack(pack, np.repeat(np.arange(j - i), np.diff(edges[i : j + 1]))))
        yield pa.RecordBatch.from_pylist(out, FOUND_KIND)


def _compare_pack(members: pa.StructArray, group: np.ndarray):
    get = dict(zip([f.name for f in members.type], members.flatten()))
    asks, there, heeds, is_open = (get[n].to_numpy(zero_copy_only=False) for n in ("asks", "there", "heeds", "open"))
    ids, text_row, classes, centre = (get[n].to_numpy() for n in ("id", "row", "class", "c"))
    by_id = np.argsort(ids, kind="stable")
    wanted = asks[:, None] & there[by_id] | heeds[:, None] & (asks & ~there)[by_id]
    wanted &= (group[:, None] == group[by_id]) & (ids[by_id] < ids[:, None])
    wanted &= is_open[:, None] | (classes[by_id] != classes[:, None])
    later, first = np.nonzero(wanted)
    first = by_id[first]
    if not len(later):
        return
    near = get["near"].to_pylist()
    sizes = np.array([len(x) // CODE for x in near])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    codes = decoded(b"".join(near))
    text = np.repeat(np.arange(len(sizes)), sizes)
    spot = np.arange(len(codes)) - bounds[text]
    table, cell, column, single = _places(codes, text, spot, group)
    columns = np.full((len(sizes), int(sizes.max())), -1, np.int32)
    columns[text, spot] = column
    if len(later) > 8 * PAIRS and group[-1] == 0 and column.max() < 8192:
        held = np.flatnonzero(column >= 0)
        enough = _common(text[held], column[held], asks | heeds, asks | there)[later, first] >= LEAST_SHARED
        later, first = later[enough], first[enough]
    begun = np.maximum(0, centre - NEAR)
    parent: dict[int, int] = {}
    roots, explained = classes, ~is_open
    for start in range(0, len(later), PAIRS):
        xs, ys = later[start : start + PAIRS], first[start : start + PAIRS]
        open_pairs = ~explained[xs] | (roots[xs] != roots[ys])
        xs, ys = xs[open_pairs], ys[open_pairs]
        where = columns[xs]
        where = np.where(where >= 0, table[cell[ys][:, None] + where], -1)
        match = where >= 0
        likely = np.count_nonzero(match, axis=1) >= LEAST_SHARED
        likely[likely] = close_over(match[likely], (centre - begun)[xs[likely]])
        both, one = likely & single[xs] & single[ys], likely & single[xs] & ~single[ys]
        likely[both] = alike_over(where[both], (centre - begun)[xs[both]])
        likely[one] = hopeful(match[one], (centre - begun)[xs[one]])
        linked = False
        for k in np.flatnonzero(likely):
            x, y = xs[k], ys[k]
            mine, other = _root(parent, int(classes[x])), _root(parent, int(classes[y]))
            if explained[x] and mine == other:
                continue
            if single[x] and single[y]:
                hits = np.flatnonzero(match[k])
                passages = single_passages(hits, where[k][hits].astype(np.int64))
            else:
                passages = passages_of(codes[bounds[x] : bounds[x + 1]], codes[bounds[y] : bounds[y + 1]])
            passages = [(int(begun[x]) + p, int(begun[x]) + q + SHINGLE_WORDS - 1, s) for p, q, s in passages]
            # A passage elsewhere has common places of its own.
            passages = [(p, q, s) for p, q, s in passages if p <= centre[x] + THIN and q >= centre[x]]
            if passages:
                linked |= mine != other
                parent[max(mine, other)] = min(mine, other)
                explained[x] |= any(p <= centre[x] and centre[x] + PROBE_WORDS <= q for p, q, _ in passages)
                kept = [{"from": p, "to": q, "similarity": s} for p, q, s in passages]
                yield {"b": ids[x], "b_row": text_row[x], "a": ids[y], "a_row": text_row[y], "passages": kept}
        if linked:
            roots = np.array([_root(parent, c) for c in classes.tolist()])


def group_passages(plain: DataFrame, shared: DataFrame, found: DataFrame, tables: Tables) -> DataFrame:
    """FOUND rows of the places (id, row, h, c, before, after) that the passages ``found`` leave open: a place lies in no
    passage yet, or places that share a run are in documents of several classes.

    Such members are compared in blocks of their hash group: first each block in itself, then, where places still lie in
    no passage or runs are still in several classes, in pairs of blocks. Those with equal surroundings are one, the
    one of the smallest id; the others repeat it.
    """
    classes = components(found.select(F.col("b").alias("a"), F.col("a").alias("b")), tables)
    classes = tables.put(classes.select(F.col("node").alias("id"), F.col("component").alias("class")))
    covered = found.groupBy(F.col("b").alias("id"), F.col("b_row").alias("row"))
    covered = covered.agg(F.array_distinct(F.flatten(F.collect_list("passages"))).alias("covered"))
    explained = F.exists("covered", lambda p: (p["from"] <= F.col("c")) & (p["to"] >= F.col("c") + PROBE_WORDS))
    members = shared.join(covered, ["id", "row"], "left").withColumn("bare", ~F.coalesce(explained, F.lit(False)))
    members = members.join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    members = tables.put(members.select("id", "row", "h", "c", "before", "after", "bare", "class"))
    tables.drop(shared)
    runs = []
    for side in ("before", "after"):
        run = members.groupBy("h", side).agg(
            F.min("id").alias(f"{side}_least"),
            F.max(F.when(F.col("bare"), F.col("id"))).alias("bare"),
            (F.min("class") < F.max("class")).alias(f"{side}_mixed"),
        )
        run = run.where(F.col(f"{side}_mixed") | (F.col("bare") > F.col(f"{side}_least")))
        runs.append(tables.put(run.drop("bare")))
    left = members.join(runs[0], ["h", "before"], "left").join(runs[1], ["h", "after"], "left")
    left = left.where("before_least IS NOT NULL OR after_least IS NOT NULL")
    is_open = F.coalesce(F.col("bare") & (F.col("id") > F.least("before_least", "after_least")), F.lit(False))
    left = left.withColumn("open", is_open)
    mixed = F.coalesce("before_mixed", F.lit(False)) | F.coalesce("after_mixed", F.lit(False))
    left = left.select("id", "row", "h", "c", "before", "after", "class", "open", (F.col("open") | mixed).alias("asks"))
    left = tables.put(left)
    tables.drop(members, *runs)
    members = left
    groups = members.groupBy("h").agg(F.count("*").alias("n"), F.count_if("asks").alias("u")).where("n > 1 AND u > 0")
    cut = surroundings(plain, members.join(groups.select("h"), "h"), LIGHT)
    # Surroundings in which a whole passage fits make their texts alike; shorter ones are compared each for itself.
    cut = tables.put(cut.withColumn("d", F.when(F.col("size") >= LEAST, F.col("d")).otherwise(F.xxhash64("d", "id", "row", "c"))))
    tables.drop(members)
    least = cut.groupBy("h", "d").agg(F.min(F.struct("id", "row", "c", "before", "after", "class", "open", "asks")).alias("least"), F.count("*").alias("n"))
    least = tables.put(least)
    low = F.greatest(F.lit(0), F.col("c") - NEAR)
    span = F.struct(
        low.alias("from"),
        (low + F.col("size") + (SHINGLE_WORDS - 1)).cast("int").alias("to"),
        F.lit(1.0).alias("similarity"),
    )
    copies = cut.join(least.where("n > 1").select("h", "d", "least"), ["h", "d"]).where("id > least.id").select(
        F.col("id").alias("b"), F.col("row").alias("b_row"), F.col("least.id").alias("a"), F.col("least.row").alias("a_row"), F.array(span).alias("passages")
    )
    copies = tables.put(copies.distinct())
    groups = least.groupBy("h").agg(F.count("*").alias("n"), F.count_if("least.asks").alias("u")).where("n > 1 AND u > 0")
    others = least.select("h", "d", "least.*").join(groups.select("h", F.ceil(F.col("n") / BLOCK).alias("blocks")), "h")
    others = tables.put(surroundings(plain, others, MEMBER))
    tables.drop(cut, least)
    sent = F.struct("asks", "there", "heeds", "id", "row", "c", "class", "open", "near")

    def compared(blocks: DataFrame, *keys: str) -> DataFrame:
        grouped = blocks.groupBy(*keys).agg(F.collect_list(sent).alias("members"))
        grouped = grouped.where(F.exists("members", lambda m: m["asks"]) & (F.size("members") > 1))
        return grouped.select("members").mapInArrow(_compare, FOUND)

    place = lambda n: F.pmod(F.xxhash64("d"), F.col(n))
    yes, no = F.lit(True), F.lit(False)
    block = others.withColumn("i", place("blocks")).withColumn("there", yes).withColumn("heeds", no)
    inside = tables.put(compared(block, "h", "i"))
    if others.where("blocks > 1").isEmpty():
        return copies.unionAll(inside)
    wide = others.where("blocks > 1")
    asking = tables.put(still_asking(wide.drop("near"), copies.unionAll(inside), classes, tables))
    groups = asking.groupBy("h").agg(F.count("*").alias("n"), F.count_if("asks").alias("u")).where("u > 0")
    groups = groups.select("h", *(F.ceil(F.col(n) / BLOCK).alias(name) for n, name in (("n", "a_blocks"), ("u", "b_blocks"))))
    again = asking.join(groups, "h").join(wide.select("id", "row", "h", "c", "near"), ["id", "row", "h", "c"])
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    later = again.where("asks").withColumns({"there": no, "heeds": no, "i": place("b_blocks"), "j": each("a_blocks")})
    first = again.withColumns({"heeds": ~F.col("asks"), "asks": no, "there": yes, "i": each("b_blocks"), "j": place("a_blocks")})
    return copies.unionAll(inside).unionAll(compared(later.unionAll(first), "h", "i", "j"))


def still_asking(members: DataFrame, found: DataFrame, classes: DataFrame, tables: Tables) -> DataFrame:
    """``members`` of groups of several blocks with class, open and asks as they are after ``found``, the rows of equal
    surroundings and of each block compared in itself: of many texts that repeat each other few ask the other blocks.

    Of two classes one is not the group's largest; its members ask, and the others heed them.
    """
    links = found.select("b", "a").distinct()
    for n in ("b", "a"):
        own = classes.select(F.col("id").alias(n), F.col("class").alias(f"{n}_class"))
        links = links.join(own, n, "left").withColumn(f"{n}_class", F.coalesce(f"{n}_class", n))
    merged = components(links.select(F.col("b_class").alias("a"), F.col("a_class").alias("b")), tables)
    merged = merged.select(F.col("node").alias("class"), F.col("component").alias("now"))
    covered = found.groupBy(F.col("b").alias("id"), F.col("b_row").alias("row"))
    covered = covered.agg(F.array_distinct(F.flatten(F.collect_list("passages"))).alias("covered"))
    explained = F.exists("covered", lambda p: (p["from"] <= F.col("c")) & (p["to"] >= F.col("c") + PROBE_WORDS))
    now = members.join(merged, "class", "left").withColumn("class", F.coalesce("now", "class")).drop("now")
    now = now.join(covered, ["id", "row"], "left")
    now = tables.put(now.withColumn("open", F.col("open") & ~F.coalesce(explained, F.lit(False))).drop("covered"))
    sizes = now.groupBy("h", "class").agg(F.count("*").alias("n"))
    told = now.join(sizes.groupBy("h").agg(F.max_by("class", F.struct("n", "class")).alias("main")), "h")
    mixed = F.lit(False)
    for side in ("before", "after"):
        run = now.groupBy("h", side).agg((F.min("class") < F.max("class")).alias(f"{side}_mixed")).where(f"{side}_mixed")
        told = told.join(run, ["h", side], "left")
        mixed |= F.coalesce(f"{side}_mixed", F.lit(False))
    asks = F.col("open") | (mixed & (F.col("class") != F.col("main")))
    return told.withColumn("asks", asks).select("id", "row", "h", "c", "class", "open", "asks", "d")


def _alike_at_large(own: np.ndarray, a: np.ndarray) -> float:
    """Jaccard similarity of a set of shingles and the stretch of ``a`` between its first and last member."""
    hits = np.flatnonzero(np.isin(a, own))
    there = np.unique(a[hits[0] : hits[-1] + 1]) if len(hits) else hits
    both = len(np.intersect1d(own, there))
    return both / max(1, len(own) + len(there) - both)


def _run_passages(hits: np.ndarray, place: np.ndarray) -> list[tuple[int, int, float]]:
    """single_passages of matches that are in order and hardly moved: by unbroken runs, as none of them is left out."""
    steps = np.diff(hits) - 1
    cuts = np.flatnonzero(steps)
    gaps = steps[cuts].tolist()
    begin, end = [0, *(cuts + 1).tolist()], [*(cuts + 1).tolist(), len(hits)]
    low, high = hits[begin].tolist(), [x + 1 for x in hits[[x - 1 for x in end]].tolist()]
    a_low, a_high = place[begin].tolist(), [x + 1 for x in place[[x - 1 for x in end]].tolist()]
    out = []
    left = [(0, len(begin), int(SPARE * len(hits)))]
    while left:
        u, v, gap = left.pop()
        both, own = end[v - 1] - begin[u], high[v - 1] - low[u]
        if both < SIMILARITY * LEAST or own < LEAST:
            continue
        wide = [w for w in range(u + 1, v) if gaps[w - 1] > gap]
        if wide:
            left.extend((x, y, gap) for x, y in zip([u, *wide], [*wide, v]))
            continue
        if both >= SIMILARITY * own:
            alike = both / (own + a_high[v - 1] - a_low[u] - both)
            if alike >= SIMILARITY:
                out.append((low[u], high[v - 1], alike))
                continue
        widest = max(gaps[u : v - 1], default=0)
        if widest:
            left.append((u, v, min(widest - 1, gap * 3 // 4)))
    return sorted(out)


def single_passages(hits: np.ndarray, place: np.ndarray) -> list[tuple[int, int, float]]:
    """passages_of two texts in which no shingle comes twice: ``hits`` are the places of the common ones in the first
    text, ``place`` in the second. Sets of shingles are then as large as their stretches are long."""
    if len(hits) < LEAST_SHARED:
        return []
    if (place[1:] > place[:-1]).all():  # a passage is a run of hits, which outweighs what both texts hold between them
        over = (1 + SIMILARITY) * np.arange(len(hits)) - SIMILARITY * (hits + place)
        lowest = np.minimum.accumulate(over[: len(over) - LEAST_SHARED + 1])
        if (over[LEAST_SHARED - 1 :] - lowest).max() < SIMILARITY - 1 - 1e-6:
            return []
        shift = place - hits
        if int(shift.max()) - int(shift.min()) <= SHIFT:
            return _run_passages(hits, place)
    steps, shift, out = np.diff(hits) - 1, place - hits, []
    left = [(0, len(hits), int(SPARE * len(hits)))]
    while left:
        i, j, gap = left.pop()
        own = int(hits[j - 1]) + 1 - int(hits[i])
        if j - i < SIMILARITY * LEAST or own < LEAST:
            continue
        cuts = (np.flatnonzero(steps[i : j - 1] > gap) + (i + 1)).tolist()
        if cuts:
            left.extend((x, y, gap) for x, y in zip([i, *cuts], [*cuts, j]))
            continue
        if j - i >= SIMILARITY * own:
            there, moved = place[i:j], shift[i:j]
            low, high, most = int(there.min()), int(there.max()), max(SHIFT, SPARE * own)
            alike = (j - i) / (own + high + 1 - low - (j - i))
            if int(moved.max()) - int(moved.min()) > most:  # else all are near, and this is their likeness
                near = there[np.abs(moved - np.median(moved)) <= most]
                if len(near):
                    low, high = int(near.min()), int(near.max())
                    both = np.count_nonzero((there >= low) & (there <= high))
                    alike = max(alike, len(near) / (own + high + 1 - low - both))
            if alike >= SIMILARITY:
                out.append((int(hits[i]), int(hits[i]) + own, float(alike)))
                continue
        widest = int(steps[i : j - 1].max())
        if widest:
            left.append((i, j, min(widest - 1, gap * 3 // 4)))
    return sorted(out)


def passages_of(b: np.ndarray, a: np.ndarray) -> list[tuple[int, int, float]]:
    """(from, to, similarity) of the parts of shingles ``b`` that repeat in shingles ``a``, checked exactly.

    A part may first span gaps as wide as SPARE of its matches; where it is not alike, it is cut at narrower ones.
    """
    values, first = np.unique(a, return_index=True)
    if not len(values):
        return []
    at = np.minimum(np.searchsorted(values, b), len(values) - 1)
    match, place = values[at] == b, first[at]
    order = np.argsort(b, kind="stable")
    again = b[order[1:]] == b[order[:-1]]
    if len(values) == len(a) and not again.any():
        return single_passages(np.flatnonzero(match), place[match])
    before = np.full(len(b), -1)  # where a shingle stood before; in [p, q) as many differ as stood before p
    before[order[1:][again]] = order[:-1][again]

    def look(hits: np.ndarray, gap: int) -> list[tuple[int, int, float]]:
        if len(hits) < SIMILARITY * LEAST or hits[-1] + 1 - hits[0] < LEAST:
            return []
        steps = np.diff(hits) - 1
        cuts = np.flatnonzero(steps > gap) + 1
        if len(cuts):
            return [found for part in np.split(hits, cuts) for found in look(part, gap)]
        p, q = int(hits[0]), int(hits[-1]) + 1
        if np.count_nonzero(before[hits] < p) < SIMILARITY * np.count_nonzero(before[p:q] < p):  # it cannot be alike
            widest = int(steps.max())
            return look(hits, min(widest - 1, gap * 3 // 4)) if widest else []
        shift = place[hits] - hits
        near = hits[np.abs(shift - np.median(shift)) <= max(SHIFT, SPARE * (q - p))]
        own = np.unique(b[p:q])
        same = np.unique(b[near]) if len(near) else near
        there = np.unique(a[place[near].min() : place[near].max() + 1]) if len(near) else near
        alike = max(
            len(same) / max(1, len(own) + len(there) - len(np.intersect1d(own, there))),
            _alike_at_large(own, a),  # where lines repeat, places do not tell which one matches
        )
        if alike >= SIMILARITY:
            return [(p, q, float(alike))]
        widest = int(steps.max())
        return look(hits, min(widest - 1, gap * 3 // 4)) if widest else []

    hits = np.flatnonzero(match)
    return look(hits, int(SPARE * len(hits)))


def named_texts(docs: DataFrame, tables: Tables, text: str) -> DataFrame:
    """(id, row, text) of documents with an id; ``row`` tells unlike texts of one id apart."""
    plain = docs.where(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("id"), F.coalesce(f"`{text}`", F.lit("")).alias("text"))
    many = tables.put(plain.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id"))
    nothing = F.lit(0).cast("long")
    if many.isEmpty():
        return plain.select("id", nothing.alias("row"), "text")
    known = plain.join(many.withColumn("many", F.lit(True)), "id", "left")
    return known.select("id", F.when(F.col("many"), F.xxhash64("text")).otherwise(nothing).alias("row"), "text")


def joined_passages(passages: list[dict]) -> list[dict]:
    """Passages of one pair of texts in their order; those that overlap are one, as alike as the longest of them."""
    out: list[dict] = []
    longest = 0
    for p in sorted(passages, key=lambda p: (p["from"], p["to"], p["similarity"])):
        size = p["to"] - p["from"]
        if out and p["from"] < out[-1]["to"]:
            if size > longest:
                out[-1]["similarity"], longest = p["similarity"], size
            out[-1]["to"] = max(out[-1]["to"], p["to"])
        else:
            out.append(dict(p))
            longest = size
    return out


def repeated_passages(docs: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """(doc_id, source_id, passages): passages of 50 words or more that repeat one of a document with a smaller id.

    ``passages`` holds struct<from,to,similarity> with word places. A passage holds a run of RUN_WORDS words that the
    other text has too, so both have one compact window of that run with one min-hash. Windows are compared with the
    first document that has their hash (an anchor): the spans around them are cut from both texts and compared
    exactly. Hash groups with a place that lies in no passage then, or with documents that no chain of passages links,
    are compared member by member (see group_passages). So each word that repeats a smaller id is in a passage, and
    chains of rows link all documents that repeat each other; a document whose passages and links are known
    already is not listed again with all others that have the same. Texts without words (NULL, empty) and texts
    under 50 words have none. Rows with one doc_id count as one document; rows without an id have no passages.
    """
    before = set(tables.live)
    plain = named_texts(docs, tables, text)
    named = set(tables.live)
    windows = tables.put(window_rows(plain))
    each = windows.select("id", "row", F.inline(F.arrays_zip("h", "c", "before", "after")))
    anchors = each.groupBy("h").agg(F.min(F.struct("id", "row", "c")).alias("anchor"), F.max("id").alias("last"))
    anchors = tables.put(anchors.where("anchor.id < last").select("h", "anchor"))
    shared = tables.put(each.join(anchors, "h").select("id", "row", "h", "c", "before", "after", "anchor"))
    tables.drop(windows, anchors)
    places = shared.where("id > anchor.id").groupBy(
        F.col("id").alias("b"), F.col("row").alias("b_row"), F.col("anchor.id").alias("a"), F.col("anchor.row").alias("a_row")
    )
    places = places.agg(F.collect_list(F.struct("c", F.col("anchor.c").alias("other"))).alias("places"))
    spans = tables.put(places.mapInArrow(_join_places, SPANS))
    found = tables.put(checked_spans(plain, spans, tables))
    tables.keep_since(named, shared, found)
    rest = tables.put(group_passages(plain, shared, found, tables))
    tables.keep_since(named, found, rest)
    both = found.unionAll(rest).groupBy(F.col("b").alias("doc_id"), F.col("a").alias("source_id"))
    both = both.agg(F.array_distinct(F.flatten(F.collect_list("passages"))).alias("passages"))

    def join(batches):
        for batch in batches:
            lists = pa.array([joined_passages(p) for p in batch.column(2).to_pylist()], pa.list_(PASSAGE))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], lists], names)

    names = ["doc_id", "source_id", "passages"]
    both = tables.put(both.mapInArrow(join, both.schema))
    tables.keep_since(before, both)
    told = tables.put(needed_links(both))
    tables.keep_since(before, told)
    return told


def needed_links(found: DataFrame) -> DataFrame:
    """``found`` without the links that say nothing new: what repeats the source repeats the document's smallest source
    in the same passages, and these two are linked themselves."""
    least = found.groupBy("doc_id").agg(F.min("source_id").alias("s"), F.min_by("passages", "source_id").alias("there"))
    links = found.select(F.col("doc_id").alias("source_id"), F.col("source_id").alias("s"), F.lit(True).alias("linked"))
    within = F.forall("passages", lambda p: F.exists("there", lambda q: (q["from"] <= p["from"]) & (q["to"] >= p["to"])))
    both = found.join(least, "doc_id").join(links, ["source_id", "s"], "left")
    return both.where(F.col("linked").isNull() | ~within).select("doc_id", "source_id", "passages")


def checked_spans(plain: DataFrame, spans: DataFrame, tables: Tables) -> DataFrame:
    """FOUND rows that exact comparison finds in the stored candidate spans (SPANS).

    A text is sent once with all spans asked of it, or once for each ASKERS of them where there are more.
    """

    def side(of: str, later: bool) -> DataFrame:
        own = [F.col(of).alias("id"), F.col(f"{of}_row").alias("row")]
        return spans.select(*own, *PAIR, F.lit(later).alias("later"), F.col(f"{of}_from").alias("low"), F.col(f"{of}_to").alias("high"))

    asked = side("b", True).unionAll(side("a", False))
    many = asked.groupBy("id", "row").agg(F.ceil(F.count("*") / ASKERS).alias("sheets")).where("sheets > 1")
    sheet = F.pmod(F.xxhash64(*PAIR), F.coalesce("sheets", F.lit(1)))
    asked = asked.join(tables.put(many), ["id", "row"], "left").withColumn("sheet", sheet)
    asked = asked.groupBy("id", "row", "sheet").agg(F.collect_list(F.struct(*PAIR, "later", "low", "high")).alias("asked"))
    found = plain.join(asked, ["id", "row"]).select("text", "asked")
    kind = ", ".join([*(f"{n} long" for n in PAIR), "later boolean", "starts array<int>", "pieces array<binary>"])

    def cut(batches):
        names = [*PAIR, "later", "starts", "pieces"]
        for batch in batches:
            for part in slices(batch, 0):
                shingles, bounds = Words(part.column(0).to_pylist()).shingles()
                rows = part.column(1)
                text = np.repeat(np.arange(part.num_rows), np.diff(rows.offsets.to_numpy()))
                own = rows.flatten()
                get = dict(zip([f.name for f in own.type], own.flatten()))
                low, high = get["low"].to_pylist(), get["high"].to_pylist()
                held, size, begun = [], 0, 0
                for i, (t, starts, stops) in enumerate(zip(text.tolist(), low, high)):
                    p, q = bounds[t], bounds[t + 1]
                    held.append([encoded(shingles[min(p + x, q) : min(p + y, q)]) for x, y in zip(starts, stops)])
                    size += sum(map(len, held[-1]))
                    if size > 2_000_000 or i + 1 == len(low):
                        here = [get[n].slice(begun, i + 1 - begun) for n in (*PAIR, "later", "low")]
                        yield pa.RecordBatch.from_arrays([*here, pa.array(held, pa.list_(pa.binary()))], names)
                        held, size, begun = [], 0, i + 1

    pieces = found.mapInArrow(cut, kind).groupBy(*PAIR)
    pairs = pieces.agg(F.collect_list(F.struct("later", "starts", "pieces")).alias("sides"))

    def check(batches):
        for batch in batches:
            rows = []
            sides = batch.column(4)
            for k in range(batch.num_rows):
                both = {}
                for one in sides[k].as_py():  # equal rows of one id are sent more than once
                    both[one["later"]] = one
                passages = []
                if len(both) == 2:
                    for start, x, y in zip(both[True]["starts"], both[True]["pieces"], both[False]["pieces"]):
                        for p, q, alike in passages_of(decoded(x), decoded(y)):
                            passages.append({"from": start + p, "to": start + q + SHINGLE_WORDS - 1, "similarity": alike})
                if passages:
                    rows.append({**{n: batch.column(i)[k].as_py() for i, n in enumerate(PAIR)}, "passages": passages})
            yield pa.RecordBatch.from_pylist(rows, FOUND_KIND)

    return pairs.mapInArrow(check, FOUND)


def passage_classes(docs: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """doc_id, class_id, n_passages, repeated_words, source_ids and passages of every document.

    class_id is the smallest doc_id reachable over repeated passages (its own where there is none).
    """
    found = repeated_passages(docs, tables, text)
    classes = components(found.select(F.col("doc_id").alias("a"), F.col("source_id").alias("b")), tables)
    spans = found.select("doc_id", "source_id", F.inline("passages"))
    per_doc = spans.groupBy("doc_id").agg(
        F.sort_array(F.collect_set(F.struct("from", "to"))).alias("passages"),
        F.sort_array(F.collect_set("source_id")).alias("source_ids"),
    )
    out = docs.select("doc_id").join(per_doc, "doc_id", "left").join(
        classes.select(F.col("node").alias("doc_id"), F.col("component").alias("class_id")), "doc_id", "left"
    )
    words = F.aggregate(
        "passages",
        F.struct(F.lit(0).alias("total"), F.lit(0).alias("reach")),
        lambda s, p: F.struct(
            (s["total"] + F.greatest(F.lit(0), p["to"] - F.greatest(p["from"], s["reach"]))).alias("total"),
            F.greatest(s["reach"], p["to"]).alias("reach"),
        ),
        lambda s: s["total"],
    )
    return out.select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce(F.size("passages"), F.lit(0)).alias("n_passages"),
        F.coalesce(words, F.lit(0)).alias("repeated_words"),
        "source_ids",
        "passages",
    )


def numbered_rows(docs: DataFrame, tables: Tables, name: str) -> DataFrame:
    """Documents with a number of their own in column ``name``: their id, or for rows without an id or with one that
    repeats, numbers after all ids (which are below 2 ** 62), given once in a stored table."""
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    repeated = tables.put(ids.select("doc_id", F.lit(True).alias(f"{name}_many")))
    if repeated.isEmpty():
        return docs.withColumn(name, F.col("doc_id"))
    last = docs.agg(F.coalesce(F.max("doc_id"), F.lit(0))).first()[0]
    repeated = repeated.withColumnRenamed("doc_id", f"{name}_id")
    known = docs.join(repeated, docs["doc_id"].eqNullSafe(repeated[f"{name}_id"]), "left")
    number = F.when(F.col(f"{name}_many"), F.monotonically_increasing_id() + last + 1).otherwise(F.col("doc_id"))
    return tables.put(known.withColumn(name, number).drop(f"{name}_many", f"{name}_id"))


def remove_passages(docs: DataFrame, tables: Tables, text: str = "text") -> DataFrame:
    """Documents without the words of passages that repeat a document with a smaller id.

    Rows that repeat an id or have none are documents of their own, which come after all others. Other columns stay; a
    document of which nothing but white space is left goes. Texts without repeats are untouched.
    """
    rows = numbered_rows(docs, tables, "_number")
    named = rows.select(F.col("_number").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = repeated_passages(named, tables)
    spans = found.select(F.col("doc_id").alias("_number"), F.inline("passages")).groupBy("_number")
    spans = tables.put(spans.agg(F.sort_array(F.collect_set(F.struct("from", "to"))).alias("_spans")))
    tables.drop(found)
    others = [c for c in docs.columns if c != text]
    hidden = [F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(others)]
    sent = rows.join(spans, "_number", "left").select(F.col(f"`{text}`").alias("_text"), "_spans", *hidden)

    def cut(batches):
        for batch in batches:
            for part in slices(batch, 0):
                texts, spans = part.column(0).to_pylist(), part.column(1).to_pylist()
                left = [without(t, s) if s else t for t, s in zip(texts, spans)]
                stays = [not s or t.strip() != "" for t, s in zip(left, spans)]
                arrays = [pa.array(left, pa.string()), pa.array(stays), *part.columns[2:]]
                yield pa.RecordBatch.from_arrays(arrays, names)

    fields = [T.StructField("_text", T.StringType()), T.StructField("_stays", T.BooleanType())]
    schema = T.StructType([*fields, *sent.schema.fields[2:]])
    names = schema.names
    back = {c: f"_{i}" for i, c in enumerate(others)} | {text: "_text"}
    return sent.mapInArrow(cut, schema).where("_stays").select(*[F.col(back[c]).alias(c) for c in docs.columns])


def without(text: str, spans: list[dict]) -> str:
    """The text without the words of the (sorted) spans."""
    words = Words([text])
    out, at = [], 0
    for span in spans:
        start = int(words.start[span["from"]])
        stop = int(words.end[min(span["to"], len(words.end)) - 1])
        if start > at:
            out.append(words.data[at:start])
        at = max(at, stop)
    out.append(words.data[at:])
    return b"".join(out).decode("utf-8", "surrogatepass")

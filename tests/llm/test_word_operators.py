"""Spelling variants, decontamination and source divergence against plain Python, on odd rows and hot groups."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tradeloom.llm import divergence, positional_index, queries, spelling
from tradeloom.llm.store import Tables

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, term string, row long, word string, n long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that the operators use."""
    return spark.createDataFrame([(*r, 1, "t", 1, "w", 1) for r in rows], SCHEMA).repartition(3)


def given(spark):
    return [tuple(r)[:4] for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]


# 11
def spelled(rows, least=2):
    words = Counter()
    for name, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            words[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in words.items() if len(w) >= 7 and n >= least}
    cuts, near = defaultdict(set), defaultdict(set)
    for w in words:
        for k in range(len(w)):
            cuts[k, w[:k] + w[k + 1 :]].add(w)
    for (_, cut), found in cuts.items():
        for w in found:
            near[w] |= found - {w}
            if cut in words:
                near[w].add(cut)
                near[cut].add(w)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def variants(found):
    rows = [tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


ODD_WORDS = [
    (1, "Painting painting PAINTING paintings " * 40 + "paintinq paintinq ainting ainting", "en", "a"),
    (2, "étranger etranger étranger etranger Étranger Étranger a×b÷cdefg a×b÷cdefg", "fr", "a"),
    (None, None, None, None),
    (3, "", "en", "a"),
    (4, " ".join(["x" * 5000, "x" * 4999 + "y"] * 3 + ["x" * 5001] * 2), "en", "a"),
    (5, "abcdefgh abcdefgh hgfedcba hgfedcba abcdegfh abcdegfh", "en", "a"),
    (5, "abcdefgh abcdefgh hgfedcba hgfedcba abcdegfh abcdegfh", "en", "a"),
    (None, "painting painting", "en", "a"),
]


@pytest.mark.parametrize("part", [spelling.PART, 3])
def test_variants_match_plain_python(spark, part):
    docs = given(spark) + ODD_WORDS
    assert variants(spelling.variant_groups(frame(spark, docs), Tables(spark), part=part)) == spelled(docs)


def test_hot_block_of_words_is_compared_in_parts(spark):
    rng = np.random.default_rng(0)  # one signature for most words: rearranged letters, with chains of forms
    words = {"".join(rng.permutation(list("aabbccdd"))) for _ in range(400)} | {"aabbccde", "aabbcce", "aabbccdd"}
    text = " ".join(w for k, w in enumerate(sorted(words)) for _ in range(2 * 11 ** (k % 3)))
    docs = [(7, text, "en", "a")]
    found = variants(spelling.variant_groups(frame(spark, docs), Tables(spark), part=50))
    assert found == spelled(docs) and any(root != form for _, form, root, *_ in found if form)


def test_one_edit_is_exact():
    words = ["abcdefg", "abcdefh", "abcdef", "bcdefg", "abdefg", "abcdegf", "zabcdefg", "abczdefg", "abcdefgz", "gabcdef"]
    letters = spelling.Letters(pa.array(words))
    pairs = [(i, j) for i in range(len(words)) for j in range(len(words)) if i != j and 0 <= len(words[j]) - len(words[i]) <= 1]
    a, b = (np.array(x) for x in zip(*pairs))
    expected = [
        sum(x != y for x, y in zip(words[i], words[j])) == 1
        if len(words[i]) == len(words[j])
        else any(words[j][:k] + words[j][k + 1 :] == words[i] for k in range(len(words[j])))
        for i, j in pairs
    ]
    assert spelling.one_edit(letters, a, b).tolist() == expected


# 12
def tokens(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))


def contaminated(docs, items, window=10):
    windows = defaultdict(set)
    for name, text in items:
        words = tokens(text)
        size = min(window, len(words))
        for s in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[s : s + size])].add(name)
    out = []
    for name, text, *_ in docs:
        words, hit, found = tokens(text), set(), set()
        for size in {len(w) for w in windows}:
            for s in range(len(words) - size + 1):
                if (names := windows.get(tuple(words[s : s + size]))) is not None:
                    hit.update(range(s, s + size))
                    found |= names
        listed = sorted(str(n) for n in found if n is not None)
        out.append((name, len(words), len(hit), listed))
    return sorted(out, key=repr)


PHRASE = "the quick brown fox jumps over the lazy dog and runs away from the quick brown hound"
ITEMS = [
    (1, PHRASE),
    (2, PHRASE.upper()),
    (2, "short item"),
    (11, "a a a a a a a a a a a a"),
    (3, "ünï-cödé 漢字 words here"),
    (4, ""),
    (5, None),
    (None, "nameless item words"),
    (6, "never seen anywhere at all"),
]
LEAKS = [
    (1, f"Before {PHRASE} after", "en", "a"),
    (2, "quick brown fox jumps over the lazy dog and runs; quick brown fox", "en", "a"),
    (3, "fox jumps over the lazy dog and runs away from the quick", "en", "a"),
    (4, "Short-item; short item. short  items short", "en", "a"),
    (5, "a " * 30, "en", "a"),
    (6, "ÜNÏ cödé ünï cödé 漢字 Words HERE", "en", "a"),
    (7, "a nameless item words b", "en", "a"),
    (8, None, None, None),
    (9, "", "en", "a"),
    (10, " ".join(["filler"] * 20_000 + PHRASE.split() + ["filler"] * 20_000), "en", "a"),
    (1, "another text of the same id with a short item", "en", "a"),
    (None, PHRASE, "en", "a"),
    (None, PHRASE, "en", "a"),
]


def test_contamination_matches_plain_python(spark):
    docs = LEAKS + given(spark)
    items = ITEMS + [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    bench = spark.createDataFrame([(*i, "p", 0) for i in items], "item_id long, text string, phrase string, row int")
    found = positional_index.contamination(frame(spark, docs), bench, Tables(spark))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == contaminated(docs, items)


def test_contamination_of_empty_tables(spark):
    docs, bench = frame(spark, LEAKS), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = positional_index.contamination(docs, bench.where("false"), Tables(spark)).collect()
    assert len(found) == len(LEAKS) and not any(r.n_hit or r["items"] for r in found)
    assert positional_index.contamination(docs.where("false"), bench, Tables(spark)).count() == 0


def test_proximity_matches(spark):
    items = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "beta")], "item_id long, text string")
    texts = ["alpha beta gamma delta", "alpha x beta gamma delta", "delta x y z alpha w v u beta gamma", "gamma beta alpha delta x", "beta"]
    tables = Tables(spark)
    docs = frame(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])
    named, places = positional_index.item_phrases(items, tables)
    index = positional_index.build_index(docs, places, tables)

    def found(slop):
        near = positional_index.proximity_matches(index, places, slop, tables, window=4)
        return {(r.item_id, r.doc_id) for r in near.join(index.rows, "row").join(named, "phrase").collect()}

    words = {(2, i) for i in range(5)}
    assert found(0) == words | {(1, 0)}
    assert found(1) == words | {(1, 0), (1, 1)}
    assert found(3) == words | {(1, 0), (1, 1)}
    assert found(4) == words | {(1, 0), (1, 1), (1, 3)}


# 13
def diverged(docs, least=30, top=50):
    counts, seen = defaultdict(Counter), defaultdict(Counter)
    for _, text, lang, source in docs:
        words = re.findall("[^\x00-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
        counts[lang or "", source or ""].update(words)
        seen[lang or ""].update(set(words))
    rows = []
    for lang in seen:
        kept = [t for t, n in seen[lang].items() if n >= least]
        v, own = len(kept), sorted(s for at, s in counts if at == lang)

        def shares(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 10**9 * (count[t] + 5) // (total + 5 * v) for t in kept}

        q = shares(sum((counts[lang, s] for s in own), Counter()))
        p = {s: shares(counts[lang, s]) for s in own}
        for s in own:
            pairs = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in own if o != s]
            over = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", over, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                rows += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:most], 1)]
    return sorted(rows)


def audited(spark, docs, **options):
    found = divergence.audit(frame(spark, docs), Tables(spark), **options)
    return sorted(tuple(r) for r in found.select("lang", "source", "part", "item", "value", "rank").collect())


ODD_SOURCES = [
    (1, None, None, None),
    (2, "", "en", "silent"),
    (3, "alpha beta gamma", "xx", "a"),
    (4, "alpha beta gamma", "xx", "b"),
    (4, "alpha beta gamma", "xx", "b"),
    (5, "Ünï漢 Alpha9beta " * 3000, "en", "src1"),
    (6, "the", None, "src1"),
]


@pytest.mark.parametrize("least", [2, 30])
def test_divergence_matches_plain_python(spark, least, monkeypatch):
    monkeypatch.setattr(divergence, "PACKET", 3)  # many packets and blocks on a small table
    monkeypatch.setattr(divergence, "BLOCK_BITS", 4)
    docs = given(spark) + ODD_SOURCES
    assert audited(spark, docs, least_docs=least) == diverged(docs, least)


def test_divergence_of_an_empty_table(spark):
    assert divergence.audit(frame(spark, ODD_SOURCES).where("false"), Tables(spark)).count() == 0


def test_gallop_and_pair_value():
    rng = np.random.default_rng(1)
    for small, large in ((0, 50), (3, 5000), (900, 1000), (200, 20_000), (50, 0)):
        a, b = (np.sort(rng.choice(30_000, n, replace=False)) for n in (small, large))
        assert divergence.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()
        p, q = dict(zip(a.tolist(), range(5, 5 + small))), dict(zip(b.tolist(), range(9, 9 + large)))
        union = p.keys() | q.keys()
        value = sum(abs(p.get(t, 3) - q.get(t, 7)) for t in union)
        args = (a, np.array(list(p.values()), dtype=np.int64), 3, b, np.array(list(q.values()), dtype=np.int64), 7)
        assert divergence.pair_value(*args) == (value, len(union))


# the queries over whole tables
def test_queries_match_plain_python(spark):
    docs = given(spark)
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    assert variants(queries.op11_spelling_variants(spark, DATA)) == spelled(docs)
    found = {r.doc_id: tuple(r)[1:] for r in queries.op12_decontamination(spark, DATA).collect()}
    for name, n_words, n_hit, listed in contaminated(docs, items):
        digest = hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert found[name] == (n_words, n_hit, len(listed), digest, n_hit > 0)
    assert sorted(tuple(r) for r in queries.op13_source_divergence(spark, DATA).collect()) == diverged(docs)

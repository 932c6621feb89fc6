"""Operators against brute force on small tables, and their defined results on odd rows."""

import hashlib
import zlib
from collections import Counter, defaultdict, deque

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from tradeloom.llm import jaccard_join, lattice, packing, passages, pieces, quality, queries, toxicity, urls, vector_graph, winnow
from tradeloom.llm.blocks import Words
from tradeloom.llm.components import components
from tradeloom.llm.store import Tables

DATA = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label int, node long, host string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def words(n, seed, names="abcdefgh"):
    rng = np.random.default_rng(seed)
    return ["".join(rng.choice(list(names), 5)) for _ in range(n)]


LONG = words(300, 1)
NEAR = [*LONG[:150], "changed", *LONG[151:]]
PASSAGE = words(70, 2)
ODD = [  # NULLs, empty and very long texts, ties, repeated rows; the extra columns have clashing names
    (1, " ".join(LONG), "en", "a", 5, 1, 1, "h"),
    (2, " ".join(NEAR), "en", "a", 5, 1, 1, "h"),
    (3, " ".join(LONG), None, None, None, None, None, None),
    (4, None, "en", "a", 0, 1, 1, "h"),
    (5, "", "en", "a", 0, 1, 1, "h"),
    (6, " ".join([*words(60, 3), *PASSAGE, *words(60, 4)]), "de", "b", 5, 1, 1, "h"),
    (7, " ".join([*words(90, 5), *PASSAGE, *words(20, 6)]), "de", "b", 5, 1, 1, "h"),
    (8, " ".join(words(20_000, 7)), "de", "b", 5, 1, 1, "h"),
    (9, "x", "fr", "b", 1, 1, 1, "h"),
    (9, "x", "fr", "b", 1, 1, 1, "h"),
    (None, "  two   spaces\n and\t▁mark ﬁ <|endoftext|> ünïcode 漢字 don't ", "fr", "c", 1, 1, 1, "h"),
]


@pytest.fixture(scope="module")
def docs(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    return spark.createDataFrame(ODD, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(docs):
    return docs.where("false")


@pytest.fixture(scope="module")
def given_docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}


def test_shingles_match_word_tuples():
    texts = ["A b c d e f", "", "x", "a B c d e F", " \t", "a b c d e g"]
    hashes, bounds = Words(texts).shingles()
    assert np.diff(bounds).tolist() == [2, 0, 1, 2, 0, 2]
    assert hashes[0] == hashes[3] == hashes[5] and hashes[1] == hashes[4] != hashes[6]


def test_components_match_union_find(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(i, i + 1) for i in range(1000, 1040)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    found = components(spark.createDataFrame([*edges, (None, 5)], "a long, b long"), Tables(spark)).collect()
    assert {r.node: r.component for r in found} == {x: root(x) for x in linked}


# 1
def test_compact_windows_cover_each_sequence_once():
    rng = np.random.default_rng(3)
    hashes = rng.permutation(200).astype(np.uint64)
    bounds = np.array([0, 120, 120, 200])
    text, left, centre, right = passages.compact_windows(hashes, bounds, 10)
    for t in range(3):
        own = hashes[bounds[t] : bounds[t + 1]]
        for i in range(len(own)):
            for j in range(i + 9, len(own)):
                hits = (text == t) & (left <= i) & (i <= centre) & (centre <= j) & (j <= right)
                assert hits.sum() == 1 and own[centre[hits][0]] == own[i : j + 1].min()


def test_passages(spark, docs, none):
    found = {(r.doc_id, r.source_id): r.passages for r in passages.repeated_passages(docs, Tables(spark)).collect()}
    assert set(found) == {(2, 1), (3, 1), (7, 6)}
    assert [(p["from"], p["to"]) for p in found[7, 6]] == [(90, 160)]
    classes = {r.doc_id: r.class_id for r in passages.passage_classes(docs, Tables(spark)).collect()}
    assert classes == {1: 1, 2: 1, 3: 1, 4: 4, 5: 5, 6: 6, 7: 6, 8: 8, 9: 9, None: None}
    kept = passages.remove_passages(docs, Tables(spark))
    left = {r.doc_id: r.text for r in kept.collect()}
    before = {r[0]: r[1] for r in ODD}
    assert kept.columns == docs.columns and 3 not in left and 2 not in left
    assert left[7].split() == [*words(90, 5), *words(20, 6)]
    assert all(left[i] == before[i] for i in (1, 4, 5, 6, 8, 9, None))
    assert passages.passage_classes(none, Tables(spark)).count() == passages.remove_passages(none, Tables(spark)).count() == 0


def test_rows_that_repeat_an_id_lose_only_their_own_passages(spark):
    clean, short = words(300, 31), "only a few words"
    rows = [
        (1, " ".join([*words(40, 32), *PASSAGE, *words(40, 33)])),
        (2, " ".join([*words(10, 34), *PASSAGE])),
        (2, " ".join(clean)),
        (2, short),
        (2, None),
        (None, " ".join([*PASSAGE, *words(5, 35)])),
        (None, short),
    ]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    left = sorted((tuple(r) for r in passages.remove_passages(given, Tables(spark)).collect()), key=repr)
    expected = [rows[0], (2, " ".join(words(10, 34)) + " "), *rows[2:5], (None, " " + " ".join(words(5, 35))), rows[6]]
    assert left == sorted(expected, key=repr)


def test_texts_with_many_askers_are_sent_in_sheets(spark, monkeypatch):
    rows = [(i, " ".join([*PASSAGE, *words(60, 100 + i)])) for i in range(12)]
    given = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(map(tuple, passages.passage_classes(given, Tables(spark)).select("doc_id", "class_id").collect()))
    monkeypatch.setattr(passages, "ASKERS", 3)
    parts = sorted(map(tuple, passages.passage_classes(given, Tables(spark)).select("doc_id", "class_id").collect()))
    assert whole == parts == [(i, 0) for i in range(12)]


def test_passages_span_insertions():
    for n, extra in ((80, 7), (90, 10), (98, 14), (400, 60)):
        plain = words(n, 200 + n)
        longer = [*plain[: n // 2], *words(extra, 300 + n), *plain[n // 2 :]]
        sides = [[*words(30, i), *body, *words(30, i + 1)] for i, body in ((11, plain), (13, longer))]
        shingles, bounds = Words([" ".join(s) for s in sides]).shingles()
        x, y = shingles[: bounds[1]], shingles[bounds[1] :]
        for later, first, size in ((y, x, n + extra), (x, y, n)):
            found = passages.passages_of(later, first)
            assert [(p, q + 4) for p, q, _ in found] == [(30, 30 + size)]
            assert found[0][2] == pytest.approx((n - 8) / (n + extra), abs=1e-9)  # four shingles are cut on the plain side


def test_no_anchor_hides_later_copies(spark):
    rows = []
    for k in range(40):
        shared = words(80, 1000 + k)
        version = [f"edit{i}" if i % 20 == 10 else w for i, w in enumerate(shared)]  # similarity under 0.8
        line = [*words(50, 2000 + k), *shared[:30], *words(50, 3000 + k)]  # a line of under 50 words
        bodies = [version, line, [*words(40, 4000 + k), *shared], [*words(60, 5000 + k), *shared, *words(9, 6000 + k)]]
        edited = [*shared[:40], "one", "word", "more", *shared[40:]]
        rows += [(10 * k + i, " ".join(body)) for i, body in enumerate([*bodies, [*words(30, 7000 + k), *edited]])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = defaultdict(set)
    for r in passages.repeated_passages(docs, Tables(spark)).collect():
        found[r.doc_id].update((r.source_id, p["from"], p["to"]) for p in r.passages)
    for k in range(40):
        assert (10 * k + 2, 60, 140) in found[10 * k + 3], k
        assert min(p for _, p, _ in found[10 * k + 4]) == 30 and max(q for _, _, q in found[10 * k + 4]) == 113, k
        assert not found[10 * k] and not found[10 * k + 1] and not found[10 * k + 2]


def test_links_between_unlike_sources_are_kept(spark):
    rows, expected = [], {}
    for k in range(40):
        shared = words(56, 100_000 + k)
        first, second = ([f"edit{k}" if i == at else w for i, w in enumerate(shared)] for at in (18, 38))
        # Each version is alike to the whole (47 of 57 shingles), but not to the other one (42 of 62).
        for i, body in enumerate((first, second, shared)):
            rows.append((10 * k + i, " ".join([*words(60, 110_000 + 10 * k + i), *body, *words(60, 120_000 + 10 * k + i)])))
            expected[10 * k + i] = 10 * k
    for k in range(100, 110):
        line = words(15, 130_000 + k)  # one line is alike by 11 of 15 shingles to the same line again and again
        for i, times in enumerate((1, 4, 4)):
            rows.append((10 * k + i, " ".join([*words(60, 140_000 + 10 * k + i), *line * times, *words(60, 150_000 + 10 * k + i)])))
            expected[10 * k + i] = 10 * k + min(i, 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in passages.passage_classes(docs, Tables(spark)).collect()}
    lost = {d: (c, expected[d]) for d, c in found.items() if c != expected[d]}
    assert not lost


def test_recall_of_edited_passages(spark):
    rows, pairs = [], 400
    for k in range(pairs):
        first = words(100, 20_000 + k)
        later = [f"edit{i}" if i in (33, 66) else w for i, w in enumerate(first)]  # similarity 86 / 106
        rows.append((2 * k, " ".join([*words(40, 30_000 + k), *first, *words(40, 40_000 + k)])))
        rows.append((2 * k + 1, " ".join([*words(40, 50_000 + k), *later, *words(40, 60_000 + k)])))
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r.doc_id: (r.source_id, r.passages) for r in passages.repeated_passages(table, Tables(spark)).collect()}
    assert all(d % 2 and s == d - 1 for d, (s, _) in found.items())
    whole = sum(any(p["to"] - p["from"] >= 90 for p in own) for _, own in found.values())
    print("found", len(found), "whole", whole, "of", pairs)
    assert whole >= 0.99 * pairs


# 2
def test_passages_do_not_depend_on_blocks(spark, monkeypatch):
    shared = words(80, 41)
    texts = [" ".join([*words(40 + i, 50 + i), *shared, *words(30, 70 + i)]) for i in range(6)]
    rows = [*enumerate(texts), (3, texts[3]), (4, " ".join(words(90, 99)))]  # an id with equal, one with unlike rows
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)

    def found():
        out = passages.repeated_passages(docs, Tables(spark)).select("doc_id", "source_id", F.inline("passages"))
        return {(r.doc_id, r.source_id, r["from"], r.to) for r in out.collect()}

    whole = found()
    assert whole == {(i, 0, 40 + i, 120 + i) for i in range(1, 6)}
    monkeypatch.setattr(passages, "WINDOW_BYTES", 1)  # each text a block
    assert found() == whole


def test_url_rules_and_trees(spark):
    rows = [(i, f"http://s{i % 7}.example.{('net', 'com', 'org')[i % 3]}/{('en', 'de', 'fr')[i // 3 % 3]}/{i}?a=1#x", 1) for i in range(90)]
    rows += [(200, None, 1), (201, "", 1), (202, "no scheme", 1), (203, "HTTP://A.Example.NET", 1), (203, "HTTP://A.Example.NET", 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host int")
    found = urls.judge_urls(pages, queries.RULES, Tables(spark)).collect()
    assert len(found) == 95
    for r in found:
        if r.page_id < 90:
            i = r.page_id
            tld, lang = ("net", "com", "org")[i % 3], ("en", "de", "fr")[i // 3 % 3]
            assert (r.host, r.path) == (f"s{i % 7}.example.{tld}", f"/{lang}/{i}")
            rule = {("net", "en"): "example.net/en/", ("com", "de"): "example.com/de/", ("org", "fr"): "org/fr/"}.get((tld, lang))
            rule = rule or ("net/" if tld == "net" else None)
            assert r.rule == rule
            if rule:
                assert r.verdict == ("block" if rule in ("net/", "example.com/de/") else "allow")
    odd = {r.page_id: (r.host, r.path, r.rule) for r in found if r.page_id >= 200}
    assert odd[200] == odd[201] == odd[202] == ("", "", None) and odd[203] == ("a.example.net", "", None)
    label = F.length("url") > 40
    longer = spark.createDataFrame([(i, "http://a.org/" + "x" * (i % 60)) for i in range(400)], "page_id long, url string")
    learned = urls.judge_urls(longer, [], Tables(spark), label).collect()
    assert np.mean([(r.verdict == "block") == (13 + r.page_id % 60 > 40) for r in learned]) > 0.97
    assert urls.judge_urls(pages.where("false"), queries.RULES, Tables(spark)).count() == 0


# 3
@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=25))
def test_packing_plan_is_a_packing(counts):
    rows = packing.plan_packing(counts, 64)
    filled = defaultdict(list)
    for length in counts:
        ranks = sorted((a, b) for n, a, b, _, _ in rows if n == length)
        assert [a for a, _ in ranks] == [0, *[b for _, b in ranks[:-1]]] and ranks[-1][1] == counts[length]
    for length, a, b, sequence, offset in rows:
        for k in range(b - a):
            filled[sequence + k].append((offset, length))
    for own in filled.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) <= 64
    total = sum(n * c for n, c in counts.items())
    # Two items above a third at most share a sequence; the largest with the smallest, if they fit, is best for these.
    large = deque(sorted(n for n, c in counts.items() for _ in range(c) if 3 * n > 64))
    paired = 0
    while large:
        paired += 1
        if large and large[0] + large.pop() <= 64 and large:
            large.popleft()
    least = max(-(-total // 64), paired)
    assert len(filled) <= 11 / 9 * least + 1 or len(filled) - least <= 4


def test_packed_documents(spark, docs, none):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    found = queries.packed_rows(docs).collect()
    by_doc, filled = defaultdict(list), defaultdict(list)
    for r in found:
        by_doc[r.doc_id].append(r)
        filled[r.sequence_id].append((r.offset, r.length))
    for doc_id, text in {r[0]: r[1] for r in ODD}.items():
        ids = lib.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_doc[doc_id], key=lambda r: r.piece)
        if doc_id == 9:
            own = own[:1]
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
        assert sum(r.length for r in own) == len(ids) and all(r.length == 1024 for r in own[1:])
        for r in own:
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert len(by_doc[9]) == 2
    for own in filled.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *[n for _, n in own]])[:-1].tolist() and sum(n for _, n in own) <= 1024
    assert queries.packed_rows(none).count() == 0


# 4
@settings(max_examples=80, deadline=None)
@given(st.text("ab", max_size=60), st.integers(1, 6), st.integers(1, 9))
def test_winnowing_matches_its_definition(text, gram, window):
    places, hashes = winnow.fingerprint(text, gram, window)
    assert len(places) == len(hashes) and (len(text) == 0) == (len(places) == 0)
    k = min(gram, len(text))
    names = {}
    grams = [text[i : i + k] for i in range(len(text) - k + 1)] if text else []
    single = [winnow.fingerprint(g, k, 1)[1][0] for g in grams]
    for g, h in zip(grams, single):
        assert names.setdefault(g, h) == h
    kept = set()
    for i in range(max(1, len(single) - window + 1) if single else 0):
        own = single[i : i + window]
        kept.add(i + max(j for j, h in enumerate(own) if h == min(own)))
    assert places.tolist() == sorted(kept) and hashes.tolist() == [single[p] for p in sorted(kept)]


def test_following_documents(spark, docs, none, given_docs):
    found = {r.doc_id: r for r in winnow.with_following(spark.read.parquet(f"{DATA}/documents.parquet")).collect()}
    order = sorted(given_docs, reverse=True)
    for i, doc_id in enumerate(order):
        text, after = given_docs[doc_id].text or "", given_docs[order[(i + 1) % len(order)]].text or ""
        changed = winnow.edited(text, after)
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert r.near_next == winnow.likeness(winnow.fingerprint(text)[1], winnow.fingerprint(after)[1])
        assert r.edited_fingerprint == winnow.packed(*winnow.fingerprint(changed)) and 0 <= r.near_edited <= 1
    odd = winnow.with_following(docs).collect()
    assert len(odd) == len(ODD) and {r.doc_id: r.fingerprint for r in odd}[1] == {r.doc_id: r.fingerprint for r in odd}[3]
    assert {r.doc_id: r.n_chars for r in odd}[4] == 0 and winnow.with_following(none).count() == 0


# 5 and 10
def events(grammar, text):
    return [[(*event, token) for event, token in found] for _, found in grammar.clauses(text)]


def all_paths(machine, clause):
    """Weight and written symbols of every accepted path, by trying all of them."""
    paths = [(machine.start, 0.0, ())]
    for _, readings in clause:
        paths = [
            (to, weight + own + more, (*written, out))
            for state, weight, written in paths
            for symbol, own in readings.items()
            for out, more, to in machine.arcs.get((state, symbol), ())
        ]
    return [(weight, written) for state, weight, written in paths if state in machine.finals]


def test_clauses_against_all_paths():
    rng = np.random.default_rng(8)
    weights = {event: float(w) for event, w in zip(toxicity.EVENTS, rng.normal(size=len(toxicity.EVENTS)))}
    grammar = toxicity.Grammar({"fool": 1.5, "clown": 0.7}, {}, weights, None)
    names = ["fool", "clown", "kill", "beat", "you", "him", "not", "said", "will", "tree"]
    steps = [
        toxicity._insults(),
        toxicity._threats(),
        toxicity._targets(),
        toxicity._after(toxicity.NEGATION, "negated"),
        toxicity._after(toxicity.REPORT, "reported"),
        toxicity._weighing(weights),
    ]
    for _ in range(400):
        clause = [(t, grammar.readings(t)[1]) for t in rng.choice(names, rng.integers(1, 7))]
        paths = all_paths(grammar.machine, clause)
        weight, found = grammar.machine.best_path(clause, toxicity.WRITTEN)
        assert weight == pytest.approx(max(w for w, _ in paths))
        # One transducer after the other, each on all that the one before wrote.
        chained = dict(readings_of(clause))
        for step in steps:
            after = {}
            for symbols, w in chained.items():
                for more, written in all_paths(step, [(None, {s: 0.0}) for s in symbols]):
                    after[written] = max(w + more, after.get(written, -np.inf))
            chained = after
        assert weight == pytest.approx(max(chained.values()))
        assert any(v == pytest.approx(weight) and [s for s in k if s in toxicity.WRITTEN] == [e for e, _ in found] for k, v in chained.items())


def readings_of(clause):
    sequences = [((), 0.0)]
    for _, readings in clause:
        sequences = [((*s, symbol), w + own) for s, w in sequences for symbol, own in readings.items()]
    return sequences


def test_clause_patterns():
    grammar = toxicity.Grammar({"fool": 3.0}, {"zork": 2.0}, toxicity.event_weights({}, 0.1), None)
    weight = lambda text: sum(w for w, _ in grammar.clauses(text))
    assert weight("you are a fool") == 3 and weight("a zorkling") == 2
    assert 0 < weight("you are certainly, after all that was tried here, not a fool") < 3
    assert 0 < weight("she said that you are a fool") < 3
    assert weight("you fool and fool") == 6 and weight("they should burn you") > 0
    assert not grammar.clauses("burn the wood") and not grammar.clauses("not zorked") and not grammar.clauses("")
    assert not grammar.clauses("kill time. you") and len(grammar.clauses("fool\nfool")) == 2


def test_toxicity_grammar(spark, docs, none):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(600):
        body = words(40, 100 + i)
        bad = i % 4 == 0
        for place in rng.choice(40, 3, replace=False) if bad else []:
            body[place] = rng.choice(["fool", "zorkish", "zorkly"])
        rows.append((i, " ".join(body), int(bad)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    grammar = toxicity.learn_grammar(table.drop("toxic"), table.select("doc_id", "toxic"), ~queries.held_out("doc_id", 5))
    scored = {r.doc_id: r for r in toxicity.score_toxicity(table, grammar, ["doc_id"]).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert np.mean([(scored[i].score >= 0.5) == bool(y) for i, _, y in held]) > 0.97
    far = " ".join(["so"] * 5_000)
    assert events(grammar, f"you fool. fool {far} you! he said fool; fool") == [
        [("insult", "aimed", "fool")],
        [("insult", "aimed", "fool")],
        [("insult", "reported", "fool")],
        [("insult", "plain", "fool")],
    ]
    assert events(grammar, "I want to kill you. kill time. you fool but they will beat him") == [
        [("menace", "aimed", "kill")],
        [("insult", "aimed", "fool")],
        [("vow", "aimed", "beat")],
    ]
    odd = toxicity.score_toxicity(docs, grammar, ["doc_id", "label"]).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.score_toxicity(none, grammar, ["doc_id"]).count() == 0
    blank = toxicity.learn_grammar(none, table.select("doc_id", "toxic").where("false"), F.lit(True))
    assert toxicity.score_toxicity(docs, blank, ["doc_id"]).count() == len(ODD)


def test_quality_posteriors(spark, docs, none):
    rows = [("big", "x", 0.9)] * 2000 + [("bad", "x", 0.1)] * 2000 + [("few", "x", 0.1)] + [("big", "y", 0.2)] * 500
    found = quality.site_posteriors(spark.createDataFrame(rows, "host string, path string, p double"), 0.5)
    rate = {(r.host, r.path): (r.host_rate, r.path_rate) for r in found.collect()}
    assert rate["bad", "x"][1] < 0.15 and rate["big", "x"][1] > 0.85 and rate["big", "y"][1] < 0.3
    assert rate["bad", "x"][0] < rate["few", "x"][0] < 0.5  # a sparse site stays near the prior
    good = [(i, " ".join(words(50, i)) + ".", 1) for i in range(100)]
    junk = [(1000 + i, "### $$$ %%% " * 20, 0) for i in range(100)]
    table = spark.createDataFrame(good + junk, "doc_id long, text string, quality int")
    model = quality.learn_classifier(table.drop("quality"), table.select("doc_id", "quality"), F.lit(True))
    judged = quality.score_quality(table, model, ["doc_id", "quality"], F.lit("h"), F.lit("p"), Tables(spark))
    assert [c for c in judged.columns] == ["doc_id", "quality", "doc_score", "host_rate", "path_rate", "quality", "good"]
    kept = quality.score_quality(table, model, ["doc_id"], F.lit("h"), F.lit("p"), Tables(spark)).collect()
    assert all(r.good == (r.doc_id < 1000) for r in kept)
    odd = quality.score_quality(docs, model, docs.columns, F.col("source"), F.col("lang"), Tables(spark))
    assert odd.count() == len(ODD) and odd.select(*docs.columns[:2]).where("doc_id = 4").first()[1] is None
    assert quality.score_quality(none, model, ["doc_id"], F.col("source"), F.col("lang"), Tables(spark)).count() == 0


# 6
def test_vector_graph(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(400, 16))
    near = base[:40].repeat(3, axis=0) + rng.normal(size=(120, 16)) * 0.1
    rows = [(i, [float(v) for v in x], 1) for i, x in enumerate(np.vstack([base, near]))]
    rows += [(900, rows[0][1], 1), (901, None, 1), (902, [0.0] * 16, 1), (903, [None, *[1.0] * 15], 1), (904, [float("nan")] * 16, 1)]
    rows += [(905, [1.0, 2.0], 1), (None, rows[1][1], 1), (906, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int")
    found = {r.id: r for r in vector_graph.near_classes(table, Tables(spark)).collect()}
    x = np.array([r[1] for r in rows[:520]] + [rows[0][1], rows[1][1]], dtype=np.float32).astype(float)
    names = [*range(520), 900, None]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    exact = (x @ x.T >= 0.9).sum(axis=1) - 1
    assert all(found[n].n_links <= e for n, e in zip(names, exact))
    assert sum(found[n].n_links for n in names) >= 0.99 * exact.sum()
    assert found[900].class_id == 0 and found[None].class_id == 1
    assert all(found[i].n_links == 0 and found[i].class_id == i for i in (901, 902, 903, 904, 905, 906))
    result = vector_graph.near_classes(table, Tables(spark))
    assert vector_graph.audit_recall(table.where("vec_id < 520"), result.where("id > 1 AND id < 520"), 100) >= 0.9
    assert vector_graph.near_classes(table.where("false"), Tables(spark)).count() == 0


# 7
def test_lattice_sums_all_segmentations():
    names = ["▁", "▁a", "a", "b", "ab", "▁ab"]
    opens = np.array([p.startswith("▁") for p in names] + [False, False])
    model = lattice.Lattice(names, lattice.normalised(np.arange(1.0, 9.0)[None, :], opens))

    def brute(rest):
        if not rest:
            return 1.0
        total = sum(np.exp(model.log_p[0, i]) * brute(rest[len(p) :]) for i, p in enumerate(names) if rest.startswith(p))
        return total if rest[0] in "▁ab" else total + np.exp(model.log_p[0, -2]) * brute(rest[1:])

    tried = ["a", "ab", "aab", "abab", "xa", "x"]
    want = [np.log(brute("▁" + w)) + model.log_p[0, -1] for w in tried]
    assert np.allclose(model.score(tried)[0], want)
    uses = model.expected(["ab"], 0)
    assert np.isclose(uses[0] + uses[1] + uses[5], 1) and uses[-1] == 1


def test_document_scores(spark, docs, none):
    table = docs.withColumn("_held_out", queries.held_out("doc_id", 10))
    found = lattice.score_documents(table, PIECES, "_held_out", Tables(spark)).collect()
    assert len(found) == len(ODD)
    counts, size = Counter(), 0
    for r in ODD:
        if zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 10:
            own = (r[1] or "").encode().lower().split()
            counts.update([*own, b" "])
    size, distinct = sum(counts.values()), len(counts)
    for r in found:
        text = next(o[1] for o in ODD if o[0] == r.doc_id) or ""
        tokens = [*text.encode().lower().split(), b" "]
        base = sum(np.log10((counts[t] + 0.1) / (size + 0.1 * (distinct + 1))) for t in tokens)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), size)
        assert np.isclose(r.base_score, base) and np.isfinite(r.score) and r.score < 0
    empty = lattice.score_documents(none.withColumn("_held_out", F.lit(False)), PIECES, "_held_out", Tables(spark))
    assert empty.count() == 0


# 8
@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from(list(" ab▁\n\té漢ﬁ　\0.")), max_size=30))
def test_chunk_table_equals_the_library(text):
    table = test_chunk_table_equals_the_library.__dict__.setdefault("table", pieces.ChunkTable(PIECES))
    assert table.splits
    ids, decoded = table.encode([text, text + "x"])
    for own, back, whole in zip(ids, decoded, [text, text + "x"]):
        assert np.frombuffer(own, np.int32).tolist() == table.lib.encode(whole)
        assert back == table.lib.decode(table.lib.encode(whole))


def test_encoded_documents(spark, docs, none):
    found = pieces.encode_decode(docs, PIECES, ["doc_id"]).collect()
    assert len(found) == len(ODD)
    lib = pieces.ChunkTable(PIECES).lib
    texts = {r[0]: r[1] or "" for r in ODD}
    for r in found:
        ids = lib.encode(texts[r.doc_id])
        assert (list(r.ids), r.decoded) == (ids, lib.decode(ids))
    assert pieces.encode_decode(none, PIECES, ["doc_id"]).count() == 0


# 9
def test_jaccard_classes_match_brute_force(spark, docs, none, given_docs):
    table = spark.read.parquet(f"{DATA}/documents.parquet")
    found = {r.doc_id: r for r in jaccard_join.jaccard_classes(table, Tables(spark)).collect()}
    ids = sorted(given_docs)
    sets = dict(zip(ids, map(set, jaccard_join.shingle_sets([given_docs[i].text for i in ids]))))
    links = {i: [j for j in ids if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in ids}
    assert {i: found[i].n_links for i in ids} == {i: len(links[i]) for i in ids}
    odd = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_classes(docs, Tables(spark)).collect()}
    assert odd[1] == (1, 2) and odd[2] == (1, 2) and odd[3] == (1, 2) and odd[9] == (9, 1)
    assert odd[4] == (4, 0) and odd[5] == (5, 0) and odd[None] == (None, 0)
    assert jaccard_join.jaccard_classes(none, Tables(spark)).count() == 0


def test_dense_groups_are_counted_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "SMALL", 6)
    monkeypatch.setattr(jaccard_join, "BLOCK", 10)
    rows = []
    for i in range(60):  # near copies: each changes one word of its own
        body = list(LONG)
        body[i * 4] = f"edit{i}"
        rows.append((i, " ".join(body)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_join.jaccard_classes(table, Tables(spark)).collect()
    assert {(r.class_id, r.n_links) for r in found} == {(0, 59)}


def test_a_node_that_comes_twice_counts_once():
    columns = ["bucket", "first", "second", "block", "node", "copies", "size", "tokens", "buckets"]
    rows = [dict(zip(columns, (7, 0, 0, 0, n, 1, 5, [1, 2, 3, 4, 5], [7]))) for n in (1, 2, 2)]
    out = jaccard_join.compare(pa.Table.from_pylist(rows)).to_pylist()
    assert [(r["node"], r["links"], r["root"]) for r in out] == [(1, 1, 1), (2, 1, 1)]


def test_pipeline(spark, docs, none, given_docs):
    kept = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, tables = kept.columns, Tables(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = tables.put(stage(spark, kept, DATA))
        assert after.columns == columns and 0 < after.count() <= kept.count(), name
        assert stage(spark, kept.where("false"), DATA).count() == 0
        kept = after
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, DATA)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in kept.select("doc_id").collect()}
    assert corpus_pipeline.jaccard_stage(spark, docs, DATA).select("doc_id").distinct().count() == 8


def test_jaccard_stage_keeps_one_row_of_each_group(spark):
    a, b, c, d = (" ".join(words(60, 80_000 + i)) for i in range(4))
    rows = [(7, a), (7, a), (7, a), (None, a), (None, b), (None, b), (1, c), (5, c), (5, d), (8, ""), (8, ""), (None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    left = [tuple(r) for r in corpus_pipeline.jaccard_stage(spark, table, DATA).collect()]
    assert Counter(left) == Counter([(7, a), (None, b), (1, c), (5, d), (8, ""), (8, ""), (None, None)])


def test_token_ids_agree_over_all_white_space():
    table = packing.UnitTable(
        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    blanks = " \t\n\r\x0b\x0c\x1c\x1f\x85\xa0\u1680\u2000\u2009\u2028\u202f\u205f\u3000\u200b"

    @settings(max_examples=1500, deadline=None)
    @given(st.text(st.sampled_from("   " + blanks + "ab'sZ9.é漢")))
    def check(text):
        ids = table.lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(table.encode(text), dtype="<u4").tolist() == ids

    for text in (" \xa0 \xa0", "a \xa0 \xa0 b", "a  b", " a", "a ", "a\n b", "a \nb", ""):
        assert np.frombuffer(table.encode(text), dtype="<u4").tolist() == table.lib.encode(text, add_special_tokens=False).ids
    check()


def test_judging_stages_keep_clashing_columns(spark):
    names = ["good", "quality", "doc_score", "host_rate", "path_rate", "score", "matched", "host", "_0", "_others", "evidence"]
    given = spark.read.parquet(f"{DATA}/documents.parquet")
    extra = given.select("*", *[F.lit(i).alias(c) for i, c in enumerate(names)])
    for stage in (corpus_pipeline.quality_stage, corpus_pipeline.toxicity_stage):
        plain, kept = (stage(spark, d, DATA) for d in (given, extra))
        assert kept.columns == extra.columns
        assert sorted(r.doc_id for r in plain.collect()) == sorted(r.doc_id for r in kept.collect())
        assert kept.select(*names).distinct().collect() == [tuple(range(len(names)))]


def test_vectors_of_doubles(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(6, 16))
    rows = [(i, (base[i % 6] + 0.01 * rng.normal(size=16)).tolist()) for i in range(30)]
    given = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r.id: r.class_id for r in vector_graph.near_classes(given, Tables(spark)).collect()}
    assert found == {i: i % 6 for i in range(30)}


def test_parts_without_hope_hold_no_passage():
    chance = np.random.default_rng(5)
    said = Counter()
    for _ in range(3000):
        n = int(chance.integers(1, 130))
        b = chance.permutation(1000)[:n].astype(np.int32)
        a = b.copy()
        a[chance.random(n) < chance.choice([0.0, 0.1, 0.19, 0.22, 0.3])] = 5000
        if chance.random() < 0.3:
            a = np.roll(a, int(chance.integers(0, 40)))
        found = bool(passages.passages_of(b, a))
        hope = bool(passages.hopeful(np.isin(b, a)[None, :])[0])
        assert hope or not found
        said[hope, found] += 1
    assert said[True, True] > 500 and said[False, False] > 500


def test_texts_without_repeats_are_compared_alike():
    rng = np.random.default_rng(11)
    kinds = set()
    for k in range(600):
        size = int(rng.integers(46, 280))
        a = rng.choice(1 << 40, size, replace=False).astype(np.uint64)
        b = a.copy()
        for place in rng.integers(0, size, int(rng.integers(0, 2 + size // 12))):  # an edited word changes 5 shingles
            b[place : place + 5] = rng.choice(1 << 40, len(b[place : place + 5]), replace=False) + (1 << 41)
        if k % 3 == 0:
            b = np.roll(b, int(rng.integers(0, size)))
        elif k % 3 == 1:
            start = int(rng.integers(0, size))
            b = np.concatenate([b[:start], rng.choice(1 << 40, int(rng.integers(1, 60)), replace=False).astype(np.uint64) + (1 << 42), b[start:]])
        general = passages.passages_of(b, np.concatenate([a, np.full(2, 7 << 50, np.uint64)]))  # a repeat that b has not
        hits = np.flatnonzero(np.isin(b, a))
        where = {int(x): i for i, x in enumerate(a)}
        single = passages.single_passages(hits, np.array([where[int(x)] for x in b[hits]], np.int64))
        assert single == passages.passages_of(b, a) == general
        kinds.add((k % 3, len(single)))
    assert {(0, 0), (0, 1), (0, 2), (1, 0), (1, 1), (1, 2), (2, 0), (2, 1)} <= kinds


def test_no_passage_over_a_place_is_passed_over():
    chance = np.random.default_rng(17)
    said = Counter()
    for k in range(3000):
        n = int(chance.integers(40, 277))
        b = chance.permutation(1000)[:n].astype(np.int32)
        if k % 4 == 3:  # lines repeat
            b = b[np.sort(chance.integers(0, max(2, n // 8), n))]
        a = b.copy()
        for place in chance.integers(0, n, int(chance.integers(0, 2 + n // 14))):
            a[place : place + 5] = 5000 + place
        if k % 3 == 0:
            a = np.roll(a, int(chance.integers(0, 60)))
        elif k % 3 == 1:
            a = np.delete(a, slice(*np.sort(chance.integers(0, n, 2))))
        at = int(chance.integers(0, n))
        over = any(p <= at + passages.THIN and q + 4 >= at for p, q, _ in passages.passages_of(b, a))
        values, first = np.unique(a, return_index=True)
        number = np.minimum(np.searchsorted(values, b), max(0, len(values) - 1))
        there = np.where(values[number] == b, first[number], -1)[None, :] if len(a) else np.full((1, n), -1)
        kept = bool(passages.close_over(there >= 0, np.array([at]))[0])
        if len(values) == len(a) and len(np.unique(b)) == n:
            kept &= bool(passages.alike_over(there, np.array([at]))[0])
        assert kept or not over
        said[kept, over, k % 4 == 3] += 1
    assert min(said[True, True, False], said[False, False, False], said[True, True, True]) > 100


def test_members_of_a_group_are_placed_and_counted_together():
    chance = np.random.default_rng(23)
    texts = [chance.integers(0, 60, int(chance.integers(1, 50))).astype(np.uint64) for _ in range(12)]
    group = np.repeat([0, 1, 2], [5, 3, 4])
    text = np.repeat(np.arange(12), [len(x) for x in texts])
    spot = np.concatenate([np.arange(len(x)) for x in texts])
    table, first, column, single = passages._places(np.concatenate(texts), text, spot, group)
    assert single.tolist() == [len(np.unique(x)) == len(x) for x in texts]
    for x in range(12):
        own = column[text == x]
        for y in np.flatnonzero((group == group[x]) & (np.arange(12) != x)):
            found = np.where(own >= 0, table[first[y] + own], -1).tolist()
            assert found == [int(np.flatnonzero(texts[y] == s)[0]) if s in texts[y] else -1 for s in texts[x]]
    here = text < 5
    asks, there = np.array([True, False, True, True, True]), np.array([True, True, False, True, True])
    both = passages._common(text[here & (column >= 0)], column[here & (column >= 0)], asks, there)
    for x, y in zip(*np.nonzero(asks[:, None] & there)):
        assert x == y or both[x, y] == np.isin(texts[x], texts[y]).sum()


def test_blocks_of_near_copies_do_not_all_meet(spark, monkeypatch):
    compare, block = passages._compare, 16
    base = words(150, 160_000)

    def sent(n):
        chance = np.random.default_rng(29)
        rows = []
        for i in range(n):
            edits = set(chance.integers(0, 150, 5).tolist())
            rows.append((i, " ".join(f"edit{i}at{p}" if p in edits else w for p, w in enumerate(base))))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        members = spark.sparkContext.accumulator(0)

        def counted(batches):
            for batch in batches:
                members.add(len(batch.column(0).flatten()))
                yield from compare(iter([batch]))

        monkeypatch.setattr(passages, "BLOCK", block)
        monkeypatch.setattr(passages, "_compare", counted)
        split = {r.doc_id: r.class_id for r in passages.passage_classes(docs, Tables(spark)).collect()}
        monkeypatch.setattr(passages, "BLOCK", 1000)
        monkeypatch.setattr(passages, "_compare", compare)
        whole = {r.doc_id: r.class_id for r in passages.passage_classes(docs, Tables(spark)).select("doc_id", "class_id").collect()}
        assert split == whole and len(set(split.values())) < n / 4
        return members.value

    few, many = sent(100), sent(300)
    print("members sent", few, many)
    assert few > 200 and many < 5 * few  # all blocks with all blocks: about nine times as many

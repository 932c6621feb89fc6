"""Operator 5: toxicity by a grammar of composed weighted transducers, scored by matched clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.blocks import map_texts, slices
from tradeloom.llm.logistic import Classifier, fit
from tradeloom.llm.transducers import Arcs, Transducer

LABEL_LIMIT = 40_000  # labelled texts that the grammar is learned from, in order of a hash of their ids
LEXICON_LIMIT = 5_000  # insult terminals kept, the strongest first
PURE = 9  # toxic texts of a terminal for each clean one
STEMS = (4, 5, 6, 7)  # letters of word stems tried besides whole words
CHANCE = 0.01  # accepted number of terminals that all labels of a chance word would give

THREAT_PRIOR = 2.0  # log odds of a threat before labels are read, worth PRIOR_TEXTS texts
PRIOR_TEXTS = 5
CONTEXT_PRIOR = {"plain": 0.0, "aimed": 0.0, "negated": -2.0, "reported": -1.0}  # log odds of a context before labels are read
CONTEXT_TEXTS = 20  # texts that the prior of an insult's context is worth

# Closed word classes of the grammar. Fixed values.
NEGATIONS = "not no never nobody nothing neither nor isn't aren't don't doesn't nicht kein keine nie niemals pas jamais aucun nunca jamás tampoco".split()
REPORTS = "said says say claimed claims wrote writes quoted quotes reported called calls sagte sagt schrieb behauptet dit disait écrit affirme dijo dice escribió afirma".split()
TARGETS = "you your you're yourself u he she they them him her du dich dir ihr euch sie er tu toi te vous il elle ils tú ti usted ustedes ella ellos".split()
THREATS = "kill hurt beat destroy burn shoot stab strangle murder töten umbringen verprügeln tuer frapper détruire matar golpear destruir quemar".split()
BREAKS = "but however because although aber doch weil obwohl mais parce quoique pero porque aunque".split()
FUTURES = "will gonna shall going werde werden wird vais va allons voy vamos".split()

TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?|[.!?;\n]")
OTHER, NEGATION, REPORT, TARGET, THREAT, FUTURE, INSULT, STOP = range(8)
CLOSED = {
    **dict.fromkeys(BREAKS, STOP),
    **dict.fromkeys(FUTURES, FUTURE),
    **dict.fromkeys(TARGETS, TARGET),
    **dict.fromkeys(NEGATIONS, NEGATION),
    **dict.fromkeys(REPORTS, REPORT),
    **dict.fromkeys(THREATS, THREAT),
}
KINDS = ("insult", "menace", "vow")  # a vow is a menace after a future word
CONTEXTS = ("plain", "aimed", "negated", "reported")
EVENTS = [(kind, context) for kind in KINDS for context in CONTEXTS]
WRITTEN = frozenset(EVENTS)


def _passing(states, symbols) -> Arcs:
    return {(state, symbol): [(symbol, 0.0, state)] for state in states for symbol in symbols}


def _insults() -> Transducer:
    """Writes an insult for an insult word; one state."""
    arcs = _passing([0], [OTHER, NEGATION, REPORT, TARGET, THREAT, FUTURE])
    arcs[0, INSULT] = [("insult", 0.0, 0)]
    return Transducer(0, arcs, [0])


def _threats() -> Transducer:
    """Writes a menace for a threat word that a target follows in the clause, a vow if a future word came before.

    After a written threat the clause must still bring its target: those states are not final.
    """
    calm, future, owed, owed_future = range(4)
    states = [calm, future, owed, owed_future]
    arcs = _passing(states, [OTHER, NEGATION, REPORT, "insult"])
    for free, owing, kind in ((calm, owed, "menace"), (future, owed_future, "vow")):
        arcs[free, TARGET] = [(TARGET, 0.0, free)]
        arcs[owing, TARGET] = [(TARGET, 0.0, free)]
        arcs[free, THREAT] = arcs[owing, THREAT] = [(kind, 0.0, owing)]
    arcs[calm, FUTURE] = arcs[future, FUTURE] = [(OTHER, 0.0, future)]
    arcs[owed, FUTURE] = arcs[owed_future, FUTURE] = [(OTHER, 0.0, owed_future)]
    return Transducer(calm, arcs, [calm, future])


def _targets() -> Transducer:
    """Tells events of a clause with a target, before or after them, from plain ones.

    Before the first target a path must say whether one comes: ``none`` may meet no target, ``owed`` must.
    """
    start, none, owed, met = "start", "none", "owed", "met"
    states = [start, none, owed, met]
    arcs = _passing(states, [OTHER, NEGATION, REPORT])
    for kind in KINDS:
        plain, aimed = (kind, "plain"), (kind, "aimed")
        arcs[start, kind] = [(plain, 0.0, none), (aimed, 0.0, owed)]
        arcs[none, kind] = [(plain, 0.0, none)]
        arcs[owed, kind] = [(aimed, 0.0, owed)]
        arcs[met, kind] = [(aimed, 0.0, met)]
    for state in (start, owed, met):
        arcs[state, TARGET] = [(OTHER, 0.0, met)]
    return Transducer(start, arcs, [start, none, met])


def _after(cue: int, context: str) -> Transducer:
    """Gives every event that follows the cue in its clause the context, and drops the cue."""
    arcs = _passing([0, 1], [OTHER, *({NEGATION, REPORT} - {cue})]) | _passing([0], EVENTS)
    arcs[0, cue] = arcs[1, cue] = [(OTHER, 0.0, 1)]
    for kind, old in EVENTS:
        arcs[1, (kind, old)] = [((kind, context), 0.0, 1)]
    return Transducer(0, arcs, [0, 1])


def _weighing(weights: dict[tuple[str, str], float]) -> Transducer:
    arcs = _passing([0], [OTHER])
    for event in EVENTS:
        arcs[0, event] = [(event, weights.get(event, 0.0), 0)]
    return Transducer(0, arcs, [0])


CLAUSE = _insults().then(_threats()).then(_targets()).then(_after(NEGATION, "negated")).then(_after(REPORT, "reported"))


class Grammar:
    """Word classes with weights, composed with the transducers of a clause.

    A clause ends at ``. ! ? ;``, a line's end or one of BREAKS. The lexical transducer reads each word as its classes
    (an insult with its learned weight) or, for a weight of nothing, as any other word. The transducers for insults,
    threats, targets, negation and reported speech are composed with it and with the learned weights of the
    events they write; the heaviest path of a clause is its match. A clause whose best reading has no event, for
    instance because negation costs more than the insult weighs, does not match. All of a clause is in
    reach of its cues, however long it is.
    """

    def __init__(self, words: dict[str, float], stems: dict[str, float], weights: dict[tuple[str, str], float], model: Classifier | None):
        self.words, self.stems, self.model = words, stems, model
        self.sizes = sorted({len(s) for s in stems})
        self.machine = CLAUSE.then(_weighing(weights)).numbered()
        self.cache: dict[str, tuple[bool, dict[int, float] | None]] = {}

    def weight(self, token: str) -> float:
        """Weight of a token as an insult; 0 for all others."""
        weight = self.words.get(token, 0.0)
        for size in self.sizes:
            weight = max(weight, self.stems.get(token[:size], 0.0) if len(token) >= size else 0.0)
        return weight

    def readings(self, token: str) -> tuple[bool, dict[int, float] | None]:
        """Whether a clause needs the token for a match, and its classes with weights (None ends the clause)."""
        found = self.cache.get(token)
        if found is None:
            kind = STOP if token in ".!?;\n" else CLOSED.get(token, OTHER)
            insult = self.weight(token)
            # A cue is always read as one; an insult or threat may also be left aside.
            read = {OTHER: 0.0} if kind in (OTHER, THREAT, STOP) else {}
            if kind not in (OTHER, STOP):
                read[kind] = 0.0
            if insult > 0:
                read[INSULT] = insult
            found = (insult > 0 or kind == THREAT, None if kind == STOP else read)
            if len(self.cache) > 300_000:
                self.cache.clear()
            self.cache[token] = found
        return found

    def clauses(self, text: str, weigh: Callable[[str], float] | None = None) -> list[tuple[float, tuple]]:
        """(weight, ((kind, context), token) of each event) of every matched clause of a whole text, in order.

        ``weigh`` replaces the insult weights of the lexicon; a word it gives 0 is no insult.
        """
        found = []
        clause: list = []
        needed = False
        for token in [*TOKEN.findall(text.lower()), "."]:
            need, read = self.readings(token)
            if read is not None:
                if weigh is not None and INSULT in read:
                    own = weigh(token)
                    read = {k: w for k, w in read.items() if k != INSULT} | ({INSULT: own} if own > 0 else {}) or {OTHER: 0.0}
                clause.append((token, read))
                needed = needed or need
                continue
            if needed:  # no other clause can match
                best = self.machine.best_path(clause, WRITTEN)
                if best and best[1]:
                    found.append((best[0], tuple(best[1])))
            clause, needed = [], False
        return found

    def evidence(self, clauses: list[tuple[float, tuple]], size: int) -> tuple[float, float, float, float]:
        """Weight of the heaviest clause, of all different matched clauses, their number, and the length."""
        apart = {events: weight for weight, events in clauses}
        weights = apart.values()
        return max(weights, default=0.0), math.log1p(sum(weights)), math.log1p(len(apart)), math.log1p(size)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, used, limit: int) -> DataFrame:
    """(doc_id, text, y): at most ``limit`` labelled documents for which ``used`` holds, in order of a hash."""
    picked = (
        labels.where(F.col(target).isin(0, 1) & used)
        .groupBy("doc_id")
        .agg(F.max(target).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(limit)
    )
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")


def learn_grammar(docs: DataFrame, labels: DataFrame, used, limit: int = LABEL_LIMIT) -> Grammar:
    """Terminals and weights from labelled documents; ``used`` says which labels may be read.

    A word or word stem becomes an insult terminal if far more toxic than clean texts hold it than chance
    allows; its weight is its smoothed log ratio. Copies of a text count once. Events (an insult or threat in its
    context) are weighted by how often toxic and clean texts hold them, and the evidence of each text's clauses
    becomes a probability by a logistic model; in both, a text is read with the insult weights that all
    other texts give.
    """
    sample = labelled_sample(docs, labels, "toxic", used, limit).groupBy("text").agg(F.max("y").alias("y"))

    def count(batches):
        seen: list[Counter] = [Counter(), Counter()]

        def rows():
            for y, own in enumerate(seen):
                keys = list(own)
                if keys:
                    out = [pa.array([k for k, _ in keys]), pa.array([n for _, n in keys], pa.int32())]
                    values = pa.array(list(own.values()), pa.int64())
                    zero = pa.array([0] * len(keys), pa.int64())
                    yield pa.RecordBatch.from_arrays([*out, *([values, zero] if y else [zero, values])], NAMES)
                    own.clear()

        for batch in batches:
            for part in slices(batch, 0):
                for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    words = {w for w in TOKEN.findall(text.lower()) if len(w) > 2}
                    seen[y].update((w, 0) for w in words)
                    for size in STEMS:
                        seen[y].update((s, size) for s in {w[:size] for w in words if len(w) >= size})
                if len(seen[0]) + len(seen[1]) > 600_000:
                    yield from rows()
        yield from rows()

    found = sample.select("text", "y").mapInArrow(count, "term string, stem int, toxic long, clean long")
    sums = found.groupBy("term", "stem").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    total = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    toxic, clean = total.get(1, 0), total.get(0, 0)
    rate = (toxic + 0.5) / (toxic + clean + 1)
    least = max(3, math.ceil(math.log(CHANCE / 1e6) / math.log(rate)))
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    strong = sums.where((F.col("toxic") >= least) & (F.col("toxic") >= PURE * F.col("clean"))).withColumn("weight", weight)
    kept = strong.orderBy(F.desc(F.col("weight") * F.sqrt("toxic")), "term", "stem").limit(LEXICON_LIMIT).collect()
    kept = [r for r in kept if r["stem"] or r["term"] not in CLOSED]
    words = {r["term"]: r["weight"] for r in kept if not r["stem"]}
    stems = {r["term"]: r["weight"] for r in kept if r["stem"]}
    seen_with = {(r["term"], r["stem"]): (r["toxic"], r["clean"]) for r in kept}
    draft = Grammar(words, stems, dict.fromkeys(EVENTS, 1.0), None)

    def without_own(token: str, y: int) -> float:
        """Weight of a token from all texts but one that holds it; 0 where it would then be no terminal."""
        best = 0.0
        for key in [(token, 0), *[(token[:size], size) for size in STEMS if len(token) >= size]]:
            if key in seen_with:
                bad, good = seen_with[key][0] - y, seen_with[key][1] - (1 - y)
                if bad >= least and bad >= PURE * good:
                    best = max(best, math.log((bad + 0.5) / (toxic + 1)) - math.log((good + 0.5) / (clean + 1)))
        return best

    def pairs(batches):
        for batch in batches:
            for part in slices(batch, 0):
                yield from zip(part.column(0).to_pylist(), part.column(1).to_pylist())

    def count_events(batches):
        seen: Counter = Counter()
        for text, y in pairs(batches):
            clauses = draft.clauses(text, lambda token: without_own(token, y))
            seen.update((*event, y) for event in {event for _, events in clauses for event, _ in events})
        rows = [{"kind": k, "context": c, "y": y, "n": n} for (k, c, y), n in seen.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("kind", "string"), ("context", "string"), ("y", "int32"), ("n", "int64")]))

    events = sample.select("text", "y").mapInArrow(count_events, "kind string, context string, y int, n long")
    by = {tuple(r[:3]): r["n"] for r in events.groupBy("kind", "context", "y").agg(F.sum("n").alias("n")).collect()}
    weights = event_weights(by, rate)
    grammar = Grammar(words, stems, weights, None)

    def gather(batches):
        for batch in batches:
            rows = []
            for part in slices(batch, 0):
                for text, y in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    own = grammar.clauses(text, lambda token: without_own(token, y))
                    rows.append({"y": y, "x": list(grammar.evidence(own, len(text)))})
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("y", pa.int32()), ("x", pa.list_(pa.float64()))]))

    rows = sample.select("text", "y").mapInArrow(gather, "y int, x array<double>").collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), 4)
    grammar.model = fit(x, np.array([r["y"] for r in rows], dtype=float))
    return grammar


def event_weights(by: dict[tuple[str, str, int], int], rate: float) -> dict[tuple[str, str], float]:
    """Weights of the events from the numbers of texts, by kind, context and label, that hold them.

    An insult already has its word's weight: its context adds the log odds of its texts against those of all insults. A
    threat has none: its weight is the log odds of its texts against those of all texts. Few texts say little.
    """

    def odds(p: float) -> float:
        return math.log(p / (1 - p))

    def share_of(odds: float) -> float:
        return 1 / (1 + math.exp(-odds))

    insults = [n for (kind, _, _), n in by.items() if kind == "insult"]
    bad = sum(n for (kind, _, y), n in by.items() if kind == "insult" and y)
    overall = (bad + 1) / (sum(insults) + 2)
    weights = {}
    for kind, context in EVENTS:
        toxic, clean = by.get((kind, context, 1), 0), by.get((kind, context, 0), 0)
        if kind == "insult":
            prior = share_of(odds(overall) + CONTEXT_PRIOR[context])
            share = (toxic + CONTEXT_TEXTS * prior) / (toxic + clean + CONTEXT_TEXTS)
            weights[kind, context] = odds(share) - odds(overall)
        else:
            prior = share_of(odds(rate) + THREAT_PRIOR + CONTEXT_PRIOR[context])
            share = (toxic + PRIOR_TEXTS * prior) / (toxic + clean + PRIOR_TEXTS)
            weights[kind, context] = odds(share) - odds(rate)
    return weights


NAMES = ["term", "stem", "toxic", "clean"]


def score_toxicity(docs: DataFrame, grammar: Grammar, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``score`` (0 to 1) and ``matched`` terms of every whole text.

    NULL and empty texts match nothing and get the score of that; repeated rows get equal scores. A narrow pass;
    the grammar is bounded by LEXICON_LIMIT.
    """

    def make(texts: list[str]) -> list[pa.Array]:
        found = [grammar.clauses(t) for t in texts]
        x = np.array([grammar.evidence(f, len(t)) for f, t in zip(found, texts)], dtype=float).reshape(len(texts), 4)
        scores = 1 / (1 + np.exp(-grammar.model.log_odds(x)))
        return [pa.array(scores), pa.array([sorted({token for _, events in f for _, token in events}) for f in found], pa.list_(pa.string()))]

    fields = [T.StructField("score", T.DoubleType()), T.StructField("matched", T.ArrayType(T.StringType()))]
    return map_texts(docs, keep, text, make, fields)

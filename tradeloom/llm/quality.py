"""Operator 10: quality classifier with hierarchical empirical Bayes over hosts and paths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom.llm.blocks import Words, map_texts
from tradeloom.llm.logistic import Classifier, fit
from tradeloom.llm.toxicity import labelled_sample

LABEL_LIMIT = 40_000  # labelled documents the classifier is fitted on, in order of a hash of their ids
FEATURES = (
    "log_words",
    "word_length",
    "upper",
    "digit",
    "symbol",
    "mark",
    "bar",
    "exclamation",
    "space",
    "end_marks",
    "distinct_words",
    "distinct_shingles",
)
LARGEST_STRENGTH = 1e6
SPREAD_LIMIT = 4.0  # log odds that site evidence may add or take


def features(texts: list[str]) -> np.ndarray:
    """One row of FEATURES per text: shares of kinds of bytes and of distinct words and shingles."""
    words = Words(texts)
    n = len(texts)
    codes = np.frombuffer(words.data, dtype=np.uint8)
    sizes = np.array([len(t.encode("utf-8", "surrogatepass")) for t in texts])
    stops = words.text_start + sizes

    def share(ok: np.ndarray, of: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(ok)])
        return (sums[stops] - sums[words.text_start]) / np.maximum(of, 1)

    counts = np.diff(words.bounds)
    alpha = ((codes | 32) >= 97) & ((codes | 32) <= 122) | (codes >= 128)
    space = (codes == 32) | ((codes >= 9) & (codes <= 13))
    digit = (codes >= 48) & (codes <= 57)
    symbol = ~(alpha | space | digit)
    letters = share(alpha, sizes) * sizes
    shingles, bounds = words.shingles()

    def distinct(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
        return np.array([len(np.unique(values[a:b])) for a, b in zip(edges, edges[1:])], dtype=float) / np.maximum(
            np.diff(edges), 1
        )

    out = np.column_stack(
        [
            np.log1p(counts),
            letters / np.maximum(counts, 1) / 10,
            share((codes >= 65) & (codes <= 90), letters),
            share(digit, sizes),
            share(symbol, sizes),
            share((codes == 35) | (codes == 36) | (codes == 37) | (codes == 38) | (codes == 42), counts),
            share(codes == 124, counts),
            share(codes == 33, counts),
            share(space, sizes),
            share((codes == 46) | (codes == 63), counts),
            distinct(words.hash, words.bounds),
            distinct(shingles, bounds),
        ]
    )
    return out.reshape(n, len(FEATURES))


def learn_classifier(docs: DataFrame, labels: DataFrame, used: Column, limit: int = LABEL_LIMIT) -> Classifier:
    """Fit on at most ``limit`` labelled documents; only their features (a fixed number each) come back."""
    sample = labelled_sample(docs, labels, "quality", used, limit)

    def make(texts: list[str]) -> list[pa.Array]:
        x = features(texts)
        return [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))]

    rows = map_texts(sample, ["y"], "text", make, [T.StructField("x", T.ArrayType(T.DoubleType()))]).collect()
    x = np.array([r["x"] for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["y"] for r in rows], dtype=float))


def _strength(sites: DataFrame, own: str, parent: Column) -> float:
    """Pseudo-count of the parent's rate by the method of moments: spread of site rates beyond chance."""
    found = sites.where("n > 0").agg(
        F.sum("n").alias("n"),
        F.count("*").alias("sites"),
        F.sum(F.col("n") * F.pow(F.col(own) / F.col("n") - parent, 2)).alias("between"),
        F.sum(F.col("n") * parent * (1 - parent)).alias("noise"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    if not found["n"] or found["sites"] < 2:
        return LARGEST_STRENGTH
    noise = found["noise"] / found["n"]
    spread = (found["between"] - noise * (found["sites"] - 1)) / (found["n"] - found["squares"] / found["n"])
    if spread <= 0:
        return LARGEST_STRENGTH
    return min(LARGEST_STRENGTH, max(1.0, noise / spread - 1))


def site_posteriors(evidence: DataFrame, prior: float) -> DataFrame:
    """(host, path, host_rate, path_rate) from documents' (host, path, p), all of them.

    Expected good documents are summed by path, path sums by host. A host's rate is drawn to the global one,
    a path's rate to its host's, each by as many pseudo-documents as the spread between sites warrants, so a
    sparse site keeps its parent's rate. Sums combine before the shuffle; a hot host is one row per task.
    """
    paths = evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("p").alias("good"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    strong = _strength(hosts, "good", F.lit(prior))
    rate = (F.col("good") + strong * prior) / (F.col("n") + strong)
    hosts = hosts.select("host", rate.alias("host_rate"))
    paths = paths.join(hosts, "host")
    own = _strength(paths, "good", F.col("host_rate"))
    return paths.select(
        "host", "path", "host_rate", ((F.col("good") + own * F.col("host_rate")) / (F.col("n") + own)).alias("path_rate")
    )


def _logit(p: Column) -> Column:
    kept = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(kept / (1 - kept))


def score_quality(
    docs: DataFrame,
    classifier: Classifier,
    keep: list[str],
    host: Column,
    path: Column,
    tables,
    text: str = "text",
) -> DataFrame:
    """``keep`` columns with doc_score, host_rate, path_rate, quality (0 to 1) and good (quality >= 0.5).

    ``host`` and ``path`` name a document's site; NULL is a site of its own. Classifier evidence and the log
    odds of the path's posterior against the global prior add up. NULL and empty texts are judged by their
    features (no words); repeated rows get equal scores. Sites are joined back by Spark's choice of join.
    """
    names = [f"_{i}" for i in range(len(keep))]
    body = names[keep.index(text)] if text in keep else "_text"
    sited = docs.select(
        *[F.col(f"`{c}`").alias(name) for c, name in zip(keep, names)],
        F.coalesce(host.cast("string"), F.lit("\0")).alias("host"),
        F.coalesce(path.cast("string"), F.lit("\0")).alias("path"),
        *([] if text in keep else [F.col(f"`{text}`").alias("_text")]),
    )

    def make(texts: list[str]) -> list[pa.Array]:
        return [pa.array(classifier.log_odds(features(texts)))]

    def judged(columns: list[str]) -> DataFrame:
        return map_texts(sited, [*columns, "host", "path"], body, make, [T.StructField("evidence", T.DoubleType())])

    # Whole texts are not stored for the sites' sake: their evidence is computed again when they are kept.
    stored = tables.put(judged([] if text in keep else names))
    scored = judged(names) if text in keep else stored
    p = 1 / (1 + F.exp(-F.col("evidence")))
    overall = stored.agg(F.avg(p)).first()[0]
    prior = min(1 - 1e-6, max(1e-6, classifier.prior if overall is None else overall))
    sites = tables.put(site_posteriors(stored.select("host", "path", p.alias("p")), prior))
    shift = _logit(F.col("path_rate")) - _logit(F.lit(prior))
    bounded = F.greatest(F.least(shift, F.lit(SPREAD_LIMIT)), F.lit(-SPREAD_LIMIT))
    quality = 1 / (1 + F.exp(-(F.col("evidence") + bounded)))
    joined = scored.join(sites, ["host", "path"])
    return joined.select(
        *[F.col(f"_{i}").alias(c) for i, c in enumerate(keep)],
        p.alias("doc_score"),
        "host_rate",
        "path_rate",
        quality.alias("quality"),
        (quality >= 0.5).alias("good"),
    )

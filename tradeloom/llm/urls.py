"""Operator 2: URL filters by rules and gradient-boosted trees, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.store import Tables

LABEL_LIMIT = 50_000  # labelled urls the trees are grown on, in order of a hash
BINS = 16
TREES = 12
DEPTH = 3
RATE = 0.3
RIDGE = 1.0
LEAST_GAIN = 1e-3


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(found, capitals, capitals.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, bool]]) -> Column:
    """The longest rule that fits: its host is the url's or a parent domain, its path begins the url's path."""
    fitting = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        fitting = F.when(fits, F.lit(rule)).otherwise(fitting)
    return fitting


def entropy(text: Column) -> Column:
    """Bits per character."""
    size = F.length(text).cast("double")
    return F.when(size == 0, 0.0).otherwise(
        F.aggregate(
            F.array_distinct(F.split(text, "")),
            F.lit(0.0),
            lambda total, char: total
            + F.when(
                char != "",
                -((size - F.length(F.replace(text, char, F.lit("")))) / size)
                * F.log2((size - F.length(F.replace(text, char, F.lit("")))) / size),
            ).otherwise(0.0),
        )
    )


def lexical(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Numbers read off a url; NULL counts as empty."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "host_depth": (F.size(F.split(host, r"\.")) - 1).cast("double"),
        "path_depth": F.regexp_count(path, F.lit("/")).cast("double"),
        "digits": F.regexp_count(url, F.lit("[0-9]")) / size,
        "entropy": entropy(url),
        "parameters": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "&")).cast("double")),
        "hyphens": F.regexp_count(url, F.lit("-")).cast("double"),
        "secure": url.startswith("https").cast("double"),
    }


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


@dataclass
class Trees:
    """Boosted trees over binned features: each a list of (feature, bound) by node and leaf values."""

    cuts: dict[str, list[float]]
    start: float
    trees: list[tuple[dict[int, tuple[str, float]], dict[int, float]]] = field(default_factory=list)

    def margin(self) -> Column:
        return reduce(lambda a, b: a + b, [_leaf(*tree, 1) for tree in self.trees], F.lit(self.start))


def _leaf(splits: dict[int, tuple[str, float]], values: dict[int, float], node: int) -> Column:
    if node not in splits:
        return F.lit(values[node])
    feature, bound = splits[node]
    return F.when(F.col(feature) <= bound, _leaf(splits, values, 2 * node)).otherwise(
        _leaf(splits, values, 2 * node + 1)
    )


def _node(splits: dict[int, tuple[str, float]], node: int = 1) -> Column:
    if node not in splits:
        return F.lit(node)
    feature, bound = splits[node]
    return F.when(F.col(feature) <= bound, _node(splits, 2 * node)).otherwise(_node(splits, 2 * node + 1))


def grow(sample: DataFrame, names: Sequence[str]) -> Trees:
    """Boost depth-limited trees on ``sample`` (features, y) with logistic loss.

    For each level one aggregate sums gradients by node, feature and bin; nodes x features x bins rows reach
    the driver, whatever the number of urls.
    """
    shares = [i / BINS for i in range(1, BINS)]
    size = sample.agg(
        F.count("*").alias("n"),
        F.sum("y").alias("bad"),
        *[F.percentile_approx(name, F.array(*map(F.lit, shares)), 10_000).alias(name) for name in names],
    ).first()
    bad, n = float(size["bad"] or 0), size["n"]
    start = float(_log_odds((bad + 1) / (n + 2)))
    model = Trees({name: sorted(set(size[name] or [])) for name in names}, start)
    if not 0 < bad < n:
        return model
    bins = F.array(
        *[
            F.struct(
                F.lit(i).alias("feature"),
                sum((F.when(F.col(name) > c, 1).otherwise(0) for c in model.cuts[name]), F.lit(0)).alias("bin"),
            )
            for i, name in enumerate(names)
        ]
    )
    for _ in range(TREES):
        p = 1 / (1 + F.exp(-model.margin()))
        splits: dict[int, tuple[str, float]] = {}
        values: dict[int, float] = {}
        for _depth in range(DEPTH):
            found = (
                sample.select(_node(splits).alias("node"), (F.col("y") - p).alias("g"), (p * (1 - p)).alias("h"), F.inline(bins))
                .groupBy("node", "feature", "bin")
                .agg(F.sum("g").alias("g"), F.sum("h").alias("h"))
                .collect()
            )
            table: dict[int, dict[int, dict[int, tuple[float, float]]]] = {}
            for r in found:
                table.setdefault(r["node"], {}).setdefault(r["feature"], {})[r["bin"]] = (r["g"], r["h"])
            added = False
            for node, by_feature in table.items():
                if node in values and node.bit_length() <= _depth:
                    continue
                best = _best_split(by_feature)
                g, h = (sum(x[i] for x in next(iter(by_feature.values())).values()) for i in (0, 1))
                values[node] = RATE * g / (h + RIDGE)
                if best is None:
                    continue
                feature, place, (g1, h1) = best
                splits[node] = (names[feature], model.cuts[names[feature]][place])
                values[2 * node] = RATE * g1 / (h1 + RIDGE)
                values[2 * node + 1] = RATE * (g - g1) / (h - h1 + RIDGE)
                added = True
            if not added:
                break
        model.trees.append((splits, values))
    return model


def _log_odds(p: float) -> float:
    from math import log

    return log(p / (1 - p))


def _best_split(by_feature: dict[int, dict[int, tuple[float, float]]]):
    best, gain_of_best = None, LEAST_GAIN
    for feature, bins in sorted(by_feature.items()):
        g, h = (sum(x[i] for x in bins.values()) for i in (0, 1))
        g1 = h1 = 0.0
        for place in sorted(bins)[:-1]:
            g1, h1 = g1 + bins[place][0], h1 + bins[place][1]
            gain = g1 * g1 / (h1 + RIDGE) + (g - g1) ** 2 / (h - h1 + RIDGE) - g * g / (h + RIDGE)
            if gain > gain_of_best:
                best, gain_of_best = (feature, place, (g1, h1)), gain
    return best


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, bool]],
    tables: Tables,
    label: Column | None = None,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """key, host, path, rule, verdict (allow or block) and the trees' ``score`` of every url.

    ``rules`` are (host/path, blocks). ``label`` (true: block, NULL: unknown) marks the urls to learn from;
    by default those that a rule decides. The trees grow on at most LABEL_LIMIT of them; suffix statistics
    (labelled urls of a host's last two labels, drawn to the overall rate by ten urls) come from all.
    NULL urls have an empty host and path and get the method's verdict; repeated rows get equal ones.
    """
    own = pages.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias("_url"), *([label.alias("_label")] if label is not None else []))
    own = own.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    blocked = F.lit(None).cast("boolean")
    for rule, blocks in rules:
        blocked = F.when(F.col("rule") == rule, F.lit(blocks)).otherwise(blocked)
    own = own.withColumn("_blocked", blocked).withColumn("_suffix", suffix_of(F.col("host")))
    known = (F.col("_blocked") if label is None else F.col("_label")).cast("int")
    counted = own.groupBy("_suffix").agg(F.count(known).alias("_n"), F.sum(known).alias("_bad"))
    rate = counted.agg((F.sum("_bad") + 1) / (F.sum("_n") + 2)).first()[0] or 0.5
    suffixes = counted.select("_suffix", ((F.coalesce("_bad", F.lit(0)) + 10 * rate) / (F.col("_n") + 10)).alias("suffix_rate"))
    values = own.join(suffixes, "_suffix").withColumns(lexical(F.col("_url"), F.col("host"), F.col("path")))
    names = ["suffix_rate", *lexical(F.lit(""), F.lit(""), F.lit(""))]
    sample = values.where(known.isNotNull()).select(F.xxhash64("_url").alias("_order"), known.cast("double").alias("y"), *names)
    sample = tables.put(sample.orderBy("_order", *names).limit(LABEL_LIMIT))
    model = grow(sample, names)
    score = 1 / (1 + F.exp(-model.margin()))
    scored = values.withColumn("score", score)
    verdict = F.when(F.coalesce(F.col("_blocked"), F.col("score") >= 0.5), "block").otherwise("allow")
    return scored.select(key, "host", "path", "rule", verdict.alias("verdict"), "score")

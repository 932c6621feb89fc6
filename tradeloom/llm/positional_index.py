"""Positional inverted index over token streams, and exact phrase and proximity matches of test items in it.

Everything here is DataFrame work. The index is a stored table of postings (row, pos, term) of every token whose term
some item holds, in the order of the documents, so its columns compress to a few bytes a posting. Searches read the
lists of the rarest terms first: shifted by a term's place in its item, two lists of one phrase meet on the same
(row, item, shift), and only shifts on which the two rarest terms of a window meet are looked at in full.

Defined results: words are runs of characters other than ASCII separators, A-Z lower-cased. NULL or empty texts have
no words. Repeated documents are rows of their own, also with one id or without one. Items with the same words are
searched once; items that share an id count as one item, items without an id mark words but are no item of the list.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradeloom.llm.store import Tables

WINDOW = 10
# What separates words before A-Z is lower-cased, and the letters to lower-case.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
END_OF_TEXT = ""  # the term of one posting per document that carries its id; no word is empty


@dataclass(frozen=True)
class Index:
    """Stored tables: ``postings`` (row, pos, term), ``rows`` (row, doc_id, n_words), ``terms`` (term, word)."""

    postings: DataFrame
    rows: DataFrame
    terms: DataFrame


def words_of(text: Column) -> Column:
    """The words of a text, not yet lower-cased."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def lower_ascii(word: Column) -> Column:
    """A-Z in lower case; ``lower`` leaves alone most words and tells the others apart quickly."""
    return F.when(F.lower(word) == word, word).otherwise(F.translate(word, UPPER, UPPER.lower()))


def item_phrases(items: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame]:
    """Stored tables of distinct word sequences: their ids (phrase, item_id) and words (phrase, k, word, size)."""
    lowered = F.transform(words_of(F.col("text")), lower_ascii)
    worded = items.select("item_id", lowered.alias("words")).where("size(words) > 0")
    worded = worded.select("item_id", "words", F.sha2(F.concat_ws(" ", "words").cast("binary"), 256).alias("phrase"))
    named = tables.put(worded.select("phrase", "item_id").distinct())
    once = worded.groupBy("phrase").agg(F.first("words").alias("words"))
    places = once.select("phrase", F.size("words").alias("size"), F.posexplode("words").alias("k", "word"))
    return named, tables.put(places)


def build_index(docs: DataFrame, words: DataFrame, tables: Tables) -> Index:
    """Postings of every token of ``docs`` (doc_id, text) whose word is in ``words``.

    The terms are few next to the tokens: Spark broadcasts their stored table while it is small, else it joins by shuffle.
    """
    known = words.select("word").union(docs.sparkSession.range(1).select(F.lit(END_OF_TEXT))).distinct()
    terms = tables.put(known.select(F.monotonically_increasing_id().alias("term"), "word"))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", words_of(F.col("text")).alias("words"))
    ended = F.concat("words", F.array(F.lit(END_OF_TEXT)))
    tokens = texts.select("row", "doc_id", F.posexplode(ended).alias("pos", "word"))
    ends = F.col("word") == END_OF_TEXT
    tokens = tokens.select("row", "pos", lower_ascii(F.col("word")).alias("word"), F.when(ends, F.col("doc_id")).alias("doc_id"), ends.alias("ends"))
    postings = tables.put(tokens.join(terms, "word").select("row", "pos", "term", "ends", "doc_id"))
    rows = tables.put(postings.where("ends").select("row", "doc_id", F.col("pos").cast("long").alias("n_words")))
    return Index(postings.where("not ends").select("row", "pos", "term"), rows, terms)


def rarest_places(index: Index, places: DataFrame, window: int, lists: int) -> DataFrame:
    """(phrase, first, ranked): each window's places as (count, k, term), the rarest ``lists`` of them in order.

    Windows with a term that no document has are left out.
    """
    counts = index.postings.groupBy("term").agg(F.count("*").alias("n"))
    counted = places.join(index.terms, "word").join(counts, "term", "left")
    counted = counted.withColumn("n", F.coalesce("n", F.lit(0)))
    wide = F.least(F.lit(window), F.col("size"))
    firsts = F.sequence(F.greatest(F.lit(0), F.col("k") - wide + 1), F.least(F.col("k"), F.col("size") - wide))
    spread = counted.select("phrase", F.explode(firsts).alias("first"), F.struct("n", "k", "term").alias("place"))
    ranked = spread.groupBy("phrase", "first").agg(F.sort_array(F.collect_list("place")).alias("places"))
    return ranked.where("places[0].n > 0").select("phrase", "first", F.slice("places", 1, lists).alias("ranked"))


def _of_rows(postings: DataFrame, found: DataFrame, tables: Tables) -> DataFrame:
    """Postings of the documents in ``found``, whose stored list of rows Spark broadcasts while it is small."""
    return postings.join(tables.put(found.select("row").distinct()), "row", "left_semi")


def phrase_spans(index: Index, places: DataFrame, tables: Tables, window: int = WINDOW) -> DataFrame:
    """Stored spans (row, phrase, first, last): maximal runs of document words equal to a run of ``window`` or more
    words of a phrase (all its words if it has fewer)."""
    ranked = rarest_places(index, places, window, 2)
    seeds = ranked.select("phrase", F.explode("ranked").alias("place")).select("phrase", "place.k", "place.term")
    seeds = tables.put(seeds.distinct())
    shifted = index.postings.join(seeds, "term").select("row", "phrase", (F.col("pos") - F.col("k")).alias("shift"))
    met = shifted.groupBy("row", "phrase", "shift").agg(F.count("*").alias("n"))
    sizes = places.select("phrase", "size").distinct()
    met = met.join(sizes, "phrase").where(F.col("n") >= F.least(F.lit(2), F.lit(window), "size"))
    met = tables.put(met.select("row", "phrase", "shift"))

    needed = places.join(index.terms, "word").select("phrase", "k", "term", "size")
    wanted = met.join(needed, "phrase").withColumn("pos", F.col("shift") + F.col("k")).where("pos >= 0")
    equal = wanted.join(_of_rows(index.postings, met, tables), ["row", "pos", "term"])
    line = Window.partitionBy("row", "phrase", "shift").orderBy("k")
    runs = equal.withColumn("run", F.col("k") - F.row_number().over(line)).groupBy("row", "phrase", "shift", "run")
    spans = runs.agg(F.min("pos").alias("first"), F.max("pos").alias("last"), F.first("size").alias("size"))
    whole = F.col("last") - F.col("first") + 1 >= F.least(F.lit(window), F.col("size"))
    return tables.put(spans.where(whole).select("row", "phrase", "first", "last"))


def proximity_matches(index: Index, places: DataFrame, slop: int, tables: Tables, window: int = WINDOW) -> DataFrame:
    """(row, phrase, first, pos): the rarest term of the phrase's window at ``first`` stands at ``pos``, and every other
    term of the window within ``slop`` words of the place that the phrase gives it. Slop 0 is the exact window."""
    ranked = rarest_places(index, places, window, window)
    anchors = ranked.select("phrase", "first", F.col("ranked")[0].alias("a"), "ranked")
    at = index.postings.join(anchors.select("phrase", "first", "a.k", "a.term"), "term")
    at = tables.put(at.select("row", "phrase", "first", "pos", "k"))
    others = anchors.select("phrase", "first", F.explode(F.slice("ranked", 2, window)).alias("b"), F.col("a.k").alias("k"))
    second = anchors.select("phrase", "first", F.get("ranked", 1).alias("b"), F.col("a.k").alias("k")).where("b is not null")
    postings = _of_rows(index.postings, at, tables)

    def met(found: DataFrame, wanted: DataFrame) -> DataFrame:
        """The candidates with the number of wanted places that have their term near."""
        near = F.explode(F.sequence(F.lit(-slop), F.lit(slop))).alias("off")
        expect = found.join(wanted, ["phrase", "first", "k"]).select("row", "phrase", "first", F.col("pos").alias("anchor"), F.col("b.k").alias("bk"), F.col("b.term").alias("term"), (F.col("pos") + F.col("b.k") - F.col("k")).alias("place"), near)
        expect = expect.withColumn("pos", F.col("place") + F.col("off"))
        hits = expect.join(postings, ["row", "pos", "term"]).select("row", "phrase", "first", "anchor", "bk").distinct()
        return hits.groupBy("row", "phrase", "first", F.col("anchor").alias("pos")).agg(F.count("*").alias("met"))

    key = ["row", "phrase", "first", "pos"]
    sized = at.join(places.select("phrase", "size").distinct(), "phrase").withColumn("need", F.least(F.lit(window), "size") - 1)
    pairs = tables.put(sized.where("need > 0").join(met(at, second), key, "left_semi"))
    full = pairs.join(met(pairs, others), key).where("met = need").select(*key)
    return full.unionByName(sized.where("need = 0").select(*key))


def contamination(docs: DataFrame, items: DataFrame, tables: Tables, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, n_words, n_hit (words inside a shared window), n_items and the sorted ids of their items."""
    named, places = item_phrases(items, tables)
    index = build_index(docs, places, tables)
    spans = phrase_spans(index, places, tables, window)
    words = spans.select("row", F.explode(F.sequence("first", "last")).alias("pos")).distinct()
    hit = words.groupBy("row").agg(F.count("*").alias("n_hit"))
    listed = spans.select("row", "phrase").distinct().join(named.where("item_id is not null"), "phrase")
    listed = listed.groupBy("row").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    judged = tables.put(hit.join(listed, "row", "left"))
    tables.keep_only(index.rows, judged)
    return index.rows.join(judged, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )

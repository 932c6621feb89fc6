"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm import (
    divergence,
    jaccard_join,
    lattice,
    packing,
    passages,
    pieces,
    positional_index,
    quality,
    spelling,
    toxicity,
    urls,
    vector_graph,
    winnow,
)
from tradeloom.llm.oracles import CONTAMINATION, DIVERGENCE, VARIANTS
from tradeloom.llm.store import Tables
from tradeloom.session import configure

CAPACITY = 1024
END_ID = 2
RULES = (("net/", True), ("example.net/en/", False), ("example.com/de/", True), ("org/fr/", False))
ROWS_AT_ONCE = "2000"  # rows of one Arrow batch, so that a batch of long texts fits in a worker


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ROWS_AT_ONCE)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def held_out(key: str, parts: int):
    """Whether crc32 of the id as text leaves no remainder; a NULL id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts == 0


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.passage_classes(table(spark, folder, "documents"), Tables(spark))


def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge_urls(table(spark, folder, "pages"), RULES, Tables(spark))


def token_rows(docs: DataFrame) -> DataFrame:
    """Pieces of every document with the checksum of their ids."""
    import public_tokenizers

    found = packing.token_pieces(
        docs,
        tokenizer("byte_bpe_50k.json"),
        END_ID,
        CAPACITY,
        tokenizer("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return found.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))


def packed_rows(docs: DataFrame) -> DataFrame:
    tables = Tables(docs.sparkSession)
    rows = tables.put(token_rows(docs))
    return packing.pack(rows, CAPACITY, tables, ["doc_id", "piece", "start", "length", "ids_crc32"])


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed_rows(table(spark, folder, "documents"))


def op4_winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnow.with_following(table(spark, folder, "documents"))


def toxic_scores(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    grammar = toxicity.learn_grammar(docs, labels, ~held_out("doc_id", 5))
    return toxicity.score_toxicity(docs, grammar, keep)


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxic_scores(docs, labels, ["doc_id"]).select(
        "doc_id",
        held_out("doc_id", 5).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "matched",
    )


def op6_embedding_graph(spark: SparkSession, folder: str) -> DataFrame:
    found = vector_graph.near_classes(table(spark, folder, "embeddings"), Tables(spark))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("class_id").alias("component_id"),
        F.col("id").eqNullSafe(F.col("class_id")).alias("kept"),
    )


def op7_lattice_lm(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").withColumn("_held_out", held_out("doc_id", 10))
    return lattice.score_documents(docs, tokenizer("piece_bpe_32k.model"), "_held_out", Tables(spark))


def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = pieces.encode_decode(table(spark, folder, "documents"), tokenizer("piece_bpe_32k.model"), ["doc_id"])
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    found = jaccard_join.jaccard_classes(table(spark, folder, "documents"), Tables(spark))
    return found.select("doc_id", "class_id", "n_links", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def judged_quality(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """Documents with their quality; the host of a document is its source, the path its language there."""
    classifier = quality.learn_classifier(docs, labels, ~held_out("doc_id", 5))
    tables = Tables(docs.sparkSession)
    return quality.score_quality(docs, classifier, keep, F.col("source"), F.col("lang"), tables)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = judged_quality(docs, labels, ["doc_id"])
    return found.withColumn("held_out", held_out("doc_id", 5)).withColumnRenamed("good", "kept")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variant_groups(table(spark, folder, "documents"), Tables(spark))


def op12_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    found = positional_index.contamination(docs, items, Tables(spark))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(table(spark, folder, "documents"), Tables(spark))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_winnowing": op4_winnowing,
    "op5_toxicity": op5_toxicity,
    "op6_embedding_graph": op6_embedding_graph,
    "op7_lattice_lm": op7_lattice_lm,
    "op8_pieces": op8_pieces,
    "op9_jaccard_join": op9_jaccard_join,
    "op10_quality": op10_quality,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_decontamination": op12_decontamination,
    "op13_source_divergence": op13_source_divergence,
}
# The first ten are not within reach of SQL; tests/llm compares them with brute force.
ORACLES = {
    "op11_spelling_variants": VARIANTS,
    "op12_decontamination": CONTAMINATION,
    "op13_source_divergence": DIVERGENCE,
}

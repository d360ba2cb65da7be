"""A corpus from raw documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as
Parquet and read again as the next stage's documents. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm import byte_bpe, decision_list, doc_stats, jaccard_join, mixing, suffix_dedup
from callsift.llm.queries import MIX_EXPONENT, base_failed, learned_rules
from callsift.sources.shared_dir import new_folder, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the decision list learned from the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rules, _ = learned_rules(docs, labels, "pipeline-stats")
    shares = doc_stats.shares("_stats")
    stats = docs.select(*COLUMNS, doc_stats.describe("text").alias("_stats"))
    flat = stats.select(*COLUMNS, "_stats.n_words", "_stats.n_repeat_words", *[v.alias(k) for k, v in shares.items()])
    return flat.where(~base_failed() & decision_list.verdict(rules)).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shingles link."""
    return jaccard_join.one_of_each(docs.select(*COLUMNS), "doc_id", "text", written)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too.

    Characters that a cut leaves incomplete go as well; ``n_chars`` is counted anew.
    """
    left = suffix_dedup.remove_repeats(docs.select(*COLUMNS), "doc_id", "text", written)
    texts = left.withColumn("text", suffix_dedup.as_text("kept"))
    return texts.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*COLUMNS)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mix: the order of part files and of rows in each.

    A plain reader deals files by size; ``token_ids`` takes each row's place from them.
    """
    docs = docs.select(*COLUMNS)
    weights = mixing.power_weights(docs, "source", MIX_EXPONENT)
    return mixing.schedule(docs, "doc_id", "source", weights, mixing.BLOCK_ROWS).orderBy("slot", "in_block").select(*COLUMNS)


def with_places(docs: DataFrame) -> DataFrame:
    """Documents read from Parquet files with ``position``: their gapless place, from 0.

    Files follow one another by the numbers in their names, part and then file of the
    part; within a file rows keep their order.
    """
    name = F.col("_metadata.file_name")
    part, nth = (F.regexp_extract(name, p, 1) for p in (r"^part-(\d+)", r"-c(\d+)\."))
    number = part.cast("bigint") * 2**20 + F.coalesce(nth.try_cast("bigint"), F.lit(0))
    placed = docs.select(*COLUMNS, number.alias("_file"), F.col("_metadata.row_index").alias("_row"))
    counts = docs.select(number.alias("_file")).groupBy("_file").agg(F.count("*").alias("n"))
    before = mixing.running_before(counts, "_file", [], "_before")
    # As many rows as there are files.
    return placed.join(F.broadcast(before), "_file").select(*COLUMNS, (F.col("_before") + F.col("_row")).alias("position"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, a digest of what they decode to, and its place in the mix."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ids = with_places(docs).select(
        "doc_id", "lang", "source", "n_chars", "position", byte_bpe.round_trip("text", path, public_tokenizers.PATTERN).alias("_both")
    )
    return ids.select("*", "_both.ids", F.col("_both.bytes").alias("_bytes")).select(
        "doc_id",
        "lang",
        "source",
        "n_chars",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2("_bytes", 256).alias("decoded_sha256"),
        "position",
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("mixed sources", mixed_sources),
    ("token ids", token_ids),
]

#: Learned rules, components and byte-pair merges are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after another, on the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

"""Registered queries: each applies one operator to a whole table of the given folder."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from callsift.llm import byte_bpe, collision_search, decision_list, doc_stats, jaccard_join, mixing, multi_index, quality_qda, scaled_sketch, sharding, suffix_dedup, token_alignment, token_file, vector_rows, warc
from callsift.sources.shared_dir import new_folder, written

#: Sources are mixed by their number of rows to this power.
MIX_EXPONENT = 0.7
#: Slots of the mix that one window numbers the rows of.
MIX_CELL = 64
#: From this score on a document is predicted to be good.
QUALITY_CUT = 0.3


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text() -> F.Column:
    return F.coalesce(F.col("text"), F.lit(""))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its place in the mix of all sources."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "source")
    weights = mixing.power_weights(docs, "source", MIX_EXPONENT)
    mixed = mixing.schedule(docs, "doc_id", "source", weights, mixing.BLOCK_ROWS)
    return mixing.positions(mixed, MIX_CELL)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives, with revisit records for repeats, and read back."""
    pages = _table(spark, sf_dir, "pages")
    folder = new_folder(spark, "warc")
    warc.register(spark)
    warc.records(pages, "page_id", "url", "html").write.format("warc").mode("append").save(folder)
    back = warc.read(spark, folder)
    number = r"<urn:page:(-?\d+)>"
    digest = F.when(F.col("record_type") == "response", F.sha1("payload"))
    size = F.when(F.col("record_type") == "response", F.octet_length("payload").cast("long"))
    return back.select(
        F.regexp_extract("record_id", number, 1).cast("long").alias("page_id"),
        F.coalesce(size, "payload_bytes").alias("payload_bytes"),
        F.coalesce(digest, F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type",
        F.regexp_extract("refers_to", number, 1).cast("long").alias("refers_to"),
    )


def _described(docs: DataFrame, name: str) -> DataFrame:
    """Statistics of each document, computed once; a few numbers a row."""
    stats = docs.select("doc_id", doc_stats.describe("text").alias("stats")).select("doc_id", "stats.*")
    return written(stats, name)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for every document, learned from four fifths of the labels."""
    stats = _described(_table(spark, sf_dir, "documents"), "op3-stats")
    shown = stats.select("doc_id", *[v.alias(k) for k, v in quality_qda.features().items()])
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    labels = _table(spark, sf_dir, "labels").select("doc_id", "quality").where(~held_out)
    names = list(quality_qda.features())
    model = quality_qda.fit(shown.join(labels, "doc_id"), names, "quality")
    return model.score(shown, "score").select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= QUALITY_CUT).cast("int").alias("predicted"),
    )


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id among those it is linked with."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.link(docs, "doc_id", "text", written).withColumnRenamed("id", "doc_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that stand elsewhere too."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    left = suffix_dedup.remove_repeats(docs, "doc_id", "text", written)
    size = F.octet_length(_text()).cast("long")
    return left.select(
        "doc_id",
        size.alias("n_bytes"),
        (size - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of equal row counts, in random order."""
    docs = _table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.octet_length(_text()) + 1).cast("long").alias("size"),
        F.crc32(F.encode(_text(), "UTF-8")).alias("text_crc32"),
    )
    rows = _table(spark, sf_dir, "documents").count()
    return sharding.uniform_shards(docs, "doc_id", rows=rows).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded to ids and decoded again, as digests."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = _table(spark, sf_dir, "documents")
    ids = docs.select("doc_id", byte_bpe.round_trip("text", path, public_tokenizers.PATTERN).alias("both"))
    return ids.select("doc_id", "both.ids", "both.bytes").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def base_failed() -> F.Column:
    """Too few words, or half of them in repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def learned_rules(docs: DataFrame, labels: DataFrame, name: str) -> tuple[list[decision_list.Rule], DataFrame]:
    """Rules learned from labelled documents that pass the base rules, and all statistics."""
    shares = doc_stats.shares()
    stats = _described(docs, name).select("*", *[v.alias(k) for k, v in shares.items()])
    known = stats.where(~base_failed()).join(labels.select("doc_id", "quality"), "doc_id")
    return decision_list.learn(known, ["n_words", *shares], "quality", "doc_id"), stats


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document judged by the base rules and a learned decision list."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    rules, stats = learned_rules(docs, labels, "op8-stats")
    return stats.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed().alias("base_failed"),
        (~base_failed() & decision_list.verdict(rules)).alias("kept"),
        decision_list.fired(rules).alias("rule"),
    )


def op9_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document, of its edited text, and their likeness."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", _text().alias("text"))
    kept = docs.select("*", scaled_sketch.sketch(F.col("text")).alias("sketch"))
    pairs = scaled_sketch.with_next(kept, "doc_id", ["text", "sketch"])
    edited = pairs.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        "sketch",
        "next_sketch",
        scaled_sketch.half_replaced(F.col("text"), F.col("next_text")).alias("edited"),
    )
    sketched = edited.select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "sketch",
        "next_sketch",
        scaled_sketch.sketch(F.col("edited")).alias("edited_sketch"),
    )
    return sketched.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        scaled_sketch.fingerprint(F.col("sketch")).alias("fingerprint"),
        scaled_sketch.fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        scaled_sketch.likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        scaled_sketch.likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
    )


#: Ids that a token file holds, about.
FILE_TOKENS = 8 << 20


def op10_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids in rank-coded files, read back."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = _table(spark, sf_dir, "documents")
    ids = token_file.encode("text", path, public_tokenizers.PATTERN, 0)
    encoded = written(docs.select("doc_id", ids.alias("ids"), F.octet_length(_text()).alias("bytes")), "op10-ids")
    size = encoded.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    folder = new_folder(spark, "op10-files")
    token_file.write(encoded, "doc_id", "ids", folder, max(1, -(-size // FILE_TOKENS)))
    back = token_file.starts(token_file.read(spark, folder).withColumn("crc", F.crc32("ids")).drop("ids"))
    return back.select("doc_id", "start", "n_tokens", F.col("crc").alias("ids_crc32"))


#: Components of embeddings become whole numbers of this many parts.
PARTS = 256


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for each anchor and each of its first positives."""
    table = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    fine = vector_rows.finite("embedding")
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * PARTS))
    rows = table.where(fine).select("vec_id", label.alias("label"), whole.alias("vector"))
    rows = written(multi_index.usable(rows, "vec_id", "vector", "label"), "op11-rows")
    found = multi_index.hard_negatives(rows, F.col("id") % 100 == 0, written)
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens under two tokenizers, aligned, with corpus-wide link counts."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = [public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    blocks = written(token_alignment.blocks(docs, "doc_id", "text", *paths), "op12-blocks")
    counts = written(token_alignment.pair_counts(blocks), "op12-pairs")
    return token_alignment.link_figures(blocks, counts, "doc_id")


#: Neighbours of a query.
NEIGHBOURS = 20


def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest rows of every twentieth embedding."""
    table = _table(spark, sf_dir, "embeddings")
    found = collision_search.nearest(table, "vec_id", "embedding", F.col("vec_id") % 20 == 0, NEIGHBOURS, written)
    return found.select("query_id", "rank", "vec_id", "score")


REGISTRY = {
    f.__name__: f
    for f in (
        op1_mix_sources,
        op2_warc,
        op3_quality,
        op4_jaccard_join,
        op5_suffix_dedup,
        op6_shards,
        op7_byte_bpe,
        op8_quality_rules,
        op9_scaled_sketch,
        op10_token_file,
        op11_hard_negatives,
        op12_token_alignment,
        op13_nearest,
    )
}

"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from amphora.llm import alignment, byte_bpe, id_shards, line_dedup, packing, pivots, prefix_trie, quality, sharding, simhash, substring, token_counts, warc
from amphora.llm.encoders import EncoderSpec
from amphora.session import ensure_checkpoint_dir, pin_table

WORD_BPE = EncoderSpec(public_tokenizers.path("word_bpe_49k.json"))
BYTE_BPE = EncoderSpec(public_tokenizers.path("byte_bpe_50k.json"))
BYTE_BPE_TEXT = EncoderSpec(BYTE_BPE.path, special_as_text=True)
PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = EncoderSpec(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/id-shards-{uuid.uuid4().hex}"
    id_shards.write_id_shards(table(spark, sf_dir, "documents"), WORD_BPE, path)
    read = id_shards.read_id_shards(spark, path)
    return read.select(F.col("key").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def _sha256(column: Column) -> Column:
    return F.sha2(column, 256)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_RANKS, offsets_digest=True).drop("text")
    ids = F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary")
    digested = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "n_split", "offsets_crc32", _sha256(ids).alias("ids_sha256"), "ids")
    kept = ["doc_id", "n_tokens", "ids_sha256", "n_split", "offsets_crc32"]
    decoded = byte_bpe.decode(digested, BYTE_RANKS.path, keep=kept)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", _sha256(F.col("decoded")).alias("decoded_sha256"), "n_split", "offsets_crc32")


def op2_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)
    return counted.withColumn("over_limit", F.col("n_tokens") > 512)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per line with a word, with the first line of its class."""
    edits, near_bytes, exact_bytes = line_dedup.EVERY_LINE
    classes = line_dedup.line_classes(table(spark, sf_dir, "documents"), edits=edits, near_bytes=near_bytes, exact_bytes=exact_bytes)
    return classes.select("doc_id", "line_no", "n_links", F.col("first_id").alias("class_doc_id"), F.col("first_line_no").alias("class_line_no"), "kept")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
    return sharded.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    screened = quality.screen(table(spark, sf_dir, "documents"), measured=measured)
    failed = quality.cascade(quality.BASE_RULES, F.col).isNotNull()
    return screened.select("doc_id", *measured, failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))


def words_joined(text: Column) -> Column:
    """The words of a text (runs of anything but ASCII white space) joined by one space."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "))


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring.remove_repeated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_words", "n_removed", _sha256(words_joined(F.col("text")).cast("binary")).alias("kept_sha256"))


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and members of the rebuilt conversations: the first h turns of
    conversation c - c % 100, then c's own turns after its first h."""
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = pin_table(convs.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 100, "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6}), "convs")
    bases = convs.where("conv_id = base").select("base", F.col("n").alias("n_base"))
    heads = turns.where("pos < 5 AND conv_id % 100 = 0").withColumnRenamed("conv_id", "base")
    led = convs.where("h > 0").select("conv_id", "base", "h").join(heads, "base").where("pos < h").select("conv_id", "pos", "id", "chars")
    own = turns.withColumns({"base": F.col("conv_id") - F.col("conv_id") % 100, "h": F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6}).where("pos >= h").join(bases, "base", "left")
    place = F.col("pos") - F.col("h") + F.least("h", F.coalesce("n_base", F.lit(0).cast("long")))
    return led.unionAll(own.select("conv_id", place.alias("pos"), "id", "chars")), convs.select("conv_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(*rebuilt(prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), BYTE_BPE_TEXT, PIECES)


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    found = warc.records(warc.read_chunks(spark, path, with_data=False))
    return found.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_holds")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_pivot_index": op2_pivot_index,
    "op3_id_shards": op3_id_shards,
    "op4_token_counts": op4_token_counts,
    "op5_line_dedup": op5_line_dedup,
    "op6_simhash": op6_simhash,
    "op7_sharding": op7_sharding,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_quality": op9_quality,
    "op10_substring": op10_substring,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_alignment": op12_alignment,
    "op13_warc": op13_warc,
}

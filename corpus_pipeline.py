"""A corpus pipeline of five stages over ``documents``.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet under the shared checkpoint folder
and reads it again as the next stage's documents; the last one stays there. All stages but the last
return the columns of ``documents``; ``n_chars`` follows a text that changes.

1. quality_rules: documents that a rule rejects go, none for its length.
2. line_dedup: in each class of equal or nearly equal lines the first line of
   the corpus stays; a document whose every line with content went goes too.
3. simhash_near_dedup: of the documents that link at four bits or fewer, the
   one with the smallest id stays.
4. substring_dedup: passages of 20 words or more that start earlier go; a
   document that has no word left goes too.
5. packing: the texts as pieces of 2048-token sequences.

Documents that lose nothing keep their text byte for byte. A null id is kept
by every stage that keeps its text (by stage 3 if no other id is in its group).
An empty table gives empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from amphora.llm import line_dedup, packing, quality, queries, simhash, substring
from amphora.session import dropping_pins, pin_table, scratch_path
from amphora.sources.files import remove_folder

#: SQL has neither the fingerprints of stage 3 nor the token ids of stage 5;
#: tests hold the pipeline against a plain Python version.
ORACLE_SQL = None


def _with_length(docs: DataFrame, columns: list[str]) -> DataFrame:
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length("text").cast(kind)).select(*columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.screen(docs).where("rejected_by IS NULL").select(*docs.columns)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup.drop_repeated_lines(docs)
    return _with_length(cut.where("n_removed_lines = 0 OR n_left_lines > 0"), docs.columns)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The groups are found by row, so that rows which share an id are rows of their own.
    rows = pin_table(docs.withColumn("row_of_pipeline", F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", F.monotonically_increasing_id().alias("place"))), "simhash-rows")
    found = simhash.simhash_components(rows, id_col="row_of_pipeline")
    kept = found.where(F.col("row_of_pipeline") == F.col("component_id")).select("row_of_pipeline")
    return rows.join(kept, "row_of_pipeline", "left_semi").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = substring.remove_repeated(docs)
    return _with_length(cut.where("n_removed = 0 OR n_removed < n_words"), docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = packing.pack(docs, queries.WORD_BPE)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", deduplicate_lines),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        # What a stage pinned on its way goes when its result is written, and
        # the result before it with that.
        with dropping_pins(spark):
            out, path = stage(spark, docs, sf_dir), scratch_path(spark, f"pipeline-{name}")
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove_folder(spark, before)
        before = path
    return docs

"""FASTA and peptide CSV sources (S3-S5) and result tables."""

from __future__ import annotations

import csv
import json
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amphora.sources.files import list_files, publish_text, read_small_text


def _fasta_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Header and sequence of raw records, which come in the order of a file.
    Only the first record of a file can be without a header."""
    before = None
    for batch in batches:
        if not batch.num_rows:
            continue
        files, begins = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("at", "begins"))
        first = np.append(True, (files[1:] != files[:-1]) | (begins[1:] != begins[:-1]))
        first[0] = before != (files[0], begins[0])
        before = (files[-1], begins[-1])
        value = pc.replace_substring(batch.column("value"), "\r", "")
        parts = pc.split_pattern(value, "\n", max_splits=1)
        starts = parts.offsets.to_numpy()
        flat, starts, two = parts.values, starts[:-1], np.diff(starts) == 2
        line = pc.utf8_trim(flat.take(pa.array(starts)), " ")
        bare = first & begins & ~pc.starts_with(line, ">").to_numpy(zero_copy_only=False)
        body = pc.if_else(pa.array(two), flat.take(pa.array(starts + two)), "")
        body = pc.replace_substring_regex(pc.if_else(pa.array(bare), value, body), r"[\s\x0b]+", "")
        header = pc.if_else(pa.array(bare), "", pc.replace_substring_regex(line, "^>", ""))
        out = pa.RecordBatch.from_arrays([batch.column("file"), header.cast(pa.string()), body.cast(pa.string())], names=["file", "header", "sequence"])
        yield out.filter(pc.greater(pc.binary_length(body), 0))


def read_fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """S3: ``(file, header, sequence)``, one row per record.

    Records are read with the record separator ``\\n>`` so the reader stays
    splittable, never assembles a file on the driver, and is one scan. The
    first line of a record is its header; body lines are stripped of blanks
    and concatenated. Text before the first '>' of a file (the record at
    offset 0 that does not start with '>') is a record without header: all of
    its lines are body, so a file without any '>' is one sequence. The pass
    over a split's records knows which one that is, as they come in order.
    Records without body are dropped. Files of one sequence per line are read
    with ``read_sequence_lines``."""
    paths = [path] if isinstance(path, str) else list(path)
    meta = F.col("_metadata")
    raw = spark.read.option("lineSep", "\n>").text(paths).select(
        F.xxhash64(meta["file_path"]).alias("at"), (meta["file_block_start"] == 0).alias("begins"), meta["file_name"].alias("file"), "value")
    return raw.mapInArrow(_fasta_records, "file string, header string, sequence string")


def read_sequence_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One sequence per line, no headers: ``(file, sequence)``."""
    paths = [path] if isinstance(path, str) else list(path)
    raw = spark.read.text(paths)
    return raw.select(F.col("_metadata.file_name").alias("file"),
                      F.regexp_replace("value", r"\s+", "").alias("sequence")).where(
        F.length("sequence") > 0)


def read_apd(spark: SparkSession, paths: Sequence[str], source: str = "APD6") -> DataFrame:
    """FASTA corpora appended in the given order, tagged with ``source``;
    ``file_order`` keeps the order of the inputs."""
    out = None
    for i, p in enumerate(paths):
        part = read_fasta(spark, p).select("sequence", F.lit(source).alias("source"),
                                           F.lit(i).alias("file_order"))
        out = part if out is None else out.unionByName(part)
    return out


def csv_headers(spark: SparkSession, files: Sequence[str]) -> list[tuple[str, list[str]]]:
    """Each file's path and the names of its columns, from one job over the
    first lines (of every file one line comes to the driver)."""
    lines = spark.read.text(list(files)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"), "value")
    first = lines.where("start = 0").groupBy("path").agg(F.min_by("value", "at").alias("line"))
    return [(r["path"], next(csv.reader([r["line"].removeprefix("\ufeff")]), [])) for r in first.collect()]


def read_peptide_csvs(spark: SparkSession, path: str, source: str = "DBAASP",
                      column: str = "SEQUENCE") -> DataFrame:
    """All CSV files matching ``path`` (each with its own header row),
    united by column name like a pandas concat: only ``column`` is kept,
    renamed to ``sequence`` and tagged; null and empty sequences dropped
    (P10). No file at all gives an empty table with the schema; a file
    without the column raises and is named.

    One job reads the files' headers. The rows are one scan of all files by
    position (Spark drops every file's header line), from which each file's
    own place of the column is taken."""
    files = list_files(spark, path)
    if not files:
        return spark.createDataFrame([], "sequence string, source string")
    headers = csv_headers(spark, files)
    lacking = sorted(p for p, names in headers if column not in names)
    if lacking or len(headers) < len(files):
        raise ValueError(f"no column {column} in {', '.join(lacking) or 'an empty file'}")
    width = max(len(names) for _, names in headers)
    rows = spark.read.schema(", ".join(f"c{i} string" for i in range(width))).option("header", True).option("enforceSchema", True).option("escape", "\"").csv(files)
    places = {p: names.index(column) for p, names in headers}
    if len(set(places.values())) == 1:
        found = rows.select(F.col(f"c{next(iter(places.values()))}").alias("sequence"))
    else:
        own = spark.createDataFrame(list(places.items()), "path string, place int")  # a row for each file
        cells = F.array(*[F.col(f"c{i}") for i in range(width)])
        found = rows.select(F.col("_metadata.file_path").alias("path"), cells.alias("cells")).join(own, "path").select(
            F.get("cells", F.col("place")).alias("sequence"))
    return found.select("sequence", F.lit(source).alias("source")).where(F.col("sequence").isNotNull() & (F.col("sequence") != ""))


SCREENING_SCHEMA = T.StructType([
    T.StructField("protein", T.StringType()), T.StructField("accession_id", T.StringType()),
    T.StructField("enzyme", T.StringType()), T.StructField("min_length", T.IntegerType()),
    T.StructField("max_length", T.IntegerType()), T.StructField("num_peptides", T.LongType()),
    T.StructField("max_score", T.IntegerType()), T.StructField("top_peptide", T.StringType()),
    T.StructField("num_score_ge_3", T.LongType()), T.StructField("num_score_ge_4", T.LongType()),
    T.StructField("avg_score", T.DoubleType()), T.StructField("rank", T.LongType()),
])


def write_results(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Write a ranked table (csv with header, or parquet). Keep the
    ``rank`` column: row order is not a property of a distributed file set."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def read_results(spark: SparkSession, path: str, schema: T.StructType = SCREENING_SCHEMA,
                 fmt: str = "csv") -> DataFrame:
    """Read a saved table back with a declared schema (no inference)."""
    if fmt == "csv":
        return spark.read.schema(schema).option("header", True).csv(path)
    return spark.read.schema(schema).format(fmt).load(path)


def publish_results(df: DataFrame, path: str, order: Sequence[str] = ("rank",)) -> None:
    """S6 for readers that must not see a part: the table is written in the
    order of its rank (range-partitioned, so files follow one another) to a
    folder of its own under ``path``, and a manifest that names the folder and
    the schema is put in place when all of it is there. Earlier results stay
    until somebody removes them, so readers of them are not cut off."""
    spark, folder = df.sparkSession, f"results-{uuid.uuid4().hex}"
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(f"{path}/{folder}")
    publish_text(spark, f"{path}/manifest.json", json.dumps({"folder": folder, "schema": df.schema.jsonValue()}))


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The results that the manifest names, with their declared schema."""
    told = json.loads(read_small_text(spark, f"{path}/manifest.json"))
    return spark.read.schema(T.StructType.fromJson(told["schema"])).parquet(f"{path}/{told['folder']}")


def save_embeddings(df: DataFrame, path: str, partition: str = "split") -> None:
    """Vectors as ARRAY<FLOAT/DOUBLE> in parquet, partitioned by split."""
    df.write.mode("overwrite").partitionBy(partition).parquet(path)


def load_embeddings(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """Partition pruning on ``split`` when given."""
    df = spark.read.parquet(path)
    return df.where(F.col("split") == split) if split else df

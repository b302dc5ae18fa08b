"""Names and small files of any store that Spark reaches, through Hadoop's
file systems on the driver; no table's rows pass here."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files that match ``pattern``."""
    fs, at = _file_system(spark, pattern)
    return sorted(str(s.getPath().toString()) for s in (fs.globStatus(at) or []) if s.isFile())


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path``; none if it is not there."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(at) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in place in one step: readers see the old one or the
    new one, never a part."""
    sc, jvm = spark.sparkContext, spark.sparkContext._jvm
    fs, at = _file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{path}.draft")
    out = fs.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = sc._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), sc._jsc.hadoopConfiguration()).rename(draft, at, options)


def read_small_text(spark: SparkSession, path: str) -> str:
    return spark.read.option("wholetext", True).text(path).first()[0]

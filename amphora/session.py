"""Session helpers: building a session for tests and benches, the checkpoint
folder, and spreading under-split inputs before row-multiplying generators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from amphora.sources.files import remove_folder


def get_spark(
    app: str = "amphora",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Session for local runs (tests, bench). On a cluster, pass the session
    the platform gives you to the operators instead."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("AMPHORA_DRIVER_MEMORY", "16g"))
        # Checkpoints pin ranked/running results; drop them once unreferenced.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # The given tables are single-split files; see ``spread``.
        .config("spark.amphora.inputPartitions", str(8 * int(cpus)))
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``. Where nothing is configured, a session with a
    ``local`` master gets a fresh scratch folder (driver and executors are one
    process there); any other master raises, because a folder of one machine
    could not be read by the others."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception as err:  # noqa: BLE001 - Spark Connect: the server owns the context
        if configured:
            return configured
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share") from err
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="amphora-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder's name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Folders that ``pin_table`` has made inside ``dropping_pins``.
_MADE: ContextVar[list[str] | None] = ContextVar("_MADE", default=None)


@contextmanager
def dropping_pins(spark: SparkSession) -> Iterator[None]:
    """Remove, at the end of the block, every table that operators pinned
    inside it. Use it around a job that writes its own result: a frame that
    still reads pinned tables must be written before the block ends. Frames
    from before the block keep theirs."""
    made: list[str] = []
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
        for path in made:
            remove_folder(spark, path)


def pin_table(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return a reader of it: cuts lineage, survives lost executors, keeps column
    pruning, and gives every later branch the same rows."""
    path = scratch_path(df.sparkSession, name)
    if (made := _MADE.get()) is not None:
        made.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt round robin into ``spark.amphora.inputPartitions``
    partitions, or ``df`` itself where that is not set.

    The generators turn one sequence row into hundreds of peptide rows, so an
    input of a single split would be one task. A large input has splits enough
    and needs no shuffle of its text; whoever runs a small one (tests, bench)
    sets the number. The plan depends on that setting alone, and building it
    starts no job."""
    wanted = df.sparkSession.conf.get("spark.amphora.inputPartitions", None)
    return df.repartition(int(wanted)) if wanted else df

"""Action values maintained by a Structured Streaming query.

State is one row per action (count and reward sum), so no watermark is
needed and the state store stays tiny however long the stream runs. The
sink is ``foreachBatch`` writing the complete result table of each epoch to
a folder of its own, ``epoch=<id>``: a replayed epoch writes the same folder
again, and a reader of the last complete one (it has ``_SUCCESS``) never sees
a table that is being written; progress is in the checkpoint location."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from amphora.session import ensure_checkpoint_dir


def running_action_values(log: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Streaming-safe aggregate: n, reward sum and mean per action."""
    return log.groupBy(*keys, "action_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("reward").alias("reward_sum"),
        F.avg("reward").alias("value"),
    )


def read_action_values(spark: SparkSession, out_path: str) -> DataFrame:
    """The table of the last epoch that was written completely."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{out_path}/epoch=*/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path) or []
    epochs = [int(f.getPath().getParent().getName().split("=")[1]) for f in found]
    if not epochs:
        raise FileNotFoundError(f"no epoch has been written to {out_path}")
    return spark.read.parquet(f"{out_path}/epoch={max(epochs)}")


def stream_action_values(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    to_log: Callable[[DataFrame], DataFrame],
    out_path: str | None = None,
    checkpoint_path: str | None = None,
    available_now: bool = True,
    keys: tuple[str, ...] = (),
    glob: str | None = None,
):
    """Start the query over parquet files arriving under the folder
    ``source_path`` (only names matching ``glob`` when given).
    With ``available_now`` it processes everything present and stops, and
    the result table is returned as a batch DataFrame; otherwise the running
    ``StreamingQuery`` is returned."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    tag = uuid.uuid4().hex
    out_path = out_path or f"{base}/stream-action-values-{tag}/table"
    checkpoint_path = checkpoint_path or f"{base}/stream-action-values-{tag}/checkpoint"
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.parquet(source_path)
    agg = running_action_values(to_log(stream), keys)

    def write_epoch(batch: DataFrame, epoch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out_path}/epoch={epoch_id}")

    writer = (
        agg.writeStream.outputMode("complete")
        .foreachBatch(write_epoch)
        .option("checkpointLocation", checkpoint_path)
    )
    if not available_now:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return read_action_values(spark, out_path)

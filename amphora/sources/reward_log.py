"""Reward logs: ``reward_log(run_id, episode, step, action_id, reward)``.

The driver's ``events`` table stands in for a log of real trials: a user is
a run, a UTC day an episode, the event time (microseconds) the step, the
event type the action and ``value`` the reward; ``event_id`` tells steps of the
same time apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.LongType()),
        T.StructField("episode", T.IntegerType()),
        T.StructField("step", T.LongType()),
        T.StructField("action_id", T.StringType()),
        T.StructField("reward", T.DoubleType()),
    ]
)


def reward_log_from_events(events: DataFrame) -> DataFrame:
    # ts is TIMESTAMP_NTZ: date and micros are taken without any time zone.
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return events.select(
        F.col("user_id").alias("run_id"),
        F.unix_date(F.to_date("ts")).alias("episode"),
        micros.alias("step"),
        F.col("event_type").alias("action_id"),
        F.col("value").alias("reward"),
        "event_id",
    )


REWARD_LOG_SQL = """
    SELECT user_id AS run_id,
           (CAST(ts AS DATE) - DATE '1970-01-01')::INTEGER AS episode,
           epoch_us(ts) AS step,
           event_type AS action_id,
           value AS reward,
           event_id
    FROM events"""

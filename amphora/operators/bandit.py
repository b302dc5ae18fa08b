"""Reward-log analytics of the epsilon-greedy enzyme-combination search
(A10-A12, W1-W6, J5, B1-B3).

The interactive agent/environment loop is a simulator; what it produces is a
log ``reward_log(run_id, episode, step, action_id, reward)``, and every
quantity the loop tracks is a function of that log: the incremental mean
update is exactly the running mean, epsilon after n updates is a closed
form, the best action is an argmax with lowest-id ties. Steps of a run that
have the same number follow one another by ``event_id``, if the log has it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amphora import fixed
from amphora.functions.hashing import uniform01, uniform_int
from amphora.operators.ranking import top_k_within
from amphora.operators.running import running

LOG_ORDER = ("episode", "step")


def _order(log: DataFrame, first: Sequence[str] = LOG_ORDER) -> list[Column]:
    """The order of a log's rows; ``event_id`` makes it total."""
    return [F.col(c).asc() for c in (*first, "event_id") if c in (*first, *log.columns)]


def action_values(log: DataFrame, action_ids: Sequence | None = None,
                  keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """A10: n and mean reward per action (partial aggregation). With the
    action space ``action_ids`` (plan-time list, e.g. the combination ids)
    untried actions appear with n=0 and value 0.0, as the agent initialises
    them; the grid is a Generate per run, not a join."""
    vals = log.groupBy(*keys, "action_id").agg(
        F.count(F.lit(1)).alias("n"), F.avg("reward").alias("value")
    )
    if action_ids is None:
        return vals
    grid = log.select(*keys).distinct().withColumn(
        "action_id", F.explode(F.array(*[F.lit(a) for a in action_ids]))
    )
    return grid.join(vals, [*keys, "action_id"], "left").select(
        *keys, "action_id", F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("value", F.lit(0.0)).alias("value"),
    )


def episode_rewards(log: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Total reward per episode."""
    return log.groupBy(*keys, "episode").agg(
        F.sum("reward").alias("total_reward"), F.count(F.lit(1)).alias("steps")
    )


def best_action(values: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Argmax of value per run, lowest action id on ties."""
    return _best_action(values, keys)


def _best_action(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    # One pass: a run has one row per action, so the run-partitioned window
    # is bounded by the number of actions.
    w = Window.partitionBy(*keys).orderBy(F.col("value").desc(), F.col("action_id").asc())
    return values.select(*keys, F.col("value").alias("best_value"),
                         F.col("action_id").alias("best_action"),
                         F.row_number().over(w).alias("_r")).where("_r = 1").drop("_r")


def moving_average(rewards: DataFrame, window: int = 10, keys: Sequence[str] = ("run_id",),
                   value: str = "total_reward") -> DataFrame:
    """Trailing mean over ``window`` episodes, only full windows. A run
    has one row per episode here (after A11), so a run-partitioned window is
    bounded by the number of episodes."""
    w = Window.partitionBy(*keys).orderBy("episode").rowsBetween(-(window - 1), 0)
    return rewards.select(
        *keys, "episode", value,
        F.avg(value).over(w).alias("moving_avg"), F.count(F.lit(1)).over(w).alias("_n"),
    ).where(F.col("_n") == window).drop("_n")


def value_trajectory(log: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """The action's value estimate after each step (running mean per
    run and action), without a per-action single-task window. A step without
    a reward counts in ``n`` and leaves the mean alone (as in A10); the value
    is null until the first reward."""
    out = running(
        log, _order(log),
        {"cum_reward": ("sum", F.col("reward")), "n": ("sum", F.lit(1).cast("bigint")),
         "n_rewards": ("sum", F.col("reward").isNotNull().cast("bigint"))},
        keys=[*keys, "action_id"],
    )
    return out.withColumn("value", F.try_divide("cum_reward", "n_rewards")).drop("cum_reward", "n_rewards")


def epsilon_schedule(log: DataFrame, keys: Sequence[str] = ("run_id",),
                     start: float = fixed.EPSILON_START, floor: float = fixed.EPSILON_MIN,
                     decay: float = fixed.EPSILON_DECAY) -> DataFrame:
    """Epsilon after each update: max(floor, start * decay^n), n = number
    of updates so far in the run (a distributed running count)."""
    out = running(log, _order(log), {"n_updates": ("sum", F.lit(1).cast("bigint"))}, keys=list(keys))
    return out.withColumn(
        "epsilon", F.greatest(F.lit(floor), F.lit(start) * F.pow(F.lit(decay), F.col("n_updates")))
    )


def epsilon_after(n: Column | int, start: float = fixed.EPSILON_START,
                  floor: float = fixed.EPSILON_MIN, decay: float = fixed.EPSILON_DECAY) -> Column:
    """W3 closed form for a given number of updates."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.greatest(F.lit(floor), F.lit(start) * F.pow(F.lit(decay), n))


def best_so_far(log: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Running maximum reward inside each episode."""
    return running(log, _order(log, ["step"]), {"best_so_far": ("max", F.col("reward"))},
                   keys=[*keys, "episode"])


def rank_actions(values: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """Rank 1..n by value (desc), ties by action id, marker on the best.
    A run has one row per action, so the window is bounded by the number of
    actions."""
    w = Window.partitionBy(*keys).orderBy(F.col("value").desc(), F.col("action_id").asc())
    ranked = values.withColumn("rank", F.row_number().over(w))
    return ranked.withColumn("is_best", F.col("rank") == 1)


def reward_history(log: DataFrame, keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """The episode's history as ordered rows with a 1-based step index
    (a distributed running count, not a collected list)."""
    return running(log, _order(log, ["step"]), {"step_index": ("sum", F.lit(1).cast("bigint"))},
                   keys=[*keys, "episode"])


def label_actions(values: DataFrame, actions: DataFrame) -> DataFrame:
    """Attach action labels by id (equi join; the actions dimension is
    small and Spark's size-checked broadcast picks it up)."""
    return values.join(actions, "action_id", "left")


def assign_actions(requests: DataFrame, values: DataFrame, epsilon: float | Column,
                   seed: int = 42, keys: Sequence[str] = ("run_id",),
                   request_id: str = "request_id", action_ids: Sequence | None = None) -> DataFrame:
    """B1: epsilon-greedy assignment per request: with probability epsilon
    a uniformly random action, else the run's best action. Every request is
    answered. ``action_ids`` is the action space: exploration draws from all
    of it, and a run without history has its first action as the best one.
    Without it, the actions that a run has tried are its space, and a run
    without history gets a null action. Randomness is a hash of (request id,
    seed): reproducible on retries."""
    known = _greedy(values, keys)
    space = F.array(*[F.lit(a) for a in action_ids]) if action_ids is not None else F.col("_tried")
    eps = F.lit(epsilon) if not isinstance(epsilon, Column) else epsilon
    u = uniform01(F.col(request_id), F.lit(seed), F.lit("explore"))
    pick = uniform_int(F.greatest(F.size("_space"), F.lit(1)), F.col(request_id), F.lit(seed), F.lit("action"))
    default = F.lit(action_ids[0]) if action_ids else F.lit(None)
    return (
        requests.join(known, list(keys), "left")
        .select("*", space.alias("_space"), (u < eps).alias("explore"))
        .select(
            *[c for c in requests.columns],
            "explore",
            F.when(F.col("explore"), F.get("_space", pick.cast("int")))
            .otherwise(F.coalesce("best_action", default)).alias("action_id"),
        )
    )


def _greedy(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per run: its best action (lowest id on ties) and the sorted
    actions it has tried, in one aggregation."""
    tried = values.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "action_id"))).alias("_ranked"))
    return tried.select(*keys, F.get(F.col("_ranked"), F.lit(0))["action_id"].alias("best_action"),
                        F.array_sort(F.array_distinct(F.col("_ranked")["action_id"])).alias("_tried"))


def training_summary(log: DataFrame, actions: DataFrame | None = None,
                     keys: Sequence[str] = ("run_id",)) -> DataFrame:
    """B2: per run: episodes, total and mean episode reward, number of updates
    and final epsilon; the tried actions in order with their n and value; the
    best action, its value and, with ``actions`` (action_id, label), its label.

    The values are one aggregate over the table of A10, which has one row per
    run and action; the lowest action id wins ties, a value of null never does
    unless there is no other."""
    vals = action_values(log, keys=keys)
    row = F.struct("action_id", "n", "value")
    worse = F.struct(F.col("value").isNull(), -F.col("value"), F.col("action_id"))
    known = vals.groupBy(*keys).agg(
        F.min_by(row, worse).alias("_best"), F.array_sort(F.collect_list(row)).alias("_all"))
    best = known.select(
        *keys, F.col("_best.value").alias("best_value"), F.col("_best.action_id").alias("best_action"),
        F.col("_all.action_id").alias("actions"), F.col("_all.n").alias("action_n"), F.col("_all.value").alias("action_values"))
    if actions is not None:
        best = label_actions(best.withColumnRenamed("best_action", "action_id"),
                             actions.select("action_id", F.col("label").alias("best_label"))).withColumnRenamed("action_id", "best_action")
    eps = episode_rewards(log, keys).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_episodes"),
        F.sum("total_reward").alias("total_reward"),
        F.avg("total_reward").alias("mean_episode_reward"),
        F.sum("steps").alias("num_updates"),
    )
    return eps.join(best, list(keys)).withColumn("final_epsilon", epsilon_after(F.col("num_updates")))


def discovery_report(values: DataFrame, combos: DataFrame, candidates: DataFrame,
                     k: int = 5, keys: Sequence[str] = ("run_id",),
                     order: Sequence[Column] | None = None) -> DataFrame:
    """One table ``(*keys, section, rank, label, value, ph, temp)``:
    the recommended combination with its conditions, every combination
    ranked, and the top-k candidates (``candidates``: keys, sequence,
    probability; the best by ``order``, else by probability and sequence)."""
    ranked = rank_actions(values, keys).join(combos, "action_id", "left")
    # One pass over the ranked combinations: the best one is in both sections.
    sections = F.when(F.col("is_best"), F.array(F.lit("recommended"), F.lit("ranked"))).otherwise(F.array(F.lit("ranked")))
    combos_sec = ranked.select(*keys, F.explode(sections).alias("section"), "rank", "label", "value", "ph", "temp")
    order = order or (F.col("probability").desc(), F.col("sequence").asc())
    top = top_k_within(candidates, k, keys, order).select(
        *keys, F.lit("candidate").alias("section"), "rank", F.col("sequence").alias("label"),
        F.col("probability").alias("value"), F.lit(None).cast("array<double>").alias("ph"),
        F.lit(None).cast("array<int>").alias("temp"))
    return combos_sec.unionByName(top)

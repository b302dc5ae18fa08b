import math

from pyspark.sql import functions as F

from amphora.operators import bandit as B


def _log(spark):
    rows = []
    step = 0
    for i in range(100):
        rows.append(("r", i // 8, step, 0, 0.857)); step += 1
        rows.append(("r", i // 8, step, 1, 0.846)); step += 1
    return spark.createDataFrame(rows, "run_id string, episode int, step int, action_id int, reward double")


def test_agent_golden(spark):
    log = _log(spark)
    vals = {r.action_id: r for r in B.action_values(log, action_ids=range(8)).collect()}
    assert abs(vals[0].value - 0.857) < 1e-12 and abs(vals[1].value - 0.846) < 1e-12
    assert vals[0].n == 100 and vals[5].n == 0 and vals[5].value == 0.0
    best = B.best_action(B.action_values(log)).first()
    assert best.best_action == 0


def test_epsilon(spark):
    row = spark.range(1).select(B.epsilon_after(200).alias("e200"), B.epsilon_after(459).alias("e459"),
                                B.epsilon_after(460).alias("e460")).first()
    assert abs(row.e200 - 0.995 ** 200) < 1e-12 and abs(row.e200 - 0.367) < 1e-3
    assert row.e459 > 0.1 and row.e460 == 0.1
    assert math.ceil(math.log(0.1) / math.log(0.995)) == 460
    sched = B.epsilon_schedule(_log(spark)).orderBy("n_updates").collect()
    assert [r.n_updates for r in sched] == list(range(1, 201))


def test_value_trajectory_is_running_mean(spark):
    log = _log(spark)
    rows = B.value_trajectory(log).where("action_id = 0").orderBy("step").collect()
    assert [r.n for r in rows] == list(range(1, 101))
    assert all(abs(r.value - 0.857) < 1e-12 for r in rows)


def test_moving_average_full_windows(spark):
    ep = B.episode_rewards(_log(spark))
    ma = B.moving_average(ep, 10).orderBy("episode").collect()
    n_episodes = ep.count()
    assert len(ma) == n_episodes - 9 and ma[0].episode == 9


def test_rank_and_assign(spark):
    log = _log(spark)
    vals = B.action_values(log)
    ranked = B.rank_actions(vals).orderBy("rank").collect()
    assert [r.action_id for r in ranked] == [0, 1] and ranked[0].is_best
    req = spark.range(2000).select(F.col("id").alias("request_id"), F.lit("r").alias("run_id"))
    a1 = B.assign_actions(req, vals, 0.3, seed=7).orderBy("request_id").collect()
    a2 = B.assign_actions(req.repartition(7), vals, 0.3, seed=7).orderBy("request_id").collect()
    assert a1 == a2
    explore = sum(r.explore for r in a1) / len(a1)
    assert 0.25 < explore < 0.35
    assert all(r.action_id == 0 for r in a1 if not r.explore)

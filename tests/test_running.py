import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from amphora.operators.ranking import global_rank
from amphora.operators.running import in_order, running


def _data(spark, n=3000, seed=5):
    rng = random.Random(seed)
    # key 'hot' holds about a third of the rows
    rows = [("hot" if rng.random() < 0.34 else f"k{rng.randint(0, 40)}", i, rng.randint(-5, 9))
            for i in range(n)]
    return spark.createDataFrame(rows, "k string, t int, v int").repartition(13)


@pytest.mark.parametrize("hot", ["0", "100", "100000"])
def test_running_matches_window(spark, hot):
    """All keys are hot, one of them is, none is."""
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    spark.conf.set("spark.amphora.hotKeyRows", hot)
    df = _data(spark)
    got = running(df, [F.col("t").asc()], {"s": ("sum", F.col("v")), "m": ("max", F.col("v")),
                                           "lo": ("min", F.col("v"))}, keys=["k"])
    w = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", "t", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"),
                    F.min("v").over(w).alias("lo"))
    a = sorted(tuple(r) for r in got.select("k", "t", "s", "m", "lo").collect())
    b = sorted(tuple(r) for r in exp.collect())
    assert a == b
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.amphora.hotKeyRows")


def test_running_global(spark):
    df = _data(spark, 800)
    got = running(df, [F.col("t").asc()], {"c": ("sum", F.lit(1))})
    assert sorted(r.c for r in got.collect()) == list(range(1, 801))


def test_global_rank(spark):
    df = _data(spark, 1500)
    got = global_rank(df, [F.col("v").desc(), F.col("t").asc()])
    w = Window.orderBy(F.col("v").desc(), F.col("t").asc())
    exp = df.withColumn("rank", F.row_number().over(w))
    a = sorted((r.t, r.rank) for r in got.collect())
    b = sorted((r.t, r.rank) for r in exp.collect())
    assert a == b


def test_running_any_types_and_edges(spark):
    """Nulls, NaN, decimals, strings and null or NaN keys, against the plain window, over more partitions than keys."""
    rng = random.Random(11)
    kinds = [None, float("nan"), 0.5, 2.0]
    rows = [(rng.choice(kinds), rng.choice([None, "a"]), i, rng.choice([None, float("nan"), 1.5, -2.0, 7.25] if i % 7 else [None]),
             rng.choice([None, "x", "yy"]), rng.choice([None, 3, -4])) for i in range(2500)]
    spark.conf.set("spark.amphora.hotKeyRows", "300")
    df = spark.createDataFrame(rows, "f double, g string, t int, v double, s string, n int").withColumn("dec", F.col("n").cast("decimal(12,2)"))
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "70")
    try:
        aggs = {"sv": ("sum", F.col("v")), "mv": ("max", F.col("v")), "lv": ("min", F.col("v")), "ms": ("max", F.col("s")),
                "sd": ("sum", F.col("dec")), "sn": ("sum", F.col("n")), "ln": ("min", F.col("n")), "xn": ("xor", F.col("n").cast("long"))}
        got = running(df, [F.col("t").asc()], aggs, keys=["f", "g"])
        w = Window.partitionBy("f", "g").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
        fns = {"sum": F.sum, "max": F.max, "min": F.min, "xor": F.bit_xor}
        exp = df.select("*", *[fns[k](v).over(w).alias(n) for n, (k, v) in aggs.items()])
        assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in exp.schema]
        show = lambda d: sorted((r["t"], str([r[n] for n in aggs])) for r in d.collect())
        assert show(got) == show(exp)
        assert running(df.limit(0), [F.col("t").asc()], aggs, keys=["f"]).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.amphora.hotKeyRows")


def test_in_order_has_no_exchange_after_the_sort(spark):
    df = in_order(_data(spark), [F.col("t").asc()], {"s": ("sum", F.col("v"))}, keys=["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    rows_side = plan[: plan.index("BroadcastExchange")]  # what comes before is the side of the rows
    assert "BroadcastHashJoin" in plan and "Exchange" not in rows_side and "SortMergeJoin" not in plan


def test_running_of_ordinary_keys_is_one_shuffle(spark):
    df = running(_data(spark), [F.col("t").asc()], {"s": ("sum", F.col("v"))}, keys=["k"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "MapInArrow" not in plan

"""Dimension tables built from the fixed values: proteins, enzymes, combos."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from amphora import fixed

ENZYME_SCHEMA = T.StructType(
    [
        T.StructField("enzyme", T.StringType(), False),
        T.StructField("cleaves_after", T.ArrayType(T.StringType()), False),
        T.StructField("not_before", T.ArrayType(T.StringType()), False),
        T.StructField("cleaves_before", T.ArrayType(T.StringType()), False),
        T.StructField("ph_optimum", T.DoubleType(), False),
        T.StructField("temp_optimum_celsius", T.IntegerType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("food_grade", T.BooleanType(), False),
    ]
)

COMBO_SCHEMA = T.StructType(
    [
        T.StructField("action_id", T.IntegerType(), False),
        T.StructField("enzymes", T.ArrayType(T.StringType()), False),
        T.StructField("label", T.StringType(), False),
        T.StructField("ph", T.ArrayType(T.DoubleType()), False),
        T.StructField("temp", T.ArrayType(T.IntegerType()), False),
    ]
)


def proteins(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(fixed.PROTEINS), "protein string, accession_id string")


def enzymes(spark: SparkSession) -> DataFrame:
    rows = [
        (e.name, list(e.cleaves_after), list(e.not_before), list(e.cleaves_before),
         float(e.ph_optimum), int(e.temp_optimum_celsius), e.source, e.food_grade)
        for e in fixed.ENZYMES
    ]
    return spark.createDataFrame(rows, ENZYME_SCHEMA)


def combos(spark: SparkSession) -> DataFrame:
    """P12 folded in: ``ph``/``temp`` are the conditions of each enzyme in
    combination order, always arrays (a single enzyme gives a 1-array)."""
    rows = []
    for c in fixed.COMBOS:
        rules = [fixed.ENZYME_BY_NAME[e] for e in c.enzymes]
        rows.append((c.action_id, list(c.enzymes), c.label,
                     [float(r.ph_optimum) for r in rules],
                     [int(r.temp_optimum_celsius) for r in rules]))
    return spark.createDataFrame(rows, COMBO_SCHEMA)

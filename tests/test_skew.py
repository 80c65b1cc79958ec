from pyspark.sql import functions as F

from tallymark.operators.skew import heavy_keys, per_key_totals

SCHEMA = "a int, b bigint, v double, field string, n int"


def test_complete_with_a_hot_key_nulls_and_nan(spark):
    rows = [(1, None, 0.1, "x", 0)] * 900 + [(i, i, float(i), None, 1) for i in range(100)] + [(None, 7, None, "", 2), (2, 7, float("nan"), "", 2)]
    got = {(r.field, r.key_value): (r.n, r.total) for r in per_key_totals(spark.createDataFrame(rows, SCHEMA), ["a", "b"], "v").collect()}
    assert got["a", 1] == (901, 91.0)
    assert got["a", None] == (1, None)
    assert got["b", 7] == (3, 7.0)
    assert got["b", None] == (900, 90.0)
    assert sum(n for (f, _), (n, _) in got.items() if f == "a") == len(rows)


def test_what_cannot_be_summed_is_counted(spark):
    rows = [(1, 1, v, "", 0) for v in (0.123456, 1e23, float("inf"), float("nan"), -1e25, None)]
    r = per_key_totals(spark.createDataFrame(rows, SCHEMA), ["a"], "v").first()
    assert (r.n, r.unsummed, r.total) == (6, 3, 1e23 + 0.123456)


def test_heavy_keys_leave_out_null(spark):
    rows = [(1, None, 1.0, "", 0)] * 60 + [(2, 5, 1.0, "", 0)] * 40
    got = {(r.field, r.key_value, r.share) for r in heavy_keys(spark.createDataFrame(rows, SCHEMA), {"a": 0.5, "b": 0.4}, "v").collect()}
    assert got == {("a", 1, 0.6), ("b", 5, 0.4)}


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert per_key_totals(df, ["a"], "v").count() == 0 and heavy_keys(df, {"a": 0.1}, "v").count() == 0


def test_states_are_combined_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("a"), F.col("id").cast("double").alias("v"))
    plan = per_key_totals(df, ["a"], "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_sum") >= 1 and plan.count("Exchange hashpartitioning") == 1

import math
import random
import re

from pyspark.sql import functions as F

from millrace.functions.measures import mean, not_finite, total
from millrace.operators.latest import latest_per_key, newest_first


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_settles_ties_and_missing_times(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "z"), ("a", 2, "y"), ("b", None, "n"), ("b", 0, "m"),
         ("c", None, "q"), (None, 5, "r")], "k string, at int, tie string")
    got = latest_per_key(df, ["k"], newest_first("at", ties=["tie"]))
    assert rows(got) == sorted([("a", 2, "y"), ("b", 0, "m"), ("c", None, "q"), (None, 5, "r")],
                               key=repr)


def test_latest_cuts_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("at"))
    text = plan(latest_per_key(df, ["k"], newest_first("at")))
    operators = re.findall(r"WindowGroupLimit|Exchange", text)
    assert operators == ["WindowGroupLimit", "Exchange", "WindowGroupLimit"]


def test_exact_sums(spark):
    random.seed(5)
    cents = [random.randint(-10_000_000, 10_000_000) for _ in range(2000)]
    values = [c / 100 for c in cents]
    df = spark.createDataFrame([(v,) for v in values + [None]], "v double")
    for parts in (1, 7):
        got = df.repartition(parts).agg(total("v").alias("t"), mean("v").alias("m")).first()
        assert got.t == sum(cents) / 100
        assert got.m == sum(cents) / 100 / 2000
    empty = df.where("false").agg(total("v").alias("t"), mean("v").alias("m")).first()
    assert (empty.t, empty.m) == (None, None)


def test_no_amount_is_left_out(spark):
    def of(*values):
        df = spark.createDataFrame([(v,) for v in values], "v double")
        return df.agg(total("v").alias("t"), not_finite("v").alias("n")).first()
    assert of(8e18, 8e18).t == 1.6e19
    assert of(9.5e18, 1.0, -9.5e18, 4e-7, None).t == 1.0
    assert of(-2.5e25, 2.5e25, -0.25).t == -0.25
    assert of(1e300, 1.0).t == 1e300
    assert math.isnan(of(1.0, float("nan")).t) and of(1.0, float("nan")).n == 1
    assert of(1.0, float("inf")) == (float("inf"), 1)

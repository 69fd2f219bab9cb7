"""A key, value or group holding a third of all rows must not land in one task,
and results must stay whole and exact."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from bikelake.operators.latest import latest_per_key
from bikelake.operators.quality import not_null, run_checks, unique
from bikelake.operators.rank import global_rank, range_sorted


def _skewed(spark, n=30000):
    # a third of the rows share the value 7 (and key -1), the rest are spread out
    return spark.range(0, n, numPartitions=6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 1000).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 97).alias("k"))


def test_range_sort_splits_hot_value(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")   # keep the raw partitioning visible
    try:
        df = _skewed(spark)
        sizes = [r["count"] for r in range_sorted(df, [F.col("v").asc()])
                 .groupBy(F.spark_partition_id().alias("p")).count().collect()]
        hot = [r["count"] for r in range_sorted(df, [F.col("v").asc()]).filter("v = 7")
               .groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    assert sum(sizes) == 30000
    assert len(hot) > 1 and max(sizes) < 30000 / 3          # the hot value is split


def test_rank_on_hot_value_is_a_permutation(spark):
    df = _skewed(spark)
    r = global_rank(df, [F.col("v").desc(), F.col("id").asc()], "r")
    expect = df.withColumn("r", F.row_number().over(Window.orderBy(F.col("v").desc(), F.col("id"))).cast("long"))
    assert sorted(map(tuple, r.collect())) == sorted(map(tuple, expect.collect()))


def test_latest_and_checks_on_hot_key(spark):
    df = _skewed(spark)
    got = {r["k"]: r["id"] for r in latest_per_key(df, ["k"], ["v", "id"]).collect()}
    assert got[-1] == 29997 and len(got) == 98
    agg = {r["k"]: r["id"] for r in latest_per_key(df, ["k"], ["v", "id"], method="aggregate").collect()}
    assert agg == got
    rep = {(r["column_name"], r["test"]): r["failures"]
           for r in run_checks(df, [unique("k"), not_null("v"), unique("id")], "t").collect()}
    assert rep == {("k", "unique"): 98, ("v", "not_null"): 0, ("id", "unique"): 0}

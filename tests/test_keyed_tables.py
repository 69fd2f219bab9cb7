"""Keyed tables in buckets: what a merge writes, NULL keys, schema growth, stops, pruning."""

import os
import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from bikelake.sinks.tables import (KEPT_VERSIONS, bucket_folders, merge_buckets, merge_frames, publish, rows_of_keys,
                                   switch_buckets, table_version, upsert)

COLS = "k string, ts long, v string"


def fresh():
    return f"kt_{uuid.uuid4().hex[:8]}", tempfile.mkdtemp(prefix="bl-kt-")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def on_disk(root, name):
    return {os.path.join(v, b) for v in os.listdir(f"{root}/{name}") for b in os.listdir(f"{root}/{name}/{v}")
            if b.startswith("_bucket=")}


def test_merge_writes_only_touched_buckets(spark):
    name, root = fresh()
    upsert(name, spark.createDataFrame([(f"k{i}", 1, "a") for i in range(400)], COLS), ["k"], root, buckets=16)
    before = bucket_folders(spark, name, root)
    assert len(before) == 16
    source = spark.createDataFrame([("k7", 2, "b"), ("new", 2, "b")], COLS)
    upsert(name, source, ["k"], root)
    after = bucket_folders(spark, name, root)
    moved = {b for b in after if after[b] != before[b]}
    assert 1 <= len(moved) <= 2                                   # two keys, at most two buckets written
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert len(got) == 401 and got["k7"] == "b" and got["new"] == "b" and got["k8"] == "a"
    assert rows(rows_of_keys(spark, name, root, ["k"], source.select("k"))) == rows(source)


def test_random_merges_equal_the_frame_form_and_old_folders_go(spark):
    rng, (name, root) = random.Random(4), fresh()
    want = spark.createDataFrame([], COLS)
    for step in range(7):
        keys = rng.sample([f"k{i}" for i in range(30)], rng.randrange(0, 9))
        source = spark.createDataFrame([(k, rng.randrange(5), f"s{step}") for k in keys], COLS)
        order = ["ts", "v"]
        want = spark.createDataFrame(merge_frames(want, source, ["k"], order).collect(), COLS)
        upsert(name, source, ["k"], root, order_desc=order, buckets=4)
        assert rows(spark.table(name)) == rows(want)
    named = {os.path.relpath(p, f"{root}/{name}") for p in bucket_folders(spark, name, root).values()}
    left = on_disk(root, name)
    assert named <= left and len(left) <= 4 * KEPT_VERSIONS       # the merge prunes by itself


def test_null_keys_insert_or_match(spark):
    a = [("x", 1, "a"), (None, 1, "a")]
    for mode, nulls in (("insert", 3), ("match", 1)):
        name, root = fresh()
        for ts in (1, 2, 3):
            upsert(name, spark.createDataFrame([(k, ts, f"{v}{ts}") for k, _, v in a], COLS), ["k"], root,
                   order_desc=["ts"], null_keys=mode)
        got = rows(spark.table(name))
        assert sum(r[0] is None for r in got) == nulls and ("x", 3, "a3") in got and (None, 3, "a3") in got
    with pytest.raises(ValueError, match="null_keys"):
        upsert("t", spark.createDataFrame(a, COLS), ["k"], "/tmp", null_keys="drop")


def test_stop_before_the_switch_leaves_the_old_version(spark):
    name, root = fresh()
    upsert(name, spark.createDataFrame([("a", 1, "old")], COLS), ["k"], root)
    new = spark.createDataFrame([("a", 2, "new"), ("b", 2, "new")], COLS)
    merge_buckets(name, new, ["k"], root)                         # written, never switched
    assert rows(spark.table(name)) == [("a", 1, "old")] and table_version(spark, name) == 1
    version, written, plan = merge_buckets(name, new, ["k"], root)
    assert rows(spark.read.parquet(*written.values())) == [("a", 2, "new"), ("b", 2, "new")]
    switch_buckets(spark, name, version, plan)
    assert rows(spark.table(name)) == [("a", 2, "new"), ("b", 2, "new")]


def test_new_column_empty_table_and_table_published_whole(spark):
    name, root = fresh()
    upsert(name, spark.createDataFrame([], COLS), ["k"], root)
    assert spark.table(name).columns == ["k", "ts", "v"] and spark.table(name).count() == 0
    upsert(name, spark.createDataFrame([("a", 1, "it's \\ \"q\"")], COLS), ["k"], root)
    upsert(name, spark.createDataFrame([("b", 1, "y", 2.5)], COLS + ", `x'y` double"), ["k"], root)
    assert rows(spark.table(name)) == [("a", 1, "it's \\ \"q\"", None), ("b", 1, "y", 2.5)]
    upsert(name, spark.createDataFrame([("a", 2, "z")], COLS), ["k"], root)
    assert rows(spark.table(name)) == [("a", 2, "z", None), ("b", 1, "y", 2.5)]
    whole, root = fresh()
    publish(spark.createDataFrame([("a", 1, "p"), ("c", 1, "p")], COLS), whole, root)
    upsert(whole, spark.createDataFrame([("a", 2, "u")], COLS), ["k"], root)
    upsert(whole, spark.createDataFrame([("d", 2, "u")], COLS), ["k"], root)
    assert rows(spark.table(whole)) == [("a", 2, "u"), ("c", 1, "p"), ("d", 2, "u")]


def test_two_key_columns(spark):
    name, root = fresh()
    one = spark.range(60).select((F.col("id") % 6).alias("a"), F.col("id").cast("string").alias("b"), F.lit(1).alias("v"))
    upsert(name, one, ["a", "b"], root)
    upsert(name, one.filter("id % 2 = 0").withColumn("v", F.lit(2)), ["a", "b"], root)
    assert spark.table(name).groupBy("v").count().orderBy("v").collect() == [(1, 30), (2, 30)]


def test_several_tasks_write_a_bucket(spark):
    """A bucket may outgrow a task: with more shuffle partitions than buckets it is cut into
    shares by key, and rows with a NULL key (a third here) by their values."""
    source = spark.range(6000).select(F.when(F.col("id") % 3 > 0, F.concat(F.lit("k"), "id")).alias("k"),
                                      F.col("id").alias("ts"), F.lit("a").alias("v"))
    again = source.filter("ts < 3000").withColumn("ts", F.col("ts") + 1).withColumn("v", F.lit("b"))
    settings = {"spark.sql.shuffle.partitions": "32", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for mode, nulls in (("insert", 3000), ("match", 1)):
            name, root = fresh()
            upsert(name, source, ["k"], root, order_desc=["ts"], null_keys=mode, source_unique=True, buckets=4)
            upsert(name, again, ["k"], root, order_desc=["ts"], null_keys=mode, source_unique=True)
            got = rows(spark.table(name))
            want = {k: (ts + 1, "b") if ts < 3000 else (ts, "a") for k, ts, _ in rows(source) if k}
            assert {r[0]: r[1:] for r in got if r[0]} == want and len(got) == 4000 + nulls
            sizes = [[spark.read.parquet(f"{d}/{f}").filter("k IS NULL" if mode == "insert" else "k IS NOT NULL").count()
                      for f in os.listdir(d) if f.endswith(".parquet")] for d in bucket_folders(spark, name, root).values()]
            assert all(len(s) > 1 for s in sizes)
            assert max(map(max, sizes)) < (1500 if mode == "insert" else 800)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)

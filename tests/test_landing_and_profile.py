"""Idempotent landing, quantiles by bracket selection, mergeable monthly state."""

import json
import math
import os
import random
import statistics
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bikelake.config import Config
from bikelake.operators.profile import _exact_quantiles, profile_describe
from bikelake.operators.trips import flow_of, flow_state, monthly_flow
from bikelake.plans.flows import TRIP_ARRIVALS, TRIP_DEPARTURES, run_history
from bikelake.sinks.landing import land_snapshots, read_landed


def test_landing_again_replaces(spark):
    base = tempfile.mkdtemp(prefix="bl-land-")
    schema = StructType([StructField("t", StringType()), StructField("v", LongType())])

    def land(rows, **kw):
        df = spark.createDataFrame(rows, "t string, v long").withColumn("t", F.to_timestamp("t"))
        land_snapshots(df, base, "t", **kw)
        return sorted(r.v for r in read_landed(spark, base, schema).collect())

    jan = [(f"2024-01-{d:02d} 10:00:00", d) for d in range(1, 6)]
    assert land(jan, snapshot="run-1") == [1, 2, 3, 4, 5]
    assert land(jan, snapshot="run-1") == [1, 2, 3, 4, 5]              # tried again
    assert land([("2024-01-02 00:00:00", 20)], snapshot="run-2") == [1, 2, 3, 4, 5, 20]
    assert land(jan[:2], snapshot="run-1") == [1, 2, 20]              # a shorter retry leaves nothing behind
    assert land([("2024-01-02 00:00:00", 30)]) == [1, 2, 20, 30]       # without a name: appended
    with pytest.raises(ValueError, match="file name"):
        land(jan, snapshot="../x")
    assert land([], snapshot="run-1") == [20, 30]


def test_landing_after_a_stop(spark, monkeypatch):
    from bikelake.sinks import landing
    base = tempfile.mkdtemp(prefix="bl-land-")
    schema = StructType([StructField("t", StringType()), StructField("v", LongType())])
    df = spark.createDataFrame([(f"2024-01-{d:02d} 10:00:00", d) for d in range(1, 9)], "t string, v long") \
        .withColumn("t", F.to_timestamp("t"))
    land_snapshots(df, base, "t", snapshot="s")
    # some files of a later run have moved, its manifest holds old and new names
    extra = f"{base}/year=2024/month=01/day=09"
    os.makedirs(extra)
    with open(f"{extra}/s-00000.json", "w") as f:
        f.write(json.dumps({"t": "2024-01-09T10:00:00.000000Z", "v": 9}))
    with open(f"{base}/_manifest/s/part-x.txt", "w") as f:
        f.write("year=2024/month=01/day=09/s-00000.json\n")
    land_snapshots(df, base, "t", snapshot="s")
    assert sorted(r.v for r in read_landed(spark, base, schema).collect()) == list(range(1, 9))


def quantile(values, q):
    p = q * (len(values) - 1)
    lo, hi = values[math.floor(p)], values[math.ceil(p)]
    return lo + (hi - lo) * (p - math.floor(p))


@pytest.mark.parametrize("bracket", [5, 200, 1_000_000])
def test_bracket_quantiles_are_exact(spark, bracket):
    rng = random.Random(bracket)
    columns = {"normal": [rng.gauss(0, 1) for _ in range(20_000)],
               "hot": [7.0 if rng.random() < 0.4 else rng.random() * 1e6 for _ in range(20_000)],
               "few": [float(rng.randrange(3)) for _ in range(20_000)],
               "wide": [10.0 ** rng.randrange(-300, 300) * rng.choice([-1, 1]) for _ in range(20_000)]}
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(6)
    got = _exact_quantiles(df, {c: 20_000 for c in columns}, max_bracket=bracket, accuracy=200)
    for c, v in columns.items():
        for q in (0.25, 0.5, 0.75):
            assert got[c, q] == quantile(sorted(v), q), (c, q)


def test_describe_of_odd_columns(spark):
    df = spark.createDataFrame([(1.0, None, float("nan"), 2), (3.0, None, 5.0, 2), (8.0, None, float("nan"), 2)],
                               "a double, none double, nan double, one int")
    got = {r.column_name: r for r in profile_describe(df, df.columns).collect()}
    assert (got["a"]["count"], got["a"].p25, got["a"].p50, got["a"].p75, got["a"].max) == (3, 2.0, 3.0, 5.5, 8.0)
    assert got["a"]["std"] == round(statistics.stdev([1.0, 3.0, 8.0]), 6)
    assert (got["none"]["count"], got["none"].p50, got["none"]["mean"]) == (0, None, None)
    assert (got["nan"]["count"], got["nan"].p50, got["nan"]["std"]) == (1, 5.0, None)
    assert got["one"].p25 == 2.0
    assert profile_describe(df.limit(0), ["a"]).first()["count"] == 0


def trips(rng, month, n=60):
    out = []
    for k in range(n):
        a, b = rng.choice(["5.10", "7", "", "9_"]), rng.choice(["5.1", "7", "8"])
        start = f"2024-{month:02d}-{rng.randrange(1, 28):02d} 23:50:00" if k else f"2024-{month:02d}-28 23:50:00"
        out.append((f"r{month}-{k}", "classic_bike", start, f"2024-{month + (k == 0):02d}-{'01' if k == 0 else start[8:10]} 23:59:00",
                    f"W {a} St", a, f"E {b} Ave", b, str(rng.random()), "-73.1", "40.2", str(rng.random()), "member"))
    return out


def put_csv(path, rows, reverse=False):
    head = ["ride_id", "rideable_type", "started_at", "ended_at", "start_station_name", "start_station_id", "end_station_name",
            "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng", "member_casual"]
    os.makedirs(path, exist_ok=True)
    order = -1 if reverse else 1
    with open(f"{path}/{uuid.uuid4().hex}.csv", "w") as f:
        f.write("".join(",".join(r[::order]) + "\n" for r in [head, *map(list, rows)]))


def test_history_reads_touched_months_only(spark):
    rng, cfg = random.Random(2), Config(f"mobility_m{uuid.uuid4().hex[:6]}", tempfile.mkdtemp(prefix="bl-hist-"))
    mapping = spark.createDataFrame([("5.1", "five", "Five"), ("7", "five", "Five")],
                                    "station_id string, canonical_station_key string, canonical_station_name string")

    def go():
        names = run_history(spark, cfg, mapping)
        rows = spark.table(names["silver"])
        want = monthly_flow(rows, rows, mapping, TRIP_DEPARTURES, TRIP_ARRIVALS)
        assert sorted(map(tuple, spark.table(names["flow"]).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        state = f"{cfg.data('gold', '_monthly_state')}/year=2024"
        return {m: sorted(os.listdir(f"{state}/{m}")) for m in sorted(os.listdir(state))}

    for m in (1, 2):
        put_csv(f"{cfg.landing('trips')}/year=2024/month={m:02d}", trips(rng, m))
    first = go()
    put_csv(f"{cfg.landing('trips')}/year=2024/month=02", trips(rng, 2, 5), reverse=True)   # another column order
    put_csv(f"{cfg.landing('trips')}/year=2024/month=03", trips(rng, 3))
    second = go()
    assert set(second) == {"month=1", "month=2", "month=3"}
    assert second["month=1"] == first["month=1"] and second["month=2"] != first["month=2"]
    assert go() == second                                              # nothing new: nothing written


def test_states_of_parts_unite(spark):
    rng = random.Random(8)
    rows = [(f"2024-0{rng.randrange(1, 4)}-05", rng.choice(["1", "2", " ", None]), rng.choice(["A", "B", None]), float(k % 7), float(k % 3)) for k in range(300)]
    df = spark.createDataFrame(rows, "ts string, id string, name string, lat double, lng double").withColumn("ts", F.to_timestamp("ts"))
    spec = dict(ts="ts", id="id", name="name", lat="lat", lng="lng")
    parts = [flow_state(p, p, spec, spec) for p in (df.limit(100), df.filter("lat > 3"))]
    one = flow_of(parts[0].unionByName(parts[1]), None)
    both = df.limit(100).unionByName(df.filter("lat > 3"))
    assert sorted(map(tuple, one.collect()), key=repr) == sorted(map(tuple, monthly_flow(both, both, None, spec, spec).collect()), key=repr)

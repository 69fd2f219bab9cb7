"""Operators on explicit fixtures (FIXTURES.md section 7) and equivalences."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from bikelake.operators.joins import assert_unique, join_coverage, lookup_join
from bikelake.operators.latest import latest_per_key
from bikelake.operators.profile import (conditional_counts, profile_describe, profile_keys,
                                        profile_nulls, snapshot_diff)
from bikelake.operators.quality import DataTestFailure, accepted, gate, not_null, run_checks, unique
from bikelake.operators.rank import global_rank
from bikelake.operators.stations import rebalancing_queue, station_health
from bikelake.operators.trips import hourly_demand, monthly_flow, monthly_flow_join, monthly_side


def _nkey(r):
    return tuple((x is None, x if x is not None else 0) for x in r)


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()] if order else sorted(
        (tuple(r) for r in df.collect()), key=_nkey)


# --- latest per key -------------------------------------------------------

LATEST = [
    ("a", 10, "f1", 1), ("a", 10, "f2", 2), ("a", 9, "f3", 3),           # same ts, file decides
    ("b", None, "f1", 4), ("b", 5, "f0", 5),                             # NULL ordering value loses
    ("c", None, None, 6),                                                # all-NULL row still returned
    (None, 1, "f1", 7), (None, 2, "f1", 8),                              # NULL key is one group
]


def test_latest_aggregate_equals_window(spark):
    df = spark.createDataFrame(LATEST, "k string, ts long, f string, v long")
    agg = latest_per_key(df, ["k"], ["ts", "f"])
    win = latest_per_key(df, ["k"], ["ts", "f"], method="window")
    assert rows(agg) == rows(win) == sorted(
        [("a", 10, "f2", 2), ("b", 5, "f0", 5), ("c", None, None, 6), (None, 2, "f1", 8)],
        key=_nkey)
    assert agg.columns == df.columns


# --- health and queue -----------------------------------------------------

STATION_COLS = ("station_id string, capacity long, num_bikes_available long, num_docks_available long, "
                "num_bikes_disabled long, num_docks_disabled long, is_installed int, is_renting int, "
                "is_returning int")
STATIONS = [
    ("oos_installed", 20, 5, 5, 1, None, 0, 1, 1),
    ("oos_both", 20, 5, 5, 0, 0, 1, 0, 0),
    ("renting0_only", 20, 5, 5, 0, 0, 1, 0, 1),        # not out of service
    ("no_bikes", 20, 0, 0, 0, 0, 1, 1, 1),             # bikes=0 and docks=0 -> NO_BIKES first
    ("no_docks", 20, 5, 0, 0, 0, 1, 1, 1),
    ("low_bikes_10", 20, 2, 18, 0, 0, 1, 1, 1),        # exactly 10.00
    ("low_bikes_round", 2499, 250, 1000, 0, 0, 1, 1, 1),  # 10.004 -> 10.0 after rounding
    ("low_docks", 40, 20, 3, 0, 0, 1, 1, 1),           # 7.5 %
    ("healthy", 20, 10, 10, 0, 0, 1, 1, 1),
    ("cap0", 0, 3, 3, 0, 0, 1, 1, 1),
    ("capnull", None, 3, 3, 0, 0, 1, 1, 1),
    ("no_status", 20, None, None, None, None, None, None, None),
]
EXPECTED_HEALTH = {
    "oos_installed": "OUT_OF_SERVICE", "oos_both": "OUT_OF_SERVICE", "renting0_only": "HEALTHY",
    "no_bikes": "NO_BIKES", "no_docks": "NO_DOCKS", "low_bikes_10": "LOW_BIKES",
    "low_bikes_round": "LOW_BIKES", "low_docks": "LOW_DOCKS", "healthy": "HEALTHY",
    "cap0": "HEALTHY", "capnull": "HEALTHY", "no_status": "HEALTHY",
}


QUEUE_TEST = ["priority_rank", "station_id", "capacity", "health_status", "priority_level", "priority_score",
              "recommended_action"]
HEALTH_TEST = ["station_id", "capacity", "num_bikes_available", "num_docks_available", "disabled_assets",
               "bike_availability_pct", "dock_availability_pct", "health_status"]


def test_station_health_classes(spark):
    h = station_health(spark.createDataFrame(STATIONS, STATION_COLS), columns=HEALTH_TEST)
    got = {r["station_id"]: r["health_status"] for r in h.collect()}
    assert got == EXPECTED_HEALTH
    d = {r["station_id"]: r for r in h.collect()}
    assert d["oos_installed"]["disabled_assets"] == 1
    assert d["low_bikes_round"]["bike_availability_pct"] == 10.0
    assert d["cap0"]["bike_availability_pct"] is None


def test_queue_scores_and_rank(spark):
    h = station_health(spark.createDataFrame(STATIONS, STATION_COLS), columns=HEALTH_TEST)
    q = rebalancing_queue(h, columns=QUEUE_TEST)
    got = [(r["priority_rank"], r["station_id"], r["priority_level"], r["priority_score"],
            r["recommended_action"]) for r in q.orderBy("priority_rank").collect()]
    assert got == [
        (1, "no_bikes", "CRITICAL", 100.0, "ADD_BIKES"),
        (2, "no_docks", "CRITICAL", 100.0, "REMOVE_BIKES"),
        (3, "oos_both", "HIGH", 95.0, "INVESTIGATE"),
        (4, "oos_installed", "HIGH", 95.0, "INVESTIGATE"),
        (5, "low_docks", "MEDIUM", 82.5, "REMOVE_BIKES"),
        (6, "low_bikes_round", "MEDIUM", 80.0, "ADD_BIKES"),   # tie on score: larger capacity first
        (7, "low_bikes_10", "MEDIUM", 80.0, "ADD_BIKES"),
    ]


def test_distributed_rank_equals_window(spark):
    df = spark.range(0, 5000, numPartitions=7).select(
        F.col("id"), (F.hash("id") % 97).alias("a"), (F.col("id") % 13).alias("b"))
    order = [F.col("a").desc(), F.col("b").asc(), F.col("id").asc()]
    dist = global_rank(df, order, "r")
    single = df.withColumn("r", F.row_number().over(Window.orderBy(*order)).cast("long"))
    assert rows(dist) == rows(single)
    assert dist.agg(F.min("r"), F.max("r"), F.count_distinct("r")).first() == (1, 5000, 5000)


# --- monthly flow ---------------------------------------------------------

TRIPS = [  # started, ended, start id, start name, s lat, s lng, end id, end name, e lat, e lng
    ("2024-01-31 23:50:00", "2024-02-01 00:10:00", "1.10", "A St", 1.0, 2.0, "2", "B St", 3.0, 4.0),
    ("2024-01-05 10:00:00", "2024-01-05 10:20:00", "1.1", "A Street", 1.5, 2.5, "9", "Z St", 9.0, 9.0),
    ("2024-01-05 11:00:00", "2024-01-05 11:20:00", " ", "blank", 0.0, 0.0, "2", "B St", 3.5, 4.5),
    ("2024-01-06 11:00:00", None, None, "null id", 0.0, 0.0, "3", "C St", 5.0, 6.0),   # NULL end time
    (None, "2024-01-07 08:00:00", "4", "D St", 7.0, 8.0, "1.1", "A St", 1.0, 2.0),     # NULL start time
    (None, "2024-01-08 08:00:00", "4", "D St", 7.0, 8.0, "", "blank end", 0.0, 0.0),
    ("2024-01-09 09:00:00", "2024-01-09 09:30:00", "5", None, None, None, "5", "E St", 5.0, 5.0),
]
TRIP_COLS = ("started_at string, ended_at string, start_station_id string, start_station_name string, "
             "start_lat double, start_lng double, end_station_id string, end_station_name string, "
             "end_lat double, end_lng double")
DEP = dict(ts="started_at", id="start_station_id", name="start_station_name", lat="start_lat", lng="start_lng")
ARR = dict(ts="ended_at", id="end_station_id", name="end_station_name", lat="end_lat", lng="end_lng")


def _trips(spark):
    df = spark.createDataFrame(TRIPS, TRIP_COLS)
    return df.withColumns({"started_at": F.col("started_at").cast("timestamp"),
                           "ended_at": F.col("ended_at").cast("timestamp")})


def _mapping(spark):
    return spark.createDataFrame([("1.1", "a_key", "A Canonical"), ("2", "b_key", "B Canonical")],
                                 "station_id string, canonical_station_key string, canonical_station_name string")


def test_monthly_flow_forms_agree(spark):
    t, m = _trips(spark), _mapping(spark)
    join_form = monthly_flow_join(monthly_side(t, "started_at", "start_station_id", "start_station_name",
                                               "start_lat", "start_lng", m, "departures"),
                                  monthly_side(t, "ended_at", "end_station_id", "end_station_name",
                                               "end_lat", "end_lng", m, "arrivals"))
    one_scan = monthly_flow(t, t, m, DEP, ARR)                       # same frame: explode form
    two_frames = monthly_flow(t, t.select("*"), m, DEP, ARR)        # union form
    a, b, c = rows(join_form), rows(one_scan), rows(two_frames)
    assert a == b == c
    # NULL-month groups of each side stay separate rows
    nulls = [r for r in a if r[1] is None]
    assert sorted((r[7], r[8]) for r in nulls) == [(0, 1), (2, 0)]


def test_monthly_flow_invariants(spark):
    t, m = _trips(spark), _mapping(spark)
    f = monthly_flow(t, t, m, DEP, ARR)
    tot = f.agg(F.sum("departures"), F.sum("arrivals")).first()
    # departures = rows with a non-blank start id, arrivals likewise
    assert tot == (5, 6)
    bad = f.filter((F.col("total_station_activity") != F.col("departures") + F.col("arrivals"))
                   | (F.col("net_flow") != F.col("arrivals") - F.col("departures"))).count()
    assert bad == 0
    jan_a = f.filter("station_month_key = '2024|01|a_key'").first()
    # "1.10" is not normalised here (that is Silver's job), so only "1.1" maps to a_key
    assert (jan_a["station_name"], jan_a["departures"], jan_a["arrivals"]) == ("A Canonical", 1, 1)


def test_hourly_demand_segments(spark):
    df = spark.createDataFrame([
        ("2024-01-01 08:10:00", "member", "classic_bike", 10.0),
        ("2024-01-01 08:20:00", "member", "classic_bike", 10.01),
        ("2024-01-01 08:30:00", "casual", "classic_bike", None),
        ("2024-01-01 08:40:00", "member", "electric_bike", 1.005),
    ], "started_at string, member_casual string, rideable_type string, ride_duration_minutes double")
    df = df.withColumn("started_at", F.col("started_at").cast("timestamp"))
    got = {(r["member_casual"], r["rideable_type"]): (r["total_trips"], r["avg_ride_duration_minutes"])
           for r in hourly_demand(df).collect()}
    assert got == {("member", "classic_bike"): (2, 10.01), ("casual", "classic_bike"): (1, None),
                   ("member", "electric_bike"): (1, 1.01)}


# --- joins, profile, quality -----------------------------------------------

def test_lookup_join_and_unique(spark):
    fact = spark.createDataFrame([("1",), ("2",), (None,)], "id string")
    dim = spark.createDataFrame([("1", "x")], "id string, k string")
    assert rows(lookup_join(fact, dim, "id")) == sorted(
        [("1", "x"), ("2", None), (None, None)], key=_nkey)
    assert rows(lookup_join(fact, dim, "id")) == rows(lookup_join(fact, dim, "id"))
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([("1",), ("1",)], "id string"), ["id"])
    assert_unique(spark.createDataFrame([(None,), (None,)], "id string"), ["id"])


def test_join_coverage_matches_materialised_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k long")
    right = spark.createDataFrame([(1, "a"), (1, None), (2, None), (4, "z"), (None, "n")],
                                  "k long, name string")
    cov = join_coverage(left, right, "k", "name").first().asDict()
    j = left.join(right, "k", "left")
    assert cov["left_rows"] == 5 and cov["right_rows"] == 5
    assert cov["joined_rows"] == j.count()
    assert cov["missing_after_join"] == j.filter(F.col("name").isNull()).count()
    assert cov["unmatched_left_rows"] == 2  # k=3 and the NULL key


def test_snapshot_diff_null_semantics(spark):
    old = spark.createDataFrame([(1, 5, 5), (2, 5, 5), (3, None, 1), (4, None, 1), (5, 1, 1)],
                                "id long, bikes long, docks long")
    new = spark.createDataFrame([(1, 5, 5), (2, 6, 5), (3, 2, 1), (4, None, 1), (6, 1, 1)],
                                "id long, bikes long, docks long")
    safe = [r["id"] for r in snapshot_diff(old, new, ["id"], ["bikes", "docks"]).collect()]
    sql = [r["id"] for r in snapshot_diff(old, new, ["id"], ["bikes", "docks"], null_safe=False).collect()]
    assert sorted(safe) == [2, 3] and sorted(sql) == [2]


def test_profiles(spark):
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", None), (2, None, 3.0), (None, "b", 4.0)],
                               "k long, s string, x double")
    nulls = {r["column_name"]: r["null_count"] for r in profile_nulls(df).collect()}
    assert nulls == {"k": 1, "s": 1, "x": 1}
    keys = profile_keys(df, ["k"]).first()
    assert (keys["row_count"], keys["distinct_keys"], keys["duplicate_rows"], keys["null_key_rows"]) == (4, 3, 1, 1)
    cc = conditional_counts(df, {"one": F.col("k") == 1, "big": F.col("x") > 2}).first()
    assert (cc["one"], cc["big"]) == (2, 2)


def test_describe_matches_pandas(spark):
    import pandas as pd
    vals = [3.5, 1.0, 7.25, 2.0, 2.0, 10.0, -4.5, 0.125, 9.0]
    df = spark.createDataFrame([(v,) for v in vals] + [(None,)], "x double")
    d = pd.Series(vals).describe()
    for exact in (True, False):
        r = profile_describe(df, ["x"], exact=exact).first()
        assert r["count"] == 9
        assert abs(r["mean"] - d["mean"]) < 1e-6 and abs(r["std"] - d["std"]) < 1e-6
        assert (r["min"], r["max"]) == (d["min"], d["max"])
        if exact:
            assert (r["p25"], r["p50"], r["p75"]) == (d["25%"], d["50%"], d["75%"])


def test_checks_and_gate(spark):
    df = spark.createDataFrame([(1, "member"), (1, "casual"), (2, "other"), (None, None)],
                               "id long, member_casual string")
    rep = run_checks(df, [not_null("id"), unique("id"), accepted("member_casual", ["member", "casual"])], "t")
    got = {(r["column_name"], r["test"]): r["failures"] for r in rep.collect()}
    assert got == {("id", "not_null"): 1, ("id", "unique"): 1, ("member_casual", "accepted_values"): 1}
    with pytest.raises(DataTestFailure):
        gate(rep)
    assert len(gate(rep, on_fail="warn")) == 3
    assert gate(run_checks(df.filter("id = 2"), [not_null("id")], "t")) == []



def test_describe_ignores_nan_and_unique_is_typed(spark):
    from bikelake.operators.quality import run_checks, unique
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (4.0,), (None,)], "v double")
    r = profile_describe(df, ["v"]).collect()[0]
    assert (r["count"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]) == (3, 1.0, 1.5, 2.0, 3.0, 4.0)
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.0,)], "v double")
    assert run_checks(zeros, [unique("v")]).collect()[0]["failures"] == 1


def test_strict_gold_columns_and_unique_mapping(spark):
    from bikelake.operators.trips import resolve_entity
    with pytest.raises(Exception):
        station_health(spark.createDataFrame(STATIONS, STATION_COLS))
    twice = spark.createDataFrame([("1", "a", "A"), ("1", "b", "B")],
                                  "station_id string, canonical_station_key string, canonical_station_name string")
    with pytest.raises(ValueError):
        resolve_entity(spark.createDataFrame([("1",)], "id string"), twice, "id")

"""Sinks, sources and streams on explicit fixtures: upsert semantics, versioned
publish, multi-line JSON snapshots with schema drift, incremental runs, rescue."""

import json
import os
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from bikelake.config import Config
from bikelake.operators.silver import latest_information, latest_status, silver_stations
from bikelake.sinks.landing import land_snapshots, read_landed
from bikelake.sinks.tables import merge_frames, publish, table_version, upsert
from bikelake.sources.files import feed_url, load_dim
from bikelake.sources.schemas import DISCOVERY, STATION_STATUS, infer_schema, with_rescued
from bikelake.streaming.ingest import ingest_snapshots
from bikelake.streaming.state import incremental_state


def _tmp():
    return tempfile.mkdtemp(prefix="bl-test-")


def _name(p):
    return f"t_{p}_{uuid.uuid4().hex[:8]}"


def _sorted(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x or 0) for x in r))


# --- upsert ------------------------------------------------------------------

def test_upsert_semantics(spark):
    root, name = _tmp(), _name("up")
    cols = "k string, v long"
    target = spark.createDataFrame([("same", 1), ("upd", 1), ("gone", 1), (None, 1)], cols)
    assert publish(target, name, root) == 1
    src = spark.createDataFrame([("same", 1), ("upd", 2), ("new", 3), (None, 9)], cols)
    upsert(name, src, ["k"], root)
    expect = [("gone", 1), ("new", 3), ("same", 1), ("upd", 2), (None, 1), (None, 9)]
    assert _sorted(spark.table(name)) == sorted(expect, key=lambda r: (r[0] is None, r[0] or "", r[1]))
    # second identical run: non-NULL keys unchanged, the NULL-key row is inserted again (MERGE semantics)
    upsert(name, src, ["k"], root)
    again = _sorted(spark.table(name))
    assert [r for r in again if r[0] is not None] == [r for r in expect if r[0] is not None]
    assert sum(1 for r in again if r[0] is None) == 3
    # empty source changes nothing
    before = _sorted(spark.table(name))
    upsert(name, spark.createDataFrame([], cols), ["k"], root)
    assert _sorted(spark.table(name)) == before
    assert table_version(spark, name) == 4


def test_upsert_rejects_duplicate_source_keys(spark):
    root, name = _tmp(), _name("dup")
    publish(spark.createDataFrame([("a", 1)], "k string, v long"), name, root)
    with pytest.raises(ValueError):
        upsert(name, spark.createDataFrame([("a", 1), ("a", 2)], "k string, v long"), ["k"], root)


def test_merge_with_order_guard_is_replay_safe(spark):
    t = spark.createDataFrame([("a", 5, "new"), ("b", 1, "old")], "k string, ts long, v string")
    s = spark.createDataFrame([("a", 3, "stale"), ("b", 2, "fresh"), ("c", 1, "ins")],
                              "k string, ts long, v string")
    once = merge_frames(t, s, ["k"], ["ts"])
    twice = merge_frames(once, s, ["k"], ["ts"])
    assert _sorted(once) == _sorted(twice) == [("a", 5, "new"), ("b", 2, "fresh"), ("c", 1, "ins")]


def test_publish_schema_change(spark):
    root, name = _tmp(), _name("sch")
    publish(spark.createDataFrame([(1,)], "a long"), name, root)
    publish(spark.createDataFrame([(1, "x")], "a long, b string"), name, root)
    assert spark.table(name).columns == ["a", "b"] and table_version(spark, name) == 2


# --- snapshots: multi-line JSON, drift, incremental --------------------------

def _doc(last_updated, stations, **extra):
    d = {"last_updated": last_updated, "ttl": 60, "version": "2.3", "data": {"stations": stations}}
    d.update(extra)
    return d


def _write(path, name, doc):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w") as f:
        json.dump(doc, f, indent=2)   # pretty-printed: one multi-line document per file


def test_snapshot_stream_incremental_and_drift(spark):
    base = _tmp()
    src, ckpt, out = f"{base}/in", f"{base}/ckpt", f"{base}/out"
    _write(src, "s1.json", _doc(100, [
        {"station_id": "1", "num_bikes_available": 3, "num_docks_available": 7, "is_installed": True,
         "is_renting": 1, "is_returning": 1, "last_reported": 90, "brand_new_field": "x"},
        {"station_id": "2", "num_bikes_available": "oops", "num_docks_available": 1,
         "is_installed": 1, "is_renting": 0, "is_returning": 0, "last_reported": 95}]))
    _write(src, "s2.json", {"last_updated": 101, "ttl": 60})               # missing data
    _write(src, "s3.json", _doc(102, []))                                 # empty stations
    def run():
        ingest_snapshots(spark, src, STATION_STATUS, ckpt, path=out)
        return spark.read.parquet(out)

    first = run()
    assert first.count() == 2                                             # explode drops s2, s3
    r = {x["station_id"]: x for x in first.collect()}
    assert r["1"]["is_installed"] == "true" and r["2"]["num_bikes_available"] is None
    assert r["1"]["_source_file"].endswith("s1.json") and r["1"]["last_updated"] == 100
    # unknown field and mistyped known field are rescued, not lost
    assert json.loads(r["1"]["_rescued_data"]) == {"brand_new_field": "x"}
    assert json.loads(r["2"]["_rescued_data"]) == {"num_bikes_available": "oops"}
    assert run().count() == 2                                             # no new file: nothing appended
    _write(src, "s4.json", _doc(200, [{"station_id": "1", "num_bikes_available": 0,
                                       "num_docks_available": 10, "is_installed": "true",
                                       "is_renting": "1", "is_returning": "1", "last_reported": 190}]))
    assert run().count() == 3                                             # only the new file
    status = latest_status(spark.read.parquet(out))
    latest = {x["station_id"]: x for x in status.collect()}
    assert latest["1"]["num_bikes_available"] == 0 and latest["1"]["is_installed"] == 1
    assert latest["2"]["is_renting"] == 0


def test_silver_stations_current_state(spark):
    info = spark.createDataFrame([
        ("1", " W  42 St ", 40.1234567, -73.1, 20, "r", 1, 10, "f1"),
        ("1", "W 42 St", 40.5, -73.5, 22, "r", 0, 10, "f2"),     # same last_updated: later file wins
        ("2", "E 1 Ave", 40.0, -73.0, 10, "r", 1, 5, "f1"),      # info only -> NULL measures
    ], "station_id string, name string, lat double, lon double, capacity long, region_id string, "
       "is_charging int, last_updated long, _source_file string")
    status = spark.createDataFrame([
        ("1", 1, 0, 5, 0, 0, 0, 0, "true", "1", "1", 50, 60, "f1"),
        ("1", 2, 0, 4, 0, 0, 0, 0, "true", "1", "1", 50, 61, "f2"),   # same last_reported, later update
        ("3", 9, 0, 9, 0, 0, 0, 0, "1", "1", "1", 50, 60, "f1"),      # status only -> dropped
    ], "station_id string, num_bikes_available long, num_bikes_disabled long, num_docks_available long, "
       "num_docks_disabled long, num_ebikes_available long, num_scooters_available long, "
       "num_scooters_unavailable long, is_installed string, is_renting string, is_returning string, "
       "last_reported long, last_updated long, _source_file string")
    s = {r["station_id"]: r for r in silver_stations(info, status).collect()}
    assert set(s) == {"1", "2"}
    assert s["1"]["address"] == "W42 St" and s["1"]["lat"] == 40.5 and s["1"]["is_charging"] is False
    assert s["1"]["num_bikes_available"] == 2 and s["1"]["status_source_file"] == "f2"
    assert s["2"]["num_bikes_available"] is None
    a = latest_information(info, "aggregate").collect()
    w = latest_information(info, "window").collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, w))


def test_rescue_unknown_and_bad_fields(spark):
    df = spark.createDataFrame([('{"id": 1, "name": "a"}',), ('{"id": "x", "extra": {"z": 1}}',),
                                ('{"id": 2}',)], "j string")
    schema = StructType([StructField("id", LongType()), StructField("name", StringType())])
    got = [(r["_parsed"]["id"], r["_rescued_data"]) for r in with_rescued(df, "j", schema).collect()]
    assert got[0] == (1, None)
    assert got[1][0] is None and json.loads(got[1][1]) == {"extra": '{"z":1}', "id": "x"}
    assert got[2] == (2, None)


def test_infer_schema_remembered(spark):
    base = _tmp()
    _write(f"{base}/sample", "a.json", _doc(1, [{"station_id": "1", "capacity": 5}]))
    s1 = infer_schema(spark, f"{base}/sample", f"{base}/schema", multiLine=True)
    _write(f"{base}/sample", "b.json", _doc(2, [{"station_id": "1", "capacity": 5, "new": 1.5}]))
    s2 = infer_schema(spark, f"{base}/sample", f"{base}/schema", multiLine=True)
    assert s1 == s2 and "data" in s1.fieldNames()


def test_feed_url_and_dim(spark):
    base = _tmp()
    _write(f"{base}/disc", "discovery.json", {"last_updated": 1, "ttl": 0, "data": {"en": {"feeds": [
        {"name": "station_information", "url": "u1"}, {"name": "station_status", "url": "u2"}]}}})
    docs = spark.read.schema(DISCOVERY).option("multiLine", True).json(f"{base}/disc")
    assert [r["url"] for r in feed_url(docs, "station_status").collect()] == ["u2"]
    os.makedirs(f"{base}/seed")
    with open(f"{base}/seed/m.csv", "w") as f:
        f.write("station_id,canonical_station_key,canonical_station_name\n5997.10,k,K\n5308.04,j,J\n")
    dim = load_dim(spark, f"{base}/seed", "station_id string, canonical_station_key string, "
                                         "canonical_station_name string")
    assert sorted(r["station_id"] for r in dim.collect()) == ["5308.04", "5997.1"]


def test_landing_and_config(spark):
    base = _tmp()
    df = spark.createDataFrame([("2024-01-31 23:59:59.123456", 1), ("2024-02-01 00:00:00", 2)],
                               "t string, v long").withColumn("t", F.col("t").cast("timestamp"))
    land_snapshots(df, base, "t", grain="hour")
    assert os.path.isdir(f"{base}/year=2024/month=01/day=31/hour=23")
    back = read_landed(spark, base, StructType(df.schema.fields), grain="hour")
    got = sorted((r["v"], r["month"], r["day"], r["hour"], r["t"].microsecond) for r in back.collect())
    assert got == [(1, 1, 31, 23, 123456), (2, 2, 1, 0, 0)]
    cfg = Config("mobility_dev", "s3://bucket/lake")
    assert cfg.env == "dev" and cfg.table("silver", "stations") == "dev_silver.stations"
    assert cfg.checkpoint("bronze", "trips") == "s3://bucket/lake/_checkpoints/dev/bronze/trips"


def test_incremental_state_equals_full(spark):
    base = _tmp()
    rows = [(u, t, f"e{u}-{t}") for u in range(5) for t in range(6)] + [(1, 5, "e1-5b")]
    df = spark.createDataFrame(rows, "k long, ts long, v string")
    for i in range(3):   # three files, streamed one per micro-batch
        df.filter(F.col("ts") % 3 == i).coalesce(1).write.parquet(f"{base}/in/part={i}")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in/*")
    name = _name("inc")
    incremental_state(stream, name, f"{base}/tables", ["k"], ["ts", "v"], f"{base}/ckpt")
    full = df.groupBy("k").agg(F.max_by(F.struct("ts", "v"), F.struct("ts", "v")).alias("m")) \
        .select("k", "m.ts", "m.v")
    assert _sorted(spark.table(name)) == _sorted(full)
    assert table_version(spark, name) == 3


# --- flows ---------------------------------------------------------------------

def _info_doc(ts, stations):
    return {"last_updated": ts, "ttl": 60, "version": "2.3", "data": {"stations": stations}}


def test_live_flow_twice_merges(spark):
    from bikelake.plans.flows import run_live
    base = _tmp()
    cfg = Config(f"mobility_t{uuid.uuid4().hex[:6]}", base)
    info = [{"station_id": "1", "name": "W 4 St", "lat": 1.0, "lon": 2.0, "capacity": 20,
             "region_id": "r", "is_charging": False},
            {"station_id": "2", "name": "E 9 Ave", "lat": 1.5, "lon": 2.5, "capacity": 10,
             "region_id": "r", "is_charging": True}]
    _write(cfg.landing("station_information"), "i1.json", _info_doc(100, info))
    _write(cfg.landing("station_status"), "s1.json", _info_doc(100, [
        {"station_id": "1", "num_bikes_available": 0, "num_docks_available": 20, "num_bikes_disabled": 1,
         "num_docks_disabled": 0, "num_ebikes_available": 0, "is_installed": True, "is_renting": True,
         "is_returning": True, "last_reported": 90},
        {"station_id": "2", "num_bikes_available": 5, "num_docks_available": 5, "num_bikes_disabled": 0,
         "num_docks_disabled": 0, "num_ebikes_available": 1, "is_installed": 1, "is_renting": 1,
         "is_returning": 1, "last_reported": 95}]))
    names = run_live(spark, cfg)
    q = {r["station_id"]: r for r in spark.table(names["queue"]).collect()}
    assert set(q) == {"1"} and q["1"]["health_status"] == "NO_BIKES" and q["1"]["priority_rank"] == 1
    # a later snapshot: station 1 refilled, station 2 drained -> MERGE updates both
    _write(cfg.landing("station_status"), "s2.json", _info_doc(200, [
        {"station_id": "1", "num_bikes_available": 10, "num_docks_available": 10, "num_bikes_disabled": 0,
         "num_docks_disabled": 0, "num_ebikes_available": 0, "is_installed": True, "is_renting": True,
         "is_returning": True, "last_reported": 190},
        {"station_id": "2", "num_bikes_available": 5, "num_docks_available": 0, "num_bikes_disabled": 0,
         "num_docks_disabled": 0, "num_ebikes_available": 0, "is_installed": 1, "is_renting": 1,
         "is_returning": 1, "last_reported": 195}]))
    names = run_live(spark, cfg)
    assert spark.table(names["bronze_status"]).count() == 4          # incremental append
    silver = {r["station_id"]: r for r in spark.table(names["silver"]).collect()}
    assert silver["1"]["num_bikes_available"] == 10 and silver["1"]["address"] == "W4 St"
    assert table_version(spark, names["silver"]) == 2                 # created, then merged
    q = {r["station_id"]: r for r in spark.table(names["queue"]).collect()}
    assert set(q) == {"2"} and q["2"]["health_status"] == "NO_DOCKS"


def test_profile_report_and_resolve_entity(spark):
    from bikelake.operators.profile import profile_report
    from bikelake.operators.trips import resolve_entity
    df = spark.createDataFrame([("1.1", "a"), ("2", None), (None, "c")], "id string, name string")
    rep = profile_report(df, n=2)
    assert rep["rows"] == 3 and rep["columns"] == ["id", "name"] and rep["dtypes"]["id"] == "string"
    assert rep["sample"].count() == 2
    m = spark.createDataFrame([("1.1", "k", "K")], "station_id string, canonical_station_key string, "
                                                   "canonical_station_name string")
    got = sorted((tuple(r) for r in resolve_entity(df, m, "id", "name").collect()),
                 key=lambda r: (r[0] is None, r[0] or ""))
    assert got == [("1.1", "a", "k", "K"), ("2", None, "2", None), (None, "c", None, "c")]


def _trip_csv(path, rows):
    os.makedirs(path, exist_ok=True)
    header = ("ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,"
              "end_station_name,end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual\n")
    with open(os.path.join(path, "trips.csv"), "w") as f:
        f.write(header + "".join(",".join(r) + "\n" for r in rows))


def test_history_flow_incremental_month(spark):
    from bikelake.plans.flows import run_history
    base = _tmp()
    cfg = Config(f"mobility_h{uuid.uuid4().hex[:6]}", base)
    jan = [("r1", "classic_bike", "2024-01-05 10:00:00", "2024-01-05 10:30:00", "W 4 St", "5.10_",
            "E 9 Ave", "7", "40.1", "-73.1", "40.2", "-73.2", "member"),
           ("r2", " Electric_Bike", "2024-01-31 23:50:00", "2024-02-01 00:10:00", "W  4 St", "5.1",
            "E 9 Ave", "7.00", "40.3", "-73.3", "40.4", "-73.4", "Casual")]
    _trip_csv(f"{cfg.landing('trips')}/year=2024/month=01", jan)
    mapping = spark.createDataFrame([("5.1", "w4", "W4 St")], "station_id string, "
                                    "canonical_station_key string, canonical_station_name string")
    names = run_history(spark, cfg, mapping)
    flow = {r["station_month_key"]: r for r in spark.table(names["flow"]).collect()}
    assert flow["2024|01|w4"]["departures"] == 2 and flow["2024|02|7"]["arrivals"] == 1
    assert spark.table(names["silver"]).filter("start_station_id = '5.1'").count() == 2
    feb = [("r3", "classic_bike", "2024-02-02 08:00:00", "2024-02-02 08:05:00", "E 9 Ave", "7",
            "W 4 St", "5.1", "40.2", "-73.2", "40.1", "-73.1", "member")]
    _trip_csv(f"{cfg.landing('trips')}/year=2024/month=02", feb)
    names = run_history(spark, cfg, mapping)
    assert spark.table(names["bronze"]).count() == 3                    # only the new file appended
    flow = {r["station_month_key"]: r for r in spark.table(names["flow"]).collect()}
    assert flow["2024|02|w4"]["arrivals"] == 1 and flow["2024|02|7"]["departures"] == 1
    demand = {(r["member_casual"], r["rideable_type"]) for r in spark.table(names["demand"]).collect()}
    assert demand == {("member", "classic_bike"), ("casual", "electric_bike")}


def test_publish_survives_a_stop_between_its_steps(spark):
    """A version that is written and not switched to leaves the old table whole; a rerun succeeds,
    also with another schema and with partitions."""
    from bikelake.sinks.tables import prune_versions, switch, write_version
    name, root = _name("crash"), _tmp()
    publish(spark.createDataFrame([(1, "x")], "a long, p string"), name, root, batch_id=7)
    for df, parts in ((spark.createDataFrame([(2, "y")], "a long, p string"), ()),
                      (spark.createDataFrame([(2, "y", 1.0)], "a long, p string, c double"), ("p",))):
        before = spark.table(name).collect()
        write_version(df, name, root, parts)                     # stopped before the switch
        assert spark.table(name).collect() == before
        v, path = write_version(df, name, root, parts)
        switch(spark, name, v, path)
        assert [r.a for r in spark.table(name).collect()] == [2] and table_version(spark, name) == v
    from bikelake.sinks.tables import last_batch
    assert last_batch(spark, name) == 7
    for k in range(4):
        publish(spark.createDataFrame([(k, "x")], "a long, p string"), name, root)
    assert prune_versions(spark, name, root, keep=2) >= 4 and spark.table(name).count() == 1


def test_failing_gate_leaves_the_previous_version(spark):
    from bikelake.operators.quality import DataTestFailure, not_null
    from bikelake.plans.flows import _published_and_tested
    cfg = Config(f"mobility_g{uuid.uuid4().hex[:6]}", _tmp())
    cfg.ensure_databases(spark)
    good, bad = (spark.createDataFrame([(x,)], "a long") for x in (1, None))
    name = _published_and_tested(good, cfg, "m", [not_null("a")], "raise")
    with pytest.raises(DataTestFailure):
        _published_and_tested(bad, cfg, "m", [not_null("a")], "raise")
    assert [r.a for r in spark.table(name).collect()] == [1]


def test_csv_header_order_is_never_swapped(spark):
    from bikelake.sources.files import load_dim
    base = _tmp()
    os.makedirs(base, exist_ok=True)
    with open(f"{base}/seed.csv", "w") as f:
        f.write("canonical_station_name,station_id,canonical_station_key\nName,5.10,key\n")
    r = load_dim(spark, base, "station_id string, canonical_station_key string, canonical_station_name string").collect()
    assert [tuple(x) for x in r] == [("5.1", "key", "Name")]


def test_unreadable_schema_store_is_not_overwritten(spark):
    from bikelake.sources.schemas import infer_schema
    base = _tmp()
    os.makedirs(f"{base}/store", exist_ok=True)
    with open(f"{base}/store/part-0.txt", "w") as f:
        f.write("not json")
    with pytest.raises(ValueError):
        infer_schema(spark, f"{base}/none", f"{base}/store")
    assert open(f"{base}/store/part-0.txt").read() == "not json"


def test_repeated_unknown_key_is_rescued(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from bikelake.sources.schemas import with_rescued
    contract = StructType([StructField("id", StringType()), StructField("n", LongType())])
    rows = [('{"id":"a","n":1}',), ('{"id":"b","x":1,"x":2}',), ('{"id":"c","x":1,"x":2,"n":"y"}',), (None,)]
    got = with_rescued(spark.createDataFrame(rows, "j string"), "j", contract).collect()
    assert {(r._parsed or [None])[0]: r._rescued_data for r in got} == {
        "a": None, "b": '{"x":"1","x":"2"}', "c": '{"x":"1","x":"2","n":"y"}', None: None}

"""The live flow's later runs: only new files and changed stations, rows of a full build."""

import json
import os
import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from bikelake.config import Config
from bikelake.operators.quality import DataTestFailure
from bikelake.operators.silver import silver_stations
from bikelake.operators.stations import station_health
from bikelake.plans.flows import run_live
from bikelake.sinks.tables import bucket_folders


def snapshot(cfg, feed, name, updated, stations):
    folder = cfg.landing(feed)
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump({"last_updated": updated, "ttl": 60, "version": "2.3", "data": {"stations": stations}}, f)


def info(i, name="W 4 St"):
    return {"station_id": None if i is None else str(i), "name": name, "lat": 1.0, "lon": 2.0, "capacity": 20, "region_id": "r", "is_charging": False}


def status(i, bikes, at):
    return {"station_id": str(i), "num_bikes_available": bikes, "num_docks_available": 20 - bikes, "num_bikes_disabled": 0,
            "num_docks_disabled": 0, "num_ebikes_available": 0, "is_installed": True, "is_renting": 1, "is_returning": "1",
            "last_reported": at}


def full_build(spark, names):
    drop = ["batch"]
    return silver_stations(spark.table(names["bronze_information"]).drop(*drop), spark.table(names["bronze_status"]).drop(*drop))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same_as_full_build(spark, names):
    full = full_build(spark, names).drop("_silver_updated_at")
    assert rows(spark.table(names["silver"]).select(*full.columns)) == rows(full)
    health = spark.table(names["health"]).drop("_silver_updated_at")
    assert rows(health) == rows(station_health(full_build(spark, names)).drop("_silver_updated_at"))


def test_second_run_writes_changed_stations_only(spark):
    cfg = Config(f"mobility_i{uuid.uuid4().hex[:6]}", tempfile.mkdtemp(prefix="bl-live-"))
    rng = random.Random(1)
    snapshot(cfg, "station_information", "i1", 100, [info(i) for i in range(300)])
    snapshot(cfg, "station_status", "s1", 100, [status(i, rng.randrange(21), 90) for i in range(299)])
    names = run_live(spark, cfg, on_fail="report")
    same_as_full_build(spark, names)
    before = {t: bucket_folders(spark, names[t], cfg.root) for t in ("silver", "health")}
    stamps = {r.station_id: r._silver_updated_at for r in spark.table(names["silver"]).collect()}

    # three stations change, one of them in both feeds, and an older record comes late
    snapshot(cfg, "station_status", "s2", 200, [status(7, 0, 190), status(8, 20, 190), status(9, 1, 10)])
    snapshot(cfg, "station_information", "i2", 200, [info(7, "E 9 Ave"), info(1000), info(None)])
    names = run_live(spark, cfg, on_fail="report")
    same_as_full_build(spark, names)
    new = {r.station_id: r for r in spark.table(names["silver"]).collect()}
    assert (new["7"].address, new["7"].num_bikes_available, new["9"].num_bikes_available) == ("E9 Ave", 0, new["9"].num_bikes_available)
    touched = {i for i in new if stamps.get(i) != new[i]._silver_updated_at}
    assert touched == {"7", "8", "9", "1000", None}
    for t in before:
        after = bucket_folders(spark, names[t], cfg.root)
        assert 0 < sum(after[b] != before[t].get(b) for b in after) <= 5

    names = run_live(spark, cfg, on_fail="report")             # nothing new: nothing written
    assert rows(spark.table(names["silver"])) == sorted((tuple(r) for r in new.values()), key=repr)


def test_a_run_that_fails_its_tests_is_caught_up(spark):
    cfg = Config(f"mobility_j{uuid.uuid4().hex[:6]}", tempfile.mkdtemp(prefix="bl-live-"))
    snapshot(cfg, "station_information", "i1", 100, [info(1), info(2)])
    snapshot(cfg, "station_status", "s1", 100, [status(1, 5, 90)])
    with pytest.raises(DataTestFailure):                       # station 2 has no status
        run_live(spark, cfg)
    assert not spark.catalog.tableExists(cfg.table("gold", "station_live_health"))
    snapshot(cfg, "station_status", "s2", 200, [status(2, 0, 190)])
    names = run_live(spark, cfg)
    same_as_full_build(spark, names)
    assert spark.table(names["health"]).count() == 2
    assert [r.station_id for r in spark.table(names["queue"]).collect()] == ["2"]


def test_drift_reaches_bronze_and_leaves_silver(spark):
    cfg = Config(f"mobility_k{uuid.uuid4().hex[:6]}", tempfile.mkdtemp(prefix="bl-live-"))
    snapshot(cfg, "station_information", "i1", 100, [info(1)])
    snapshot(cfg, "station_status", "s1", 100, [status(1, 5, 90)])
    run_live(spark, cfg)
    snapshot(cfg, "station_status", "s2", 200, [{**status(1, 6, 190), "battery": 0.5}, 3])
    names = run_live(spark, cfg)
    assert [tuple(r) for r in spark.table(names["bronze_status"]).orderBy("batch").select("num_bikes_available", "battery").collect()] == [(5, None), (6, 0.5)]
    assert [(r.reason, r.content) for r in spark.read.parquet(cfg.data("quarantine", "station_status")).collect()] == [("element", "3")]
    same_as_full_build(spark, names)
    assert spark.table(names["silver"]).select(F.max("num_bikes_available")).first()[0] == 6


def test_independent_flows_run_side_by_side(spark, monkeypatch):
    """Each of two steps waits for the other: one after the other, they would never end."""
    import threading

    from bikelake.plans import bind_suite
    meet = threading.Barrier(2, timeout=20)

    def flow(*names):
        def run(spark, sf):
            meet.wait()
            spark.range(3).selectExpr("id AS x").createOrReplaceTempView("side_by_side")
            return dict.fromkeys(names, "side_by_side")
        return run

    monkeypatch.setattr(bind_suite, "history_tables", flow("demand", "flow"))
    monkeypatch.setattr(bind_suite, "live_tables", flow("health", "queue"))
    monkeypatch.setattr(bind_suite, "GOLD_TESTS", {m: [bind_suite.not_null("x")] for m in bind_suite._MODEL_SQL})
    report = bind_suite.q_dq_suite(spark, "").collect()
    assert sorted(r.table_name for r in report) == sorted(bind_suite._MODEL_SQL) and {r.failures for r in report} == {0}


def test_feeds_are_read_side_by_side_and_a_failure_stops_the_run(spark, monkeypatch):
    import threading
    import uuid

    import pytest

    from bikelake.config import Config
    from bikelake.plans import flows
    from bikelake.session import scratch_path
    meet, seen = threading.Barrier(2, timeout=20), []

    def ingest(spark, source, *rest, **more):
        meet.wait()
        seen.append(source)
        raise OSError("no such feed")

    monkeypatch.setattr(flows, "ingest_feed", ingest)
    cfg = Config(catalog=f"mobility_t{uuid.uuid4().hex[:8]}", root=scratch_path(spark, "side"))
    with pytest.raises(OSError):
        flows.run_live(spark, cfg)
    assert len(seen) == 2


def test_first_load_of_unique_rows_is_not_ranked(spark, monkeypatch):
    import uuid

    from bikelake.session import scratch_path
    from bikelake.sinks import tables
    root, name = scratch_path(spark, "first"), f"first_{uuid.uuid4().hex[:8]}"
    rows = spark.createDataFrame([(None, 0), *((k, k) for k in range(40))], "k long, v long")
    with monkeypatch.context() as m:
        m.setattr(tables, "Window", None)
        tables.upsert(name, rows, ["k"], root, null_keys="match", source_unique=True)
    assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, rows.collect()))
    tables.upsert(name, spark.createDataFrame([(None, 7), (3, 8)], "k long, v long"), ["k"], root, null_keys="match",
                  source_unique=True)
    got = {r.k: r.v for r in spark.table(name).collect()}
    assert len(got) == 41 and got[None] == 7 and got[3] == 8 and got[4] == 4


def test_elements_without_new_keys_are_not_parsed_for_them(spark, monkeypatch):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from bikelake.streaming import feeds
    contract = StructType([StructField("id", LongType()), StructField("Name", StringType())])

    def kinds(*texts, **more):
        found = feeds.new_keys(spark.createDataFrame([(t,) for t in texts], "_element string"), contract, **more)
        return [(f.name, f.dataType.simpleString()) for f in found.fields]

    with monkeypatch.context() as m:
        m.setattr(feeds.F, "try_parse_json", None)
        assert kinds('{"id": 1}', '{"id": "x", "id": 2}') == []
    assert kinds('{"id": 1, "name": 2, "b": 1, "a": 1.5, "n": null}', '{"b": true, "c": {"d": 1}, "NAME": 1}') == [
        ("a", "double"), ("b", "string"), ("c", "string")]
    assert kinds('{"b": 1, "odd key": 2, "it\'s": false, " ": 1}', '{"b": 3}') == [
        ("b", "bigint"), ("it's", "boolean"), ("odd key", "bigint")]
    assert kinds('{"c": 1, "b": 2, "a": null, "d": 4}', limit=2) == [("b", "bigint"), ("c", "bigint")]


def test_rescue_of_clean_and_odd_objects(spark):
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    from bikelake.sources.schemas import with_rescued
    contract = StructType([StructField("id", LongType()), StructField("s", StringType())])
    want = {'{"id":1,"s":"a"}': None, '{"id":1}': None, '{}': None, '{"id":null,"s":null}': None, '{"id":1,"S":2}': '{"S":"2"}',
            '{"id":"x","s":"a"}': '{"id":"x"}', '{"id":1,"x":null}': '{"x":null}', '[1]': None, '{"id":1': None, 'no': None,
            '{"s":{"a":[1]},"y":{"z":1}}': '{"y":"{\\"z\\":1}"}'}
    got = with_rescued(spark.createDataFrame([(t,) for t in want], "j string"), "j", contract)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN NOT _fits" in plan              # the second parse is left out for rows that fit
    assert {r.j: r._rescued_data for r in got.collect()} == want

"""Lossless, evolving ingest: quarantine, contract versions, remembered schemas, CSV by header."""

import json
import os
import tempfile

import pyarrow.parquet as pq
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from bikelake.sources.schemas import (contract_versions, merge_contracts, remember_contract, remembered_schema)
from bikelake.streaming.feeds import (STAGE_GROUP_BYTES, batch_ids, bronze_view, ingest_csv, ingest_feed,
                                      parse_documents, pieces, staged)

ELEMENT = StructType([StructField("station_id", StringType()), StructField("n", LongType())])


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", newline="") as f:
        f.write(text if isinstance(text, str) else json.dumps(text, indent=1))


class Feed:
    def __init__(self, spark):
        self.spark, self.base = spark, tempfile.mkdtemp(prefix="bl-feed-")
        self.name = "feed_" + os.path.basename(self.base).replace("-", "_").lower()

    def run(self, **kw):
        b = self.base
        ingest_feed(self.spark, f"{b}/in", ELEMENT, f"{b}/contract", f"{b}/bronze", f"{b}/quarantine", f"{b}/ckpt", **kw)
        return self.spark.table(bronze_view(self.spark, self.name, f"{b}/contract", f"{b}/bronze"))

    def quarantine(self):
        return sorted((r.reason, r.content) for r in self.spark.read.parquet(f"{self.base}/quarantine").collect())


def doc(stations, **more):
    return {"last_updated": 5, "ttl": 60, "version": "2.3", "data": {"stations": stations}, **more}


def test_every_byte_is_in_bronze_or_quarantine(spark):
    f = Feed(spark)
    whole = json.dumps(doc([{"station_id": "t", "n": 1}]))
    put(f"{f.base}/in", "a.json", doc([{"station_id": "1", "n": 1}, 17, None, "text", [1, {"x": 2}], {"station_id": "2", "n": "oops"}]))
    put(f"{f.base}/in", "b.json", whole[:-9])                                   # truncated
    put(f"{f.base}/in", "c.json", whole + whole)                                # one document too many
    put(f"{f.base}/in", "d.json", doc([{"station_id": "3"}], producer="acme", ttl="soon"))
    put(f"{f.base}/in", "e.json", {"last_updated": 9, "data": {"stations": {"not": "a list"}, "note": "n"}})
    put(f"{f.base}/in", "f.json", {"last_updated": 9, "data": [1, 2]})
    put(f"{f.base}/in", "g.json", "[1, 2]")
    put(f"{f.base}/in", "h.json", "  \n")
    put(f"{f.base}/in", "i.json", {"last_updated": 9})
    rows = {r.station_id: r for r in f.run().collect()}
    assert set(rows) == {"1", "2", "3"} and rows["1"].n == 1 and rows["1"].last_updated == 5
    assert json.loads(rows["2"]._rescued_data) == {"n": "oops"} and rows["3"].ttl is None
    assert rows["3"]._source_file.endswith("d.json")
    got = f.quarantine()
    assert got == sorted([
        ("element", "17"), ("element", "null"), ("element", "text"), ("element", '[1,{"x":2}]'),
        ("document", whole[:-9]), ("document", whole + whole), ("envelope", '{"producer":"acme","ttl":"soon"}'),
        ("stations", '{"not":"a list"}'), ("data", '{"note":"n"}'), ("data", "[1,2]"), ("document", "[1, 2]")])
    f.run()                                                                      # nothing new: nothing more
    assert f.quarantine() == got


def test_new_field_becomes_a_column_and_old_rows_are_null(spark):
    f = Feed(spark)
    put(f"{f.base}/in", "a.json", doc([{"station_id": "1", "n": 1, "later": None}]))
    assert f.run().columns[:3] == ["station_id", "n", "_rescued_data"]
    put(f"{f.base}/in", "b.json", doc([{"station_id": "2", "n": 2, "level": 0.5, "open": True, "tags": ["x"], "N": 7, "mix": 1},
                                       {"station_id": "3", "n": 3, "level": 2, "mix": "a", "batch": 1}]))
    got = {r.station_id: r for r in f.run().collect()}
    assert (got["1"].level, got["1"].open, got["1"].tags) == (None, None, None)
    assert (got["2"].level, got["2"].open, got["2"].tags, got["2"].mix) == (0.5, True, '["x"]', "1")
    assert (got["3"].level, got["3"].mix) == (2.0, "a")
    # names that a column already has, in another case too, stay rescued
    assert json.loads(got["2"]._rescued_data) == {"N": "7"} and json.loads(got["3"]._rescued_data) == {"batch": "1"}
    assert sorted(contract_versions(spark, f"{f.base}/contract")) == [1, 2]
    put(f"{f.base}/in", "c.json", doc([{"station_id": "4", "n": 4}]))
    assert {r.station_id: r.level for r in f.run().collect()} == {"1": None, "2": 0.5, "3": 2.0, "4": None}
    assert sorted(contract_versions(spark, f"{f.base}/contract")) == [1, 2]     # nothing wider: no version
    assert batch_ids(spark, f"{f.base}/bronze") == [0, 1, 2]
    plan = spark.table(f.name).filter("batch > 1").inputFiles()
    assert plan and {r.station_id for r in spark.table(f.name).filter("batch > 1").collect()} == {"4"}


def test_a_batch_that_runs_again_replaces_itself(spark):
    f = Feed(spark)
    put(f"{f.base}/in", "a.json", doc([{"station_id": "1", "new": 1}, 5]))
    first = sorted(map(tuple, f.run().drop("_ingested_at").collect()))
    # a stop before the stream's commit: the batch's commit is gone, its folders are there
    os.remove(f"{f.base}/ckpt/commits/0")
    for x in os.listdir(f"{f.base}/ckpt/commits"):
        os.remove(f"{f.base}/ckpt/commits/{x}")
    assert sorted(map(tuple, f.run().drop("_ingested_at").collect())) == first
    assert f.quarantine() == [("element", "5")]


def test_ingest_holds_no_rows_in_the_executors_memory(spark, monkeypatch):
    f, kept, frame = Feed(spark), [], type(spark.range(0))
    for name in ("persist", "cache", "localCheckpoint"):
        monkeypatch.setattr(frame, name, lambda self, *a, _f=getattr(frame, name), _n=name, **b: kept.append(_n) or _f(self, *a, **b))
    put(f"{f.base}/in", "a.json", doc([{"station_id": "1", "n": 1, "more": 2}, 5, {}], producer="acme"))
    put(f"{f.base}/in", "b.json", doc([]))
    # pieces that a stopped run of the batch left are replaced
    spark.createDataFrame([(None, '{"station_id":"old"}')], "reason string, content string").write.parquet(f"{f.base}/bronze/_staged/000000000")
    got = sorted(((r.station_id, r.n, r.more) for r in f.run().collect()), key=repr)
    assert kept == [] and got == [("1", 1, 2), (None, None, None)]
    assert f.quarantine() == [("element", "5"), ("envelope", '{"producer":"acme"}')]
    assert os.listdir(f"{f.base}/bronze/_staged") == []


def test_documents_are_parsed_once_into_small_row_groups(spark):
    docs = spark.createDataFrame([(json.dumps(doc([{"station_id": "1"}, 2])), "a"), (None, "b")], "value string, _source_file string")
    parsed = parse_documents(docs)

    def parses(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("from_json")
    assert parses(pieces(parsed)) == parses(parsed)
    assert sorted(map(tuple, pieces(parsed).collect()), key=repr) == [("element", "2", 5, 60, "a"), (None, '{"station_id":"1"}', 5, 60, "a")]
    folder = tempfile.mkdtemp(prefix="bl-staged-") + "/x"
    texts = spark.range(0, 4000, 1, 1).select(F.sha2(F.col("id").cast("string"), 512).alias("h")).select(
        F.concat(*[F.sha2(F.concat("h", F.lit(str(k))), 512) for k in range(80)]).alias("content"))
    with staged(texts, folder) as back:                                          # some 40 MB, hardly compressed
        assert back.count() == 4000
        groups = [m.row_group(i).total_byte_size for name in os.listdir(folder) if name.endswith(".parquet")
                  for m in [pq.ParquetFile(f"{folder}/{name}").metadata] for i in range(m.num_row_groups)]
        assert len(groups) > 1 and max(groups) < 4 * STAGE_GROUP_BYTES
    assert not os.path.exists(folder)


def test_json_lines_and_empty_feed(spark):
    f = Feed(spark)
    os.makedirs(f"{f.base}/in")
    assert f.run(multi_line=False).count() == 0
    put(f"{f.base}/in", "a.json", "\n".join([json.dumps(doc([{"station_id": "1", "n": 1}])), "", "{broken", json.dumps(doc([]))]) + "\n")
    assert [r.station_id for r in f.run(multi_line=False).collect()] == ["1"] and f.quarantine() == [("document", "{broken")]


def test_repeated_keys_and_long_documents(spark):
    docs = spark.createDataFrame([('{"last_updated":1,"x":1,"x":2,"data":{"stations":[{"a":1}]}}',),
                                  (json.dumps(doc([{"station_id": str(k), "n": k} for k in range(50_000)])),), (None,)], "value string")
    a, b, c = parse_documents(docs).select(F.size("_elements"), "_problems").collect()
    assert a[0] == 1 and [tuple(p) for p in a[1]] == [("envelope", '{"x":"1","x":"2"}')]
    assert (b[0], b[1], c[1]) == (50_000, [], [])


def test_remembered_schema_widens_and_never_narrows(spark):
    base = tempfile.mkdtemp(prefix="bl-schema-")
    samples = [{"a": 1, "b": "x"}, {"a": 1.5, "c": True}, {"a": 2, "b": 7}, {"a": {"deep": 1}}]
    want = [{"a": LongType(), "b": StringType()}, {"a": DoubleType(), "b": StringType(), "c": BooleanType()},
            {"a": DoubleType(), "b": StringType(), "c": BooleanType()},
            {"a": StringType(), "b": StringType(), "c": BooleanType()}]
    for k, (sample, fields) in enumerate(zip(samples, want)):
        put(f"{base}/s{k}", "x.json", json.dumps(sample))
        version, schema = remembered_schema(spark, f"{base}/s{k}", f"{base}/store")
        assert {f.name: f.dataType for f in schema.fields} == fields
        assert version == (1, 2, 2, 3)[k]
    assert remember_contract(spark, f"{base}/store", StructType([StructField("A", LongType())]))[0] == 3
    os.makedirs(f"{base}/store/v000004")                                       # a stop while it was written
    assert max(contract_versions(spark, f"{base}/store")) == 3
    assert merge_contracts(StructType(), StructType()) == StructType()


def test_csv_by_header_name(spark):
    base = tempfile.mkdtemp(prefix="bl-csv-")
    parts = [StructField("year", IntegerType()), StructField("month", IntegerType())]
    put(f"{base}/in/year=2024/month=01", "a.csv", "ride_id,name,end\nr1,\"A, b\",x\n")
    put(f"{base}/in/year=2024/month=02", "b.csv", "﻿end,tip,ride_id,tip,name\ny,3,r2,4,B\ny2,,r3,,B2\nshort,1\n")
    put(f"{base}/in/year=2024/month=02", "c.csv", "ride_id\nr4\nr5,too,many\n")
    put(f"{base}/in/year=2024/month=02", "empty.csv", "")

    def go():
        ingest_csv(spark, f"{base}/in", ["ride_id", "name", "end"], parts, f"{base}/bronze", f"{base}/ckpt")
        return {r.ride_id: r for r in spark.read.parquet(f"{base}/bronze/rows").collect()}

    got = go()
    assert {k: (r.name, r.end, r.month) for k, r in got.items()} == {
        "r1": ("A, b", "x", 1), "r2": ("B", "y", 2), "r3": ("B2", "y2", 2), None: (None, "short", 2),
        "r4": (None, None, 2), "r5": (None, None, 2)}
    assert got["r1"]._rescued_data is None and got["r2"]._rescued_data == '{"tip":"3","tip":"4"}'
    assert json.loads(got["r5"]._rescued_data) == {"_corrupt_record": "r5,too,many"}
    assert json.loads(got[None]._rescued_data) == {"tip": "1", "_corrupt_record": "short,1"}
    put(f"{base}/in/year=2024/month=03", "d.csv", "name,ride_id,end\nN,r6,z\n")
    assert go()["r6"].month == 3 and len(go()) == 7

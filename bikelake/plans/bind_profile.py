"""Profiling and data-quality queries on the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bikelake.operators.joins import join_coverage
from bikelake.operators.latest import latest_per_key
from bikelake.operators.profile import (conditional_counts, profile_describe, profile_keys,
                                        profile_nulls, sample_rows, snapshot_diff)
from bikelake.operators.quality import Check, accepted, not_null, run_checks, unique
from bikelake.plans import bind_gold  # noqa: F401  (registers the gold SQL the suite reads)
from bikelake.plans.catalog import ORACLE_SQL, query
from bikelake.plans.gold_tests import GOLD_TESTS, checks_sql
from bikelake.sources.tables import load_table

# Snapshot cut used to split the event history into an "old" and a "new" snapshot.
SNAPSHOT_CUT = "2024-01-15 00:00:00"


@query("join_coverage", sql="""
    with j as (select o.o_orderkey, l.l_orderkey, l.l_linestatus
               from orders o left join lineitem l on l.l_orderkey = o.o_orderkey)
    select (select count(*) from orders) as left_rows, (select count(*) from lineitem) as right_rows,
           count(*) as joined_rows, cast(count_if(l_linestatus is null) as bigint) as missing_after_join,
           cast(count_if(l_orderkey is null) as bigint) as unmatched_left_rows
    from j""")
def q_join_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """Orders (status side) LEFT JOIN lineitem (information side): rows per side,
    joined rows, rows whose probe column is NULL after the join."""
    o = load_table(spark, sf, "orders")
    li = load_table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey")
    return join_coverage(o, li, "o_orderkey", "l_linestatus")


@query("snapshot_diff", sql=f"""
    with old as (
      select user_id, value, event_type from events where ts < timestamp '{SNAPSHOT_CUT}'
      qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1),
    new as (
      select user_id, value, event_type from events
      qualify row_number() over (partition by user_id order by ts desc, event_id desc) = 1)
    select old.user_id, old.value as value_old, new.value as value_new,
           old.event_type as event_type_old, new.event_type as event_type_new
    from old join new on old.user_id = new.user_id
    where old.value is distinct from new.value or old.event_type is distinct from new.event_type""")
def q_snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    """J4 + F6 + R2: per-user state at the cut vs now; keys whose measures changed."""
    ev = load_table(spark, sf, "events").select("user_id", "ts", "event_id", "value", "event_type")
    old = latest_per_key(ev.filter(F.col("ts") < F.lit(SNAPSHOT_CUT).cast("timestamp")),
                         ["user_id"], ["ts", "event_id"])
    new = latest_per_key(ev, ["user_id"], ["ts", "event_id"])
    return snapshot_diff(old, new, ["user_id"], ["value", "event_type"])


@query("conditional_counts", sql="""
    select cast(count_if(l_discount = 0) as bigint) as zero_bikes,
           cast(count_if(l_tax = 0) as bigint) as zero_docks,
           cast(count_if(l_returnflag = 'N' and l_linestatus = 'O' and l_quantity > 1) as bigint) as operational,
           cast(count_if(l_returnflag = 'N' and l_linestatus = 'O' and l_quantity > 1 and l_discount = 0) as bigint)
             as operational_zero_bikes,
           cast(count_if(l_returnflag = 'N' and l_linestatus = 'O' and l_quantity > 1 and l_tax = 0) as bigint)
             as operational_zero_docks
    from lineitem""")
def q_conditional_counts(spark: SparkSession, sf: str) -> DataFrame:
    """A7 + F5: zero-bike / zero-dock counts overall and among "operational" rows
    (a three-flag conjunction)."""
    li = load_table(spark, sf, "lineitem")
    c = F.col
    operational = (c("l_returnflag") == "N") & (c("l_linestatus") == "O") & (c("l_quantity") > 1)
    return conditional_counts(li, {
        "zero_bikes": c("l_discount") == 0,
        "zero_docks": c("l_tax") == 0,
        "operational": operational,
        "operational_zero_bikes": operational & (c("l_discount") == 0),
        "operational_zero_docks": operational & (c("l_tax") == 0),
    })


@query("sample_rows", sql="""
    select * from orders order by o_totalprice desc, o_orderkey limit 20""")
def q_sample_rows(spark: SparkSession, sf: str) -> DataFrame:
    """L1: deterministic top-20 sample (the limit is the feature)."""
    o = load_table(spark, sf, "orders")
    return sample_rows(o, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 20)


_DOC_LABEL_COLS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"), ("source", "string"),
                   ("n_chars", "bigint"), ("quality", "int"), ("toxic", "int")]


@query("profile_nulls", sql="with j as (select d.*, l.quality, l.toxic from documents d "
                            "left join labels l on d.doc_id = l.doc_id)\n" + "\nunion all\n".join(
    f"select {i} as ordinal, '{c}' as column_name, '{t}' as data_type, count(*) as row_count, "
    f"cast(count_if({c} is null) as bigint) as null_count from j"
    for i, (c, t) in enumerate(_DOC_LABEL_COLS)))
def q_profile_nulls(spark: SparkSession, sf: str) -> DataFrame:
    """A5 + R1: one-pass NULL profile of documents LEFT JOIN labels."""
    d = load_table(spark, sf, "documents")
    lb = load_table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    return profile_nulls(d.join(lb, "doc_id", "left"))


@query("profile_keys", sql="""
    select count(*) as row_count,
           (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem)) as distinct_keys,
           count(*) - (select count(*) from (select distinct l_orderkey, l_linenumber from lineitem))
             as duplicate_rows,
           cast(count_if(l_orderkey is null or l_linenumber is null) as bigint) as null_key_rows,
           cast(11 as bigint) as column_count
    from lineitem""")
def q_profile_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A4: rows, distinct keys, duplicates of (l_orderkey, l_linenumber)."""
    return profile_keys(load_table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def _describe_sql(table: str, col: str) -> str:
    r = lambda e: f"cast(round(cast({e} as decimal(28,10)), 6) as double)"
    return (f"select '{col}' as column_name, count({col}) as count, {r(f'avg({col})')} as mean, "
            f"{r(f'stddev_samp({col})')} as std, {r(f'min({col})')} as min, "
            f"{r(f'quantile_cont({col}, 0.25)')} as p25, {r(f'quantile_cont({col}, 0.5)')} as p50, "
            f"{r(f'quantile_cont({col}, 0.75)')} as p75, {r(f'max({col})')} as max from {table}")


@query("profile_describe", sql=_describe_sql("events", "value") + "\nunion all\n"
       + _describe_sql("events", "user_id"))
def q_profile_describe(spark: SparkSession, sf: str) -> DataFrame:
    """describe() with exact interpolated quartiles (distributed rank, no single task)."""
    return profile_describe(load_table(spark, sf, "events"), ["value", "user_id"])


EVENT_CHECKS: list[Check] = [
    not_null("event_id"), unique("event_id"), not_null("ts"), not_null("user_id"),
    accepted("event_type", ["view", "click", "purchase", "signup"]), unique("user_id"),
]
LINEITEM_CHECKS: list[Check] = [
    not_null("l_shipdate"), accepted("l_returnflag", ["A", "N", "R"]), unique("l_orderkey"),
    not_null("l_orderkey"),
]


@query("dq_checks", sql=checks_sql("select * from events", EVENT_CHECKS, "events")
       + "\nunion all\n" + checks_sql("select * from lineitem", LINEITEM_CHECKS, "lineitem"))
def q_dq_checks(spark: SparkSession, sf: str) -> DataFrame:
    """not_null / unique / accepted_values, one aggregate pass per table + one per unique."""
    ev = run_checks(load_table(spark, sf, "events"), EVENT_CHECKS, "events")
    li = run_checks(load_table(spark, sf, "lineitem"), LINEITEM_CHECKS, "lineitem")
    return ev.unionByName(li)

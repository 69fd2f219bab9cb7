"""Historical gold models: hourly demand cube and monthly station flow.

Scale notes
-----------
* Every aggregate here is a hash aggregate with a partial (map-side) step, so a
  hot station or hour is reduced to one row per task before the shuffle.
* The mapping dimension meets the pre-aggregated rows (one per month, raw id, name and
  side), never the raw rows; Catalyst and AQE choose broadcast or shuffle by size.
* ``monthly_flow`` reads each side once and replaces the two aggregates plus the
  full outer join of the SQL formulation by ONE aggregate over a side-tagged
  union; ``monthly_flow_join`` keeps the literal join form and is tested equal.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bikelake.functions.clean import non_blank, round_decimal
from bikelake.operators.joins import assert_unique, lookup_join

FLOW_KEYS = ["ride_year", "ride_month", "station_key"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hourly_demand(df: DataFrame, ts: str = "started_at",
                  segments: Sequence[str] = ("member_casual", "rideable_type"),
                  measure: str = "ride_duration_minutes",
                  count_as: str = "total_trips",
                  avg_as: str = "avg_ride_duration_minutes") -> DataFrame:
    """Hourly demand cube: one row per (date, year, month, weekday, hour, *segments)."""
    t = F.col(ts)
    return (
        df.groupBy(
            F.to_date(t).alias("ride_date"),
            F.year(t).alias("ride_year"),
            F.month(t).alias("ride_month"),
            F.date_format(t, "EEEE").alias("day_of_week"),
            F.hour(t).alias("ride_hour"),
            *[F.col(s) for s in segments],
        )
        .agg(F.count(F.lit(1)).alias(count_as),
             round_decimal(F.avg(measure), 2).alias(avg_as))
    )


def resolve_entity(df: DataFrame, mapping: DataFrame, id_col: str, name_col: str | None = None,
                   key_out: str = "station_key", name_out: str = "station_name",
                   map_key: str = "station_id") -> DataFrame:
    """Canonical key (and name) for every row (J2, X10): LEFT JOIN the mapping on the id;
    an unmapped id falls back to itself, an unmapped name to the row's own name.
    A mapping id that occurs twice would multiply rows, so it is rejected."""
    m = mapping.select(F.col(map_key).alias("_mid"),
                       F.col("canonical_station_key").alias("_mkey"),
                       F.col("canonical_station_name").alias("_mname"))
    assert_unique(m, ["_mid"], what="mapping id")
    j = lookup_join(df, m, F.col(id_col) == F.col("_mid"))
    out = j.withColumn(key_out, F.coalesce("_mkey", F.col(id_col)))
    if name_col is not None:
        out = out.withColumn(name_out, F.coalesce("_mname", F.col(name_col)))
    return out.drop("_mid", "_mkey", "_mname")


def _side_rows(df: DataFrame, ts, id_col, name_col, lat, lng, carry=()) -> DataFrame:
    """Rows of one side with a non-blank raw id (F2)."""
    return df.select(
        F.year(_c(ts)).alias("ride_year"),
        F.month(_c(ts)).alias("ride_month"),
        _c(id_col).cast("string").alias("_id"),
        _c(name_col).cast("string").alias("_name"),
        _c(lat).cast("double").alias("_lat"),
        _c(lng).cast("double").alias("_lng"),
        *carry,
    ).filter(non_blank("_id"))


def _resolved(state: DataFrame, mapping: DataFrame | None, map_key: str) -> DataFrame:
    """Pre-aggregated rows with the canonical key and name of their raw id (J2, X10): the
    mapping meets one row per month, id and name, never the raw rows."""
    if mapping is None:
        return state.withColumnsRenamed({"_id": "station_key", "_name": "station_name_raw"})
    return resolve_entity(state, mapping, "_id", "_name", key_out="station_key",
                          name_out="station_name_raw", map_key=map_key).drop("_id", "_name")


def _mean(total: str, n: str):
    """``avg`` from partial sums; NULL when there is no value (no division by zero)."""
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def _pre_aggregate(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Mergeable sums and counts per month, raw id and name (and ``keys``).

    The only step over raw rows, a hash aggregate with a partial step: ``max(string)``
    cannot use a fixed-width hash buffer, so names are keys here, and only one row per
    distinct name reaches the sort-based ``max`` of the final aggregate.
    """
    return df.groupBy("ride_year", "ride_month", "_id", "_name", *keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_lat").alias("_sl"), F.count("_lat").alias("_cl"),
        F.sum("_lng").alias("_sg"), F.count("_lng").alias("_cg"))


def monthly_side(df: DataFrame, ts, id_col, name_col, lat, lng,
                 mapping: DataFrame | None = None, count_as: str = "departures",
                 map_key: str = "station_id") -> DataFrame:
    """Monthly departures (or arrivals) per canonical station (A2/A3)."""
    p = _resolved(_pre_aggregate(_side_rows(df, ts, id_col, name_col, lat, lng)), mapping, map_key)
    return (
        p.groupBy(*FLOW_KEYS)
        .agg(F.max("station_name_raw").alias("station_name"),
             F.sum("_sl").alias("_sl"), F.sum("_cl").alias("_cl"),
             F.sum("_sg").alias("_sg"), F.sum("_cg").alias("_cg"),
             F.sum("_n").alias(count_as))
        .select(*FLOW_KEYS, "station_name",
                round_decimal(_mean("_sl", "_cl"), 6).alias("station_lat"),
                round_decimal(_mean("_sg", "_cg"), 6).alias("station_lng"),
                count_as)
    )


def _finish_flow(df: DataFrame) -> DataFrame:
    key = F.concat(F.col("ride_year").cast("string"), F.lit("|"),
                   F.lpad(F.col("ride_month").cast("string"), 2, "0"), F.lit("|"),
                   F.col("station_key"))
    return df.select(
        key.alias("station_month_key"), *FLOW_KEYS,
        "station_name", "station_lat", "station_lng", "departures", "arrivals",
        (F.col("departures") + F.col("arrivals")).alias("total_station_activity"),
        (F.col("arrivals") - F.col("departures")).alias("net_flow"),
    )


def monthly_flow_join(departures: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Literal form: full outer join of the two monthly sides on (year, month, key).

    NULL keys never match, so a NULL-month group of each side stays a separate row.
    """
    d = departures.alias("d")
    a = arrivals.alias("a")
    cond = [F.col(f"d.{k}") == F.col(f"a.{k}") for k in FLOW_KEYS]
    j = d.join(a, cond[0] & cond[1] & cond[2], "full")
    return _finish_flow(j.select(
        *[F.coalesce(f"d.{k}", f"a.{k}").alias(k) for k in FLOW_KEYS],
        F.coalesce("d.station_name", "a.station_name").alias("station_name"),
        F.coalesce("d.station_lat", "a.station_lat").alias("station_lat"),
        F.coalesce("d.station_lng", "a.station_lng").alias("station_lng"),
        F.coalesce("d.departures", F.lit(0)).alias("departures"),
        F.coalesce("a.arrivals", F.lit(0)).alias("arrivals"),
    ))


def flow_state(dep_rows: DataFrame, arr_rows: DataFrame, dep: dict, arr: dict, keys: Sequence[str] = ()) -> DataFrame:
    """Mergeable state of the monthly flow: sums and counts per month, raw id, name and side
    (and ``keys``, columns of the rows).  States of disjoint rows are united by ``flow_of``."""
    keys = list(keys)
    if dep_rows is arr_rows:
        # Departures and arrivals come from the same rows (trips): read them once
        # and emit two tagged rows per trip instead of scanning the table twice.
        sides = F.array(*[
            F.struct(_c(spec["ts"]).alias("ts"), _c(spec["id"]).cast("string").alias("id"),
                     _c(spec["name"]).cast("string").alias("name"),
                     _c(spec["lat"]).cast("double").alias("lat"),
                     _c(spec["lng"]).cast("double").alias("lng"), F.lit(flag).alias("_dep"))
            for spec, flag in ((dep, True), (arr, False))])
        rows = dep_rows.select(F.explode(sides).alias("_s"), *keys).select("_s.*", *keys)
        u = _side_rows(rows, "ts", "id", "name", "lat", "lng", carry=["_dep", *keys])
    else:
        def tagged(rows, spec, is_dep):
            r = _side_rows(rows, spec["ts"], spec["id"], spec["name"], spec["lat"], spec["lng"], carry=keys)
            return r.withColumn("_dep", F.lit(is_dep))

        u = tagged(dep_rows, dep, True).unionByName(tagged(arr_rows, arr, False))
    return _pre_aggregate(u, ["_dep", *keys])


def monthly_flow(dep_rows: DataFrame, arr_rows: DataFrame, mapping: DataFrame | None,
                 dep: dict, arr: dict, map_key: str = "station_id") -> DataFrame:
    """Monthly station flow (A2 A3 J3 X11 X12): ``flow_of`` the rows' state.

    ``dep``/``arr`` give the columns of each side: ``ts, id, name, lat, lng``.
    """
    return flow_of(flow_state(dep_rows, arr_rows, dep, arr), mapping, map_key)


def flow_of(state: DataFrame, mapping: DataFrame | None, map_key: str = "station_id") -> DataFrame:
    """Monthly station flow of a state: ids resolved, both sides in one grouped aggregate.

    Rows whose year or month is NULL keep the side in their grouping key, which
    reproduces the full outer join exactly (NULLs never match).
    """
    null_part = F.when(F.col("ride_year").isNull() | F.col("ride_month").isNull(), F.col("_dep"))
    p = _resolved(state, mapping, map_key).withColumn("_nullside", null_part)
    d, a = F.col("_dep"), ~F.col("_dep")

    def side_sum(cond, c):
        return F.sum(F.when(cond, F.col(c)))

    g = (
        p.groupBy(*FLOW_KEYS, "_nullside")
        .agg(
            F.max(F.when(d, F.col("station_name_raw"))).alias("_dname"),
            F.max(F.when(a, F.col("station_name_raw"))).alias("_aname"),
            side_sum(d, "_sl").alias("_dsl"), side_sum(d, "_cl").alias("_dcl"),
            side_sum(a, "_sl").alias("_asl"), side_sum(a, "_cl").alias("_acl"),
            side_sum(d, "_sg").alias("_dsg"), side_sum(d, "_cg").alias("_dcg"),
            side_sum(a, "_sg").alias("_asg"), side_sum(a, "_cg").alias("_acg"),
            F.coalesce(side_sum(d, "_n"), F.lit(0)).alias("departures"),
            F.coalesce(side_sum(a, "_n"), F.lit(0)).alias("arrivals"),
        )
        .withColumns({"_dlat": _mean("_dsl", "_dcl"), "_alat": _mean("_asl", "_acl"),
                      "_dlng": _mean("_dsg", "_dcg"), "_alng": _mean("_asg", "_acg")})
    )
    return _finish_flow(g.select(
        *FLOW_KEYS,
        F.coalesce("_dname", "_aname").alias("station_name"),
        F.coalesce(round_decimal(F.col("_dlat"), 6), round_decimal(F.col("_alat"), 6)).alias("station_lat"),
        F.coalesce(round_decimal(F.col("_dlng"), 6), round_decimal(F.col("_alng"), 6)).alias("station_lng"),
        "departures", "arrivals",
    ))

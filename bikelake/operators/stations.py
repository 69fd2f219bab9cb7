"""Live gold models: station health and the rebalancing queue."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikelake.functions.clean import guarded_pct, null_safe_sum
from bikelake.operators.rank import global_rank

# Fixed values of the health model.
HEALTH_CLASSES = ["HEALTHY", "LOW_BIKES", "LOW_DOCKS", "NO_BIKES", "NO_DOCKS", "OUT_OF_SERVICE"]
HEALTH_COLUMNS = [
    "station_id", "address", "lat", "lon", "capacity",
    "num_bikes_available", "num_ebikes_available", "num_bikes_disabled",
    "num_docks_available", "num_docks_disabled",
    "bike_availability_pct", "dock_availability_pct", "disabled_assets",
    "is_installed", "is_renting", "is_returning",
    "health_status",
    "last_reported_at", "status_last_updated_at", "_silver_updated_at",
]
QUEUE_COLUMNS = [
    "priority_rank", "station_id", "address", "lat", "lon", "capacity",
    "num_bikes_available", "num_docks_available",
    "bike_availability_pct", "dock_availability_pct",
    "num_bikes_disabled", "num_docks_disabled",
    "health_status", "priority_level", "priority_score", "recommended_action",
    "is_renting", "is_returning", "last_reported_at", "status_last_updated_at",
]


def station_health(stations: DataFrame, low_pct: float = 10,
                   columns: Sequence[str] = tuple(HEALTH_COLUMNS)) -> DataFrame:
    """Classify every station (first matching rule wins).

    A station without status has NULL measures; every rule is then NULL, so it is
    ``HEALTHY`` (trap T5) — the ``not_null`` data tests report it.  Percentages
    are compared after rounding (trap T21).
    """
    c = F.col
    h = stations.withColumns({
        "bike_availability_pct": guarded_pct("num_bikes_available", "capacity"),
        "dock_availability_pct": guarded_pct("num_docks_available", "capacity"),
        "disabled_assets": null_safe_sum("num_bikes_disabled", "num_docks_disabled"),
    })
    status = (
        F.when((c("is_installed") == 0) | ((c("is_renting") == 0) & (c("is_returning") == 0)),
               "OUT_OF_SERVICE")
        .when(c("num_bikes_available") == 0, "NO_BIKES")
        .when(c("num_docks_available") == 0, "NO_DOCKS")
        .when(c("bike_availability_pct") <= low_pct, "LOW_BIKES")
        .when(c("dock_availability_pct") <= low_pct, "LOW_DOCKS")
        .otherwise("HEALTHY")
    )
    h = h.withColumn("health_status", status)
    return h.select(*columns)  # a column the contract names and the input lacks is an error


def _score_from(pct: str):
    # round(90 - pct, 2) in exact decimal arithmetic, exposed as double
    return F.round(F.lit(90).cast("decimal(10,2)") - F.col(pct).cast("decimal(10,2)"), 2).cast("double")


def rebalancing_queue(health: DataFrame, distributed_rank: bool = True,
                      columns: Sequence[str] = tuple(QUEUE_COLUMNS)) -> DataFrame:
    """Non-healthy stations with action, level, score and a global priority rank."""
    hs = F.col("health_status")
    q = health.filter(hs != "HEALTHY").withColumns({
        "recommended_action": F.when(hs == "OUT_OF_SERVICE", "INVESTIGATE")
        .when(hs.isin("NO_BIKES", "LOW_BIKES"), "ADD_BIKES")
        .when(hs.isin("NO_DOCKS", "LOW_DOCKS"), "REMOVE_BIKES"),
        "priority_level": F.when(hs.isin("NO_BIKES", "NO_DOCKS"), "CRITICAL")
        .when(hs == "OUT_OF_SERVICE", "HIGH")
        .when(hs.isin("LOW_BIKES", "LOW_DOCKS"), "MEDIUM"),
        "priority_score": F.when(hs.isin("NO_BIKES", "NO_DOCKS"), F.lit(100.0))
        .when(hs == "OUT_OF_SERVICE", F.lit(95.0))
        .when(hs == "LOW_BIKES", _score_from("bike_availability_pct"))
        .when(hs == "LOW_DOCKS", _score_from("dock_availability_pct")),
    })
    order = [F.col("priority_score").desc(), F.col("capacity").desc(), F.col("station_id").asc()]
    ranked = global_rank(q, order, name="priority_rank", distributed=distributed_rank)
    return ranked.select(*columns)

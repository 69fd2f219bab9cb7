"""Data tests declared on the four gold models (fixed values of the model contracts)."""

from __future__ import annotations

from bikelake.operators.quality import accepted, not_null, unique
from bikelake.operators.stations import HEALTH_CLASSES

RIDER_TYPES = ["member", "casual"]
BIKE_TYPES = ["electric_bike", "classic_bike"]
PRIORITY_LEVELS = ["CRITICAL", "HIGH", "MEDIUM"]
ACTIONS = ["ADD_BIKES", "REMOVE_BIKES", "INVESTIGATE"]

GOLD_TESTS = {
    "hourly_trip_demand": [
        not_null("ride_date"), not_null("ride_hour"),
        not_null("member_casual"), accepted("member_casual", RIDER_TYPES),
        not_null("rideable_type"), accepted("rideable_type", BIKE_TYPES),
        not_null("total_trips"), not_null("avg_ride_duration_minutes"),
    ],
    "station_monthly_flow": [
        not_null("station_month_key"), unique("station_month_key"),
        not_null("ride_year"), not_null("ride_month"), not_null("station_key"),
        not_null("departures"), not_null("arrivals"),
        not_null("total_station_activity"), not_null("net_flow"),
    ],
    "station_live_health": [
        not_null("station_id"), unique("station_id"),
        not_null("health_status"), accepted("health_status", HEALTH_CLASSES),
        not_null("num_bikes_available"), not_null("num_docks_available"),
    ],
    "station_rebalancing_priority": [
        not_null("priority_rank"), unique("priority_rank"),
        not_null("station_id"), unique("station_id"),
        not_null("health_status"),
        not_null("priority_level"), accepted("priority_level", PRIORITY_LEVELS),
        not_null("recommended_action"), accepted("recommended_action", ACTIONS),
        not_null("priority_score"),
    ],
}


def checks_sql(source_sql: str, checks, table_name: str) -> str:
    """DuckDB SQL computing the same report as ``run_checks`` (for oracles)."""
    parts = []
    for c in checks:
        col = c.column
        if c.test == "not_null":
            parts.append(f"select '{table_name}' as table_name, '{col}' as column_name, 'not_null' as test, "
                         f"cast(count_if({col} is null) as bigint) as failures from ({source_sql})")
        elif c.test == "accepted_values":
            vals = ", ".join("'" + str(v) + "'" for v in c.values)
            parts.append(f"select '{table_name}' as table_name, '{col}' as column_name, 'accepted_values' as test, "
                         f"cast(count_if({col} is not null and {col} not in ({vals})) as bigint) as failures "
                         f"from ({source_sql})")
        else:
            parts.append(f"select '{table_name}' as table_name, '{col}' as column_name, 'unique' as test, "
                         f"cast(count(*) as bigint) as failures from (select {col} from ({source_sql}) "
                         f"where {col} is not null group by {col} having count(*) > 1)")
    return "\nunion all\n".join(parts)

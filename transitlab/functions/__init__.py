"""Column expressions. Every function returns a ``Column`` built from Spark built-ins (no Python UDF)."""
from .timefuncs import (clock_to_seconds, hour_of_day, is_rush_hour, is_weekend, parse_service_date,
                        time_of_day, weekday_monday0)
from .keys import archive_key, iso_timestamp, trip_update_pk, trip_update_sk, vehicle_pk, vehicle_sk

__all__ = [
    "clock_to_seconds", "hour_of_day", "is_rush_hour", "is_weekend", "parse_service_date", "time_of_day",
    "weekday_monday0", "archive_key", "iso_timestamp", "trip_update_pk", "trip_update_sk", "vehicle_pk",
    "vehicle_sk",
]

"""DuckDB text of each registered query (same views, same names, doubles rounded to 6 places).

Views come from ``views.duck_cte``; derived steps (schedule, delays, live views) are extra CTEs here,
written independently of the Spark operators.
"""
from __future__ import annotations

from .views import duck_cte


def r(*cols: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


VP = f"event_id, vehicle_id, route_id, {r('latitude', 'longitude', 'speed')}, timestamp, feed_timestamp"
TU = ("event_id, trip_id, route_id, vehicle_id, stop_id, stop_sequence, arrival_delay, departure_delay, "
      "feed_timestamp")
VALID_V = ("vehicle_id IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL AND timestamp IS NOT NULL "
           "AND NOT isnan(latitude) AND latitude BETWEEN -90 AND 90 AND NOT isnan(longitude) "
           "AND longitude BETWEEN -180 AND 180 AND (speed IS NULL OR NOT (speed < 0))")
VALID_T = "trip_id IS NOT NULL AND stop_id IS NOT NULL AND feed_timestamp IS NOT NULL"
FIRST_V = "QUALIFY row_number() OVER (PARTITION BY vehicle_id, timestamp ORDER BY event_id) = 1"
FIRST_T = "QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id, feed_timestamp ORDER BY event_id) = 1"

STOP_TIMES_T = ("CASE WHEN event_id % 4 = 0 THEN feed_timestamp + to_seconds(arrival_delay) END AS arrival_time, departure_delay, "
                "CASE WHEN event_id % 5 = 0 THEN feed_timestamp + to_seconds(departure_delay) END AS departure_time")

SCHED3 = """, sched3 AS (
SELECT st.trip_id, st.stop_id, st.arrival_time, st.departure_time, st.stop_sequence,
       t.route_id, t.service_id, t.trip_headsign, r.route_short_name, r.route_long_name, r.route_type,
       s.stop_name, s.stop_lat, s.stop_lon
FROM stop_times st LEFT JOIN trips t ON st.trip_id = t.trip_id
LEFT JOIN routes r ON t.route_id = r.route_id
LEFT JOIN stops s ON st.stop_id = s.stop_id)"""
CAL = """, cal AS (
SELECT service_id, strptime(date, '%Y%m%d') AS date, exception_type,
       CAST(isodow(strptime(date, '%Y%m%d')) - 1 AS INTEGER) AS day_of_week
FROM calendar_dates)"""
FIRST_SCHED = """, first_sched AS (
SELECT trip_id, stop_id, stop_sequence, arrival_time, route_id, route_short_name, route_long_name,
       stop_name, stop_lat, stop_lon
FROM sched3
QUALIFY row_number() OVER (PARTITION BY trip_id, stop_id ORDER BY stop_sequence NULLS FIRST,
    arrival_time NULLS FIRST, route_id NULLS FIRST, route_short_name NULLS FIRST, route_long_name NULLS FIRST,
    stop_name NULLS FIRST, stop_lat NULLS FIRST, stop_lon NULLS FIRST) = 1)"""
SU_D = """, su_d AS (
SELECT *, COALESCE(arrival_delay / CAST(60 AS DOUBLE), CAST(0 AS DOUBLE)) AS delay_minutes FROM schedule_updates)"""
TU_D = """, tu_d AS (
SELECT *, COALESCE(arrival_delay / CAST(60 AS DOUBLE), CAST(0 AS DOUBLE)) AS delay_minutes FROM trip_updates)"""
SCHED_D = """, sched_d AS (
SELECT u.*, f.stop_sequence AS stop_sequence_scheduled, f.arrival_time, f.route_id AS route_id_scheduled,
       f.route_short_name, f.route_long_name, f.stop_name, f.stop_lat, f.stop_lon
FROM su_d u LEFT JOIN first_sched f ON u.trip_id = f.trip_id AND u.stop_id = f.stop_id)"""
LIVE_V = """, lv_src AS (
SELECT * FROM vehicle_positions
WHERE timestamp > (SELECT max(timestamp) FROM vehicle_positions) - INTERVAL 24 HOUR AND vehicle_id IS NOT NULL),
live_v AS (
SELECT vehicle_id,
  arg_max(route_id, {'t': timestamp, 'e': event_id}) FILTER (WHERE route_id IS NOT NULL) AS route_id,
  arg_max(latitude, {'t': timestamp, 'e': event_id}) FILTER (WHERE latitude IS NOT NULL) AS latitude,
  arg_max(longitude, {'t': timestamp, 'e': event_id}) FILTER (WHERE longitude IS NOT NULL) AS longitude,
  arg_max(speed, {'t': timestamp, 'e': event_id}) FILTER (WHERE speed IS NOT NULL) AS speed,
  max(timestamp) AS timestamp,
  arg_max(feed_timestamp, {'t': timestamp, 'e': event_id}) FILTER (WHERE feed_timestamp IS NOT NULL)
      AS feed_timestamp
FROM lv_src GROUP BY vehicle_id)"""
LIVE_T = """, lt_src AS (
SELECT *, arrival_delay / CAST(60 AS DOUBLE) AS delay_minutes FROM trip_updates
WHERE feed_timestamp > (SELECT max(feed_timestamp) FROM trip_updates) - INTERVAL 24 HOUR),
live_t AS (
SELECT route_id, trip_id, vehicle_id, avg(delay_minutes) AS delay_minutes, min(feed_timestamp) AS feed_timestamp
FROM lt_src WHERE route_id IS NOT NULL AND trip_id IS NOT NULL AND vehicle_id IS NOT NULL
GROUP BY route_id, trip_id, vehicle_id)"""
LATEST_T = """, latest_t AS (
SELECT vehicle_id, delay_minutes FROM live_t WHERE delay_minutes IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY vehicle_id ORDER BY feed_timestamp DESC, route_id DESC, trip_id DESC) = 1)"""
VWD = """, vwd AS (
SELECT v.*, l.delay_minutes FROM live_v v LEFT JOIN latest_t l ON v.vehicle_id = l.vehicle_id)"""
ITEM_V = """, items_v AS (
SELECT 'VEHICLE#' || COALESCE(route_id, 'None') AS pk,
       COALESCE(CASE WHEN strftime(timestamp, '%f') = '000000' THEN strftime(timestamp, '%Y-%m-%dT%H:%M:%S')
                     ELSE strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || '.' || strftime(timestamp, '%f') END, 'None')
         || '#' || COALESCE(vehicle_id, 'None') AS sk,
       'vehicle_position' AS record_type, *, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS event_date
FROM vehicle_positions
QUALIFY row_number() OVER (PARTITION BY pk, sk ORDER BY event_id DESC) = 1)"""
ITEM_T = """, items_t AS (
SELECT 'TRIP#' || COALESCE(route_id, 'None') AS pk,
       COALESCE(CASE WHEN strftime(feed_timestamp, '%f') = '000000'
                     THEN strftime(feed_timestamp, '%Y-%m-%dT%H:%M:%S')
                     ELSE strftime(feed_timestamp, '%Y-%m-%dT%H:%M:%S') || '.' || strftime(feed_timestamp, '%f') END,
                'None') || '#' || COALESCE(trip_id, 'None') || '#' || COALESCE(stop_id, 'None') AS sk,
       'trip_update' AS record_type, *, CAST(CAST(feed_timestamp AS DATE) AS VARCHAR) AS event_date
FROM trip_updates
QUALIFY row_number() OVER (PARTITION BY pk, sk ORDER BY event_id DESC) = 1)"""


def _hour(ts: str) -> str:
    return f"CAST(hour({ts}) AS INTEGER)"


def _stats(valid: str, keys: str, table: str, label: str) -> str:
    return (f"SELECT '{label}' AS record_type, count(*) AS processed, count(*) FILTER (WHERE v) AS valid, "
            f"count(*) FILTER (WHERE NOT v) AS invalid, "
            f"count(*) FILTER (WHERE v) - count(DISTINCT ({keys})) FILTER (WHERE v) AS duplicate "
            f"FROM (SELECT *, ({valid}) AS v FROM {table})")


def _histogram(src: str) -> str:
    lo, hi = "(SELECT min(v) FROM hv)", "(SELECT max(v) FROM hv)"
    return f"""
, hv AS (SELECT CAST(delay_minutes AS DOUBLE) AS v FROM {src} WHERE delay_minutes IS NOT NULL AND NOT isnan(delay_minutes)),
hbin AS (SELECT CAST(CASE WHEN {hi} = {lo} THEN 1
                          ELSE least(floor((v - {lo}) / ({hi} - {lo}) * CAST(50 AS DOUBLE)) + 1, 50) END
                AS INTEGER) AS bin FROM hv)
SELECT bin, round({lo} + (bin - 1) * (({hi} - {lo}) / CAST(50 AS DOUBLE)), 6) AS bin_start,
       round(CASE WHEN bin = 50 THEN {hi} ELSE {lo} + bin * (({hi} - {lo}) / CAST(50 AS DOUBLE)) END, 6) AS bin_end,
       count(*) AS frequency
FROM hbin GROUP BY bin"""


SCHED3_COLS = (f"trip_id, stop_id, arrival_time, departure_time, stop_sequence, route_id, service_id, trip_headsign, "
               f"route_short_name, route_long_name, route_type, stop_name, {r('stop_lat', 'stop_lon')}")
SCHED_D_COLS = ("trip_id, stop_id, stop_sequence, route_id, vehicle_id, arrival_delay, feed_timestamp, event_id, "
                "round(delay_minutes, 6) AS delay_minutes, stop_sequence_scheduled, arrival_time, route_id_scheduled, "
                f"route_short_name, route_long_name, stop_name, {r('stop_lat', 'stop_lon')}")
BASE = ("vehicle_positions", "trip_updates", "schedule_updates", "stop_times", "trips", "routes", "stops",
        "calendar_dates")


def W(*names: str) -> str:
    return duck_cte(*names)


ALL = W(*BASE)


def _ranking(top: int = 10) -> str:
    return (f"SELECT route_short_name, avg(delay_minutes) AS avg_delay, count(delay_minutes) AS num_updates, "
            f"min(route_long_name) AS route_name FROM sched_d WHERE route_short_name IS NOT NULL "
            f"GROUP BY route_short_name HAVING count(delay_minutes) >= 5 "
            f"ORDER BY avg_delay DESC NULLS LAST, route_short_name LIMIT {top}")


ORACLE: dict[str, str] = {
    "scan_routes": W("routes") + "SELECT route_id, route_short_name, route_long_name, route_type FROM routes",
    "scan_trips": W("trips") + "SELECT trip_id, route_id, service_id, trip_headsign FROM trips",
    "scan_stops": W("stops") + f"SELECT stop_id, stop_name, {r('stop_lat', 'stop_lon')} FROM stops",
    "scan_stop_times": W("stop_times") + "SELECT trip_id, stop_id, arrival_time, departure_time, stop_sequence FROM stop_times",
    "scan_calendar_dates": W("calendar_dates") + "SELECT service_id, date, exception_type FROM calendar_dates",
    "flatten_vehicles": W("vehicle_positions") + (
        f"SELECT vehicle_id, CAST(NULL AS VARCHAR) AS trip_id, route_id, {r('latitude', 'longitude')}, "
        f"CAST(NULL AS DOUBLE) AS bearing, round(speed, 6) AS speed, timestamp, "
        f"CAST(NULL AS INTEGER) AS current_stop_sequence, CAST(NULL AS INTEGER) AS current_status, "
        f"CAST(NULL AS INTEGER) AS congestion_level, feed_timestamp FROM vehicle_positions"),
    "flatten_trip_updates": W("trip_updates") + (
        "SELECT trip_id, route_id, vehicle_id, stop_id, stop_sequence, arrival_delay, "
        f"{STOP_TIMES_T}, CAST(NULL AS INTEGER) AS schedule_relationship, feed_timestamp FROM trip_updates"),
    "archive_day": W("vehicle_positions") + (
        f", clean AS (SELECT * FROM vehicle_positions WHERE {VALID_V} {FIRST_V})\n"
        f"SELECT {VP}, 'transit/vehicles/' || strftime(feed_timestamp, '%Y%m%d') || '/' "
        f"|| strftime(feed_timestamp, '%Y%m%d_%H%M%S') || '.json' AS archive_key, "
        f"strftime(feed_timestamp, '%Y%m%d') AS date FROM clean "
        f"WHERE strftime(feed_timestamp, '%Y%m%d') = (SELECT strftime(max(feed_timestamp), '%Y%m%d') FROM clean)"),
    "keyed_vehicles": W("vehicle_positions") + ITEM_V + (
        f"\nSELECT pk, sk, record_type, {VP}, event_date FROM items_v"),
    "keyed_trip_updates": W("trip_updates") + ITEM_T + f"\nSELECT pk, sk, record_type, {TU}, event_date FROM items_t",
    "recent_by_route": W("vehicle_positions") + ITEM_V + (
        f"\nSELECT pk, sk, record_type, {VP}, event_date FROM items_v "
        f"WHERE record_type = 'vehicle_position' AND pk = 'VEHICLE#click' ORDER BY sk DESC LIMIT 100"),
    "export_trip_updates": W("trip_updates") + ITEM_T + (
        "\nSELECT pk, sk, trip_id, route_id, vehicle_id, stop_id, stop_sequence, arrival_delay, departure_delay, "
        "feed_timestamp FROM items_t WHERE record_type = 'trip_update'"),
    "valid_vehicles": W("vehicle_positions") + f"SELECT {VP} FROM vehicle_positions WHERE {VALID_V}",
    "valid_trip_updates": W("trip_updates") + f"SELECT {TU} FROM trip_updates WHERE {VALID_T}",
    "dedup_vehicles": W("vehicle_positions") + f"SELECT {VP} FROM vehicle_positions {FIRST_V}",
    "dedup_trip_updates": W("trip_updates") + f"SELECT {TU} FROM trip_updates {FIRST_T}",
    "clean_vehicles": W("vehicle_positions") + f"SELECT {VP} FROM vehicle_positions WHERE {VALID_V} {FIRST_V}",
    "clean_trip_updates": W("trip_updates") + f"SELECT {TU} FROM trip_updates WHERE {VALID_T} {FIRST_T}",
    "quality_stats": W("vehicle_positions", "trip_updates")
    + _stats(VALID_V, "vehicle_id, timestamp", "vehicle_positions", "vehicle_position")
    + "\nUNION ALL\n" + _stats(VALID_T, "trip_id, stop_id, feed_timestamp", "trip_updates", "trip_update"),
    "route_filter": W("trip_updates") + f"SELECT {TU} FROM trip_updates WHERE route_id IN ('click', 'view')",
    "time_range_filter": W("trip_updates") + (
        f"SELECT {TU} FROM trip_updates "
        f"WHERE feed_timestamp > (SELECT max(feed_timestamp) FROM trip_updates) - INTERVAL 24 HOUR"),
    "map_points": W("vehicle_positions") + LIVE_V + (
        f"\nSELECT vehicle_id, {r('latitude', 'longitude')}, 50 AS size FROM live_v "
        f"WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) AND NOT isnan(longitude) "
        f"AND latitude <> 0 AND longitude <> 0"),
    "raw_preview": W("trip_updates") + LIVE_T + (
        "\nSELECT route_id, trip_id, vehicle_id, round(delay_minutes, 6) AS delay_minutes, feed_timestamp, "
        "(SELECT count(*) FROM live_t) AS total_rows FROM live_t ORDER BY route_id, trip_id, vehicle_id LIMIT 100"),
    "schedule_calendar": W("trips", "calendar_dates") + CAL + (
        "\nSELECT t.trip_id, t.route_id, t.service_id, t.trip_headsign, c.date, c.day_of_week "
        "FROM trips t LEFT JOIN cal c ON t.service_id = c.service_id"),
    "master_schedule": ALL + SCHED3 + CAL + (
        "\nSELECT s.trip_id, s.stop_id, s.arrival_time, s.departure_time, s.stop_sequence, s.route_id, s.service_id, "
        "s.trip_headsign, s.route_short_name, s.route_long_name, s.route_type, s.stop_name, "
        "round(s.stop_lat, 6) AS stop_lat, round(s.stop_lon, 6) AS stop_lon, c.date, c.day_of_week "
        "FROM sched3 s LEFT JOIN cal c ON s.service_id = c.service_id"),
    "updates_with_schedule": ALL + SCHED3 + FIRST_SCHED + (
        "\nSELECT u.trip_id, u.stop_id, u.stop_sequence, u.route_id, u.vehicle_id, u.arrival_delay, u.feed_timestamp, "
        "u.event_id, f.stop_sequence AS stop_sequence_scheduled, f.arrival_time, f.route_id AS route_id_scheduled, "
        "f.route_short_name, f.route_long_name, f.stop_name, round(f.stop_lat, 6) AS stop_lat, "
        "round(f.stop_lon, 6) AS stop_lon "
        "FROM schedule_updates u LEFT JOIN first_sched f ON u.trip_id = f.trip_id AND u.stop_id = f.stop_id"),
    "vehicles_with_delay": W("vehicle_positions", "trip_updates") + LIVE_V + LIVE_T + LATEST_T + VWD + (
        f"\nSELECT vehicle_id, route_id, {r('latitude', 'longitude', 'speed')}, timestamp, feed_timestamp, "
        f"round(delay_minutes, 6) AS delay_minutes FROM vwd"),
    "delays": W("trip_updates") + TU_D + f"\nSELECT {TU}, round(delay_minutes, 6) AS delay_minutes FROM tu_d",
    "calculate_delays": ALL + SCHED3 + FIRST_SCHED + SU_D + SCHED_D + f"\nSELECT {SCHED_D_COLS} FROM sched_d",
    "delay_statistics": W("schedule_updates") + SU_D + (
        "\nSELECT count(*) AS total_records, round(avg(delay_minutes), 6) AS avg_delay_minutes, "
        "round(median(delay_minutes), 6) AS median_delay_minutes, round(max(delay_minutes), 6) AS max_delay_minutes, "
        "round(min(delay_minutes), 6) AS min_delay_minutes, "
        "round(CAST(count(*) FILTER (WHERE abs(delay_minutes) <= 5) AS DOUBLE) / count(*), 6) AS on_time_rate, "
        "round(stddev_samp(delay_minutes), 6) AS std_delay_minutes FROM su_d"),
    "delay_by_route": ALL + SCHED3 + FIRST_SCHED + SU_D + SCHED_D + (
        "\nSELECT route_id, round(avg(delay_minutes), 6) AS avg_delay, round(median(delay_minutes), 6) AS median_delay, "
        "round(stddev_samp(delay_minutes), 6) AS std_delay, count(delay_minutes) AS count, "
        "min(route_short_name) AS route_short_name, min(route_long_name) AS route_long_name, "
        "round(CAST(count(*) FILTER (WHERE abs(delay_minutes) <= 5) AS DOUBLE) / count(*), 6) AS on_time_rate "
        "FROM sched_d WHERE route_id IS NOT NULL GROUP BY route_id"),
    "delay_by_hour": W("trip_updates") + TU_D + (
        f"\nSELECT {_hour('feed_timestamp')} AS hour, round(avg(delay_minutes), 6) AS avg_delay, "
        f"round(median(delay_minutes), 6) AS median_delay, count(delay_minutes) AS count FROM tu_d "
        f"WHERE feed_timestamp IS NOT NULL GROUP BY 1"),
    "delay_histogram": W("schedule_updates") + SU_D + _histogram("su_d"),
    "hourly_trend": W("trip_updates") + TU_D + (
        f"\nSELECT {_hour('feed_timestamp')} AS hour, round(avg(delay_minutes), 6) AS avg_delay FROM tu_d "
        f"WHERE feed_timestamp IS NOT NULL GROUP BY 1"),
    "schedule_summary": ALL + SCHED3 + CAL + (
        "\n, ms AS (SELECT s.*, c.date FROM sched3 s LEFT JOIN cal c ON s.service_id = c.service_id)"
        "\nSELECT count(*) AS total_records, count(DISTINCT route_id) AS unique_routes, "
        "count(DISTINCT stop_id) AS unique_stops FROM ms"),
    "kpis": W("vehicle_positions", "trip_updates") + LIVE_V + LIVE_T + (
        "\n, k AS (SELECT avg(delay_minutes) AS avg_delay, "
        "CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE abs(delay_minutes) <= 5) AS DOUBLE) / count(*) * 100.0 "
        "END AS on_time_rate FROM live_t)"
        "\nSELECT (SELECT count(DISTINCT vehicle_id) + COALESCE(max(CASE WHEN vehicle_id IS NULL THEN 1 ELSE 0 END), 0) "
        "FROM live_v) AS active_buses, round(avg_delay, 6) AS avg_delay, "
        "CASE WHEN avg_delay IS NULL THEN 'N/A' WHEN avg_delay <= 3 THEN 'normal' ELSE 'inverse' END AS avg_delay_status, "
        "round(on_time_rate, 6) AS on_time_rate, "
        "CASE WHEN on_time_rate IS NULL THEN 'N/A' WHEN on_time_rate >= 80 THEN 'Good' ELSE 'Below Target' END "
        "AS on_time_label FROM k"),
    "heatmap_long": W("trip_updates") + TU_D + (
        f"\nSELECT route_id, {_hour('feed_timestamp')} AS hour, round(avg(delay_minutes), 6) AS delay_minutes FROM tu_d "
        f"WHERE route_id IS NOT NULL AND feed_timestamp IS NOT NULL GROUP BY 1, 2"),
    "heatmap_pivot": W("trip_updates") + TU_D + (
        "\nSELECT route_id, " + ", ".join(
            f"round(avg(delay_minutes) FILTER (WHERE hour(feed_timestamp) = {h}), 6) AS h{h:02d}" for h in range(24))
        + " FROM tu_d WHERE route_id IS NOT NULL GROUP BY route_id"),
    "heatmap_peaks": W("trip_updates") + TU_D + (
        f"\n, cells AS (SELECT route_id, {_hour('feed_timestamp')} AS hour, avg(delay_minutes) AS d FROM tu_d "
        f"WHERE route_id IS NOT NULL AND feed_timestamp IS NOT NULL GROUP BY 1, 2)"
        "\n(SELECT 'hour' AS dimension, CAST(hour AS VARCHAR) AS key, round(avg(d), 6) AS avg_delay FROM cells "
        "GROUP BY hour ORDER BY avg(d) DESC NULLS LAST, hour LIMIT 1)"
        "\nUNION ALL\n(SELECT 'route' AS dimension, route_id AS key, round(avg(d), 6) AS avg_delay FROM cells "
        "GROUP BY route_id ORDER BY avg(d) DESC NULLS LAST, route_id LIMIT 1)"),
    "latest_delay": W("trip_updates") + (
        "\nSELECT vehicle_id, round(arg_max(arrival_delay / CAST(60 AS DOUBLE), {'t': feed_timestamp, 'e': event_id}) "
        "FILTER (WHERE arrival_delay IS NOT NULL), 6) AS delay_minutes FROM trip_updates "
        "WHERE vehicle_id IS NOT NULL GROUP BY vehicle_id"),
    "status_summary": W("vehicle_positions", "trip_updates") + LIVE_V + LIVE_T + LATEST_T + (
        "\n, dv AS (SELECT v.vehicle_id, l.delay_minutes AS d FROM live_v v LEFT JOIN latest_t l "
        "ON v.vehicle_id = l.vehicle_id WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT isnan(latitude) "
        "AND NOT isnan(longitude) AND latitude <> 0 AND longitude <> 0)"
        "\nSELECT count(*) FILTER (WHERE d <= 2) AS on_time, count(*) FILTER (WHERE d > 2 AND d <= 5) AS slight_delay, "
        "count(*) FILTER (WHERE d > 5) AS delayed, count(*) FILTER (WHERE d IS NULL) AS unknown FROM dv"),
    "route_ranking": ALL + SCHED3 + FIRST_SCHED + SU_D + SCHED_D + (
        f"\nSELECT route_short_name, round(avg_delay, 6) AS avg_delay, num_updates, route_name FROM ({_ranking()})"),
    "route_ranking_display": ALL + SCHED3 + FIRST_SCHED + SU_D + SCHED_D + (
        f"\nSELECT route_short_name AS \"Route\", printf('%.2f min', avg_delay) AS \"Avg Delay\", "
        f"num_updates AS \"Sample Size\", route_name AS \"Route Name\" FROM ({_ranking()})"),
    "live_vehicles": W("vehicle_positions") + LIVE_V + (
        f"\nSELECT vehicle_id, route_id, {r('latitude', 'longitude', 'speed')}, timestamp, feed_timestamp FROM live_v"),
    "live_trip_delays": W("trip_updates") + LIVE_T + (
        "\nSELECT route_id, trip_id, vehicle_id, round(delay_minutes, 6) AS delay_minutes, feed_timestamp FROM live_t"),
    "arrival_seconds": W("stop_times") + (
        "\nSELECT trip_id, stop_id, stop_sequence, arrival_time, COALESCE("
        "TRY_CAST(NULLIF(split_part(arrival_time, ':', 1), '') AS BIGINT) * 3600 + "
        "TRY_CAST(NULLIF(split_part(arrival_time, ':', 2), '') AS BIGINT) * 60 + "
        "TRY_CAST(NULLIF(split_part(arrival_time, ':', 3), '') AS BIGINT), CAST(0 AS BIGINT)) AS arrival_seconds "
        "FROM stop_times"),
    "calendar_weekday": W("calendar_dates") + CAL + "\nSELECT service_id, date, exception_type, day_of_week FROM cal",
    "temporal_features": W("trip_updates") + (
        f"\nSELECT event_id, trip_id, feed_timestamp, {_hour('feed_timestamp')} AS hour_of_day, "
        f"CAST(isodow(feed_timestamp) - 1 AS INTEGER) AS day_of_week, "
        f"CAST(isodow(feed_timestamp) - 1 >= 5 AS INTEGER) AS is_weekend, "
        f"CAST(hour(feed_timestamp) BETWEEN 7 AND 9 OR hour(feed_timestamp) BETWEEN 16 AND 18 AS INTEGER) AS is_rush_hour, "
        f"CASE WHEN hour(feed_timestamp) BETWEEN 0 AND 6 THEN 'night' WHEN hour(feed_timestamp) BETWEEN 7 AND 12 "
        f"THEN 'morning' WHEN hour(feed_timestamp) BETWEEN 13 AND 18 THEN 'afternoon' "
        f"WHEN hour(feed_timestamp) BETWEEN 19 AND 23 THEN 'evening' END AS time_of_day FROM trip_updates"),
    "archive_keys": W("vehicle_positions") + (
        "\nSELECT DISTINCT feed_timestamp, 'transit/vehicles/' || strftime(feed_timestamp, '%Y%m%d') || '/' "
        "|| strftime(feed_timestamp, '%Y%m%d_%H%M%S') || '.json' AS archive_key FROM vehicle_positions"),
    "route_encoding": W("schedule_updates") + (
        "\nSELECT trip_id, stop_id, route_id, "
        "CAST(dense_rank() OVER (ORDER BY COALESCE(route_id, 'None')) - 1 AS INTEGER) AS route_id_encoded "
        "FROM schedule_updates"),
    "weather_feature": W("trip_updates") + (
        "\nSELECT event_id, feed_timestamp, CAST(-5.0 AS DOUBLE) AS weather_temp FROM trip_updates"),
}

_FEATURES = (
    f"{_hour('feed_timestamp')} AS hour_of_day, CAST(isodow(feed_timestamp) - 1 AS INTEGER) AS day_of_week, "
    f"CAST(isodow(feed_timestamp) - 1 >= 5 AS INTEGER) AS is_weekend, "
    f"CAST(hour(feed_timestamp) BETWEEN 7 AND 9 OR hour(feed_timestamp) BETWEEN 16 AND 18 AS INTEGER) AS is_rush_hour, "
    f"CAST(dense_rank() OVER (ORDER BY COALESCE(route_id, 'None')) - 1 AS INTEGER) AS route_id_encoded, stop_sequence")
ORACLE["feature_set"] = W("trip_updates") + TU_D + (
    f"\nSELECT trip_id, route_id, stop_id, feed_timestamp, {_FEATURES}, round(delay_minutes, 6) AS delay_minutes "
    f"FROM tu_d")
ORACLE["training_rows"] = W("trip_updates") + (
    f"\n, fs AS (SELECT trip_id, route_id, stop_id, feed_timestamp, {_FEATURES}, "
    f"arrival_delay / CAST(60 AS DOUBLE) AS delay_minutes FROM trip_updates)"
    "\nSELECT trip_id, route_id, stop_id, feed_timestamp, hour_of_day, day_of_week, is_weekend, is_rush_hour, "
    "route_id_encoded, stop_sequence, round(delay_minutes, 6) AS delay_minutes FROM fs "
    "WHERE delay_minutes IS NOT NULL AND hour_of_day IS NOT NULL AND day_of_week IS NOT NULL "
    "AND is_weekend IS NOT NULL AND is_rush_hour IS NOT NULL AND route_id_encoded IS NOT NULL "
    "AND stop_sequence IS NOT NULL")
ORACLE["regression_metrics"] = W("trip_updates") + (
    "\n, p AS (SELECT arrival_delay / CAST(60 AS DOUBLE) AS y, departure_delay / CAST(60 AS DOUBLE) AS p "
    "FROM trip_updates WHERE arrival_delay IS NOT NULL AND departure_delay IS NOT NULL)"
    "\nSELECT round(avg(abs(y - p)), 6) AS mae, round(avg((y - p) * (y - p)), 6) AS mse, "
    "round(sqrt(avg((y - p) * (y - p))), 6) AS rmse, "
    "round(1.0 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)), 6) AS r2_score, "
    "round(avg(CAST(abs(y - p) <= 1 AS DOUBLE)) * 100.0, 6) AS within_1min, "
    "round(avg(CAST(abs(y - p) <= 2 AS DOUBLE)) * 100.0, 6) AS within_2min, "
    "round(avg(CAST(abs(y - p) <= 5 AS DOUBLE)) * 100.0, 6) AS within_5min, count(*) AS test_samples FROM p")

_INGEST_V = W("vehicle_positions") + (
    f"\nSELECT vehicle_id, CAST(NULL AS VARCHAR) AS trip_id, route_id, {r('latitude', 'longitude')}, CAST(NULL AS DOUBLE) AS bearing, "
    "round(speed, 6) AS speed, timestamp, CAST(NULL AS INTEGER) AS current_stop_sequence, CAST(NULL AS INTEGER) AS current_status, "
    "CAST(NULL AS INTEGER) AS congestion_level, feed_timestamp, CAST(CAST(timestamp AS DATE) AS VARCHAR) AS event_date "
    f"FROM vehicle_positions WHERE {VALID_V} {FIRST_V}")
ORACLE["ingest_vehicles_stream"] = ORACLE["ingest_out_of_order"] = _INGEST_V
ORACLE["vehicle_preview"] = W("vehicle_positions") + LIVE_V + (
    f"\nSELECT vehicle_id, route_id, {r('latitude', 'longitude', 'speed')}, timestamp, feed_timestamp, "
    f"(SELECT count(*) FROM live_v) AS total_rows FROM live_v ORDER BY vehicle_id LIMIT 100")
ORACLE["route_filter_vehicles"] = W("vehicle_positions") + (
    f"SELECT {VP} FROM vehicle_positions WHERE route_id IN ('click', 'view')")
ORACLE["schedule_calendar_active"] = W("trips", "calendar_dates") + CAL + (
    "\nSELECT t.trip_id, t.route_id, t.service_id, t.trip_headsign, c.date, c.day_of_week "
    "FROM trips t LEFT JOIN (SELECT * FROM cal WHERE exception_type <> 2) c ON t.service_id = c.service_id")

ORACLE["ingest_trip_updates_stream"] = W("trip_updates") + (
    f"\nSELECT trip_id, route_id, vehicle_id, stop_id, stop_sequence, arrival_delay, {STOP_TIMES_T}, "
    "CAST(NULL AS INTEGER) AS schedule_relationship, feed_timestamp, CAST(CAST(feed_timestamp AS DATE) AS VARCHAR) AS event_date "
    f"FROM trip_updates WHERE {VALID_T} {FIRST_T}")
ORACLE["ingest_summary"] = W("vehicle_positions", "trip_updates") + (
    "\n, s AS (" + _stats(VALID_V, "vehicle_id, timestamp", "vehicle_positions", "vehicles") + " UNION ALL "
    + _stats(VALID_T, "trip_id, stop_id, feed_timestamp", "trip_updates", "trip_updates")
    + ")\nSELECT record_type AS kind, processed, valid, invalid, duplicate, valid - duplicate AS stored FROM s")
ORACLE["recent_any_route"] = W("vehicle_positions") + ITEM_V + (
    f"\nSELECT pk, sk, record_type, {VP}, event_date FROM items_v ORDER BY pk, sk LIMIT 100")
ORACLE["store_upsert"] = W("vehicle_positions") + ITEM_V + (
    ", puts AS (SELECT pk, sk, record_type, event_date, event_id, vehicle_id, route_id, latitude, longitude, speed, timestamp, feed_timestamp, 0 AS b "
    "FROM items_v)"
    + ITEM_V.replace("items_v", "items_w").replace("FROM vehicle_positions", "FROM vehicle_positions WHERE event_id % 3 = 0")
    + ", both_puts AS (SELECT * FROM puts UNION ALL SELECT pk, sk, record_type, event_date, event_id, vehicle_id, route_id, latitude, longitude, "
      "coalesce(speed, 0) + 100, timestamp, feed_timestamp, 1 FROM items_w)"
    + f"\nSELECT pk, sk, record_type, {VP}, event_date FROM both_puts QUALIFY row_number() OVER (PARTITION BY pk, sk ORDER BY b DESC) = 1")
ORACLE["archive_files"] = W("vehicle_positions") + (
    f"\nSELECT 'vehicles' AS data_type, strftime(max(feed_timestamp), '%Y%m%d') AS date, true AS has_files, true AS not_empty "
    f"FROM vehicle_positions WHERE {VALID_V}")
ORACLE["timetable_summary"] = ALL + "\n" + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", count(*) AS rows FROM {t}" for t in ("routes", "trips", "stops", "stop_times", "calendar_dates"))
ORACLE["filtered_kpis"] = ORACLE["kpis"].replace("FROM live_t)", "FROM live_t WHERE route_id IN ('click', 'view'))") \
    .replace("FROM live_v) AS", "FROM live_v WHERE route_id IN ('click', 'view')) AS")
ORACLE["training_table"] = ALL + SCHED3 + FIRST_SCHED + SU_D + SCHED_D + (
    f"\nSELECT trip_id, route_id, stop_id, feed_timestamp, {_FEATURES}, round(delay_minutes, 6) AS delay_minutes FROM sched_d")
ORACLE["route_encoding_reuse"] = W("schedule_updates") + (
    "\nSELECT event_id, route_id, CAST(dense_rank() OVER (ORDER BY COALESCE(route_id, 'None')) - 1 AS INTEGER) AS route_id_encoded "
    "FROM schedule_updates")
ORACLE["weather_hourly"] = W("trip_updates") + (
    "\n, w AS (SELECT feed_timestamp AS h, CASE WHEN hour(feed_timestamp) % 7 <> 0 THEN avg(arrival_delay) END AS t FROM trip_updates "
    "WHERE hour(feed_timestamp) % 5 <> 0 GROUP BY feed_timestamp)"
    "\nSELECT event_id, feed_timestamp, round(coalesce(t, (SELECT avg(t) FROM w)), 6) AS weather_temp FROM trip_updates LEFT JOIN w ON h = feed_timestamp")
ORACLE["split_counts"] = W("trip_updates") + (
    "\n, n AS (SELECT count(*) AS n FROM trip_updates WHERE arrival_delay IS NOT NULL)"
    "\nSELECT n, n - CAST(ceil(0.2 * n) AS BIGINT) AS train, CAST(ceil(0.2 * n) AS BIGINT) AS test, CAST(0 AS BIGINT) AS overlap FROM n")
_INPUTS = "hour_of_day,day_of_week,is_weekend,is_rush_hour,route_id_encoded,stop_sequence"
for _type, _name in (("random_forest", "forest_round_trip"), ("boosted_trees", "boosted_round_trip")):
    ORACLE[_name] = W("trip_updates") + (
        "\n, n AS (SELECT CAST(ceil(0.2 * count(*)) AS BIGINT) AS n FROM trip_updates WHERE arrival_delay IS NOT NULL)"
        f"\nSELECT n AS scored, n AS equal, '{','.join(sorted(_INPUTS.split(',')))}' AS features, CAST(1 AS DOUBLE) AS importance_sum, "
        f"'{_type}' AS model_type, '{_INPUTS}' AS feature_names FROM n")
ORACLE["train_from_table"] = W("schedule_updates") + (
    f"\nSELECT 'random_forest' AS model_type, '{_INPUTS}' AS feature_names, CAST(ceil(0.2 * count(*)) AS BIGINT) AS test_samples FROM schedule_updates")

ORACLE["live_vehicles_default_window"] = ORACLE["live_vehicles"].replace("INTERVAL 24 HOUR", "INTERVAL 10 MINUTE")
ORACLE["live_trip_delays_default_window"] = ORACLE["live_trip_delays"].replace("INTERVAL 24 HOUR", "INTERVAL 1 HOUR")
ORACLE["export_written"] = ORACLE["export_trip_updates"]
for _name in ("delay_statistics", "delay_by_route", "delay_by_hour"):
    ORACLE[f"{_name}_ranges"] = ORACLE[_name]
ORACLE["archive_index"] = W("vehicle_positions") + (
    "\nSELECT 'vehicles' AS data_type, strftime(feed_timestamp, '%Y%m%d') AS date, count(*) AS rows, count(*) AS read_rows, "
    "CAST(sum(event_id) AS BIGINT) AS event_ids, count(DISTINCT feed_timestamp) AS snapshots FROM vehicle_positions GROUP BY 2")
_LEVELS = ITEM_V.replace("ORDER BY event_id DESC) = 1)", "ORDER BY event_id % 5 DESC, event_id DESC) = 1)")
ORACLE["store_levels"] = W("vehicle_positions") + _LEVELS + f"\nSELECT pk, sk, record_type, {VP}, event_date FROM items_v"
ORACLE["recent_by_route_files"] = ORACLE["store_levels"] + " WHERE pk = 'VEHICLE#click' ORDER BY sk DESC LIMIT 100"
# the second run repeats every key; after the reset before the third all of them are new again
ORACLE["ingest_memory"] = (
    ORACLE["ingest_summary"].replace(")\nSELECT record_type AS kind", ")\nSELECT CAST(run AS INTEGER) AS run, record_type AS kind")
    .replace("duplicate, valid - duplicate AS stored FROM s",
             "CASE WHEN run = 1 THEN valid ELSE duplicate END AS duplicate, CASE WHEN run = 1 THEN 0 ELSE valid - duplicate END AS stored FROM s, range(3) r(run)"))
ORACLE["fresh_vehicles_stream"] = ORACLE["live_vehicles_default_window"]
# runs of a quarter of the time each, every 50th row one run later; the watermark of a run is the newest time of the runs before it less
# 10 minutes; a row counts in the windows the watermark has not reached, and is late if there is none
ORACLE["recent_delays_stream"] = W("trip_updates") + """
, u AS (SELECT *, feed_timestamp + to_minutes(CAST(event_id * 7 % 60 AS BIGINT)) + to_seconds(event_id % 60) AS ts FROM trip_updates),
s AS (SELECT *, CAST(floor(epoch(ts)) AS BIGINT) AS sec FROM u),
l AS (SELECT s.*, CAST(floor((sec - lo) * 4 / (hi - lo + 1)) AS BIGINT) + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END AS run
  FROM s, (SELECT min(sec) AS lo, max(sec) AS hi FROM s) b WHERE route_id IS NOT NULL AND trip_id IS NOT NULL AND vehicle_id IS NOT NULL),
wm AS (SELECT g.run, coalesce(max(l.sec) - 600, 0) AS w FROM range(6) g(run) LEFT JOIN l ON l.run < g.run GROUP BY g.run),
e AS (SELECT l.*, w, sec - sec % 120 + 120 * k AS till FROM l JOIN wm ON wm.run = l.run, range(1, 31) r(k)),
win AS (SELECT till, route_id, trip_id, vehicle_id, avg(arrival_delay / CAST(60 AS DOUBLE)) AS delay_minutes, min(ts) AS feed_timestamp
  FROM e WHERE till > w AND till <= (SELECT max(w) FROM wm) GROUP BY ALL),
late AS (SELECT route_id, trip_id, vehicle_id, count(*) AS late_rows FROM l JOIN wm ON wm.run = l.run WHERE sec - sec % 120 + 3600 <= w GROUP BY ALL)
SELECT make_timestamp((till - 3600) * 1000000) AS window_start, route_id, trip_id, vehicle_id, round(delay_minutes, 6) AS delay_minutes, feed_timestamp,
       CAST(0 AS BIGINT) AS late_rows FROM win
UNION ALL SELECT NULL, route_id, trip_id, vehicle_id, NULL, NULL, late_rows FROM late"""

# DuckDB's round() keeps the sign of a value that rounds to zero (-0.0); Spark's decimal rounding gives 0.0.
# Adding 0.0 maps -0.0 to 0.0 and leaves every other double unchanged.
ORACLE = {k: v.replace(", 6)", ", 6) + 0.0") for k, v in ORACLE.items()}

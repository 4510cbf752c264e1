"""Transit-shaped views over the supplied TPC-H-like test tables.

The supplied tables carry no transit columns, so each view maps one of them onto a transit schema
(``FIXTURES.md`` section 3). A view is written once as SQL text; Spark evaluates it with
``spark.sql(text, table=DataFrame)`` (no temp-view names), and the DuckDB oracles inline the very same
text as CTEs, so both engines start from identical inputs. ``{K}`` is the only engine-specific part.

The ``% n`` expressions below inject nulls, zeros and unmatched keys into every row stream; no view drops
rows to make anything cheaper.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SPARK_K = "TRY_CAST(get_json_object(props, '$.k') AS INT)"
DUCK_K = "TRY_CAST(json_extract_string(props, '$.k') AS INT)"

# view name -> (source tables, SQL text). Source tables appear as {name} placeholders.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "vehicle_positions": (("events",), """
SELECT event_id,
       CAST(user_id AS STRING) AS vehicle_id,
       event_type AS route_id,
       CASE WHEN event_id % 50 = 0 THEN NULL
            WHEN event_id % 33 = 0 THEN CAST(0 AS DOUBLE)
            ELSE value - 60 END AS latitude,
       CAST({K} - 50 AS DOUBLE) * 4 AS longitude,
       CASE WHEN event_id % 10 = 0 THEN NULL ELSE value - 2 END AS speed,
       date_trunc('hour', CAST(ts AS TIMESTAMP)) AS timestamp,
       date_trunc('hour', CAST(ts AS TIMESTAMP)) AS feed_timestamp
FROM {events}"""),
    "trip_updates": (("events",), """
SELECT event_id,
       CASE WHEN event_id % 97 = 0 THEN NULL ELSE CAST({K} AS STRING) END AS trip_id,
       CASE WHEN event_id % 41 = 0 THEN NULL ELSE event_type END AS route_id,
       CAST(user_id AS STRING) AS vehicle_id,
       CAST(user_id % 10 AS STRING) AS stop_id,
       CAST(user_id % 10 AS INT) + 1 AS stop_sequence,
       CASE WHEN event_id % 20 = 0 THEN NULL ELSE CAST(floor(value * 10 - 200) AS INT) END AS arrival_delay,
       CASE WHEN event_id % 30 = 0 THEN NULL ELSE CAST(floor(value * 10 - 150) AS INT) END AS departure_delay,
       date_trunc('hour', CAST(ts AS TIMESTAMP)) AS feed_timestamp
FROM {events}"""),
    "schedule_updates": (("lineitem",), """
SELECT CAST(CASE WHEN l_linenumber = 7 THEN l_orderkey + 1000000 ELSE l_orderkey END AS STRING) AS trip_id,
       CAST(l_partkey AS STRING) AS stop_id,
       l_linenumber AS stop_sequence,
       CAST(l_suppkey % 25 AS STRING) AS route_id,
       CAST(l_suppkey AS STRING) AS vehicle_id,
       CASE WHEN l_linenumber = 3 THEN NULL
            ELSE CAST(floor(l_extendedprice / 100) AS INT) - 200 END AS arrival_delay,
       CAST(l_shipdate AS TIMESTAMP) AS feed_timestamp,
       l_orderkey * 8 + l_linenumber AS event_id
FROM {lineitem}"""),
    "stop_times": (("lineitem",), """
SELECT CAST(l_orderkey AS STRING) AS trip_id,
       CAST(l_partkey AS STRING) AS stop_id,
       concat(CAST(20 + l_linenumber AS STRING), ':', lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), ':00')
           AS arrival_time,
       concat(CAST(20 + l_linenumber AS STRING), ':', lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), ':30')
           AS departure_time,
       l_linenumber AS stop_sequence
FROM {lineitem}"""),
    # Every 40th order keeps its row but gets a trip id no stop time refers to (unmatched on both sides).
    "trips": (("orders",), """
SELECT CASE WHEN o_orderkey % 40 = 0 THEN concat('X', CAST(o_orderkey AS STRING))
            ELSE CAST(o_orderkey AS STRING) END AS trip_id,
       CAST(o_custkey % 27 AS STRING) AS route_id,
       CAST(o_orderkey % 6 AS STRING) AS service_id,
       o_orderpriority AS trip_headsign
FROM {orders}"""),
    "routes": (("nation", "region"), """
SELECT CAST(n_nationkey AS STRING) AS route_id,
       n_name AS route_short_name,
       concat(n_name, ' / ', r_name) AS route_long_name,
       CAST(3 AS INT) AS route_type
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey"""),
    "stops": (("part",), """
SELECT CAST(p_partkey AS STRING) AS stop_id,
       p_name AS stop_name,
       CAST(53.5 + p_size * 0.001 AS DOUBLE) AS stop_lat,
       CAST(-113.5 - p_size * 0.001 AS DOUBLE) AS stop_lon
FROM {part}"""),
    # One service per region, one date per nation: 5 services x 5 dates; the fifth date is a removal.
    "calendar_dates": (("nation",), """
SELECT CAST(n_regionkey AS STRING) AS service_id,
       concat('202401', lpad(CAST(n_nationkey + 1 AS STRING), 2, '0')) AS date,
       CASE WHEN n_nationkey % 5 = 4 THEN 2 ELSE 1 END AS exception_type
FROM {nation}"""),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sources, text = VIEWS[name]
    frames = {src: table(spark, sf_dir, src) for src in sources}
    return spark.sql(text.replace("{K}", SPARK_K), **frames)


def duck_cte(*names: str) -> str:
    """``WITH`` clause defining the named views for DuckDB (sources are its pre-registered tables)."""
    parts = []
    for name in names:
        sources, text = VIEWS[name]
        body = text.replace("{K}", DUCK_K)
        for src in sources:
            body = body.replace("{" + src + "}", src)
        parts.append(f"{name} AS ({body.strip()})")
    return "WITH " + ",\n".join(parts) + "\n"

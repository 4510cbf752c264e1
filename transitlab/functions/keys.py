"""Text keys of the keyed store and the snapshot archive."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def iso_timestamp(col) -> Column:
    """ISO-8601 text of a timestamp: ``yyyy-MM-ddTHH:mm:ss`` plus ``.ffffff`` only when micros are non-zero."""
    ts = _c(col)
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.when(micros == "000000", base).otherwise(F.concat(base, F.lit("."), micros))


def _text(col) -> Column:
    # A present-but-null attribute is written as the text None (key templates never see a default).
    return F.coalesce(_c(col).cast("string"), F.lit("None"))


def _ts_text(col) -> Column:
    return F.coalesce(iso_timestamp(col), F.lit("None"))


def vehicle_pk(route_col="route_id") -> Column:
    return F.concat(F.lit("VEHICLE#"), _text(route_col))


def vehicle_sk(ts_col="timestamp", vehicle_col="vehicle_id") -> Column:
    return F.concat_ws("#", _ts_text(ts_col), _text(vehicle_col))


def trip_update_pk(route_col="route_id") -> Column:
    return F.concat(F.lit("TRIP#"), _text(route_col))


def trip_update_sk(ts_col="feed_timestamp", trip_col="trip_id", stop_col="stop_id") -> Column:
    return F.concat_ws("#", _ts_text(ts_col), _text(trip_col), _text(stop_col))


def archive_key(data_type: str | Column, ts_col) -> Column:
    """``transit/{type}/{yyyyMMdd}/{yyyyMMdd_HHmmss}.json`` for a snapshot taken at ``ts_col``."""
    dt = F.lit(data_type) if isinstance(data_type, str) else data_type
    ts = _c(ts_col)
    return F.format_string("transit/%s/%s/%s.json", dt, F.date_format(ts, "yyyyMMdd"),
                           F.date_format(ts, "yyyyMMdd_HHmmss"))

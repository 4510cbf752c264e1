"""Clock text, service dates and calendar features."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clock_to_seconds(col) -> Column:
    """Timetable clock text ``H:M:S`` -> seconds after midnight of the service day (BIGINT).

    Hours may pass 24 (trips after midnight). Parts after the third are ignored. Missing text, fewer than
    three parts or a part that is not an integer give 0, the same value as midnight.
    """
    parts = F.split(_c(col), ":")
    h, m, s = (_integer_text(F.get(parts, i)) for i in range(3))
    return F.coalesce(h * 3600 + m * 60 + s, F.lit(0).cast("bigint"))


def _integer_text(part: Column) -> Column:
    """Integer text -> BIGINT, null when not an integer. Accepts surrounding spaces, a sign, leading zeros
    and single underscores between digit groups ('1_0' is 10); rejects decimals, exponents and hex."""
    # the regular expression only runs on the rare parts that contain an underscore (AND short-circuits)
    grouped = part.contains("_") & part.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)+\s*$")
    return F.when(grouped, F.regexp_replace(part, "_", "")).otherwise(part).try_cast("bigint")


def parse_service_date(col) -> Column:
    """``yyyyMMdd`` text -> midnight TIMESTAMP of that day (the reference keeps service dates as timestamps).

    Malformed text fails the query (ANSI parse), as a strict format parse should.
    """
    return F.to_timestamp(_c(col), "yyyyMMdd")


def weekday_monday0(col) -> Column:
    """Day of week with Monday = 0 ... Sunday = 6 (INT)."""
    return F.weekday(_c(col)).cast("int")


def hour_of_day(col) -> Column:
    return F.hour(_c(col)).cast("int")


def is_weekend(col) -> Column:
    """1 on Saturday and Sunday, else 0."""
    return (weekday_monday0(col) >= 5).cast("int")


# Rush hours are 7-9 and 16-18 inclusive of the whole end hour.
RUSH_HOURS = ((7, 9), (16, 18))
# Parts of the day by hour (inclusive bounds): night 0-6, morning 7-12,
# afternoon 13-18, evening 19-23.
TIME_OF_DAY = (("night", 0, 6), ("morning", 7, 12), ("afternoon", 13, 18), ("evening", 19, 23))


def is_rush_hour(col) -> Column:
    h = hour_of_day(col)
    cond = None
    for lo, hi in RUSH_HOURS:
        c = h.between(lo, hi)
        cond = c if cond is None else (cond | c)
    return cond.cast("int")


def time_of_day(col) -> Column:
    h = hour_of_day(col)
    out = None
    for label, lo, hi in TIME_OF_DAY:
        out = (F.when(h.between(lo, hi), F.lit(label)) if out is None
               else out.when(h.between(lo, hi), F.lit(label)))
    return out

"""DataFrame -> DataFrame operators (quality, timetable joins, delays, live views, reports, features, models)."""

"""Transit analytics on Spark: every operator is a DataFrame -> DataFrame function.

Sub-packages
------------
sources    scans of timetable text files, landed feed snapshots, the archive and the keyed store
functions  column expressions (clock text, weekday, keys)
operators  quality checks, timetable joins, delay aggregates, live views, reports, features, models
plans      the registered queries (and their DuckDB oracles) over the supplied test tables
streaming  Structured Streaming versions of ingest and the live views
"""

__version__ = "0.1.0"

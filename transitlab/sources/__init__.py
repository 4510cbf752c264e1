"""Scans and sinks: timetable text files, feed snapshots, the snapshot archive, the keyed store."""

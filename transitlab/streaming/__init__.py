"""Structured Streaming forms of ingest (R1, R2) and of the live views (L1, L2)."""

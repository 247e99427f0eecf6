"""Incremental file-stream ingest and latest-state upserts."""

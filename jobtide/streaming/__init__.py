"""Incremental ingestion."""

from jobtide.streaming.ingest import ingest_new

__all__ = ["ingest_new"]

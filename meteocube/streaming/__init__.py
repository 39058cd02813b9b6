"""Structured Streaming form of the ingest stage (no other streams exist in the cube)."""

from .ingest import run_hourly_ingest, start_hourly_ingest

__all__ = ["run_hourly_ingest", "start_hourly_ingest"]

"""Readers: raw observations (CSV / parquet), stored cube tables, test-table mapping."""

from .raw import read_csv, read_csv_text, register_views, type_raw, typed_with_bad_text

__all__ = ["read_csv", "read_csv_text", "register_views", "type_raw", "typed_with_bad_text"]

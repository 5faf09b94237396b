"""Incremental, resumable runs with Structured Streaming."""

from .incremental import (  # noqa: F401
    append_results, compact_cache, csv_rows, csv_source, land_csv, read_lookup_cache, retry_transient,
    seen_keys, stream_clean, stream_enrich, TRANSIENT_ERRORS,
)

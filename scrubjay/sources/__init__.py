"""Readers, writers and the fixture views derived from the driver tables."""

from .tables import (  # noqa: F401
    NA_TOKENS, read_table, require_columns, normalize_na, typed_load, filtered_scan,
)
from .csv_split import read_csv_splits  # noqa: F401
from .sinks import write_table, path_exists, put_and_verify, load_table, stored_bytes  # noqa: F401

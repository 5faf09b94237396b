"""Scalar functions, all native ``Column`` expressions (no Python UDFs)."""

from .text import (  # noqa: F401
    strip, upper_strip, length, blank_to_null, try_int, fingerprint, pct,
    is_nullish,
)
from .keys import (  # noqa: F401
    is_valid_key, usable, missing_for_select, missing_for_fill,
)
from .json import RESPONSE_FIELDS, decode_response, first_result, parse_results  # noqa: F401

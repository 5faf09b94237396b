"""Key validity and the two 'missing value' predicates of the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import strip, upper_strip, _c

KEY_LENGTH = 17
# Characters never used in a vehicle identification number.
FORBIDDEN_KEY_CHARS = "IOQ"


def is_valid_key(c, ascii_only: bool = False) -> Column:
    """Key validity (F1/D1): strip, upper-case, then exactly 17 letters or
    digits (Unicode-aware like ``str.isalnum``), none of them I/O/Q. NULL is
    invalid (false, never NULL). One regex over the normalised key; the
    quantifier counts code points like Python's ``len``."""
    t = upper_strip(c, ascii_only)
    cls = "A-Z0-9" if ascii_only else r"\p{L}\p{N}"
    pattern = rf"\A[{cls}&&[^{FORBIDDEN_KEY_CHARS}]]{{{KEY_LENGTH}}}\z"
    return F.coalesce(t.rlike(pattern), F.lit(False))


def usable(c) -> Column:
    """Key present: not NULL and not blank after strip."""
    return F.coalesce(strip(_c(c)) != "", F.lit(False))


def missing_for_select(c) -> Column:
    """'Needs a value' when choosing keys to look up (P4): NULL, blank, or the
    literal texts ``nan`` / ``None``."""
    c = _c(c).cast("string")
    return F.coalesce(strip(c) == "", F.lit(True)) | c.isin("nan", "None")


def missing_for_fill(c) -> Column:
    """'May be overwritten' when filling (P5): NULL or blank only, so text
    ``None`` is looked up but never filled."""
    return F.coalesce(strip(_c(c).cast("string")) == "", F.lit(True))

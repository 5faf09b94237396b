"""String helpers with Python ``str`` semantics where the pipeline needs them."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DoubleType, FloatType

# Python's str.strip() removes exactly the characters for which
# str.isspace() is true (Unicode White_Space plus U+001C..U+001F). The set is
# derived from that rule, so ``btrim`` with it strips like Python with a
# single native call (no regex, the input referenced once).
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())
# ASCII subset, for data known to be plain ASCII.
_ASCII_WS = "".join(ch for ch in WHITESPACE if ord(ch) < 128)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c, ascii_only: bool = False) -> Column:
    """``str.strip()``: remove leading/trailing Unicode whitespace (F2).

    Spark's one-argument ``trim`` removes spaces only; this also strips tabs,
    NBSP, ideographic space etc., in line with Python.
    """
    return F.btrim(_c(c), F.lit(_ASCII_WS if ascii_only else WHITESPACE))


def upper_strip(c, ascii_only: bool = False) -> Column:
    """Normalised key: strip then upper-case (F2 + F3)."""
    return F.upper(strip(c, ascii_only))


def length(c) -> Column:
    """Length in code points as BIGINT."""
    return F.length(_c(c)).cast("bigint")


def blank_to_null(c) -> Column:
    """``s.strip() or None`` (F8)."""
    return F.nullif(strip(c), F.lit(""))


def try_int(c) -> Column:
    """``int(s)`` for text: optional sign and ASCII digits after stripping;
    anything else (``8.0``, ``V8``, blank) is NULL and the row is kept (F7).
    Values beyond INT range are NULL too."""
    s = strip(_c(c).cast("string"))
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))


def fingerprint(c, n: int = 12) -> Column:
    """First ``n`` hex digits of the MD5 of the text."""
    return F.substring(F.md5(_c(c).cast("string")), 1, n)


def pct(part, whole, digits: int | None = None) -> Column:
    """``part / whole * 100``, NULL when ``whole`` is 0."""
    v = F.try_divide(_c(part).cast("double"), _c(whole).cast("double")) * F.lit(100.0)
    return F.round(v, digits) if digits is not None else v


def is_nullish(c, dtype=None) -> Column:
    """NULL, or NaN for floating columns (F12): Spark keeps NaN apart from NULL."""
    c = _c(c)
    if isinstance(dtype, (DoubleType, FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def nullish_in(df, name: str) -> Column:
    """``is_nullish`` for column ``name`` of ``df`` (its type decides NaN)."""
    return is_nullish(F.col(f"`{name}`"), df.schema[name].dataType)

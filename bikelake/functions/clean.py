"""Column -> Column cleaners.

All of them are built-in expressions, so they stay inside whole-stage codegen.
Regexes use Java syntax (``$1`` back-references, replace-all by default).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the source system's cleaning rules.
# Station id normalisation, applied in this order:
#   1. trailing underscores:               _+$                 -> ""
#   2. trailing zeros after a decimal digit (\.\d*?[1-9])0+$  -> $1
#   3. a decimal part of zeros only:       \.0+$               -> ""
ID_TRAILING_UNDERSCORES = r"_+$"
ID_TRAILING_ZEROS = r"(\.\d*?[1-9])0+$"
ID_ZERO_FRACTION = r"\.0+$"
# Station names: single-letter compass direction followed by a number, "W 42" -> "W42".
NAME_DIRECTION_NUMBER = r"\b([NSEW])\s+(\d+)\b"
NAME_WHITESPACE_RUN = r"\s+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_id(c) -> Column:
    """Normalise a station id: trim, drop trailing ``_``, drop redundant decimal zeros."""
    s = F.trim(_c(c))
    s = F.regexp_replace(s, ID_TRAILING_UNDERSCORES, "")
    s = F.regexp_replace(s, ID_TRAILING_ZEROS, "$1")
    return F.regexp_replace(s, ID_ZERO_FRACTION, "")


def clean_name(c, collapse_ws: bool = True) -> Column:
    """Trim, optionally collapse whitespace runs, merge ``<direction> <number>``.

    ``collapse_ws=True`` is the trip cleaning, ``False`` the station-information one.
    """
    s = F.trim(_c(c))
    if collapse_ws:
        s = F.regexp_replace(s, NAME_WHITESPACE_RUN, " ")
    return F.regexp_replace(s, NAME_DIRECTION_NUMBER, "$1$2")


def normalize_category(c) -> Column:
    """``lower(trim(c))`` — rider type / bike type."""
    return F.lower(F.trim(_c(c)))


def non_blank(c) -> Column:
    """``c is not null and trim(c) != ''``."""
    col = _c(c)
    return col.isNotNull() & (F.trim(col) != F.lit(""))


def to_type(c, dtype: str, strict: bool = False) -> Column:
    """Cast; by default ``try_cast`` so one malformed value yields NULL instead of
    failing the whole batch under ANSI mode (trap T1)."""
    col = _c(c)
    return col.cast(dtype) if strict else col.try_cast(dtype)


def epoch_to_ts(c) -> Column:
    """Epoch seconds -> timestamp (equals ``from_unixtime(x).cast('timestamp')`` in UTC)."""
    return F.timestamp_seconds(_c(c))


def duration_minutes(start, end) -> Column:
    """Whole-second difference in minutes, two decimals (negatives kept)."""
    secs = _c(end).cast("long") - _c(start).cast("long")
    return F.round(secs / F.lit(60.0), 2)


def round_decimal(c, scale: int) -> Column:
    """HALF_UP rounding of a double through ``decimal(28,10)``, returned as double.

    Removes the dependence on the binary expansion (17.935 -> 17.94 on every
    engine) and on summation order of ``avg`` (trap T2).
    """
    return F.round(_c(c).cast("decimal(28,10)"), scale).cast("double")


def guarded_pct(part, whole) -> Column:
    """``round(part * 100 / whole, 2)`` when ``whole > 0`` else NULL (X13), as double."""
    w = _c(whole)
    pct = F.round(_c(part).cast("decimal(20,0)") * F.lit(100) / w.cast("decimal(20,0)"), 2)
    return F.when(w > 0, pct.cast("double"))


def null_safe_sum(*cols) -> Column:
    """``coalesce(a,0) + coalesce(b,0) + ...``."""
    out = None
    for c in cols:
        term = F.coalesce(_c(c), F.lit(0))
        out = term if out is None else out + term
    return out

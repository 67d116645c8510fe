"""Cleaning of in-band missing codes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The in-band codes that mean "missing".
MISSING = ("", "~01", "~02", "~03", "~NA", "~DV", "UNK")
MISSING_OR_NA = ("", "~01", "~02", "~03", "~NA", "~DV", "UNK", "NA")
MISSING_EMPLOYEE = ("", "~EZ", "~NZ", "~ZZ", "~UD", "~AL", "UNK")

NOT_AVAILABLE = "NA"
UNKNOWN = "UNK"

# What a caret inside a code turns into.  The established output carries the
# letter s; "space" is what the cleaning step was evidently meant to do.
CARET_MODES = {"letter": "s", "space": " "}

Transform = Callable[[Column], Column]


def is_missing(
    x: Column, sentinels: Sequence[str] = MISSING, *, null_is_missing: bool = True
) -> Column:
    """True for a sentinel and, unless switched off, for NULL."""
    hit = x.isin(*sentinels)
    return hit | x.isNull() if null_is_missing else hit


def caret_fix(x: Column, mode: str = "letter") -> Column:
    """Replace carets, trim blanks, upper-case."""
    return F.upper(F.trim(F.replace(x, F.lit("^"), F.lit(CARET_MODES[mode]))))


def upper_trim(x: Column) -> Column:
    return F.upper(F.trim(x))


def keep(x: Column) -> Column:
    return x


def clean_code(
    x: Column,
    sentinels: Sequence[str] = MISSING,
    *,
    null_is_missing: bool = True,
    transform: Transform = keep,
) -> Column:
    """``"NA"`` for a missing code, otherwise ``transform(x)``.

    With ``null_is_missing=False`` a NULL stays NULL.
    """
    missing = is_missing(x, sentinels, null_is_missing=null_is_missing)
    return F.when(missing, F.lit(NOT_AVAILABLE)).otherwise(transform(x))


def or_unknown(x: Column, transform: Transform = keep) -> Column:
    """``"UNK"`` for NULL, otherwise ``transform(x)``."""
    return F.when(x.isNull(), F.lit(UNKNOWN)).otherwise(transform(x))

"""Text cell functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabforge.config import NA_TOKENS, SYMBOLS

# Python's ASCII whitespace (str.isspace over ASCII): \t \n \v \f \r, \x1c-\x1f, space.
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def na_to_null(c: Column | str, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Cells equal to one of the NA tokens become null (exact, case-sensitive)."""
    c = _col(c)
    return F.when(~c.isin(list(tokens)), c)


def ascii_fold(c: Column | str) -> Column:
    """Drop every non-ASCII character; null stays null.

    Pure-ASCII text (byte length = character length, both cheap) skips the
    regex.
    """
    c = _col(c)
    return F.when(F.octet_length(c) == F.length(c), c).otherwise(F.regexp_replace(c, "[^\\x00-\\x7F]", ""))


def strip_symbols(c: Column | str, symbols: str = SYMBOLS) -> Column:
    """Delete each of ``symbols`` from the text. ``translate`` runs only on
    texts containing one of them (``contains`` is a plain byte search)."""
    c = _col(c)
    if not symbols:
        return c
    has = c.contains(symbols[0])
    for ch in symbols[1:]:
        has = has | c.contains(ch)
    return F.when(has, F.translate(c, symbols, "")).otherwise(c)


def cell_is_valid(c: Column | str, invalid: str = "?") -> Column:
    """Null is valid; text is valid unless it equals ``invalid`` or is blank."""
    c = _col(c)
    # Fast path without allocation: a first byte above 0x20 (byte-wise
    # c >= '!') is not blank; only texts starting with a blank are trimmed.
    non_blank = F.when(c >= F.lit("!"), F.lit(True)).otherwise(F.btrim(c, F.lit(_BLANKS)) != F.lit(""))
    return c.isNull() | ((c != F.lit(invalid)) & non_blank)


def is_missing(c: Column | str, is_double: bool = False) -> Column:
    """Null test; NaN also counts as missing for floating columns."""
    c = _col(c)
    return (c.isNull() | F.isnan(c)) if is_double else c.isNull()

"""Safe type coercions: text that does not parse becomes null, never an error.

All are built-in expressions (one regular expression and ``try_cast``), so
ANSI mode never raises and nothing leaves the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Plain decimal literals (optional sign, fraction, exponent, surrounding
# whitespace) are what the source application's numeric parser accepts.
# Any character outside the decimal alphabet (digits, signs, point, e/E, \s).
_NOT_DECIMAL_CHAR = r"[^0-9+\-.eE \t\n\x0B\f\r]"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_double(c: Column | str) -> Column:
    """Text → double; non-decimal text, overflow (±inf) and NaN → null.

    Accepts exactly the plain decimal grammar (optional sign, digits with an
    optional point, optional exponent, surrounding whitespace). Spark's own
    cast accepts more only through letters or ``_`` (``1d``, ``Infinity``,
    ``NaN``, hex), so a text made of digits, signs, points, ``e``/``E`` and
    whitespace alone is handed to ``try_cast`` (which rejects any malformed
    arrangement of those characters). The check is one character-class scan —
    no backtracking, no capture — and the ``nullif`` chain shares its argument.
    """
    c = _col(c).cast("string")
    x = F.when(~c.rlike(_NOT_DECIMAL_CHAR), c).try_cast("double")
    return F.nullif(F.nullif(x, F.lit(float("inf"))), F.lit(float("-inf")))


_INTEGER = r"^\s*[+-]?[0-9]+\s*$"


def long_from_double(x: Column | str) -> Column:
    """Integral double → bigint; fractional, non-finite, out of range → null."""
    x = _col(x)
    return F.when(F.floor(x) == x, x).try_cast("bigint")


def exact_integer(c: Column | str) -> Column:
    """Text of digits with an optional sign → bigint, all 64 bits exact; any other text → null."""
    c = _col(c).cast("string")
    return F.when(c.rlike(_INTEGER), F.btrim(c, F.lit(" \t\n\x0b\f\r"))).try_cast("bigint")


def _inexact(c: Column | str) -> Column:
    """The double of a text that is not plain digits (``2.0``, ``1e3``)."""
    c = _col(c).cast("string")
    return safe_double(F.when(~c.rlike(_INTEGER), c))


def safe_long(c: Column | str) -> Column:
    """Text → bigint: digits exactly; ``'2.0'`` and ``'1e3'`` by way of a
    double; fractional, non-finite or out-of-range values → null.

    Over whole columns prefer :func:`coerce_frame`, which parses once into a
    column and checks integrality in a second projection.
    """
    return F.coalesce(exact_integer(c), long_from_double(_inexact(c)))


_TIME = r"(?:[ T]([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:\.([0-9]{1,6})[0-9]*)?)?)?"
_MONTH = r"(Jan(?:uary)?|Feb(?:ruary)?|Mar(?:ch)?|Apr(?:il)?|May|June?|July?|Aug(?:ust)?|Sep(?:t(?:ember)?)?|Oct(?:ober)?|Nov(?:ember)?|Dec(?:ember)?)"
#: Date layouts with the groups of year, month and day (None: the first). Each text has one of these shapes at most; numbers
#: with the year last are read month first and, where that gives no date, day first.
_DATES = [
    (r"([0-9]{4})[-/.]([0-9]{1,2})[-/.]([0-9]{1,2})", 1, 2, 3), (r"([0-9]{4})([0-9]{2})([0-9]{2})", 1, 2, 3),
    (r"([0-9]{1,2})([-/.])([0-9]{1,2})\{sep}([0-9]{4}|[0-9]{2})", 4, 1, 3),
    (rf"([0-9]{{1,2}})[ -]{_MONTH}[ -]([0-9]{{4}})", 3, 2, 1), (rf"{_MONTH}[ -]([0-9]{{1,2}}),?[ -]([0-9]{{4}})", 3, 1, 2),
    (rf"{_MONTH}[ -]([0-9]{{4}})", 2, 1, None), (r"([0-9]{4})", 1, None, None),
]
_READ = "\u0001"


def _date_pattern() -> tuple[str, str]:
    """One pattern of all layouts, and what a match is replaced by: year, month, day, hour, minute, second, fraction, order.

    Of a field's groups in the different layouts one takes part in a match, so
    that they can stand side by side in the replacement.
    """
    shapes, fields, before = [], {"year": "", "month": "", "day": "", "order": ""}, 0
    for shape, year, month, day in _DATES:
        if "{sep}" in shape:
            fields["order"] += f"${before + 2}"
            shape = shape.replace("{sep}", str(before + 2))
        for field, group in (("year", year), ("month", month), ("day", day)):
            if group:
                fields[field] += f"${before + group}"
        shapes.append(shape)
        before += re.compile(shape.replace(f"\\{before + 2}", "")).groups
    time = [f"${before + i}" for i in range(1, 5)]
    return f"(?i)^(?:{'|'.join(shapes)}){_TIME}$", _READ + "|".join([fields["year"], fields["month"], fields["day"], *time, fields["order"]])


_DATE_PATTERN, _DATE_PARTS = _date_pattern()


def _once(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def safe_timestamp(c: Column | str) -> Column:
    """Text → timestamp_ntz by the layout that it has; none, or no such date → null.

    All layouts are one pattern, matched once: the match is replaced by its
    parts, which are put into ISO form and cast without any time zone, so the
    result does not depend on the session's. Blanks around the text, one- or
    two-digit months and days, month names, two-digit years (69 and later:
    1900s) and times to the microsecond are read. A bare number is a date only
    as ``yyyymmdd`` or ``yyyy``.
    """
    c = F.btrim(_col(c).cast("string"), F.lit(" \t\n\x0b\f\r"))

    def read(parts: Column) -> Column:
        part = [F.get(parts, F.lit(i)) for i in range(8)]
        year, month, day, hour, minute, second, fraction, order = part
        full = lambda x, missing: F.when(x == "", F.lit(missing)).otherwise(x)
        year = F.when(F.length(year) == 2, F.concat(F.when(year >= "69", F.lit("19")).otherwise(F.lit("20")), year)).otherwise(year)
        named = ((F.position(F.lower(F.substring(month, 1, 3)), F.lit("janfebmaraprmayjunjulaugsepoctnovdec")) + 2) / 3).cast("int").cast("string")
        month = F.when(month >= "A", named).otherwise(full(month, "1"))
        time = F.concat(F.lit(" "), F.concat_ws(":", full(hour, "0"), full(minute, "0"), full(second, "0")), F.lit("."), full(fraction, "0"))
        date = lambda m, d: F.concat(F.concat_ws("-", year, m, d), time).try_cast("timestamp_ntz")
        return F.coalesce(date(month, full(day, "1")), F.when(order != "", date(day, month)))

    told = F.regexp_replace(c, _DATE_PATTERN, _DATE_PARTS)
    return _once(told, lambda t: F.when(t.startswith(_READ), _once(F.split(F.substring(t, 2, 99), r"\|", -1), read)))


def safe_boolean(c: Column | str, true_values: Sequence[str] = ("true", "yes", "1")) -> Column:
    """Text → boolean: lower-cased value in ``true_values``; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.lower(c.cast("string")).isin(list(true_values)))


def safe_string(c: Column | str) -> Column:
    """Any value → its text; null stays null."""
    return _col(c).cast("string")


def coerce_by_dtype(c: Column | str, dtype: str) -> Column:
    """Dispatch on a pandas-style dtype name from the column-type config.

    ``Int64``/``int64`` → bigint, ``float64`` → double, ``datetime64[ns]`` →
    timestamp_ntz, ``bool`` → boolean, ``string*``/``object*`` → string, any
    other name → double.
    """
    d = dtype.lower()
    if d in ("int64", "int32", "integer"):
        return safe_long(c)
    if d == "float64":
        return safe_double(c)
    if d.startswith("datetime64"):
        return safe_timestamp(c)
    if d in ("bool", "boolean"):
        return safe_boolean(c)
    if d.startswith("string") or d.startswith("object"):
        return safe_string(c)
    return safe_double(c)


def spark_type_of(dtype: str) -> str:
    """Spark SQL type name produced by :func:`coerce_by_dtype` for ``dtype``."""
    d = dtype.lower()
    if d in ("int64", "int32", "integer"):
        return "bigint"
    if d.startswith("datetime64"):
        return "timestamp_ntz"
    if d in ("bool", "boolean"):
        return "boolean"
    if d.startswith("string") or d.startswith("object"):
        return "string"
    return "double"


def coerce_frame(df, column_types: dict[str, str]):
    """Coerce every configured column of ``df`` to its configured type.

    Columns already of the target type are left alone. An integer column's text
    is read in one projection, its digits exactly and anything else as a double,
    and joined in the next, so each runs once per cell (the optimizer keeps a
    non-cheap column that is used twice in its own projection).
    """
    current = dict(df.dtypes)
    todo = {c: d for c, d in column_types.items() if c in current and current[c] != spark_type_of(d)}
    longs = {c for c, d in todo.items() if spark_type_of(d) == "bigint"}

    def q(c):
        return F.col(f"`{c}`")

    def read(c):
        if c in longs:
            return F.struct(exact_integer(q(c)).alias("exact"), _inexact(q(c)).alias("inexact"))
        return coerce_by_dtype(q(c), todo[c])

    out = df.select(*[read(c).alias(c) if c in todo else q(c) for c in df.columns])
    if longs:
        whole = lambda c: F.coalesce(q(c)["exact"], long_from_double(q(c)["inexact"]))
        out = out.select(*[whole(c).alias(c) if c in longs else q(c) for c in out.columns])
    return out

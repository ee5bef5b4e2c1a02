"""Column expressions shared by the marts.

All of these are built-in Catalyst expressions, so they stay inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Game types that count as playoff games, and the clock
# boundaries (minutes after midnight) of the day parts.
PLAYOFF_TYPES = ("WC", "DIV", "CON", "SB")
PRIMETIME_ALWAYS_DAYS = ("Monday", "Thursday")
PRIMETIME_LATE_DAYS = ("Sunday", "Saturday")
AFTERNOON_START_MIN = 15 * 60
EVENING_START_MIN = 19 * 60

_CLOCK_PATTERN = r"^\d{1,2}:\d{2}$"


def clock_minutes(text: Column | str) -> Column:
    """``'H:MM'``/``'HH:MM'`` text to minutes after midnight, else NULL.

    Text that does not match the pattern (empty, ``TBD``) is NULL.  A time that
    matches but is not a clock time (``25:99``) is NULL too instead of an error.
    """
    t = F.col(text) if isinstance(text, str) else text
    parts = F.split(t, ":")
    hour = F.get(parts, 0).try_cast("int")
    minute = F.get(parts, 1).try_cast("int")
    valid = t.rlike(_CLOCK_PATTERN) & (hour < 24) & (minute < 60)
    return F.when(valid, hour * 60 + minute)


def empty_to_null(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.nullif(c, F.lit(""))


def name_or_display(name: str = "player_name", display: str = "player_display_name") -> Column:
    """Short name when present and not empty, else the display name."""
    return F.coalesce(empty_to_null(name), F.col(display))


def round_int(c: Column | str) -> Column:
    """Float to int rounding half to even, like a ``::int`` cast of a real.

    A plain Spark cast truncates (3.7 -> 3); ``rint`` rounds half-even first.
    """
    c = F.col(c) if isinstance(c, str) else c
    return F.rint(c).cast("int")


def strip_ws(c: Column | str) -> Column:
    """Strip every kind of leading and trailing white space (tabs too)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def lenient_int(c: Column | str) -> Column:
    """Text or number to a nullable bigint: bad text -> NULL, ``'3.0'`` -> 3."""
    c = F.col(c) if isinstance(c, str) else c
    as_double = c.cast("string").try_cast("double")
    whole = F.when(as_double == F.floor(as_double), as_double)
    return whole.try_cast("bigint")


def ratio(num: Column, den: Column, places: int) -> Column:
    """``ROUND(num / NULLIF(den, 0), places)`` with exact decimal arithmetic.

    Both sides are cast to decimals, so rounding is half-up on the exact
    quotient (never on a binary approximation); a zero denominator gives
    NULL.  The result is a double.
    """
    q = F.try_divide(to_decimal(num), den.cast("decimal(20,0)"))
    return F.round(q, places).cast("double")


def to_decimal(c: Column) -> Column:
    """Exact decimal of a count or a sum: 26 integer and 12 fractional digits.

    A double is taken at its decimal value to 12 places (as a ``real`` is
    read into ``numeric``); the quotient of two such values keeps 12
    places, enough to round to 4 places on the exact side of every tie.
    """
    return c.cast("decimal(38,12)")


def round_avg(c: Column | str, places: int) -> Column:
    """``ROUND(AVG(c), places)`` on the exact average (NULLs ignored)."""
    c = F.col(c) if isinstance(c, str) else c
    return ratio(F.sum(c), F.count(c), places)


def flag_sum(cond: Column, value: Column | int = 1) -> Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``: 0 when nothing qualifies."""
    v = value if isinstance(value, Column) else F.lit(value)
    return F.sum(F.when(cond, v).otherwise(F.lit(0)))


def filter_sum(cond: Column, value: Column) -> Column:
    """``SUM(value) FILTER (WHERE cond)``: NULL when nothing qualifies."""
    return F.sum(F.when(cond, value))


def dash_key(*parts: Column | str) -> Column:
    """``a || '-' || b || ...``; NULL if any part is NULL (unlike concat_ws)."""
    cols: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            cols.append(F.lit("-"))
        cols.append((F.col(p) if isinstance(p, str) else p).cast("string"))
    return F.concat(*cols)


def first_present(columns: Iterable[str], options: Iterable[str]) -> str | None:
    """First of ``options`` that is a column name in ``columns``."""
    have = set(columns)
    for name in options:
        if name in have:
            return name
    return None

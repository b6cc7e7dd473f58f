"""Column functions that give irregular input one meaning.  Null in, null out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^\s*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\s*$"
_INSTANT = r"^\d{4}-\d{2}-\d{2}(?:[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)?)?$"


def number(text: Column) -> Column:
    """A string as a double; null unless it is a plain decimal or scientific number."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def instant(text: Column) -> Column:
    """A string as a UTC timestamp; null unless it is a whole ISO-8601 date or instant."""
    return F.when(text.rlike(_INSTANT), F.regexp_replace(text, ",", ".").try_cast("timestamp"))


def real(x: Column) -> Column:
    """A double without NaN."""
    return F.when(~F.isnan(x), x)


def finite(x: Column) -> Column:
    """Whether a number is neither null, NaN nor infinite."""
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))


def whole(x: Column) -> Column:
    """A number as a long, halves to the even neighbour."""
    return F.bround(real(x)).cast("bigint")


def plus_seconds(at: Column, seconds: Column) -> Column:
    """A timestamp so many seconds later, to the microsecond."""
    return at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def seconds_between(later: Column, earlier: Column) -> Column:
    micros = lambda t: F.unix_micros(t.cast("timestamp"))
    return (micros(later) - micros(earlier)) / 1e6


def close(a: Column, b: Column, tolerance: float = 1e-9) -> Column:
    """Both null, or within ``tolerance``; never null."""
    return (a.isNull() & b.isNull()) | F.coalesce(F.abs(a - b) <= tolerance, F.lit(False))


def rounded(x: Column, digits: int = 6) -> Column:
    """A double for comparison across engines; no negative zero."""
    return F.round(x, digits) + F.lit(0.0)


def member(text: Column, *names: str) -> Column:
    """Whether a string is one of ``names``, regardless of case and outer blanks; all are for none."""
    return F.lower(F.trim(text)).isin([n.strip().lower() for n in names]) if names else F.lit(True)


def band(x: Column, low=None, high=None, plausible=None, documented=None, above_low: bool = False) -> Column:
    """``below``, ``above``, ``implausible``, ``undocumented`` or ``ok``: the first that holds.

    ``low`` itself is below if ``above_low``; ``plausible`` and ``documented`` are (low, high).
    """
    outside = lambda r: (x < r[0]) | (x > r[1])
    label = F.when(x.isNull(), None)
    if low is not None:
        label = label.when(x <= low if above_low else x < low, "below")
    if high is not None:
        label = label.when(x > high, "above")
    if plausible:
        label = label.when(outside(plausible), "implausible")
    if documented:
        label = label.when(outside(documented), "undocumented")
    return label.otherwise("ok")


#: A gap in laps, such as "+1 LAP".
LAPPED = r"^\+\d+ LAPS?$"

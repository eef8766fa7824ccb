"""Date assembly, parsing, formatting and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def date_from_parts(y, m, d) -> Column:
    """Strict: parts are cast to int; an impossible date raises (ANSI)."""
    return F.make_date(_c(y).cast("int"), _c(m).cast("int"), _c(d).cast("int"))


def date_from_parts_coerce(y, m, d) -> Column:
    """Coercing: an impossible date (month 13, 30 February, ...) is NULL.
    Validated arithmetically (no text parsing); ``make_date`` only runs on
    valid parts, so ANSI mode never raises here."""
    yi, mi, di = (_c(x).try_cast("int") for x in (y, m, d))
    last = F.dayofmonth(F.last_day(F.make_date(yi, mi, F.lit(1))))
    valid = yi.between(1, 9999) & mi.between(1, 12) & (di >= 1) & (di <= last)
    return F.when(valid, F.make_date(yi, mi, di))


def date_from_yyyymmdd(c, strict: bool = True) -> Column:
    """A ``yyyymmdd`` number (possibly a double from a matrix) as a date,
    split arithmetically (no text round trip).  Strict: an impossible date
    fails the query (ANSI); otherwise it is NULL."""
    n = _c(c).cast("bigint")
    y, m, d = (n / 10000).cast("int"), ((n / 100).cast("bigint") % 100).cast("int"), (n % 100).cast("int")
    return F.make_date(y, m, d) if strict else date_from_parts_coerce(y, m, d)


def last_trading_day(c) -> Column:
    """Saturday -> Friday, Sunday -> Friday, weekdays unchanged (no holidays)."""
    d = _c(c)
    return F.date_sub(d, F.greatest(F.lit(0), F.weekday(d) - 4))


def relative_date(c, days: int) -> Column:
    return F.date_sub(_c(c), days)


def is_weekday(c) -> Column:
    return F.weekday(_c(c)) < 5


DATE_STYLES = {"iso": "yyyy-MM-dd", "compact": "yyyyMMdd"}


def format_date(c, style: str = "iso") -> Column:
    """Date as text: ``iso`` = 2024-01-31, ``compact`` = 20240131."""
    return F.date_format(_c(c), DATE_STYLES.get(style, style))

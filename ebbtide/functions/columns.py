"""Scalar rules as Column expressions; all of them stay inside generated code."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MISSING = "__missing__"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num: Column | str, den: Column | str, default: float = 0.0, mode: str = "nonzero") -> Column:
    """Double division that answers ``default`` for an unusable denominator.

    ``nonzero`` rejects a NULL or zero denominator; ``positive`` also rejects a
    negative one. A NULL numerator over a usable denominator stays NULL.
    """
    num, den = _col(num), _col(den)
    usable = {"nonzero": den.isNotNull() & (den != 0), "positive": den > 0}[mode]
    return F.when(usable, num.cast("double") / den.cast("double")).otherwise(F.lit(float(default)))


def null_outside(c: Column | str, low, high) -> Column:
    """The value where it lies in [low, high], NULL elsewhere."""
    c = _col(c)
    return F.when(c.between(low, high), c)


def normalize_category(c: Column | str, allowed: Sequence[str], default: str = "unknown") -> Column:
    """The value where it is one of ``allowed`` (exact case), else ``default``."""
    c = _col(c)
    return F.when(c.isin(*allowed), c).otherwise(default)


def less_flag(a: Column | str, b: Column | str) -> Column:
    """1 where a < b, 0 otherwise, also when either side is NULL."""
    return F.when(_col(a) < _col(b), 1).otherwise(0)


def present_flag(c: Column | str) -> Column:
    """1 where the column holds a value, 0 where it is NULL."""
    return _col(c).isNotNull().cast("int")


def row_sum(columns: Sequence[str]) -> Column:
    """Sum across columns of one row; one NULL makes the whole row NULL."""
    total = F.col(columns[0])
    for name in columns[1:]:
        total = total + F.col(name)
    return total


def parse_ymd(c: Column | str, strict: bool = False) -> Column:
    """YYYYMMDD integer to DATE; bad input raises when strict, else gives NULL.

    Days up to the 28th are put together from the digits, which is far cheaper
    than parsing text; the rest, with everything malformed, goes to the parser.
    """
    c = _col(c)
    eight_digits = c.between(10000101, 99991231)
    plain = eight_digits & (c % 10000).between(101, 1231) & (c % 100).between(1, 28)
    year, month = (F.call_function("div", c, F.lit(n)) for n in (10000, 100))
    text = c.cast("string")
    parsed = F.to_date(text, "yyyyMMdd") if strict else F.when(eight_digits, F.try_to_date(text, "yyyyMMdd"))
    return F.when(plain, F.make_date(year.cast("int"), (month % 100).cast("int"), (c % 100).cast("int"))).otherwise(
        parsed
    )


def ymd_of(c: Column | str) -> Column:
    """DATE or timestamp to YYYYMMDD integer."""
    c = _col(c)
    return F.year(c) * 10000 + F.month(c) * 100 + F.day(c)


def days_between(start: Column | str, end: Column | str) -> Column:
    """Day boundaries crossed from ``start`` to ``end`` (negative when reversed)."""
    return F.datediff(_col(end), _col(start))


def ymd_month(c: Column | str) -> Column:
    """YYYYMMDD integer to its YYYYMM integer."""
    return F.call_function("div", _col(c), F.lit(100)).cast("int")


def month_start(c: Column | str) -> Column:
    """YYYYMM integer to the first DATE of that month."""
    return F.to_date(F.concat(_col(c).cast("string"), F.lit("01")), "yyyyMMdd")


def date_literal(value: str | dt.date) -> Column:
    return F.lit(dt.date.fromisoformat(value) if isinstance(value, str) else value)


def in_ymd_window(c: Column | str, window: tuple[int, int]) -> Column:
    """Inclusive test on YYYYMMDD integers; reaches the scan as a pushed filter."""
    return _col(c).between(*window)


def clip_upper(c: Column | str, limit: float) -> Column:
    """Values above the limit become the limit; NULL stays NULL."""
    c = _col(c)
    return F.when(c > limit, F.lit(limit)).otherwise(c)


def zero_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(0))


def log1p(c: Column | str) -> Column:
    return F.log1p(_col(c))


def category_text(c: Column | str) -> Column:
    """Category as text, with a sentinel level for NULL."""
    return F.coalesce(_col(c).cast("string"), F.lit(MISSING))


def percent_lift(before: Column | str, after: Column | str) -> Column:
    """Reduction from ``before`` to ``after`` in percent of ``before``; NULL if that is 0."""
    before, after = _col(before), _col(after)
    return F.try_divide(before - after, before) * F.lit(100.0)

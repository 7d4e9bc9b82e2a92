"""Column helpers: arithmetic, text, and date expressions on single rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def known(c: str | Column) -> Column:
    """NaN becomes null, so that missing has one spelling."""
    return F.when(F.isnan(_col(c)), None).otherwise(_col(c))


def price_range(high="high", low="low") -> Column:
    return _col(high) - _col(low)


def price_change(close="close", open_="open") -> Column:
    return _col(close) - _col(open_)


def hl_ratio(high="high", low="low", close="close") -> Column:
    return F.try_divide(price_range(high, low), _col(close)) * 100


def growth(now: str | Column, before: str | Column) -> Column:
    """Percent change. From zero it is signed infinity, and missing for zero to zero."""
    now, before = _col(now), _col(before)
    from_zero = F.when(now > 0, F.lit(INFINITY)).when(now < 0, F.lit(-INFINITY))
    return F.when(before == 0, from_zero).otherwise((F.try_divide(now, before) - 1) * 100)


def deviation_pct(predicted, current) -> Column:
    """Absolute distance of the prediction from the price, in percent of the price."""
    return F.try_divide(F.abs(_col(predicted) - _col(current)), _col(current)) * 100


def direction(predicted, current) -> Column:
    return F.when(_col(predicted) > _col(current), "up").otherwise("down")


def bar_color(close="close", open_="open") -> Column:
    return F.when(_col(close) >= _col(open_), "up").otherwise("down")


def rsi_level(rsi: str | Column, low: float = 30, high: float = 70) -> Column:
    rsi = _col(rsi)
    return F.when(rsi > high, "overbought").when(rsi < low, "oversold")


def error_pct(actual, predicted) -> Column:
    return F.try_divide(_col(actual) - _col(predicted), _col(actual)) * 100


def safe_name(c: str | Column) -> Column:
    """A symbol or feature-set name usable in a path."""
    return F.translate(_col(c), "/ ^", "__")


def safe_text(name: str) -> str:
    """`safe_name` for a plain string."""
    return name.replace("^", "").replace("/", "_").replace(" ", "_")


def to_number(c: str | Column) -> Column:
    return known(_col(c).try_cast("double"))


def two_decimals(c: str | Column) -> Column:
    """A number as text with two decimals; halves go up."""
    return F.format_string("%.2f", F.floor(_col(c) * 100 + 0.50001) / 100)


def to_day(c: str | Column) -> Column:
    """Date from text such as 2024-01-02 or 2024-01-02T00:00:00.000; null when unreadable."""
    return F.to_date(_col(c).try_cast("timestamp"))


def month_key(c: str | Column = "date") -> Column:
    return F.date_format(_col(c), "yyyy-MM")


def day_text(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd")


def second_text(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd HH:mm:ss")


def iso_text(c: str | Column) -> Column:
    return F.date_format(_col(c), "yyyy-MM-dd'T'HH:mm:ss")


def next_date(c: str | Column = "date", calendar: str = "day") -> Column:
    """The following calendar day, or the following weekday with `calendar="business"`."""
    day = _col(c)
    if calendar == "day":
        return F.date_add(day, 1)
    if calendar != "business":
        raise ValueError(f"unknown calendar {calendar!r}")
    weekday = F.dayofweek(day)  # Sunday is 1
    step = F.when(weekday == 6, 3).when(weekday == 7, 2).otherwise(1)
    return F.date_add(day, step)


def in_range(c: str | Column, start=None, end=None) -> Column:
    """`start <= c < end`; either bound may be left out."""
    test = F.lit(True)
    if start is not None:
        test = test & (_col(c) >= F.lit(start))
    if end is not None:
        test = test & (_col(c) < F.lit(end))
    return test


def pair_key(line: str | Column) -> Column:
    """Key of a tab-separated pair line."""
    return F.split_part(_col(line), F.lit("\t"), F.lit(1))


def pair_value(line: str | Column) -> Column:
    """Value of a tab-separated pair line."""
    return F.split_part(_col(line), F.lit("\t"), F.lit(2))


def or_unknown(c: str | Column) -> Column:
    return F.coalesce(_col(c), F.lit("Unknown"))

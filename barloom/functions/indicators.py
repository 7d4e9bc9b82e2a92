"""Indicators for `operators.series.measure`."""

from __future__ import annotations

import math
import operator
from functools import partial, reduce

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.functions import columns as C
from barloom.operators.series import POSITION, Indicator

# An average stops looking back where the weight of older rows falls below 2^-64, under the
# rounding of a double; block weights stay below e^650, inside a double's range.
FORGET = 64 * math.log(2)
OVERFLOW = 650
# Rolling sums are built from sums of 4, 16, 64, .. rows.
RADIX = 4


def _shifted(col: str, k: int, w: WindowSpec) -> Column:
    return F.lag(col, k).over(w) if k else F.col(col)


def _power_sums(col: str, n: int) -> list[dict]:
    """Sums of the last 4, 16, 64, .. rows, each from the one before it, up to n rows."""
    steps = []
    name, size = col, 1
    while size * RADIX <= n:
        wider = _sum_name(col, size * RADIX)
        steps.append({wider: partial(_pieces, name, size, 0, RADIX)})
        name, size = wider, size * RADIX
    return steps


def _sum_name(col: str, size: int) -> str:
    return col if size == 1 else f"_{col.lstrip('_')}_sum{size}"


def _pieces(name: str, size: int, skip: int, count: int, w: WindowSpec) -> Column:
    parts = [_shifted(name, skip + i * size, w) for i in range(count)]
    return reduce(operator.add, parts)


def _rolling_sum(col: str, n: int, w: WindowSpec, skip: int = 0) -> Column:
    """Sum of the n rows that end `skip` rows back, put together from the power sums.

    Null when a value is missing or the series is too short. A frame of n rows would be added up
    again for every row; this takes a few lags, and keeps the precision of short sums, which a
    difference of running totals would lose.
    """
    pieces = []
    size = RADIX ** len(_power_sums(col, n))
    while size:
        count, n = divmod(n, size)
        if count:
            pieces.append(_pieces(_sum_name(col, size), size, skip, count, w))
            skip += count * size
        size //= RADIX
    return reduce(operator.add, pieces)


def sma(col: str, n: int, out: str) -> Indicator:
    """Mean of the last n rows; missing until n known values exist."""
    value = {out: lambda w: _rolling_sum(col, n, w) / n}
    return Indicator((*_power_sums(col, n), value), before=n - 1)


def lagged(col: str, k: int, out: str) -> Indicator:
    return Indicator(({out: lambda w: F.lag(col, k).over(w)},), before=k)


def lead(col: str, k: int, out: str) -> Indicator:
    return Indicator(({out: lambda w: F.lead(col, k).over(w)},), after=k)


def trailing_mean(col: str, n: int, out: str) -> Indicator:
    """Mean of the n rows before the current one; missing until n exist."""
    value = {out: lambda w: _rolling_sum(col, n, w, skip=1) / n}
    return Indicator((*_power_sums(col, n), value), before=n)


def diff(col: str, out: str, order: int = 1) -> Indicator:
    """First difference, or the difference of it with `order=2`."""
    if order == 1:
        return Indicator(({out: lambda w: F.col(col) - F.lag(col, 1).over(w)},), before=1)
    if order != 2:
        raise ValueError("order is 1 or 2")

    def second(w: WindowSpec) -> Column:
        previous = F.lag(col, 1).over(w)
        return (F.col(col) - previous) - (previous - F.lag(col, 2).over(w))

    return Indicator(({out: second},), before=2)


def pct_change(col: str, out: str, k: int = 1) -> Indicator:
    """Percent change over k rows. Forward-fill `col` first when it can be missing."""
    helper = f"_{col}_lag{k}"
    return Indicator(
        ({helper: lambda w: F.lag(col, k).over(w)}, {out: lambda w: C.growth(col, helper)}),
        before=k,
    )


def rsi(col: str, out: str, n: int = 14) -> Indicator:
    """Relative strength from plain means of gains and losses.

    The first row has no difference and counts as neither gain nor loss, so values start at the
    n-th row. Written as gain / (gain + loss), which is the same number and needs no infinity.
    """
    delta, gain, loss = (f"_{col}_{name}" for name in ("delta", "gain", "loss"))
    moves = {
        gain: lambda w: F.when(F.col(delta) > 0, F.col(delta)).otherwise(0.0),
        loss: lambda w: F.when(F.col(delta) < 0, -F.col(delta)).otherwise(0.0),
    }
    sums = [
        {**g, **lo}
        for g, lo in zip(_power_sums(gain, n), _power_sums(loss, n), strict=True)
    ]

    def value(w: WindowSpec) -> Column:
        gained, lost = _rolling_sum(gain, n, w), _rolling_sum(loss, n, w)
        return 100 * F.try_divide(gained, gained + lost)

    first = {delta: lambda w: F.col(col) - F.lag(col, 1).over(w)}
    return Indicator((first, moves, *sums, {out: value}), before=n)


def _decay(span: int) -> float:
    return 1 - 2 / (span + 1)


def _ema_steps(col: str, span: int, out: str) -> list[dict]:
    """A running sum of rows over their weight, times the weight, in each block.

    The block's first row seeds the average. The weight q^step is taken once per row.
    """
    q = _decay(span)
    weight = f"_weight{span}"

    def value(w: WindowSpec) -> Column:
        term = F.when(F.col("_step") == 0, F.col(col)).otherwise(F.col(col) * (1 - q))
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return F.sum(term / F.col(weight)).over(so_far) * F.col(weight)

    return [{weight: lambda w: F.pow(F.lit(q), F.col("_step"))}, {out: value}]


def _ema_frame(spans: list[int]) -> dict[str, int]:
    rates = [-math.log(_decay(span)) for span in spans if span > 1]
    return {
        "before": math.ceil(FORGET / min(rates)),
        "reach": math.floor(OVERFLOW / max(rates)),
    }


def ema(col: str, span: int, out: str) -> Indicator:
    """Exponential average with weight 2 / (span + 1), seeded by the first value.

    `col` must be known on every row; `features.ema_over_gaps` is for columns with gaps.
    """
    if span < 2:
        return Indicator(({out: lambda w: F.col(col)},))
    return Indicator(tuple(_ema_steps(col, span, out)), **_ema_frame([span]))


def _gap_log(span: int, gap: float) -> float:
    """Logarithm of what an average keeps of itself at a value that comes `gap` rows later."""
    rate = -math.log(_decay(span))
    return -gap * rate - math.log(math.exp(-gap * rate) + 1 - _decay(span))


def ema_known_rows(col: str, span: int, out: str) -> Indicator:
    """Exponential average of a column with gaps, for use by `features.ema_over_gaps`.

    After a gap of g rows the old average counts q^g against 1 - q for the new value. That share
    differs from row to row, so the weights are running products of it, kept as logarithms.
    """
    q = _decay(span)
    at, last, gap, keep, log = (f"_{out}_{n}" for n in ("at", "last", "gap", "keep", "log"))

    def kept(_: WindowSpec) -> Column:
        aged = F.col(gap) * math.log(q)
        share = aged - F.ln(F.exp(aged) + (1 - q))
        # A share under 2^-64 changes nothing any more; the bound keeps the products in range.
        return F.when(F.col(gap).isNotNull(), F.greatest(share, F.lit(-FORGET)))

    def average(w: WindowSpec) -> Column:
        new = F.coalesce(1 - F.exp(F.col(keep)), F.lit(1.0))
        term = F.col(col) * new * F.exp(-F.col(log))
        return F.sum(term).over(so_far(w)) * F.exp(F.col(log))

    def so_far(w: WindowSpec) -> WindowSpec:
        return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def seen(w: WindowSpec) -> Column:
        earlier = w.rowsBetween(Window.unboundedPreceding, -1)
        return F.last(at, ignorenulls=True).over(earlier)

    slowest = min(-_gap_log(span, g) / g for g in range(1, 50 * span))
    return Indicator(
        (
            {at: lambda w: F.when(F.col(col).isNotNull(), F.col(POSITION))},
            {last: seen},
            {gap: lambda w: F.col(at) - F.col(last)},
            {keep: kept},
            {log: lambda w: F.coalesce(F.sum(keep).over(so_far(w)), F.lit(0.0))},
            {out: average},
        ),
        before=math.ceil(FORGET / slowest),
        reach=math.floor(OVERFLOW / -math.log(q)),
    )


def macd(
    col: str,
    out: str = "macd",
    signal_out: str | None = "signal",
    histogram_out: str | None = "histogram",
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
) -> Indicator:
    """Fast minus slow average, its own average, and the distance of the two.

    The signal is an average of an average. Both start from the first value, so it equals a fixed
    mix of plain averages of `col` (two poles, partial fractions): with q = 1 - 2/(span + 1) and
    a = 1 - q, averaging ema_p again with q_s gives
    (a_s q_p ema_p - a_p q_s ema_s) / (q_p - q_s).
    One pass over the series therefore yields all three lines.
    """
    if signal in (fast, slow):
        raise ValueError("the signal span must differ from the fast and slow spans")
    name = {span: f"_{col}_ema{span}" for span in (fast, slow, signal)}

    def smoothed(span: int) -> Column:
        q, qs = _decay(span), _decay(signal)
        mixed = F.col(name[span]) * ((1 - qs) * q) - F.col(name[signal]) * ((1 - q) * qs)
        return mixed / F.lit(q - qs)

    def line() -> Column:
        return F.col(name[fast]) - F.col(name[slow])

    def signal_line() -> Column:
        return smoothed(fast) - smoothed(slow)

    averages: list[dict] = [{}, {}]
    for span, helper in name.items():
        for step, columns in zip(averages, _ema_steps(col, span, helper), strict=True):
            step.update(columns)
    lines = {
        out: lambda w: line(),
        signal_out: lambda w: signal_line(),
        histogram_out: lambda w: line() - signal_line(),
    }
    outputs = {n: build for n, build in lines.items() if n}
    return Indicator((*averages, outputs), **_ema_frame([fast, slow, signal]))


def windows(cols: list[str], length: int, out: str) -> Indicator:
    """The `length` rows before the current one, oldest first; missing until that many exist."""

    def value(w: WindowSpec) -> Column:
        rows = F.collect_list(F.array(*cols)).over(w.rowsBetween(-length, -1))
        return F.when(F.col(POSITION) >= length, rows)

    return Indicator(({out: value},), before=length)

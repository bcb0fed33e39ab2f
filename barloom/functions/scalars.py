"""Scalar functions of bars and results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso(time: Column) -> Column:
    return F.date_format(F.timestamp_seconds(time), "yyyy-MM-dd HH:mm")


def day(time: Column) -> Column:
    return F.date_format(F.timestamp_seconds(time), "yyyy-MM-dd")


def pct(fraction: Column, digits: int = 2) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", fraction * 100), F.lit("%"))


def human_bytes(n: Column) -> Column:
    x = n.cast("double")
    out = F.concat(n.cast("long").cast("string"), F.lit(" B"))
    for unit, size in (("KiB", 2.0**10), ("MiB", 2.0**20), ("GiB", 2.0**30), ("TiB", 2.0**40)):
        out = F.when(x >= size, F.concat(F.format_string("%.1f", x / size), F.lit(f" {unit}"))).otherwise(out)
    return out


def cagr(final: Column, years: Column) -> Column:
    """expm1(ln(final) / years); 0 when either isn't positive, infinite on overflow."""
    ok = (final > 0) & (years > 0)
    return F.when(ok, F.expm1(F.ln(F.when(ok, final)) / F.when(ok, years))).otherwise(F.lit(0.0))


def participation(order: Column, turnover: Column) -> Column:
    return F.when(turnover > 0, order / F.when(turnover > 0, turnover))


def impact_fraction(order: Column, turnover: Column, sigma: Column, k: float = 1.0) -> Column:
    """k * sigma * sqrt(order / turnover); null without turnover, 0 without volatility."""
    share = participation(order, turnover)
    return F.when(share.isNull(), None).when(sigma <= 0, F.lit(0.0)).otherwise(F.lit(k) * sigma * F.sqrt(share))


def drawdown_factor(drawdown: Column, start: float, full: float, floor: float) -> Column:
    """1 down to `start`, `floor` from `full` on, linear between; drawdowns are positive fractions here."""
    x = F.abs(drawdown)
    return F.when(x <= start, F.lit(1.0)).when(x >= full, F.lit(float(floor))).otherwise(1.0 - (1.0 - floor) * (x - start) / (full - start))


def annual_rate(daily: Column) -> Column:
    return daily * 365 * 100


def quote_of(symbol: Column) -> Column:
    """The text after the last dash, in upper case; null without a dash."""
    return F.when(F.contains(symbol, F.lit("-")), F.upper(F.element_at(F.split(symbol, "-"), -1)))


def spread_two_bars(high: Column, low: Column, next_high: Column, next_low: Column) -> Column:
    """High-low spread estimate of two bars in a row; null where a range isn't positive or is inverted."""
    ok = (low > 0) & (next_low > 0) & (high >= low) & (next_high >= next_low)
    h, l, nh, nl = (F.when(ok, c) for c in (high, low, next_high, next_low))
    beta = F.pow(F.ln(h / l), 2) + F.pow(F.ln(nh / nl), 2)
    gamma = F.pow(F.ln(F.greatest(h, nh) / F.least(l, nl)), 2)
    c = 3 - 2 * 2**0.5
    alpha = (F.sqrt(2 * beta) - F.sqrt(beta)) / c - F.sqrt(gamma / c)
    return 2 * (F.exp(alpha) - 1) / (1 + F.exp(alpha))

"""Indicators of a series as window expressions; the three that are recurrences are scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.timegrid import DAY, YEAR_DAYS, bars_per_year
from barloom.operators.scans import ema, smoothed, with_macds, with_rsis
from barloom.sources.bars import KEY, in_order

YEAR = YEAR_DAYS * DAY


def _last(n: int) -> W:
    return in_order().rowsBetween(-(n - 1), 0)


def nth() -> Column:
    return F.row_number().over(in_order())


def sma(n: int, column: str = "close") -> Column:
    """Null until n rows are there."""
    return F.when(nth() >= n, F.avg(column).over(_last(n)))


def change(n: int, column: str = "close") -> Column:
    """Return over n bars; null where the earlier price is missing or not positive."""
    before = F.lag(column, n).over(in_order())
    return F.when(before > 0, F.col(column) / F.when(before > 0, before) - 1)


def log_change(column: str = "close") -> Column:
    before = F.lag(column).over(in_order())
    return F.ln(F.when((before > 0) & (F.col(column) > 0), F.col(column) / F.when(before > 0, before)))


def channel_high(n: int) -> Column:
    """The highest high of the n bars before this one."""
    return F.when(nth() > n, F.max("high").over(in_order().rowsBetween(-n, -1)))


def channel_low(n: int) -> Column:
    return F.when(nth() > n, F.min("low").over(in_order().rowsBetween(-n, -1)))


def step_of(bars: DataFrame) -> DataFrame:
    """bars with `step`, the series' median spacing in whole seconds; 1 for a single bar. One more window, no join."""
    rows = bars.withColumn("__gap", F.col("time") - F.lag("time").over(in_order()))
    step = F.median("__gap").over(W.partitionBy(*KEY)).cast("long")
    return rows.withColumn("step", F.coalesce(step, F.lit(1).cast("long"))).drop("__gap")


def with_volatility(bars: DataFrame, n: int, least: int = 20) -> DataFrame:
    """Adds `vol`: population deviation of the last n simple returns, a year's worth; null under `least` of them. Needs `step`."""
    rows = bars.withColumn("__r", change(1))
    seen = F.count("__r").over(_last(n))
    return rows.withColumn("vol", F.when(seen >= least, F.stddev_pop("__r").over(_last(n)) * F.sqrt(F.lit(float(YEAR)) / F.col("step")))).drop("__r")


def drawdown(column: str = "close") -> Column:
    """This value over the highest so far, less one."""
    return F.col(column) / F.max(column).over(in_order().rowsBetween(W.unboundedPreceding, 0)) - 1


def trend(n: int) -> Column:
    return F.col("close") / sma(n) - 1


def median_turnover(n: int) -> Column:
    """Median over the last n bars, nothing traded counting as 0; null until n bars are there."""
    value = F.coalesce("turnover", F.lit(0.0))
    return F.when(nth() >= n, F.percentile(value, F.lit(0.5)).over(_last(n)))


def windows_of(timeframe: str) -> dict[str, int]:
    """Bars of the usual spans of change: one bar, a day, a week, a month, a year."""
    per_year = bars_per_year(timeframe)
    spans = {"24h": DAY, "7d": 7 * DAY, "30d": 30 * DAY, "1y": YEAR}
    return {"1": 1} | {name: max(1, round(seconds * per_year / YEAR)) for name, seconds in spans.items()}


def changes(bars: DataFrame, timeframe: str) -> DataFrame:
    """The last bar of each series with its change over each span."""
    rows = bars.select(*KEY, "time", "close", *[change(n).alias(f"change_{name}") for name, n in windows_of(timeframe).items()])
    newest = W.partitionBy(*KEY).orderBy(F.col("time").desc())
    return rows.withColumn("__n", F.row_number().over(newest)).where("__n = 1").drop("__n")


def decisions(bars: DataFrame, every: int, scored: Column | None = None) -> DataFrame:
    """Adds `decide`: true at bars where a grid of `every` steps from the epoch is due. Needs `step`.

    The grid begins at its first point from the first scored bar on; a bar decides once at most, and
    after a gap one late point is caught up a bar. In closed form: with points due by this bar G and
    bars since the start j, the points taken are j + least(1, running minimum of G - j).
    """
    order = in_order()
    rows = bars.withColumn("__on", (F.coalesce(scored, F.lit(False)) if scored is not None else F.lit(True)).cast("int"))
    rows = rows.withColumn("__on", F.max("__on").over(order.rowsBetween(W.unboundedPreceding, 0)))
    span = F.col("step") * every
    begin = F.min(F.when(F.col("__on") == 1, F.col("time"))).over(W.partitionBy(*order_keys(bars)))
    rows = rows.withColumn("__g0", F.ceil(begin / span) * span).withColumn("__j", F.sum("__on").over(order) - 1)
    due = F.greatest(F.lit(0), F.floor((F.col("time") - F.col("__g0")) / span) + 1)
    rows = rows.withColumn("__d", F.when(F.col("__on") == 1, due - F.col("__j")))
    taken = F.col("__j") + F.least(F.lit(1), F.min("__d").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("__p", F.when(F.col("__on") == 1, taken).otherwise(F.lit(0)))
    decide = F.col("__p") > F.coalesce(F.lag("__p").over(order), F.lit(0))
    return rows.withColumn("decide", decide).drop("__on", "__g0", "__j", "__d", "__p")


def order_keys(bars: DataFrame) -> list[str]:
    return list(KEY)


def held(value: Column, when: Column) -> Column:
    """The value at the last bar where `when` holds."""
    return F.last(F.when(when, value), ignorenulls=True).over(in_order().rowsBetween(W.unboundedPreceding, 0))


def with_ema(bars: DataFrame, n: int, out: str = "ema") -> DataFrame:
    return smoothed(bars, [ema("close", n, out)])


def with_macd(bars: DataFrame, fast: int = 12, slow: int = 26, signal: int = 9) -> DataFrame:
    """Adds `macd`, `macd_signal` and `macd_hist`; null until the averages that they are made of are there."""
    rows = with_macds(bars, [(fast, slow, signal)])
    return rows.withColumnsRenamed({"line0": "macd", "trigger0": "macd_signal"}).withColumn("macd_hist", F.col("macd") - F.col("macd_signal"))


def with_rsi(bars: DataFrame, n: int = 14) -> DataFrame:
    return with_rsis(bars, [n]).withColumnRenamed(f"rsi{n}", "rsi")

"""Which series, and which stretch of them, a question is about."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import quote_of
from barloom.functions.timegrid import parse_duration
from barloom.sources.bars import KEY


def parse_quotes(text: str | None) -> frozenset[str] | None:
    """'USDT, btc' -> {'USDT', 'BTC'}; None, which keeps every quote, where the text names none or one of the words for all."""
    named = frozenset(re.findall(r"[^\s,]+", ((text or "").strip() or "any").upper()))
    if not named:
        raise ValueError("a list of quotes has no name in it")
    return None if named <= {"ANY", "ALL", "*"} else named


def quoted(bars: DataFrame, quotes: frozenset[str] | None) -> DataFrame:
    """Series whose symbol ends, after its last dash, in one of the quotes."""
    return bars if quotes is None else bars.where(quote_of(F.col("symbol")).isin(*sorted(quotes)))


def matching(symbol: Column, text: str) -> Column:
    """All words of the text must match: '/q' is a quote, 'a/b' a pair, anything else a part of the name."""
    found, low = F.lit(True), F.lower(symbol)
    for word in text.lower().split():
        found = found & (F.endswith(low, F.lit("-" + word[1:])) if word.startswith("/") else F.contains(low, F.lit(word.replace("/", "-"))))
    return found


def listed(series: DataFrame, names: list[str]) -> DataFrame:
    """series with `listed`: whether the symbol is one of the names, which are a parameter and few."""
    return series.withColumn("listed", F.col("symbol").isin(*names) if names else F.lit(False))


def selected(bars: DataFrame, symbols: list[str] | None = None, configured: list[str] | None = None, timeframes: list[str] | None = None) -> DataFrame:
    """(symbol, timeframe, bars) of the series asked for: those named, else those configured, else all; a name without bars has a row of 0."""
    if timeframes:
        bars = bars.where(F.col("timeframe").isin(*timeframes))
    counted = bars.groupBy(*KEY).agg(F.count(F.lit(1)).alias("bars"))
    names = sorted(set(symbols or configured or ()))
    if not names:
        return counted
    wanted = bars.sparkSession.createDataFrame([(n,) for n in names], "symbol string")
    return wanted.join(counted, "symbol", "left").select("symbol", "timeframe", F.coalesce("bars", F.lit(0)).alias("bars"))


def _midnight(text: str) -> int:
    return int(datetime.strptime(text, "%Y-%m-%d").replace(tzinfo=timezone.utc).timestamp())


def reporting_window(bars: DataFrame, last: str | None = None, first: str | None = None, until: str | None = None, least: int = 3) -> DataFrame:
    """The bars of each series that a report is about: the `last` '1y' before its own end, or those from one day's midnight to another's.

    The two forms exclude each other. A series that is left with fewer than `least` bars falls out, unless that is all it has. Cut results by it,
    not what signals are worked out from.
    """
    if last is not None and (first is not None or until is not None):
        raise ValueError("give either a last stretch or days")
    from pyspark.sql import Window as W

    whole = W.partitionBy(*KEY)
    rows = bars.withColumn("__all", F.count(F.lit(1)).over(whole)).withColumn("__end", F.max("time").over(whole))
    if last is not None:
        rows = rows.where(F.col("time") >= F.col("__end") - parse_duration(last))
    if first is not None:
        rows = rows.where(F.col("time") >= _midnight(first))
    if until is not None:
        rows = rows.where(F.col("time") <= _midnight(until))
    n = F.count(F.lit(1)).over(whole)
    return rows.withColumn("__n", n).where(f"__n >= {least} or __n = __all").drop("__n", "__all", "__end")

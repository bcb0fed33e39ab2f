"""Where queries and their SQL are put together."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.sources.bars import synthetic_bars
from barloom.sources.derived import EVENT_SQL, event_bars, trade_bars, trade_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Sets of bars that queries run on, with their SQL.
FIXTURES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str]] = {
    "ticks": (event_bars, EVENT_SQL),
    "types": (lambda spark, sf: trade_bars(spark, sf, "p_type", "1w"), trade_sql("p_type", "1w")),
    "brands": (lambda spark, sf: trade_bars(spark, sf, "p_brand", "1w"), trade_sql("p_brand", "1w")),
    "daily": (lambda spark, sf: trade_bars(spark, sf, "p_brand", "1d"), trade_sql("p_brand", "1d")),
    "flags": (lambda spark, sf: trade_bars(spark, sf, "l_returnflag", "1w"), trade_sql("l_returnflag", "1w")),
}
FIXTURES["closes"] = (
    lambda spark, sf: synthetic_bars(trade_bars(spark, sf, "p_type", "1w").select("symbol", "timeframe", "time", "close")),
    trade_sql("p_type", "1w").replace("bars AS (", "bars0 AS (") + """,
bars AS (SELECT symbol, timeframe, time, open, greatest(open, close) AS high, least(open, close) AS low, close, 1.0::DOUBLE AS volume, close AS turnover FROM bars0)""",
)
W = "WINDOW w AS (PARTITION BY symbol, timeframe ORDER BY time)"


def on_bars(name: str, fixture: str, plan: Callable[[DataFrame], DataFrame], sql: str | None = None) -> None:
    """Registers plan(bars) with SQL that may begin with more common table expressions: 'x AS (...), y AS (...) SELECT ...'."""
    make, bars_sql = FIXTURES[fixture]
    QUERIES[name] = lambda spark, sf: plan(make(spark, sf))
    if sql is not None:
        joined = sql if sql.lstrip().upper().startswith("SELECT") else None
        ORACLE[name] = f"WITH RECURSIVE {bars_sql}\n{joined}" if joined else f"WITH RECURSIVE {bars_sql},\n{sql}"


def on_tables(name: str, plan: Callable[[SparkSession, str], DataFrame], sql: str | None = None) -> None:
    QUERIES[name] = plan
    if sql is not None:
        ORACLE[name] = sql


def r6(column: Column | str, name: str | None = None) -> Column:
    """Rounded to six digits, as sums in another order differ in the last ones."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6).alias(name) if name else F.round(column, 6)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """df with these columns, or all of type double, rounded to six digits."""
    names = names or tuple(c for c, kind in df.dtypes if kind == "double")
    return df.withColumns({c: F.round(c, 6) for c in names})

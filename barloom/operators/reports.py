"""Results as the tables and documents that are given out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import iso
from barloom.sources.bars import KEY


def _fixed(column: str, digits: int):
    return F.format_string(f"%.{digits}f", F.col(column).cast("double"))


def trade_table(trades: DataFrame, more: int = 0, keep: tuple[str, ...] = ()) -> DataFrame:
    """A line a trade: sides in words, moments in UTC, prices to eight digits, returns to six; what is open says yes. `more` adds digits, here and below; `keep` names columns that stay."""
    return trades.select(
        *KEY, *keep, F.when(F.col("side") > 0, "long").otherwise("short").alias("side"), iso(F.col("entry_time")).alias("entry_time_utc"), _fixed("entry_price", 8 + more).alias("entry_price"),
        iso(F.col("exit_time")).alias("exit_time_utc"), _fixed("exit_price", 8 + more).alias("exit_price"), "bars_held", _fixed("gross_return", 6 + more).alias("gross_return"), _fixed("net_return", 6 + more).alias("net_return"),
        _fixed("equity_at_entry", 8 + more).alias("equity_at_entry"), _fixed("equity_at_exit", 8 + more).alias("equity_at_exit"), F.when(F.col("open_at_end"), "yes").otherwise("").alias("open_at_end"),
    )


def equity_table(curve: DataFrame, more: int = 0) -> DataFrame:
    """A line a bar: close, equity and holding to eight digits, and the position. curve has `hold`, as buy_and_hold() gives it."""
    return curve.select(*KEY, iso(F.col("time")).alias("time_utc"), _fixed("close", 8 + more).alias("close"), _fixed("equity", 8 + more).alias("equity"), _fixed("hold", 8 + more).alias("buy_hold"), "position")


def basket_table(combined: DataFrame, more: int = 0) -> DataFrame:
    """A line a shared bar: the basket's value and the share invested."""
    return combined.select(iso(F.col("time")).alias("time_utc"), _fixed("basket", 8 + more).alias("basket"), _fixed("invested", 6 + more).alias("invested"), "n_legs")


def book_table(book: DataFrame, calendar: DataFrame, more: int = 0) -> DataFrame:
    """A line a bar of a risk book, with its moment from calendar (idx, time)."""
    rows = book.join(calendar, "idx")
    return rows.select(iso(F.col("time")).alias("time_utc"), _fixed("equity", 8 + more).alias("equity"), _fixed("invested", 6 + more).alias("invested"), _fixed("turnover", 6 + more).alias("turnover"))


def summary_documents(figures: DataFrame, audits: DataFrame) -> DataFrame:
    """(series, document): one nested JSON text a series, of dotted figures (series, field, value) and its audit (series and any columns).

    'a.b' becomes {"a": {"b": ...}}, a name without a dot stands at the top.
    """
    parts = F.split("field", "\\.", 2)
    rows = figures.where("value is not null").select(*KEY, F.when(F.size(parts) > 1, parts[0]).alias("part"), F.element_at(parts, -1).alias("name"), "value")
    nested = rows.groupBy(*KEY, "part").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("held"))
    named = nested.groupBy(*KEY).agg(
        F.max(F.when(F.col("part").isNull(), F.to_json("held"))).alias("top"),
        F.sort_array(F.collect_list(F.when(F.col("part").isNotNull(), F.concat(F.lit('"'), "part", F.lit('":'), F.to_json("held"))))).alias("parts"),
    )
    audit = audits.select(*KEY, F.concat(F.lit('"quality":'), F.to_json(F.struct(*[c for c in audits.columns if c not in KEY]))).alias("audit"))
    head = F.expr("substring(to_json(struct(symbol, timeframe)), 2, length(to_json(struct(symbol, timeframe))) - 2)")
    top = F.expr("substring(top, 2, length(top) - 2)")
    pieces = F.array_compact(F.concat(F.array(head, top), F.col("parts"), F.array("audit")))
    whole = named.join(audit, list(KEY), "left")
    return whole.select(*KEY, F.concat(F.lit("{"), F.array_join(pieces, ","), F.lit("}")).alias("document"))

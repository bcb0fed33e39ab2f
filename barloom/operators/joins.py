"""Joins in time: the last print before a moment, alignment to a calendar, bars of a window before a moment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.sources.bars import KEY


def asof(bars: DataFrame, dates: DataFrame, values: list[str], max_age: int | None = None, tags: tuple[str, ...] = ()) -> DataFrame:
    """For each series and each row (k, date) and its tags: the last bar at or before the date.

    Gives k, date, print_time, the values as print_<name>, and under their own names those not older than max_age.
    Bars and moments go through one window by series: nothing is paired that isn't asked for, a row for each series and date.
    """
    probes = bars.select(*KEY).distinct().crossJoin(dates.select("k", "date", *tags))
    seen = F.struct(F.col("time").alias("print_time"), *[F.col(v) for v in values])
    rows = bars.select(*KEY, "time", F.lit(0).alias("probe"), F.lit(None).cast("long").alias("k"), seen.alias("seen")).unionByName(
        probes.select(*KEY, F.col("date").alias("time"), F.lit(1).alias("probe"), F.col("k").cast("long").alias("k"), *tags), allowMissingColumns=True
    )
    upto = W.partitionBy(*KEY).orderBy("time", "probe").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("seen", F.last("seen", ignorenulls=True).over(upto)).where("probe = 1")
    fresh = F.lit(True) if max_age is None else F.col("time") - F.col("seen.print_time") <= max_age
    return rows.select(
        *KEY, "k", *tags, F.col("time").alias("date"), F.col("seen.print_time").alias("print_time"), *[F.col(f"seen.{v}").alias(f"print_{v}") for v in values],
        *[F.when(fresh, F.col(f"seen.{v}")).alias(v) for v in values],
    )


def aligned(bars: DataFrame, calendar: DataFrame, max_age: int = 3 * 86_400) -> DataFrame:
    """(symbol, idx, time, price, turnover, first_idx): closes on a calendar's times (idx, time), carried on for max_age.

    Only bars on the calendar count; turnover is that of the bar itself, else 0.
    """
    grid = bars.select("symbol").distinct().crossJoin(calendar)
    rows = grid.join(bars.select("symbol", "time", "close", "turnover"), ["symbol", "time"], "left")
    upto = W.partitionBy("symbol").orderBy("idx").rowsBetween(W.unboundedPreceding, 0)
    last = F.last(F.when(F.col("close").isNotNull(), F.struct("time", "close")), ignorenulls=True).over(upto)
    first = F.min(F.when(F.col("close").isNotNull(), F.col("idx"))).over(W.partitionBy("symbol"))
    rows = rows.withColumn("last", last).withColumn("first_idx", first)
    return rows.select("symbol", "idx", "time", F.when(F.col("time") - F.col("last.time") <= max_age, F.col("last.close")).alias("price"), F.coalesce("turnover", F.lit(0.0)).alias("turnover"), "first_idx")


def window_bars(bars: DataFrame, dates: DataFrame, gate: int) -> DataFrame:
    """bars with the k of each date in whose window (date - gate, date] they lie: a join on bins of `gate` seconds, of which a window meets two."""
    first, last = F.floor((F.col("date") - gate + 1) / gate), F.floor(F.col("date") / gate)
    spans = dates.select("k", "date", F.explode(F.sequence(first, last)).alias("__bin"))
    rows = bars.withColumn("__bin", F.floor(F.col("time") / gate)).join(spans, "__bin")
    return rows.where((F.col("time") <= F.col("date")) & (F.col("time") > F.col("date") - gate)).drop("__bin")


def shared_times(bars: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, time): the times at which every symbol, of those of the same `by` if it is given, has a bar."""
    n = bars.groupBy(*by).agg(F.countDistinct("symbol").alias("n"))
    times = bars.groupBy(*by, "time").agg(F.countDistinct("symbol").alias("have"))
    every = times.join(n, list(by)).where("have = n") if by else times.join(F.broadcast(n), times["have"] == n["n"])
    return every.select(*by, "time")


def diff(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """keys, old, new, moved: every key of either side, absent ones counting 0."""
    both = old.withColumnRenamed(value, "old").join(new.withColumnRenamed(value, "new"), keys, "full_outer")
    both = both.withColumn("old", F.coalesce("old", F.lit(0.0))).withColumn("new", F.coalesce("new", F.lit(0.0)))
    return both.select(*keys, "old", "new", F.abs(F.col("new") - F.col("old")).alias("moved"))

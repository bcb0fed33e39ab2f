"""Baskets of fixed weights: each leg is run alone and they are added up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators.joins import shared_times
from barloom.sources.bars import KEY


def common_window(bars: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, first_time, last_time): from the latest first bar to the earliest last one. Here and below, `by` names the columns that tell baskets apart."""
    ends = bars.groupBy(*by, "symbol").agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    return ends.groupBy(*by).agg(F.max("lo").alias("first_time"), F.min("hi").alias("last_time"))


def timeline(bars: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, time): the times that all legs share within their common window."""
    window, inside, shared = common_window(bars, by), F.expr("time between first_time and last_time"), shared_times(bars, by)
    held = shared.join(window, list(by)).where(inside) if by else shared.join(F.broadcast(window), inside)
    return held.select(*by, "time")


def legs(curve: DataFrame, times: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Each leg's curve on the shared times, 1 at the first and marked at the last close."""
    rows = curve.join(times, [*by, "time"], "left_semi")
    order = W.partitionBy(*by, *KEY).orderBy("time")
    rows = rows.withColumn("leg", F.col("equity") / F.first("equity").over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    mark = F.when(F.lead("time").over(order).isNull(), 1 + F.col("position") * (F.col("close") / F.col("open") - 1)).otherwise(F.lit(1.0))
    return rows.withColumn("leg", F.col("leg") * mark)


def combined(leg_rows: DataFrame) -> DataFrame:
    """(time, basket, invested): equal weights at the start, never rebalanced."""
    return leg_rows.groupBy("time").agg((1 + F.avg(F.col("leg") - 1)).alias("basket"), F.avg(F.abs("position")).alias("invested"), F.count(F.lit(1)).alias("n_legs"))


def contributions(leg_rows: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, symbol, total, contribution, share): what each leg added, and its share of the final value."""
    last = leg_rows.groupBy(*by, "symbol").agg(F.max_by("leg", "time").alias("final"), F.avg(F.abs("position")).alias("exposure"))
    every = W.partitionBy(*by)
    return last.select(
        *by, "symbol", (F.col("final") - 1).alias("total"), ((F.col("final") - 1) / F.count(F.lit(1)).over(every)).alias("contribution"),
        (F.col("final") / F.sum("final").over(every)).alias("share"), "exposure",
    )


def swaps(leg_rows: DataFrame) -> DataFrame:
    """(time, changed, names): bars at which legs moved in or out, and which."""
    was = F.coalesce(F.lag("position").over(W.partitionBy(*KEY).orderBy("time")), F.lit(0.0))
    moved = leg_rows.withColumn("move", F.col("position") - was).where(F.abs("move") >= 1e-12)
    return moved.groupBy("time").agg(F.sum("move").alias("changed"), F.array_join(F.sort_array(F.collect_list("symbol")), ",").alias("names"))


def select_by_turnover(bars: DataFrame, reference: int, lookback: int, top: int, least: int | None = None) -> DataFrame:
    """(symbol, turnover): the largest median turnovers of positive bars in [reference - lookback, reference); ties by symbol."""
    least = max(5, lookback // 86_400 // 3) if least is None else least
    rows = bars.where((F.col("time") >= reference - lookback) & (F.col("time") < reference) & (F.col("turnover") > 0))
    ranked = rows.groupBy("symbol").agg(F.median("turnover").alias("turnover"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    return ranked.orderBy(F.col("turnover").desc(), "symbol").limit(top).select("symbol", "turnover")

"""Risk and return of curves and trades."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.scalars import cagr
from barloom.sources.bars import KEY


def performance(curve: DataFrame, per_year: Column | float, value: str = "equity", keys=KEY) -> DataFrame:
    """A row for each curve: totals, growth and volatility a year, Sharpe ratio, deepest drawdown.

    Volatility is of simple returns, the Sharpe ratio of log returns above -100 %, both with
    population deviations; years count points.
    """
    order = W.partitionBy(*keys).orderBy("time")
    per_year = per_year if isinstance(per_year, Column) else F.lit(float(per_year))
    before = F.lag(value).over(order)
    rows = curve.withColumn("__r", F.when(before > 0, F.col(value) / F.when(before > 0, before) - 1))
    rows = rows.withColumn("__l", F.when(F.col("__r") > -1, F.log1p(F.when(F.col("__r") > -1, F.col("__r")))))
    rows = _fallen(rows, value, keys)
    out = rows.groupBy(*keys).agg(
        F.max_by(value, "time").alias("final_equity"), F.count(F.lit(1)).alias("points"), F.count("__r").alias("n"),
        F.stddev_pop("__r").alias("sd"), F.avg("__l").alias("mean_log"), F.stddev_pop("__l").alias("sd_log"), F.count("__l").alias("n_log"),
        F.max(per_year).alias("per_year"), _worst().alias("x"),
    )
    years = F.col("points") / F.col("per_year")
    out = out.withColumn("years", years).withColumn("total_return", F.col("final_equity") - 1).withColumn("cagr", cagr(F.col("final_equity"), years))
    vol = F.when(F.col("n") >= 2, F.col("sd") * F.sqrt("per_year")).otherwise(F.lit(0.0))
    sharpe = F.when((F.col("n_log") >= 2) & (F.col("sd_log") > 0), F.col("mean_log") / F.nullif(F.col("sd_log"), F.lit(0.0)) * F.sqrt("per_year")).otherwise(F.lit(0.0))
    return out.select(*keys, "final_equity", "total_return", "cagr", vol.alias("ann_vol"), sharpe.alias("sharpe"), "years", "points", *_deepest())


def _fallen(rows: DataFrame, value: str, keys) -> DataFrame:
    """rows with `__dd`, the fall from the highest value so far, and `__at`, the first time of that value."""
    order = W.partitionBy(*keys).orderBy("time")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("__peak", F.max(value).over(so_far))
    rows = rows.withColumn("__dd", F.when(F.col("__peak") > 0, F.col(value) / F.nullif(F.col("__peak"), F.lit(0.0)) - 1).otherwise(F.lit(0.0)))
    higher = F.col("__peak") > F.coalesce(F.lag("__peak").over(order), F.lit(float("-inf")))
    return rows.withColumn("__at", F.max(F.when(higher, F.col("time"))).over(so_far))


def _worst() -> Column:
    return F.min(F.struct(F.col("__dd").alias("dd"), F.col("time").alias("trough"), F.col("__at").alias("peak")))


def _deepest() -> list[Column]:
    fell = F.col("x.dd") < 0
    return [F.least(F.col("x.dd"), F.lit(0.0)).alias("max_drawdown"), F.when(fell, F.col("x.peak")).alias("dd_start"), F.when(fell, F.col("x.trough")).alias("dd_end")]


def max_drawdown(curve: DataFrame, value: str = "equity", keys=KEY) -> DataFrame:
    """(max_drawdown, dd_start, dd_end): the deepest fall from a peak, that peak's first time and its first trough; 0 and nulls if none."""
    return _fallen(curve, value, keys).groupBy(*keys).agg(_worst().alias("x")).select(*keys, *_deepest())


def trade_stats(trade_rows: DataFrame, keys=KEY) -> DataFrame:
    """Closed trades of each series: number, share won, mean, median and geometric mean return, bars held, best and worst."""
    closed = trade_rows.where("not open_at_end")
    net = F.col("net_return")
    return closed.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_closed"), F.avg((net > 0).cast("double")).alias("win_rate"), F.avg(net).alias("mean_return"), F.median(net).alias("median_return"),
        (F.exp(F.avg(F.when(net > -1, F.log1p(F.when(net > -1, net))))) - 1).alias("geometric_return"),
        F.avg("bars_held").alias("mean_bars"), F.max(net).alias("best"), F.min(net).alias("worst"),
    )

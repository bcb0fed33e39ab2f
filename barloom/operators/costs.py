"""What trading costs: spreads and impact estimated from bars, and costs of many kinds joined to series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalars import impact_fraction, spread_two_bars
from barloom.sources.bars import KEY, ends, in_order


def spreads(bars: DataFrame, window: int | None = None, before: int | None = None) -> DataFrame:
    """(series, spread): the median of the two-bar estimates, none below 0; null under three bars."""
    rows = bars if before is None else bars.where(F.col("time") < before)
    rows = rows if window is None else ends(rows, window, newest=True)
    order = in_order()
    each = spread_two_bars(F.lag("high").over(order), F.lag("low").over(order), F.col("high"), F.col("low"))
    out = rows.withColumn("__s", F.when(each.isNotNull(), F.greatest(each, F.lit(0.0)))).groupBy(*KEY).agg(F.median("__s").alias("spread"), F.count(F.lit(1)).alias("n"))
    return out.select(*KEY, F.when(F.col("n") >= 3, F.col("spread")).alias("spread"))


def market_stats(bars: DataFrame, before: int | None = None, least: int = 30) -> DataFrame:
    """(series, median turnover, sample deviation of log returns) over bars that traded; series of fewer than `least` fall out."""
    rows = bars.where((F.col("close") > 0) & (F.col("turnover") > 0))
    rows = rows if before is None else rows.where(F.col("time") < before)
    rows = rows.withColumn("__r", F.ln(F.col("close") / F.lag("close").over(in_order())))
    out = rows.groupBy(*KEY).agg(F.median("turnover").alias("turnover"), F.stddev_samp("__r").alias("sigma"), F.count(F.lit(1)).alias("n"))
    return out.where(F.col("n") >= least).drop("n")


def leg_costs(stats: DataFrame, spread: DataFrame, fee: float, order: float, k: float = 1.0) -> DataFrame:
    """(symbol, rate): fee, half of the spread and the impact of an order; what isn't known adds nothing."""
    both = stats.select("symbol", "turnover", "sigma").join(spread.select("symbol", "spread"), "symbol", "left")
    impact = impact_fraction(F.lit(float(order)), F.col("turnover"), F.col("sigma"), k)
    rate = F.lit(fee) + F.coalesce(F.col("spread") / 2, F.lit(0.0)) + F.coalesce(impact, F.lit(0.0))
    return both.select("symbol", rate.alias("rate"))


def with_costs(bars: DataFrame, costs: DataFrame, default: float) -> DataFrame:
    """bars with the rate of their symbol, or the default one."""
    return bars.join(costs.select("symbol", "rate"), "symbol", "left").withColumn("rate", F.coalesce("rate", F.lit(default)))


def ranked_rates(rates: DataFrame, least: float) -> DataFrame:
    """Borrowing rates of `least` percent a year or more, dearest first, then by currency."""
    annual: Column = F.col("daily") * 365 * 100
    return rates.withColumn("annual", annual).where(F.col("annual") >= least).orderBy(F.col("annual").desc(), "currency")

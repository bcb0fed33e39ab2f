"""One rule over a whole archive, and what its results have in common."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.timegrid import DAY, TIMEFRAMES, bars_per_year
from barloom.operators.costs import spreads
from barloom.operators.curve import buy_and_hold, equity_curve, summary
from barloom.operators.indicators import change, changes, decisions, held, step_of, windows_of
from barloom.sources.bars import BARS, KEY, ends, stored_periods
from barloom.sources.workspace import kept


def screened(results: DataFrame, by: str = "timeframe") -> DataFrame:
    """results (…, total_return, hold_return) by a column: count, medians, shares that earned and that beat holding."""
    return results.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.median("total_return").alias("median_total"), F.median("hold_return").alias("median_hold"),
        F.avg((F.col("total_return") > 0).cast("double")).alias("profitable"), F.avg((F.col("total_return") > F.col("hold_return")).cast("double")).alias("beat_hold"),
    )


def trimmed(results: DataFrame, value: str, shares=(0.0, 0.001, 0.01, 0.05, 0.1)) -> DataFrame:
    """(cut, n, mean, median) without the top share of results; ranks are of the whole."""
    ranked = results.select(F.col(value).alias("v"), F.percent_rank().over(W.orderBy(F.col(value).desc())).alias("r"))
    cuts = results.sparkSession.createDataFrame([(float(s),) for s in shares], "cut double")
    rows = ranked.join(F.broadcast(cuts), F.col("r") >= F.col("cut"))
    return rows.groupBy("cut").agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("mean"), F.median("v").alias("median"))


def concentration(results: DataFrame, value: str, share: float) -> DataFrame:
    """(share): how much of all that is gained the top `share` of results gain."""
    ranked = results.select(F.greatest(value, F.lit(0.0)).alias("v"), F.percent_rank().over(W.orderBy(F.col(value).desc())).alias("r"))
    return ranked.agg((F.sum(F.when(F.col("r") <= share, F.col("v"))) / F.nullif(F.sum("v"), F.lit(0.0))).alias("share"))


def cohorts(results: DataFrame) -> DataFrame:
    """By whole years of history: count, median drawdown now, median total, share more than 90 % below its peak."""
    rows = results.withColumn("history", F.floor("years").cast("long"))
    return rows.groupBy("history").agg(
        F.count(F.lit(1)).alias("n"), F.median("below_peak").alias("below_peak"), F.median("total_return").alias("total"),
        F.avg((F.col("below_peak") < -0.9).cast("double")).alias("ruined"),
    )


def turnover_share(bars: DataFrame, top: int) -> DataFrame:
    """(share): how much of all turnover the `top` symbols have."""
    sums = bars.groupBy("symbol").agg(F.sum("turnover").alias("v"))
    ranked = sums.select("v", F.row_number().over(W.orderBy(F.col("v").desc(), "symbol")).alias("r"))
    return ranked.agg((F.sum(F.when(F.col("r") <= top, F.col("v"))) / F.sum("v")).alias("share"))


def index(bars: DataFrame, timeframe: str) -> DataFrame:
    """A row a series: last price and its changes, median positive turnover, bars, last time."""
    sums = bars.groupBy(*KEY).agg(F.median(F.when(F.col("turnover") > 0, F.col("turnover"))).alias("turnover"), F.count(F.lit(1)).alias("bars"))
    return changes(bars, timeframe).join(sums, list(KEY))


def stored_index(spark: SparkSession, path: str, timeframe: str, reach: int = 1) -> DataFrame:
    """index() of an archive of write_bars(), from the newest period of each series alone: for archives with much more history than a row a series needs.

    Where that period has too few bars for the longest span of change, the `reach` periods before it are read too; a change beyond them is null.
    turnover is the median of the newest period, bars are those that were looked at; closes that aren't positive are left out. Of the older periods, symbols are
    read alone, to find the series that have ended: these are read in the periods around their own last one. No period is named to the scan that isn't needed.
    """
    periods = stored_periods(spark, path, timeframe)
    bars = spark.read.schema(T.StructType([*BARS.fields, T.StructField("period", T.StringType())])).parquet(path).where(F.col("timeframe") == timeframe)
    bars = bars.select(*KEY, "time", "close", "turnover", "period")
    if not periods:
        return index(bars.drop("period"), timeframe)
    newest, before = periods[-1], periods[:-1]
    place = F.array_position(F.array(*[F.lit(p) for p in periods]), F.col("period"))
    rows = bars.where(F.col("period").isin(periods[-1 - reach :])).withColumn("last", F.max("period").over(W.partitionBy(*KEY))).where(F.col("last") == newest)
    if before:
        live = bars.where(F.col("period") == newest).select(*KEY).distinct()
        gone = kept(bars.where(F.col("period").isin(before)).select(*KEY, "period").distinct().join(live, list(KEY), "left_anti").groupBy(*KEY).agg(F.max("period").alias("last")), "ended")
        # a line a period
        ends_ = [periods.index(r["last"]) for r in gone.select("last").distinct().collect()]
        wanted = sorted({periods[i] for at in ends_ for i in range(max(0, at - reach), at + 1)})
        at = F.array_position(F.array(*[F.lit(p) for p in periods]), F.col("last"))
        if wanted:
            rows = rows.unionByName(bars.where(F.col("period").isin(wanted)).join(gone, list(KEY)).where(place.between(at - reach, at)))
    own = F.col("period") == F.col("last")
    needed = max(windows_of(timeframe).values()) + 1
    rows = rows.withColumn("__n", F.sum(own.cast("long")).over(W.partitionBy(*KEY))).where((own | (F.col("__n") < needed)) & (F.col("close") > 0))
    sums = rows.groupBy(*KEY).agg(F.median(F.when(own & (F.col("turnover") > 0), F.col("turnover"))).alias("turnover"), F.count(F.lit(1)).alias("bars"))
    return changes(rows, timeframe).join(sums, list(KEY))


def calendar_momentum(bars: DataFrame, lookback: int, rebalance: int, least: int = 20) -> DataFrame:
    """bars with the `target` of a momentum rule whose lookback and rebalance are seconds, in bars of each series' own timeframe, one at least.

    All timeframes are one plan: their numbers of bars are a small table of constants. Series of fewer than lookback + least bars fall out.
    """
    bars_of = {t: [max(1, round(x / (seconds or 30 * DAY))) for x in (lookback, rebalance)] for t, seconds in TIMEFRAMES.items()}
    numbers = F.create_map(*[x for t, (n, every) in bars_of.items() for x in (F.lit(t), F.array(F.lit(n), F.lit(every)))])
    rows = bars.withColumn("__given", F.try_element_at(numbers, F.col("timeframe"))).where("__given is not null")
    rows = rows.withColumn("__bars", F.count(F.lit(1)).over(W.partitionBy(*KEY))).where(F.col("__bars") >= F.col("__given")[0] + least)
    move = F.lit(None).cast("double")
    for n in sorted({n for n, _ in bars_of.values()}):
        move = F.when(F.col("__given")[0] == n, change(n)).otherwise(move)
    rows = step_of(rows).withColumn("__score", move)
    rows = decisions(rows, F.col("__given")[1], F.col("__score").isNotNull())
    side = F.when(F.col("__score") > 0, 1.0).when(F.col("__score").isNotNull(), 0.0)
    rows = rows.withColumn("__side", side)
    return rows.withColumn("target", F.coalesce(held(F.col("__side"), F.col("decide")), F.lit(0.0))).select(*bars.columns, "target")


def archive_screen(bars: DataFrame, lookback: int = 30 * DAY, rebalance: int = 7 * DAY, rate: float = 0.001) -> DataFrame:
    """One momentum rule in calendar time on every series of every timeframe: a row a timeframe, as screened() gives it."""
    curve = equity_curve(buy_and_hold(calendar_momentum(bars, lookback, rebalance), rate), rate)
    hold = curve.groupBy(*KEY).agg((F.max_by("hold", "time") - 1).alias("hold_return"))
    return screened(summary(curve).select(*KEY, (F.col("final_equity") - 1).alias("total_return")).join(hold, list(KEY)))


def stats(bars: DataFrame, timeframe: str, now: int, tail: int = 120, window: int = 720, fine: str = "1h") -> DataFrame:
    """A row a series of the timeframe: bars, ends, years, median absolute return of the last bars, spread, days since the last bar.

    bars may hold other timeframes too: a symbol's spread is that of its series in `fine`, which such estimates are made for, where there is one.
    """
    finest = spreads(bars.where(F.col("timeframe") == fine), window).select("symbol", F.col("spread").alias("fine_spread"), F.lit(fine).alias("fine"))
    bars = bars.where(F.col("timeframe") == timeframe)
    order = W.partitionBy(*KEY).orderBy("time")
    move = F.abs(F.col("close") / F.lag("close").over(order) - 1)
    recent = ends(bars.withColumn("__m", move), tail, newest=True).groupBy(*KEY).agg(F.median("__m").alias("median_move"))
    sums = bars.groupBy(*KEY).agg(F.count(F.lit(1)).alias("bars"), F.min("time").alias("first_time"), F.max("time").alias("last_time"))
    sums = sums.withColumn("years", F.col("bars") / bars_per_year(timeframe)).withColumn("stale_days", (F.lit(now) - F.col("last_time")) / 86_400)
    rows = sums.join(recent, list(KEY)).join(spreads(bars, window), list(KEY), "left").join(finest, "symbol", "left")
    spread = F.when(F.col("fine").isNotNull(), F.col("fine_spread")).otherwise(F.col("spread"))
    return rows.withColumns({"spread": spread, "spread_source": F.coalesce("fine", F.lit(timeframe))}).drop("fine", "fine_spread")


def rolling_choice(curves: DataFrame, years: int = 2) -> DataFrame:
    """(year, option, total): for each year the option that gained most over the `years` before, the first on ties; needs (option, year, growth)."""
    before = W.partitionBy("option").orderBy("year").rowsBetween(-years, -1)
    rows = curves.withColumn("__p", F.product("growth").over(before)).withColumn("__n", F.count(F.lit(1)).over(before)).where(F.col("__n") == years)
    best = rows.groupBy("year").agg(F.max(F.struct(F.round("__p", 12).alias("score"), (-F.col("option")).alias("back"))).alias("x"))
    picks = best.select("year", (-F.col("x.back")).alias("option"))
    return picks.join(curves, ["year", "option"]).select("year", "option", (F.col("growth") - 1).alias("total"))

"""Books of ranked symbols, rebalanced on dates. A book's drift depends on prices alone, so all of it is relational."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.timegrid import DAY, YEAR_DAYS
from barloom.operators import indicators as I
from barloom.operators.joins import asof, window_bars
from barloom.sources.bars import KEY, in_order


def rebalance_dates(bars: DataFrame, calendar: str, every: int) -> DataFrame:
    """(k, date): the calendar symbol's decision bars, numbered from 0."""
    dates = I.decisions(I.step_of(bars.where(F.col("symbol") == calendar)), every).where("decide")
    return dates.select((F.row_number().over(in_order()) - 1).cast("long").alias("k"), F.col("time").alias("date"))


def panel(bars: DataFrame, dates: DataFrame, lookback: int, max_age: int, trend_bars: int | None = None) -> DataFrame:
    """(symbol, k, date, close, print_close, momentum, below_peak, trend): readings of each symbol on each date.

    Momentum is the close over that of the date less `lookback` seconds; symbols that never have one fall out.
    """
    order = in_order()
    rows = bars.withColumn("peak", F.max("close").over(order.rowsBetween(W.unboundedPreceding, 0)))
    rows = rows.withColumn("mean", I.sma(trend_bars) if trend_bars else F.lit(None).cast("double"))
    # One pass for both moments: each date is asked for twice, now and `lookback` before.
    moments = dates.select("k", "date", F.explode(F.array(F.lit(0), F.lit(1))).alias("ago"))
    moments = moments.withColumn("date", F.col("date") - F.col("ago") * lookback)
    seen = asof(rows, moments, ["close", "peak", "mean"], max_age, ("ago",))
    now = F.col("ago") == 0
    values = ("date", "close", "print_close", "peak", "mean")
    both = seen.groupBy("symbol", "k").agg(*[F.max(F.when(now, F.col(v))).alias(v) for v in values], F.max(F.when(~now, F.col("close"))).alias("past"))
    both = both.withColumn("momentum", F.when(F.col("past") != 0, F.col("close") / F.when(F.col("past") != 0, F.col("past")) - 1))
    out = both.select(
        "symbol", "k", "date", "close", "print_close", "momentum", (F.col("close") / F.col("peak") - 1).alias("below_peak"), (F.col("close") / F.col("mean") - 1).alias("trend")
    )
    return out.withColumn("__any", F.count("momentum").over(W.partitionBy("symbol"))).where("__any > 0").drop("__any")


def window_gates(bars: DataFrame, dates: DataFrame, gate: int) -> DataFrame:
    """(symbol, k, turnover, volatility) of the bars in (date - gate, date], null under three: the upper middle turnover, one that is missing counting 0, and the
    deviation of the log returns inside of the window, three at least, a year's worth by the series' own spacing.
    """
    rows = window_bars(I.step_of(bars).select(*KEY, "time", "close", "turnover", "step"), dates, gate)
    close, before = F.col("close"), F.lag("close").over(W.partitionBy("symbol", "k").orderBy("time"))
    rows = rows.withColumn("__r", F.when((before > 0) & (close > 0), F.ln(close / F.when(before > 0, before))))
    # counted downwards the middle of an even number is the upper one
    middle = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY coalesce(turnover, 0.0D) DESC)")
    out = rows.groupBy("symbol", "k").agg(F.count(F.lit(1)).alias("n"), middle.alias("t"), F.count("__r").alias("moves"), F.stddev_pop("__r").alias("sd"), F.max("step").alias("step"))
    yearly = F.sqrt(F.coalesce(F.lit(float(YEAR_DAYS * DAY)) / F.nullif("step", F.lit(0)), F.lit(float(YEAR_DAYS))))
    return out.select("symbol", "k", F.when(F.col("n") >= 3, F.col("t")).alias("turnover"), F.when(F.col("moves") > 2, F.col("sd") * yearly).alias("volatility"))


def gate_ok(trend: float | None = None, below_peak: float | None = None, turnover: float | None = None, volatility: float | None = None) -> Column:
    """All gates that are set; a reading that is missing fails."""
    ok = F.lit(True)
    for name, least in (("trend", trend), ("below_peak", None if below_peak is None else -below_peak), ("turnover", turnover), ("volatility", volatility)):
        if least is not None:
            ok = ok & F.coalesce(F.col(name) >= least, F.lit(False))
    return ok


def ranked(readings: DataFrame, top: float, long_short: bool = False) -> DataFrame:
    """(symbol, k, side): the strongest and, if shorts are held, the weakest of each date; ties go by symbol.

    top is a number of symbols, or below 1 a share of those that have a reading.
    """
    return _sided(readings.where("momentum is not null and close is not null"), top, long_short).where("side is not null")


def weighted_readings(readings: DataFrame, top: float, long_short: bool = False, ok: Column | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """All readings with `side` and `weight`, those of ranked() and weights() among the ones that are `ok`, null and 0 elsewhere.

    `by` names the columns of a book's key: books that differ in what is ok are then rows of one plan.
    """
    fit = F.col("momentum").isNotNull() & F.col("close").isNotNull()
    fit = fit if ok is None else fit & ok
    rows = _sided(readings.withColumn("__fit", fit), top, long_short, "__fit", by)
    rows = rows.withColumn("side", F.when(F.col("__fit"), F.col("side"))).drop("__fit")
    half = F.when(F.min("side").over(W.partitionBy(*by, "k")) < 0, 0.5).otherwise(1.0)
    weight = F.col("side") * half / F.count("side").over(W.partitionBy(*by, "k", "side"))
    return rows.withColumn("weight", F.when(F.col("side").isNotNull(), weight).otherwise(F.lit(0.0)))


def _sided(rows: DataFrame, top: float, long_short: bool, fit: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    every = W.partitionBy(*by, *(["k", fit] if fit else ["k"]))
    n = F.greatest(F.lit(1), F.bround(F.count(F.lit(1)).over(every) * top).cast("int")) if top < 1 else F.lit(int(top))
    best = F.row_number().over(every.orderBy(F.col("momentum").desc(), "symbol"))
    worst = F.row_number().over(every.orderBy("momentum", "symbol"))
    rows = rows.withColumn("__n", n).withColumn("__best", best).withColumn("__worst", worst)
    side = F.when(F.col("__best") <= F.col("__n"), 1)
    side = side.when(F.col("__worst") <= F.col("__n"), -1) if long_short else side
    return rows.withColumn("side", side).drop("__n", "__best", "__worst")


def signed(readings: DataFrame, threshold: float = 0.0, long_short: bool = False) -> DataFrame:
    side = F.when(F.col("momentum") > threshold, 1)
    side = side.when(F.col("momentum") < -abs(threshold), -1) if long_short else side
    return readings.withColumn("side", side).where("side is not null and close is not null")


def weights(chosen: DataFrame) -> DataFrame:
    """Equal weights on each side, a half each where a date has shorts."""
    each = W.partitionBy("k", "side")
    half = F.when(F.min("side").over(W.partitionBy("k")) < 0, 0.5).otherwise(1.0)
    return chosen.withColumn("weight", F.col("side") * half / F.count(F.lit(1)).over(each))


def book(readings: DataFrame, held: DataFrame | None = None, rate: float = 0.001, by: tuple[str, ...] = ()) -> DataFrame:
    """(k, date, holdings, turnover, growth, delisted, equity): equity before each date's trades, by period.

    Without `held`, readings have `weight` themselves, as weighted_readings() gives it: nothing is joined then. `by` names the columns of a book's
    key, which come first; each book is one of its own.

    A holding earns from its close to the next date's, or to its last print where it has none there. Turnover is
    against what the weights before have drifted to; its cost is paid before the period earns.
    """
    along = W.partitionBy(*by, "symbol").orderBy("k")
    ahead = readings.select(
        *by, "symbol", "k", "date", "close", F.lead("close").over(along).alias("next_close"), F.lead("print_close").over(along).alias("next_print"), *(["weight"] if held is None else [])
    )
    rows = ahead if held is None else ahead.join(held.select(*by, "symbol", "k", "weight"), [*by, "symbol", "k"], "left")
    rows = rows.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    ratio = F.when(F.col("weight") != 0, F.coalesce(F.coalesce("next_close", "next_print") / F.col("close"), F.lit(1.0))).otherwise(F.lit(1.0))
    rows = rows.withColumn("ratio", ratio)
    growth = 1 + F.sum(F.col("weight") * (F.col("ratio") - 1)).over(W.partitionBy(*by, "k"))
    rows = rows.withColumn("growth", growth).withColumn("drifted", F.lag(F.col("weight") * F.col("ratio") / F.col("growth")).over(along))
    turn = F.abs(F.col("weight") - F.coalesce("drifted", F.lit(0.0)))
    per = rows.groupBy(*by, "k").agg(
        F.max("date").alias("date"), F.sum((F.col("weight") != 0).cast("long")).alias("holdings"), F.sum(turn).alias("turnover"), F.max("growth").alias("growth"),
        F.sum(((F.col("weight") != 0) & F.col("next_close").isNull() & F.col("next_print").isNotNull()).cast("long")).alias("delisted"),
    )
    return compounded(per, rate, by)


def gate_books(readings: DataFrame, limits: list[float | None], top: float, rate: float = 0.001) -> DataFrame:
    """(option, k, date, ...): book() for each limit of how far below its peak a symbol may be, in order of the list; None is no gate.

    The limits are a few constants: readings are repeated for each, and ranks, weights and books are keyed by them in one plan.
    """
    options = F.array(*[F.struct(F.lit(i).alias("option"), F.lit(x).cast("double").alias("limit")) for i, x in enumerate(limits)])
    rows = readings.withColumn("__o", F.explode(options)).withColumns({"option": F.col("__o.option"), "__limit": F.col("__o.limit")}).drop("__o")
    ok = F.col("__limit").isNull() | F.coalesce(F.col("below_peak") >= -F.col("__limit"), F.lit(False))
    return book(weighted_readings(rows, top, ok=ok, by=("option",)), rate=rate, by=("option",))


def yearly(books: DataFrame, rate: float = 0.001, by: tuple[str, ...] = ("option",)) -> DataFrame:
    """(by, year, growth): what the periods that begin in a year made of a book, costs included."""
    net = F.greatest(1 - F.col("turnover") * rate, F.lit(0.0)) * F.col("growth")
    return books.groupBy(*by, F.year(F.timestamp_seconds("date")).alias("year")).agg(F.product(net).alias("growth"))


def compounded(per: DataFrame, rate: float, keys: tuple[str, ...] = ()) -> DataFrame:
    """per with `equity` before each period: one row a date, so that each book is one small window."""
    before = W.partitionBy(*keys).orderBy("k").rowsBetween(W.unboundedPreceding, -1)
    rows = per.withColumn("__f", F.greatest(1 - F.col("turnover") * rate, F.lit(0.0)) * F.col("growth"))
    equity = F.when(F.coalesce(F.min("__f").over(before), F.lit(1.0)) <= 0, F.lit(0.0)).otherwise(F.coalesce(F.product("__f").over(before), F.lit(1.0)))
    return rows.withColumn("equity", equity).drop("__f")


def vol_scale(per: DataFrame, window: int, per_year: float, target: float, floor: float, cap: float) -> DataFrame:
    """per with `scale`: target over the deviation of the last periods' unscaled returns, a year's worth, between floor and cap."""
    last = W.orderBy("k").rowsBetween(-window, -1)
    rows = per.withColumn("__r", F.col("growth") - 1)
    sigma = F.stddev_pop("__r").over(last) * per_year**0.5
    scale = F.when(F.count("__r").over(last) < min(5, window), F.lit(1.0)).when(sigma <= 0, F.lit(cap)).otherwise(
        F.greatest(F.lit(floor), F.least(F.lit(cap), F.lit(target) / F.nullif(sigma, F.lit(0.0))))
    )
    return rows.withColumn("scale", scale).drop("__r")


def vol_targeted(readings: DataFrame, window: int, per_year: float, target: float, floor: float = 0.1, cap: float = 1.0, rate: float = 0.001) -> DataFrame:
    """book() of readings with `weight`, every date's weights times its vol_scale(), which is of the book at full weight; with `scale`."""
    scales = vol_scale(book(readings, rate=rate), window, per_year, target, floor, cap).select("k", "scale")
    sized = readings.join(scales, "k").withColumn("weight", F.col("weight") * F.col("scale")).drop("scale")
    return book(sized, rate=rate).join(scales, "k")


def equal_weight(readings: DataFrame, rate: float = 0.001) -> DataFrame:
    """(k, equal_weight): an equal share in each symbol from its first print on, cash before, its last print after."""
    along = W.partitionBy("symbol").orderBy("k")
    seen = along.rowsBetween(W.unboundedPreceding, 0)
    first = F.first("close", ignorenulls=True).over(seen)
    value = F.when(first.isNull(), F.lit(1.0)).otherwise(F.last("close", ignorenulls=True).over(seen) / first * (1 - rate) ** 2)
    return readings.withColumn("__v", value).groupBy("k").agg(F.avg("__v").alias("equal_weight"))


def trade_log(readings: DataFrame, held: DataFrame) -> DataFrame:
    """(symbol, k, event, close): buys, sells, shorts and covers at the dates where a symbol's side changes."""
    rows = readings.select("symbol", "k", "close").join(held.select("symbol", "k", "side"), ["symbol", "k"], "left")
    rows = rows.withColumn("side", F.coalesce("side", F.lit(0)))
    was = F.coalesce(F.lag("side").over(W.partitionBy("symbol").orderBy("k")), F.lit(0))
    rows = rows.withColumn("was", was).where("side <> was")
    left = F.when(F.col("was") > 0, "sell").when(F.col("was") < 0, "cover")
    came = F.when(F.col("side") > 0, "buy").when(F.col("side") < 0, "short")
    return rows.select("symbol", "k", F.explode(F.array_compact(F.array(left, came))).alias("event"), "close")


def census(readings: DataFrame, held: DataFrame) -> DataFrame:
    """A row for each symbol of the universe: dates held, first and last, and its events; those never held too."""
    spans = held.groupBy("symbol").agg(F.count(F.lit(1)).alias("held"), F.min("k").alias("first_k"), F.max("k").alias("last_k"))
    events = trade_log(readings, held).groupBy("symbol").pivot("event", ["buy", "sell", "short", "cover"]).count()
    out = readings.select("symbol").distinct().join(spans, "symbol", "left").join(events, "symbol", "left")
    return out.select("symbol", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("held", "buy", "sell", "short", "cover")], "first_k", "last_k")


def exposure_markers(per_k: DataFrame) -> DataFrame:
    """(k, exposure) where the share of capital in the market changes."""
    was = F.lag("exposure").over(W.orderBy("k"))
    return per_k.withColumn("__w", was).where(F.col("__w").isNull() | (F.col("__w") != F.col("exposure"))).drop("__w")


def permuted(readings: DataFrame, columns: list[str], seed: int) -> DataFrame:
    """A placebo: on each date, every symbol has the readings `columns` of another one, by a permutation that the seed sets."""
    names = readings.select("symbol").distinct()
    order = W.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), "symbol")), "symbol")
    a = names.select("symbol", F.row_number().over(W.orderBy("symbol")).alias("n"))
    b = names.select(F.col("symbol").alias("lender"), F.row_number().over(order).alias("n"))
    lent = readings.select(F.col("symbol").alias("lender"), "k", *columns)
    mapped = a.join(b, "n").drop("n")
    return readings.drop(*columns).join(mapped, "symbol").join(lent, ["lender", "k"], "left").drop("lender")

"""Exposures to equity: curves, trades, benchmarks. Signals are read at a close and filled at the next open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.sources.bars import KEY


def _so_far(keys) -> W:
    return W.partitionBy(*keys).orderBy("time").rowsBetween(W.unboundedPreceding, 0)


def check_targets(bars: DataFrame, spot_only: bool = False) -> DataFrame:
    """Fails when a row is read whose target is outside of [-1, 1], or below 0 if only spot is allowed."""
    low = 0.0 if spot_only else -1.0
    bad = F.col("target").isNull() | (F.col("target") < low) | (F.col("target") > 1)
    return bars.withColumn("target", F.when(bad, F.raise_error(F.lit("target out of range")).cast("double")).otherwise(F.col("target")))


def equity_curve(bars: DataFrame, rate: Column | float = 0.001, keys=KEY) -> DataFrame:
    """bars with position, before, equity, gross, fee and ruined; needs `target`, and heeds `exit_price` if it is there.

    The position of a bar is the target of the one before. From open to open it earns the move of the price,
    or of the exit price where one was hit inside of the bar; a change of position costs `rate` of what it
    moves. Equity is the running product of these factors; once it isn't positive it stays 0.
    """
    order = W.partitionBy(*keys).orderBy("time")
    rate = rate if isinstance(rate, Column) else F.lit(float(rate))
    stops = F.col("exit_price") if "exit_price" in bars.columns else F.lit(None).cast("double")
    rows = bars.withColumn("__pos", F.coalesce(F.lag("target").over(order), F.lit(0.0))).withColumn("__exit", stops)
    held = F.coalesce(F.lag("__pos").over(order), F.lit(0.0))
    open_ = F.lag("open").over(order)
    fill = F.when((held != 0) & F.lag("__exit").over(order).isNotNull(), F.lag("__exit").over(order)).otherwise(F.col("open"))
    rows = rows.withColumn("__held", held).withColumn("__move", F.coalesce(1 + held * (fill / F.nullif(open_, F.lit(0.0)) - 1), F.lit(1.0)))
    rows = rows.withColumn("__gross", F.coalesce(1 + held * (F.col("open") / F.nullif(open_, F.lit(0.0)) - 1), F.lit(1.0)))
    rows = rows.withColumn("turn", F.abs(F.col("__pos") - F.col("__held"))).withColumn("__factor", F.col("__move") * F.pow(1 - rate, F.col("turn")))
    so_far = _so_far(keys)
    rows = rows.withColumn("__ruin", F.min("__factor").over(so_far) <= 0)
    after = F.when(F.col("__ruin"), F.lit(0.0)).otherwise(F.product("__factor").over(so_far))
    rows = rows.withColumn("equity", after).withColumn("gross", F.when(F.min("__gross").over(so_far) <= 0, F.lit(0.0)).otherwise(F.product("__gross").over(so_far)))
    ruined_before = F.coalesce(F.lag("__ruin").over(order), F.lit(False))
    rows = rows.withColumn("before", F.when(ruined_before, F.lit(0.0)).otherwise(F.coalesce(F.lag("equity").over(order), F.lit(1.0)) * F.col("__move")))
    rows = rows.withColumn("position", F.when(ruined_before, F.lit(0.0)).otherwise(F.col("__pos")))
    rows = rows.withColumn("fee", rate * F.col("turn") * F.greatest("before", F.lit(0.0)))
    return rows.withColumn("ruined", F.col("__ruin")).drop("__pos", "__exit", "__held", "__move", "__gross", "__factor", "__ruin")


def summary(curve: DataFrame, rate: Column | float = 0.001, keys=KEY) -> DataFrame:
    """A row for each curve: final equity marked at the last close, gross equity, fees, exposure, bars."""
    place = F.max_by(F.struct("equity", "position", "open", "close", "gross"), "time").alias("z")
    out = curve.groupBy(*keys).agg(
        place, F.sum("fee").alias("fees_paid"), F.avg(F.abs("position")).alias("exposure"), F.count(F.lit(1)).alias("bars"), F.max("ruined").alias("ruined")
    )
    mark = 1 + F.col("z.position") * (F.col("z.close") / F.col("z.open") - 1)
    return out.select(*keys, "bars", (F.col("z.equity") * mark).alias("final_equity"), (F.col("z.gross") * mark).alias("gross_equity"), "fees_paid", "exposure", "ruined")


def trades(curve: DataFrame, keys=KEY) -> DataFrame:
    """A row for each holding period: a run of bars of one side, resized or not; one still open is marked at the last close."""
    order = W.partitionBy(*keys).orderBy("time")
    side = F.signum("position").cast("int")
    rows = curve.withColumn("side", side).withColumn("__n", F.row_number().over(order))
    last_side = F.coalesce(F.lag("side").over(order), F.lit(0))
    rows = rows.withColumn("__new", (F.col("side") != last_side).cast("int")).withColumn("__was", last_side)
    rows = rows.withColumn("trade", F.sum("__new").over(_so_far(keys)))
    # The bar after a run's last one closes it: at its open, with the equity after its costs.
    rows = rows.withColumn("__x", F.lead(F.struct("time", "open", "equity", "ruined")).over(order))
    basis = F.when(F.col("__was") == 0, F.col("before")).otherwise(F.col("equity"))
    runs = rows.where("side <> 0").groupBy(*keys, "trade").agg(
        F.min_by(F.struct("side", F.col("time").alias("entry_time"), F.col("open").alias("entry_price"), basis.alias("equity_at_entry")), "time").alias("e"),
        F.max_by(F.struct("__x", "time", "close", "open", "equity", "position"), "time").alias("l"), F.count(F.lit(1)).alias("bars_held"),
    )
    still = F.col("l.__x").isNull()
    price = F.when(still, F.col("l.close")).otherwise(F.col("l.__x.open"))
    after = F.when(still, F.col("l.equity") * (1 + F.col("l.position") * (F.col("l.close") / F.col("l.open") - 1))).otherwise(F.col("l.__x.equity"))
    return runs.select(
        *keys, "trade", F.col("e.side").alias("side"), F.col("e.entry_time").alias("entry_time"), F.col("e.entry_price").alias("entry_price"),
        F.when(still, F.col("l.time")).otherwise(F.col("l.__x.time")).alias("exit_time"), price.alias("exit_price"), "bars_held",
        (F.pow(price / F.col("e.entry_price"), F.col("e.side")) - 1).alias("gross_return"), (after / F.nullif(F.col("e.equity_at_entry"), F.lit(0.0)) - 1).alias("net_return"),
        F.col("e.equity_at_entry").alias("equity_at_entry"), after.alias("equity_at_exit"), still.alias("open_at_end"),
    )


def book_check(trade_rows: DataFrame, totals: DataFrame, keys=KEY, tol: float = 1e-9) -> DataFrame:
    """Whether the trades' net returns, multiplied up, are the final equity."""
    held = trade_rows.groupBy(*keys).agg(F.product(1 + F.col("net_return")).alias("booked"))
    error = F.abs(F.coalesce("booked", F.lit(1.0)) / F.nullif(F.col("final_equity"), F.lit(0.0)) - 1)
    return totals.join(held, list(keys), "left").select(*keys, error.alias("error"), (F.coalesce(error, F.lit(0.0)) <= tol).alias("ok"))


def buy_and_hold(bars: DataFrame, rate: Column | float = 0.001, keys=KEY) -> DataFrame:
    """bars with `hold`: 1 at first, then the close over the second bar's open."""
    order = W.partitionBy(*keys).orderBy("time")
    second = F.nth_value("open", 2).over(order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    first = F.row_number().over(order) == 1
    return bars.withColumn("hold", F.when(first, F.lit(1.0)).otherwise(F.col("close") / second)).withColumn("hold_net", F.col("hold") * (1 - rate) ** 2)


def close_fill(bars: DataFrame, rate: float = 0.001, keys=KEY) -> DataFrame:
    """bars with `close_equity`: the same targets filled at their own closes."""
    order = W.partitionBy(*keys).orderBy("time")
    held = F.coalesce(F.lag("target").over(order), F.lit(0.0))
    factor = F.coalesce(1 + held * (F.col("close") / F.lag("close").over(order) - 1), F.lit(1.0)) * F.pow(F.lit(1 - rate), F.abs(F.col("target") - held))
    return bars.withColumn("__f", factor).withColumn("close_equity", F.product("__f").over(_so_far(keys))).drop("__f")


def fees_in(curve: DataFrame, rate: float, first: int, last: int, keys=KEY) -> DataFrame:
    """Fees of the bars from first to last, counted from 0, restated from the equity after them; the first bar has none."""
    n = F.row_number().over(W.partitionBy(*keys).orderBy("time")) - 1
    rows = curve.withColumn("__n", n).where(F.col("__n").between(max(first, 1), last) & (F.col("equity") > 0))
    return rows.groupBy(*keys).agg(F.sum(F.lit(rate) * F.col("turn") * F.col("equity") / F.pow(F.lit(1 - rate), F.col("turn"))).alias("fees"))


def restrict(curve: DataFrame, first: int, last: int, keys=KEY) -> DataFrame:
    """The results between two times, rebased to 1 at the first bar; `marked` ends at the last close, `hold` enters at the second open.

    Signals keep their history: results are cut, not inputs. Series of fewer than three bars there fall out.
    """
    rows = curve.where(F.col("time").between(first, last))
    order = W.partitionBy(*keys).orderBy("time")
    every = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumn("__n", F.count(F.lit(1)).over(W.partitionBy(*keys))).where("__n >= 3").drop("__n")
    rows = rows.withColumn("equity", F.col("equity") / F.first("equity").over(every))
    ends = F.lead("time").over(order).isNull()
    rows = rows.withColumn("marked", F.when(ends, F.col("equity") * (1 + F.col("position") * (F.col("close") / F.col("open") - 1))).otherwise(F.col("equity")))
    begins = F.lag("time").over(order).isNull()
    return rows.withColumn("hold", F.when(begins, F.lit(1.0)).otherwise(F.col("close") / F.nth_value("open", 2).over(every)))


def trades_within(trade_rows: DataFrame, first: int, last: int) -> DataFrame:
    """Trades that a window sees: one carried in starts with the window."""
    rows = trade_rows.where((F.col("entry_time") <= last) & ((F.col("exit_time") > first) | F.col("open_at_end")))
    return rows.withColumn("entry_time", F.greatest("entry_time", F.lit(first)))


def markers(curve: DataFrame, keys=KEY) -> DataFrame:
    """Bars at which a side is entered, left or turned; resizes give none."""
    now = F.signum("position").cast("int")
    rows = curve.withColumn("__now", now).withColumn("__was", F.coalesce(F.lag(now).over(W.partitionBy(*keys).orderBy("time")), F.lit(0)))
    kind = F.when(F.col("__was") == 0, "entry").when(F.col("__now") == 0, "exit").otherwise("flip")
    return rows.where("__now <> __was").select(*keys, "time", "open", kind.alias("kind"), F.col("__now").alias("side"))


def swept(bars: DataFrame, params: DataFrame) -> DataFrame:
    """Every bar for every row of a small table of parameters; group and order by its id beside the series."""
    return bars.crossJoin(F.broadcast(params))


def overlay(bars: DataFrame, start: float, full: float, floor: float, rate: float = 0.001) -> DataFrame:
    """Adds `scaled` and `scaled_equity`: exposure shrinks with the account's own drawdown at the bar before."""
    from barloom.operators.folds import fold

    def step(rows, state):
        equity, peak, pos, wanted, at = state or (1.0, 1.0, 0.0, None, None)
        out, curve = [], []
        for target, price in zip(rows["target"].tolist(), rows["open"].tolist(), strict=True):
            want = 0.0
            if at is not None:
                fall = abs(equity / peak - 1)
                scale = 1.0 if fall <= start else floor if fall >= full else 1 - (1 - floor) * (fall - start) / (full - start)
                want = wanted * scale if equity > 0 else 0.0
                equity = max(0.0, equity * (1 + pos * (price / at - 1)) * (1 - rate) ** abs(want - pos))
            pos, peak, wanted, at = want, max(peak, equity), target, price
            out.append(want)
            curve.append(equity)
        return {"scaled": out, "scaled_equity": curve}, (equity, peak, pos, wanted, at)

    return fold(bars, KEY, step, {"scaled": "double", "scaled_equity": "double"})



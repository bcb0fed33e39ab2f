"""Books weighted by risk on an aligned calendar: decided at a close, filled at the next one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.operators.folds import fold

CALM = 0.10
PASSES = 10


def universe(rows: DataFrame, top: int, lookback: int, rebalance: int, min_history: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """(symbol, idx, traded, place) and the columns `carry` at each rebalance bar: the most traded over the last `lookback` bars with a price and a history."""
    along = W.partitionBy("symbol").orderBy("idx")
    traded = rows.withColumn("traded", F.sum("turnover").over(along.rowsBetween(-(lookback - 1), 0)))
    ready = traded.where((F.col("idx") >= 1) & (F.col("idx") % rebalance == 0) & F.col("price").isNotNull() & (F.col("idx") - F.col("first_idx") >= min_history))
    place = F.row_number().over(W.partitionBy("idx").orderBy(F.col("traded").desc(), "symbol"))
    return ready.withColumn("place", place).where(F.col("place") <= top).select("symbol", "idx", "traded", "place", *carry)


def trailing_vol(rows: DataFrame, window: int, per_year: float) -> DataFrame:
    """rows with `vol`: population deviation of the returns of the last window bars, a year's worth; null under three."""
    along = W.partitionBy("symbol").orderBy("idx")
    before = F.lag("price").over(along)
    last = along.rowsBetween(-(window - 1), 0)
    out = rows.withColumn("__r", F.when(before > 0, F.col("price") / F.when(before > 0, before) - 1))
    return out.withColumn("vol", F.when(F.count("__r").over(last) >= 3, F.stddev_pop("__r").over(last) * per_year**0.5)).drop("__r")


def weighted(chosen: DataFrame, scheme: str = "equal") -> DataFrame:
    """chosen with `weight`, 1 in all on each bar: equal, or inverse to `vol` without what is calmer than 10 % a year."""
    each = W.partitionBy("idx")
    if scheme == "equal":
        return chosen.withColumn("weight", 1 / F.count(F.lit(1)).over(each))
    rows = chosen.where(F.col("vol") >= CALM).withColumn("__i", 1 / F.col("vol"))
    return rows.withColumn("weight", F.col("__i") / F.sum("__i").over(each)).drop("__i")


def capped(rows: DataFrame, cap: float) -> DataFrame:
    """Weights cut at `cap`; what is cut goes to the others in proportion, pass by pass, and what finds no room is cash."""
    each = W.partitionBy("idx")
    for _ in range(PASSES):
        rows = rows.withColumn("__over", F.greatest(F.col("weight") - cap, F.lit(0.0)))
        room = F.when(F.col("weight") < cap, F.col("weight")).otherwise(F.lit(0.0))
        rows = rows.withColumn("__room", room).withColumn("__sum", F.sum("__room").over(each)).withColumn("__cut", F.sum("__over").over(each))
        more = F.when(F.col("__sum") > 0, F.col("__cut") * F.col("__room") / F.nullif(F.col("__sum"), F.lit(0.0))).otherwise(F.lit(0.0))
        rows = rows.withColumn("weight", F.least(F.col("weight"), F.lit(cap)) + more).drop("__over", "__room", "__sum", "__cut")
    return rows.withColumn("weight", F.least("weight", F.lit(cap)))


def default_cap(top: int) -> float:
    return max(0.25, 2 / top)


def trend_ok(rows: DataFrame, bars: int) -> DataFrame:
    """rows with `up`: the price is above that of `bars` rows ago; a missing one fails."""
    past = F.lag("price", bars).over(W.partitionBy("symbol").orderBy("idx"))
    return rows.withColumn("up", F.coalesce(F.col("price") > past, F.lit(False)))


def positions(rows: DataFrame, weights: DataFrame, rebalance: int, gate: bool = False) -> DataFrame:
    """(symbol, fill, until, idx, weight, ratio, gone, sale): each holding bar by bar, from its fill to the bar of the next one.

    A decision at bar d is filled at d + 1 and held until the next decision that has targets is filled, or the calendar ends;
    `ratio` is the price over that of the fill, and a bar without a price, or after one without, leaves it as it is. With a gate, a name
    whose `up` fails at a close between decisions is sold at the next one: `sale` there, `gone` from there on, and its ratio
    stays. Decisions should be made among names that are `up`; one that was sold comes back by them alone.
    """
    was = F.lag("price").over(W.partitionBy("symbol").orderBy("idx"))
    moves = rows.select("symbol", "idx", F.coalesce(F.col("price") / F.when(was > 0, was), F.lit(1.0)).alias("move"), *(["up"] if gate else []))
    # One row a rebalance.
    fills = weights.select((F.col("idx") + 1).alias("fill")).distinct().crossJoin(F.broadcast(rows.agg(F.max("idx").alias("last")))).where("fill <= last")
    fills = fills.select("fill", F.coalesce(F.lead("fill").over(W.orderBy("fill")), F.col("last")).alias("until"))
    held = weights.select("symbol", (F.col("idx") + 1).alias("fill"), "weight").join(fills, "fill")
    out = held.withColumn("idx", F.explode(F.sequence("fill", "until"))).join(moves, ["symbol", "idx"])
    along = W.partitionBy("symbol", "fill").orderBy("idx")
    if gate:
        fails = (~F.col("up") & (F.col("idx") % rebalance != 0)).cast("int")
        before = lambda n: F.coalesce(F.max(fails).over(along.rowsBetween(W.unboundedPreceding, -n)) == 1, F.lit(False))
        out = out.withColumn("gone", before(1)).withColumn("__left", before(2))
    else:
        out = out.withColumn("gone", F.lit(False)).withColumn("__left", F.lit(False))
    earned = F.when((F.col("idx") == F.col("fill")) | F.col("__left"), F.lit(1.0)).otherwise(F.col("move"))
    ratio = F.product(earned).over(along.rowsBetween(W.unboundedPreceding, 0))
    return out.select("symbol", "fill", "until", "idx", "weight", ratio.alias("ratio"), "gone", (F.col("gone") & ~F.col("__left")).alias("sale"))


def book_bars(held: DataFrame) -> DataFrame:
    """(idx, fill, unit, growth, exits, alive, swaps) for each bar from the first fill on: what a book needs, whatever its scale.

    unit is the value, at this bar and before its trades, of one invested at the fill of the book that came into it, growth what the bar
    made of it; exits and alive are the parts of it in names that are sold here and that stay. On the bar of a fill, swaps has
    (new, old) for each name: its new weight, and its part of unit so far.
    """
    value = F.col("weight") * F.col("ratio")
    per = held.groupBy("fill", "idx").agg(
        (1 + F.sum(F.col("weight") * (F.col("ratio") - 1))).alias("unit"), F.sum(F.when(F.col("sale"), value).otherwise(F.lit(0.0))).alias("exits"),
        F.sum(F.when(F.col("gone"), F.lit(0.0)).otherwise(value)).alias("alive"),
    )
    growth = F.col("unit") / F.nullif(F.lag("unit").over(W.partitionBy("fill").orderBy("idx")), F.lit(0.0))
    per = per.withColumn("growth", F.coalesce(growth, F.lit(1.0))).where("idx > fill")
    ends = held.where("(idx = fill) or (idx = until)").join(held.select(F.col("fill").alias("idx")).distinct(), "idx")
    new = F.when(F.col("idx") == F.col("fill"), F.col("weight")).otherwise(F.lit(0.0))
    old = F.when((F.col("idx") > F.col("fill")) & ~F.col("gone"), value).otherwise(F.lit(0.0))
    swaps = ends.groupBy("idx", "symbol").agg(F.sum(new).alias("new"), F.sum(old).alias("old")).groupBy("idx").agg(F.collect_list(F.struct("new", "old")).alias("swaps"))
    both = per.join(swaps, "idx", "full_outer")
    fill = F.when(F.col("swaps").isNotNull(), F.col("idx")).otherwise(F.col("fill"))
    zero = lambda c, v=0.0: F.coalesce(c, F.lit(v)).alias(c)
    return both.select("idx", fill.alias("fill"), "unit", zero("growth", 1.0), zero("exits"), zero("alive"), "swaps")


def unit_book(held: DataFrame, rate: float = 0.001) -> DataFrame:
    """(idx, fill, growth, turnover, invested, cost, equity) for each bar from the first fill on, fully invested.

    On the bar of a fill the old book earns up to that close; names that the gate sells there are sold first, then the new weights
    are traded against what the old ones have drifted to. Each trade costs `rate` of what it moves.
    """
    unit = F.coalesce(F.nullif(F.col("unit"), F.lit(0.0)), F.lit(1.0))
    book = book_bars(held).withColumn("__sold", F.col("exits") / unit)
    moved = F.aggregate("swaps", F.lit(0.0), lambda total, x: total + F.abs(x["new"] - x["old"] / unit))
    invested = F.when(F.col("swaps").isNotNull(), F.aggregate("swaps", F.lit(0.0), lambda total, x: total + x["new"])).otherwise(F.col("alive") / unit)
    book = book.withColumn("__moved", F.coalesce(moved, F.lit(0.0))).withColumn("invested", invested)
    kept = F.greatest(1 - F.col("__sold") * rate, F.lit(0.0)) * F.greatest(1 - F.col("__moved") * rate, F.lit(0.0))
    before = W.orderBy("idx")
    book = book.withColumn("__kept", kept).withColumn("equity", F.product(F.col("growth") * F.col("__kept")).over(before.rowsBetween(W.unboundedPreceding, 0)))
    cost = F.coalesce(F.lag("equity").over(before), F.lit(1.0)) * F.col("growth") * (1 - F.col("__kept"))
    return book.select("idx", "fill", "growth", (F.col("__sold") + F.col("__moved")).alias("turnover"), "invested", cost.alias("cost"), "equity")


def budget_scaled(bars: DataFrame, budget: float, vol_window: int, per_year: float, rate: float = 0.001) -> DataFrame:
    """(book_id, idx, fill, scale, turnover, invested, equity) of book_bars() with a book_id: exposure is cut where the book's own volatility exceeds the budget.

    The scale of a fill is set at its decision, a bar before, from the deviation of the scaled book's last vol_window returns; a book is then
    worth 1 + scale * (unit - 1) since its fill. This feeds back, so each book is walked, one row a bar; books run in parallel. Bars of
    the calendar before the first fill count as flat.
    """

    def step(rows, state):
        first = int(rows["idx"].iloc[0])
        equity, scale, unit, levels, out = 1.0, 1.0, 1.0, [1.0] * first, []
        for value, exits, alive, swaps in zip(*(rows[c] for c in ("unit", "exits", "alive", "swaps")), strict=True):
            worth, turnover = 1.0, 0.0
            if value == value and value is not None:
                worth = 1 + scale * (value - 1)
                equity *= worth / (1 + scale * (unit - 1))
                turnover, unit = scale * exits / worth, value
                equity *= max(0.0, 1 - rate * turnover)
            invested = scale * alive / worth
            if swaps is not None:
                now = 1.0
                if len(levels) > vol_window:
                    recent = [b / a - 1 for a, b in zip(levels[-vol_window - 1 :], levels[-vol_window:], strict=False) if a > 0]
                    mean = sum(recent) / max(len(recent), 1)
                    real = (sum((x - mean) ** 2 for x in recent) / len(recent) * per_year) ** 0.5 if len(recent) > 3 else 0.0
                    now = min(1.0, budget / real) if real > 0 else 1.0
                moved = sum(abs(now * x["new"] - scale * x["old"] / worth) for x in swaps)
                equity *= max(0.0, 1 - rate * moved)
                turnover, scale, unit, invested = turnover + moved, now, 1.0, now * sum(x["new"] for x in swaps)
            levels.append(equity)
            out.append((scale, turnover, invested, equity))
        return dict(zip(("scale", "turnover", "invested", "equity"), map(list, zip(*out, strict=True)), strict=True)), None

    walked = fold(bars.withColumn("time", F.col("idx")), ["book_id"], step, dict.fromkeys(("scale", "turnover", "invested", "equity"), "double"))
    return walked.select("book_id", "idx", "fill", "scale", "turnover", "invested", "equity")


def single_hold(rows: DataFrame, symbol: str, rate: float = 0.001) -> DataFrame:
    """(idx, hold): one symbol's price over its first, less the cost of buying it; 1 before it is there."""
    along = W.orderBy("idx").rowsBetween(W.unboundedPreceding, 0)
    price, first = F.last("price", ignorenulls=True).over(along), F.first("price", ignorenulls=True).over(along)
    return rows.where(F.col("symbol") == symbol).select("idx", F.when(first.isNull(), F.lit(1.0)).otherwise(price / first * (1 - rate)).alias("hold"))


def shares(book: DataFrame) -> DataFrame:
    """Mean share invested, share of bars out of the market, turnover a bar, and cost a bar: the share of the equity that its fills and exits took."""
    return book.agg(F.avg("invested").alias("invested"), F.avg((F.col("invested") <= 0).cast("double")).alias("flat"), F.avg("turnover").alias("turnover"), F.avg(F.col("cost") / F.nullif(F.col("equity") + F.col("cost"), F.lit(0.0))).alias("cost"))


def restricted(book: DataFrame, first: int, last: int | None = None, hold: DataFrame | None = None, rate: float = 0.001) -> DataFrame:
    """The bars from first to last, or to the end, of a book as it stood: indexed from 0, equity 1 at the first, costs of what it then had.

    hold, (idx, hold), is bought anew: it starts at 1 less one side's cost. No rows where fewer than three bars are there.
    """
    rows = book.where(F.col("idx") >= first if last is None else F.col("idx").between(first, last))
    if hold is not None:
        rows = rows.join(hold, "idx", "left")
    whole = W.orderBy("idx").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    based = [(F.col(c) / F.first("equity").over(whole)).alias(c) for c in ("equity", "cost") if c in book.columns]
    bought = [] if hold is None else [(F.col("hold") / F.first("hold").over(whole) * (1 - rate)).alias("hold")]
    rows = rows.withColumn("__n", F.count(F.lit(1)).over(W.partitionBy())).where("__n >= 3")
    return rows.select((F.col("idx") - first).alias("idx"), *based, "invested", "turnover", *bought)

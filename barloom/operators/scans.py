"""Smoothings along a series as associative scans: steps are affine maps, composed within slices of time and then across slices.

A smoothing starts as the mean of its first n values and goes on as level + alpha * (value - level); a missing value holds
the level. Each step is a map x -> a x + b, so the steps of a slice make one such map; these, one a slice, are composed along a series and give
every slice its start. No task needs more of a series than the bars of a slice and two numbers for each other one. All smoothings of a call share the slices, so their number changes no exchange.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.timegrid import DAY, TIMEFRAMES
from barloom.sources.bars import KEY
from barloom.sources.workspace import kept

#: Bars of a slice at most.
SLICE_BARS = 4096
#: (1 - alpha) ** -rows must stay a double: the natural logarithm that a slice may reach.
_STEEPEST = 230.0


@dataclass(frozen=True)
class Smoothing:
    """out: the smoothing of a column by alpha, from the mean of its first n values on."""

    value: str
    n: int
    alpha: float
    out: str

    @property
    def keep(self) -> float:
        return 1 - self.alpha


def ema(value: str, n: int, out: str) -> Smoothing:
    return Smoothing(value, n, 2 / (n + 1), out)


def wilder(value: str, n: int, out: str) -> Smoothing:
    return Smoothing(value, n, 1 / n, out)


def _with_slices(bars: DataFrame, slice_bars: int) -> DataFrame:
    """Adds `__slice`: spans of slice_bars steps of the series' timeframe, counted from the epoch; unknown timeframes count as days."""
    lengths = F.create_map(*[F.lit(x) for k, v in TIMEFRAMES.items() for x in (k, v or 28 * DAY)])
    span = F.coalesce(F.try_element_at(lengths, F.col("timeframe")), F.lit(DAY)).cast("long") * slice_bars
    return bars.withColumn("__slice", F.floor(F.col("time") / span))


def _valid(column: str) -> Column:
    return F.when(~F.isnan(column), F.col(column))


def _across() -> W:
    return W.partitionBy(*KEY).orderBy("__slice")


def with_previous(bars: DataFrame, column: str, out: str, slice_bars: int = SLICE_BARS) -> DataFrame:
    """Adds the value that the bar before has; only the last bar of a slice is asked for across slices."""
    rows = kept(_with_slices(bars, slice_bars), "slices")
    ends = rows.groupBy(*KEY, "__slice").agg(F.max_by(column, "time").alias("__end"))
    ends = ends.select(*KEY, "__slice", F.lag("__end").over(_across()).alias("__before"))
    within = W.partitionBy(*KEY, "__slice").orderBy("time")
    rows = rows.join(ends, [*KEY, "__slice"]).withColumns({"__nth": F.row_number().over(within), "__lag": F.lag(column).over(within)})
    return rows.withColumn(out, F.when(F.col("__nth") == 1, F.col("__before")).otherwise(F.col("__lag"))).drop("__slice", "__before", "__nth", "__lag")


def smoothed(bars: DataFrame, steps: list[Smoothing], slice_bars: int = SLICE_BARS) -> DataFrame:
    """bars with each smoothing's `out`, null until n values are there. Times of a series must differ, or the slices may grow too steep, which fails."""
    for s in steps:
        if s.n < 1 or not 0 < s.alpha <= 1:
            raise ValueError(f"no smoothing: {s}")
        if s.keep > 0:
            slice_bars = max(1, min(slice_bars, int(_STEEPEST / -math.log(s.keep))))
    values = list(dict.fromkeys(s.value for s in steps))
    rows = kept(_with_slices(bars, slice_bars), "slices")  # counted, mapped and joined: the bars themselves are worked out once
    counted = rows.groupBy(*KEY, "__slice").agg(*[F.count(_valid(v)).alias(f"__n{k}") for k, v in enumerate(values)])
    earlier = _across().rowsBetween(W.unboundedPreceding, -1)
    counted = counted.select(*KEY, "__slice", *[F.coalesce(F.sum(f"__n{k}").over(earlier), F.lit(0)).alias(f"__n{k}") for k in range(len(values))])
    within = W.partitionBy(*KEY, "__slice").orderBy("time")
    rows = rows.join(counted, [*KEY, "__slice"])
    rows = rows.withColumns({f"__c{k}": F.col(f"__n{k}") + F.count(_valid(v)).over(within) for k, v in enumerate(values)})
    at = {v: F.col(f"__c{k}") for k, v in enumerate(values)}
    # how often each step has shrunk the level in this slice; the first n values only add
    shrunk = {f"__k{i}": F.count(F.when(at[s.value] > s.n, _valid(s.value))).over(within) for i, s in enumerate(steps)}
    rows = rows.withColumns(shrunk)
    maps = {}
    for i, s in enumerate(steps):
        times, value = F.col(f"__k{i}"), _valid(s.value)
        if s.keep == 0:
            maps[f"__a{i}"] = F.when(F.count(value).over(within) > 0, 0.0).otherwise(1.0)
            maps[f"__b{i}"] = F.coalesce(F.last(value, ignorenulls=True).over(within), F.lit(0.0))
            continue
        # refused beyond twice the steepest, where times repeat: the sum below would leave the doubles
        factor = F.when(times * -math.log(s.keep) > 2.5 * _STEEPEST, F.raise_error(F.lit("too many bars in a slice"))).otherwise(F.pow(F.lit(s.keep), times))
        gain = F.when(at[s.value] > s.n, value * s.alpha).otherwise(value / s.n)
        maps[f"__a{i}"] = factor
        maps[f"__b{i}"] = factor * F.coalesce(F.sum(gain / F.pow(F.lit(s.keep), times)).over(within), F.lit(0.0))
    rows = rows.withColumns(maps)
    # a's fall along a slice, b's are those of its last bar
    ends = rows.groupBy(*KEY, "__slice").agg(*[x for i in range(len(steps)) for x in (F.min(f"__a{i}").alias(f"__a{i}"), F.max_by(f"__b{i}", "time").alias(f"__b{i}"))])
    every = range(len(steps))
    each = F.array_sort(F.collect_list(F.struct("__slice", *[F.col(f"__{c}{i}") for i in every for c in "ab"])))
    begun = F.struct(*[F.lit(0.0).alias(f"x{i}") for i in every], F.array().cast(f"array<struct<slice:bigint,{','.join(f'x{i}:double' for i in every)}>>").alias("out"))

    def compose(state: Column, end: Column) -> Column:
        place = F.struct(end["__slice"].alias("slice"), *[state[f"x{i}"].alias(f"x{i}") for i in every])
        return F.struct(*[(end[f"__a{i}"] * state[f"x{i}"] + end[f"__b{i}"]).alias(f"x{i}") for i in every], F.concat(state["out"], F.array(place)).alias("out"))

    starts = ends.groupBy(*KEY).agg(each.alias("__ends")).select(*KEY, F.explode(F.aggregate("__ends", begun, compose, lambda state: state["out"])).alias("x"))
    starts = starts.select(*KEY, F.col("x.slice").alias("__slice"), *[F.col(f"x.x{i}").alias(f"__x{i}") for i in every])
    rows = rows.join(starts, [*KEY, "__slice"])
    out = [F.when(at[s.value] >= s.n, F.col(f"__a{i}") * F.col(f"__x{i}") + F.col(f"__b{i}")).alias(s.out) for i, s in enumerate(steps)]
    names = {s.out for s in steps}
    return rows.select(*[c for c in bars.columns if c not in names], *out)


def with_emas(bars: DataFrame, spans: list[int], column: str = "close", slice_bars: int = SLICE_BARS) -> DataFrame:
    """bars with `ema{n}` for each n."""
    return smoothed(bars, [ema(column, n, f"ema{n}") for n in dict.fromkeys(spans)], slice_bars)


def with_macds(bars: DataFrame, grid: list[tuple[int, int, int]], slice_bars: int = SLICE_BARS) -> DataFrame:
    """bars with `line{k}` and `trigger{k}` for each (fast, slow, signal) of a grid, in two passes for all of them."""
    for fast, slow, signal in grid:
        if not 2 <= fast < slow or signal < 2:
            raise ValueError("macd needs 2 <= fast < slow and signal >= 2")
    spans = sorted({n for fast, slow, _ in grid for n in (fast, slow)})
    rows = smoothed(bars, [ema("close", n, f"__ema{n}") for n in spans], slice_bars)
    lines = {(fast, slow): f"__line{fast}_{slow}" for fast, slow, _ in grid}
    rows = rows.withColumns({name: F.col(f"__ema{fast}") - F.col(f"__ema{slow}") for (fast, slow), name in lines.items()})
    # a missing close holds both averages, so the line too; its own average takes the line at every bar
    triggers = {key: f"__trigger{'_'.join(map(str, key))}" for key in dict.fromkeys(grid)}
    rows = smoothed(rows, [ema(lines[fast, slow], n, name) for (fast, slow, n), name in triggers.items()], slice_bars)
    out = [x for k, (fast, slow, n) in enumerate(grid) for x in (F.col(lines[fast, slow]).alias(f"line{k}"), F.col(triggers[fast, slow, n]).alias(f"trigger{k}"))]
    return rows.select(*bars.columns, *out)


def with_rsis(bars: DataFrame, spans: list[int], slice_bars: int = SLICE_BARS) -> DataFrame:
    """bars with `rsi{n}` for each n: mean gains and losses smoothed by 1 / n; 50 if flat, 100 without losses."""
    spans = list(dict.fromkeys(spans))
    rows = with_previous(bars, "close", "__was", slice_bars)
    move = F.col("close") - F.col("__was")
    rows = rows.withColumns({"__up": F.when(move.isNotNull(), F.greatest(move, F.lit(0.0))), "__down": F.when(move.isNotNull(), F.greatest(-move, F.lit(0.0)))})
    rows = smoothed(rows, [w for n in spans for w in (wilder("__up", n, f"__gain{n}"), wilder("__down", n, f"__loss{n}"))], slice_bars)

    def level(n: int) -> Column:
        gain, loss = F.col(f"__gain{n}"), F.col(f"__loss{n}")
        return F.when((gain == 0) & (loss == 0), 50.0).when(loss == 0, 100.0).when(gain.isNotNull(), 100 - 100 / (1 + gain / F.nullif(loss, F.lit(0.0))))

    return rows.select(*bars.columns, *[level(n).alias(f"rsi{n}") for n in spans])

"""Parameters chosen on past data and judged on what follows.

Signals and curves are causal, so each candidate is run once over all bars and its curve is cut for every split.
"""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.scalars import cagr
from barloom.operators.curve import equity_curve
from barloom.operators.signals import targets
from barloom.sources.bars import KEY


def expand_grid(axes: dict[str, list]) -> list[dict]:
    """Every combination, in order of the names; refused beyond 400."""
    names = sorted(axes)
    grid = [dict(zip(names, values, strict=True)) for values in product(*(axes[n] for n in names))]
    if len(grid) > 400:
        raise ValueError(f"{len(grid)} candidates; 400 at most")
    return grid


def split_bounds(spark: SparkSession, n: int, train: int, test: int, step: int | None = None) -> DataFrame:
    """(split, train_start, train_end, test_end): half-open ranges of bars, while a whole test fits."""
    step = step or test
    last = (n - train - test) // step
    ids = spark.range(max(0, last + 1)).select(F.col("id").alias("split"))
    start = F.col("split") * step
    return ids.select("split", start.alias("train_start"), (start + train).alias("train_end"), (start + train + test).alias("test_end"))


def series_splits(bars: DataFrame, train: int, test: int, step: int | None = None) -> DataFrame:
    """(series, split, train_start, train_end, test_end): the split_bounds of each series by its own count of bars."""
    step = step or test
    last = F.floor((F.col("n") - train - test) / step)
    counted = bars.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= train + test)
    ids = counted.select(*KEY, F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("split"))
    start = F.col("split") * step
    return ids.select(*KEY, "split", start.alias("train_start"), (start + train).alias("train_end"), (start + train + test).alias("test_end"))


def _with_splits(rows: DataFrame, splits: DataFrame, *on: str) -> DataFrame:
    """rows beside the splits of their own series, or beside splits that hold for all, which are few."""
    if set(KEY) <= set(splits.columns):
        return rows.join(splits, [*KEY, *on])
    return rows.join(F.broadcast(splits), [*on]) if on else rows.crossJoin(F.broadcast(splits))


def candidates(bars: DataFrame, name: str, grid: list[dict], rate: float = 0.001) -> DataFrame:
    """(series, candidate, i, time, open, close, equity): every candidate's curve over all bars, numbered from 0.

    All candidates' targets are columns of one pass over the bars, then rows. Rules that walk do so once for all candidates, and
    smoothings share their slices, so the number of exchanges and of Python stages is the same for one candidate as for four hundred.
    """
    rows, pairs = targets(bars, name, grid), []
    for i in range(len(grid)):
        columns = [F.lit(i).alias("candidate"), F.col(f"__target{i}").alias("target")]
        if f"__exit{i}" in rows.columns:
            columns.append(F.col(f"__exit{i}").alias("exit_price"))
        pairs.append(F.struct(*columns))
    kept = [c for c in ("time", "open", "close", "exit_price") if c in bars.columns]
    rows = rows.select(*KEY, *kept, F.explode(F.array(*pairs)).alias("__pair")).select(*KEY, *kept, "__pair.*")
    curve = equity_curve(rows, rate, [*KEY, "candidate"])
    place = F.row_number().over(W.partitionBy(*KEY, "candidate").orderBy("time")) - 1
    return curve.select(*KEY, "candidate", place.alias("i"), "time", "open", "close", "equity")


def scores(curves: DataFrame, splits: DataFrame, per_year: float) -> DataFrame:
    """(series, split, candidate, total_return, cagr, sharpe) on each train range, rebased to its first point."""
    cut = _with_splits(curves, splits).where("i >= train_start and i < train_end")
    order = W.partitionBy(*KEY, "split", "candidate").orderBy("i")
    before = F.lag("equity").over(order)
    rows = cut.withColumn("__l", F.when((before > 0) & (F.col("equity") > 0), F.ln(F.col("equity") / F.when(before > 0, before))))
    out = rows.groupBy(*KEY, "split", "candidate").agg(
        F.max_by("equity", "i").alias("z"), F.min_by("equity", "i").alias("a"), F.count(F.lit(1)).alias("n"), F.avg("__l").alias("m"), F.stddev_pop("__l").alias("s")
    )
    total = F.col("z") / F.nullif(F.col("a"), F.lit(0.0))
    sharpe = F.when(F.col("s") > 0, F.col("m") / F.nullif(F.col("s"), F.lit(0.0)) * per_year**0.5).otherwise(F.lit(0.0))
    return out.select(*KEY, "split", "candidate", (total - 1).alias("total_return"), cagr(total, F.col("n") / per_year).alias("cagr"), sharpe.alias("sharpe"))


def chosen(scored: DataFrame, metric: str = "sharpe") -> DataFrame:
    """The best candidate of each split, the first one on ties."""
    best = F.max(F.struct(F.round(metric, 12).alias("score"), (-F.col("candidate")).alias("back"))).alias("x")
    return scored.groupBy(*KEY, "split").agg(best).select(*KEY, "split", (-F.col("x.back")).alias("candidate"), F.col("x.score").alias("score"))


def stitched(curves: DataFrame, splits: DataFrame, picks: DataFrame, rate: float = 0.001) -> DataFrame:
    """(series, split, i, time, equity, benchmark): the chosen candidates' test ranges chained, beside holding over the same ones.

    Each range is rebased to its own first bar; holding enters at the bar before the test, less two sides' cost in each split.
    """
    spans = _with_splits(picks, splits, "split")
    cut = curves.join(spans, [*KEY, "candidate"]).where("i >= train_end and i < test_end")
    order = W.partitionBy(*KEY, "split").orderBy("i")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = cut.withColumn("part", F.col("equity") / F.nullif(F.first("equity").over(whole), F.lit(0.0)))
    entry = curves.where("candidate = 0").select(*KEY, (F.col("i") + 1).alias("train_end"), F.col("close").alias("entry"))
    rows = rows.join(entry, [*KEY, "train_end"]).withColumn("hold", F.col("close") / F.col("entry") * (1 - rate) ** 2)
    ends = rows.groupBy(*KEY, "split").agg(F.max_by("part", "i").alias("p"), F.max_by("hold", "i").alias("h"))
    so_far = W.partitionBy(*KEY).orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    ends = ends.select(*KEY, "split", F.coalesce(F.product("p").over(so_far), F.lit(1.0)).alias("level"), F.coalesce(F.product("h").over(so_far), F.lit(1.0)).alias("hold_level"))
    out = rows.join(ends, [*KEY, "split"])
    return out.select(*KEY, "split", "i", "time", (F.col("part") * F.col("level")).alias("equity"), (F.col("hold") * F.col("hold_level")).alias("benchmark"))


def stability(picks: DataFrame) -> DataFrame:
    """(series, candidate, wins, share): how often each candidate was chosen."""
    wins = picks.groupBy(*KEY, "candidate").agg(F.count(F.lit(1)).alias("wins"))
    return wins.withColumn("share", F.col("wins") / F.sum("wins").over(W.partitionBy(*KEY)))

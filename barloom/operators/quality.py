"""What is missing or wrong in stored bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.functions.timegrid import align, instant, seconds_of, shift, slots_between
from barloom.sources.bars import KEY, in_order

MOST_SLOTS = 100_000


def ohlc_invalid() -> Column:
    return (F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close")) | (F.col("high") < F.col("low"))


def ohlc_invalid_tolerant() -> Column:
    """With a tolerance of 1e-9 of the high, 1 at least; values that aren't finite or amounts below 0 are invalid too."""
    tol = F.greatest(F.abs("high"), F.lit(1.0)) * 1e-9
    odd = F.lit(False)
    for c in ("open", "high", "low", "close", "volume", "turnover"):
        odd = odd | F.coalesce(F.isnan(c) | (F.abs(c) == float("inf")), F.lit(False))
    wrong = (
        (F.col("high") + tol < F.greatest("open", "close")) | (F.col("low") - tol > F.least("open", "close")) | (F.col("high") + tol < F.col("low"))
        | (F.col("volume") < 0) | F.coalesce(F.col("turnover") < 0, F.lit(False))
    )
    return odd | wrong


def misaligned(timeframe: str) -> Column:
    return align(F.col("time"), timeframe) != F.col("time")


def gaps(bars: DataFrame, timeframe: str) -> DataFrame:
    """(series, after, before, expected, missing): each place where the next bar isn't the next label. `missing` counts MOST_SLOTS - 1 slots at most, as in quality()."""
    rows = bars.select(*KEY, "time", F.lag("time").over(in_order()).alias("after")).where("after is not null")
    rows = rows.withColumn("expected", shift(F.col("after"), 1, timeframe))
    missing = F.when(F.col("time") <= F.col("expected"), F.lit(0).cast("long")).otherwise(_slots_up(F.col("expected"), F.col("time"), timeframe))
    return rows.where("time <> expected").select(*KEY, "after", F.col("time").alias("before"), "expected", F.least(missing, F.lit(MOST_SLOTS - 1)).alias("missing"))


def _slots_up(start: Column, stop: Column, timeframe: str) -> Column:
    """Labels passed on the way from start to stop, a begun one included."""
    seconds = seconds_of(timeframe)
    if seconds is not None:
        return F.ceil((stop - start) / F.lit(seconds))
    whole = slots_between(start, stop, timeframe)
    return whole + (shift(start, whole, timeframe) < stop).cast("long")


def quality(bars: DataFrame, timeframe: str) -> DataFrame:
    """A row for each series: bars, first, last, gaps, missing, the largest gap in slots, bad rows, prices that aren't positive."""
    before = F.lag("time").over(in_order())
    rows = bars.withColumn("expected", shift(before, 1, timeframe))
    late = F.col("time") > F.col("expected")
    slots = F.when(late, F.least(_slots_up(F.col("expected"), F.col("time"), timeframe), F.lit(MOST_SLOTS - 1))).otherwise(F.lit(0).cast("long"))
    rows = rows.withColumn("gap", F.coalesce(F.col("time") != F.col("expected"), F.lit(False))).withColumn("slots", F.when(F.col("gap"), slots).otherwise(F.lit(0).cast("long")))
    flag = lambda c: F.sum(c.cast("long"))
    positive = F.least("open", "high", "low", "close") <= 0
    return rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("bars"), F.min("time").alias("first_time"), F.max("time").alias("last_time"), flag(F.col("gap")).alias("gaps"),
        F.sum("slots").alias("missing"), (F.max("slots") + 1).alias("largest_gap_slots"), flag(ohlc_invalid()).alias("bad_ohlc"), flag(positive).alias("non_positive"),
    )


def verify(bars: DataFrame, timeframe: str, order: str = "time", max_gaps: int = 20, min_gap_bars: int = 2) -> DataFrame:
    """A row for each series as its rows stand in `order`: coverage, repeats, disorder, invalid and misaligned rows, and the widest gaps."""
    before = F.lag("time").over(W.partitionBy(*KEY).orderBy(order))
    rows = bars.withColumn("before", before)
    missing = slots_between(F.col("before"), F.col("time"), timeframe) - 1
    jumped = (F.col("time") > F.col("before")) & (F.col("time") != shift(F.col("before"), 1, timeframe))
    rows = rows.withColumn("missing", F.when(jumped, F.greatest(missing, F.lit(0))).otherwise(F.lit(0).cast("long")))
    # only the widest are gathered, so a series full of holes makes no long list
    rows = rows.withColumn("width", F.row_number().over(W.partitionBy(*KEY).orderBy(F.col("missing").desc(), "before", "time")))
    gap = F.when((F.col("missing") >= min_gap_bars) & (F.col("width") <= max(max_gaps, 1)), F.struct((-F.col("missing")).alias("rank"), F.col("before").alias("after"), F.col("time").alias("before"), "missing"))
    flag = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("long"))
    out = rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.sum("missing").alias("missing"),
        flag(F.col("time") == F.col("before")).alias("duplicates"), flag(F.col("time") < F.col("before")).alias("out_of_order"),
        flag(ohlc_invalid_tolerant()).alias("invalid"), flag(misaligned(timeframe)).alias("misaligned"),
        F.slice(F.sort_array(F.collect_list(gap)), 1, max(max_gaps, 1)).alias("gaps"),
    )
    expected = slots_between(F.col("first_time"), F.col("last_time"), timeframe) + 1
    clean = (F.size("gaps") == 0) & (F.col("duplicates") + F.col("invalid") + F.col("misaligned") == 0)
    return out.withColumn("expected", expected).withColumn("coverage_pct", F.least(F.col("rows") / F.col("expected") * 100, F.lit(100.0))).withColumn("clean", clean)


def inventory(bars: DataFrame, timeframe: str, floors: DataFrame | None = None) -> DataFrame:
    """Series with their length, ends and the bar to fetch next; totals come as rows of null symbol or null timeframe.

    With `file` and `file_bytes` columns, as stored_files() gives them, also the files and their bytes (a file of several series counts
    for each); with floors (series, floor) the oldest moment that there is, see history_floor().
    """
    stored = "file" in bars.columns
    parts = bars.groupBy(*KEY, *(["file"] if stored else [])).agg(
        F.count(F.lit(1)).alias("bars"), F.min("time").alias("lo"), F.max("time").alias("hi"), *([F.max("file_bytes").alias("size")] if stored else [])
    )
    out = parts.rollup(*reversed(KEY)).agg(
        F.countDistinct("symbol").alias("n_symbols"), F.sum("bars").alias("bars"), F.min("lo").alias("first_time"), F.max("hi").alias("last_time"),
        *([F.count("file").alias("files"), F.sum("size").alias("bytes")] if stored else []),
    )
    out = out.withColumn("next_time", F.when(F.col("symbol").isNotNull(), shift(F.col("last_time"), 1, timeframe)))
    return out if floors is None else out.join(history_floor(floors, bars), list(KEY), "left")


def stored_files(bars: DataFrame) -> DataFrame:
    """Bars as they are read from files, with each one's `file` and `file_bytes`."""
    return bars.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("file_bytes"))


def coverage(bars: DataFrame, group: Column, name: str) -> DataFrame:
    """Ends and rows of each file or period of a series."""
    return bars.groupBy(*KEY, group.alias(name)).agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count(F.lit(1)).alias("rows"))


def islands(bars: DataFrame, timeframe: str) -> DataFrame:
    """Runs of bars without a gap."""
    start = F.coalesce((F.col("time") != shift(F.lag("time").over(in_order()), 1, timeframe)).cast("int"), F.lit(1))
    rows = bars.select(*KEY, "time", start.alias("start")).withColumn("island", F.sum("start").over(in_order()))
    return rows.groupBy(*KEY, "island").agg(F.min("time").alias("first_time"), F.max("time").alias("last_time"), F.count(F.lit(1)).alias("bars"))


def fetch_plan(bars: DataFrame, timeframe: str, floor: int, now: int, limit: int = 1500) -> DataFrame:
    """Half-open windows of at most `limit` bars that cover what is missing before the first bar and after the last one up to `now`.

    Windows are cut on the numbers of slots: steps from the epoch, or calendar months.
    """
    step = seconds_of(timeframe)
    month = lambda t: F.year(instant(t)).cast("long") * 12 + F.month(instant(t)) - 1
    slot = (lambda t: F.floor(t / F.lit(step))) if step else month
    begins = (lambda n: n * step) if step else (lambda n: F.unix_timestamp(F.make_date((n / 12).cast("int"), (n % 12 + 1).cast("int"), F.lit(1)).cast("timestamp")))
    ends_ = bars.groupBy(*KEY).agg(F.min("time").alias("lo"), F.max("time").alias("hi"))
    moment = lambda t: F.lit(t).cast("long")
    head = F.struct(F.lit("head").alias("side"), slot(moment(floor)).alias("a"), slot(F.col("lo")).alias("b"))
    tail = F.struct(F.lit("tail").alias("side"), (slot(F.col("hi")) + 1).alias("a"), slot(moment(now)).alias("b"))
    rows = ends_.select(*KEY, F.explode(F.array(head, tail)).alias("x")).where("x.a < x.b").select(*KEY, "x.*")
    rows = rows.withColumn("n", F.explode(F.sequence(F.col("a"), F.col("b") - 1, F.lit(limit).cast("long"))))
    return rows.select(*KEY, "side", begins(F.col("n")).alias("from_time"), begins(F.least(F.col("n") + limit, F.col("b"))).alias("to_time"))


def merged_intervals(intervals: DataFrame, touch: int = 0, keys: tuple[str, ...] = KEY) -> DataFrame:
    """(series, first_time, last_time, parts): the union of closed intervals (series, first_time, last_time), as those of several files.

    Intervals that overlap, nest, or begin at most `touch` seconds after the end so far (a bar, where bars follow each other) are one: a
    new one begins where the running maximum of ends is left behind.
    """
    order = W.partitionBy(*keys).orderBy("first_time", "last_time")
    so_far = F.max("last_time").over(order.rowsBetween(W.unboundedPreceding, -1))
    fresh = F.coalesce((F.col("first_time") > so_far + touch).cast("int"), F.lit(1))
    rows = intervals.select(*keys, "first_time", "last_time", fresh.alias("fresh")).withColumn("island", F.sum("fresh").over(order))
    return rows.groupBy(*keys, "island").agg(F.min("first_time").alias("first_time"), F.max("last_time").alias("last_time"), F.count(F.lit(1)).alias("parts")).drop("island")


def history_floor(meta: DataFrame, bars: DataFrame) -> DataFrame:
    """(series, floor): the oldest moment that there is of a series, as far as is known.

    meta has the recorded `floor`, and may have `start`, the begin that a bounded load was told, and `full`, whether a load has gone all the way back.
    The older of record and start holds, so a bounded start never loosens a record; what stored bars are older than is belied by them; after a
    full load, and where nothing is known, the floor is the first stored bar.
    """
    first = bars.groupBy(*KEY).agg(F.min("time").alias("first_time"))
    rows = first.join(meta, list(KEY), "left")
    start = F.col("start") if "start" in meta.columns else F.lit(None).cast("long")
    full = F.coalesce("full", F.lit(False)) if "full" in meta.columns else F.lit(False)
    recorded = F.when(F.col("floor") <= F.col("first_time"), F.col("floor"))
    told = F.when(start <= F.col("first_time"), start)
    known = F.coalesce(F.least(recorded, told), F.col("first_time"))
    return rows.select(*KEY, F.when(full, F.col("first_time")).otherwise(known).alias("floor"))
